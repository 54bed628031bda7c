"""Registration of queries with their SQL, and what queries share."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.models_sql import LOADED_AT, compose
from checks.raw_layer import RawLayer, read_given
from starloom.plans.staging import StagingViews
from starloom.plans.warehouse import build_analytics, build_mart, role_views
from starloom.sources.layers import LayerStore
from starloom.sources.workspace import new_workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# The published warehouse of each application and input folder: built once, then
# read from its written tables, as reports do.
_published: dict[tuple[str, str, str], dict[str, DataFrame]] = {}


class Context:
    """Inputs of one query run."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @staticmethod
    def loaded_at() -> Column:
        return F.lit(LOADED_AT).cast("timestamp")

    def given(self, table: str) -> DataFrame:
        return read_given(self.spark, self.sf_dir, table)

    @cached_property
    def raw(self) -> RawLayer:
        return RawLayer(self.spark, self.sf_dir)

    @cached_property
    def stg(self) -> StagingViews:
        return StagingViews(self.raw, self.loaded_at())

    @cached_property
    def store(self) -> LayerStore:
        """An empty store of its own."""
        return LayerStore(self.spark, new_workspace(self.spark))

    def _once(self, part: str, build: Callable[[], dict[str, DataFrame]]):
        key = (self.spark.sparkContext.applicationId, self.sf_dir, part)
        if key not in _published:
            _published[key] = build()
        return _published[key]

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        """The published dimensions and fact, and the role-playing views."""

        def build() -> dict[str, DataFrame]:
            written = build_analytics(self.raw, self.store, self.loaded_at())
            return written | role_views(written)

        return self._once("analytics", build)

    @cached_property
    def published(self) -> dict[str, DataFrame]:
        """All of the above and the mart."""

        def build() -> dict[str, DataFrame]:
            return {"mart_sales_order_line": build_mart(self.tables, self.store)}

        return self.tables | self._once("mart", build)

    @property
    def mart(self) -> DataFrame:
        return self.published["mart_sales_order_line"]


def query(sql: str | None = None, name: str | None = None):
    """Register a function of a :class:`Context`; ``sql`` is the equal SQL."""

    def register(function: Callable[[Context], DataFrame]):
        key = name or function.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = lambda spark, sf_dir: function(Context(spark, sf_dir))
        if sql is not None:
            SQL[key] = compose(sql)
        return function

    return register
