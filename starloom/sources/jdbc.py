"""Tables of a relational database, read by Spark's JDBC source."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from starloom.sources.ranges import predicates

@dataclass(frozen=True)
class JdbcSource:
    """Connection settings; nothing is opened until a table is read.

    ``options`` go to every read (``user``, ``password``, ``driver``,
    ``customSchema`` ...). ``fetch_size`` is how many rows come per round trip; None
    leaves it to the driver, and some drivers then hold a whole table in memory.
    ``ranges`` maps a table to a column and a number of parallel range reads over
    it, which are of equal width and suit a unique, evenly spread column. ``measured`` maps
    a table to a numeric column and its bounds (:func:`starloom.sources.ranges.range_bounds`,
    over the copy landed last): ranges of about equally many rows, a hot value apart. A
    table without either is read by one task, and a warning says so. ``catalog_query`` lists table names and differs
    per database; the default is the standard information schema, with names qualified
    by their schema unless ``schema`` is given.
    """

    spark: SparkSession
    url: str
    schema: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    fetch_size: int | None = 10_000
    ranges: Mapping[str, tuple[str, int]] = field(default_factory=dict)
    measured: Mapping[str, tuple[str, DataFrame]] = field(default_factory=dict)
    catalog_query: str | None = None

    def _named(self, table: str) -> str:
        return f"{self.schema}.{table}" if self.schema else table

    def _load(self, **settings: str) -> DataFrame:
        everywhere = {"url": self.url, **self.options}
        return self.spark.read.format("jdbc").options(**everywhere, **settings).load()

    def tables(self) -> list[str]:
        """Names only, as many as the database has tables."""
        return sorted(row[0] for row in self._load(query=self.listing()).collect())

    def listing(self) -> str:
        """The query that lists the tables, by names that :meth:`read` understands."""
        if self.catalog_query:
            return self.catalog_query
        where = "from information_schema.tables where table_type = 'BASE TABLE'"
        if self.schema:
            return f"select table_name {where} and table_schema = '{self.schema}'"
        return f"select table_schema || '.' || table_name {where}"

    def read_settings(
        self, table: str, ends: tuple[object, object] | None = None
    ) -> dict[str, str]:
        """Reader settings of one table; ``ends`` are the range column's two ends.

        Rows outside the ends, and rows without a value, are read by the first and
        the last range.
        """
        settings = {"dbtable": self._named(table)}
        if self.fetch_size:
            settings["fetchsize"] = str(self.fetch_size)
        if table in self.ranges and ends and ends[0] is not None:
            column, partitions = self.ranges[table]
            settings |= {
                "partitionColumn": column,
                "lowerBound": str(ends[0]),
                "upperBound": str(ends[1]),
                "numPartitions": str(partitions),
            }
        return settings

    def read(self, table: str, columns: Sequence[str] | None = None) -> DataFrame:
        """One table; filters and the column list are pushed to the database."""
        ends = None
        if table in self.measured:
            column, bounds = self.measured[table]
            settings = {"fetchsize": str(self.fetch_size)} if self.fetch_size else {}
            df = self.spark.read.jdbc(
                self.url,
                self._named(table),
                predicates=predicates(bounds, column),
                properties={**self.options, **settings},
            )
            return df.select(*columns) if columns else df
        if table in self.ranges:
            column = self.ranges[table][0]
            bounds = f"select min({column}) lo, max({column}) hi from {self._named(table)}"
            ends = tuple(self._load(query=bounds).first())
        else:
            warnings.warn(f"{table} has no ranges and is read by one task", stacklevel=2)
        df = self._load(**self.read_settings(table, ends))
        return df.select(*columns) if columns else df
