from __future__ import annotations

import functools
import re
import time
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.raw_layer import RawLayer
from checks.registry import Context
from starloom.operators.lookup import (
    JoinLimits,
    Lookup,
    fits_broadcast,
    hot_keys,
    left_lookups,
    lookup_parts,
    near_dims,
)
from starloom.operators.metrics import customers_orders_left
from starloom.operators.quality import relationships
from starloom.plans.mart import mart_parts, mart_sales_order_line
from starloom.plans.warehouse import build_warehouse
from tests.conftest import SF_DIR, rows

SHUFFLE_ONLY = JoinLimits(broadcast_rows=0, hot_share=0.05)


def joined_by_hand(facts, dims):
    return sorted(
        (
            (row, key, value)
            for row, key in facts
            for value in ([v for k, v in dims if k == key and key is not None] or [None])
        ),
        key=repr,
    )


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    keys=st.lists(st.one_of(st.none(), st.integers(0, 6)), min_size=1, max_size=60),
    dims=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 8)), st.text("ab", max_size=2)), max_size=10),
    hot=st.integers(0, 6),
)
def test_shuffled_lookup_equals_brute_force(spark, keys, dims, hot):
    """Hot keys, NULL keys, orphans and repeated dimension keys give the same rows."""
    facts = list(enumerate(keys + [hot] * 40 + [None] * 30))
    fact = spark.createDataFrame(facts, "row_id int, k int")
    dim = spark.createDataFrame(dims, "dk int, v string")
    found = left_lookups(fact, [Lookup(dim, "k", "dk", {"v": "v"})], ["row_id"], SHUFFLE_ONLY)
    assert rows(found) == joined_by_hand(facts, dims)


@pytest.mark.parametrize("size", ["measured", "large"])
def test_rows_of_a_hot_key_are_spread(spark, size):
    fact = spark.range(10_000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 2, F.col("id")).alias("k")
    )
    dim = spark.range(10_000).select(F.col("id").alias("dk"), F.col("id").cast("string").alias("v"))
    hot = hot_keys(fact, ["k"], SHUFFLE_ONLY)["k"].collect()
    assert {key for key, _ in hot} == {7, None}
    assert all(salts > 1 for _, salts in hot)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = left_lookups(fact, [Lookup(dim, "k", "dk", {"v": "v"}, size)], ["id"], SHUFFLE_ONLY)
        held = (
            found.groupBy("k", F.spark_partition_id().alias("p")).count()
            .groupBy("k").agg(F.count(F.lit(1)).alias("places"), F.sum("count").alias("n"))
        )
        places = {row["k"]: (row["places"], row["n"]) for row in held.collect() if row["n"] > 1}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert places[7][0] > 4 and places[7][1] == 3334
    assert places[None][0] > 4 and places[None][1] == 3333


def test_a_large_dimension_with_few_keys_in_use_is_reduced(spark):
    """Both roles are looked up right; the one with few keys in use is not shuffled."""
    fact = spark.range(5000).select(
        "id", (F.col("id") % 5).alias("few"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("many")
    )
    dim = spark.range(10_000).select(F.col("id").alias("dk"), F.concat(F.lit("n"), "id").alias("v"))
    dim = dim.unionByName(dim.filter("dk = 3"))
    lookups = [
        Lookup(dim, "few", "dk", {"v": "few_name"}),
        Lookup(dim, "many", "dk", {"v": "many_name"}),
    ]
    found = left_lookups(fact, lookups, ["id"], JoinLimits(broadcast_rows=100))
    assert found.columns == ["id", "few", "many", "few_name", "many_name"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join LeftOuter, \(few#\d+L = __near_key_0", plan)
    assert re.search(r"Join LeftOuter, .*many#\d+L = __dim_key", plan)
    names = dim.groupBy("dk", "v").count()
    names = [(r["dk"], r["v"], r["count"]) for r in names.collect()]
    by_key = {dk: [v] * n for dk, v, n in names}
    expected = sorted(
        (
            (i, i % 5, many, few_name, many_name)
            for i in range(5000)
            for many in [i if i % 7 > 0 else None]
            for few_name in by_key[i % 5]
            for many_name in by_key.get(many, [None])
        ),
        key=repr,
    )
    assert rows(found) == expected


def test_hot_keys_of_many_partitions_and_of_none(spark):
    spread = spark.range(0, 90_000, 1, 40).selectExpr(
        "case when id % 3 = 0 then 7 when id % 3 = 1 then null else id end as k"
    )
    found = dict(map(tuple, hot_keys(spread, ["k"], JoinLimits(hot_share=0.1))["k"].collect()))
    assert set(found) == {7, None}
    assert all(13 <= salts <= 14 for salts in found.values())
    assert hot_keys(spread.limit(0), ["k"]) == {}


def test_as_many_keys_are_hot_as_hold_more_than_a_partition(spark):
    """Five thousand keys, all of them twice as hot as the limit, and all of them salted."""
    many = spark.range(0, 100_000, 1, 4).select((F.col("id") % 5000).alias("k"), "id")
    found = hot_keys(many, ["k"], JoinLimits(hot_share=1 / 10_000))["k"]
    assert found.count() == 5000 and found.filter("__salts > 1").count() == 5000
    dim = spark.range(5000).select(F.col("id").alias("dk"), F.col("id").cast("string").alias("v"))
    limits = JoinLimits(broadcast_rows=0, hot_share=1 / 10_000)
    joined = left_lookups(many, [Lookup(dim, "k", "dk", {"v": "v"})], ["id"], limits)
    assert joined.filter("v = cast(k as string)").count() == 100_000


def test_hot_keys_of_all_columns_take_one_scan(spark, tmp_path):
    from starloom.operators import lookup as module

    fact = spark.range(1000).selectExpr("id", "id % 2 as a", "id % 3 as b", "id % 400 as c")
    taken = []
    written = module._written
    module._written = lambda df, path, rows: taken.append(path) or written(df, path, rows)
    try:
        found = hot_keys(fact, ["a", "b", "c"], SHUFFLE_ONLY)
    finally:
        module._written = written
    assert set(found) == {"a", "b"}
    assert sum(path.endswith("/sketches") for path in taken) == 1


def test_values_of_any_type_are_measured(spark):
    limits = JoinLimits(broadcast_bytes=100_000)
    for value in ("cast(repeat('x', 2000) as binary)", "array_repeat(id, 500)", "struct(repeat('x', 2000))", "map('k', repeat('x', 2000))"):
        assert not fits_broadcast(spark.range(100).selectExpr("id", f"{value} as v"), limits)


def test_all_broadcasts_of_a_plan_are_bounded(spark):
    fact = spark.range(10).withColumnRenamed("id", "k")
    dims = [spark.range(100).selectExpr("id as dk", f"repeat('x', 500) as v{i}") for i in range(3)]
    lookups = [Lookup(dim, "k", "dk", {f"v{i}": f"v{i}"}) for i, dim in enumerate(dims)]
    assert len(near_dims(lookups, JoinLimits())) == 3
    assert len(near_dims(lookups, JoinLimits(plan_bytes=120_000))) == 2
    assert left_lookups(fact, lookups, ["k"], JoinLimits(plan_bytes=120_000)).count() == 10


def test_size_is_measured_before_broadcasting(spark):
    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
    assert fits_broadcast(wide, JoinLimits(broadcast_rows=100, broadcast_bytes=200_000))
    assert not fits_broadcast(wide, JoinLimits(broadcast_rows=99))
    assert not fits_broadcast(wide, JoinLimits(broadcast_bytes=90_000))


def test_small_dimension_is_broadcast_and_large_is_not(spark):
    fact = spark.range(100).withColumnRenamed("id", "k")
    dim = spark.range(10).select(F.col("id").alias("dk"), F.lit("v").alias("v"))

    def plan(**how):
        limits = how.pop("limits", JoinLimits())
        found = left_lookups(fact, [Lookup(dim, "k", "dk", {"v": "v"}, **how)], ["k"], limits)
        return found._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan()
    assert "SortMergeJoin" in plan(size="large")


def test_warehouse_is_the_same_without_any_measured_broadcast(spark, store):
    """The plan for large dimensions gives the rows of the plan for small ones."""
    small = Context(spark, SF_DIR).published
    large = build_warehouse(RawLayer(spark, SF_DIR), store, Context.loaded_at(), SHUFFLE_ONLY)
    for name in ("dim_customer", "dim_stock_item", "mart_sales_order_line"):
        assert large[name].columns == small[name].columns
        assert large[name].exceptAll(small[name]).count() == 0
        assert small[name].exceptAll(large[name]).count() == 0
    wide = mart_sales_order_line(small, SHUFFLE_ONLY)
    assert wide.count() == small["fact_sales_order_line"].count()


def test_mart_is_the_same_when_only_the_rows_in_use_are_small(spark):
    """Persons are too many to broadcast, the salespeople and pickers among them are not."""
    tables = Context(spark, SF_DIR).published
    limits = JoinLimits(broadcast_rows=50, hot_share=0.05)
    mixed = mart_sales_order_line(tables, limits)
    mart = tables["mart_sales_order_line"]
    assert mixed.exceptAll(mart).count() == 0 and mart.exceptAll(mixed).count() == 0


def test_reports_are_the_same_without_any_measured_broadcast(spark):
    tables = Context(spark, SF_DIR).published
    fact, customers = tables["fact_sales_order_line"], tables["dim_customer"]
    near = customers_orders_left(customers, fact)
    far = customers_orders_left(customers, fact, SHUFFLE_ONLY)
    assert near.exceptAll(far).count() == 0 and far.exceptAll(near).count() == 0
    assert rows(relationships(tables)) == rows(relationships(tables, limits=SHUFFLE_ONLY))


def shuffle_files(spark) -> int:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return sum(len(list(Path(str(folder)).rglob("shuffle_*"))) for folder in folders)


def test_mart_in_parts_has_the_same_rows(spark, store):
    """Each part has its share of the lines, and one part's shuffles are gone before the next."""
    tables = Context(spark, SF_DIR).published
    fact, mart = tables["fact_sales_order_line"], tables["mart_sales_order_line"]
    # One customer and no customer at all have a sixth of the lines each.
    hot = F.when(F.col("sales_order_line_key") % 6 == 0, 7).when(F.col("sales_order_line_key") % 6 > 1, F.col("customer_key"))
    uneven = fact.withColumn("customer_key", hot.cast("long"))
    # Contact persons, items and customers are shuffled: six times the parts of one lookup.
    limits = JoinLimits(broadcast_rows=50, hot_share=0.05, parts=1, part_rows=1000)
    for lines, whole in ((fact, mart), (uneven, None)):
        changed = tables | {"fact_sales_order_line": lines}
        parts = mart_parts(changed, limits)
        held = [part.count() for part in parts]
        assert len(parts) == 6 and max(held) < 1.5 * fact.count() / 6
        whole = mart_sales_order_line(changed) if whole is None else whole
        before = shuffle_files(spark)
        written = store.materialize(parts, "mart_sales_order_line")
        assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) != "true"
        deadline = time.time() + 20
        while shuffle_files(spark) > before and time.time() < deadline:
            time.sleep(0.2)
        assert shuffle_files(spark) <= before
        assert written.columns == mart.columns
        assert written.exceptAll(whole).count() == 0 and whole.exceptAll(written).count() == 0


def test_parts_keep_orphans_nulls_and_repeated_keys_of_any_type(spark):
    """Also where both keys have other types, whose hashes don't agree."""
    fact = spark.range(4000).selectExpr("id", "cast(case when id % 7 > 0 then id % 900 end as int) as k")
    for kind in ("int", "long", "string", "decimal(20,3)"):
        dim = spark.range(1000).filter("id % 10 > 0").selectExpr("id * 2 as n").union(spark.range(50))
        dim = dim.selectExpr(f"cast(n as {kind}) as dk", "n as v")
        lookups = [Lookup(dim, "k", "dk", {"v": "v"})]
        limits = JoinLimits(broadcast_rows=0, hot_share=0.05, part_rows=100)
        parts = lookup_parts(fact, lookups, ["id"], limits)
        whole = left_lookups(fact, lookups, ["id"], SHUFFLE_ONLY)
        assert len(parts) == 2 and all(0 < part.count() < whole.count() * 0.7 for part in parts)
        together = functools.reduce(DataFrame.unionByName, parts)
        assert rows(together) == rows(whole)


def test_keys_in_use_too_many_to_broadcast_their_rows_are_not_sent(spark, monkeypatch):
    from starloom.operators import lookup as module

    fact = spark.range(3000).withColumnRenamed("id", "k")
    dim = spark.range(5000).select(F.col("id").alias("dk"), F.col("id").cast("string").alias("v"))
    taken = []
    monkeypatch.setattr(module, "_written", lambda df, path, rows: taken.append(path))
    # 3,000 keys by themselves are 96,000 bytes, with a value each 144,000 and more.
    limits = JoinLimits(broadcast_bytes=100_000)
    assert module.few_used(fact, [Lookup(dim, "k", "dk", {"v": "v"})], limits) == {}
    assert taken == []
