"""Rejects, range bounds, footers, late history, digests, bitmaps and sketches."""

from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.operators import colocated, merge, metrics, quality
from starloom.operators.lookup import JoinLimits
from starloom.sources import files, ranges
from starloom.sources.jdbc import JdbcSource
from starloom.sources.workspace import new_workspace
from tests.conftest import rows

# CSV rejects


def test_bad_records_are_set_aside_whole(spark, tmp_path):
    text = (
        'id,at,price,name\n1,2024-01-01,1.50,plain\nx,2024-01-02,2.50,"two\nlines, ""quoted"""\n'
        "3,yesterday,free,\n4,2024-01-04,4.50\n5,2024-01-05,5.50,more,than,enough\n6,,,\\N\n7,2024-01-07,7.5,\\\\N\n"
    )
    (tmp_path / "a.csv").write_text(text)
    schema = "id int, at date, price decimal(9,2), name string"
    good, bad = files.land_csv_with_rejects(spark, str(tmp_path / "a.csv"), schema, new_workspace(spark))
    assert sorted(r["id"] for r in good.collect()) == [1, 6, 7]
    assert {r["id"]: r["name"] for r in good.collect()} == {1: "plain", 6: None, 7: "\\N"}
    found = {r["record"].split(",")[0]: r for r in bad.collect()}
    assert {k: r["reason"] for k, r in found.items()} == {
        "x": "id is not int: x",
        "3": "at is not date: yesterday; price is not decimal(9,2): free",
        "4": "number of fields",
        "5": "number of fields",
    }
    assert found["x"]["record"] == 'x,2024-01-02,2.50,"two\nlines, ""quoted"""'
    assert all(r["file"].endswith("a.csv") for r in found.values())
    # Counting reads no column, and must not forget the rejects.
    assert (good.count(), bad.count()) == (3, 4)


def test_an_export_without_bad_records_lands_whole(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.sql("select id, cast(id as string) as t from range(20)")
    files.write_csv(df, path)
    good, bad = files.land_csv_with_rejects(spark, path, "id bigint, t string", new_workspace(spark), multi_line=False)
    assert rows(good) == rows(df) and bad.count() == 0


# Ranges


@pytest.mark.parametrize("wanted", [1, 2, 7, 40])
@pytest.mark.parametrize("kind", ["even", "hot", "two hot", "one value", "nulls", "few"])
def test_ranges_hold_every_row_once_and_none_is_uneven(spark, kind, wanted):
    pick = random.Random(kind)
    n = 12_000
    values = {
        "even": [pick.randint(-(10**9), 10**9) for _ in range(n)],
        "hot": [5 if i % 3 == 0 else pick.randint(0, 10**6) for i in range(n)],
        "two hot": [[7, 8, pick.randint(0, 100)][i % 3] for i in range(n)],
        "one value": [42] * n,
        "nulls": [None if i % 50 == 0 else i for i in range(n)],
        "few": [3, 1, 2],
    }[kind]
    df = spark.createDataFrame([(v,) for v in values], "key long")
    bounds = ranges.range_bounds(df, "key", wanted)
    conditions = ranges.predicates(bounds, "key")
    assert len(conditions) <= 2 * wanted + 1
    held = df.select("key", F.array(*[F.expr(c).cast("int") for c in conditions]).alias("met")).collect()
    assert all(sum(m or 0 for m in r["met"]) == 1 for r in held)
    for i in range(len(conditions)):
        mine = {r["key"] for r in held if r["met"][i] == 1}
        count = sum(r["met"][i] == 1 for r in held)
        if kind != "few" and len(mine - {None}) > 1:
            assert count <= 2.05 * len(values) / wanted + (240 if kind == "nulls" else 0)


def test_ranges_of_an_empty_table_and_of_text(spark):
    bounds = ranges.range_bounds(spark.range(0).withColumnRenamed("id", "key"), "key", 4)
    assert ranges.predicates(bounds, "key") == ["(1 = 1 or key is null)"]
    with pytest.raises(ValueError, match="integers"):
        ranges.range_bounds(spark.sql("select 'a' as key"), "key", 4)


def test_jdbc_reads_by_measured_ranges(spark):
    df = spark.range(100).withColumnRenamed("id", "key")
    asked = {}

    class Reader:
        def jdbc(self, url, table, predicates, properties):
            asked.update(url=url, table=table, predicates=predicates, properties=properties)
            return df

    class Session:
        read = Reader()

    source = JdbcSource(Session(), "jdbc:x", schema="s", measured={"t": ("key", ranges.range_bounds(df, "key", 4))})
    assert source.read("t", ["key"]).count() == 100
    assert asked["table"] == "s.t" and len(asked["predicates"]) == 4
    assert asked["properties"] == {"fetchsize": "10000"}


# Footers


def test_footers_answer_without_reading_columns(spark):
    path = f"{new_workspace(spark)}/t"
    spark.range(1000).selectExpr("id", "cast(id as string) as t", "date_add(date'2024-01-01', cast(id as int)) as d").write.parquet(path)
    df = files.footer_aggregate(spark, path, F.count(F.lit(1)).alias("n"), F.max("d").alias("d"), F.min("id").alias("i"))
    scan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MAX(d), MIN(id)]" in scan
    assert df.first()["n"] == 1000 and str(df.first()["d"]) == "2026-09-26"
    # Text has no exact statistics there and is read.
    assert files.footer_aggregate(spark, path, F.max("t").alias("t")).first()["t"] == "999"


# Late history


def plain_history(events):
    """Versions of each key, from all events (key, time, value or None for an end) in order."""
    out = []
    for key in {e[0] for e in events}:
        last, versions = None, []
        for at, value in sorted((e[1], e[2]) for e in events if e[0] == key):
            if value == last:
                continue
            if versions and versions[-1][3] is None:
                versions[-1] = (*versions[-1][:3], at)
            if value is not None:
                versions.append((key, value, at, None))
            last = value
        out += versions
    return sorted(out, key=repr)


def time(at: int) -> str:
    return f"{2000 + at // 4}-{1 + 3 * (at % 4):02d}-01 00:00:00"


def deliver(spark, history, batch):
    """One delivery of rows (key, at, value); None says that the key ends."""
    rows_of = [(k, time(at), v, v is None) for k, at, v in batch]
    df = spark.createDataFrame(rows_of, "k int, at string, v string, gone boolean")
    df = df.withColumn("at", F.col("at").cast("timestamp"))
    after = merge.scd2_apply(history, df, ["k"], ["v"], "at", "gone")
    path = f"{new_workspace(spark)}/h"
    after.write.parquet(path)
    return spark.read.parquet(path)


def found_history(history):
    text = "date_format({0}, 'yyyy-MM-dd HH:mm:ss') as {0}"
    found = history.selectExpr("k", "v", text.format("valid_from"), text.format("valid_to"), "is_current").collect()
    assert all(r["is_current"] == (r["valid_to"] is None) for r in found)
    return sorted((tuple(r)[:4] for r in found), key=repr)


def no_history(spark):
    return spark.createDataFrame([], "k int, v string, valid_from timestamp, valid_to timestamp, is_current boolean")


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.sampled_from([1, 2, None]), st.integers(0, 60)), min_size=1, max_size=14, unique=True
    ),
    st.randoms(use_true_random=False),
)
def test_deliveries_in_any_order_give_the_history_in_order(spark, places, pick):
    # Values all differ, so none is dropped for saying what one before it says.
    events = [(k, at, None if pick.random() < 0.2 else f"v{i}") for i, (k, at) in enumerate(places)]
    # An end that comes before what it ends says nothing; all in one go there is no such order.
    alive = [e for e in events if e[2] is not None]
    ends = [e for e in events if e[2] is None]
    pick.shuffle(alive)
    history = no_history(spark)
    half = len(alive) // 2
    for batch in (alive[half:], alive[:half], ends):
        if batch:
            history = deliver(spark, history, batch)
    assert found_history(history) == [
        (k, v, time(a), None if b is None else time(b)) for k, v, a, b in plain_history(events)
    ]


def test_late_versions_collapse_ties_and_gaps(spark):
    history = deliver(spark, no_history(spark), [(1, 1, "a"), (1, 9, "b"), (2, 1, "a"), (3, 1, "x")])
    history = deliver(spark, history, [(2, 5, None)])
    # Between two versions; the same as before; the same as after; into an ended key; at an end.
    history = deliver(spark, history, [(1, 3, "b"), (2, 3, "a"), (2, 7, "c"), (None, 4, "n")])
    assert found_history(history) == sorted(
        [
            (1, "a", time(1), time(3)), (1, "b", time(3), None), (2, "a", time(1), time(5)),
            (2, "c", time(7), None), (3, "x", time(1), None), (None, "n", time(4), None),
        ],
        key=repr,
    )
    again = deliver(spark, history, [(1, 3, "b"), (2, 5, "d"), (3, 1, None)])
    assert found_history(again) == sorted(
        [
            (1, "a", time(1), time(3)), (1, "b", time(3), None), (2, "a", time(1), time(5)), (2, "d", time(5), time(7)),
            (2, "c", time(7), None), (None, "n", time(4), None),
        ],
        key=repr,
    )


def test_keys_that_a_snapshot_lacks_end(spark):
    history = deliver(spark, no_history(spark), [(1, 1, "a"), (2, 1, "b"), (None, 1, "n"), (4, 8, "late")])
    snapshot = spark.sql("select * from values (1), (9) as t(k)")
    gone = merge.missing_keys(history, snapshot, ["k"], F.lit(time(5)).cast("timestamp"))
    assert sorted(r["k"] or 0 for r in gone.collect()) == [0, 2]
    after = merge.scd2_apply(history, gone, ["k"], ["v"], "effective", "deleted")
    assert found_history(after) == sorted(
        [(1, "a", time(1), None), (2, "b", time(1), time(5)), (None, "n", time(1), time(5)), (4, "late", time(8), None)],
        key=repr,
    )


# Digests


def scanned(df):
    """The filters that reach each file scan of a plan, whole."""
    found, plans = [], [df._jdf.queryExecution().sparkPlan()]
    while plans:
        plan = plans.pop()
        if plan.nodeName().startswith("Scan"):
            found.append({"filters": plan.metadata().apply("PushedFilters")})
        children = plan.children()
        plans += [children.apply(i) for i in range(children.size())]
    return found


def test_digests_find_every_difference_and_spare_equal_ranges(spark):
    folder = new_workspace(spark)
    source = spark.range(-5000, 20_000).selectExpr("id as k", "cast(id % 7 as string) as v", "id * 2 as w")
    extra = spark.sql("select * from values (null, 'n', 1L), (null, 'n', 1L), (-3L, '4', -6L) as t(k, v, w)")
    source = source.unionByName(extra)
    changed = source.selectExpr("k", "if(k = 4321, 'x', v) as v", "w").filter("k is null or k <> 17")
    changed = changed.filter("k is not null").unionByName(extra.limit(1))
    sides = []
    for name, df in (("a", source), ("b", changed)):
        df.repartitionByRange(16, "k").sortWithinPartitions("k").write.parquet(f"{folder}/{name}")
        sides.append(spark.read.parquet(f"{folder}/{name}"))
    found = quality.mismatched_rows_by_digest(*sides, "k", 1000)
    assert rows(found) == rows(quality.mismatched_rows(*sides))
    buckets = quality.differing_buckets(*sides, "k", 1000, ["k", "v", "w"])
    assert sorted(map(str, (r[0] for r in buckets.collect()))) == sorted(["0", "4", "None"])
    scans = [s["filters"] for s in scanned(found)]
    assert scans and all("GreaterThanOrEqual(k,4000)" in s and "LessThan(k,5000)" in s for s in scans)
    equal = quality.mismatched_rows_by_digest(sides[0], sides[0], "k", 1000)
    assert equal.count() == 0
    # No bucket differs, so nothing is left to read.
    assert "Scan" not in equal._jdf.queryExecution().optimizedPlan().toString()


def test_key_ranges_cover_their_buckets():
    assert quality.key_ranges([], 3) == []
    assert quality.key_ranges([5, 1, 2, 3, 9, 20, 21], 64) == [(1, 3), (5, 5), (9, 9), (20, 21)]
    assert quality.key_ranges([5, 1, 2, 3, 9, 20, 21], 2) == [(1, 9), (20, 21)]
    assert quality.key_ranges([5, 1, 2], 1) == [(1, 5)]


# Bitmaps


def test_bitmaps_find_what_the_keys_do(spark):
    pick = random.Random(1)
    known = [*range(-70_000, 70_000, 7), 2**40, 0, 1]
    used = [pick.choice(known) for _ in range(4000)] + [5, 5, -5, 2**40 + 1, -(2**40), None, None, 32_768, -32_768]
    lines = spark.createDataFrame([(k,) for k in used], "k long")
    dim = spark.createDataFrame([(k,) for k in known], "key long")
    edge = quality.Edge("lines", "k", "dim", "key")
    found = quality.relationship_by_bitmap(lines, dim, edge)
    plain = quality.relationship(lines, dim, edge, False)
    assert rows(found) == rows(plain) and found.count() > 4
    assert rows(quality.unique_by_bitmap(lines, "t", "k")) == rows(quality.unique(lines, "t", ["k"]))
    assert quality.unique_by_bitmap(dim.distinct(), "t", "key").count() == 0
    nothing = dim.limit(0)
    assert rows(quality.relationship_by_bitmap(lines, nothing, edge)) == rows(quality.relationship(lines, nothing, edge, False))


# Sketches and periods


def sales(spark):
    fact = spark.range(60_000).selectExpr(
        "if(id % 11 = 0, null, id * 7919 % 9001) as customer_key", "id % 13 as stock_item_key",
        "date_format(date_add(date'2023-01-01', cast(id % 900 as int)), 'yyyyMMdd') as order_date_key",
        "cast(id % 5 as int) as quantity", "cast(id % 9 as decimal(18,2)) as unit_price",
    )
    customers = spark.range(9001).selectExpr(
        "id as customer_key", "concat('c', id % 4) as delivery_country_name",
        "concat('p', id % 12) as delivery_state_province_name", "concat('k', id % 3) as customer_category_name",
    )
    items = spark.range(13).selectExpr("id as stock_item_key", "concat('i', id) as stock_item_name")
    return fact, customers, items


def test_sketches_merge_in_any_order_and_stay_within_their_error(spark):
    fact, customers, _ = sales(spark)
    parts = [metrics.customer_sketches(fact.filter(f"stock_item_key % 3 = {i}"), customers) for i in range(3)]
    one = parts[0].union(parts[1]).union(parts[2])
    other = parts[2].union(parts[0]).union(parts[1])
    whole = metrics.customer_sketches(fact, customers)
    by = ["delivery_country_name", "order_year"]
    found = [rows(metrics.customers_by(s, *by)) for s in (one, other, whole)]
    assert found[0] == found[1] == found[2]
    exact = (
        fact.filter("customer_key is not null").join(customers, "customer_key")
        .groupBy("delivery_country_name", F.substring("order_date_key", 1, 4).alias("order_year"))
        .agg(F.countDistinct("customer_key").alias("n"))
    )
    counts = {(r[0], r[1]): r["n"] for r in exact.collect()}
    for country, year, _, estimate in found[0]:
        assert abs(estimate - counts[country, year]) <= max(1, metrics.SKETCH_ERROR * counts[country, year])


def test_period_metric_shuffles_no_line_where_customers_fit(spark):
    fact, customers, items = sales(spark)
    near = metrics.sales_by_period(fact, customers, items)
    plan = near._jdf.queryExecution().executedPlan().toString()
    # The lines' way up to the partial sums has no exchange but broadcasts.
    initial = plan[plan.index("Initial Plan") :] if "Initial Plan" in plan else plan
    assert initial.count("Exchange hashpartitioning") == 1
    assert "hashpartitioning(customer_category_name" in initial
    far = metrics.sales_by_period(fact, customers, items, JoinLimits(broadcast_rows=10))
    assert rows(near) == rows(far)


# Co-located storage


def plan_of(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text[text.index("Initial Plan") :] if "Initial Plan" in text else text


@pytest.mark.parametrize("hot", [False, True])
def test_stored_by_one_key_they_join_without_an_exchange(spark, hot):
    key = "if(id % 3 = 0, 7, if(id % 17 = 0, null, id % 500))" if hot else "if(id % 117 = 0, null, id % 500)"
    lines = spark.range(30_000).selectExpr("id as line", f"{key} as k", "cast(id as string) as v")
    headers = spark.range(0, 600, 2).selectExpr("id as k", "concat('h', id) as name", "id * 2 as n")
    headers = headers.unionByName(spark.sql("select null as k, 'none' as name, 0L as n"))
    stored = colocated.store_colocated(lines, headers, "k", "k", new_workspace(spark), 8)
    joined = colocated.colocated_lookup(stored, {"name": "header", "n": "n"})
    plan = plan_of(joined)
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" in plan
    named = headers.withColumnsRenamed({"k": "hk", "name": "header"})
    expected = lines.join(named, F.col("k") == F.col("hk"), "left").select("line", "k", "v", "header", "n")
    assert rows(joined) == rows(expected)
    if hot:
        assert stored.hot_rows.select("k").distinct().count() == 1
        assert stored.hot_rows.count() == lines.filter("k = 7").count() > 9_999
        assert "BroadcastHashJoin" in plan
        sizes = stored.rows.groupBy(F.pmod(F.hash("k"), F.lit(8))).count().collect()
        assert max(r["count"] for r in sizes) < 2 * 20_000 / 8
    else:
        assert stored.hot_rows is None


def test_empty_tables_are_stored_and_joined(spark):
    lines, headers = spark.range(0).selectExpr("id as k", "id as v"), spark.range(0).selectExpr("id as k", "id as n")
    stored = colocated.store_colocated(lines, headers, "k", "k", new_workspace(spark), 2)
    assert colocated.colocated_lookup(stored, {"n": "n"}).columns == ["k", "v", "n"]
    assert colocated.colocated_lookup(stored, {"n": "n"}).count() == 0
