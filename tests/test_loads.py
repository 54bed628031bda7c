from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starloom.operators import merge
from starloom.sources import files, hadoop, incremental, loads, workspace
from starloom.sources.jdbc import JdbcSource
from starloom.sources.layers import LayerStore, Route, route
from tests.conftest import SF_DIR, rows

PLACE = ("raw", "t", "at", ["id"])


def batch(spark, *values):
    return spark.createDataFrame(values, "id int, at int, v string")


# Layers


def test_a_model_setting_beats_its_folder():
    assert route("stg_sales_order") == route("stg_dim_customer_wwi")
    assert route("stg_sales_order") == Route("stg", "view")
    assert route("dim_customer") == Route("dwh", "table")
    assert route("dim_contact_person").materialized == "view"
    assert route("mart_sales_order_line").layer == "mart"
    own = {"dim_contact_person": {"materialized": "table", "schema": "mart"}}
    assert route("dim_contact_person", own).layer == "mart"
    assert route("dim_contact_person", own).materialized == "table"


def test_a_table_may_be_replaced_from_itself(spark, store):
    store.replace(spark.range(5), "raw", "t")
    store.replace(store.read("raw", "t").select((F.col("id") + 1).alias("id")), "raw", "t")
    assert rows(store.read("raw", "t")) == [(1,), (2,), (3,), (4,), (5,)]


def test_a_failed_write_leaves_the_table_as_it_was(spark, store):
    store.replace(spark.range(3), "raw", "t")
    broken = spark.range(3).select(F.raise_error(F.lit("broken")).cast("bigint").alias("id"))
    with pytest.raises(PySparkException, match="broken"):
        store.replace(broken, "raw", "t")
    assert store.read("raw", "t").count() == 3
    assert store.replace(spark.range(4), "raw", "t").count() == 4
    assert store.read("raw", "t").count() == 4


def test_pruning_keeps_what_is_in_force(spark, store):
    for number in range(1, 5):
        store.replace(spark.range(number), "raw", "t")
    assert store.prune("raw", "t") == 3
    assert store.prune("raw", "t") == 0
    assert store.read("raw", "t").count() == 4
    assert store.replace(spark.range(9), "raw", "t").count() == 9


def test_reading_a_missing_table_says_so(store):
    with pytest.raises(FileNotFoundError, match="sales_raw.none"):
        store.read("raw", "none")


def test_datasets_carry_the_prefix(spark):
    assert LayerStore(spark, "/x", prefix="eu").location("dwh", "t") == "/x/eu_dwh/t"


def test_a_view_is_not_written(spark, store):
    df = spark.range(2)
    assert store.materialize(df, "dim_contact_person") is df
    assert not store.exists("dwh", "dim_contact_person")
    store.materialize(df, "dim_customer")
    assert store.exists("dwh", "dim_customer")


def test_partitioned_table(spark, store):
    df = spark.range(6).withColumn("p", F.col("id") % 2)
    store.replace(df, "mart", "t", partition_by=["p"])
    assert rows(store.read("mart", "t").filter("p = 1").select("id")) == [(1,), (3,), (5,)]


def test_workspaces_differ_and_lie_in_the_shared_folder(spark):
    first, second = workspace.new_workspace(spark), workspace.new_workspace(spark)
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))


# Merge and history


def test_latest_per_key_breaks_ties_the_same_way(spark):
    df = batch(spark, (1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, None, "d"))
    assert rows(merge.latest_per_key(df, ["id"], ["at"])) == [(1, 2, "c"), (2, None, "d")]


def test_merge_updates_inserts_and_repeats_without_effect(spark, store):
    store.merge(batch(spark, (1, 1, "a"), (2, 1, "b")), "raw", "t", ["id"], ["at"])
    delta = batch(spark, (2, 2, "B"), (2, 3, "C"), (3, 2, "n"))
    expected = [(1, 1, "a"), (2, 3, "C"), (3, 2, "n")]
    for _ in range(2):
        assert rows(store.merge(delta, "raw", "t", ["id"], ["at"])) == expected


versions = st.lists(
    st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 3)), st.text("ab", max_size=1)),
    max_size=12,
)


def newest(values):
    """Per id the row with the greatest (at, v), a missing ``at`` being the least."""
    best = {}
    for row in values:
        rank = (row[1] is not None, row[1] or 0, row[2])
        if row[0] not in best or rank > best[row[0]][0]:
            best[row[0]] = (rank, row)
    return {key: row for key, (_, row) in best.items()}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(first=versions, delta=versions)
def test_merge_equals_brute_force(spark, first, delta):
    schema = "id int, at int, v string"
    target = merge.latest_per_key(spark.createDataFrame(first, schema), ["id"], ["at"])
    fresh = merge.latest_per_key(spark.createDataFrame(delta, schema), ["id"], ["at"])
    merged = merge.merge_on_key(target, fresh, ["id"])
    assert rows(merged) == sorted((newest(first) | newest(delta)).values(), key=repr)


def test_history_closes_adds_keeps_and_repeats_without_effect(spark):
    def at(day):
        return F.lit(f"2024-01-0{day} 00:00:00").cast("timestamp")

    first = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, v string")
    second = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d")], "id int, v string")
    history = merge.scd2_start(first, ["id", "v"], at(1))
    once = merge.scd2_merge(history, second, ["id"], ["v"], at(2))
    one, two = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    expected = sorted(
        [
            (1, "a", one, None, True),
            (2, None, one, two, False),
            (2, "b", two, None, True),
            (3, "c", one, None, True),
            (4, "d", two, None, True),
        ],
        key=repr,
    )
    assert rows(once) == expected
    assert rows(merge.scd2_merge(once, second, ["id"], ["v"], at(3))) == expected


# Cursor loads


def test_replaying_a_cursor_load_adds_nothing(spark, store):
    df = batch(spark, (1, 1, "a"), (2, 2, "b"), (3, 2, "c"))
    incremental.cursor_load(df, store, *PLACE)
    assert rows(incremental.cursor_load(df, store, *PLACE)) == rows(df)
    assert incremental.CursorState(store).get("t_cursor") == "2"


def test_late_rows_at_the_mark_are_taken_and_older_ones_are_not(spark, store):
    incremental.cursor_load(batch(spark, (1, 1, "a"), (2, 5, "b")), store, *PLACE)
    later = batch(spark, (2, 5, "b"), (3, 5, "same mark"), (4, 4, "too old"), (5, 9, "new"))
    loaded = incremental.cursor_load(later, store, *PLACE)
    assert [row[0] for row in rows(loaded)] == [1, 2, 3, 5]
    assert incremental.CursorState(store).get("t_cursor") == "9"


def test_a_run_that_died_before_writing_its_mark_can_be_repeated(spark, store):
    first = batch(spark, (1, 1, "a"))
    second = batch(spark, (1, 1, "a"), (2, 2, "b"), (3, 3, "c"))
    incremental.cursor_load(first, store, *PLACE)
    incremental.cursor_load(second, store, *PLACE)
    incremental.CursorState(store).set("t_cursor", "at", "1")
    assert rows(incremental.cursor_load(second, store, *PLACE)) == rows(second)


def test_merging_cursor_load_updates(spark, store):
    incremental.cursor_load(batch(spark, (1, 1, "a"), (2, 2, "b")), store, *PLACE, "merge")
    changed = batch(spark, (1, 3, "A"), (2, 2, "b"), (9, 1, "too old"))
    merged = incremental.cursor_load(changed, store, *PLACE, "merge")
    assert rows(merged) == [(1, 3, "A"), (2, 2, "b")]
    assert incremental.CursorState(store).get("t_cursor") == "3"


def test_full_refresh_forgets_the_mark(spark, store):
    incremental.cursor_load(batch(spark, (1, 9, "a")), store, *PLACE)
    refreshed = incremental.full_refresh(batch(spark, (2, 1, "b")), store, *PLACE)
    assert rows(refreshed) == [(2, 1, "b")]
    assert incremental.CursorState(store).get("t_cursor") == "1"


def test_an_empty_load_keeps_the_mark(spark, store):
    incremental.cursor_load(batch(spark, (1, 4, "a")), store, *PLACE)
    incremental.cursor_load(batch(spark, (1, 4, "a")).limit(0), store, *PLACE)
    assert incremental.CursorState(store).get("t_cursor") == "4"


def test_missing_cursor_values(spark):
    df = batch(spark, (1, 1, "a"), (2, None, "b"), (3, 5, "c"))
    three = F.lit(3)
    assert rows(incremental.since(df, "at", three, on_null="exclude")) == [(3, 5, "c")]
    kept = incremental.since(df, "at", three, on_null="include")
    assert rows(kept) == [(2, None, "b"), (3, 5, "c")]
    with pytest.raises(PySparkException, match="cursor column at is NULL"):
        incremental.since(df, "at", three).collect()
    with pytest.raises(ValueError, match="on_null"):
        incremental.since(df, "at", three, on_null="other")


def test_range_is_half_open(spark):
    df = batch(spark, (1, 1, "a"), (2, 2, "b"), (3, 3, "c"))
    assert rows(incremental.since(df, "at", F.lit(1), F.lit(3))) == [(1, 1, "a"), (2, 2, "b")]


def test_cursor_bound_reaches_the_parquet_scan(spark, store):
    written = store.replace(batch(spark, (1, 1, "a")), "raw", "t")
    for policy in ("raise", "include", "exclude"):
        found = incremental.since(written, "at", F.lit(3), on_null=policy)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(at,3)" in plan


def test_chunks(spark):
    df = spark.range(100)
    taken = incremental.first_chunks(df, [F.col("id").desc()], chunk_size=3, chunks=2)
    assert [row[0] for row in taken.collect()] == [99, 98, 97, 96, 95, 94]


# Many tables


def test_only_what_was_asked_for_is_loaded(spark, store):
    source = files.FolderSource(spark, SF_DIR)
    assert "lineitem" in source.tables()
    results = loads.load_selected(source, store, ["region", "nation"])
    assert [(r.table, r.rows) for r in results] == [("region", 5), ("nation", 25)]
    assert hadoop.child_names(spark, f"{store.root}/sales_raw") == ["nation", "region"]


def test_extracting_touches_no_table(spark, store):
    staged = loads.extract_only(files.FolderSource(spark, SF_DIR), store, ["region"], "run")
    assert staged["region"].count() == 5
    assert hadoop.child_names(spark, store.root) == ["staging_files"]


def test_merge_load_reports_its_rows(spark, store):
    source = files.FolderSource(spark, SF_DIR)
    wanted = [loads.TableLoad("nation", "merge", keys=("n_nationkey",))]
    for _ in range(2):
        assert [r.rows for r in loads.run_loads(source, store, wanted)] == [25]
    assert store.read("raw", "nation").count() == 25


def test_unknown_settings_are_refused(spark, store):
    source = files.FolderSource(spark, SF_DIR)
    with pytest.raises(ValueError, match="disposition"):
        loads.run_loads(source, store, [loads.TableLoad("region", "other")])
    with pytest.raises(ValueError, match="format"):
        files.write_as(spark.range(1), store.root, "xml")


def test_csv_that_does_not_parse_raises(spark, store):
    files.write_csv(spark.sql("select 'x' as ColorID, 'red' as ColorName"), f"{store.root}/c")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        files.land_csv(spark, f"{store.root}/c", "warehouse__Colors").collect()


# JDBC: settings only, no database is opened


def test_jdbc_settings():
    source = JdbcSource(
        None, "jdbc:x", schema="app", fetch_size=100, ranges={"orders": ("id", 4)}
    )
    assert source.read_settings("other") == {"dbtable": "app.other", "fetchsize": "100"}
    assert source.read_settings("orders", (1, 99)) == {
        "dbtable": "app.orders",
        "fetchsize": "100",
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "99",
        "numPartitions": "4",
    }
    empty = source.read_settings("orders", (None, None))
    assert "partitionColumn" not in empty


def test_a_table_is_loaded_once_per_run(spark, store):
    with pytest.raises(ValueError, match="once"):
        loads.load_selected(files.FolderSource(spark, SF_DIR), store, ["region", "region"])


def test_jdbc_defaults():
    source = JdbcSource(None, "jdbc:x")
    assert source.read_settings("a.t") == {"dbtable": "a.t", "fetchsize": "10000"}
    assert "table_schema || '.' || table_name" in source.listing()
    assert JdbcSource(None, "jdbc:x", schema="s").listing().endswith("table_schema = 's'")
    assert JdbcSource(None, "jdbc:x", catalog_query="q").listing() == "q"


# Partitions and columns


def test_append_keeps_partitions_and_adds_columns(spark, store):
    first = spark.sql("select id, 'a b:c/d' as p, 'x' as a from range(6)")
    store.replace(first, "raw", "t", partition_by=["p"])
    second = spark.sql("select id, 'q' as p, cast(id as string) as b from range(6, 8)")
    returned = store.append(second, "raw", "t")
    read = store.read("raw", "t")
    assert read.columns == returned.columns == ["id", "p", "a", "b"]
    assert rows(read) == rows(returned)
    assert rows(read.filter("id >= 5")) == [(5, "a b:c/d", "x", None), (6, "q", None, "6"), (7, "q", None, "7")]
    folders = hadoop.files_below(spark, store.folder("raw", "t", store.entry("raw", "t")))
    assert all(name.startswith("p=") for name in folders)
    merged = store.merge(spark.sql("select 6L as id, 'q' as p, 'm' as a"), "raw", "t", ["id"])
    assert rows(merged.filter("p = 'q'")) == [(6, "q", "m", None), (7, "q", None, "7")]
    assert merged.count() == 8
    with pytest.raises(ValueError, match="column id is bigint"):
        store.append(spark.sql("select 'text' as id"), "raw", "t")


def test_tables_need_no_success_files(spark, store):
    mark = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf = spark._jsc.hadoopConfiguration()
    conf.set(mark, "false")
    try:
        store.replace(spark.range(2), "raw", "t")
        assert store.exists("raw", "t")
        store.append(spark.range(2, 5), "raw", "t")
    finally:
        conf.unset(mark)
    assert rows(store.read("raw", "t")) == [(0,), (1,), (2,), (3,), (4,)]


def test_an_append_that_fails_half_way_adds_nothing_and_can_be_repeated(spark, store):
    store.replace(spark.range(3), "raw", "t")
    half = spark.range(3, 7, 1, 4).select(
        F.when(F.col("id") == 6, F.raise_error(F.lit("broken")).cast("bigint")).otherwise(F.col("id")).alias("id")
    )
    with pytest.raises(PySparkException, match="broken"):
        store.append(half, "raw", "t")
    assert store.read("raw", "t").count() == 3
    assert rows(store.append(spark.range(3, 5), "raw", "t")) == [(0,), (1,), (2,), (3,), (4,)]
    # A replacement whose last step, naming it, did not come about.
    spark.range(50, 60).write.parquet(f"{store.location('raw', 't')}/data-unnamed")
    assert store.read("raw", "t").count() == 5
    store.prune("raw", "t")
    assert rows(store.read("raw", "t")) == [(0,), (1,), (2,), (3,), (4,)]


def files_of(spark, store, table):
    return set(hadoop.files_below(spark, store.folder("raw", table, store.entry("raw", table))))


def test_merge_overwrites_only_partitions_with_changed_keys(spark, store):
    target = spark.range(0, 4000).selectExpr("id", "id * 2 as v", "id div 1000 as p")
    store.replace(target, "raw", "t", partition_by=["p"])
    before = files_of(spark, store, "t")
    delta = spark.sql("select 5L as id, 0L as v, 0L as p union all select 9999L, 1L, 9L")
    merged = store.merge(delta, "raw", "t", ["id"])
    after = files_of(spark, store, "t")
    kept = {name for name in before if not name.startswith("p=0/")}
    assert kept <= after and kept and not {n for n in before if n.startswith("p=0/")} & after
    assert merged.count() == 4001
    assert rows(merged.filter("id in (4, 5, 9999)").select("id", "v")) == [(4, 8), (5, 0), (9999, 1)]
    assert hadoop.files_below(spark, f"{store.root}/staging_files") == []


def test_merge_moves_rows_between_partitions_and_clears_emptied_ones(spark, store):
    first = spark.sql("select * from values (1, 'a b:c/d%', 1), (2, 'q', 1), (null, null, 1), (4, 'q', 1) as t(id, p, v)")
    store.merge(first, "raw", "t", ["id"], partition_by=["p"])
    # The only rows of two partitions move, one of them to a partition without a value.
    moved = spark.sql("select * from values (1, cast(null as string), 2), (null, 'new', 2), (4, 'r', 2) as t(id, p, v)")
    for _ in range(2):
        merged = store.merge(moved, "raw", "t", ["id"])
        assert rows(merged.select("id", "v", "p")) == [
            (1, 2, None), (2, 1, "q"), (4, 2, "r"), (None, 2, "new")
        ]
    back = spark.sql("select * from values (1, 'q', 3) as t(id, p, v)")
    assert rows(store.merge(back, "raw", "t", ["id"]).select("id", "v", "p")) == [
        (1, 3, "q"), (2, 1, "q"), (4, 2, "r"), (None, 2, "new")
    ]


def test_merge_with_a_hot_partition_and_many_keys(spark, store, monkeypatch):
    from starloom.sources import layers

    monkeypatch.setattr(layers, "fits_broadcast", lambda df: False)
    target = spark.range(3000).selectExpr("id", "id as v", "if(id < 2000, 'hot', concat('p', id % 5)) as p")
    store.replace(target, "raw", "t", partition_by=["p"])
    delta = spark.range(0, 4000, 2).selectExpr("id", "-id as v", "if(id < 2000, 'hot', concat('p', id % 5)) as p")
    merged = store.merge(delta, "raw", "t", ["id"])
    expected = {i: -i if i % 2 == 0 else i for i in [*range(3000), *range(3000, 4000, 2)]}
    assert {r["id"]: r["v"] for r in merged.collect()} == expected
    assert merged.count() == len(expected)


def test_merge_twice_into_the_same_files(spark, store):
    store.replace(spark.range(0, 100, 1, 2).selectExpr("id", "'a' as v"), "raw", "t")
    for value in ("b", "c"):
        store.merge(spark.sql(f"select id, '{value}' as v from range(40, 60)"), "raw", "t", ["id"])
    found = store.read("raw", "t")
    assert found.count() == 100
    assert found.filter("v = 'c'").count() == 20 and found.filter("v = 'b'").count() == 0


def test_missing_and_repeated_keys_merge_once(spark, store):
    delta = spark.sql("select * from values (1, 1, 'a'), (1, 2, 'b'), (null, 1, 'n') as t(id, at, v)")
    for _ in range(3):
        merged = store.merge(delta, "raw", "t", ["id"], ["at"])
    assert rows(merged) == [(1, 2, "b"), (None, 1, "n")]


def test_history_of_repeated_and_missing_keys(spark):
    def at(day):
        return F.lit(f"2024-01-0{day} 00:00:00").cast("timestamp")

    snapshot = spark.sql("select * from values (1, 'a'), (1, 'b'), (null, 'n') as t(id, v)")
    history = merge.scd2_start(snapshot, ["id", "v"], at(1), ["id"])
    for day in (2, 3):
        history = merge.scd2_merge(history, snapshot, ["id"], ["v"], at(day))
    assert rows(history.select("id", "v", "is_current")) == [(1, "b", True), (None, "n", True)]


# Cursor marks


def test_the_mark_does_not_move_with_the_time_zone(spark, store):
    df = spark.sql("select id, timestamp '2024-01-01 00:00:00 UTC' + make_interval(0,0,0,0,id) as at, 'v' as v from range(9)")
    incremental.cursor_load(df.filter("id < 4"), store, *PLACE)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        loaded = incremental.cursor_load(df, store, *PLACE)
        assert loaded.count() == 9
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert incremental.CursorState(store).get("t_cursor").isdigit()


def test_null_keys_are_loaded_once(spark, store):
    df = batch(spark, (1, 1, "a"), (None, 2, "b"), (None, None, "c"), (4, None, "d"))
    for _ in range(3):
        loaded = incremental.cursor_load(df, store, *PLACE, on_null="include")
        assert rows(loaded) == rows(df)


def test_a_settled_cursor_load_does_not_read_its_table(spark, store, monkeypatch):
    incremental.cursor_load(batch(spark, (1, 1, "a"), (None, 5, "b")), store, *PLACE)
    read, asked = store.read, []
    monkeypatch.setattr(store, "read", lambda layer, table: asked.append((layer, table)) or read(layer, table))
    appended = []
    append = store.append
    monkeypatch.setattr(store, "append", lambda df, *a: appended.append(df._jdf.queryExecution().optimizedPlan().toString()) or append(df, *a))
    later = batch(spark, (None, 5, "b"), (3, 5, "same mark"), (5, 9, "new"))
    loaded = incremental.cursor_load(later, store, *PLACE)
    # Once, to hand the table back, and not in the plan of what is added.
    assert asked.count(("raw", "t")) == 1
    assert "sales_raw" not in appended[0]
    assert loaded.count() == 4


def test_rows_that_come_during_a_load_are_left_to_the_next(spark, store, monkeypatch):
    """What comes at the new mark after its keys were settled isn't loaded now, nor lost."""
    path = f"{store.root}/source"
    batch(spark, (1, 5, "a")).write.parquet(path)

    def source():
        return spark.read.schema("id int, at int, v string").parquet(path)

    remember = incremental.CursorState.remember

    def late(self, resource, digests):
        out = remember(self, resource, digests)
        batch(spark, (2, 5, "late"), (3, 7, "later")).write.mode("append").parquet(path)
        return out

    monkeypatch.setattr(incremental.CursorState, "remember", late)
    assert rows(incremental.cursor_load(source(), store, *PLACE)) == [(1, 5, "a")]
    monkeypatch.setattr(incremental.CursorState, "remember", remember)
    assert [r[0] for r in rows(incremental.cursor_load(source(), store, *PLACE))] == [1, 2, 3]


def test_rows_without_a_cursor_are_added_once(spark, store):
    df = batch(spark, (1, 1, "a"), (2, None, "b"), (3, 5, "c"))
    for _ in range(3):
        loaded = incremental.cursor_load(df, store, *PLACE, on_null="include")
    assert rows(loaded) == rows(df)


# CSV


NASTY = [
    'twelve 12" disc', 'deep "sea", blue', "line one\n2,line two", "a\r\nb", " x ", "a\\", "\\N", "\\", "NULL", "", None, '"', ",", "\t", "\\\\N", "é,漢",
]


def test_csv_gives_back_any_text(spark, store):
    df = spark.createDataFrame(list(enumerate(NASTY)), "n int, t string")
    path = f"{store.root}/csv"
    files.write_csv(df, path)
    back = files.read_csv(spark, path, "n int, t string")
    assert sorted(map(tuple, back.collect())) == sorted(enumerate(NASTY))


def test_csv_of_a_database_export(spark, tmp_path):
    export = tmp_path / "colors.csv"
    export.write_text('ColorID,ColorName\r\n1,"12"" disc, red"\r\n2,NULL\r\n3,"two\nlines"\r\n')
    found = files.land_csv(spark, str(export), "warehouse__Colors", null_value="NULL")
    assert rows(found) == [(1, '12" disc, red'), (2, None), (3, "two\nlines")]


def test_csv_with_another_header_raises(spark, tmp_path):
    export = tmp_path / "colors.csv"
    export.write_text("ColorName,ColorID\nred,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.land_csv(spark, str(export), "warehouse__Colors").collect()
