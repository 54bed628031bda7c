"""Queries over sources, sinks, load dispositions, cursor loads and type policies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.models_sql import LOADED_AT
from checks.raw_layer import RAW_SQL
from checks.registry import Context, query
from starloom.functions import coercion
from starloom.functions.calendar import date_spine_of
from starloom.operators import merge
from starloom.plans.roles import dim_salesperson_person
from starloom.sources import contracts, files, incremental, loads, ranges
from starloom.sources.layers import LayerStore, route

# The landing tables are the orders as two exports: the second starts before the
# first ends, so it holds changed orders as well as new ones.
DELTA_FROM = "1998-01-01"
BASE_UNTIL = "1999-01-01"
# The events as the source held them at a first load.
FIRST_LOAD_UNTIL = "2024-01-15 00:00:00"
NOW = "2024-01-30 00:00:00"
# Order keys in one partition of a merged table.
ORDERS_A_RANGE = 50_000

LANDING_SQL = """
    select o_orderkey as order_key, o_custkey as customer_key, o_orderstatus as status,
        cast(o_totalprice as decimal(18,2)) as total, o_orderdate as updated
    from orders"""


def landing_orders(ctx: Context) -> DataFrame:
    return ctx.given("orders").select(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_custkey").alias("customer_key"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total"),
        F.col("o_orderdate").alias("updated"),
    )


def landing_base(ctx: Context) -> DataFrame:
    return landing_orders(ctx).filter(F.col("updated") < F.lit(BASE_UNTIL).cast("timestamp_ntz"))


def landing_delta(ctx: Context) -> DataFrame:
    """Two versions of each order since ``DELTA_FROM``; the later one counts."""
    since = landing_orders(ctx).filter(
        F.col("updated") >= F.lit(DELTA_FROM).cast("timestamp_ntz")
    )

    def version(added: str, later: str) -> DataFrame:
        return since.withColumns(
            {
                "total": (F.col("total") + F.lit(added).cast("decimal(3,2)")).cast("decimal(18,2)"),
                "updated": F.col("updated") + F.expr(f"interval {later}"),
            }
        )

    return version("0.50", "12 hours").unionByName(version("1.00", "24 hours"))


MERGED_SQL = f"""
    select order_key, customer_key, status,
        cast(case when updated >= '{DELTA_FROM}' then total + 1 else total end as decimal(18,2))
            as total,
        case when updated >= '{DELTA_FROM}' then updated + interval 1 day else updated end
            as updated
    from ({LANDING_SQL}) o"""


# Sources

def _contract_columns(table: str) -> list[tuple[str, str]]:
    return [tuple(part.strip().split(" ")) for part in contracts.RAW_TABLES[table].split(", ")]


def _contract_sql() -> str:
    parts = []
    for table in RAW_SQL:
        for column, kind in _contract_columns(table):
            parts.append(
                f"select '{table}' as table_name, '{column}' as column_name,"
                f" '{kind}' as expected_type, 'string' as actual_type,"
                f" count(*) as row_count, count(*) - count({column}) as null_count,"
                f" cast(0 as bigint) as uncastable_count from {table}"
            )
    return "\nunion all\n".join(parts)


@query(_contract_sql())
def schema_contract(ctx: Context) -> DataFrame:
    """The raw tables as untyped text against their contracts."""
    untyped = {table: contracts.as_text(df) for table, df in ctx.raw.items()}
    return contracts.contract_reports(untyped)


@query("select * from sales__Customers")
def csv_landing(ctx: Context) -> DataFrame:
    path = f"{ctx.store.root}/exports/sales__Customers"
    files.write_csv(ctx.raw["sales__Customers"], path)
    return files.land_csv(ctx.spark, path, "sales__Customers")


@query(
    """
    select doc_id, case doc_id % 8 when 0 then null when 1 then '' when 2 then 'NULL'
            when 3 then '\\N' when 4 then '"' || text || '", ' when 5 then ' ' || text || ' \\'
            else text end as text, lang, source, n_chars
    from documents"""
)
def csv_landing_text(ctx: Context) -> DataFrame:
    """Text with quotes, line breaks, outer blanks and the spellings of a missing value."""
    docs = ctx.given("documents")
    text, case = F.col("text"), F.col("doc_id") % 8
    nasty = (
        F.when(case == 0, F.lit(None))
        .when(case == 1, "")
        .when(case == 2, "NULL")
        .when(case == 3, "\\N")
        .when(case == 4, F.concat(F.lit('"'), text, F.lit('", ')))
        .when(case == 5, F.concat(F.lit(" "), text, F.lit(" \\")))
        .otherwise(text)
    )
    path = f"{ctx.store.root}/csv_text"
    files.write_csv(docs.withColumn("text", nasty), path)
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return files.read_csv(ctx.spark, path, schema)


@query("select * from sales__Orders")
def csv_landing_orders(ctx: Context) -> DataFrame:
    path = f"{ctx.store.root}/exports/sales__Orders"
    files.write_csv(ctx.raw["sales__Orders"], path)
    return files.land_csv(ctx.spark, path, "sales__Orders")


_SOON = "OrderID % 50 = 3"
_NAMED = "OrderID % 70 = 5"


@query(
    f"""
    select cast(OrderID as varchar) as order_id, CustomerID as customer_id,
        ExpectedDeliveryDate as expected, 'landed' as outcome, null as reason
    from sales__Orders where not ({_SOON} or {_NAMED})
    union all
    select cast(OrderID as varchar), null, null, 'rejected', concat_ws('; ',
        case when {_NAMED} then 'CustomerID is not bigint: C' || CustomerID end,
        case when {_SOON} then 'ExpectedDeliveryDate is not date: soon' end)
    from sales__Orders where {_SOON} or {_NAMED}"""
)
def csv_landing_rejects(ctx: Context) -> DataFrame:
    """An export some of whose values don't have their type: the rest lands."""
    path, schema = f"{ctx.store.root}/exports/untidy", contracts.RAW_TABLES["sales__Orders"]
    named = F.when(F.expr(_NAMED), F.concat(F.lit("C"), "CustomerID"))
    untidy = ctx.raw["sales__Orders"].withColumns(
        {
            "CustomerID": F.coalesce(named, F.col("CustomerID").cast("string")),
            "ExpectedDeliveryDate": F.when(F.expr(_SOON), "soon").otherwise(
                F.col("ExpectedDeliveryDate").cast("string")
            ),
        }
    )
    files.write_csv(untidy, path)
    landed, rejects = files.land_csv_with_rejects(
        ctx.spark, path, schema, f"{ctx.store.root}/landing"
    )
    good = landed.select(
        F.col("OrderID").cast("string").alias("order_id"),
        F.col("CustomerID").alias("customer_id"),
        F.col("ExpectedDeliveryDate").alias("expected"),
        F.lit("landed").alias("outcome"),
        F.lit(None).cast("string").alias("reason"),
    )
    bad = rejects.select(
        F.split("record", ",")[0].alias("order_id"),
        F.lit(None).cast("bigint").alias("customer_id"),
        F.lit(None).cast("date").alias("expected"),
        F.lit("rejected").alias("outcome"),
        "reason",
    )
    return good.unionByName(bad)


@query(
    """
    select cast(unnest(generate_series(min(OrderDate), max(OrderDate), interval 1 day)) as date)
        as full_date
    from sales__Orders"""
)
def date_spine(ctx: Context) -> DataFrame:
    """One row per day over the range the orders span."""
    return date_spine_of(ctx.raw["sales__Orders"], "OrderDate")


GIVEN = (
    "benchmark",
    "conversations",
    "customer",
    "documents",
    "embeddings",
    "events",
    "labels",
    "lineitem",
    "nation",
    "orders",
    "pages",
    "part",
    "region",
    "supplier",
)


def _counts_sql(tables, disposition: str = "replace") -> str:
    return "\nunion all\n".join(
        f"select '{t}' as table_name, '{disposition}' as disposition, count(*) as row_count"
        f" from {t}"
        for t in tables
    )


def _report(ctx: Context, results) -> DataFrame:
    return loads.report_frame(ctx.spark, results).drop("seconds")


@query(_counts_sql(GIVEN))
def load_all(ctx: Context) -> DataFrame:
    source = files.FolderSource(ctx.spark, ctx.sf_dir)
    return _report(ctx, loads.load_all(source, ctx.store))


@query(_counts_sql(("customer", "orders")))
def load_selected(ctx: Context) -> DataFrame:
    source = files.FolderSource(ctx.spark, ctx.sf_dir)
    return _report(ctx, loads.load_selected(source, ctx.store, ["customer", "orders"]))


@query("select * from orders")
def table_scan(ctx: Context) -> DataFrame:
    return files.FolderSource(ctx.spark, ctx.sf_dir).read("orders")


@query("select * from lineitem")
def parquet_scan(ctx: Context) -> DataFrame:
    return ctx.given("lineitem")


RANGED = (("orders", "o_custkey", 16), ("lineitem", "l_orderkey", 40), ("events", "user_id", 8))


@query(
    "\nunion all\n".join(
        f"select '{t}' as table_name, count(*) as row_count, count(*) as rows_in_one_range,"
        f" cast(0 as bigint) as uneven_ranges from {t}"
        for t, _, _ in RANGED
    )
    + """
    union all
    select 'skewed', count(*), count(*), 0 from lineitem"""
)
def range_bounds(ctx: Context) -> DataFrame:
    """Ranges for parallel reads of keys, a skewed one among them, laid over their tables.

    Uneven is a range of more than twice the average that isn't one value by itself. Of the
    skewed key, a third of the rows have one value.
    """
    hot = F.when(F.col("l_linenumber") % 3 == 1, 77).otherwise(F.col("l_partkey"))
    tables = [(name, ctx.given(name).select(F.col(c).alias("key")), n) for name, c, n in RANGED]
    tables.append(("skewed", ctx.given("lineitem").select(hot.alias("key")), 25))
    reports = []
    for name, df, wanted in tables:
        bounds = ranges.range_bounds(df, "key", wanted)
        met = df.join(
            F.broadcast(bounds), ranges.in_range(F.col("key"), F.col("lower"), F.col("upper"))
        )
        counted = met.groupBy("number").agg(
            F.count(F.lit(1)).alias("n"), (F.min("key") < F.max("key")).alias("several")
        )
        total = df.agg(F.count(F.lit(1)).alias("row_count"))
        uneven = F.count_if(F.col("several") & (F.col("n") * wanted > 2 * F.col("row_count")))
        reports.append(
            counted.join(F.broadcast(total))
            .groupBy("row_count")
            .agg(F.sum("n").alias("rows_in_one_range"), uneven.alias("uneven_ranges"))
            .select(F.lit(name).alias("table_name"), "row_count", "rows_in_one_range", "uneven_ranges")
        )
    first, *others = reports
    for other in others:
        first = first.unionByName(other)
    return first


FOOTERS = (("orders", "o_orderkey"), ("lineitem", "l_partkey"), ("events", "event_id"))


@query(
    "\nunion all\n".join(
        f"select '{t}' as table_name, count(*) as row_count, min({c}) as least, max({c}) as greatest from {t}"
        for t, c in FOOTERS
    )
)
def footer_statistics(ctx: Context) -> DataFrame:
    """Counts and ends of keys from the files' footers; no column is read."""
    found = []
    for table, column in FOOTERS:
        counted = files.footer_aggregate(
            ctx.spark,
            f"{ctx.sf_dir}/{table}.parquet",
            F.count(F.lit(1)).alias("row_count"),
            F.min(column).alias("least"),
            F.max(column).alias("greatest"),
        )
        found.append((table, *counted.first()))
    schema = "table_name string, row_count bigint, least bigint, greatest bigint"
    return ctx.spark.createDataFrame(found, schema)


def _reflection_sql(table: str, columns: list[tuple[str, str]]) -> str:
    parts = []
    for position, (column, kind) in enumerate(columns, start=1):
        text = kind == "string"
        decimal = kind.startswith("decimal")
        precision, scale = kind[8:-1].split(",") if decimal else ("null", "null")
        longest = f"cast(max(length({column})) as int)" if text else "cast(null as int)"
        parts.append(
            f"select '{table}' as table_name, {position} as ordinal_position,"
            f" '{column}' as column_name, '{kind}' as data_type,"
            f" cast({precision} as int) as numeric_precision,"
            f" cast({scale} as int) as numeric_scale,"
            f" {longest} as longest_text, count({column}) as non_null_count from {table}"
        )
    return "\nunion all\n".join(parts)


REFLECTED = tuple(contracts.RAW_TABLES)


@query("\nunion all\n".join(_reflection_sql(t, _contract_columns(t)) for t in REFLECTED))
def schema_reflection(ctx: Context) -> DataFrame:
    """Types at full precision and the widths in use."""
    first, *others = [contracts.schema_reflection(ctx.raw[table], table) for table in REFLECTED]
    for other in others:
        first = first.unionByName(other)
    return first


EVENT_COLUMNS = [
    ("event_id", "bigint"),
    ("ts", "timestamp_ntz"),
    ("user_id", "bigint"),
    ("event_type", "string"),
    ("value", "double"),
    ("props", "string"),
]


@query(_reflection_sql("events", EVENT_COLUMNS))
def schema_report(ctx: Context) -> DataFrame:
    """Columns as inferred once a table has been loaded."""
    source = files.FolderSource(ctx.spark, ctx.sf_dir)
    loads.load_selected(source, ctx.store, ["events"])
    return contracts.schema_reflection(ctx.store.read("raw", "events"), "events")


# Sinks and dispositions


@query("select * from stg_sales_customer")
def materialize_table(ctx: Context) -> DataFrame:
    return ctx.store.replace(ctx.stg["stg_sales_customer"], "stg", "stg_sales_customer")


@query("select * from dim_salesperson_person")
def materialize_view(ctx: Context) -> DataFrame:
    """A view over a written dimension, worked out when it is read."""
    view = dim_salesperson_person(ctx.tables["dim_person"])
    view.createOrReplaceTempView("starloom_salespeople")
    return ctx.spark.table("starloom_salespeople")


ROUTED = {
    "dim_contact_person": ("sales_dwh", "view"),
    "dim_customer": ("sales_dwh", "table"),
    "dim_date": ("sales_dwh", "table"),
    "dim_package_type": ("sales_dwh", "table"),
    "dim_person": ("sales_dwh", "table"),
    "dim_picked_by_person": ("sales_dwh", "view"),
    "dim_salesperson_person": ("sales_dwh", "view"),
    "dim_stock_item": ("sales_dwh", "table"),
    "fact_sales_order_line": ("sales_dwh", "table"),
    "mart_sales_order_line": ("sales_mart", "table"),
}


@query(
    "\nunion all\n".join(
        f"select '{model}' as model, '{dataset}' as dataset, '{kind}' as materialized,"
        f" count(*) as row_count from {model}"
        for model, (dataset, kind) in ROUTED.items()
    )
)
def layer_routing(ctx: Context) -> DataFrame:
    """Where each published relation lies and how many rows it has there."""
    names = LayerStore(ctx.spark, ctx.store.root)
    result = None
    for model, df in ctx.published.items():
        chosen = route(model)
        row = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(model).alias("model"),
            F.lit(names.dataset(chosen.layer)).alias("dataset"),
            F.lit(chosen.materialized).alias("materialized"),
            "row_count",
        )
        result = row if result is None else result.unionByName(row)
    return result


@query(MERGED_SQL.replace(f"case when updated >= '{DELTA_FROM}' then", "case when true then"))
def load_replace(ctx: Context) -> DataFrame:
    """Orders replaced by a version of themselves that is worked out from them."""
    store = ctx.store
    first = store.replace(landing_orders(ctx), "raw", "landing_orders")
    changed = first.withColumns(
        {
            "total": (F.col("total") + 1).cast("decimal(18,2)"),
            "updated": F.col("updated") + F.expr("interval 1 day"),
        }
    )
    store.replace(changed, "raw", "landing_orders")
    return store.read("raw", "landing_orders")


@query(LANDING_SQL)
def load_append(ctx: Context) -> DataFrame:
    later = landing_orders(ctx).filter(
        F.col("updated") >= F.lit(BASE_UNTIL).cast("timestamp_ntz")
    )
    ctx.store.append(landing_base(ctx), "raw", "landing_orders")
    return ctx.store.append(later, "raw", "landing_orders")


@query(
    """
    select o_orderkey, o_orderstatus, o_totalprice,
        case when o_orderkey % 2 = 1 then o_orderpriority end as o_orderpriority
    from orders"""
)
def load_append_partitioned(ctx: Context) -> DataFrame:
    """A partitioned table, to which the second load adds rows and a column."""
    orders = ctx.given("orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )
    place = ("raw", "orders_by_status")
    first = orders.filter("o_orderkey % 2 <> 1").drop("o_orderpriority")
    ctx.store.replace(first, *place, partition_by=["o_orderstatus"])
    ctx.store.append(orders.filter("o_orderkey % 2 = 1"), *place)
    return ctx.store.read(*place)


@query(MERGED_SQL)
def load_merge(ctx: Context) -> DataFrame:
    """Orders partitioned by ranges of their key; the merge overwrites the ranges it changes."""
    how = {"keys": ["order_key"], "order_by": ["updated"], "partition_by": ["order_range"]}
    merged = None
    for export in (landing_base(ctx), landing_delta(ctx)):
        ranged = export.withColumn("order_range", F.expr(f"order_key div {ORDERS_A_RANGE}"))
        merged = ctx.store.merge(ranged, "raw", "landing_orders", **how)
    return merged.drop("order_range")


@query(LANDING_SQL)
def load_full_refresh(ctx: Context) -> DataFrame:
    """A cursor load of the first export, then everything anew."""
    place = (ctx.store, "raw", "landing_orders", "updated", ["order_key"])
    incremental.cursor_load(landing_base(ctx), *place)
    return incremental.full_refresh(landing_orders(ctx), *place)


@query("select * from part")
def extract_only(ctx: Context) -> DataFrame:
    source = files.FolderSource(ctx.spark, ctx.sf_dir)
    return loads.extract_only(source, ctx.store, ["part"], "extract")["part"]


@query(
    "\nunion all\n".join(
        f"select '{fmt}' as sink_format, count(*) as row_count,"
        " cast(sum(Quantity) as bigint) as quantity,"
        " cast(sum(UnitPrice) as decimal(38,2)) as unit_price,"
        " max(PickingCompletedWhen) as last_picking from sales__OrderLines"
        for fmt in ("csv", "parquet")
    )
)
def sink_format(ctx: Context) -> DataFrame:
    """The order lines written in both formats and read back."""
    back = {}
    for fmt in ("csv", "parquet"):
        path = f"{ctx.store.root}/formats/{fmt}"
        files.write_as(ctx.raw["sales__OrderLines"], path, fmt)
        back[fmt] = (
            files.land_csv(ctx.spark, path, "sales__OrderLines")
            if fmt == "csv"
            else ctx.spark.read.parquet(path)
        )
    read = [df.withColumn("sink_format", F.lit(fmt)) for fmt, df in back.items()]
    return (
        read[0]
        .unionByName(read[1])
        .groupBy("sink_format")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum("Quantity").alias("quantity"),
            F.sum("UnitPrice").cast("decimal(38,2)").alias("unit_price"),
            F.max("PickingCompletedWhen").alias("last_picking"),
        )
    )


@query(
    """
    select 'orders' as table_name, 'replace' as disposition, count(*) as row_count from orders
    union all
    select 'lineitem', 'append', count(*) from lineitem
    union all
    select 'customer', 'merge', count(*) from customer"""
)
def load_report(ctx: Context) -> DataFrame:
    source = files.FolderSource(ctx.spark, ctx.sf_dir)
    wanted = [
        loads.TableLoad("orders"),
        loads.TableLoad("lineitem", "append"),
        loads.TableLoad("customer", "merge", keys=("c_custkey",), order_by=("c_acctbal",)),
    ]
    return _report(ctx, loads.run_loads(source, ctx.store, wanted))


# Cursor loads


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


@query(
    f"""
    select event_id, ts, user_id, event_type, value, props,
        case when ts <= '{FIRST_LOAD_UNTIL}' then 1 else 2 end as load_number
    from events"""
)
def incremental_cursor(ctx: Context) -> DataFrame:
    """Two appending loads; the second reads the rows at the mark again and skips them."""
    events = ctx.given("events")
    place = (ctx.store, "raw", "events", "ts", ["event_id"])
    earlier = events.filter(F.col("ts") <= _ntz(FIRST_LOAD_UNTIL))
    incremental.cursor_load(earlier.withColumn("load_number", F.lit(1)), *place)
    return incremental.cursor_load(events.withColumn("load_number", F.lit(2)), *place)


@query(f"select * from events where ts >= '{FIRST_LOAD_UNTIL}'")
def incremental_initial(ctx: Context) -> DataFrame:
    place = (ctx.store, "raw", "events", "ts", ["event_id"])
    return incremental.cursor_load(ctx.given("events"), *place, initial=FIRST_LOAD_UNTIL)


@query("select * from events where ts >= '2024-01-10' and ts < '2024-01-20'")
def incremental_range(ctx: Context) -> DataFrame:
    bounds = (_ntz("2024-01-10 00:00:00"), _ntz("2024-01-20 00:00:00"))
    return incremental.since(ctx.given("events"), "ts", *bounds)


@query("select * from events order by ts desc, event_id")
def incremental_desc(ctx: Context) -> DataFrame:
    return incremental.newest_first(ctx.given("events"), "ts", "event_id")


@query("select * from events order by ts desc, event_id limit 10")
def limited_chunk(ctx: Context) -> DataFrame:
    """The newest chunk of ten rows: the chunk size is the feature."""
    order = [F.col("ts").desc(), F.col("event_id")]
    return incremental.first_chunks(ctx.given("events"), order, chunk_size=10)


@query(
    f"""
    select order_key, updated from ({LANDING_SQL}) o
    where updated >= timestamp '2000-06-30 00:00:00' - interval 1 year
        and updated < timestamp '2000-06-30 00:00:00'"""
)
def relative_range(ctx: Context) -> DataFrame:
    """Orders of the year before a given now."""
    now = _ntz("2000-06-30 00:00:00")
    orders = landing_orders(ctx).select("order_key", "updated")
    return incremental.since(orders, "updated", incremental.years_back(now), now)


@query(f"select order_key, updated, timestamp '{LOADED_AT}' as processed_at from ({LANDING_SQL}) o")
def load_stamp(ctx: Context) -> DataFrame:
    return incremental.load_stamp(
        landing_orders(ctx).select("order_key", "updated"), ctx.loaded_at()
    )


# Column choice and type policies at load


@query("select o_orderkey, o_orderstatus from orders")
def include_columns(ctx: Context) -> DataFrame:
    source = files.FolderSource(ctx.spark, ctx.sf_dir)
    wanted = loads.TableLoad("orders", included_columns=("o_orderkey", "o_orderstatus"))
    loads.run_loads(source, ctx.store, [wanted])
    return ctx.store.read("raw", "orders")


@query("select event_id, ts, user_id, event_type, value from events")
def table_adapter(ctx: Context) -> DataFrame:
    source = files.FolderSource(ctx.spark, ctx.sf_dir)
    without = coercion.drop_column("events", "props")
    loads.load_selected(source, ctx.store, ["events", "part"], callback=without)
    return ctx.store.read("raw", "events")


@query("select o_orderkey, o_totalprice from orders")
def double_as_double(ctx: Context) -> DataFrame:
    prices = ctx.given("orders").select("o_orderkey", "o_totalprice")
    return coercion.adapt_types(prices, coercion.doubles_as_double)


@query(
    """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey,
        cast(l_extendedprice as decimal(18,4)) as l_extendedprice,
        cast(l_discount as decimal(18,4)) as l_discount
    from lineitem"""
)
def float_as_decimal(ctx: Context) -> DataFrame:
    lines = ctx.given("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount"
    )
    return coercion.adapt_types(lines, coercion.floats_as_decimal(18, 4))


@query(
    """
    select OrderLineID, cast(UnitPrice as varchar) as UnitPrice, cast(TaxRate as varchar) as TaxRate
    from sales__OrderLines"""
)
def decimal_verbatim(ctx: Context) -> DataFrame:
    lines = ctx.raw["sales__OrderLines"].select("OrderLineID", "UnitPrice", "TaxRate")
    return coercion.adapt_types(lines, coercion.decimals_as_text)


# JSON spells a small number with an exponent here and with zeros there.
_DIGITS = "replace(replace(v, '-', ''), '0.000', '')"
_SMALL = f"{_DIGITS}[1] || '.' || case when len({_DIGITS}) > 1 then {_DIGITS}[2:] else '0' end"


@query(
    f"""
    select vec_id, label, '[' || array_to_string(list_transform(embedding, lambda x:
        list_transform([cast(x as varchar)], lambda v:
            case when x = 0 or abs(x) >= 0.001 then v
            when abs(x) >= 0.0001 then
                case when x < 0 then '-' else '' end || {_SMALL} || 'E-4'
            else regexp_replace(regexp_replace(v, '^(-?[0-9])e', '\\1.0e'), 'e-0*', 'E-') end
        )[1]), ',') || ']' as embedding
    from embeddings"""
)
def array_to_json(ctx: Context) -> DataFrame:
    return coercion.adapt_types(ctx.given("embeddings"), coercion.arrays_as_json)


@query(
    """
    select p_partkey, p_name, cast(p_retailprice as decimal(18,2)) as p_retailprice,
        '[' || cast(p_partkey as varchar) || ',' || cast(p_size as varchar) || ']' as codes
    from part"""
)
def type_adapter(ctx: Context) -> DataFrame:
    """Arrays as JSON and floats as decimals, one rule after the other."""
    parts = ctx.given("part").select(
        "p_partkey", "p_name", "p_retailprice", F.array("p_partkey", "p_size").alias("codes")
    )
    rule = coercion.chain(coercion.arrays_as_json, coercion.floats_as_decimal(18, 2))
    return coercion.adapt_types(parts, rule)


# History

TRACKED = ["customer_name", "credit_limit", "payment_term_days"]
FIRST_SEEN = "2024-01-01 00:00:00"
SECOND_SEEN = "2024-02-01 00:00:00"


@query(
    f"""
    select customer_key, customer_name, credit_limit, payment_term_days,
        timestamp '{FIRST_SEEN}' as valid_from,
        case when credit_limit > 5000 then timestamp '{SECOND_SEEN}' end as valid_to,
        not coalesce(credit_limit > 5000, false) as is_current
    from stg_sales_customer where not is_on_credit_hold
    union all
    select customer_key, customer_name, credit_limit,
        cast(case when credit_limit > 5000 then 30 else payment_term_days end as int),
        timestamp '{SECOND_SEEN}', null, true
    from stg_sales_customer where is_on_credit_hold or credit_limit > 5000"""
)
def scd2_merge(ctx: Context) -> DataFrame:
    """Customers in good standing first; then all of them, some on longer terms."""
    customers = ctx.stg["stg_sales_customer"].select(
        "customer_key", *TRACKED, "is_on_credit_hold"
    )
    columns = ["customer_key", *TRACKED]
    first = customers.filter(~F.col("is_on_credit_hold"))
    longer = F.when(F.col("credit_limit") > 5000, 30).otherwise(F.col("payment_term_days"))
    second = customers.withColumn("payment_term_days", longer)
    history = ctx.store.replace(
        merge.scd2_start(first, columns, F.lit(FIRST_SEEN).cast("timestamp")), "dwh", "history"
    )
    at = F.lit(SECOND_SEEN).cast("timestamp")
    return merge.scd2_merge(history, second, ["customer_key"], TRACKED, at)


LATE_AT, SNAPSHOT_AT, GONE_AT = "2024-02-01 00:00:00", "2024-03-01 00:00:00", "2024-04-01 00:00:00"


@query(
    f"""
    select * from (with customer as (
        select customer_key, credit_limit, payment_term_days, is_on_credit_hold as held,
            cast(case when credit_limit > 5000 then 30 else payment_term_days end as int) as longer
        from stg_sales_customer),
    event as (
        select customer_key, timestamp '{FIRST_SEEN}' as moment, credit_limit,
            payment_term_days, true as alive from customer where not held
        union all
        select customer_key, timestamp '{LATE_AT}', cast(credit_limit + 100 as decimal(18,2)),
            payment_term_days, true from customer where customer_key % 3 = 0
        union all
        select customer_key, timestamp '{SNAPSHOT_AT}', credit_limit, longer, true from customer
        where held or longer is distinct from payment_term_days
        union all
        select customer_key, timestamp '{GONE_AT}', null, null, false from customer
        where customer_key % 7 = 0),
    told as (
        select *, row_number() over w as number, lag(credit_limit) over w as old_limit,
            lag(payment_term_days) over w as old_days
        from event window w as (partition by customer_key order by moment)),
    news as (
        select * from told where not alive or number = 1
            or credit_limit is distinct from old_limit or payment_term_days is distinct from old_days),
    spans as (select *, lead(moment) over (partition by customer_key order by moment) as valid_to from news)
    select customer_key, credit_limit, payment_term_days, moment as valid_from, valid_to,
        valid_to is null as is_current
    from spans where alive)"""
)
def scd2_late(ctx: Context) -> DataFrame:
    """A snapshot, customers that a later one lacks, and last a delivery older than both."""
    tracked, keys = ["credit_limit", "payment_term_days"], ["customer_key"]
    customers = ctx.stg["stg_sales_customer"].select(*keys, *tracked, "is_on_credit_hold")

    def at(time: str):
        return F.lit(time).cast("timestamp")

    first = merge.scd2_start(
        customers.filter(~F.col("is_on_credit_hold")), [*keys, *tracked], at(FIRST_SEEN)
    )
    history = ctx.store.replace(first, "dwh", "history_1")
    longer = F.when(F.col("credit_limit") > 5000, 30).otherwise(F.col("payment_term_days"))
    snapshot = customers.withColumns({"payment_term_days": longer, "effective": at(SNAPSHOT_AT)})
    history = merge.scd2_apply(history, snapshot, keys, tracked, "effective")
    history = ctx.store.replace(history, "dwh", "history_2")
    gone = merge.missing_keys(history, customers.filter("customer_key % 7 <> 0"), keys, at(GONE_AT))
    history = merge.scd2_apply(history, gone, keys, tracked, "effective", "deleted")
    history = ctx.store.replace(history, "dwh", "history_3")
    raised = (F.col("credit_limit") + 100).cast("decimal(18,2)")
    late = customers.filter("customer_key % 3 = 0").withColumns(
        {"credit_limit": raised, "effective": at(LATE_AT)}
    )
    return merge.scd2_apply(history, late, keys, tracked, "effective")
