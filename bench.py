"""Time the warehouse build and the dashboard queries; prints one JSON line.

The headline is the slowest dashboard query over the published tables: a report
has to answer within five seconds.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from checks.raw_layer import RawLayer  # noqa: E402
from starloom.functions.calendar import dim_date  # noqa: E402
from starloom.operators import metrics, quality  # noqa: E402
from starloom.operators.merge import scd2_merge, scd2_start  # noqa: E402
from starloom.plans.mart import mart_sales_order_line  # noqa: E402
from starloom.plans.warehouse import build_analytics  # noqa: E402
from starloom.sources import files  # noqa: E402
from starloom.sources.incremental import cursor_load  # noqa: E402
from starloom.sources.layers import LayerStore  # noqa: E402
from starloom.sources.workspace import new_workspace  # noqa: E402

REPEATS = 3


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df) -> None:
    """Work out every row and column without writing them anywhere."""
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def load_times(spark: SparkSession, raw: RawLayer, store: LayerStore) -> dict[str, float]:
    """Loads of the order lines: landing, append, merge of a hundredth, cursor load, history."""
    key, lines = "OrderLineID", raw["sales__OrderLines"]
    columns = ["OrderLineID", "OrderID", "StockItemID", "Quantity", "UnitPrice"]
    lines = store.replace(lines.select(*columns), "bench", "source")
    delta = lines.filter(f"{key} % 100 = 0").withColumn("Quantity", F.col("Quantity") + 1)
    last = lines.agg(F.max("OrderID")).first()[0]
    newest = delta.union(lines).filter(F.col("OrderID") > last * 99 // 100)

    def ranged(df):
        return df.withColumn("OrderRange", F.expr(f"OrderID div {last // 50 + 1}"))

    path = f"{store.root}/bench_csv"
    schema = ", ".join(f"{name} {kind}" for name, kind in lines.dtypes)
    later = F.lit("2024-02-02 00:00:00").cast("timestamp")
    history = scd2_start(lines, columns, later, [key])
    actions = {
        "csv_write": lambda: files.write_csv(lines, path),
        "csv_landing": lambda: run(files.read_csv(spark, path, schema)),
        "append": lambda: [store.append(lines, "bench", "appended") for _ in range(2)],
        "merge_start": lambda: store.merge(lines, "bench", "merged", [key]),
        "merge": lambda: store.merge(delta, "bench", "merged", [key]),
        "merge_start_ranges": lambda: store.merge(
            ranged(lines), "bench", "ranges", [key], partition_by=["OrderRange"]
        ),
        "merge_newest_orders": lambda: store.merge(ranged(newest), "bench", "ranges", [key]),
        "cursor_load": lambda: cursor_load(lines, store, "bench", "cursor", key, [key]),
        "history_start": lambda: store.replace(history, "bench", "history"),
        "history": lambda: run(
            scd2_merge(store.read("bench", "history"), delta, [key], columns[1:], later)
        ),
    }
    return {f"load_{name}": timed(action) for name, action in actions.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    store = LayerStore(spark, new_workspace(spark))
    stamp = F.lit("2024-02-01 00:00:00").cast("timestamp")
    times: dict[str, float] = {}
    tables: dict = {}

    run(spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count())
    times["build_calendar"] = timed(lambda: run(dim_date(spark)))
    raw = RawLayer(spark, sf_dir)
    times["build_analytics"] = timed(lambda: tables.update(build_analytics(raw, store, stamp)))
    times["build_mart"] = timed(
        lambda: tables.update(
            mart=store.materialize(mart_sales_order_line(tables), "mart_sales_order_line")
        )
    )

    mart, fact = tables["mart"], tables["fact_sales_order_line"]
    customers, items = tables["dim_customer"], tables["dim_stock_item"]
    dashboards = {
        "revenue_by_line": lambda: metrics.revenue_by_line(mart),
        "quantity_sold_picked": lambda: metrics.quantity_sold_picked(fact, items),
        "fulfillment_cycle": lambda: metrics.fulfillment_cycle(fact),
        "customer_lifetime_value": lambda: metrics.customer_lifetime_value(fact, customers),
        "customer_retention": lambda: metrics.customer_retention(fact),
        "revenue_by_geography": lambda: metrics.revenue_by_geography(fact, customers),
        "sales_by_period": lambda: metrics.sales_by_period(fact, customers, items),
        "late_lines": lambda: metrics.late_lines(fact),
        "customer_orders": lambda: metrics.customer_orders(fact),
        "customers_orders_left": lambda: metrics.customers_orders_left(customers, fact),
    }
    checks = {
        "dq_relationships": lambda: quality.relationships(tables),
        "dq_reconcile": lambda: quality.reconcile(
            fact, mart, ["sales_order_key"], ["quantity", "unit_price"]
        ),
    }
    for name, query in (dashboards | checks).items():
        run(query())
        times[name] = min(timed(lambda: run(query())) for _ in range(REPEATS))
    times |= load_times(spark, raw, store)
    slowest = max(times[name] for name in dashboards)
    print(
        json.dumps(
            {
                "metric": "slowest dashboard query over published tables (target < 5 s)",
                "value": round(slowest, 3),
                "unit": "sec",
                "queries": {name: round(seconds, 3) for name, seconds in times.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
