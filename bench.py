"""Times the headline steps and queries; prints one JSON line.

The steps run on files and tables that are written beforehand and not timed:
load, route, merge into an empty table, merge update, fold of three batches, and
all of it end to end. Each is run once cold and then warm; the value of a step is
the median of its five warm runs. Whole queries, which also make their documents,
are run once warm.
"""

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.layout import Layout, shared_folder
from tributary.operators.merge import fold_scd1, merge_scd1
from tributary.operators.rules import classify
from tributary.plans import silver
from tributary.plans.queries import QUERIES
from tributary.plans.bronze import raw_orders
from tributary.schemas import STG_ORDERS
from tributary.session import configure
from tributary.sources import order_documents as source
from tributary.sources.tables import publish
from tributary.streaming.ingest import refresh_pipe
from tributary.streaming.task import call_step

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
QUERY_RUNS = int(os.environ.get("BENCH_QUERY_RUNS", "1"))
SINGLE_QUERIES = ("silver_reason_counts", "silver_orders", "merge_update", "merge_fold")


def run(rows: DataFrame) -> None:
    rows.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = configure(
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    base = shared_folder(spark)
    stage = f"{base}/stage"
    publish(source.order_facts(spark, SF_DIR), base, "facts")
    facts = spark.read.parquet(f"{base}/facts")
    source.write_files(source.order_documents(facts), stage, array=False)

    loaded = Layout(f"{base}/loaded")
    refresh_pipe(spark, loaded, stage)
    raw = raw_orders(spark, loaded)
    documents = raw.count()
    for revision in (1, 2, 3):
        rows = source.in_batch(source.raw_orders(facts, revision), revision).drop("o_orderkey")
        accepted = silver.accepted_orders(silver.routed_rows(rows))
        accepted.write.parquet(f"{base}/batches/batch_id={revision}")

    def batch(number: int) -> DataFrame:
        return spark.read.schema(STG_ORDERS).parquet(f"{base}/batches/batch_id={number}")

    def load() -> Layout:
        layout = Layout(shared_folder(spark))
        refresh_pipe(spark, layout, stage)
        return layout

    def end_to_end() -> None:
        layout = load()
        call_step(spark, layout)
        run(silver.stg_orders(spark, layout))

    steps = {
        "bronze_load": load,
        "routing": lambda: run(silver.routed_rows(raw)),
        "route_counts": lambda: run(classify(raw).groupBy("route").agg(F.count("*").alias("n"))),
        "merge_into_empty": lambda: run(merge_scd1(spark.createDataFrame([], STG_ORDERS), batch(1))),
        "merge_update_stored": lambda: run(merge_scd1(batch(1), batch(2))),
        "fold_three_batches": lambda: run(
            fold_scd1(spark.read.parquet(f"{base}/batches"))
        ),
        "end_to_end": end_to_end,
    }
    steps.update({
        f"query_{name}": lambda name=name: run(QUERIES[name](spark, SF_DIR)) for name in SINGLE_QUERIES
    })
    cold, warm, runs = {}, {}, {}
    for name, step in steps.items():
        times = []
        for _ in range((QUERY_RUNS if name.startswith("query_") else RUNS) + 1):
            start = time.perf_counter()
            step()
            times.append(time.perf_counter() - start)
        cold[name], warm[name] = round(times[0], 3), round(statistics.median(times[1:]), 3)
        runs[name] = len(times) - 1
        print(f"{name}: cold {cold[name]} warm {warm[name]}", file=sys.stderr)
    spark.stop()
    print(json.dumps({
        "metric": "sum of warm medians",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "warm_runs": runs,
        "documents": documents,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
