"""Headline queries, timed end to end at $BENCH_SF_DIR on local[$BENCH_CPUS].

Log lines are derived from the driver tables and landed as day text files once, each line
$BENCH_COPIES times, and converted to typed Parquet, both untimed. Every timing starts at
the landed files and ends when the whole result went to the no-op sink. Each query runs once
before it is timed. Prints one JSON line; ``lines`` is how many log lines each query reads.
"""

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance import fixtures as fx
from pintulog.operators import counters, parsing, usage
from pintulog.plans import catalog, ingest, institutions, reports
from pintulog.session import tune
from pintulog.shared import release, shared_folder
from pintulog.sources import tables
from pintulog.sources.lines import decode_lines, read_lines, stem_date


def queries(spark: SparkSession, sf_dir: str, log: str, events: str) -> dict:
    mapping, api_list, known = (make(spark, sf_dir) for make in (fx.mapping, fx.api_list, fx.catalog))

    def lines() -> DataFrame:
        return read_lines(spark, log)

    return {
        "line_quality": lambda: counters.line_quality(lines()),
        "typed_events": lambda: parsing.typed_events(decode_lines(lines(), require_time=False), "file_stem"),
        "metric_values_long": lambda: parsing.metric_values_long(decode_lines(lines()), "file_stem"),
        "flat_extract": lambda: reports.extract(lines(), "file_stem"),
        "all_dataset": lambda: reports.all_dataset(lines(), "internal", cleanse=True),
        "recap_aggregated": lambda: reports.recap(lines(), mapping, "internal", cleanse=True),
        "recap_national": lambda: reports.recap(lines(), mapping, "national", cleanse=False),
        "recap_daily_pivot": lambda: reports.recap_daily(lines(), mapping, "internal", cleanse=True),
        "hits_per_second": lambda: reports.hits(lines(), "internal", cleanse=False),
        "hits_summary": lambda: reports.hits_summary(lines(), "national", cleanse=False),
        "usage_by_date": lambda: reports.usage_by_date(reports.extract(lines()), mapping),
        "map_institution": lambda: institutions.map_institution(api_list, mapping),
        "accumulate_usage": lambda: usage.accumulate(reports.recap(lines(), mapping, "internal", cleanse=True)),
        "catalog_upsert": lambda: catalog.refresh_from_lines(known, lines(), mapping, cleanse=True),
        "events_by_api": lambda: tables.read_events(spark, events, "2025-06-17", "2025-06-19")
        .groupBy("day", "apiName").agg(F.count(F.lit(1)).alias("calls"), F.avg("backendLatency").alias("latency")),
    }


def timed(make) -> float:
    """Seconds for building and computing; some plans run jobs while they are built."""
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    copies = int(os.environ.get("BENCH_COPIES", "20"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pintulog-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    fx.shared_storage(tune(spark))
    log, events = shared_folder(spark), shared_folder(spark)
    day = stem_date().alias("day")
    repeated = F.explode(F.sequence(F.lit(1), F.lit(copies)))
    fx.lines(spark, sf_dir).repartition(int(cpus)).select(day, "value", repeated).drop("col").write.partitionBy("day").text(log)
    landed = ingest.ingest_typed(spark, log, events)
    seconds = {}
    for name, make in queries(spark, sf_dir, log, events).items():
        timed(make)
        seconds[name] = round(timed(make), 3)
    release(spark)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "gateway_log_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "lines": landed["lines"],
                "lines_per_sec": {n: round(landed["lines"] / s) for n, s in seconds.items() if n != "map_institution"},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
