"""Aggregations over calls."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pintulog.functions.timestamps import second_text, wall_clock

# What one recap row stands for.
RECAP_KEYS = [
    "apiCreator", "apiName", "applicationOwner", "applicationName", "userIp",
    "apiCreatorTenantDomain",
]
USAGE_KEYS = ["instansi_pemilik_api", "apiCreator", "apiName", "apiCreatorTenantDomain"]
DATE_KEYS = ["log_timestamp", "api_name", "api_creator", "application_owner", "application_name"]


def count_calls(calls: DataFrame, *keys: str) -> DataFrame:
    """Rows per key tuple; null keys form groups of their own."""
    return calls.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrence"))


# Columns a table of days may have; more than three years of days.
MAX_DAY_COLUMNS = 1200


def distinct_texts(table: DataFrame, column: str, most: int = MAX_DAY_COLUMNS) -> list[str]:
    """Sorted distinct values of a column, such as file days, for use as column names.

    More than ``most`` raise an error; none is ever left out.
    """
    rows = table.select(column).distinct().orderBy(column).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} values of {column}: too many for columns")
    return [row[0] for row in rows]


def pivot_days(daily: DataFrame, days: list[str]) -> DataFrame:
    """Daily counts (recap keys + ``file_stem``) to one zero-filled column per day."""
    on_day = [F.when(F.col("file_stem") == day, F.col("occurrence")).otherwise(0) for day in days]
    return daily.groupBy(*RECAP_KEYS).agg(
        F.sum("occurrence").alias("occurrence"),
        *[F.sum(count).alias(day) for count, day in zip(on_day, days)],
    )


def hits_per_second(records: DataFrame) -> DataFrame:
    """Records per wall-clock second; records without a readable time are left out."""
    seconds = records.select(second_text(wall_clock("time")).alias("second"))
    return (
        seconds.where(F.col("second").isNotNull())
        .groupBy("second")
        .agg(F.count(F.lit(1)).alias("hits"))
    )


def hits_summary(hits: DataFrame) -> DataFrame:
    """Peak, its earliest second, number of seconds and mean, as one row."""
    peak = F.min(F.struct((-F.col("hits")).alias("less"), "hits", "second"))
    return hits.agg(
        peak.alias("_peak"),
        F.count(F.lit(1)).alias("total_unique_seconds"),
        F.try_divide(F.sum("hits"), F.count(F.lit(1))).alias("average_hits_per_second"),
    ).select(
        F.coalesce(F.col("_peak")["hits"], F.lit(0).cast("bigint")).alias("maximum_concurrent_hits"),
        F.col("_peak")["second"].alias("timestamp_of_maximum_hits"),
        "total_unique_seconds",
        "average_hits_per_second",
    )


def summary_rows(summary: DataFrame) -> DataFrame:
    """The summary as the two-column (metric, value) report table."""
    # The labels of the report.
    labels = {
        "Maximum Concurrent Hits": "maximum_concurrent_hits",
        "Timestamp of Maximum Hits": "timestamp_of_maximum_hits",
        "Total Unique Seconds": "total_unique_seconds",
        "Average Hits per Second": "average_hits_per_second",
    }
    rows = [
        F.struct(F.lit(label).alias("metric"), F.col(name).cast("string").alias("value"))
        for label, name in labels.items()
    ]
    return summary.select(F.inline(F.array(*rows)))


def accumulate(usage: DataFrame) -> DataFrame:
    """Usage summed per institution, creator, API and tenant; null keys drop out."""
    return (
        usage.dropna(subset=USAGE_KEYS)
        .groupBy(*USAGE_KEYS)
        .agg(F.coalesce(F.sum("occurrence"), F.lit(0)).cast("bigint").alias("occurrence"))
    )
