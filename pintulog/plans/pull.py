"""Pulling a range from a log store, once or as it fills."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pintulog.sources.lines import decode_lines
from pintulog.sources.range_pull import STEP_HOURS, Fetch, Volume, range_source


def decoded(entries: DataFrame) -> DataFrame:
    """Records of raw store entries, with their ``line``; those that are no complete record drop out."""
    return decode_lines(entries.select("line", F.col("line").alias("value")))


def pull_entries(
    spark: SparkSession,
    fetch: Fetch,
    start: str,
    end: str,
    query: str,
    limit: int = 500,
    step_hours: float = float(STEP_HOURS),
    labels: tuple[str, ...] = (),
    volume: Volume | None = None,
    **options: str,
) -> DataFrame:
    """Raw entries (store_time, line, a column per label) of ``[start, end)`` that match ``query``.

    Filters on them go to the store: bounds on ``store_time``, labels that equal a text, texts
    that ``line`` contains. With ``volume`` the range is fetched in slices of about as many
    entries each, else in equal steps.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(range_source(fetch, volume=volume))
    reader = spark.read.format("log_range").option("start", start).option("end", end)
    reader = reader.option("query", query).option("limit", limit).option("stepHours", step_hours)
    return reader.option("labels", ",".join(labels)).options(**options).load()


def pull_range(
    spark: SparkSession,
    fetch: Fetch,
    start: str,
    end: str,
    query: str,
    limit: int = 500,
    step_hours: float = float(STEP_HOURS),
    volume: Volume | None = None,
    **options: str,
) -> DataFrame:
    """Records of ``[start, end)`` that match ``query``, fetched step by step in parallel."""
    return decoded(pull_entries(spark, fetch, start, end, query, limit, step_hours, volume=volume, **options))


def pull_stream(spark: SparkSession, source: type, start: str, query: str, **options: str) -> DataFrame:
    """Records from ``start`` on as the store fills, as a stream of bounded batches.

    ``source`` comes from :func:`pintulog.sources.range_pull.range_source`. A stream that resumes at
    another place than its checkpoint may repeat records: see
    :func:`pintulog.streaming.runs.land_once`.
    """
    spark.dataSource.register(source)
    reader = spark.readStream.format(source.name()).option("start", start).option("query", query)
    return decoded(reader.options(**options).load())


def catch_up(start: Callable[[], StreamingQuery]) -> list[dict]:
    """Start a stream from its checkpoint, stop it when it has taken in all there is; its progress by batch.

    ``start`` leaves the trigger as it is by default: an ``availableNow`` run of a pull is one batch.
    """
    query = start()
    try:
        query.processAllAvailable()
        return list(query.recentProgress)
    finally:
        query.stop()
