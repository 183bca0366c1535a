"""Streaming hit counts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pintulog.functions.timestamps import second_text, wall_clock
from pintulog.plans.reports import scoped_records


def with_event_time(records: DataFrame, delay: str) -> DataFrame:
    """Records with ``event_time``, watermarked: the wall clock as TIMESTAMP, which a
    watermark needs. The session zone is used on the way in and on the way out, so the
    wall clock comes back unchanged; keep the session in UTC, where no hour is skipped.
    """
    timed = records.withColumn("event_time", wall_clock("time").cast("timestamp"))
    return timed.where(F.col("event_time").isNotNull()).withWatermark("event_time", delay)


def stream_hits(lines: DataFrame, level: str, cleanse: bool, delay: str) -> DataFrame:
    """Records per second over a stream of lines, in tumbling one-second windows.

    ``delay`` says how far out of order records may come; a later one is not counted,
    and :func:`pintulog.streaming.runs.run_to_table` then fails the run.
    """
    timed = with_event_time(scoped_records(lines, level, cleanse), delay)
    counts = timed.groupBy(F.window("event_time", "1 second")).agg(F.count(F.lit(1)).alias("hits"))
    return counts.select(second_text(F.col("window")["start"]).alias("second"), "hits")
