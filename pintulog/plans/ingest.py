"""Landing: text day files, or a pulled range, to typed Parquet."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pintulog.functions.timestamps import wall_clock
from pintulog.operators.counters import counted
from pintulog.operators.parsing import typed_events
from pintulog.sinks import write_event_slice, write_events, write_record_slice
from pintulog.sources.lines import decode_lines, read_day_lines


def typed_day_lines(day_lines: DataFrame) -> DataFrame:
    """Typed events of lines that carry the ``day`` of their file."""
    events = typed_events(decode_lines(day_lines, require_time=False), "day")
    return events.select(*[c for c in events.columns if c != "day"], "day")


def ingest_typed(
    spark: SparkSession,
    source: str,
    target: str,
    first: str | None = None,
    last: str | None = None,
    compact: bool = False,
) -> dict[str, int]:
    """Convert the day files between two dates (both included, None is open).

    Returns how many lines were read and events written, counted along the write, and how many
    lines have no date because they landed under ``day=unknown``; those are left out.
    """
    dated = F.count_if(F.col("day").isNotNull()).alias("rows")
    undated = F.count_if(F.col("day").isNull()).alias("undated")
    lines, read = counted(read_day_lines(spark, source, first, last, undated=True), "lines", dated, undated)
    events, written = counted(typed_day_lines(lines.where(F.col("day").isNotNull())), "events")
    write_events(events, target, compact)
    return {"lines": read.get["rows"], "events": written.get["rows"], "undated": read.get["undated"]}


def land_pulled_events(records: DataFrame, target: str, piece: str) -> dict[str, int]:
    """Pulled records as typed Parquet, each under the day of its own time.

    ``piece`` names the pulled range. Its folder is replaced when the range is pulled
    again; what other pulls landed for the same days stays. Returns counts.
    """
    records, read = counted(records, "records")
    events, written = counted(typed_events(records), "events")
    write_event_slice(events, target, piece)
    return {"records": read.get["rows"], "events": written.get["rows"]}


def land_pulled_records(records: DataFrame, target: str, piece: str) -> dict[str, int]:
    """Pulled records as JSON lines by day; see :func:`land_pulled_events` for ``piece``.

    Records with an unreadable time are kept apart under ``day=unknown`` and counted.
    """
    undated = F.count_if(wall_clock("time").isNull()).alias("undated")
    records, read = counted(records, "records", F.count(F.lit(1)).alias("rows"), undated)
    write_record_slice(records, target, piece)
    return {"records": read.get["rows"], "undated": read.get["undated"]}
