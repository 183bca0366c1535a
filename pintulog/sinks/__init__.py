"""Day-partitioned and report outputs. All writes stay parallel."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pintulog.functions.timestamps import wall_clock
from pintulog.shared import remove
from pintulog.streaming import folders

# Fixed value: how timestamps are written in CSV extracts (date, space, time).
CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# Fixed value: the day of records whose own time cannot be read.
UNKNOWN_DAY = "unknown"

# The headers of written reports, by column; others keep their name.
REPORT_HEADERS = {
    "instansi_pemilik_api": "Instansi Pemilik API",
    "instansi_api_requester": "Instansi API Requester",
    "nama_instansi_pemilik_api": "Nama Instansi Pemilik API",
    "nama_instansi_requester": "Nama Instansi Requester",
    "nama_instansi": "Nama Instansi",
    "second": "Timestamp",
    "hits": "Hits",
    "metric": "Metric",
    "value": "Value",
}
RECAP_HEADERS = REPORT_HEADERS | {"occurrence": "Occurrence"}

# The common CSV dialect: a quote inside a quoted field is doubled.
CSV_DIALECT = {"header": "true", "quote": '"', "escape": '"'}


def write_events(events: DataFrame, path: str, compact: bool = False) -> None:
    """Typed events as Snappy Parquet under ``day=``, replacing only the days written.

    Days come with their input files, so rows already sit together and no shuffle is
    needed: each task sorts and writes what it read. ``compact`` rebalances first,
    for many small inputs; adaptive execution then splits a day that is too large for
    one file and joins small ones, so no day passes through a single task.
    """
    if compact:
        events = events.hint("rebalance", F.col("day"))
    (
        events.sortWithinPartitions("day", F.col("time").asc_nulls_last())
        .write.partitionBy("day")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .parquet(path)
    )


def with_record_day(df: DataFrame) -> DataFrame:
    """Rows with ``day`` taken from their own time, as pulled records need it."""
    return df.withColumn("day", F.to_date(wall_clock("time")))


def slice_path(path: str, piece: str) -> str:
    """The folder of one pull below ``path``: a pull owns its folder and no other."""
    if not piece or "/" in piece:
        raise ValueError(f"not a folder name: {piece!r}")
    return f"{path.rstrip('/')}/slice={piece}"


def write_event_slice(events: DataFrame, path: str, piece: str) -> None:
    """Pulled events as Parquet under ``slice=/day=``; running the pull again replaces its slice."""
    rows = with_record_day(events).sortWithinPartitions("day", F.col("time").asc_nulls_last())
    writer = rows.write.partitionBy("day").mode("overwrite").option("partitionOverwriteMode", "static")
    writer.option("compression", "snappy").parquet(slice_path(path, piece))


def write_record_slice(records: DataFrame, path: str, piece: str) -> None:
    """Raw records as one JSON object per line under ``slice=/day=`` of their time.

    A record whose time cannot be read lies under ``day=unknown``. Where records carry the
    ``line`` they were read from, that is written, with whatever further keys it has.
    """
    day = F.coalesce(F.col("day").cast("string"), F.lit(UNKNOWN_DAY)).alias("day")
    value = F.to_json(F.struct("log", "time", "stream"))
    if "line" in records.columns:
        # line ends can only stand between the parts of an object, where any white space will do
        value = F.coalesce(F.translate("line", "\n\r", "  "), value)
    rows = with_record_day(records).select(day, value.alias("value"))
    writer = rows.write.partitionBy("day").mode("overwrite").option("partitionOverwriteMode", "static")
    writer.text(slice_path(path, piece))


def write_extract(rows: DataFrame, path: str, by: str | None = "file_stem") -> None:
    """An extract as CSV with header, per source day or (``by=None``) undivided."""
    writer = rows.write.mode("overwrite").options(**CSV_DIALECT)
    writer = writer.option("timestampNTZFormat", CSV_TIMESTAMP)
    (writer.partitionBy(by) if by else writer).csv(path)


def write_report(
    report: DataFrame, path: str, order: list[str] | None = None, headers: dict[str, str] | None = None
) -> None:
    """A report table as CSV, globally sorted when ``order`` is given.

    ``headers`` names the columns in the file, such as ``REPORT_HEADERS``.
    """
    if order:
        report = report.orderBy(*order)
    report.withColumnsRenamed(headers or {}).write.mode("overwrite").options(**CSV_DIALECT).csv(path)


def write_version(table: DataFrame, target: str, keep: int = 2) -> int:
    """``table`` as the next version of ``target``, which it may read; the version's number.

    A version counts once it is written to its end, so until then, and if the write dies, readers
    get the one before. The last ``keep`` complete versions stay for those still reading.
    Of two writers at a time one fails. :func:`pintulog.sources.tables.read_version` reads it.
    """
    spark = table.sparkSession
    number = max(map(int, folders.names(spark, target, "version")), default=0) + 1
    table.write.mode("errorifexists").parquet(f"{target}/version={number}")
    complete = folders.numbered(spark, target, "version")
    oldest = complete[-keep:][0]
    remove(spark, *(f"{target}/version={n}" for n in folders.names(spark, target, "version") if int(n) < oldest))
    return number
