"""Day-partitioned log text: files to lines, lines to records."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pintulog.operators.filters import file_dates
from pintulog.schemas import FRAMED_DDL


def file_stem(name: str | Column) -> Column:
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def stem_date(stem: str | Column = "file_stem") -> Column:
    """The date text of a stem such as ``logs_2025-06-16``: its second ``_`` part."""
    return F.try_element_at(F.split(stem, "_"), F.lit(2))


def day_in_name(name: str | Column) -> Column:
    """Date of a file named ``logs_<date>.txt``; null when the name holds none."""
    text = F.replace(F.replace(name, F.lit("logs_"), F.lit("")), F.lit(".txt"), F.lit(""))
    return F.when(text.rlike(r"\A\d{4}-\d{2}-\d{2}\z"), text.try_cast("date"))


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    first: str | None = None,
    last: str | None = None,
    stream: bool = False,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Lines of the text files below ``path`` with their file stem and file date.

    Files are day files named like ``logs_2025-06-16.txt``, or parts below ``day=``
    folders, which stand for the day file of that name. The date bounds act on file
    metadata or the folder only, so files outside them are not opened. ``stream`` takes
    files in as they arrive, at most ``files_per_batch`` at a time.
    """
    reader = spark.readStream if stream else spark.read
    if stream and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.text(path)
    stem = file_stem(F.col("_metadata.file_name"))
    if "day" in lines.columns:
        stem = F.concat(F.lit("logs_"), F.col("day").cast("string"))
    if first is not None or last is not None:
        lines = file_dates(lines, first, last, stem_date(stem))
    return lines.select("value", stem.alias("file_stem"), stem_date(stem).alias("file_date"))


def read_day_lines(
    spark: SparkSession,
    path: str | list[str],
    first: str | None = None,
    last: str | None = None,
    stream: bool = False,
    undated: bool = False,
) -> DataFrame:
    """As :func:`read_lines` for conversion: ``*.txt`` with a readable date, as ``day``.

    Below ``day=`` folders the folder is the date. ``undated`` also reads those without one,
    such as ``day=unknown``, with a null ``day``.
    """
    reader = spark.readStream if stream else spark.read
    lines = reader.option("pathGlobFilter", "*.txt").text(path)
    if "day" in lines.columns:
        day = F.col("day").cast("string").try_cast("date")
    else:
        undated = False
        day = day_in_name(F.col("_metadata.file_name"))
    wanted = day.isNotNull()
    if first is not None:
        wanted &= day >= F.lit(first).cast("date")
    if last is not None:
        wanted &= day <= F.lit(last).cast("date")
    return lines.where(wanted | day.isNull() if undated else wanted).select("value", day.alias("day"))


def undated_files(spark: SparkSession, path: str) -> DataFrame:
    """Names of ``*.txt`` files that :func:`read_day_lines` leaves out (content not read)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(name.alias("file_name")).where(day_in_name("file_name").isNull())


def record(value: str | Column = "value") -> Column:
    """The line as struct<log,time,stream>; all null when it is not one JSON object.

    ``log`` is null unless it is a JSON string, whatever that string begins with. The line is read as
    the first element of an array that ends in null: white space around it is allowed,
    and a line with anything else after its object gives no array of two.
    """
    value = F.col(value) if isinstance(value, str) else value
    framed = F.concat(F.lit("["), value, F.lit(",null]"))
    parsed = F.from_json(framed, f"array<struct<{FRAMED_DDL}>>", {"allowSingleQuotes": "false"})

    def texts(found: Column) -> Column:
        log = found["log"]
        is_text = F.schema_of_variant(log) == "STRING"
        return F.struct(F.when(is_text, log.cast("string")).alias("log"), found["time"].alias("time"), found["stream"].alias("stream"))

    # the lambda binds the parsed array, which is used more than once
    one = F.transform(F.array(parsed), lambda p: F.when(F.size(p) == 2, texts(F.get(p, F.lit(0)))))
    return F.get(one, F.lit(0))


def decode_lines(lines: DataFrame, require_time: bool = True) -> DataFrame:
    """Records of the readable lines; blank, broken and incomplete lines drop out.

    ``inline`` keeps the parsed record behind a generator. A plain projection would
    let the optimizer push each later filter on ``log`` below it and parse the JSON
    once more per filter.
    """
    others = [c for c in lines.columns if c != "value"]
    records = lines.select(*others, F.inline(F.array(record())))
    kept = F.col("log").isNotNull()
    if require_time:
        kept &= F.col("time").isNotNull()
    return records.where(kept)
