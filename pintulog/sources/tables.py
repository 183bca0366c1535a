"""Landed tables: typed events, extracts and reference data, with declared columns."""

import csv
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pintulog.operators.usage import DATE_KEYS
from pintulog.schemas import (
    API_LIST_DDL,
    CATALOG_DDL,
    EVENT_DDL,
    EXTRACT_DDL,
    MAPPING_DDL,
    USAGE_DDL,
    fields,
)
from pintulog.sinks import CSV_DIALECT
from pintulog.streaming import folders


def read_events(
    spark: SparkSession, path: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Typed events of day files or of pulled slices; day bounds prune partitions."""
    events = spark.read.schema(f"{EVENT_DDL}, day date").parquet(path).drop("slice")
    if first is not None:
        events = events.where(F.col("day") >= F.lit(first).cast("date"))
    if last is not None:
        events = events.where(F.col("day") <= F.lit(last).cast("date"))
    return events


def _named(rows: DataFrame, ddl: str, others: bool, optional: tuple[str, ...] = ()) -> DataFrame:
    """The declared columns of ``rows``, by name and typed, and with ``others`` the rest after them."""
    declared = fields(ddl)
    missing = [f.name for f in declared if f.name not in rows.columns and f.name not in optional]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {rows.columns}")
    typed = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in declared if f.name in rows.columns]
    rest = [f"`{c}`" for c in rows.columns if c not in {f.name for f in declared}]
    return rows.select(*typed, *(rest if others else []))


def _csv(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    """All columns of CSV files as text, under the names in their header.

    The names come from one file. A file whose header says otherwise fails the read
    instead of giving its columns other names.
    """
    dialect = CSV_DIALECT | {"multiLine": str(multiline).lower()}
    header = spark.read.options(**dialect).csv(path)
    folders = _folders(header)
    text = ", ".join(f"`{c}` string" for c in header.columns if c not in folders)
    return spark.read.schema(text).options(**dialect, enforceSchema="false").csv(path)


def _folders(rows: DataFrame) -> set[str]:
    """Names of the partition folders that the files of ``rows`` lie in."""
    files = rows.inputFiles()
    return {part.partition("=")[0] for part in files[0].split("/")[:-1] if "=" in part} if files else set()


def read_extract(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Extract CSV files: their columns by name, whatever their order; further columns are left out.

    Columns are text or whole numbers; an unreadable number is null.
    """
    return _named(_csv(spark, path), EXTRACT_DDL, others=False)


def read_extract_keys(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The five columns usage by date needs; the CSV parser skips the others.

    Files may hold only these.
    """
    return _named(_csv(spark, path), ", ".join(f"{c} string" for c in DATE_KEYS), others=False)


def read_extract_keys_of(
    spark: SparkSession, paths: list[str], skip_bad: bool = False
) -> tuple[DataFrame, dict[str, str]]:
    """The key columns of several extracts, and why some were left out, by path.

    The first lines of all files come from one job, and files with equal headers are read
    together, whatever their number. An extract that lacks a column fails the whole unless
    ``skip_bad``; then it is named in the second result, file by file, and the others are
    read. An extract is a CSV file or a folder of them; a path that is not there is bad too.
    """
    here = [path for path in paths if exists(spark, path)]
    bad = {path: "there is no such file" for path in paths if path not in here}
    if bad and not skip_bad:
        raise ValueError(f"cannot read {bad}")
    by_header: dict[tuple[str, ...], list[str]] = {}
    for uri, header in (first_lines(spark, here) if here else {}).items():
        columns = header_columns(header)
        file = unquote(uri)
        plain = re.sub(r"\A[a-z0-9]+:/+", "/", file)
        file = plain if plain in here else file
        missing = [c for c in DATE_KEYS if c not in columns]
        if missing and not skip_bad:
            raise ValueError(f"missing columns {missing}; there are {list(columns)} in {file}")
        if missing:
            bad[file] = f"missing columns {missing}; there are {list(columns)}"
        else:
            by_header.setdefault(columns, []).append(file)
    if not by_header:
        raise ValueError(f"no extract can be read: {bad}")
    good = []
    for columns, files in by_header.items():
        schema = ", ".join(f"`{c}` string" for c in columns)
        good.append(spark.read.schema(schema).options(**CSV_DIALECT, enforceSchema="false").csv(files).select(*DATE_KEYS))
    return reduce(DataFrame.unionByName, good), bad


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(store.globStatus(where))


def first_lines(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The first line of each text file below ``paths``, found by the executors in one job.

    Lines of a file's first block come to one task in their order, so the least number is the first.
    """
    lines = spark.read.text(paths).select("value", "_metadata.file_path", "_metadata.file_block_start")
    numbered = lines.where("file_block_start = 0").withColumn("number", F.monotonically_increasing_id())
    first = numbered.groupBy("file_path").agg(F.min_by("value", "number").alias("value"))
    return {r.file_path: r.value for r in first.collect()}  # a line per file, as many as were named


def header_columns(line: str) -> tuple[str, ...]:
    """The names in a header line; one that occurs again gets its place, so every column has its own."""
    names = next(csv.reader([line]), [])
    return tuple(name if name not in names[:i] else f"{name}_{i}" for i, name in enumerate(names))


def _reference(spark: SparkSession, path: str, ddl: str, optional: tuple[str, ...] = ()) -> DataFrame:
    """A reference table by column name, further columns passed through after the declared ones."""
    is_csv = path.rstrip("/").endswith(".csv")
    rows = _csv(spark, path, multiline=True) if is_csv else spark.read.parquet(path)
    return _named(rows, ddl, others=True, optional=optional)


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Institution mapping; ``ord`` is the row order that decides between matches."""
    return _reference(spark, path, MAPPING_DDL)


def read_api_list(spark: SparkSession, path: str) -> DataFrame:
    return _reference(spark, path, API_LIST_DDL)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The API catalog; its counts are missing before the first refresh."""
    return _reference(spark, path, CATALOG_DDL, optional=("occurrence",))


def version_path(spark: SparkSession, target: str) -> str:
    """The newest complete version that :func:`pintulog.sinks.write_version` wrote."""
    complete = folders.numbered(spark, target, "version")
    if not complete:
        raise ValueError(f"no complete version in {target}")
    return f"{target}/version={complete[-1]}"


def read_catalog_version(spark: SparkSession, target: str) -> DataFrame:
    return read_catalog(spark, version_path(spark, target))


def read_usage(spark: SparkSession, path: str) -> DataFrame:
    return _reference(spark, path, USAGE_DDL)
