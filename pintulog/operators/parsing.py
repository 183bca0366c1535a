"""Records to typed or named columns, in both dialects."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pintulog.functions import metric_map as mm
from pintulog.functions.regex_fields import ANALYSIS_FIELDS, EXTRACT_FIELDS, field
from pintulog.functions.timestamps import wall_clock
from pintulog.schemas import EVENT_DDL, fields


def analysis_fields(records: DataFrame, *keep: str) -> DataFrame:
    """The analysis row: 13 text fields, after the ``keep`` columns."""
    return records.select(*keep, *[field(name).alias(name) for name in ANALYSIS_FIELDS])


def extract_text_fields(records: DataFrame, *keep: str) -> DataFrame:
    """The 29 fields of the full extract as text under their log names."""
    return records.select(*keep, *[field(name).alias(name) for name in EXTRACT_FIELDS])


def extract_row(records: DataFrame, *keep: str, strict: bool = False) -> DataFrame:
    """The 30-column extract: snake_case names, whole-number latencies, two timestamps.

    A missing latency is 0, one beyond 64 bits and an unreadable timestamp null; ``strict`` fails the job
    on either instead.
    """

    def need(value, what):
        if not strict:
            return value
        return F.when(value.isNull(), F.raise_error(F.lit(f"no readable {what}"))).otherwise(value)

    columns = [need(wall_clock("time"), "log_timestamp").alias("log_timestamp")]
    for source, name in EXTRACT_FIELDS.items():
        value = field(source)
        if name.endswith("latency"):
            number = value.try_cast("bigint")
            absent = F.when(value.isNull(), F.lit(0).cast("bigint"))
            value = need(number, name) if strict else absent.otherwise(number)
        elif name == "request_timestamp":
            value = need(wall_clock(value), name)
        columns.append(value.alias(name))
    return records.select(*keep, *columns)


def with_metrics(records: DataFrame, balanced: bool = False) -> DataFrame:
    """Metric-bearing records with their block as ``metrics``; see :func:`metric_map.metric_text`."""
    return records.where(mm.has_metrics()).select("*", mm.metric_text(balanced=balanced).alias("metrics"))


def typed_events(records: DataFrame, *keep: str, balanced: bool = False) -> DataFrame:
    """Metric-bearing records as the 31-column event, after the ``keep`` columns.

    A record whose own or request time is present but unreadable drops out; unknown
    keys are ignored; ``stream``/``time`` keys inside the block override the record's.
    """
    columns = fields(EVENT_DDL)
    others = with_metrics(records, balanced).select(
        *keep, F.col("stream").alias("_stream"), F.nullif("time", F.lit("")).alias("_time"), "metrics"
    )
    # One pass gives all texts; behind a generator, since a typed column looks at its text more
    # than once, and Spark would repeat the pass for each.
    values = F.inline(F.array(mm.metric_values([c.name for c in columns])))
    texts = others.select(*keep, "_stream", "_time", values)
    requested = F.nullif("requestTimestamp", F.lit(""))
    readable = (F.col("_time").isNull() | wall_clock("_time").isNotNull()) & (
        requested.isNull() | wall_clock(requested).isNotNull()
    )
    typed = []
    for column in columns:
        name, kind = column.name, column.dataType.simpleString()
        value = F.col(name)
        if name in ("stream", "time"):
            value = F.coalesce(value, f"_{name}")
        if kind == "timestamp_ntz":
            value = wall_clock(value)
        elif kind == "int":
            value = mm.as_int(value)
        elif kind == "boolean":
            value = F.lower(value) == "true"
        else:
            value = F.nullif(value, F.lit(""))
        typed.append(value.alias(name))
    return texts.where(readable).select(*keep, *typed)


def metric_maps(records: DataFrame, *keep: str, balanced: bool = False) -> DataFrame:
    """The whole block of each record as map<string,string>, unknown keys included."""
    pairs = with_metrics(records, balanced).select(*keep, mm.metric_pairs().alias("pairs"))
    return pairs.select(*keep, mm.last_wins_map().alias("metrics"))


def metric_values_long(records: DataFrame, *keep: str, balanced: bool = False) -> DataFrame:
    """One row per (record, key): the value's kind and the column of that kind."""
    value = F.col("value")
    kind = F.col("kind")
    return (
        metric_maps(records, *keep, balanced=balanced)
        .select(*keep, F.explode("metrics").alias("key", "value"))
        .select("*", mm.value_kind("value").alias("kind"))
        .select(
            *keep,
            "key",
            "kind",
            F.when(kind == "str", value).alias("str_value"),
            F.when(kind == "int", value.try_cast("bigint")).alias("int_value"),
            F.when(kind == "bool", F.lower(value) == "true").alias("bool_value"),
        )
    )
