"""Scan counters."""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pintulog.sources.lines import record


def parsed_lines(lines: DataFrame) -> DataFrame:
    """Every line with its record fields, unreadable lines included with nulls."""
    return lines.select("*", F.inline(F.array(record())))


def line_counters() -> list[Column]:
    """Counters over :func:`parsed_lines`: all, non-blank, one JSON object, complete."""
    log, time = F.col("log"), F.col("time")
    return [
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("value").rlike(r"\S")).alias("non_blank"),
        F.count_if(log.isNotNull()).alias("decoded"),
        F.count_if(log.isNotNull() & time.isNotNull()).alias("complete"),
    ]


def line_quality(lines: DataFrame) -> DataFrame:
    """One row of :func:`line_counters`."""
    return parsed_lines(lines).agg(*line_counters())


def counted(df: DataFrame, name: str, *counters: Column) -> tuple[DataFrame, Observation]:
    """``df`` with counters that fill while a job over it runs, at no extra pass."""
    observation = Observation(name)
    counters = counters or (F.count(F.lit(1)).alias("rows"),)
    return df.observe(observation, *counters), observation
