"""Log-store response pages to records."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pintulog.schemas import ENVELOPE_DDL
from pintulog.sources.lines import record


def flatten_pages(pages: DataFrame, body: str = "value") -> DataFrame:
    """One row per entry of each page: store time (ns), labels and the record in it.

    A page or entry that is no JSON object gives no row.
    """
    others = [c for c in pages.columns if c != body]
    page = pages.select(*others, F.inline(F.array(F.from_json(body, ENVELOPE_DDL))))
    series = page.select(*others, F.inline(F.col("data")["result"]).alias("labels", "values"))
    entries = series.select(*others, "labels", F.explode("values").alias("entry"))
    records = entries.select(
        *others,
        "labels",
        F.col("entry")[0].try_cast("bigint").alias("store_time"),
        F.inline(F.array(record(F.col("entry")[1]))),
    )
    return records.where(F.col("log").isNotNull() & F.col("time").isNotNull())
