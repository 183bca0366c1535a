"""Refreshing the API catalog from usage tables."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pintulog.operators import upsert
from pintulog.operators.usage import USAGE_KEYS, accumulate
from pintulog.plans.reports import recap_both_levels
from pintulog.shared import settle
from pintulog.sinks import write_version
from pintulog.sources.tables import read_catalog_version


def catalog_usage(*usages: DataFrame) -> DataFrame:
    """One row per catalog key from usage tables applied in the given order, written to
    shared storage: update and insert both read it, and a log scan may lie behind it.

    Applying tables one after the other equals reducing them together by (step, place):
    the last count stays, and a new row is named by the usage row that brought it.
    """
    steps = [u.withColumn("step", F.lit(i)) for i, u in enumerate(usages)]
    usage = reduce(DataFrame.unionByName, steps)
    return settle(upsert.usage_per_catalog_key(usage, ["step", *USAGE_KEYS]))


def refresh_catalog(catalog: DataFrame, *usages: DataFrame) -> DataFrame:
    """The catalog after upserting every usage table, in the given order."""
    return upsert.catalog_upsert(catalog, catalog_usage(*usages))


def refresh_from_lines(
    catalog: DataFrame, lines: DataFrame, mapping: DataFrame, cleanse: bool
) -> DataFrame:
    """The whole chain over one log scan: recap, accumulate, national then internal."""
    recaps = recap_both_levels(lines, mapping, cleanse)
    return refresh_catalog(catalog, *[accumulate(recap) for recap in recaps])


def write_back(spark: SparkSession, target: str, lines: DataFrame, mapping: DataFrame, cleanse: bool) -> int:
    """Refresh the versioned catalog at ``target`` from ``lines`` and write it back; its new version.

    A refresh that fails leaves the catalog as it was.
    """
    return write_version(refresh_from_lines(read_catalog_version(spark, target), lines, mapping, cleanse), target)
