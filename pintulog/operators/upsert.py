"""Usage counts into the API catalog."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pintulog.operators.filters import NATIONAL_TENANT
from pintulog.operators.usage import USAGE_KEYS

CATALOG_KEYS = ["api_name", "created_by", "domain"]

# How the catalog writes the national tenant, and the status of new rows.
NATIONAL_DOMAIN = "nasional"
NEW_STATUS = "PUBLISHED"


def catalog_domain(tenant: str | Column = "apiCreatorTenantDomain") -> Column:
    tenant = F.col(tenant) if isinstance(tenant, str) else tenant
    return F.when(tenant == NATIONAL_TENANT, NATIONAL_DOMAIN).otherwise(tenant)


def with_occurrence(catalog: DataFrame) -> DataFrame:
    """The catalog, its missing ``occurrence`` column added as null."""
    if "occurrence" in catalog.columns:
        return catalog
    return catalog.withColumn("occurrence", F.lit(None).cast("bigint"))


def usage_per_catalog_key(usage: DataFrame, order: list[str] | None = None) -> DataFrame:
    """One row per catalog key: institution of the first usage row, count of the last.

    ``order`` says which columns give the row order; the default is the key order in
    which accumulated usage is reported.
    """
    order = order or USAGE_KEYS
    place = F.struct(*order)
    return usage.groupBy(
        F.col("apiName").alias("api_name"),
        F.col("apiCreator").alias("created_by"),
        catalog_domain().alias("domain"),
    ).agg(
        F.max(F.struct(place.alias("place"), "occurrence"))["occurrence"].alias("new_occurrence"),
        F.min(F.struct(place.alias("place"), "instansi_pemilik_api"))[
            "instansi_pemilik_api"
        ].alias("nama_instansi"),
    )


def catalog_update(catalog: DataFrame, per_key: DataFrame) -> DataFrame:
    """Every catalog row; those whose key has usage carry its count.

    Usage has one row per key, so a catalog key with very many rows only makes the
    left side uneven, which adaptive execution splits.
    """
    catalog = with_occurrence(catalog)
    new = per_key.select(*CATALOG_KEYS, "new_occurrence", F.lit(True).alias("_used"))
    return catalog.join(new, CATALOG_KEYS, "left").select(
        *[catalog[c] for c in catalog.columns if c != "occurrence"],
        F.when(F.col("_used"), F.col("new_occurrence"))
        .otherwise(catalog["occurrence"])
        .alias("occurrence"),
    )


def catalog_insert(catalog: DataFrame, per_key: DataFrame) -> DataFrame:
    """Catalog rows for usage keys the catalog does not have yet."""
    known = catalog.select(*CATALOG_KEYS).distinct()
    return per_key.join(known, CATALOG_KEYS, "left_anti").select(
        F.col("created_by").alias("api_provider"),
        "created_by",
        "api_name",
        F.lit(None).cast("string").alias("api_version"),
        "domain",
        F.lit(NEW_STATUS).alias("status"),
        "nama_instansi",
        F.col("new_occurrence").alias("occurrence"),
    )


def catalog_upsert(catalog: DataFrame, per_key: DataFrame) -> DataFrame:
    """Update, then append: running it again with the same usage changes nothing."""
    return catalog_update(catalog, per_key).unionByName(
        catalog_insert(catalog, per_key), allowMissingColumns=True
    )
