"""Rule-routed institution mapping of an API list."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pintulog.operators import lookup as lk

# The classes an administrator's API name falls in, tried in this
# order, the institution type each is limited to, and the words its name is rid of.
CLASS_TYPES = {"prov": "Provinsi", "kab": "Kabupaten", "kota": "Kota"}
ADMIN_PROVIDER = "admin"
NOISE = {
    "prov": "satudata|opendata|prov|data|open|-CSW|portal|-|_",
    "kab": "satudata|opendata|kab|data|open|-CSW|portal|-|_",
    "kota": "satudata|opendata|kota|data|open|-CSW|portal|-|_",
    "other": "satudata|opendata|data|open|-CSW|portal|-|_",
}


def routed(api_list: DataFrame) -> DataFrame:
    """The API list with the ``route`` of each row and the text ``key`` it looks up.

    Routes: ``domain`` and ``akun`` look the provider up, the four name classes look
    up the cleaned API name; no route means no provider or no name.
    """
    name = F.lower("api_name")
    name_class = F.lit("other")
    for cls in reversed(CLASS_TYPES):
        name_class = F.when(name.contains(cls), cls).otherwise(name_class)
    provider = F.col("api_provider")
    route = (
        F.when(provider.contains("@"), "domain")
        .when(provider != ADMIN_PROVIDER, "akun")
        .when(provider.isNotNull() & name.isNotNull(), name_class)
    )
    noise = F.lit(None)
    for cls, words in NOISE.items():
        noise = F.when(F.col("route") == cls, f"(?i){words}").otherwise(noise)
    needle = F.regexp_replace(F.regexp_replace(name, F.col("noise"), ""), r"^\s+|\s+$", "")
    by_name = F.col("noise").isNotNull()
    key = F.when(by_name, F.replace(needle, F.lit(" "), F.lit(""))).otherwise(provider)
    # inline() keeps the route computed once; every later use would repeat it otherwise.
    rows = api_list.select("*", F.inline(F.array(F.struct(route.alias("route")))))
    return rows.withColumn("noise", noise).withColumn("key", key).drop("noise")


def _first_texts(mapping: DataFrame, *keys: str) -> DataFrame:
    hit = F.struct("ord", "nama_instansi")
    return mapping.where(F.col("text").isNotNull()).groupBy("text", *keys).agg(F.min(hit).alias("hit"))


def _provider_hits(keys: DataFrame, mapping: DataFrame) -> DataFrame:
    """First domain or account, by route, that occurs in the provider."""
    patterns = mapping.select(
        "ord",
        "nama_instansi",
        F.explode(
            F.create_map(F.lit("domain"), "domain", F.lit("akun"), "akun_nasional")
        ).alias("for_route", "text"),
    )
    patterns = _first_texts(patterns, "for_route")
    cut = lk.pieces(keys, "key", ["route", lk.key_id("key").alias("id")], lk.lengths_of(patterns, "text"))
    on = (cut["piece"] == patterns["text"]) & (cut["route"] == patterns["for_route"])
    return cut.join(patterns, on).select("route", "id", "hit")


def _name_hits(keys: DataFrame, mapping: DataFrame) -> DataFrame:
    """First mapping row of the class's type whose name, account or domain has the key."""
    texts = mapping.select(
        "ord",
        "nama_instansi",
        "tipe_instansi",
        F.explode(
            F.array(
                F.replace(F.lower("nama_instansi"), F.lit(" "), F.lit("")),
                F.lower("akun_nasional"),
                F.lower("domain"),
            )
        ).alias("text"),
    )
    class_of = F.lit("other")
    for cls, kind in CLASS_TYPES.items():
        class_of = F.when(F.col("tipe_instansi") == kind, cls).otherwise(class_of)
    # a row of a typed class also counts where any type does
    classes = F.explode(F.array_distinct(F.array(class_of, F.lit("other")))).alias("route")
    return lk.within(keys, _first_texts(texts.select("*", classes), "route"), ["route"])


def map_institution(api_list: DataFrame, mapping: DataFrame) -> DataFrame:
    """The API list with ``nama_instansi``: null without a provider, else the first
    hit of the row's route, else the unregistered label."""
    rows = routed(api_list)
    keys = rows.select("route", "key").where(F.col("route").isNotNull()).distinct()
    by_provider = F.col("route").isin("domain", "akun")
    hits = (
        _provider_hits(keys.where(by_provider), mapping)
        .unionByName(_name_hits(keys.where(~by_provider), mapping))
        .groupBy(F.col("route").alias("_route"), F.col("id").alias("_id"))
        .agg(F.min("hit").alias("_hit"))
    )
    label = (
        F.when(F.col("api_provider").isNull(), None)
        .when(F.col("_hit").isNull(), lk.UNREGISTERED)
        .otherwise(F.col("_hit")["nama_instansi"])
    )
    return rows.join(
        hits, (rows["route"] == hits["_route"]) & (lk.key_id(rows["key"]) == hits["_id"]), "left"
    ).select(*[rows[c] for c in api_list.columns], label.alias("nama_instansi"))
