"""Language identification by Bayesian fusion of several kinds of evidence.

* Text: the likelihood of its byte trigrams under one model per language, and under a
  uniform one for text in none of them.
* The declared language, from markup or a column: P(declared | language).
* The suffix of the address, such as a country's or a path's: P(suffix | language).
* The host: a prior for its languages, smoothed towards that of its domain, which is
  smoothed towards that of the corpus.

The trigram models are fitted on a bounded sample, at most ``per_language`` texts of each
declared language. Everything else is counted over all rows by grouped aggregation, with
the language of the text alone as the observation. The tables of declared language and
suffix are small by construction, languages squared; priors of hosts grow with the hosts
and are joined.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pintulog.llm.batches import bounded_batches, slices
from pintulog.llm.components import lookup
from pintulog.shared import settle

FEATURES = 1 << 14
PER_LANGUAGE = 900  # below 1000 Spark cuts the ranking down before its shuffle
MAX_LANGUAGES = 256
OVERLAP = 3  # a byte is part of three trigrams, which are not independent
HOST_WEIGHT, DOMAIN_WEIGHT, SMOOTH = 20.0, 50.0, 1.0
OTHER = "other"


def trigram_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of all texts, lower-cased, and where each text begins among them."""
    raw = [x.lower().encode() for x in texts]
    data = np.frombuffer(b"\n\n".join([*raw, b"", b""]), np.uint8).astype(np.uint32)
    data[(data >= 9) & (data <= 13)] = 32
    x = data[:-2] | data[1:-1] << np.uint32(8) | data[2:] << np.uint32(16)
    codes = (x * np.uint32(2654435761)) >> np.uint32(18)
    sizes = np.array([len(x) for x in raw], np.int64)
    starts = np.cumsum(np.r_[0, sizes + 2])[:-1]
    inside = np.ones(len(codes) + 2, bool)
    inside[starts + sizes] = inside[starts + sizes + 1] = False
    return codes[inside[: len(codes)]], np.r_[0, np.cumsum(sizes)]


def _count(batches):
    for batch in batches:
        for part in slices(batch, "text"):
            labels = part.column(0).to_pylist()
            codes, starts = trigram_codes([x or "" for x in part.column(1).to_pylist()])
            rows = []
            for label in dict.fromkeys(labels):
                own = np.concatenate([codes[starts[i] : starts[i + 1]] for i, x in enumerate(labels) if x == label])
                counts = np.bincount(own, minlength=FEATURES)
                rows += [(label, int(code), int(counts[code])) for code in np.flatnonzero(counts)]
            names, places, counts = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(places, pa.int32()), pa.array(counts, pa.int64())], ["label", "code", "n"])


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages and log P(trigram | language), the last row that of no language, from (label, text).

    At most ``per_language`` different texts of each label are used, those with the
    smallest hash; the model has languages x ``FEATURES`` numbers at any size of the table.
    Only hashes are ranked, first within ranges of them, so no task gets all of a frequent label,
    and only the texts drawn are shuffled. More than ``MAX_LANGUAGES`` labels are an error.
    """
    bounded_batches(labelled.sparkSession)
    drawn = Window.partitionBy("label").orderBy("hash")
    keyed = labelled.filter("label is not null and text is not null").withColumn("hash", F.xxhash64("text"))
    span = F.shiftright("hash", 58)
    in_span = Window.partitionBy("label", "span").orderBy("hash")
    least = keyed.select("label", "hash", span.alias("span")).distinct().withColumn("n", F.row_number().over(in_span)).filter(F.col("n") <= per_language)
    ranked = least.withColumn("n", F.row_number().over(drawn)).filter(F.col("n") <= per_language)
    limits = ranked.groupBy("label").agg(F.max("hash").alias("most")).limit(MAX_LANGUAGES + 1).collect()
    if len(limits) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    limits = labelled.sparkSession.createDataFrame(limits, "label string, most long")
    below = keyed.join(F.broadcast(limits), "label").filter("hash <= most")
    sample = below.groupBy("label", "hash").agg(F.first("text").alias("text")).select("label", "text")
    counts = sample.mapInArrow(_count, "label string, code int, n long").groupBy("label", "code").agg(F.sum("n").alias("n"))
    names = sorted(row["label"] for row in counts.select("label").distinct().collect())
    table = np.zeros((len(names) + 1, FEATURES))
    place = {name: i for i, name in enumerate(names)}
    for row in counts.toLocalIterator():
        table[place[row["label"]], row["code"]] = row["n"]
    table[-1] = 1
    table[:-1] += 0.5
    return names, np.log(table / table.sum(axis=1, keepdims=True))


def _score(model):
    def run(batches):
        table = model.value
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [x or "" for x in part.column(part.schema.get_field_index("text")).to_pylist()]
                codes, starts = trigram_codes(texts)
                sums = np.zeros((part.num_rows, len(table)))
                filled = np.diff(starts) > 0
                spoken = np.array([any(map(str.isalpha, x)) for x in texts], bool)
                for i, row in enumerate(table):
                    if filled.any():
                        sums[filled, i] = np.add.reduceat(row[codes], starts[:-1][filled])
                lists = pa.ListArray.from_arrays(np.arange(part.num_rows + 1, dtype=np.int32) * len(table), sums.reshape(-1) / OVERLAP)
                at = part.schema.get_field_index("text")
                columns = [c for i, c in enumerate(part.columns) if i != at]
                names = [n for i, n in enumerate(part.schema.names) if i != at]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(filled & spoken), lists], [*names, "has_text", "likelihood"])

    return run


def host_of(address: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(address, F.lit("")), r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))


def domain_of(host: Column) -> Column:
    """The last two labels of a host name."""
    return F.substring_index(host, ".", -2)


def suffix_of(address: Column, languages: list[str]) -> Column:
    """The first path segment if it names a language, else the last label of the host."""
    path = F.lower(F.regexp_extract(F.coalesce(address, F.lit("")), r"^\s*[^:/?#]+://[^/?#]*/([A-Za-z]{2,3})(?:[-_][A-Za-z]+)?(?:[/?#]|$)", 1))
    return F.when(path.isin(languages), path).otherwise(F.nullif(F.substring_index(host_of(address), ".", -1), F.lit("")))


def markup_language(html: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})", 1)), F.lit(""))


def _table(rows: DataFrame, value: str, languages: list[str]) -> dict[str, list[float]]:
    """log P(value | language) for the values that name a language, and for all others together."""
    counts = rows.filter(F.col(value).isNotNull()).groupBy(value, "heard").agg(F.count("*").alias("n")).collect()
    values = [*languages, OTHER]
    table = np.full((len(values), len(languages)), SMOOTH)
    for row in counts:
        table[values.index(row[value]), languages.index(row["heard"])] += row["n"]
    logs = np.log(table / table.sum(axis=0, keepdims=True))
    return {v: logs[i].tolist() for i, v in enumerate(values)}


def _looked_up(value: str, table: dict[str, list[float]], zero: Column) -> Column:
    out = zero
    for name, logs in table.items():
        out = F.when(F.col(value) == name, F.array(*map(F.lit, logs))).otherwise(out)
    return out


def identify(
    df: DataFrame, ident: str, text: str = "text", declared: Column | None = None, address: Column | None = None,
    host: Column | None = None, domain: Column | None = None, model: tuple[list[str], np.ndarray] | None = None, least: float = 0.5,
) -> DataFrame:
    """(ident, language, text_language, confidence, kept) for every row of ``df``.

    ``language`` has the highest posterior, ``confidence``, among those of the model;
    ``text_language`` is that of the text alone. A row is kept if its language reaches
    ``least`` and its text is likelier in that language than in none. A null or empty
    text, one without letters, or one in no language, has language null, confidence 0,
    and is not kept.
    Evidence that a row or table lacks does not count. Without a ``model`` one is fitted on
    texts by their declared language; without any declared language nothing is kept.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    none = F.lit(None).cast("string")
    spoken = F.lower(F.regexp_extract(F.coalesce(declared.cast("string"), F.lit("")), r"^\s*([A-Za-z]{2,3})(?![A-Za-z])", 1)) if declared is not None else F.lit("")
    spoken = F.nullif(spoken, F.lit(""))
    languages, table = model or fit(df.select(spoken.alias("label"), F.col(text).cast("string").alias("text")))
    where = host if host is not None else host_of(address) if address is not None else none
    given = df.select(
        F.col(ident), F.col(text).cast("string").alias("text"),
        F.when(spoken.isin(languages), spoken).when(spoken.isNotNull(), F.lit(OTHER)).alias("declared"),
        (suffix_of(address, languages) if address is not None else none).alias("suffix"),
        F.coalesce(where, F.lit("")).alias("host"),
        F.coalesce(domain if domain is not None else domain_of(where), F.lit("")).alias("domain"),
    ).withColumn("suffix", F.when(F.col("suffix").isin(languages), F.col("suffix")).when(F.col("suffix").isNotNull(), F.lit(OTHER)))
    kind = df.schema[ident].dataType.simpleString()
    shared = spark.sparkContext.broadcast(table)  # languages x FEATURES doubles
    scored = settle(given.mapInArrow(
        _score(shared), f"`{ident}` {kind}, declared string, suffix string, host string, domain string, has_text boolean, likelihood array<double>"
    ))
    count = len(languages)
    names = F.array(*map(F.lit, languages)).cast("array<string>")
    spoken_part = F.slice("likelihood", 1, count)
    best = F.array_max(spoken_part)
    heard = scored.withColumn("heard", F.when(F.col("has_text") & (best > F.element_at("likelihood", -1)), F.get(names, F.array_position(spoken_part, best).cast("int") - 1)))
    if not count:
        return heard.select(ident, none.alias("language"), none.alias("text_language"), F.lit(0.0).alias("confidence"), F.lit(False).alias("kept"))
    sure = heard.filter("heard is not null")
    by_declared, by_suffix = _table(sure, "declared", languages), _table(sure, "suffix", languages)

    # counts per language at three levels, each smoothed by the level above
    per = [F.sum((F.col("heard") == x).cast("long")).cast("double").alias(f"n{i}") for i, x in enumerate(languages)]
    hosts = settle(sure.groupBy("domain", "host").agg(*per))
    total = hosts.agg(*[F.sum(f"n{i}") for i in range(count)]).first()
    total = np.array([x or 0.0 for x in total]) + SMOOTH
    overall = F.array(*map(F.lit, (total / total.sum()).tolist()))
    counted = F.array(*[f"n{i}" for i in range(count)])

    def smoothed(counts: Column, above: Column, weight: float) -> Column:
        size = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(counts, above, lambda n, p: (n + p * weight) / (size + weight))

    domains = hosts.groupBy("domain").agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in range(count)]).select("domain", smoothed(counted, overall, DOMAIN_WEIGHT).alias("above"))
    priors = lookup(hosts, domains, "domain").select(F.struct("domain", "host").alias("place"), smoothed(counted, F.col("above"), HOST_WEIGHT).alias("prior"))
    zero = F.array(*[F.lit(0.0)] * count)
    joined = lookup(heard.withColumn("place", F.struct("domain", "host")), priors, "place", "left")
    evidence = joined.withColumn("log", F.transform(F.coalesce("prior", overall), lambda p: F.log(p)))
    for part in (spoken_part, _looked_up("declared", by_declared, zero), _looked_up("suffix", by_suffix, zero)):
        evidence = evidence.withColumn("log", F.zip_with("log", part, lambda a, b: a + b))
    top = F.array_max("log")
    share = F.aggregate(F.transform("log", lambda x: F.exp(x - top)), F.lit(0.0), lambda a, x: a + x)
    return evidence.select(
        ident,
        F.when(F.col("heard").isNotNull(), F.get(names, F.array_position("log", top).cast("int") - 1)).alias("language"),
        F.col("heard").alias("text_language"),
        F.when(F.col("heard").isNotNull(), 1 / share).otherwise(0.0).alias("confidence"),
    ).withColumn("kept", F.coalesce(F.col("confidence") >= least, F.lit(False)))


def document_languages(df: DataFrame) -> DataFrame:
    """Of documents (doc_id, text, lang, source): ``lang`` is the declared language, ``source`` the host."""
    return identify(df, "doc_id", declared=F.col("lang"), host=F.col("source"), domain=F.lit("documents"))


def page_languages(df: DataFrame) -> DataFrame:
    """Of pages (page_id, url, html): markup language, path or host suffix, host and domain of the address."""
    plain = F.regexp_replace(F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " "), r"(?s)<[^>]*>", " ")
    return identify(df.withColumn("text", plain), "page_id", declared=markup_language(F.col("html")), address=F.col("url"))
