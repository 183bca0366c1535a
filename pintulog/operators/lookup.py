"""First-match lookups of account and domain texts in an ordered mapping table.

"Pattern occurs in key" is a theta join, which Spark can only run by comparing every
key with every pattern. Here a key is cut into its distinct substrings of the patterns' lengths
and the join becomes an equality on the substring. "Key occurs in pattern" would need every
substring of a pattern, so patterns are indexed by stretches of three characters instead, and a
key is searched for only in those that hold its rarest one (:func:`within`). Rows carry a digest of
their text, not the text, so a long one is not repeated; either side may be broadcast or
shuffled as its size allows.

Lookups run on the distinct keys of an already aggregated table, never on log rows.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the label of a key no mapping row matches.
UNREGISTERED = "Tidak Terdaftar"

# Characters of a key that are cut into pieces together.
WINDOW = 256

# Characters of the stretches that texts are indexed by.
GRAM = 3


def lengths_of(patterns: DataFrame, column: str) -> Column:
    """The distinct text lengths of a column, as one array for every row of a query."""
    return patterns.agg(F.collect_set(F.length(column))).scalar()


def key_id(text: str | Column) -> Column:
    """A digest that stands for a key in joins, however long the key is."""
    return F.md5(F.col(text) if isinstance(text, str) else text)


def pieces(
    texts: DataFrame, column: str, keep: list[str | Column], lengths: Column
) -> DataFrame:
    """The ``keep`` columns with every substring of ``column`` of the given lengths.

    One that a text holds twice comes twice; who looks for hits takes their smallest anyway, and
    needs no table of all pieces to do so. A text is first cut into windows that overlap by the longest length, so finding a
    piece never walks through the whole of a long text.
    """
    known = texts.where(F.col(column).isNotNull())
    text = F.col(column)
    last = F.floor(F.greatest(F.length(text) - 1, F.lit(0)) / WINDOW).cast("int")
    windows = known.select(*keep, text.alias("_all"), F.explode(F.sequence(F.lit(0), last)).alias("_window"))
    part = F.substring(F.col("_all"), F.col("_window") * WINDOW + 1, F.coalesce(F.array_max(lengths), F.lit(0)) + WINDOW)
    windows = windows.select("*", part.alias("_text")).drop("_all")
    room = F.length("_text") - F.col("_length") + 1
    starts = F.when(F.col("_length") == 0, 1).otherwise(F.least(room, F.lit(WINDOW)))
    fits = (F.col("_length") <= F.length("_text")) & ((F.col("_length") > 0) | (F.col("_window") == 0))
    return (
        windows.select("*", F.explode(lengths).alias("_length"))
        .where(fits)
        .select("*", F.explode(F.sequence(F.lit(1), starts)).alias("_start"))
        .select("*", F.substring(F.col("_text"), F.col("_start"), F.col("_length")).alias("piece"))
        .drop("_length", "_start", "_text", "_window")
    )


def first_rows(mapping: DataFrame, column: str) -> DataFrame:
    """One row per non-null text of a mapping column: ``text`` and its first ``hit``."""
    return (
        mapping.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("text"))
        .agg(F.min(F.struct("ord", "nama_instansi")).alias("hit"))
    )


def dictionary(mapping: DataFrame, column: str) -> DataFrame:
    """As :func:`first_rows`, but a repeated text keeps its first place and last name."""
    return (
        mapping.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("text"))
        .agg(
            F.struct(
                F.min("ord").alias("ord"),
                F.max(F.struct("ord", "nama_instansi"))["nama_instansi"].alias("nama_instansi"),
            ).alias("hit")
        )
    )


def _ranked(stage: int, hit: str = "hit") -> Column:
    return F.struct(
        F.lit(stage).alias("stage"),
        F.col(hit)["ord"].alias("ord"),
        F.col(hit)["nama_instansi"].alias("nama_instansi"),
    ).alias("hit")


def equal_hits(keys: DataFrame, patterns: DataFrame, stage: int = 0) -> DataFrame:
    met = keys.join(patterns, keys["key"] == patterns["text"])
    return met.select(key_id("key").alias("id"), _ranked(stage))


def contained_hits(
    keys: DataFrame, patterns: DataFrame, lengths: Column, stage: int = 0
) -> DataFrame:
    """Patterns that occur in a key, one row per key and pattern text."""
    cut = pieces(keys, "key", [key_id("key").alias("id")], lengths)
    return cut.join(patterns, cut["piece"] == patterns["text"]).select("id", _ranked(stage))


def gram_index(texts: DataFrame, column: str, keep: list[str | Column]) -> DataFrame:
    """Every text by each of its distinct stretches of up to ``GRAM`` characters, the empty one included.

    Rows grow with the length of a text, and carry a digest of it (``text_id``).
    """
    sizes = F.sequence(F.lit(0), F.lit(GRAM))
    return pieces(texts, column, [key_id(column).alias("text_id"), *keep], sizes).distinct()


def within(keys: DataFrame, texts: DataFrame, on: list[str]) -> DataFrame:
    """(on…, id, hit): the first of ``texts`` (text, hit, on…) that each of ``keys`` (key, on…) occurs in.

    A key of up to ``GRAM`` characters is itself in the index, which knows the first text of each
    stretch. A longer one must have all its stretches in the index; only the texts under the
    rarest of them are then searched. A stretch that occurs everywhere is thus met only by
    keys that have nothing rarer. Neither side is compared with the other as a whole.
    """
    index = gram_index(texts, "text", ["hit", *on])
    known = index.groupBy(*on, "piece").agg(F.count(F.lit(1)).alias("texts"), F.min("hit").alias("hit"))
    size = F.least(F.length("key"), F.lit(GRAM))
    starts = F.when(size == 0, F.array(F.lit(1))).otherwise(F.sequence(F.lit(1), F.length("key") - size + 1))
    grams = F.array_distinct(F.transform(starts, lambda at: F.substr(F.col("key"), at, size)))
    asked = keys.where(F.col("key").isNotNull()).select(*on, key_id("key").alias("id"), "key", grams.alias("_grams"))
    asked = asked.select(*on, "id", "key", F.size("_grams").alias("_count"), F.explode("_grams").alias("piece"))
    rarest = (
        asked.join(known, [*on, "piece"])
        .groupBy(*on, "id", "key", "_count")
        .agg(F.count(F.lit(1)).alias("_met"), F.min(F.struct("texts", "piece", "hit")).alias("_rarest"))
        .where(F.col("_met") == F.col("_count"))
        .select(*on, "id", "key", F.col("_rarest.piece").alias("piece"), F.col("_rarest.hit").alias("hit"))
    )
    # one join for short and long keys, so that the keys, which come out of a log scan, are read once
    short = F.length("key") <= GRAM
    candidates = rarest.withColumn("_piece", F.when(~short, F.col("piece"))).drop("piece")
    places = index.select(*[F.col(c).alias(f"_{c}") for c in on], F.col("piece").alias("_at"), "text_id")
    met = candidates.join(
        places, (F.col("_piece") == F.col("_at")) & reduce(lambda x, y: x & y, [F.col(c) == F.col(f"_{c}") for c in on], F.lit(True)), "left"
    ).where(short | F.col("text_id").isNotNull())
    whole = texts.select(key_id("text").alias("text_id"), "text", F.col("hit").alias("_hit"), *[F.col(c).alias(f"_{c}") for c in on])
    found = met.join(whole, ["text_id", *[f"_{c}" for c in on]], "left").where(short | F.contains("text", "key"))
    return found.select(*on, "id", F.when(short, F.col("hit")).otherwise(F.col("_hit")).alias("hit"))


def containing_hits(keys: DataFrame, patterns: DataFrame, stage: int = 0) -> DataFrame:
    """The first pattern a key occurs in, or those among which it is."""
    return within(keys, patterns, []).select("id", _ranked(stage))


def best_hits(*candidates: DataFrame) -> DataFrame:
    """The first candidate of every key, by its digest: lowest stage, then mapping order."""
    return reduce(DataFrame.unionByName, candidates).groupBy("id").agg(F.min("hit").alias("hit"))


def substring_lookup(keys: DataFrame, mapping: DataFrame, column: str) -> DataFrame:
    """First mapping text of ``column``, in dictionary order, that occurs in the key."""
    lengths = lengths_of(mapping, column)
    return best_hits(contained_hits(keys, dictionary(mapping, column), lengths))


def owner_lookup(keys: DataFrame, mapping: DataFrame) -> DataFrame:
    """Equal account, else the first row whose domain occurs in the key."""
    return best_hits(
        equal_hits(keys, first_rows(mapping, "akun_nasional"), 0),
        contained_hits(keys, first_rows(mapping, "domain"), lengths_of(mapping, "domain"), 1),
    )


def requester_lookup(keys: DataFrame, mapping: DataFrame) -> DataFrame:
    """Equal account, else the first row where account and key contain one another."""
    accounts = first_rows(mapping, "akun_nasional")
    return best_hits(
        equal_hits(keys, accounts, 0),
        contained_hits(keys, accounts, lengths_of(mapping, "akun_nasional"), 1),
        containing_hits(keys, accounts, 1),
    )


def keys_of(table: DataFrame, columns: list[str], count: str) -> DataFrame:
    """Distinct non-null texts of an aggregated table's columns, as ``key``.

    The keys go back to the same table in a join. Reading its ``count`` here as well
    keeps this branch's columns and filters the same as the main branch's below the
    aggregation, so Spark sees one shuffle, runs it once and reuses it; otherwise the
    log would be scanned again for the keys.
    """
    counted = [F.when(F.col(count) > 0, F.col(c)) for c in columns]
    keys = table.select(F.explode(F.array(*counted)).alias("key"))
    return keys.where(F.col("key").isNotNull()).distinct()


def attach(
    table: DataFrame, column: str, hits: DataFrame, name: str, default: str | None = UNREGISTERED
) -> DataFrame:
    """``table`` with the looked-up institution of ``column`` as ``name``.

    A key without a hit gets ``default``; a hit whose name is null stays null.
    """
    found = hits.select(F.col("id").alias("_id"), F.col("hit").alias("_hit"))
    label = F.when(F.col("_hit").isNull(), F.lit(default)).otherwise(F.col("_hit")["nama_instansi"])
    return (
        table.join(found, key_id(table[column]) == found["_id"], "left")
        .select(*[table[c] for c in table.columns], label.alias(name))
    )
