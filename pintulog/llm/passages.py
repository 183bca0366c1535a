"""Repeated passages across documents: paragraph MinHash banding and winnowed stretches.

Two kinds of passage are compared:

* Paragraphs of at least ``MIN_WORDS`` words, for near copies: a line of so many words, or a run
  of neighbouring shorter lines without a blank one between, as in hard-wrapped text. MinHash bands of ``LINE_ROWS``
  minima, tuned for recall (``LINE_BANDS`` of them miss a pair right at 0.75 with
  probability (1 - 0.75^3)^12 = 0.14 %), bring colliding paragraphs together, the exact Jaccard
  similarity of their five-word shingles confirms them, and components cluster them.
* Windows of ``MIN_WORDS`` words, for equal passages inside other text; all of them that a
  smaller document has too are found. Winnowing spares a row for each: a window is filed
  under the least hash of its ``GRAM``-word shingles, the last one on ties, so equal windows
  are filed alike wherever they stand. Neighbouring windows under one shingle are one row.
  Where a shingle has several documents, rows equal over all their words are decided
  together, and those that differ window by window.

Words are hashed and windows filed for all texts of a slice at once; windows that reach over the
end of a text do not count. Of each cluster or window the document with the smallest id keeps its passage; elsewhere it
is to be removed. What repeats only within one document stays.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pintulog.llm.batches import bounded_batches, slices
from pintulog.llm.components import lookup
from pintulog.llm.minhash import _lists, bands, connected, minima, packed
from pintulog.llm.words import mixed, shingles
from pintulog.shared import drop_settled, free_shuffles, settle

MIN_WORDS = 25
GRAM = 8
LINE_ROWS, LINE_BANDS = 3, 12
SLICE = 1 << 19  # bytes of text at once
HASHED = 1 << 15  # and of those hashed at once, whose numbers fit a processor's cache

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


LONG_WORD = 256  # bytes; longer words are hashed one by one
_rng = np.random.default_rng(13)
# A random number for each byte, none for white space and the same for A as for a; and one for each place.
_LETTERS = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_LETTERS[65:91] = _LETTERS[97:123]
_LETTERS[_IS_SPACE] = 0
_AT = _rng.integers(0, 1 << 63, LONG_WORD, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def word_spans(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets where each word begins and ends."""
    gap = np.r_[True, _IS_SPACE[np.frombuffer(raw, np.uint8)], True]
    return np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])


def span_hashes(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, A-Z lower-cased, ``HASHED`` bytes at once."""
    data, sizes = np.frombuffer(raw, np.uint8), ends - starts
    out = np.empty(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        high = int(np.searchsorted(starts, starts[low] + HASHED))
        first, stop = starts[low], ends[high - 1]
        begin = starts[low:high] - first
        place = np.arange(stop - first) - np.repeat(begin, np.diff(np.r_[begin, stop - first]))
        terms = _LETTERS[data[first:stop]] * _AT[np.minimum(place, LONG_WORD - 1)]
        out[low:high] = mixed(np.add.reduceat(terms, begin) + sizes[low:high].astype(np.uint64))
        low = high
    for i in np.flatnonzero(sizes > LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(raw[starts[i] : ends[i]].lower())
    return out


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(count: int) -> list[np.ndarray]:
    """``count`` powers of the base and of its inverse, remembered unless they are very many."""
    if len(_powers[0]) >= count:
        return _powers
    made = [np.cumprod(np.r_[np.uint64(1), np.full(count - 1, x)], dtype=np.uint64) for x in (_BASE, _BACK)]
    if count <= SLICE:
        _powers[:] = made
    return made


def stretch_hashes(hashes: np.ndarray, first: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Hash of the words from ``first`` to before ``after``, the same wherever they stand."""
    up, back = powers(len(hashes) + 1)
    total = np.r_[np.uint64(0), np.cumsum(hashes * up[: len(hashes)], dtype=np.uint64)]
    return mixed((total[after] - total[first]) * back[first] + (after - first).astype(np.uint64))


def winnowed(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first word, word after the last, shingle, hash) of neighbouring windows filed under one shingle.

    ``text`` numbers the text of each word. Each window of ``MIN_WORDS`` words of one text
    is in one of these stretches, under its least shingle.
    """
    if len(hashes) < MIN_WORDS:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    grams = shingles(hashes, GRAM)
    least, at, width, count = grams, np.arange(len(grams)), 1, MIN_WORDS - GRAM + 1
    while width < count:
        step = min(width, count - width)
        right = least[step:] <= least[:-step]
        least, at = np.where(right, least[step:], least[:-step]), np.where(right, at[step:], at[:-step])
        width += step
    inside = text[: len(at)] == text[MIN_WORDS - 1 :]
    first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (inside[1:] != inside[:-1])])
    after = np.r_[first[1:], len(at)] - 1 + MIN_WORDS
    first, after = first[inside[first]], after[inside[first]]
    return first, after, grams[at[first]], stretch_hashes(hashes, first, after)


def paragraphs(raw: bytes, starts: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words, and words after the last, of lines; shorter ones are joined up to a blank line."""
    line = np.searchsorted(np.flatnonzero(np.frombuffer(raw, np.uint8) == 10), starts)
    cuts = np.flatnonzero(np.diff(line)) + 1
    first, after = np.r_[0, cuts], np.r_[cuts, len(starts)]
    short = after - first < MIN_WORDS
    joined = short[1:] & short[:-1] & (np.diff(line[first]) == 1) & (np.diff(text[first]) == 0)
    heads = np.flatnonzero(np.r_[True, ~joined])
    return first[heads], after[np.r_[heads[1:], len(first)] - 1]


class Words:
    """The words of several texts in a row: hashes, places in bytes, and what text each is of."""

    def __init__(self, texts: list[str | None], hashed: bool = True):
        parts = [(x or "").encode() for x in texts]
        self.raw = b"\n".join(parts)
        self.starts, self.ends = word_spans(self.raw)
        self.begin = np.cumsum([0, *(len(x) + 1 for x in parts)])  # of each text, in bytes
        self.offset = np.searchsorted(self.starts, self.begin)  # and in words
        self.counts = np.diff(self.offset)
        self.text = np.repeat(np.arange(len(parts)), self.counts)
        self.hashes = span_hashes(self.raw, self.starts, self.ends) if hashed else None


SPANS = ["doc_id", "start", "length", "n_words", "kept_doc_id", "text_hash"]
STRETCHES_SQL = "doc_id long, first int, after int, hash long, context long"
LINES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("first", pa.int32()), ("after", pa.int32()),
    ("key", pa.binary()), ("bands", pa.list_(pa.int64())), ("sig", pa.list_(pa.int64())),
])
LINES_SQL = "doc_id long, start long, end long, first int, after int, key binary, bands array<long>, sig array<long>"


def _stretches(batches):
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            doc, w = part.column(0).to_numpy(), Words(part.column(1).to_pylist())
            if not len(w.hashes):
                continue
            first, after, value, context = winnowed(w.hashes, w.text)
            of = w.text[first]
            yield pa.RecordBatch.from_arrays([
                pa.array(doc[of]), pa.array((first - w.offset[of]).astype(np.int32)), pa.array((after - w.offset[of]).astype(np.int32)),
                pa.array(value.view(np.int64)), pa.array(context.view(np.int64)),
            ], ["doc_id", "first", "after", "hash", "context"])


def _lines(batches):
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            doc, w = part.column(0).to_numpy(), Words(part.column(1).to_pylist())
            if not len(w.hashes):
                continue
            first, after = paragraphs(w.raw, w.starts, w.text)
            long = after - first >= MIN_WORDS
            first, after = first[long], after[long]
            if not len(first):
                continue
            of, n, grams = w.text[first], len(first), shingles(w.hashes)
            found = minima([grams[a : b - 4] for a, b in zip(first.tolist(), after.tolist(), strict=True)])
            keys = np.stack([stretch_hashes(w.hashes, first, after), stretch_hashes(mixed(w.hashes + _BASE), first, after)], axis=1).tobytes()
            keys = [keys[i : i + 16] for i in range(0, 16 * n, 16)]  # 128 bits that stand for the words
            yield pa.RecordBatch.from_arrays([
                pa.array(doc[of]), pa.array(w.starts[first] - w.begin[of]), pa.array(w.ends[after - 1] - w.begin[of]),
                pa.array((first - w.offset[of]).astype(np.int32)), pa.array((after - w.offset[of]).astype(np.int32)),
                pa.array(keys, pa.binary()), _lists(bands(found, LINE_ROWS, LINE_BANDS)), _lists(packed(found)),
            ], schema=LINES)


def _line_sets(batches):
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            w, wanted = Words(part.column(0).to_pylist()), part.column(1)
            begin = np.repeat(w.begin[:-1], pc.list_value_length(wanted).to_numpy(zero_copy_only=False))
            fields = wanted.flatten()
            first, after = (np.searchsorted(w.starts, begin + fields.field(x).to_numpy(zero_copy_only=False)) for x in ("start", "end"))
            grams = shingles(w.hashes)
            items = [np.unique(grams[a : b - 4]).tobytes() for a, b in zip(first.tolist(), after.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([fields.field("node"), pa.array(items, pa.binary())], ["node", "items"])


def _flat(asked: pa.ListArray, w: Words, *names: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """The text each asked stretch is of, and its fields; those beyond their text's end are left out."""
    of = np.repeat(np.arange(len(asked)), pc.list_value_length(asked).to_numpy(zero_copy_only=False))
    fields = asked.flatten()
    columns = [fields.field(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in names]
    within = fields.field("after").to_numpy(zero_copy_only=False) <= w.counts[of]
    return of[within], [c[within] for c in columns]


def _windows(batches):
    """(document, context, place in it, hash) of each window of the asked stretches."""
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            doc, w = part.column(0).to_numpy(), Words(part.column(1).to_pylist())
            of, (first, after, context) = _flat(part.column(2), w, "first", "after", "context")
            first, after = first + w.offset[of], after + w.offset[of]
            count = after - first - MIN_WORDS + 1
            at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            start = np.repeat(first, count) + at
            found = [np.repeat(doc[of], count), np.repeat(context, count), at.astype(np.int32), stretch_hashes(w.hashes, start, start + MIN_WORDS).view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["doc_id", "context", "at", "hash"])


def _places(batches):
    """Stretches given in words, in bytes."""
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            doc, w = part.column(0).to_numpy(), Words(part.column(1).to_pylist(), hashed=False)
            of, (first, after, owner) = _flat(part.column(2), w, "first", "after", "owner")
            start, end = w.starts[first + w.offset[of]], w.ends[after + w.offset[of] - 1]
            digest = part.column(3).to_numpy()[of]
            columns = [doc[of], start - w.begin[of], end - start, after - first, owner, digest]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], SPANS)


def _asked(docs: DataFrame, stretches: DataFrame, *columns: str) -> DataFrame:
    """(doc_id, text, asked) of the documents that have such stretches."""
    asked = stretches.groupBy("doc_id").agg(F.collect_list(F.struct(*columns)).alias("asked"))
    return docs.join(asked, "doc_id").select("doc_id", "text", "asked", F.xxhash64("text").alias("text_hash"))


def _repeated(every: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, first, after, owner) of the words of windows that a smaller document has, from settled winnowed stretches."""
    plain = every.filter("not differ and doc_id > owner").select("doc_id", "first", "after", "owner")
    # Stretches of one context have the same windows: those of its smallest document stand for all.
    heads = settle(every.filter("differ").groupBy("context").agg(F.min(F.struct("doc_id", "first", "after")).alias("at")).select("context", "at.*"))
    windows = settle(_asked(docs, heads, "context", "first", "after").mapInArrow(_windows, "doc_id long, context long, at int, hash long"))
    free_shuffles(docs.sparkSession)
    again = lookup(windows, _owners(windows, "hash"), "hash").filter("doc_id > owner")
    again = again.groupBy("context").agg(F.min("at").alias("low"), F.max("at").alias("high"), F.min("owner").alias("before"))
    known = settle(lookup(heads.select("context", F.col("doc_id").alias("head")), again, "context", "left"))
    found = lookup(every.filter("differ").select("doc_id", "first", "after", "context"), known, "context").filter("doc_id > head or before is not null")
    own = F.col("doc_id") == F.col("head")
    # Windows of one stretch overlap, so those that repeat cover one run of words.
    differing = found.select(
        "doc_id", F.when(own, F.col("first") + F.col("low")).otherwise(F.col("first")).alias("first"),
        F.when(own, F.col("first") + F.col("high") + MIN_WORDS).otherwise(F.col("after")).alias("after"), F.coalesce("before", "head").alias("owner"),
    )
    runs = settle(plain.unionByName(differing))
    drop_settled(heads, windows, known)
    free_shuffles(docs.sparkSession)
    return runs


def _owners(rows: DataFrame, by: str) -> DataFrame:
    """The document that keeps the passage of each value of ``by`` that several documents have."""
    ends = rows.groupBy(by).agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
    return ends.filter("owner < last").select(by, "owner")


def _one_text(docs: DataFrame) -> DataFrame:
    """``docs`` without the texts of an id beyond the one of the smallest hash; repeated rows stay."""
    digest = F.when(F.col("text").isNotNull(), F.xxhash64("text"))
    ends = docs.groupBy("doc_id").agg(F.min(digest).alias("one"), F.max(digest).alias("last"))
    several = settle(ends.filter("one < last").select("doc_id", "one"))
    if several.isEmpty():
        return docs
    return lookup(docs, several, "doc_id", "left").filter(F.col("one").isNull() | (F.col("one") == digest)).select("doc_id", "text")


def repeats(df: DataFrame, threshold: float = 0.75) -> DataFrame:
    """(doc_id, start, length, n_words, kept_doc_id, text_hash) of each stretch of (doc_id, text) to remove.

    Offsets and lengths are in bytes of the UTF-8 text; stretches of one document do not
    overlap. ``kept_doc_id`` is the smallest id among the documents that keep parts of it. Texts
    that are null, empty or short have none, nor do rows without an id. Repeated rows
    count as one document; of several texts under one id the one of the smallest hash counts,
    and ``text_hash`` tells which it is. Other columns are ignored.
    """
    bounded_batches(df.sparkSession)
    docs = _one_text(df.filter("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")))
    # Windows first, to the end, then paragraphs: the tables of the two are never on disk together.
    cut = settle(docs.mapInArrow(_stretches, STRETCHES_SQL))
    ends = cut.groupBy("hash").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"), (F.min("context") < F.max("context")).alias("differ"))
    shared = settle(ends.filter("owner < last").drop("last"))
    del ends
    free_shuffles(df.sparkSession)  # before the next large shuffle
    every = settle(cut.join(shared, "hash"))
    drop_settled(cut, shared)
    del cut, shared
    free_shuffles(df.sparkSession)
    runs = _repeated(every, docs)
    drop_settled(every)
    free_shuffles(df.sparkSession)

    signed = settle(docs.mapInArrow(_lines, LINES_SQL))
    place = F.struct("doc_id", "start", "end")
    classes = settle(signed.groupBy(F.col("key").alias("node")).agg(F.min(place).alias("at"), F.first("bands").alias("bands"), F.first("sig").alias("sig")))
    lines = settle(signed.select("doc_id", "first", "after", F.col("key").alias("node")))
    drop_settled(signed)
    free_shuffles(df.sparkSession)

    def fetch(ids: DataFrame) -> DataFrame:
        wanted = classes.join(ids, "node", "left_semi").select("at.*", "node").groupBy("doc_id").agg(F.collect_list(F.struct("node", "start", "end")).alias("wanted"))
        texts = docs.join(wanted, "doc_id").select("text", "wanted").mapInArrow(_line_sets, "node binary, items binary")
        return texts.groupBy("node").agg(F.max("items").alias("items"))

    clusters = connected(classes.select("node", "bands", "sig"), fetch, threshold)
    drop_settled(classes)
    named = lookup(lines, clusters, "node", "left")
    named = named.select("doc_id", "first", "after", F.coalesce("component", "node").alias("cluster"))
    near = lookup(named, _owners(named, "cluster"), "cluster").filter("doc_id > owner")

    spans = runs.unionByName(near.select("doc_id", "first", "after", "owner")).distinct()
    upto = Window.partitionBy("doc_id").orderBy("first", "after").rowsBetween(Window.unboundedPreceding, -1)
    order = Window.partitionBy("doc_id").orderBy("first", "after").rowsBetween(Window.unboundedPreceding, 0)
    stretches = (
        spans.withColumn("fresh", (F.coalesce(F.max("after").over(upto), F.lit(-1)) < F.col("first")).cast("int"))
        .withColumn("stretch", F.sum("fresh").over(order))
        .groupBy("doc_id", "stretch")
        .agg(F.min("first").alias("first"), F.max("after").alias("after"), F.min("owner").alias("owner"))
    )
    found = _asked(docs, stretches, "first", "after", "owner").mapInArrow(_places, ", ".join(f"{c} long" for c in SPANS))
    found = settle(found.groupBy("doc_id", "start").agg(F.max(F.struct(*SPANS[2:])).alias("x")).select("doc_id", "start", "x.*"))
    drop_settled(runs, lines)
    free_shuffles(df.sparkSession)
    return found


def without(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``raw`` without these stretches, and without lines and space that only they filled."""
    parts, at = [], 0
    for start, length in sorted(spans):
        if start >= at:
            parts.append(raw[at:start])
        at = max(at, start + length)
    parts.append(raw[at:])
    kept = parts[0]
    for part in parts[1:]:
        left, right = kept.rstrip(b" "), part.lstrip(b" ")
        if (not left or left.endswith(b"\n")) and right.startswith(b"\n"):
            right = right[1:]
        between = b" " if left and right and not left.endswith(b"\n") and not right.startswith(b"\n") else b""
        kept = left + between + right
    return kept.rstrip(b"\n") if not parts[-1].strip() else kept


def remove(df: DataFrame, spans: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with these stretches cut from the texts they were found in; rows and all other columns stay as they are."""
    bounded_batches(df.sparkSession)
    cuts = spans.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "length")).alias("__cuts"))
    cuts = cuts.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__text"), "__cuts")
    at = df.columns.index(text)
    own = (df["doc_id"].cast("long") == cuts["__id"]) & (F.xxhash64(df[text].cast("string")) == cuts["__text"])
    joined = df.join(cuts, own, "left").select(*[df[c] for c in df.columns], "__cuts")

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                texts = [
                    x if x is None or not c else without(x.encode(), [(s["start"], s["length"]) for s in c]).decode()
                    for x, c in zip(part.column(at).to_pylist(), part.column(part.num_columns - 1).to_pylist(), strict=True)
                ]
                columns = list(part.columns[:-1])
                columns[at] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(columns, part.schema.names[:-1])

    return joined.mapInArrow(run, T.StructType(df.schema.fields))
