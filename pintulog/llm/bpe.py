"""Byte-pair encoding and decoding of whole texts, long ones by tree concatenation.

A text of up to ``LEAF`` characters is encoded where it is read. A longer one is cut into
leaves, which become rows of their own and are encoded in parallel; then the leaves of one
text meet and are joined in pairs, level by level. At each join a window of tokens around
the seam is encoded anew and grows, doubling, until its first token equals the left side's
and its last token equals the right side's at the same place. Then the join is exact: a
sequence of tokens is the encoding of its text if each adjacent pair is the encoding of
that pair, and every adjacent pair now comes from a real encoding of its surroundings. A
window that reaches the outer end of a side asks nothing more of that side, so in the worst
case both halves are encoded again.

Pre-splitting follows the vocabulary's pattern. Its only look-ahead concerns runs of white
space, so a text without such runs takes the same pattern without it, which is much faster.
"""

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pintulog.llm.batches import bounded_batches, slices
from pintulog.llm.transducer import byte_symbols

LEAF = 32_768
WINDOW = 8

# The split pattern of the vocabulary, and the same where no two white
# space characters are adjacent.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PATTERN_SINGLE = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"""
SPACE_RUN = re.compile(r"\s\s")


class Codec:
    """Encodes and decodes with the byte-level vocabulary in the JSON file at ``path``."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        special = {x["content"]: x["id"] for x in model["added_tokens"]}
        to_byte = byte_symbols()
        ranks = {
            bytes(to_byte[c] for c in token): number
            for token, number in model["model"]["vocab"].items()
            if token not in special
        }
        self.special = special
        self.full = tiktoken.Encoding("full", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.single = tiktoken.Encoding("single", pat_str=PATTERN_SINGLE, mergeable_ranks=ranks, special_tokens=special)
        self.size = max([*ranks.values(), *special.values()]) + 1
        table = {number: token for token, number in ranks.items()} | {n: x.encode() for x, n in special.items()}
        self.token = [table.get(i, b"") for i in range(self.size)]

    def plain(self, text: str) -> np.ndarray:
        """Ids of a text in which special strings count as ordinary text."""
        codec = self.full if SPACE_RUN.search(text) else self.single
        return np.array(codec.encode_ordinary(text), np.uint32)

    def parts(self, text: str) -> list[str | int]:
        """Stretches of ordinary text, and the id of each special string between them."""
        out: list[str | int] = [text]
        for string, number in self.special.items():
            if string in text:
                cut = [p.split(string) if isinstance(p, str) else [p] for p in out]
                out = [y for pieces in cut for x in pieces for y in (number, x)][1:]
        return out

    def encode(self, text: str) -> np.ndarray:
        parts = [np.array([x], np.uint32) if isinstance(x, int) else self.plain(x) for x in self.parts(text)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def encode_long(self, text: str, leaf: int = LEAF) -> np.ndarray:
        """As ``encode``, a long text by leaves within this task."""
        if len(text) <= leaf:
            return self.encode(text)
        parts = []
        for x in self.parts(text):
            cuts = [] if isinstance(x, int) else [x[i : i + leaf] for i in range(0, len(x), leaf)]
            parts.append(np.array([x], np.uint32) if isinstance(x, int) else self.tree([self.plain(c) for c in cuts or [""]]))
        return np.concatenate(parts)

    def raw(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.token.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``; bytes that form no character become U+FFFD."""
        return self.raw(ids).decode("utf-8", "replace")

    def whole(self, token: int) -> bool:
        """Whether the bytes of ``token`` begin with a character's first byte."""
        return self.token[token][0] & 0xC0 != 0x80

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The encoding of two adjacent stretches of one text from theirs."""
        if not len(left) or not len(right):
            return right if not len(left) else left
        reach = WINDOW
        while True:
            low, high = max(0, len(left) - reach), min(len(right), reach)
            while low > 0 and not self.whole(int(left[low])):
                low -= 1
            while high < len(right) and not self.whole(int(right[high])):
                high += 1
            window = self.plain(self.raw(np.concatenate([left[low:], right[:high]])).decode())
            agrees = (low == 0 or window[0] == left[low]) and (high == len(right) or window[-1] == right[high - 1])
            if agrees:
                return np.concatenate([left[:low], window, right[high:]])
            reach *= 2

    def tree(self, leaves: list[np.ndarray]) -> np.ndarray:
        """All leaves of one text joined in pairs, level by level."""
        while len(leaves) > 1:
            joined = [self.join(a, b) for a, b in zip(leaves[::2], leaves[1::2])]
            leaves = joined + leaves[len(joined) * 2 :]
        return leaves[0]


@lru_cache(2)
def codec(path: str) -> Codec:
    return Codec(path)


def _binary(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([x.astype("<u4").tobytes() for x in arrays], pa.binary())


def _encode_short(path: str, text: str, to: str):
    def run(batches):
        coder = codec(path)
        for batch in batches:
            for part in slices(batch, text):
                texts = part.column(part.schema.get_field_index(text)).to_pylist()
                ids = _binary([coder.encode(x or "") for x in texts])
                yield pa.RecordBatch.from_arrays([*part.columns, ids], [*part.schema.names, to])

    return run


def _cut(path: str, leaf: int):
    """Rows of leaves: their place, and their text or special id."""

    def run(batches):
        coder = codec(path)
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                place, rows = 0, []
                for stretch, part in enumerate(coder.parts(text)):
                    cuts = [part] if isinstance(part, int) else [part[i : i + leaf] for i in range(0, len(part), leaf)]
                    for piece in cuts:
                        special = piece if isinstance(piece, int) else None
                        rows.append((key, place, stretch, None if isinstance(piece, int) else piece, special))
                        place += 1
                for i in range(0, len(rows), 64):
                    columns = list(zip(*rows[i : i + 64], strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, [pa.binary(), pa.int32(), pa.int32(), pa.string(), pa.int32()], strict=True)],
                        ["key", "place", "stretch", "piece", "special"],
                    )

    return run


def _encode_leaves(path: str):
    def run(batches):
        coder = codec(path)
        for batch in batches:
            rows = zip(batch.column("piece").to_pylist(), batch.column("special").to_pylist(), strict=True)
            ids = [coder.plain(piece) if special is None else np.array([special], np.uint32) for piece, special in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("place"), batch.column("stretch"), _binary(ids)],
                ["key", "place", "stretch", "ids"],
            )

    return run


def _join_leaves(path: str):
    def run(group: pa.Table) -> pa.Table:
        coder = codec(path)
        found = {}
        for place, stretch, ids in zip(*(group.column(c).to_pylist() for c in ("place", "stretch", "ids")), strict=True):
            found[place] = (stretch, ids)
        stretches: dict[int, list[np.ndarray]] = {}
        for place in sorted(found):
            stretch, ids = found[place]
            stretches.setdefault(stretch, []).append(np.frombuffer(ids, "<u4"))
        ids = np.concatenate([coder.tree(leaves) for leaves in stretches.values()])
        return pa.table({"key": group.column("key")[:1], "ids": _binary([ids])})

    return run


def encode(df: DataFrame, path: str, text: str = "text", to: str = "ids", leaf: int = LEAF) -> DataFrame:
    """``df`` with the ids of each whole text in column ``to``: little-endian unsigned 32 bits.

    The result equals that of the library for the vocabulary file at ``path``, which must
    exist on every executor: no special tokens are added, special strings inside a text
    become their id, nothing is cut off. A null text is encoded as an empty one. Rows
    are never dropped; equal long texts are encoded once, whichever rows hold them. A
    column named ``to`` is replaced.

    Only texts of more than ``leaf`` characters are shuffled, as leaves; the leaves of one
    text meet in one task as the row that holds them does.
    """
    bounded_batches(df.sparkSession)
    df = df.drop(to)
    schema = T.StructType([*df.schema.fields, T.StructField(to, T.BinaryType())])
    is_long = F.coalesce(F.length(text) > leaf, F.lit(False))
    short = df.filter(~is_long).mapInArrow(_encode_short(path, text, to), schema)

    key = F.unhex(F.sha2(F.col(text), 256))
    long = df.filter(is_long)
    leaves = (
        long.select(key.alias("key"), F.col(text).alias("text"))
        .mapInArrow(_cut(path, leaf), "key binary, place int, stretch int, piece string, special int")
        .dropDuplicates(["key", "place"])
        .mapInArrow(_encode_leaves(path), "key binary, place int, stretch int, ids binary")
    )
    whole = leaves.groupBy("key").applyInArrow(_join_leaves(path), "key binary, ids binary")
    hidden = "__text_key"
    joined = long.withColumn(hidden, key).join(
        whole.select(F.col("key").alias(hidden), F.col("ids").alias(to)), hidden
    )
    return short.unionByName(joined.drop(hidden).select(*schema.names))


def decode(df: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``df`` with the text of the ids in column ``ids``, special tokens included, in ``to``.

    Null ids give an empty text. Bytes that form no character become U+FFFD. A column
    named ``to`` is replaced. There is no shuffle.
    """
    bounded_batches(df.sparkSession)
    df = df.drop(to)
    schema = T.StructType([*df.schema.fields, T.StructField(to, T.StringType())])

    def run(batches):
        coder = codec(path)
        for batch in batches:
            for part in slices(batch, ids):
                column = part.column(part.schema.get_field_index(ids)).to_pylist()
                texts = [coder.decode(np.frombuffer(x or b"", "<u4")) for x in column]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, to])

    return df.mapInArrow(run, schema)


def document_digests(df: DataFrame, path: str) -> DataFrame:
    """One row per document: token count and digests of its ids and of the text decoded from them."""
    ids = encode(df.select("doc_id", "text"), path).select("doc_id", "ids")
    return decode(ids, path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
