"""Packing documents into fixed windows, best fit decreasing.

A document of more tokens than a window is first cut into full windows, which are closed
at once. What remains of each document, less than a window, goes into the tightest open
window that still holds it, longest pieces first; a segment tree over the remaining
capacities finds that window. Pieces are dealt by a hash of the
piece and its place, so that equal ones spread like any others, into groups of about
``GROUP`` pieces, each packed by itself: in a group of this size hardly any capacity is
left over, and groups are packed in parallel however many documents there are.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pintulog.llm.batches import bounded_batches, slices
from pintulog.llm.bpe import codec
from pintulog.shared import settle

WINDOW = 2048
GROUP = 20_000


class OpenWindows:
    """Open windows by remaining capacity, in a segment tree of how many there are."""

    def __init__(self, size: int):
        self.base = 1 << size.bit_length()
        self.tree = [0] * (2 * self.base)
        self.windows: list[list[int]] = [[] for _ in range(size + 1)]

    def _add(self, capacity: int, change: int) -> None:
        node = capacity + self.base
        while node:
            self.tree[node] += change
            node >>= 1

    def put(self, window: int, capacity: int) -> None:
        self.windows[capacity].append(window)
        self._add(capacity, 1)

    def tightest(self, length: int) -> int | None:
        """The smallest capacity of at least ``length`` among the open windows."""
        node = length + self.base
        if self.tree[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.tree[node + 1]:
                node += 1
                while node < self.base:
                    node = 2 * node if self.tree[2 * node] else 2 * node + 1
                return node - self.base
            node >>= 1
        return None

    def take(self, capacity: int) -> int:
        self._add(capacity, -1)
        return self.windows[capacity].pop()


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Window and offset in it of each piece, and the number of windows."""
    window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    still, made = OpenWindows(size), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        capacity = size if length == size else still.tightest(length)
        if capacity is None or length == size:
            window[i], capacity, made = made, size, made + 1
        else:
            window[i] = still.take(capacity)
        offset[i] = size - capacity
        if capacity > length:
            still.put(int(window[i]), capacity - length)
    return window, offset, made


PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])


def pieces(df: DataFrame, path: str, end_id: int = 1, window: int = WINDOW) -> DataFrame:
    """The pieces of each document's ids followed by ``end_id``: full windows and the rest.

    A null text is an empty one and leaves the end id alone. No row is dropped; repeated
    rows are documents of their own. Other columns are ignored.
    """
    bounded_batches(df.sparkSession)

    def cut(batches):
        coder = codec(path)
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = np.append(coder.encode_long(text or ""), end_id).astype("<u4")
                    for start in range(0, len(ids), window):
                        piece = ids[start : start + window]
                        rows.append((doc, start, len(piece), zlib.crc32(piece), len(ids)))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PIECES, strict=True)], schema=PIECES)

    return df.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    )


def pack(pieces: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: the window of each, gapless from 0.

    ``pieces`` has a column ``length`` from 1 to ``window``; it is written to shared
    storage first, because it is counted and then read. Each group has about
    ``group`` pieces at any size of the table, since their number follows the count of
    rows; columns named ``sequence_id`` or ``offset`` are replaced.
    """
    pieces = settle(pieces.drop("sequence_id", "offset"))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    groups = max(1, -(-pieces.count() // group))
    place = [F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1), F.col("_metadata.row_index")]
    dealt = pieces.withColumn("__group", F.pmod(F.xxhash64(*pieces.columns, *place), F.lit(groups)))

    def packed(table: pa.Table) -> pa.Table:
        number = table.column("__group")[0].as_py()
        table = table.drop_columns(["__group"]).combine_chunks()
        place, offset, _ = best_fit(table.column("length").to_numpy(), window)
        return table.append_column("sequence_id", pa.array(place + (number << 32))).append_column("offset", pa.array(offset))

    return dealt.groupBy("__group").applyInArrow(packed, schema)
