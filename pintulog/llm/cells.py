"""Comparing all pairs within groups, large groups cut into blocks that meet in pairs."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 512


def deal(rows: DataFrame, group: str, size: str, spread: Column, block: int = BLOCK) -> DataFrame:
    """``rows`` with columns ``low``, ``high`` (a cell of their group) and ``side``, sorted by cell.

    A group of ``size`` rows has ceil(size / block) blocks, by ``spread``; each pair of
    blocks is a cell, so no task holds more than two blocks of a group at once, and every
    pair of rows of a group meets in exactly one cell. Side 0 is the lower block.
    """
    blocks = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(spread, blocks).cast("int")
    dealt = rows.withColumn("__own", own).withColumn("__other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    cells = dealt.withColumns({"low": F.least("__own", "__other"), "high": F.greatest("__own", "__other")}).withColumn(
        "side", (F.col("__own") > F.col("__other")).cast("int")
    ).drop("__own", "__other")
    return cells.repartition(group, "low", "high").sortWithinPartitions(group, "low", "high", "side")


def by_cell(batches: Iterator[pa.RecordBatch], group: str, rows: int = 4096) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole cells, small ones together, with the number of the cell of each row."""
    held: list[pa.RecordBatch] = []
    count = 0

    def split(final: bool):
        table = pa.Table.from_batches(held).combine_chunks()
        keys = [table.column(c).to_numpy() for c in (group, "low", "high")]
        changed = np.zeros(table.num_rows, bool)
        for key in keys:
            changed[1:] |= key[1:] != key[:-1]
        cell = np.cumsum(changed)
        end = table.num_rows if final else int(np.searchsorted(cell, cell[-1]))
        return table.slice(0, end), cell[:end], table.slice(end).to_batches()

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count >= rows:
            table, cell, held = split(False)
            count = sum(b.num_rows for b in held)
            if table.num_rows:
                yield table, cell
    if held:
        table, cell, _ = split(True)
        yield table, cell


def small_pairs(cell: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers (i, j), i < j, of all pairs in cells of up to ``most`` rows, a distance at a time."""
    _, number, sizes = np.unique(cell, return_inverse=True, return_counts=True)
    ends = np.cumsum(sizes)
    rows = np.flatnonzero(sizes[number] <= most)
    for distance in range(1, most):
        rows = rows[rows + distance < ends[number[rows]]]
        if not len(rows):
            return
        yield rows, rows + distance


def large_cells(cell: np.ndarray, least: int) -> Iterator[slice]:
    """The rows of each cell of more than ``least`` rows."""
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    for low, high in zip(starts, np.r_[starts[1:], len(cell)]):
        if high - low > least:
            yield slice(int(low), int(high))


def roots(linked: np.ndarray) -> np.ndarray:
    """The smallest row number in each row's component of a symmetric link matrix."""
    label = np.arange(len(linked))
    while True:
        after = np.minimum(label, np.where(linked, label[None, :], len(linked)).min(axis=1, initial=len(linked)))
        after = after[after]
        if (after == label).all():
            return label
        label = after
