"""Near-duplicate documents by b-bit MinHash.

Each distinct shingle set gets ``HASHES`` minima. Bands of ``ROWS`` full minima deal sets
into buckets; of each minimum only ``BITS`` low bits stay, packed into six 64-bit words.
Sets of one bucket are compared by those words: the share of equal fields, corrected for
chance agreement of 2^-BITS, estimates the Jaccard similarity, and pairs whose estimate is
far below the threshold go no further. Sets whose bucket is still open after the first
round get a second signature of ``LONG`` fields, which narrows what is left to the pairs
near the threshold or above. Those are confirmed on the full sets.

Documents with equal sets count as one from the start. Only connections matter, so pairs
already connected are never looked at again. A first round tries each set with the best of
its buckets' leaders; the next compares all sets of different components within each bucket
but takes only the best few partners of each; the last takes every pair left. After it no
two sets of a bucket with an estimate above the cut are both unconnected and untested.
Large buckets are compared in blocks.

With 24 bands of 4 rows a pair right at a similarity of 0.75 shares no bucket with
probability (1 - 0.75^4)^24 = 1.1e-4; the cut lies 4.5 standard deviations of the estimate
below the threshold.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pintulog.llm.batches import bounded_batches, slices
from pintulog.llm.cells import by_cell, deal, large_cells, small_pairs
from pintulog.llm.components import components, lookup, merged
from pintulog.llm.words import mixed, set_key, shingle_set
from pintulog.shared import drop_settled, free_shuffles, settle

HASHES, BITS, ROWS = 96, 4, 4
LONG = 1024
WORDS = HASHES * BITS // 64
FEW = 4
SMALL = 48
_LOW = 0x1111111111111111

_rng = np.random.default_rng(7)
_FACTORS = _rng.integers(0, 1 << 63, LONG, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 1 << 63, LONG, dtype=np.uint64)


def minima(sets: list[np.ndarray], hashes: int = HASHES) -> np.ndarray:
    """The first ``hashes`` minima of each set, none of them empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    found = np.empty((len(sets), hashes), np.uint64)
    for k in range(hashes):
        found[:, k] = np.minimum.reduceat(flat * _FACTORS[k] + _SHIFTS[k], starts)
    return mixed(found)


def bands(found: np.ndarray, rows: int = ROWS, count: int | None = None) -> np.ndarray:
    """One 64-bit bucket key for each band of ``rows`` minima, as signed integers."""
    count = count or found.shape[1] // rows
    keys = np.zeros((len(found), count), np.uint64)
    for band in range(count):
        key = np.full(len(found), band + 1, np.uint64)
        for k in range(rows):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + found[:, band * rows + k])
        keys[:, band] = key
    return keys.view(np.int64)


def packed(found: np.ndarray) -> np.ndarray:
    """The low bits of the minima, packed into signed 64-bit words."""
    fields = (found & np.uint64((1 << BITS) - 1)).reshape(len(found), -1, 64 // BITS)
    places = (np.arange(64 // BITS) * BITS).astype(np.uint64)
    return np.bitwise_or.reduce(fields << places, axis=2).view(np.int64)


def estimated(agreeing: np.ndarray, hashes: int = HASHES) -> np.ndarray:
    """Jaccard similarity from the number of agreeing fields, less what chance makes agree."""
    chance = 2.0**-BITS
    return (agreeing / hashes - chance) / (1 - chance)


def agreeing(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Equal fields of packed signatures along the last axis, by bit counts."""
    differing = (left ^ right).view(np.uint64)
    differing |= differing >> np.uint64(1)
    differing |= differing >> np.uint64(2)
    fields = left.shape[-1] * (64 // BITS)
    return fields - np.bitwise_count(differing & np.uint64(_LOW)).sum(axis=-1, dtype=np.int64)


def agreeing_sql(left: Column, right: Column) -> Column:
    """The same on array columns, in the JVM."""
    total = F.lit(HASHES)
    for i in range(WORDS):
        x = left[i].bitwiseXOR(right[i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        total = total - F.bit_count(x.bitwiseAND(F.lit(_LOW)))
    return total


def fewest(threshold: float, hashes: int = HASHES) -> int:
    """Agreeing fields below which a pair is taken for dissimilar."""
    chance = 2.0**-BITS
    share = threshold + (1 - threshold) * chance
    return int(hashes * share - 4.5 * (hashes * share * (1 - share)) ** 0.5)


def _lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(offsets, np.ascontiguousarray(values).reshape(-1))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            sets = [shingle_set(x) for x in part.column(1).to_pylist()]
            full = np.array([len(s) > 0 for s in sets])
            found = np.zeros((len(sets), HASHES), np.uint64)
            if full.any():
                found[full] = minima([s for s in sets if len(s)])
            keys = np.array([set_key(s) for s in sets], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys[:, 0]), pa.array(keys[:, 1]), _lists(bands(found)), _lists(packed(found))],
                ["doc_id", "n_shingles", "hi", "lo", "bands", "sig"],
            )


SIGNED = "doc_id long, n_shingles long, hi long, lo long, bands array<long>, sig array<long>"


def signatures(df: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, key, bands, sig) of each row; no words give 0 shingles."""
    bounded_batches(df.sparkSession)
    return df.select(F.col("doc_id").cast("long"), "text").mapInArrow(_sign, SIGNED)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            sets = [shingle_set(x).tobytes() for x in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["node", "items"])


def _confirm(least: int):
    """Whether 100 * |a & b| >= least * |a | b|."""

    def run(batches):
        for batch in batches:
            good = []
            for a, b in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= least * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(good, pa.bool_())], ["a", "b", "linked"])

    return run


def _sign_long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            sets = [np.frombuffer(x, np.uint64) for x in batch.column("items").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), _lists(packed(minima(sets, LONG)))], ["node", "long"])


def _across(cut: int, long_cut: int, few: int | None):
    """The best ``few`` partners in other components of each row of each cell, or all."""

    def run(batches):
        for table, cell in by_cell(batches, "bucket"):
            node = table.column("node").combine_chunks()
            part = table.column("part").to_numpy()
            side = table.column("side").to_numpy()
            crossed = table.column("low").to_numpy() != table.column("high").to_numpy()
            sig = table.column("sig").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
            long = table.column("long").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
            keys = table.column("bands").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
            bucket = table.column("bucket").to_numpy()
            found = []

            def take(i: np.ndarray, j: np.ndarray) -> None:
                for low in range(0, len(i), 20_000):
                    x, y = i[low : low + 20_000], j[low : low + 20_000]
                    equal = agreeing(long[x], long[y])
                    shared = (keys[x] == keys[y]).argmax(axis=1)
                    # a pair of several buckets is looked at in the first
                    near = (equal >= long_cut) & (keys[x, shared] == bucket[x])
                    found.append((x[near], y[near], equal[near]))

            for i, j in small_pairs(cell, SMALL):
                apart = (part[i] != part[j]) & (~crossed[i] | (side[i] != side[j]))
                i, j = i[apart], j[apart]
                near = agreeing(sig[i], sig[j]) >= cut
                take(i[near], j[near])
            for rows in large_cells(cell, SMALL):
                for low in range(rows.start, rows.stop, 64):
                    own = np.arange(low, min(low + 64, rows.stop))
                    if (part[own] == part[rows.start]).all() and (part[rows] == part[rows.start]).all():
                        continue
                    others = np.arange(low + 1, rows.stop)
                    equal = agreeing(sig[own][:, None, :], sig[others][None, :, :])
                    near = (equal >= cut) & (part[own][:, None] != part[others][None, :]) & (own[:, None] < others[None, :])
                    if crossed[low]:
                        near &= side[own][:, None] != side[others][None, :]
                    x, y = np.nonzero(near)
                    take(own[x], others[y])
            i, j, equal = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
            if few is not None and len(i):
                # of the two rows of a pair, either may count it among its best
                ends, other = np.concatenate([i, j]), np.concatenate([j, i])
                order = np.lexsort((other, -np.concatenate([equal, equal]), ends))
                sorted_ends = ends[order]
                first = np.searchsorted(sorted_ends, sorted_ends)
                best = order[np.arange(len(order)) - first < few]
                chosen = np.unique(best % len(i))
                i, j = i[chosen], j[chosen]
            yield pa.RecordBatch.from_arrays([node.take(pa.array(i)), node.take(pa.array(j))], ["a", "b"])

    return run


def connected(nodes: DataFrame, fetch: Callable[[DataFrame], DataFrame], threshold: float = 0.75) -> DataFrame:
    """(node, component) of the nodes that have a link, by their sets.

    ``nodes`` has distinct (node, bands, sig); ``fetch`` gives (node, items), the full set
    of each node of a table, as sorted 64-bit hashes in bytes. The ids are of any
    orderable type.
    """
    kind = nodes.schema["node"].dataType.simpleString()
    cut, long_cut, least = fewest(threshold), fewest(threshold, LONG), round(100 * threshold)
    keys = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = keys.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
    met = settle(lookup(keys, shared, "bucket"))
    del keys, shared
    free_shuffles(met.sparkSession)
    sig = nodes.select("node", "sig", "bands")
    items = settle(fetch(met.select("node").distinct()))
    free_shuffles(met.sparkSession)

    def confirmed(pairs: DataFrame) -> DataFrame:
        # a node may be in many pairs
        left = lookup(pairs, items.select(F.col("node").alias("a"), F.col("items").alias("left")), "a")
        both = lookup(left, items.select(F.col("node").alias("b"), F.col("items").alias("right")), "b")
        return settle(both.select("a", "b", "left", "right").mapInArrow(_confirm(least), f"a {kind}, b {kind}, linked boolean"))

    leader = F.min(F.struct(F.xxhash64("node", "bucket").alias("h"), F.col("node").alias("node")))
    led = lookup(met, met.groupBy("bucket").agg(leader["node"].alias("leader")), "bucket")
    led = led.filter("node <> leader").select("node", "leader").distinct()
    led = lookup(led, sig.select("node", "sig"), "node")
    led = lookup(led, sig.select(F.col("node").alias("leader"), F.col("sig").alias("leading")), "leader")
    equal = agreeing_sql(F.col("sig"), F.col("leading"))
    best = led.withColumn("equal", equal).filter(F.col("equal") >= cut).groupBy("node").agg(F.max_by("leader", "equal").alias("leader"))
    pair = F.greatest("node", "leader").alias("a"), F.least("node", "leader").alias("b")
    tested, long = confirmed(best.select(*pair).distinct()), None
    free_shuffles(met.sparkSession)
    reached = components(tested.filter("linked").select("a", "b"))
    for few in (FEW, None):
        apart = met.join(reached, "node", "left").select("bucket", "members", "node", F.coalesce("component", "node").alias("component"))
        open_buckets = apart.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("bucket")
        rows = lookup(apart, open_buckets, "bucket")
        rows = lookup(rows, sig, "node").withColumn("part", F.xxhash64("component"))
        if long is None:  # what is open later was open before
            asked = items.join(rows.select("node").distinct(), "node", "left_semi")
            long = settle(asked.mapInArrow(_sign_long, f"node {kind}, long array<long>"))
            free_shuffles(met.sparkSession)
        rows = lookup(rows, long, "node")
        dealt = deal(rows.select("bucket", "members", "node", "part", "sig", "long", "bands"), "bucket", "members", F.xxhash64("node"))
        pairs = dealt.mapInArrow(_across(cut, long_cut, few), f"a {kind}, b {kind}")
        pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        new = settle(pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti"))
        free_shuffles(met.sparkSession)
        added = confirmed(new)
        free_shuffles(met.sparkSession)
        reached = merged(reached, added.filter("linked"))
        tested = tested.union(added)
        drop_settled(new)
        free_shuffles(met.sparkSession)
    drop_settled(met, items, long, tested)
    return reached


def near_duplicates(df: DataFrame, threshold: float = 0.75) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``df`` (doc_id, text).

    Documents are linked if the Jaccard similarity of their sets of five-word shingles is
    at least ``threshold``; ``component_id`` is the smallest id reachable by links. A text
    of fewer words is one shingle; one without words, or null, has none and links with
    nothing. Equal sets always link. A row without an id comes back with a null component
    and kept; repeated rows come back each. Other columns are ignored.
    """
    signed = settle(signatures(df))
    full = signed.filter("n_shingles > 0 and doc_id is not null").withColumn("key", F.struct("hi", "lo"))
    classes = settle(full.groupBy("key").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.first("sig").alias("sig")))

    def fetch(ids: DataFrame) -> DataFrame:
        # an id may recur with other texts; only the one of the class counts
        texts = df.select(F.col("doc_id").cast("long").alias("node"), "text").join(ids, "node", "left_semi")
        sets = texts.mapInArrow(_sets, "node long, items binary")
        return sets.groupBy("node").agg(F.max("items").alias("items"))

    reached = connected(classes.select("node", "bands", "sig"), fetch, threshold)
    own = classes.select("key", "node").join(reached, "node", "left").select("key", F.coalesce("component", "node").alias("c"))
    found = lookup(full.select("doc_id", "n_shingles", "key"), own, "key").select("doc_id", "n_shingles", F.col("c").alias("component_id"))
    rest = signed.filter("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id"))
    return found.union(rest).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
