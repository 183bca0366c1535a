"""Near-duplicate vectors: random-hyperplane hashing, exact cosines, components.

Each of several tables hashes a vector to the signs of its products with random planes;
vectors at a small angle often fall on the same side of all of them. Bits per table follow
from the number of vectors, so that buckets stay small at any size, and the number of
tables from the bits, so that a pair right at the threshold shares a bucket with
probability ``RECALL``; closer pairs do so more often. Pairs of a bucket are compared by
exact cosine, in blocks if the bucket is large. A pair that meets in several tables counts
in the first; each row's links are summed where they are found, and only a spanning forest
of each cell goes on to the components, so no list of pairs is ever made.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pintulog.llm.cells import by_cell, deal, large_cells, roots, small_pairs
from pintulog.llm.components import components, lookup
from pintulog.shared import settle

RECALL = 0.999
SMALL = 8
SEED = 11


def tables_for(count: int, cosine: float, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables): about a quarter of a vector per bucket, and the recall at the threshold."""
    bits = max(8, min(56, math.ceil(math.log2(max(count, 2))) + 2))
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def planes(tables: int, bits: int, dim: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((tables * bits, dim))


def _doubles(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def _hash(tables: int, bits: int):
    weight = (1 << np.arange(bits, dtype=np.int64))

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _doubles(batch.column("v"))
            if held is None or held.shape[1] != vectors.shape[1]:
                held = planes(tables, bits, vectors.shape[1])
            signs = (vectors @ held.T > 0).reshape(len(vectors), tables, bits)
            codes = (signs * weight).sum(axis=2)
            codes = pa.ListArray.from_arrays(np.arange(len(vectors) + 1, dtype=np.int32) * tables, codes.reshape(-1))
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("size"), batch.column("v"), codes], ["node", "size", "v", "codes"])

    return run


def _compare(cosine: float):
    def run(batches):
        for table, cell in by_cell(batches, "bucket"):
            node, size = table.column("node").to_numpy(), table.column("size").to_numpy()
            side, at = table.column("side").to_numpy(), table.column("table").to_numpy()
            crossed = table.column("low").to_numpy() != table.column("high").to_numpy()
            vectors = _doubles(table.column("v").combine_chunks())
            vectors /= np.sqrt((vectors * vectors).sum(axis=1))[:, None]
            codes = table.column("codes").combine_chunks()
            codes = codes.flatten().to_numpy().reshape(len(node), -1)
            links = np.zeros(len(node), np.int64)
            ends: list[tuple[np.ndarray, np.ndarray]] = []
            for i, j in small_pairs(cell, SMALL):
                near = np.einsum("ij,ij->i", vectors[i], vectors[j]) >= cosine
                near &= ~crossed[i] | (side[i] != side[j])
                i, j = i[near], j[near]
                ends.append((node[i], node[j]))
                met = codes[i] == codes[j]
                first = met.argmax(axis=1) == at[i]
                np.add.at(links, i[first], size[j[first]])
                np.add.at(links, j[first], size[i[first]])
            for rows in large_cells(cell, SMALL):
                v, c, t = vectors[rows], codes[rows], int(at[rows.start])
                near = v @ v.T >= cosine
                np.fill_diagonal(near, False)
                if crossed[rows.start]:  # pairs within one block belong to another cell
                    near &= side[rows][:, None] != side[rows][None, :]
                label = roots(near)
                moved = label != np.arange(len(v))
                ends.append((node[rows][moved], node[rows][label[moved]]))
                for earlier in range(t):
                    near &= c[:, None, earlier] != c[None, :, earlier]
                links[rows] += near @ size[rows]
            some = links > 0
            a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*ends)) if ends else (np.zeros(0, np.int64),) * 2
            ids = np.concatenate([node[some], a])
            other = pa.array(np.concatenate([node[some], b]))
            count = pa.array(np.concatenate([links[some], np.zeros(len(a), np.int64)]))
            yield pa.RecordBatch.from_arrays([pa.array(ids), other, count], ["a", "b", "n"])

    return run


def near_duplicates(df: DataFrame, cosine: float = 0.95, recall: float = RECALL, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``df``.

    ``n_links`` counts the other rows whose vector has a cosine of at least ``cosine``
    with this one's, ``component_id`` is the smallest id reachable by links, and ``kept``
    marks the rows with that id. Vectors that are null, empty, zero or hold a null, NaN
    or infinity link with nothing. Equal vectors are compared once and share their
    links. A row without an id comes back with no links, no component, and kept.
    All vectors that are compared must have one length, else it fails.
    """
    x = F.col(vector).cast("array<double>")
    whole = F.forall(x, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False))) & F.exists(x, lambda c: c != 0)
    usable = F.col(ident).isNotNull() & F.coalesce(whole, F.lit(False))
    rows = df.select(
        F.col(ident).cast("long").alias("id"),
        F.when(usable, F.transform(x, lambda c: c + F.lit(0.0))).alias("v"),  # one zero, not two
    ).withColumn("key", F.unhex(F.sha2(F.array_join(F.transform("v", lambda c: c.cast("string")), " "), 256)))
    rows = settle(rows)
    classes = rows.filter("v is not null").groupBy("key").agg(F.min("id").alias("node"), F.count("*").alias("size"), F.first("v").alias("v"))
    count, *lengths = classes.agg(F.count("*"), F.min(F.size("v")), F.max(F.size("v"))).first()
    if lengths[0] != lengths[1]:
        raise ValueError(f"vectors have {lengths[0]} to {lengths[1]} components")
    bits, tables = tables_for(count, cosine, recall)
    hashed = settle(classes.select("node", "size", "v").mapInArrow(_hash(tables, bits), "node long, size long, v array<double>, codes array<long>"))
    keys = hashed.select("node", F.posexplode("codes").alias("table", "code")).select(
        "node", "table", F.xxhash64("table", "code").alias("bucket")
    )
    shared = keys.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
    met = lookup(keys, shared, "bucket")
    found = deal(
        met.join(hashed, "node").select("bucket", "table", "members", "node", "size", "v", "codes"),
        "bucket", "members", F.xxhash64("node"),
    ).mapInArrow(_compare(cosine), "a long, b long, n long")
    found = settle(found)
    links = found.filter("n > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    reached = components(found.filter("a <> b").select("a", "b"))
    own = classes.select("key", "node", "size").join(links, "node", "left").join(reached, "node", "left")
    own = own.select("key", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n"), F.coalesce("component", "node").alias("c"))
    out = lookup(rows.filter("v is not null").select("id", "key"), own, "key").select(
        F.col("id").alias(ident), F.col("n").alias("n_links"), F.col("c").alias("component_id")
    )
    alone = rows.filter("v is null").select(F.col("id").alias(ident), F.lit(0).cast("long"), F.col("id"))
    return out.union(alone).withColumn("kept", F.coalesce(F.col(ident) == F.col("component_id"), F.lit(True)))
