"""Exact top-k search by distributed selection on score histograms.

Queries and candidates meet in a grid of cells, a bounded block of each per cell, and every
cell scores its block pair whole. Scores are not kept. A first pass counts them per query
in a global histogram and finds the bin that holds the k-th value; the next pass spreads
that bin over a histogram of its own, and so on until a bin is one integer wide. Then each
query's k-th score is known exactly, and a last pass keeps what reaches it; ties at the
edge go to the smaller id. A cell reports its bins from the top only as far as the k-th of
its own scores, since the global k-th is no lower, so a pass moves at most k counts per
query and cell.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pintulog.shared import drop_settled, settle

BINS = 512
QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 8192


def fixed_point(df: DataFrame, ident: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(id, v): each component x as floor(scale * x) in double, of vectors that are finite throughout.

    Rows without an id, and vectors that are null, empty or hold a null, NaN or infinity,
    are left out; rows repeated in full count once.
    """
    x = F.col(vector).cast("array<double>")
    whole = F.forall(x, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))  # NaN is the largest double
    return (
        df.filter(F.col(ident).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & whole)
        .select(F.col(ident).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c * scale)).alias("v"))
        .distinct()
    )


def _matrix(table: pa.Table) -> np.ndarray:
    column = table.column("v").combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products as exact integers; through doubles while they hold them exactly."""
    bound = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * left.shape[1]
    if bound < 1 << 53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left @ right.T


def _parts(group: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """Query rows of a cell, ids of its candidates, and all scores; a query's own row is masked."""
    is_query = group.column("is_query").to_numpy()
    queries, candidates = group.filter(pa.array(is_query)), group.filter(pa.array(~is_query))
    ids = candidates.column("id").to_numpy()
    if not len(ids) or not queries.num_rows:
        return queries, ids, np.zeros((queries.num_rows, len(ids)), np.int64)
    scores = _scores(_matrix(queries), _matrix(candidates))
    scores[queries.column("id").to_numpy()[:, None] == ids[None, :]] = OUT
    return queries, ids, scores


OUT = np.iinfo(np.int64).min


def _histogram(k: int, bins: int, step: int):
    def run(group: pa.Table) -> pa.Table:
        queries, _, scores = _parts(group)
        low = queries.column("low").to_numpy()
        out_query, out_bin, out_count = [], [], []
        for i, number in enumerate(queries.column("id").to_numpy()):
            own = scores[i]
            own = own[own >= low[i]]
            place = (own - low[i]) // step
            counts = np.bincount(place[place < bins], minlength=bins)[::-1]
            filled = np.flatnonzero(counts)
            before = np.cumsum(counts[filled]) - counts[filled]
            filled = filled[before < k]
            out_query.append(np.full(len(filled), number))
            out_bin.append(bins - 1 - filled)
            out_count.append(counts[filled])
        flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_query, out_bin, out_count)]
        return pa.table([pa.array(x.astype(np.int64)) for x in flat], names=["query", "bin", "n"])

    return run


def _reaching(k: int):
    def run(group: pa.Table) -> pa.Table:
        queries, ids, scores = _parts(group)
        low = queries.column("low").to_numpy()
        rows = []
        for i, number in enumerate(queries.column("id").to_numpy().tolist()):
            at = np.flatnonzero((scores[i] >= low[i]) & (scores[i] != OUT))
            at = at[np.lexsort((ids[at], -scores[i][at]))][:k]
            rows += zip([number] * len(at), ids[at].tolist(), scores[i][at].tolist())
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    return run


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 5, bins: int = BINS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best candidates of each query by inner product.

    Both tables hold (id, v) with integer components, all vectors of one length, else it fails. A query
    is not its own candidate: rows with its id are passed over. Equal scores go to the
    smaller id; a query with fewer than ``k`` candidates gets them all. Empty tables give
    no rows. Passes follow from the range of scores, ceil(log(range, bins)), and each
    scores every pair again; only histogram counts and one interval per query are stored.
    """
    candidates, queries = settle(candidates), settle(queries)
    squared = F.aggregate("v", F.lit(0).cast("decimal(38,0)"), lambda a, x: (a + x * x).cast("decimal(38,0)"))
    size = F.size("v")
    n_candidates, most_candidate, *lengths = candidates.agg(F.count("*"), F.max(squared), F.min(size), F.max(size)).first()
    n_queries, most_query, *others = queries.agg(F.count("*"), F.max(squared), F.min(size), F.max(size)).first()
    if len(found := {n for n in (*lengths, *others) if n is not None}) > 1:
        raise ValueError(f"vectors have {min(found)} to {max(found)} components")
    bound = math.isqrt(int(most_candidate or 0) * int(most_query or 0)) + 1
    across, down = max(1, -(-n_candidates // CANDIDATE_BLOCK)), max(1, -(-n_queries // QUERY_BLOCK))

    def block(count: int):
        return F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")

    def every(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    def cells(state: DataFrame) -> DataFrame:
        asked = queries.join(state, "id").select("id", "v", "low", F.lit(True).alias("is_query"), block(down).alias("row"), every(across).alias("col"))
        offered = candidates.select("id", "v", F.lit(0).cast("long").alias("low"), F.lit(False).alias("is_query"), every(down).alias("row"), block(across).alias("col"))
        return asked.union(offered).groupBy("row", "col")

    # The k-th score of a query lies in [low, low + step of the last pass), `above` scores beyond it.
    state = queries.select("id", F.lit(-bound).cast("long").alias("low"), F.lit(0).cast("long").alias("above")).distinct()
    step = 1
    while step * bins < 2 * bound + 1:
        step *= bins
    while step:
        counts = cells(state).applyInArrow(_histogram(k, bins, step), "query long, bin long, n long")
        total = counts.groupBy("query", "bin").agg(F.sum("n").alias("n"))
        down_to = Window.partitionBy("query").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
        holding = (
            total.withColumn("upto", F.sum("n").over(down_to))
            .join(state, F.col("query") == F.col("id"))
            .filter((F.col("above") + F.col("upto") >= k) & (F.col("above") + F.col("upto") - F.col("n") < k))
            .select("id", (F.col("low") + F.col("bin") * step).alias("low"), (F.col("above") + F.col("upto") - F.col("n")).alias("above"))
        )
        found = holding.withColumnsRenamed({"low": "new_low", "above": "new_above"})
        # A query with too few candidates is in no bin and keeps its lowest bound.
        after = settle(state.join(found, "id", "left").select("id", F.coalesce("new_low", "low").alias("low"), F.coalesce("new_above", "above").alias("above")))
        if step * bins < 2 * bound + 1:
            drop_settled(state)
        state, step = after, step // bins
    reaching = cells(state).applyInArrow(_reaching(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = reaching.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
