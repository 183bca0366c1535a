"""Hard-negative mining with a multiway hyperplane tree in the manner of GNAT.

Inner products become distances by one more component: a row x of squared length n gets
sqrt(M - n), M being the largest squared length, an anchor gets 0, and then their squared
distance is |anchor|^2 + M - 2 * score. So a window of scores is an annulus round the anchor.

A node of the tree has split points; every row belongs to the nearest one (the cells are
bounded by hyperplanes), and each split point stores the range of its distances to the rows
of every sibling subtree. From an anchor's distance to one split point, each sibling's
range says which distances from the anchor are possible there; a sibling whose possible
distances miss the annulus is left out. Leaves are scored exactly, in whole numbers. Once an
anchor has as many rows as it wants, the annulus shrinks to what is still good enough.

The top node is distributed: its split points come from a bounded sample, its cells and
ranges cover all rows, and a cell is cut into blocks of bounded size however many rows it
holds. A search goes to the anchor's own cell first, and with what that gave to the other
cells that remain. Below, each task builds the tree of its block and takes a bounded block of
searches through it together, so no task grows with a cell.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pintulog.shared import settle

SPLITS = 16  # split points of the distributed node
SAMPLE = 256  # rows that its split points are chosen from
FANOUT = 8  # split points of a node within a block
LEAF = 64
BLOCK = 4096  # rows a task holds
SEARCHES = 1024  # searches a task holds
SLACK = 1e-9  # relative; distances are doubles, scores are not
NONE = np.iinfo(np.int64).min

HITS = "anchor_id long, positive_id long, id long, score long"


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products as exact integers; vectors too long for 64 bits are refused."""
    bound = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * max(1, left.shape[1])
    if bound < 1 << 53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if bound >= 1 << 63:
        raise ValueError("inner products exceed 64 bits")
    return left @ right.T


def lifted(rows: np.ndarray, most: float) -> np.ndarray:
    """Rows with the component that gives all of them the same length."""
    x = rows.astype(np.float64)
    return np.hstack([x, np.sqrt(np.maximum(most - (x * x).sum(axis=1), 0))[:, None]])


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    square = (left * left).sum(axis=1)[:, None] + (right * right).sum(axis=1)[None, :] - 2 * (left @ right.T)
    return np.sqrt(np.maximum(square, 0))


def spread(points: np.ndarray, count: int) -> list[int]:
    """Up to ``count`` different rows, each the farthest from those before it."""
    chosen = [0]
    nearest = distances(points, points[:1])[:, 0]
    while len(chosen) < count:
        far = int(nearest.argmax())
        if nearest[far] <= 0:
            break
        chosen.append(far)
        nearest = np.minimum(nearest, distances(points, points[far : far + 1])[:, 0])
    return chosen


def reach(squares: np.ndarray, most: float, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The annulus (inner, outer distance) of scores from ``low`` to ``high`` round anchors of these squared lengths."""
    slack = SLACK * (squares + most + 1)
    return np.sqrt(np.maximum(squares + most - 2 * high - slack, 0)), np.sqrt(np.maximum(squares + most - 2 * low + slack, 0))


def possible(to_split: np.ndarray, nearest: np.ndarray, farthest: np.ndarray, inner: np.ndarray, outer: np.ndarray, scale: float) -> np.ndarray:
    """(search, sibling): whether no split point rules the sibling out.

    ``nearest`` and ``farthest`` are (split point, sibling) ranges; ``to_split`` the anchors' distances.
    """
    slack = 1e-6 * scale  # square roots keep half of the digits
    d = to_split[:, :, None]
    least = np.maximum(np.maximum(d - farthest, nearest - d), 0).max(axis=1)
    most = (d + farthest).min(axis=1)
    return (least <= outer[:, None] + slack) & (most >= inner[:, None] - slack)


class Node:
    """A subtree over some rows of a block; a leaf has no split points."""

    def __init__(self, rows: np.ndarray, points: np.ndarray):
        self.rows, self.children = rows, []
        if len(rows) <= LEAF:
            return
        own = points[rows]
        chosen = spread(own, FANOUT)
        if len(chosen) < 2:  # nothing but copies
            return
        self.splits = own[chosen]
        between = distances(own, self.splits)
        cell = between.argmin(axis=1)
        parts = [np.flatnonzero(cell == k) for k in range(len(chosen))]
        self.nearest = np.array([between[p].min(axis=0) for p in parts]).T
        self.farthest = np.array([between[p].max(axis=0) for p in parts]).T
        self.children = [Node(rows[p], points) for p in parts]


class Searches:
    """Searches that pass through a block together, and the best rows of each so far."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, same: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, most: float):
        self.vectors, self.ids, self.labels, self.same = vectors, ids, labels, same
        self.low, self.high, self.k, self.most = low.copy(), high, k, most
        x = vectors.astype(np.float64)
        self.points = np.hstack([x, np.zeros((len(x), 1))])
        self.squares = (x * x).sum(axis=1)
        self.scale = float(np.sqrt(self.squares.max(initial=0) + most)) + 1
        self.best = np.full((len(x), k), NONE)
        self.best_id = np.full((len(x), k), np.iinfo(np.int64).max)

    def meet(self, at: np.ndarray, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        """Score the searches ``at`` against all rows of a leaf."""
        for low in range(0, len(ids), 1024):  # a leaf of copies may be as long as the block
            part = slice(low, low + 1024)
            scores = products(self.vectors[at], vectors[part])
            fits = (scores >= self.low[at, None]) & (scores <= self.high[at, None]) & (ids[None, part] != self.ids[at, None])
            fits &= (labels[None, part] == self.labels[at, None]) == self.same[at, None]
            some = np.flatnonzero(fits.any(axis=1))
            if not len(some):
                continue
            mine = at[some]
            all_scores = np.hstack([self.best[mine], np.where(fits[some], scores[some], NONE)])
            all_ids = np.hstack([self.best_id[mine], np.broadcast_to(ids[None, part], (len(some), scores.shape[1]))])
            order = np.lexsort((all_ids, ~all_scores), axis=1)[:, : self.k]  # ~x falls as x grows
            self.best[mine] = np.take_along_axis(all_scores, order, axis=1)
            self.best_id[mine] = np.take_along_axis(all_ids, order, axis=1)
            # a later row must reach the last one's score; an equal score still counts, by its id
            self.low[mine] = np.maximum(self.low[mine], self.best[mine, -1])

    def through(self, node: Node, points: np.ndarray, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        stack = [(node, np.arange(len(self.vectors)))]
        while stack:
            node, at = stack.pop()
            if not node.children:
                self.meet(at, vectors[node.rows], ids[node.rows], labels[node.rows])
                continue
            to_split = distances(self.points[at], node.splits)
            inner, outer = reach(self.squares[at], self.most, self.low[at].astype(np.float64), self.high[at].astype(np.float64))
            open_to = possible(to_split, node.nearest, node.farthest, inner, outer, self.scale)
            # the farthest sibling goes on the stack first, so the nearest is searched first
            for k in np.argsort(-to_split.mean(axis=0)):
                if len(some := at[open_to[:, k]]):
                    stack.append((node.children[k], some))


def _searched(k: int, most: float):
    """One cell of the grid: a block of rows and a block of searches."""

    def run(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy()
        rows, searches = group.filter(pa.array(~asks)), group.filter(pa.array(asks))
        vectors, ids, labels = matrix(rows.column("v")), rows.column("id").to_numpy(), rows.column("label").to_numpy()
        if not len(ids) or not searches.num_rows:
            return pa.table({c.split()[0]: pa.array([], pa.int64()) for c in HITS.split(", ")})
        points = lifted(vectors, most)
        found = Searches(
            matrix(searches.column("v")), searches.column("id").to_numpy(), searches.column("label").to_numpy(), searches.column("same").to_numpy(),
            searches.column("low").to_numpy(), searches.column("high").to_numpy(), k, most,
        )
        found.through(Node(np.arange(len(ids)), points), points, vectors, ids, labels)
        hit = found.best != NONE
        at = np.nonzero(hit)[0]
        columns = [found.ids[at], searches.column("positive_id").to_numpy(zero_copy_only=False)[at], found.best_id[hit], found.best[hit]]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in HITS.split(", ")])

    return run


class Index:
    """The distributed top node over ``rows`` (id, label, v): cells, their blocks, and ranges."""

    def __init__(self, rows: DataFrame, block: int = BLOCK, splits: int = SPLITS):
        square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
        size = F.size("v")
        count, most, lengths = rows.agg(F.count("*"), F.max(square), F.struct(F.min(size), F.max(size))).first()
        if count and lengths[0] != lengths[1]:
            raise ValueError(f"vectors have {lengths[0]} to {lengths[1]} components")
        self.most, self.block = float(most or 0), block
        self.empty = not count
        if self.empty:
            return
        # a bounded sample, the same whatever the partitions; only split points are taken from it
        sample = rows.orderBy(F.xxhash64("id"), "id", "label", "v").limit(SAMPLE).select("v").toArrow()
        points = lifted(matrix(sample.column("v")), self.most)
        self.splits = points[spread(points, splits)]
        self.rows = settle(rows.mapInArrow(self._to_cells(), "id long, label long, v array<long>, cell int, from_splits array<double>"))
        per_split = [f(F.col("from_splits")[i]) for f in (F.min, F.max) for i in range(len(self.splits))]
        ranges = self.rows.groupBy("cell").agg(F.count("*").alias("n"), *per_split).collect()  # a row per split point
        self.sizes = {r["cell"]: r["n"] for r in ranges}
        self.cells = sorted(self.sizes)
        by_cell = {r["cell"]: np.array(r[2:]) for r in ranges}
        bounds = np.array([by_cell[c] for c in self.cells])
        self.nearest, self.farthest = bounds[:, : len(self.splits)].T, bounds[:, len(self.splits) :].T

    def _to_cells(self):
        splits, most = self.splits, self.most

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    table = pa.Table.from_batches([batch])
                    between = distances(lifted(matrix(table.column("v")), most), splits)
                    cell = pa.array(between.argmin(axis=1).astype(np.int32))
                    spans = pa.FixedSizeListArray.from_arrays(pa.array(between.ravel()), len(splits)).cast(pa.list_(pa.float64()))
                    yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), batch.column("v"), cell, spans], ["id", "label", "v", "cell", "from_splits"])

        return run

    def _to_search(self, home: bool):
        """Searches with the cells they go to: the nearest, or all others that are not ruled out."""
        splits, most, cells, nearest, farthest = self.splits, self.most, np.array(self.cells), self.nearest, self.farthest

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                table = pa.Table.from_batches([batch])
                x = matrix(table.column("v")).astype(np.float64)
                low, high = (table.column(c).to_numpy().astype(np.float64) for c in ("low", "high"))
                squares = (x * x).sum(axis=1)
                between = distances(np.hstack([x, np.zeros((len(x), 1))]), splits)
                own = np.array(cells)[between[:, cells].argmin(axis=1)]
                if home:
                    goes = own[:, None] == cells[None, :]
                else:
                    inner, outer = reach(squares, most, low, high)
                    scale = float(np.sqrt(squares.max(initial=0) + most)) + 1
                    goes = possible(between, nearest, farthest, inner, outer, scale) & (own[:, None] != cells[None, :])
                lists = [cells[g].astype(np.int32) for g in goes]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int32()))], [*batch.schema.names, "cells"])

        return run

    def _round(self, searches: DataFrame, k: int, home: bool) -> DataFrame:
        fields = "id long, label long, v array<long>, positive_id long, same boolean, low long, high long, cells array<int>"
        sizes = F.create_map(*[F.lit(x) for c, n in self.sizes.items() for x in (c, n)])
        blocks = F.ceil(F.element_at(sizes, F.col("cell")) / self.block).cast("int")
        routed = settle(searches.mapInArrow(self._to_search(home), fields).withColumn("cell", F.explode("cells")).drop("cells"))
        per_cell = routed.groupBy("cell").agg(F.count("*").alias("n"))
        deep = F.greatest(F.lit(1), F.ceil(F.col("n") / SEARCHES)).cast("int")
        # rows meet every block of searches in their cell, searches every block of rows
        offered = self.rows.join(per_cell, "cell").select(
            "cell", F.pmod(F.xxhash64("id", "v"), blocks).cast("int").alias("across"), F.explode(F.sequence(F.lit(0), deep - 1)).alias("down"),
            "id", "label", "v", F.lit(False).alias("asks"), *[F.lit(None).cast(t).alias(c) for c, t in (("positive_id", "long"), ("same", "boolean"), ("low", "long"), ("high", "long"))],
        )
        asked = routed.join(per_cell, "cell").select(
            "cell", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("across"), F.pmod(F.xxhash64("id", "positive_id"), deep).cast("int").alias("down"),
            "id", "label", "v", F.lit(True).alias("asks"), "positive_id", "same", "low", "high",
        )
        return offered.unionByName(asked).groupBy("cell", "across", "down").applyInArrow(_searched(k, self.most), HITS)

    def search(self, searches: DataFrame, k: int) -> DataFrame:
        """(anchor_id, positive_id, id, score, rank): the ``k`` best rows of each search, all if fewer.

        ``searches`` has (id, label, v, positive_id, same, low, high): rows with (``same``) or without its
        label whose score lies from low to high, its own id excepted. ``positive_id`` tells apart
        searches of one anchor. Higher scores come first, equal ones by the smaller id.
        """
        best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "id")

        def top(hits: DataFrame) -> DataFrame:
            return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

        if self.empty:
            return searches.sparkSession.createDataFrame([], f"{HITS}, rank int")
        near = settle(top(self._round(searches, k, home=True)))
        reached = near.filter(F.col("rank") == k).select(F.col("anchor_id").alias("id"), "positive_id", F.col("score").alias("reached"))
        known = searches.join(reached, ["id", "positive_id"], "left")
        rest = known.withColumn("low", F.greatest("low", F.coalesce("reached", "low"))).select(*searches.columns)
        far = self._round(rest, k, home=False)
        return top(near.drop("rank").unionByName(far))


def labelled_points(df: DataFrame) -> DataFrame:
    """(id, label, v) of the rows of ``df`` (vec_id, embedding, label), components as floor(256 * x) in double.

    Every seventh id takes the next label of ten. Rows without an id or a label, and vectors that
    are null, empty or hold a null, NaN or infinity, are left out. An id stands for one row: repeated
    rows count once, and of different rows with one id the smallest label, then vector, counts.
    """
    x = F.col("embedding").cast("array<double>")
    whole = F.forall(x, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))  # NaN is the largest double
    label = F.col("label").cast("long")
    known = df.filter(F.col("vec_id").isNotNull() & label.isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & whole)
    points = known.select(
        F.col("vec_id").cast("long").alias("id"),
        F.struct(F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), F.transform(x, lambda c: F.floor(c * 256)).alias("v")).alias("row"),
    )
    return points.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.label", "row.v")


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, block: int = BLOCK) -> DataFrame:
    """For each anchor and each of its positives, the best negatives within a window of scores.

    ``rows`` and ``anchors`` are (id, label, v) with whole-numbered v of one length, else it
    fails; anchors are among the rows. Positives are an anchor's ``positives`` best other rows of
    its label; negatives the ``negatives`` best rows of another label whose score is from ``low``
    to ``high`` percent of the positive's. Fewer, if there are fewer; none below a positive of
    negative score, whose window is empty. No rows give no rows.
    """
    rows = settle(rows)
    index = Index(rows, block)
    whole = (1 << 62) - 1
    anchors = settle(anchors)
    asks = anchors.select("id", "label", "v", F.lit(-1).cast("long").alias("positive_id"), F.lit(True).alias("same"), F.lit(-whole).alias("low"), F.lit(whole).alias("high"))
    best = settle(index.search(asks, positives))
    pairs = best.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    windows = anchors.join(pairs, F.col("id") == F.col("anchor_id")).select(
        "id", "label", "v", "positive_id", F.lit(False).alias("same"),
        F.expr(f"cast(ceil({low} * cast(positive_score as decimal(25,0)) / 100) as bigint)").alias("low"),
        F.expr(f"cast(floor({high} * cast(positive_score as decimal(25,0)) / 100) as bigint)").alias("high"),
    )
    found = index.search(settle(windows.filter("low <= high")), negatives)
    return found.join(pairs, ["anchor_id", "positive_id"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


NEGATIVES_SQL = """
with points as (
  select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    [floor(256 * cast(x as double)) for x in embedding] as v
  from embeddings where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0
    and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0
  qualify row_number() over (partition by vec_id order by label, v) = 1
), scored as (
  select a.id as anchor_id, r.id, a.label = r.label as same, cast(list_dot_product(a.v, r.v) as bigint) as score
  from points a join points r on a.id <> r.id where a.id % 100 = 0
), positives as (
  select anchor_id, id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
)
select anchor_id, positive_id, cast(row_number() over (partition by anchor_id, positive_id order by score desc, id) as integer) as rank,
  id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify rank <= 10
"""
