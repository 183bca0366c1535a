"""Connected components of an undirected graph by alternating star contraction.

Each round moves edges towards the smallest neighbour: the large-star step links every
larger neighbour of a node to the smallest node in its neighbourhood, the small-star step
does the same for smaller neighbours. The edge set never grows, and after about log^2 n
rounds it is one star per component. Both steps take a minimum per node, which combines
before its shuffle, and join it back to the edges; no neighbourhood is ever gathered, so a
node with a third of all edges is no hot task. Rounds end in a table in shared storage.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pintulog.shared import drop_settled, free_shuffles, settle

def lookup(rows: DataFrame, table: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table`` on ``key``, unique in ``table``, however often it recurs in ``rows``.

    The hash of the key joins along, so that neither side keeps the partitioning of an
    earlier aggregation: both are dealt for this join, and adaptive execution can split
    the rows of a hot key over several tasks.
    """
    hashed = F.xxhash64(key).alias("__hash")
    return rows.select("*", hashed).join(table.select("*", hashed), [key, "__hash"], how).drop("__hash")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (a, b), a > b."""
    if large:
        both = edges.union(edges.select(F.col("b"), F.col("a"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        moved = lookup(both.filter("v > u"), least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        own = edges.toDF("u", "v")
        least = own.groupBy("u").agg(F.min("v").alias("m"))
        moved = lookup(own, least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        moved = moved.union(least.toDF("a", "b"))
    return moved.filter("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node on an edge; the component is its smallest node.

    ``edges`` has two columns of one orderable type; direction, repeats, loops and nulls
    do not matter. A node on a loop alone does not appear. No edges give no rows.
    """
    a, b = edges.columns
    clean = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("a") != F.col("b"))
    ).distinct()
    now = settle(clean)
    state = _state(now)
    while state[0]:
        after = settle(_star(_star(now, True), False))
        drop_settled(now)
        free_shuffles(now.sparkSession)
        now, before, state = after, state, _state(after)
        if before == state:
            break
    found = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.union(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component) after ``edges`` (a, b) joined the components ``labels`` says.

    Edges count once per pair of components, however many there are between the two,
    and those within a component not at all.
    """
    edges = edges.select("a", "b")
    for end in ("a", "b"):
        known = labels.select(F.col("node").alias(end), F.col("component").alias(f"c{end}"))
        edges = lookup(edges, known, end, "left").withColumn(f"c{end}", F.coalesce(f"c{end}", end))
    edges = settle(edges)
    ends = edges.select(F.col("a").alias("node"), F.col("ca").alias("component")).union(edges.select("b", "cb"))
    joined = components(edges.filter("ca <> cb").select("ca", "cb").distinct())
    joined = joined.select(F.col("node").alias("component"), F.col("component").alias("after"))
    found = lookup(labels.union(ends).distinct(), joined, "component", "left")
    after = settle(found.select("node", F.coalesce("after", "component").alias("component")))
    drop_settled(edges)
    return after
