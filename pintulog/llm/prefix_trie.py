"""Prefix trie of conversations, from ternary search trees over range shards.

Turns are dictionary-encoded, so a conversation is a sequence of whole numbers. Sequences
are dealt by range into shards of bounded size, and each shard builds a ternary search tree
of its distinct sequences, inserting the median first, then those of the halves, so every
level is balanced. An iterative walk in post-order accumulates members, children, leaves and
savings of every node.

Only the nodes on the paths to a shard's first and last sequence can also be in another
shard: the boundary nodes. A shard knows the last sequence before it and the first one after
it, so it counts a node that the shard before also has as known there, and a sequence that
goes on in the next one as no leaf. With that, all figures of boundary nodes are sums over
shards. They are merged by the digest of their prefix; all other nodes are complete.

A very frequent conversation is cut by the ids of its members, like everything else. Its
digest of members is made from blocks of ids, one after another, without collecting them.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pintulog.llm.batches import bounded_batches
from pintulog.shared import settle

SHARD = 20_000  # turns and conversations per shard, about
BLOCK = 4096  # ids per block of a digest that spans shards
WORDS = r"[^\x20\x09-\x0D]+"

NODE = (
    "conv_id long, depth long, parent_id long, parent binary, prefix binary, n_convs long, n_children long, "
    "n_leaves long, saved long, ends_sha256 string, shard int, block int, ends string"
)


def numbered_turns(df: DataFrame) -> DataFrame:
    """(conv_id, position, role, text, turn_key) of each turn, positions from 1.

    Turns follow ``turn``, null first, then role and text. Null roles and texts are empty ones; rows
    without a conversation are left out, repeated rows are turns of their own.
    """
    filled = df.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    key = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    return filled.select("conv_id", F.row_number().over(order).cast("long").alias("position"), key.alias("turn_key"), F.regexp_count("text", F.lit(WORDS)).cast("long").alias("n_words"))


def rebuilt(turns: DataFrame, group: int = 20, longest: int = 4) -> DataFrame:
    """Conversations that share beginnings: (conv_id, position, turn_id, n_words), turnless ones with null position.

    Conversation c begins with the first h turns of conversation c - c % ``group`` and goes on with its
    own after its first h, h being the CRC-32 of its decimal number modulo ``longest``.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest
    ids = turns.select("conv_id").distinct().withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % group})
    own = turns.filter(F.col("position") > h).select("conv_id", "position", "turn_id", "n_words")
    # a base has fewer than `longest` such turns and at most 2 * group followers
    heads = turns.filter((F.col("conv_id") % group == 0) & (F.col("position") < longest)).select(F.col("conv_id").alias("base"), "position", "turn_id", "n_words")
    borrowed = ids.join(heads, "base").filter("position <= h")
    return own.unionByName(borrowed.select("conv_id", "position", "turn_id", "n_words")).unionByName(
        ids.select("conv_id", F.lit(None).cast("long").alias("position"), F.lit(None).cast("long").alias("turn_id"), F.lit(None).cast("long").alias("n_words"))
    )


def with_turn_ids(turns: DataFrame) -> DataFrame:
    """``turns`` with the dictionary number of each distinct turn as ``turn_id`` instead of its key."""
    words = settle(turns.groupBy("turn_key").agg(F.max("n_words").alias("n_words")).withColumn("turn_id", F.monotonically_increasing_id()))
    return turns.drop("n_words").join(words, "turn_key").drop("turn_key")


class Tree:
    """A ternary search tree of sequences, as arrays of its nodes; node 0 is the root's place."""

    def __init__(self) -> None:
        self.turn, self.low, self.high, self.first, self.parent = [0], [0], [0], [0], [-1]
        self.words, self.depth = [0], [0]

    def _new(self, turn: int, words: int, parent: int) -> int:
        self.turn.append(turn)
        self.words.append(words)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        for links in (self.low, self.high, self.first):
            links.append(0)
        return len(self.turn) - 1

    def insert(self, sequence: list[int], words: list[int]) -> list[int]:
        """The nodes of ``sequence``, the root's first, made where missing."""
        node, path = 0, [0]
        for turn, count in zip(sequence, words):
            links, place, at = self.first, node, self.first[node]
            while at and self.turn[at] != turn:
                links, place = (self.low if turn < self.turn[at] else self.high), at
                at = links[at]
            if not at:
                at = links[place] = self._new(turn, count, node)
            path.append(at)
            node = at
        return path


def medians(count: int) -> Iterator[int]:
    """0 to ``count`` - 1, each range's middle before its halves."""
    ranges = [(0, count)]
    while ranges:
        low, high = ranges.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            ranges += [(middle + 1, high), (low, middle)]


def _shared(a: list[int] | None, b: list[int] | None) -> int:
    """How many elements two sequences begin with alike; -1 where there is none."""
    if a is None or b is None:
        return -1
    same = 0
    while same < min(len(a), len(b)) and a[same] == b[same]:
        same += 1
    return same


def shard_nodes(shard: int, ids: np.ndarray, sequences: list[list[int]], words: list[list[int]], before: list[int] | None, after: list[int] | None) -> Iterator[tuple]:
    """Rows (as ``NODE``) of the nodes of one shard, its sequences in order, equal ones by id."""
    starts = [i for i in range(len(ids)) if not i or sequences[i] != sequences[i - 1]]
    ends = [*starts[1:], len(ids)]
    tree, paths = Tree(), [[] for _ in starts]
    for k in medians(len(starts)):
        paths[k] = tree.insert(sequences[starts[k]], words[starts[k]])
    size = len(tree.turn)
    members, least, own = [0] * size, [None] * size, [None] * size
    for k, path in enumerate(paths):
        members[path[-1]], least[path[-1]] = ends[k] - starts[k], int(ids[starts[k]])
        own[path[-1]] = k
    # nodes that a shard before has too, and whether a neighbour may have the node
    known, shared = [False] * size, [False] * size
    for node in paths[0][: _shared(sequences[0], before) + 1]:
        shared[node] = known[node] = True
    common = _shared(sequences[-1], after)
    for node in paths[-1][: common + 1]:
        shared[node] = True
    last, goes_on = paths[-1][-1], common == len(sequences[-1])
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    # insertion makes parents first, so the reverse order is a post-order
    for node in range(size - 1, -1, -1):
        if not tree.first[node] and not (node == last and goes_on):
            leaves[node] = 1
        saved[node] += (members[node] - (not known[node])) * tree.words[node]
        parent = tree.parent[node]
        if parent >= 0:
            members[parent] += members[node]
            if least[parent] is None or least[node] < least[parent]:
                least[parent] = least[node]
            children[parent] += not known[node]
            leaves[parent] += leaves[node]
            saved[parent] += saved[node]
    digests: dict[int, bytes] = {}

    def prefix(node: int) -> bytes:
        """Digest of the turns down to a shared node, chained along its path."""
        chain = []
        while node not in digests and node:
            chain.append(node)
            node = tree.parent[node]
        digest = digests.setdefault(node, b"")
        for node in reversed(chain):
            digest = digests[node] = hashlib.sha256(digest + tree.turn[node].to_bytes(8, "little", signed=True)).digest()
        return digest

    nothing = hashlib.sha256(b"").hexdigest()
    for node in range(size):
        parent = tree.parent[node]
        waits = parent >= 0 and shared[parent]
        texts, digest = [None], nothing
        if own[node] is not None:
            low, high = starts[own[node]], ends[own[node]]
            if shared[node]:
                texts = [",".join(map(str, ids[i : min(i + BLOCK, high)].tolist())) for i in range(low, high, BLOCK)]
            else:
                digest = hashlib.sha256(",".join(map(str, ids[low:high].tolist())).encode()).hexdigest()
        fixed = (least[node], tree.depth[node], None if waits or parent < 0 else least[parent], prefix(parent) if waits else None, prefix(node) if shared[node] else None)
        for block, text in enumerate(texts):
            # the figures go with the first block only, since they are summed
            figures = (members[node], children[node], leaves[node], saved[node]) if not block else (0, 0, 0, 0)
            yield (*fixed, *figures, None if shared[node] else digest, shard, block, text)


def _from_shards(group: pa.Table) -> pa.Table:
    shard, before, after = (group.column(c)[0].as_py() for c in ("shard", "before", "after"))
    ids, sequences, words = (group.column(c).to_pylist() for c in ("conv_id", "turns", "words"))
    order = sorted(range(len(ids)), key=lambda i: (sequences[i], ids[i]))
    rows = shard_nodes(shard, np.array(ids)[order], [sequences[i] for i in order], [words[i] for i in order], before, after)
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string()]
    columns = list(zip(*rows))
    return pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=[f.split()[0] for f in NODE.split(", ")])


def _joined_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined texts of each prefix, rows sorted by prefix, shard and block."""
    at, digest = None, None
    for batch in batches:
        done = []
        for prefix, text in zip(batch.column("prefix").to_pylist(), batch.column("ends").to_pylist()):
            if prefix != at or digest is None:
                if digest is not None:
                    done.append((at, digest.hexdigest()))
                at, digest = prefix, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(text.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], ["prefix", "ends_sha256"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([digest.hexdigest()], pa.string())], ["prefix", "ends_sha256"])


def in_shards(sequences: DataFrame, shard: int = SHARD) -> DataFrame:
    """``sequences`` with their shard and the sequences next to the shard's ends."""
    load = sequences.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    count = max(1, -(-load // shard))
    dealt = settle(sequences.repartitionByRange(count, "turns", "conv_id").withColumn("shard", F.spark_partition_id()))
    # one row per shard, whatever it holds, so this order needs no partitions
    ends = dealt.groupBy("shard").agg(F.min("turns").alias("lowest"), F.max("turns").alias("highest"))
    by_shard = Window.orderBy("shard")
    ends = ends.select("shard", F.lag("highest").over(by_shard).alias("before"), F.lead("lowest").over(by_shard).alias("after"))
    return dealt.join(ends, "shard")


def prefix_trie(turns: DataFrame, shard: int = SHARD) -> DataFrame:
    """One row per distinct prefix of the conversations in ``turns`` (conv_id, position, turn_id, n_words).

    conv_id: the smallest member; depth; parent_conv_id: that of the parent, null for the root; n_convs:
    conversations that begin with the prefix; n_children; n_leaves: childless nodes in its subtree, itself
    included; saved_tokens: over its subtree, each node's members but one times the words of its last turn;
    ends_sha256: digest of the members that end there, decimal, ascending, comma-joined.

    Rows with a null position only say that the conversation exists; one without turns ends at
    the root. No conversations give no rows, not even the root.
    """
    bounded_batches(turns.sparkSession)
    turn = F.when(F.col("position").isNotNull(), F.struct("position", "turn_id", "n_words"))
    gathered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("all"))
    sequences = gathered.select("conv_id", F.col("all.turn_id").alias("turns"), F.col("all.n_words").alias("words"))
    nodes = settle(in_shards(settle(sequences), shard).groupBy("shard").applyInArrow(_from_shards, NODE))
    figures = ["n_convs", "n_children", "n_leaves", "saved"]
    shared = nodes.filter("prefix is not null")
    blocks = shared.filter("ends is not null").select("prefix", "shard", "block", "ends")
    digests = blocks.repartition("prefix").sortWithinPartitions("prefix", "shard", "block").mapInArrow(_joined_digests, "prefix binary, ends_sha256 string")
    merged = settle(
        shared.groupBy("prefix", "depth")
        .agg(F.min("conv_id").alias("conv_id"), F.min("parent").alias("parent"), *[F.sum(c).alias(c) for c in figures])
        .join(digests, "prefix", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())))
    )
    above = merged.select(F.col("prefix").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", *figures, "ends_sha256"]
    complete = nodes.filter("prefix is null").withColumnRenamed("parent_id", "parent_conv_id")
    below = complete.filter("parent is not null").select("parent", *columns).drop("parent_conv_id").unionByName(
        merged.filter("parent is not null").drop("prefix")
    )
    root = merged.filter("parent is null").withColumn("parent_conv_id", F.lit(None).cast("long"))
    whole = (
        complete.filter("parent is null").select(*columns)
        .unionByName(below.join(above, "parent").select(*columns))
        .unionByName(root.select(*columns))
    )
    return whole.withColumnRenamed("saved", "saved_tokens")


def conversation_trie(df: DataFrame, shard: int = SHARD) -> DataFrame:
    """:func:`prefix_trie` of the conversations that :func:`rebuilt` makes of ``df`` (conv_id, turn, role, text)."""
    return prefix_trie(rebuilt(settle(with_turn_ids(settle(numbered_turns(df))))), shard)


# CRC-32 bit by bit over the bytes of the decimal number; prefixes are lists of turns.
TRIE_SQL = r"""
with recursive turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as place
  from conversations where conv_id is not null
), conv as (
  select conv_id, conv_id - conv_id % 20 as base, xor(4294967295, list_reduce(
    [4294967295] || list_transform(range(1, length(c) + 1), lambda i: ord(substr(c, i, 1))),
    lambda crc, byte: list_reduce([xor(crc, byte)] || range(8), lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)
  )) % 4 as h
  from (select distinct conv_id, cast(conv_id as varchar) as c from turns)
), rebuilt as (
  select c.conv_id, place, role, text from conv c join turns t on t.conv_id = c.conv_id and place > h
  union all select c.conv_id, place, role, text from conv c join turns t on t.conv_id = base and place <= h
), paths as (
  select conv_id, text, list({'role': role, 'text': text}) over (partition by conv_id order by place rows unbounded preceding) as path from rebuilt
  union all select conv_id, '', [] from conv
), ends as (
  select conv_id, path from paths qualify row_number() over (partition by conv_id order by len(path) desc) = 1
), nodes as (
  select path, len(path) as depth, min(conv_id) as conv_id, count(*) as n_convs,
    (count(*) - 1) * len(regexp_extract_all(any_value(text), '[^\x20\x09-\x0D]+')) as own
  from paths group by path
), children as (
  select path[:depth - 1] as path, count(*) as n_children from nodes where depth > 0 group by 1
), below as (
  select path[:k] as path, sum(own) as saved_tokens, count(*) filter (n_children is null) as n_leaves
  from (select n.path, own, n_children, unnest(range(0, depth + 1)) as k from nodes n left join children c on c.path = n.path) group by 1
), last as (
  select path, sha256(string_agg(cast(conv_id as varchar), ',' order by conv_id)) as ends_sha256 from ends group by path
)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(c.n_children, 0) as n_children, b.n_leaves,
  cast(b.saved_tokens as bigint) as saved_tokens, coalesce(l.ends_sha256, sha256('')) as ends_sha256
from nodes n left join nodes p on n.depth > 0 and p.path = n.path[:n.depth - 1]
  left join children c on c.path = n.path left join below b on b.path = n.path left join last l on l.path = n.path
"""
