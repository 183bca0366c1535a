"""Prefix tries against a plain walk over all prefixes, whatever the shards."""

import collections
import hashlib
import random
import re
import zlib

import pytest

from pintulog.llm import prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, shard string"


def told(rows):
    """The rebuilt conversations of ``rows``, by id."""
    turns = collections.defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(found)] for c, found in turns.items()}
    out = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(base, [])[:h] + mine[h:]
    return out


def brute(conversations):
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = collections.Counter(path[:-1] for path in members if path)
    words = {path: len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0 for path in members}
    rows = set()
    for path, found in members.items():
        below = [p for p in members if p[: len(path)] == path]
        rows.add((
            min(found), len(path), min(members[path[:-1]]) if path else None, len(found), children[path],
            sum(not children[p] for p in below), sum((len(members[p]) - 1) * words[p] for p in below),
            hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest(),
        ))
    return rows


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(-25, 45), 1000, 10**12, 10**12 + 3]:
        for turn in range(rng.choice([0, 1, 1, 2, 3, 5, 9])):
            rows.append((c, rng.choice([turn, turn, None]), rng.choice(["user", None, ""]), rng.choice(["a b", "a", "", None, " x\ty\u00a0z "]), "x"))
    rows += [(c, t, "user", "all the same", "x") for c in range(100, 160) for t in range(2)]
    rows += [(None, 0, "user", "no conversation", "x"), (3, 1, "user", "a", "x"), (3, 1, "user", "a", "x")]
    return rows


@pytest.mark.parametrize("shard", [2, 9, 40, prefix_trie.SHARD])
def test_every_prefix_is_a_node_whatever_the_shards(spark, shard, monkeypatch):
    rows = random_rows(shard)
    found = prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA), shard).select(*COLUMNS).collect()
    expected = brute(told(rows))
    assert len(found) == len(expected)
    assert {tuple(r) for r in found} == expected


def test_members_of_a_frequent_end_come_in_blocks(spark, monkeypatch):
    rows = [(c, 0, "user", "one", "x") for c in range(300)]
    conversations = told(rows)
    for block in (1, 7):
        monkeypatch.setattr(prefix_trie, "BLOCK", block)
        sequences = [(c, [5] * len(t), [1] * len(t)) for c, t in sorted(conversations.items())]
        order = sorted(sequences, key=lambda s: (s[1], s[0]))
        halves = [order[:100], order[100:130], order[130:]]
        parts = []
        for i, half in enumerate(halves):
            before = halves[i - 1][-1][1] if i else None
            after = halves[i + 1][0][1] if i < 2 else None
            ids, turns, words = zip(*half)
            parts += prefix_trie.shard_nodes(i, prefix_trie.np.array(ids), list(turns), list(words), before, after)
        texts = collections.defaultdict(list)
        for row in sorted(parts, key=lambda r: (r[10], r[11])):
            if row[12] is not None:
                texts[row[1]].append(row[12])
        for depth, found in texts.items():
            assert ",".join(found) == ",".join(str(c) for c, t in sorted(conversations.items()) if len(t) == depth)


def test_medians_balance_the_tree():
    order = list(prefix_trie.medians(1000))
    assert sorted(order) == list(range(1000))
    tree = prefix_trie.Tree()
    for k in order:
        tree.insert([k], [1])
    height = {tree.first[0]: 1}
    for node in range(1, len(tree.turn)):
        for child in (tree.low[node], tree.high[node]):
            if child:
                height[child] = height[node] + 1
    assert max(height.values()) <= 10


def test_no_rows_and_turnless_conversations(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie.conversation_trie(spark.createDataFrame([(None, 0, "user", "x", "")], SCHEMA)).count() == 0
    rows = [(c, 0, "user", "gone", "") for c in range(21, 30)]
    found = prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA)).select(*COLUMNS).collect()
    assert {tuple(r) for r in found} == brute(told(rows))


def test_one_long_conversation(spark):
    rows = [(40, t, "user", f"turn {t % 7}", "") for t in range(3000)]
    found = {r.depth: r for r in prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(found) == 3001
    assert all(found[d].n_leaves == 1 and found[d].saved_tokens == 0 and found[d].n_children == (d < 3000) for d in found)
