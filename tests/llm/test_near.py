"""Near-duplicate operators, top-k and components against brute force."""

import itertools
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pintulog import shared
from pintulog.llm import cells, minhash, passages, topk, vectors, words
from pintulog.llm.components import components, merged

RNG = random.Random(9)
VOCABULARY = [f"w{i}" for i in range(4000)]


def prose(n):
    return " ".join(RNG.choice(VOCABULARY) for _ in range(n))


def edited(text, share, rng=RNG):
    return " ".join(w if rng.random() > share else rng.choice(VOCABULARY) for w in text.split(" "))


def brute_sets(text):
    found = (text or "").encode().lower().split()
    if len(found) < 5:
        return {b" ".join(found)} if found else set()
    return {b" ".join(found[i : i + 5]) for i in range(len(found) - 4)}


def brute_components(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(400 + i, 401 + i) for i in range(60)] + [(7, 7), (None, 3)]
    frame = spark.createDataFrame(edges, "x long, y long")
    real = [(a, b) for a, b in edges if a is not None and a != b]
    expected = brute_components({x for e in real for x in e}, real)
    assert {r.node: r.component for r in components(frame).collect()} == expected
    assert components(frame.limit(0)).count() == 0


def test_merging_more_edges_equals_starting_anew(spark):
    edges = [(1, 2), (3, 4), (9, 8)]
    more = [(2, 4), (1, 3), (1, 2), (10, 11), (12, 9)]
    first = components(spark.createDataFrame(edges, "a long, b long"))
    got = {r.node: r.component for r in merged(first, spark.createDataFrame(more, "a long, b long")).collect()}
    assert got == brute_components({x for e in edges + more for x in e}, edges + more)


def test_a_hub_with_most_edges(spark):
    frame = spark.range(1, 3000).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    assert components(frame).agg(F.max("component"), F.count("*")).first() == (0, 3000)


def test_cells_hold_every_pair_once(spark):
    rows = spark.range(50).select((F.col("id") % 2).alias("g"), F.lit(25).alias("size"), "id")
    dealt = cells.deal(rows, "g", "size", F.xxhash64("id"), block=8).collect()
    seen = []
    key = lambda r: (r.g, r.low, r.high)
    for (_, low, high), members in itertools.groupby(sorted(dealt, key=key), key=key):
        for x, y in itertools.combinations(sorted(members, key=lambda r: r.id), 2):
            if low == high or x.side != y.side:
                seen.append((x.id, y.id))
    assert sorted(seen) == sorted((a, b) for a, b in itertools.combinations(range(50), 2) if a % 2 == b % 2)


def test_words_are_cut_at_six_bytes_only():
    assert words.words("A b\x0bÉ\x85c d\x1ce") == ["a".encode(), "b".encode(), "É\x85c d\x1ce".encode()]
    assert len(words.shingle_set("one two three four")) == 1 and len(words.shingle_set(" \n")) == 0
    assert len(words.shingle_set("x " * 50)) == 1


def near_documents():
    base, other = prose(80), prose(60)
    texts = [base] * 5 + [edited(base, s) for s in [0.01, 0.02, 0.03, 0.03, 0.04, 0.05, 0.06, 0.08, 0.1] * 8]
    texts += [other, other + " tail", prose(3), "one two", "One  TWO", "", None, " \n", "solo"] + [prose(50) for _ in range(40)]
    return texts


@pytest.mark.parametrize("block", [512, 16])
def test_minhash_components_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(cells.deal, "__defaults__", (block,))
    texts = near_documents()
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, texts[0], None), (0, texts[0], "clash")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, component_id string")).collect()
    sets = [brute_sets(t) for t in texts]
    linked = [
        (a, b) for a, b in itertools.combinations(range(len(texts)), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    expected = brute_components(range(len(texts)), linked)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), expected[r.doc_id], expected[r.doc_id] == r.doc_id)
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_estimates_follow_the_similarity():
    a = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 2000, dtype=np.uint64))
    for shared in (0, 1000, 1800):
        b = np.r_[a[:shared], np.random.default_rng(2).integers(0, 1 << 63, 2000 - shared, dtype=np.uint64)]
        found = minhash.packed(minhash.minima([a, np.unique(b)], minhash.LONG))
        got = minhash.estimated(minhash.agreeing(found[:1], found[1:]), minhash.LONG)[0]
        assert abs(got - shared / (4000 - shared)) < 0.06


def test_agreement_is_the_same_in_the_jvm(spark):
    values = np.random.default_rng(3).integers(-(1 << 62), 1 << 62, (20, minhash.WORDS))
    values[10:] = values[:10]
    values[15, 0] ^= 1 << 40
    frame = spark.createDataFrame([(a.tolist(), b.tolist()) for a, b in zip(values[:10], values[10:])], "a array<long>, b array<long>")
    got = [r.n for r in frame.select(minhash.agreeing_sql(F.col("a"), F.col("b")).alias("n")).collect()]
    assert sorted(got) == sorted(minhash.agreeing(values[:10], values[10:]).tolist())


def unit(rng, n, dim):
    v = rng.standard_normal((n, dim))
    return v / np.linalg.norm(v, axis=1)[:, None]


@pytest.mark.parametrize("block", [512, 16])
def test_vector_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(cells.deal, "__defaults__", (block,))
    rng = np.random.default_rng(4)
    base = unit(rng, 1, 32)
    close = [base[0] + rng.standard_normal(32) * s for s in rng.uniform(0.0, 0.07, 90)]
    table = np.array([*unit(rng, 100, 32), *close, *([base[0] * 2] * 4)])
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(table)]
    odd = [(900, None), (901, []), (902, [0.0] * 32), (903, [float("nan")] * 32), (904, [float("inf")] + [1.0] * 31), (905, [None] + [1.0] * 31), (None, rows[0][1])]
    got = vectors.near_duplicates(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>"), 0.95).collect()
    assert len(got) == len(rows) + len(odd)
    n = table / np.linalg.norm(table, axis=1)[:, None]
    near = n @ n.T >= 0.95
    np.fill_diagonal(near, False)
    expected = brute_components(range(len(table)), [(a, b) for a, b in zip(*np.nonzero(near)) if a < b])
    right = sum(r.n_links == near[r.vec_id].sum() for r in got if r.vec_id is not None and r.vec_id < 900)
    assert right >= 0.97 * len(table)
    for r in got:
        if r.vec_id is None or r.vec_id >= 900:
            assert r.n_links == 0 and r.kept and r.component_id == r.vec_id
        else:
            assert r.component_id == expected[r.vec_id] and r.n_links <= near[r.vec_id].sum()


def test_tables_reach_the_recall():
    for count in (10, 10**5, 10**9):
        bits, tables = vectors.tables_for(count, 0.95)
        meet = (1 - np.arccos(0.95) / np.pi) ** bits
        assert 1 - (1 - meet) ** tables >= vectors.RECALL


def brute_topk(points, k, step):
    out = []
    for q, v in points.items():
        if q % step == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in points.items() if c != q)
            out += [(q, rank + 1, c, -s) for rank, (s, c) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("scale,bins", [(1, 4), (300, 512), (10**8, 64)])
def test_topk_equals_a_full_sort(spark, monkeypatch, scale, bins):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 16)
    rng = random.Random(scale)
    points = {i: [rng.randint(-2, 2) * scale for _ in range(6)] for i in range(60)}
    points |= {i: points[0] for i in (60, 61, 62)}
    frame = spark.createDataFrame(list(points.items()), "id long, v array<long>")
    got = topk.top_k(frame, frame.filter("id % 5 = 0"), 4, bins).collect()
    assert sorted(map(tuple, got)) == brute_topk(points, 4, 5)


def test_topk_with_few_candidates_and_odd_vectors(spark):
    rows = [(0, [0.5, -0.25]), (1, [0.1, 0.1]), (2, None), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, []), (None, [1.0, 1.0]), (0, [0.5, -0.25])]
    points = topk.fixed_point(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert sorted(tuple(r) for r in points.collect()) == [(0, [128, -64]), (1, [25, 25])]
    got = topk.top_k(points, points, 5).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 1600), (1, 1, 0, 1600)]
    assert topk.top_k(points.limit(0), points.limit(0), 5).count() == 0


def test_passages_are_cut_where_they_repeat(spark):
    passage, line = prose(70), prose(60)
    near = line.split(" ")
    near[3] = "changed"
    clean = [prose(120) for _ in range(8)]
    texts = clean + [
        f"{prose(40)} {passage} {prose(30)}", f"{prose(10)} {passage} {prose(50)}", f"{prose(90)} {passage}",
        f"{prose(30)}\n{line}\n{prose(20)}", f"{prose(25)}\n{' '.join(near)}", None, "", "short short", f"{prose(12)}\n" * 6, "é " * 300,
    ]
    rows = [(i, t, 7) for i, t in enumerate(texts)] + [(None, texts[8], 7)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, start int")
    spans = passages.repeats(frame)
    found = {(r.doc_id, r.kept_doc_id) for r in spans.collect()}
    assert found == {(9, 8), (10, 8), (12, 11)}
    left = {r.doc_id: r.text for r in passages.remove(frame, spans).collect()}
    assert len(left) == len(rows) and all(left[i] == t for i, t in enumerate(texts) if i not in (9, 10, 12))
    assert passage in left[8] and left[9].split() + left[10].split() == [w for i in (9, 10) for w in texts[i].replace(passage, "").split()]
    assert left[12] == texts[12].split("\n")[0]
    assert passages.repeats(frame.limit(0)).count() == 0


def test_removal_leaves_no_holes():
    raw = "aé bb cc\ndd ee\nff".encode()
    assert passages.without(raw, [(4, 2)]) == "aé cc\ndd ee\nff".encode()
    assert passages.without(raw, [(10, 5)]) == "aé bb cc\nff".encode()
    assert passages.without(raw, [(0, len(raw))]) == b""
    assert passages.without(raw, [(10, 2), (13, 2)]) == "aé bb cc\nff".encode()


@pytest.mark.parametrize("sizes", [[300], [0, 10, 60, 24, 25, 0, 3, 90], [24], [0]])
def test_texts_in_a_row_are_winnowed_as_alone(sizes):
    texts = [prose(n) if n else None if i else "" for i, n in enumerate(sizes)]
    every = passages.Words(texts)
    got = list(zip(*passages.winnowed(every.hashes, every.text)))
    expected = []
    for i, text in enumerate(texts):
        alone = passages.Words([text])
        shift = every.offset[i]
        expected += [(a + shift, b + shift, h, c) for a, b, h, c in zip(*passages.winnowed(alone.hashes, alone.text))]
    assert got == expected


def test_words_are_hashed_by_their_letters_alone(monkeypatch):
    texts = [f"{prose(40)} Ab aB AB ab ba é É {'x' * 255}Y {'x' * 255}y {'x' * 300}Y {'X' * 300}y {'x' * 301} \t\x0b", "ab\x00 ab \x00ab", " ", prose(300)]
    for step in (1 << 15, 40):
        monkeypatch.setattr(passages, "HASHED", step)
        w = passages.Words(texts)
        found = [x for t in texts for x in t.encode().lower().split()]
        assert len(w.hashes) == len(found) and len(set(w.hashes.tolist())) == len(set(found))
        assert len(set(zip(found, w.hashes.tolist()))) == len(set(found))
    assert len(passages.Words([None, ""]).hashes) == 0


def test_short_lines_are_joined_to_paragraphs():
    texts = ["\n".join(prose(n) for n in (30, 5, 6, 40, 7)) + "\n\n" + prose(8), f"{prose(3)}\r\n{prose(4)}\n \t\n{prose(2)}\n", prose(2)]
    w = passages.Words(texts)
    first, after = passages.paragraphs(w.raw, w.starts, w.text)
    assert (after - first).tolist() == [30, 11, 40, 7, 8, 7, 2, 2]
    assert first.tolist() == [0, *after[:-1].tolist()]


def brute_paragraphs(text):
    """(first word, words) of each paragraph, by walking over the lines."""
    out, at, open_run = [], 0, False
    for line in (text or "").split("\n"):
        found = line.lower().split()
        short = 0 < len(found) < passages.MIN_WORDS
        if found:
            if short and open_run:
                out[-1][1].extend(found)
            else:
                out.append([at, found])
        open_run = short
        at += len(found)
    return out


def test_near_copies_of_paragraphs_equal_brute_force(spark):
    rng, texts = random.Random(8), []
    for _ in range(60):
        words_ = prose(rng.randint(26, 140)).split(" ")
        for _ in range(rng.randint(2, 3)):
            copy = [w if rng.random() > rng.choice([0.0, 0.01, 0.03, 0.06]) else f"new{rng.random()}" for w in words_]
            width = rng.choice([9, 14, 500])
            body = "\n".join(" ".join(copy[k : k + width]) for k in range(0, len(copy), width))
            texts.append(rng.choice(["", f"{prose(40)}\n\n", f"{prose(6)}\n\n"]) + body + rng.choice(["", f"\n\n{prose(50)}", f"\n{prose(30)}"]))
    rng.shuffle(texts)
    units = [(i, at, w, {tuple(w[k : k + 5]) for k in range(len(w) - 4)}) for i, t in enumerate(texts) for at, w in brute_paragraphs(t) if len(w) >= passages.MIN_WORDS]
    links = [(x, y) for x in range(len(units)) for y in range(x) if 100 * len(units[x][3] & units[y][3]) >= 75 * len(units[x][3] | units[y][3])]
    part = brute_components(range(len(units)), links)
    expected = brute_repeats(texts)
    near = set()
    for x, (i, at, w, _) in enumerate(units):
        if min(units[y][0] for y in part if part[y] == part[x]) < i:
            near |= {(i, k) for k in range(at, at + len(w))}
    assert near - expected
    got = passages.repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    removed = set()
    for r in got:
        raw = texts[r.doc_id].encode()
        first = len(raw[: r.start].split())
        removed |= {(r.doc_id, x) for x in range(first, first + r.n_words)}
    assert removed == expected | near


def test_texts_that_share_an_id_are_cut_by_their_own_stretches(spark):
    passage = "é" * 3 + " " + prose(40)
    rows = [(1, passage, "x"), (2, f"{prose(30)} {passage}", "x"), (2, "é" * 60, "x"), (2, "é " * 60, "x"), (3, passage, "x"), (3, passage, "x"), (None, passage, "x"), (4, None, "x"), (4, passage, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, text_hash string")
    spans = passages.repeats(frame)
    left = [tuple(r) for r in passages.remove(frame, spans).collect()]
    assert len(left) == len(rows)
    one = {r.doc_id: r.text_hash for r in spans.collect()}
    assert set(one) - {2} == {3, 4} and len(spans.collect()) == len(one)
    for doc, text, _ in rows:
        if doc in (3, 4) and text:
            assert (doc, "", "x") in left
        elif doc != 2:
            assert (doc, text, "x") in left
    assert {t for d, t, _ in left if d == 2} - {t for d, t, _ in rows if d == 2} <= {rows[1][1].replace(" " + passage, "")}


def brute_repeats(texts, size=passages.MIN_WORDS):
    """(document, word) of each word in ``size`` words that a smaller document has too."""
    owner, out = {}, set()
    found = {i: (t or "").lower().split() for i, t in enumerate(texts)}
    for i, w in found.items():
        for k in range(len(w) - size + 1):
            owner.setdefault(tuple(w[k : k + size]), i)
    for i, w in found.items():
        for k in range(len(w) - size + 1):
            if owner[tuple(w[k : k + size])] < i:
                out |= {(i, x) for x in range(k, k + size)}
    return out


def test_every_repeated_stretch_of_enough_words_goes(spark):
    texts, common = [], prose(9)
    for n in [24, *range(25, 41)] * 3:
        passage = prose(n)
        texts += [f"{prose(60)} {passage} {prose(60)}", f"{prose(13)} {passage} {prose(40)}"]
    # the same shingles stand in other surroundings in smaller documents, and twice in the one that keeps the passage
    texts = [f"{prose(20)} {common} {prose(20)}" for _ in range(20)] + texts
    for k in (0, 8, 16):
        passage = f"{prose(k)} {common} {prose(16 - k)}".strip()
        texts += [f"{prose(20)} {common} {prose(30)} {passage} {prose(20)}", f"{prose(30)} {passage} {prose(30)}"]
    # periodic text, one piece with its surroundings
    for period in (1, 2, 3, 5):
        block = " ".join((prose(period).split() * 40)[:40])
        texts += [f"{prose(30)} {block} {prose(30)}", f"{prose(17)} {block} {prose(30)}"]
    texts += [" ".join(texts[60:64]), prose(24)]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = passages.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    removed = set()
    for r in got:
        raw = texts[r.doc_id].encode()
        first = len(raw[: r.start].split())
        assert len(raw[r.start : r.start + r.length].split()) == r.n_words and r.kept_doc_id < r.doc_id
        removed |= {(r.doc_id, x) for x in range(first, first + r.n_words)}
    assert removed == brute_repeats(texts)


def test_vectors_of_unequal_lengths_are_refused(spark):
    frame = spark.createDataFrame([(0, [1.0, 2.0]), (50, [1.0, 2.0, 3.0, 4.0]), (2, [3.0, 1.0, 2.0])], "vec_id long, embedding array<double>")
    points = topk.fixed_point(frame)
    with pytest.raises(ValueError, match="vectors have 2 to 4 components"):
        topk.top_k(points, points.filter("id % 50 = 0"))
    with pytest.raises(ValueError, match="vectors have 2 to 4 components"):
        vectors.near_duplicates(frame)


def test_windows_are_gone_from_disk_before_paragraphs_are_signed(spark, monkeypatch):
    tables, seen = [], []

    def settle(df):
        there = [t.columns for t in tables if all(os.path.exists(f.removeprefix("file://")) for f in t.inputFiles())]
        seen.append((df.columns, there))
        tables.append(shared.settle(df))
        return tables[-1]

    monkeypatch.setattr(passages, "settle", settle)
    run = " ".join(f"w{i}" for i in range(60))
    frame = spark.createDataFrame([(1, run), (2, f"x {run}"), (3, f"y {run}\n{run}")], "doc_id long, text string")
    assert {r.doc_id for r in passages.repeats(frame).collect()} == {2, 3}
    signing = [there for columns, there in seen if "bands" in columns]
    assert signing
    for columns in [c for there in signing for c in there] + [c for c, _ in seen if "bands" in c]:
        assert "context" not in columns


def test_batches_of_long_sets_are_bounded_by_bytes(spark):
    """What confirms pairs gets two full sets a row, however long the documents are."""
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], ["bytes", "rows"])

    minhash.signatures(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    pairs = spark.range(0, 40, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("left"), F.repeat(F.lit("y"), 1 << 20).alias("right"))
    seen = pairs.mapInArrow(sizes, "bytes long, rows long").collect()
    assert sum(r.rows for r in seen) == 40 and max(r.bytes for r in seen) <= 12 << 20
