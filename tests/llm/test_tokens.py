"""BPE, packing and token counts against the tokenizers library and by exact round trips."""

import collections
import hashlib
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pintulog.llm import bpe, packing, transducer

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

ODD = [
    None, "", " ", "a" * 5000, "don't I'll '' ''s !'s we've it's'll", "x<|endoftext|>y <|startoftext|>", "É́ΣΑΣ ΣΑΣ. İstanbul ǅ ß ﬁ",
    "x\x1cy\x85z　k​", "漢字かな交じり 12345 ½ ٣", "ab" * 3000 + "!?" * 2000, "😀😁 ok 🇫🇷", " \n\t  \r\n a  b", "tie", "tie",
]


def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def byte_bpe():
    return library(BYTE_BPE)


@pytest.fixture
def documents(spark):
    rows = [(i, text, "clash") for i, text in enumerate(ODD)] + [(3, "a" * 5000, "clash"), (None, "no id", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_tree_concatenation_equals_the_library(byte_bpe):
    coder = bpe.codec(BYTE_BPE)
    rng = random.Random(3)
    parts = ["a", "b", "th", " ", "  ", "\n", "'s", "'ll", "!", "''", "é", "漢", "1", "23", "\t", "<|endoftext|>", "e", "ing", "\r\n", "😀", "x" * 7]
    for _ in range(600):
        some = rng.choice([parts, parts[:3], ["a"], ["a", "e"], ["ab", " "], [" ", "\n"], ["!", "'", "s"], ["é", "漢"], ["1", "23"]])
        text = "".join(rng.choice(some) for _ in range(rng.randint(0, 160)))
        expected = ids_of(byte_bpe, text)
        for leaf in (3, 11, 40):
            assert coder.encode_long(text, leaf).tolist() == expected
        assert coder.decode(np.array(expected, np.uint32)) == byte_bpe.decode(expected, skip_special_tokens=False)


@pytest.mark.parametrize("leaf", [7, bpe.LEAF])
def test_encoding_rows_keeps_them_and_equals_the_library(spark, documents, byte_bpe, leaf):
    coded = bpe.decode(bpe.encode(documents, BYTE_BPE, leaf=leaf), BYTE_BPE)
    assert coded.columns == ["doc_id", "text", "ids", "decoded"]
    rows = coded.collect()
    assert len(rows) == documents.count()
    for row in rows:
        assert np.frombuffer(row.ids, "<u4").tolist() == ids_of(byte_bpe, row.text)
        assert row.decoded == (row.text or "")
    digests = {r.doc_id: r for r in bpe.document_digests(documents, BYTE_BPE).collect()}
    expected = np.array(ids_of(byte_bpe, ODD[4]), "<u4")
    assert digests[4].ids_sha256 == hashlib.sha256(expected.tobytes()).hexdigest()
    assert digests[4].decoded_sha256 == hashlib.sha256(ODD[4].encode()).hexdigest()


def test_no_rows_give_no_rows(spark, documents):
    empty = documents.limit(0)
    assert bpe.document_digests(empty, BYTE_BPE).count() == 0
    assert packing.pack(packing.pieces(empty, BYTE_BPE)).count() == 0
    assert transducer.document_counts(empty, WORD_BPE).count() == 0


def test_unfinished_bytes_are_replaced():
    coder = bpe.codec(BYTE_BPE)
    half = coder.encode("漢")[:1]
    assert coder.decode(half) == coder.raw(half).decode("utf-8", "replace")


def test_best_fit_takes_the_tightest_window():
    still = packing.OpenWindows(100)
    for window, capacity in enumerate((40, 10, 25)):
        still.put(window, capacity)
    assert still.tightest(20) == 25 and still.tightest(26) == 40 and still.tightest(41) is None
    assert still.take(25) == 2 and still.tightest(20) == 40
    window, offset, made = packing.best_fit(np.array([60, 30, 40, 70, 100]), 100)
    assert made == 3 and window[4] not in window[:4]
    assert window[3] == window[1] and window[0] == window[2] and offset[1] == 70


def test_best_fit_equals_a_plain_search():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 64, 500)
    window, offset, made = packing.best_fit(lengths, 64)
    room: list[int] = []
    for length in sorted(lengths.tolist(), reverse=True):
        fits = [r for r in room if r >= length]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - length)
        else:
            room.append(64 - length)
    assert made == len(room)
    for w in range(made):
        ends = sorted((o, o + n) for o, n in zip(offset[window == w], lengths[window == w]))
        assert ends[0][0] == 0 and ends[-1][1] <= 64 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))


def test_pieces_cover_every_document_once(spark, documents, byte_bpe):
    rows = packing.pack(packing.pieces(documents, BYTE_BPE, window=16), 16, group=5).collect()
    by_doc, windows = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        windows[r.sequence_id].append((r.offset, r.length))
    for places in windows.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 16
    for doc, text in enumerate(ODD):
        ids = np.array([*ids_of(byte_bpe, text), 1], "<u4")
        copies = 2 if doc == 3 else 1
        assert sum(r.length for r in by_doc[doc]) == copies * len(ids)
        for r in by_doc[doc]:
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length])
    assert by_doc[None]


def test_equal_pieces_are_dealt_over_all_groups(spark):
    equal = spark.range(0, 4000, 1, 3).select(F.lit(None).cast("long").alias("doc_id"), F.lit(3).cast("long").alias("length"))
    rows = packing.pack(equal, 16, group=100).collect()
    sizes = collections.Counter(r.sequence_id >> 32 for r in rows)
    assert len(rows) == 4000 and len(sizes) == 40 and max(sizes.values()) < 200
    offsets = collections.defaultdict(list)
    for r in rows:
        offsets[r.sequence_id].append(r.offset)
    assert all(sorted(o) == list(range(0, 3 * len(o), 3)) and len(o) <= 5 for o in offsets.values())


def test_counts_equal_the_library(spark, documents):
    words = library(WORD_BPE)
    rows = transducer.document_counts(documents, WORD_BPE, limit=3).collect()
    assert len(rows) == documents.count()
    texts = {i: t or "" for i, t in enumerate(ODD)} | {None: "no id"}
    for row in rows:
        text = texts[row.doc_id]
        assert (row.n_bytes, row.n_tokens) == (len(text.encode()), len(ids_of(words, text)))
        assert row.over_limit == (row.n_tokens > 3)


def test_random_words_count_as_in_the_library():
    words, rng = library(WORD_BPE), random.Random(5)
    letters = "etaoinshrdlucmfwypvbgkqjxz'-.,!0123456789éß漢 \n"
    texts = ["".join(rng.choice(letters[: rng.choice([2, 8, 30, len(letters)])]) for _ in range(rng.randint(0, 900))) for _ in range(300)]
    expected = [len(ids_of(words, t)) for t in texts]
    assert transducer.count_texts(texts, WORD_BPE).tolist() == expected


@pytest.mark.parametrize(("chunk", "warm"), [(9, 1), (1, 1), (7, 40), (256, 64)])
def test_chunk_maps_compose_to_the_sequential_walk(monkeypatch, chunk, warm):
    monkeypatch.setattr(transducer, "CHUNK", chunk)
    monkeypatch.setattr(transducer, "WARM_UP", warm)
    words, rng = library(WORD_BPE), random.Random(chunk)
    texts = ["a" * 997, "lorem" * 200, "ab" * 5 + "xyz" * 300, "the quick brown fox", "", "ha" * 700, "".join(rng.choices("etaoins", k=1500)), "漢" * 300]
    counts = transducer.count_texts(texts, WORD_BPE).tolist()
    assert counts == [len(ids_of(words, t)) for t in texts]
    machine = transducer.transducer(WORD_BPE)
    for text, count in zip(texts, counts, strict=True):
        symbols, _ = transducer.word_symbols([text])
        key, total = machine.states[transducer.START], 0
        for symbol in symbols.tolist():
            key, change = machine.step(key, symbol)
            total += change
        assert total == count


def test_every_exit_is_an_entry_of_the_next_map(monkeypatch):
    monkeypatch.setattr(transducer, "CHUNK", 16)
    machine = transducer.Transducer(WORD_BPE)
    symbols, offsets = transducer.word_symbols(["haha" * 200 + " some words " + "lorem" * 90])
    starts = np.arange(0, offsets[1], 16)
    ends = np.minimum(starts + 16, offsets[1])
    first, last = starts == 0, ends == offsets[1]
    pairs, exits, _ = machine.maps(symbols, starts, ends, first, last)
    inner = ~last[pairs >> 32]
    assert np.isin(((pairs[inner] >> 32) + 1) << 32 | exits[inner], pairs).all()
    assert len(pairs) > len(starts)


def test_time_of_a_long_periodic_word_grows_with_its_length():
    transducer.count_texts(["ha" * 4000], WORD_BPE)
    took = []
    for size in (50_000, 200_000):
        begun = time.process_time()
        transducer.count_texts(["ha" * size], WORD_BPE)
        took.append(time.process_time() - begun)
    assert took[1] < 12 * took[0] + 0.5


def test_a_full_automaton_starts_anew(monkeypatch):
    monkeypatch.setattr(transducer, "MAX_STATES", 1)
    words = library(WORD_BPE)
    for text in ("hello world", "entirely different"):
        assert transducer.count_texts([text], WORD_BPE).tolist() == [len(ids_of(words, text))]
