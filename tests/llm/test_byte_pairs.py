"""Byte-level BPE by recursive queries against the tiktoken library and by exact round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from pintulog.llm import byte_pairs

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = [
    None, "", " ", "a" * 5000, "ha" * 700, "don't I'll '' ''s !'s", "x<|endoftext|>y", "ΣΑΣ. İstanbul ǅ ß ﬁ", "x\x1cy\x85z　k​",
    "漢字かな交じり 12345 ½ ٣", "ab" * 900 + "!?" * 800, "😀😁 ok 🇫🇷", " \n\t  \r\n a  b", "tie", "tie", "".join(map(chr, range(0x550, 0x9FF))),
    "a࢏b c\U0001dff0d \U00016d80\U00011de0", " ".join(f"w{i}q{i * i}z" for i in range(3000)),
]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_pairs.read_ranks(PATH), special_tokens={})


@pytest.fixture
def documents(spark):
    rows = [(i, text, "clash") for i, text in enumerate(ODD)] + [(3, "a" * 5000, "clash"), (None, "no id", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


def test_words_of_every_length_equal_the_library(library):
    coder = byte_pairs.codec(PATH, public_tokenizers.PATTERN)
    rng = random.Random(5)
    words = set()
    for letters in ("ab", "a", "the", "abcdefghijklmnopqrstuvwxyz", "éèàaçtni", "漢字語a", "!?=", "0123"):
        for length in (1, 2, 3, 7, 30, 255, 256, 257, 600, 1500):
            words.add("".join(rng.choice(letters) for _ in range(length)))
    words = sorted(words)
    coder.learn(set(words) - set(coder.tokens))
    for word in words:
        expected = [x for m in [word] for x in library.encode_ordinary(m)]
        assert np.frombuffer(coder.known[word], "<u4").tolist() == expected, word[:40]


def test_characters_count_as_in_the_library(library):
    coder = byte_pairs.codec(PATH, public_tokenizers.PATTERN)
    chars = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x110000)]]
    rng = random.Random(6)
    texts = [f"a{c}b 1{c}2{c} ." for c in rng.sample(chars, 4000)]
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), repr(text)


def test_long_texts_are_encoded_in_stretches(library, monkeypatch):
    coder = byte_pairs.codec(PATH, public_tokenizers.PATTERN)
    text = "don't stop   now \n " * 400
    monkeypatch.setattr(byte_pairs, "CHARS", 100)
    monkeypatch.setattr(byte_pairs, "MATCHES", 7)
    monkeypatch.setattr(byte_pairs, "TOKENS", 11)
    ids = coder.encode(["ahead", text, text, ""])
    assert np.frombuffer(ids[1], "<u4").tolist() == library.encode_ordinary(text)
    assert ids[2] == ids[1]
    assert coder.decode(ids) == [b"ahead", text.encode(), text.encode(), b""]


def test_forgetting_words_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(byte_pairs, "MAX_WORDS", 3)
    coder = byte_pairs.codec(PATH, public_tokenizers.PATTERN)
    texts = ["qwxz zzyq ppqx", "zzyq blorpf xxyyq", "qwxz"]
    for _ in range(2):
        for text in texts:
            assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == library.encode_ordinary(text)


def test_rows_stay_and_equal_the_library(spark, documents, library):
    coded = byte_pairs.decode(byte_pairs.encode(documents, PATH), PATH)
    assert coded.columns == ["doc_id", "text", "ids", "decoded"]
    rows = coded.collect()
    assert len(rows) == documents.count()
    for row in rows:
        assert np.frombuffer(row.ids, "<u4").tolist() == library.encode_ordinary(row.text or "")
        assert bytes(row.decoded).decode() == (row.text or "")
    digests = {r.doc_id: r for r in byte_pairs.document_digests(documents, PATH).collect()}
    expected = np.array(library.encode_ordinary(ODD[5]), "<u4")
    assert digests[5].n_tokens == len(expected)
    assert digests[5].ids_sha256 == hashlib.sha256(expected.tobytes()).hexdigest()
    assert digests[5].decoded_sha256 == hashlib.sha256(ODD[5].encode()).hexdigest()


def test_no_rows_give_no_rows_and_unknown_ids_fail(spark, documents):
    assert byte_pairs.document_digests(documents.limit(0), PATH).count() == 0
    with pytest.raises(ValueError, match="no token has the id 60000"):
        byte_pairs.codec(PATH, public_tokenizers.PATTERN).decode([np.array([60000], "<u4").tobytes()])
