"""Token counts by a finite-state transducer compiled from a word-level BPE vocabulary.

The tokenizer has no state beyond the current word, and inside a word the merge table is
finite, so counting tokens is a walk through a deterministic automaton. Its alphabet are
bytes, each in two forms: inside a word and ending one. A state holds what later bytes can
still change: each split point of the word so far from which a longer entry may still
follow, the token that ends there and its count relative to the end. A transition is annotated with the change of the token count; the sum over a text is its
token count. States and transitions are compiled when first met and kept per worker up to
``MAX_STATES``, then compiled anew, so memory is bounded and no result depends on it.

A text is cut into chunks of equal length wherever they fall. Each chunk becomes a map: for
every state it may be entered in, the state it is left in and the tokens on the way. Behind
a chunk that holds a word end this is one state, known from the bytes since. Inside a longer
word it is a set: what runs from each of the last ``longest`` bytes lead to, and any exit of
the chunk before that is not among them, until the sets are closed. So each map covers all
exits of the one before. The maps are composed by a parallel scan: each round doubles the
number of chunks that a composed map spans, and the map over a whole text, applied to the
start state, gives its count. All chunks of a text are in one task.

The split of a word into tokens is unique: a sequence of tokens is the encoding of its
text exactly if each adjacent pair is the encoding of that pair. So the token that ends at
a position is the one entry compatible with the token before it.
"""

import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pintulog.llm.batches import bounded_batches, slices

MAX_STATES = 150_000
MAX_PAIRS = 150_000
FEW = 12
NEVER = 1 << 30
CHUNK = 256
WARM_UP = 64
START = 0

# White space as Unicode defines it, and the contractions of the pattern.
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3


@lru_cache(1)
def char_classes() -> np.ndarray:
    """Letter, number, white space or other for every code point."""
    kinds = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x110000):
        major = unicodedata.category(chr(code))[0]
        if major == "L":
            kinds[code] = LETTER
        elif major == "N":
            kinds[code] = NUMBER
    kinds[WHITE_SPACE] = SPACE
    return kinds


def byte_symbols() -> dict[str, int]:
    """Byte of each character in which byte-level vocabularies write bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Transducer:
    """Counts tokens of words given as symbols: byte, or 256 + byte for a word's last.

    In here a token or part of a word is a string with one character per symbol.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        self.specials = [x["content"] for x in model["added_tokens"]]
        suffix = model["model"]["end_of_word_suffix"]
        to_byte = byte_symbols()

        def symbols(token: str) -> str:
            last = token.endswith(suffix)
            values = [to_byte[c] for c in (token[: -len(suffix)] if last else token)]
            return "".join(map(chr, [*values[:-1], values[-1] + 256 * last]))

        self.rank: dict[tuple[str, str], int] = {}
        for i, pair in enumerate(model["model"]["merges"]):
            left, right = map(symbols, pair if isinstance(pair, list) else pair.split(" "))
            self.rank.setdefault((left, right), i)
        vocabulary = {symbols(x) for x in model["model"]["vocab"] if x not in self.specials}
        self.tokens = {x: x for x in vocabulary if self.encode(x) == [x]}
        self.longest = max(map(len, self.tokens))
        self.begun: dict[str, list[str] | None] = {}  # by prefix: the entries, None if they are many
        for token in sorted(self.tokens):
            for k in range(1, len(token)):
                found = self.begun.setdefault(token[:k], [])
                if found is not None:
                    found.append(token)
                    if len(found) > FEW:
                        self.begun[token[:k]] = None
        self.fits: dict[tuple[str, str], bool] = {}
        self.forget()

    def forget(self) -> None:
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.column = np.full(512, -1, np.int32)
        self.columns = 0
        self.next = np.full((1024, 64), -1, np.int32)
        self.emit = np.zeros((1024, 64), np.int8)
        self.state_of((("", None, 0),))

    def encode(self, word: str) -> list[str]:
        """Plain merging, lowest rank first and leftmost among equals."""
        parts, rank = list(word), self.rank.get
        while len(parts) > 1:
            ranks = [rank(pair, NEVER) for pair in zip(parts, parts[1:])]
            best = min(ranks)
            if best == NEVER:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def compatible(self, left: str, right: str) -> bool:
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) > MAX_PAIRS:
                self.fits.clear()
            known = self.fits[left, right] = self.encode(left + right) == [left, right]
        return known

    def open(self, begun: str, last: str | None) -> bool:
        """Whether some entry that starts with ``begun`` can follow ``last``."""
        if begun not in self.begun:
            return False
        entries = self.begun[begun]
        return entries is None or last is None or any(self.compatible(last, x) for x in entries)

    def state_of(self, key: tuple) -> int:
        number = self.number.get(key)
        if number is None:
            number = self.number[key] = len(self.states)
            self.states.append(key)
            if number == len(self.next):
                grown = max(number + 1024, number * 5 // 4)
                self.next = np.vstack([self.next, np.full((grown - number, self.next.shape[1]), -1, np.int32)])
                self.emit = np.vstack([self.emit, np.zeros((grown - number, self.emit.shape[1]), np.int8)])
        return number

    def step(self, key: tuple, symbol: int) -> tuple[tuple, int]:
        """The state after ``symbol`` and the change of the token count.

        A state lists the split points that matter: the bytes since, the token that ends
        there (None at the start of the word), and its count less that of the end.
        """
        letter, found = chr(symbol), None
        for begun, last, count in key:
            token = self.tokens.get(begun + letter)
            if token is not None and (last is None or self.compatible(last, token)):
                found = token, count + 1
                break
        if found is None:
            raise ValueError(f"no vocabulary entry ends at byte {symbol % 256}")
        token, total = found
        if symbol >= 256:
            return self.states[START], total
        after = [(begun + letter, last, count - total) for begun, last, count in key if self.open(begun + letter, last)]
        return (*after, ("", token, 0)), total

    def compile(self, states: np.ndarray, symbols: np.ndarray) -> None:
        """Add the transitions of these pairs."""
        for state, symbol in {*zip(states.tolist(), symbols.tolist(), strict=True)}:
            if self.column[symbol] < 0:
                self.column[symbol] = self.columns
                self.columns += 1
                if self.columns > self.next.shape[1]:
                    more = (len(self.next), 16)
                    self.next = np.hstack([self.next, np.full(more, -1, np.int32)])
                    self.emit = np.hstack([self.emit, np.zeros(more, np.int8)])
            key, change = self.step(self.states[state], symbol)
            target = self.state_of(key)
            self.next[state, self.column[symbol]] = target
            self.emit[state, self.column[symbol]] = change

    def run(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exit state and count of each chunk, all chunks one symbol further at each step."""
        order = np.argsort(starts - ends, kind="stable")
        at, left = starts[order], (ends - starts)[order]
        state, count = entries[order].astype(np.int32), np.zeros(len(order), np.int64)
        active = np.searchsorted(-left, -np.arange(left[0] if len(left) else 0), side="left")
        for step, n in enumerate(active.tolist()):
            read = symbols[at[:n] + step]
            columns, now = self.column[read], state[:n]
            target = np.where(columns >= 0, self.next[now, columns], -1)
            if (missing := target < 0).any():
                self.compile(now[missing], read[missing])
                columns = self.column[read]
                target = self.next[now, columns]
            count[:n] += self.emit[now, columns]
            state[:n] = target
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return state[back], count[back]

    def entries(self, symbols: np.ndarray, chunks: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Pairs of a chunk and a state it may be entered in, as sorted ``chunk << 32 | state``.

        The last word end before a chunk fixes its state. If it is far, runs from each of the
        ``longest`` places before the warm-up give states, one of them begins at a split.
        """
        ended = np.flatnonzero(symbols >= 256) + 1
        before = np.searchsorted(ended, starts, side="right") - 1
        word = np.where(before >= 0, ended[before], 0)
        far = starts - word > WARM_UP
        back = np.maximum(starts[far, None] - WARM_UP - np.arange(self.longest), word[far, None])
        begin = np.r_[word[~far], back.ravel()]
        end = np.r_[starts[~far], np.repeat(starts[far], self.longest)]
        owner = np.r_[chunks[~far], np.repeat(chunks[far], self.longest)]
        states, _ = self.run(symbols, begin, end, np.full(len(begin), START, np.int32))
        return np.unique(owner << 32 | states)

    def maps(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The map of every chunk over its closed set of entries: pairs, and the exit and count of each."""
        due = np.union1d(np.flatnonzero(first) << 32 | START, self.entries(symbols, np.flatnonzero(~first), starts[~first]))
        pairs, exits, counts = np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int64)
        while len(due):
            chunk = due >> 32
            left, made = self.run(symbols, starts[chunk], ends[chunk], due & 0xFFFFFFFF)
            pairs, exits, counts = np.r_[pairs, due], np.r_[exits, left], np.r_[counts, made]
            inner = ~last[chunk]
            due = np.setdiff1d((chunk[inner] + 1) << 32 | left[inner], pairs)
        order = np.argsort(pairs)
        return pairs[order], exits[order], counts[order]

    def count(self, symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Token count of each text; text i has the symbols from offsets[i] to offsets[i + 1]."""
        if len(self.states) > MAX_STATES:
            self.forget()
        sizes = np.diff(offsets)
        per_text = -(-sizes // CHUNK)
        text = np.repeat(np.arange(len(sizes)), per_text)
        totals = np.zeros(len(sizes), np.int64)
        if not len(text):
            return totals
        change = text[1:] != text[:-1]
        first, last = np.r_[True, change], np.r_[change, True]
        place = np.arange(len(text)) - np.repeat(np.flatnonzero(first), per_text[per_text > 0])
        starts = offsets[:-1][text] + place * CHUNK
        ends = np.minimum(starts + CHUNK, offsets[1:][text])
        pairs, exits, counts = self.maps(symbols, starts, ends, first, last)
        chunk = pairs >> 32
        onward = np.where(last[chunk], len(pairs), np.searchsorted(pairs, (chunk + 1) << 32 | exits))
        totals[text[first]] = compose(onward, counts, int(per_text.max()))[np.searchsorted(pairs, np.flatnonzero(first) << 32 | START)]
        return totals


def compose(onward: np.ndarray, counts: np.ndarray, longest: int) -> np.ndarray:
    """Tokens from each pair of chunk and entry to the end of its text, by a scan over the maps.

    ``onward[i]`` is the pair that pair i leads to, ``len(onward)`` at the end of a text.
    After round k a pair's map spans 2 ** k chunks.
    """
    onward, totals = np.r_[onward, len(onward)], np.r_[counts, 0]
    span = 1
    while span < longest:
        totals = totals + totals[onward]
        onward = onward[onward]
        span *= 2
    return totals[:-1]


@lru_cache(2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def lowered(text: str) -> str:
    """Composed and lower-cased as the vocabulary's normalizer does: each character by itself."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFC", text)
    return "".join(map(str.lower, text)) if "Σ" in text else text.lower()


def word_symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all words of all texts, and where each text begins among them."""
    joined = "\n".join([*texts, ""])
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    kinds = char_classes()[codes]
    begins = np.empty(len(codes), bool)
    if len(codes):
        begins[0] = True
        np.not_equal(kinds[1:], kinds[:-1], out=begins[1:])
        begins |= kinds == NUMBER
    for at in np.flatnonzero((codes == 39) & begins):  # an apostrophe that opens a run
        tail = joined[at + 1 : at + 3]
        if found := next((c for c in CONTRACTIONS if tail.startswith(c)), None):
            begins[at + 1] = False
            if at + 1 + len(found) < len(codes):
                begins[at + 1 + len(found)] = True
    ending = np.r_[begins[1:], True] if len(codes) else begins
    width = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
    raw = np.frombuffer(joined.encode(), np.uint8)
    last_byte = np.cumsum(width) - 1
    symbols = raw.astype(np.int32)
    symbols[last_byte[ending]] += 256
    inside = np.repeat(kinds != SPACE, width)
    lengths = np.array([len(t) for t in texts], np.int64)
    text_ends = np.cumsum(lengths + 1)
    kept = np.cumsum(inside)
    offsets = np.r_[0, kept[last_byte[text_ends - 1]]] if len(texts) else np.zeros(1, np.int64)
    return symbols[inside], offsets


def count_texts(texts: list[str], path: str) -> np.ndarray:
    """Tokens of each text. A special string is one token and ends the text before it."""
    machine = transducer(path)
    pieces, owner = [], []
    extra = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        parts = [text]
        for special in machine.specials:
            if special in text:
                parts = [x for part in parts for x in part.split(special)]
        extra[i] = len(parts) - 1
        pieces += map(lowered, parts)
        owner += [i] * len(parts)
    symbols, offsets = word_symbols(pieces)
    counts = machine.count(symbols, offsets)
    return extra + np.bincount(owner, weights=counts, minlength=len(texts)).astype(np.int64)


def token_counts(df: DataFrame, path: str, text: str = "text", to: str = "n_tokens") -> DataFrame:
    """``df`` with the token count of each whole text in column ``to``.

    A null or empty text counts 0; a row is never dropped and repeated rows are counted
    each. The vocabulary at ``path`` must exist on every executor. There is no shuffle:
    a text is counted where it is read, in memory bounded by the batch and the text. A
    column named ``to`` is replaced.
    """
    bounded_batches(df.sparkSession)
    df = df.drop(to)
    schema = T.StructType([*df.schema.fields, T.StructField(to, T.LongType())])

    def counted(batches):
        for batch in batches:
            for part in slices(batch, text):
                texts = [x or "" for x in part.column(part.schema.get_field_index(text)).to_pylist()]
                counts = pa.array(count_texts(texts, path), pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns, counts], [*part.schema.names, to])

    return df.mapInArrow(counted, schema)


def document_counts(df: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """One row per document: bytes, tokens, and whether the tokens exceed ``limit``."""
    counts = token_counts(df.select("doc_id", "text"), path)
    return counts.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
