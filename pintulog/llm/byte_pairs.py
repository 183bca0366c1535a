"""Byte-level BPE by recursive DuckDB queries within each partition.

The vocabulary becomes a merge table: for every token and every way to cut it into two
tokens, (left, right, merged), the merged id being the rank. A text is split by the
vocabulary's pattern; distinct words that are no token themselves become token positions,
join the merge table, and each word's leftmost pair of least rank is contracted, again and
again until no pair of the word is in the table. Ordered aggregation of token rows decodes.

Every query holds a bounded number of rows. Words of up to ``SHORT`` bytes are rows with a
list of ids, one contraction a round. A longer word keeps one row per position in a keyed
recursion, whose state is as large as the word however many rounds it takes; there, all
repeats of the least pair are contracted in one round when no pair made of the merged token
has a lower rank, since the order then cannot matter. It is first cut between bytes that
are adjacent in no token, which no merge can cross.
"""

import base64
import itertools
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pintulog.llm.batches import bounded_batches, slices

SHORT = 256
SQUARES = 1 << 24  # sum of squared word lengths per query of short words
LONG_BYTES = 1 << 16  # bytes per query of long words, or one word
MAX_WORDS = 800_000  # encoded words a worker remembers
CHARS = 2_000_000  # a longer text is encoded in stretches
MATCHES = 400_000  # matches of one such text that are held at once
TOKENS = 1 << 18  # token rows per decoding query

# Two alternatives that begin with different characters, so either may be tried first.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d|"
WORDS = r" ?\p{L}+|"

MERGES = """
create table merges as
with cut as (
  select id, hex(token) as whole, unnest(range(1, octet_length(token))) as place from vocabulary
  where octet_length(token) > 1
), halves as (
  select id, substr(whole, 1, 2 * place) as head, substr(whole, 2 * place + 1) as tail from cut
), pairs as (
  select l.id as l, r.id as r, halves.id as id
  from halves join tokens l on l.token = head join tokens r on r.token = tail
)
select *, id not in (select l from pairs where l > id union all select r from pairs where r > id) as safe
from pairs
"""

# A word is a list of ids; ``best`` holds rank and place of its leftmost least pair.
CONTRACT_SHORT = """
with recursive step(w, ids, done) as (
  select w, ids, false from words
  union all
  select w, case when best is null then ids
    else ids[:(best & 4294967295) - 1] || [(best >> 32)::int] || ids[(best & 4294967295) + 2:] end, best is null or len(ids) = 2
  from (
    select w, any_value(ids) as ids, min((m.id::bigint << 32) | place) as best
    from (
      select w, ids, unnest(ids[:len(ids) - 1]) as l, unnest(ids[2:]) as r, unnest(range(1, len(ids))) as place
      from step where not done
    ) s left join merges m on m.l = s.l and m.r = s.r
    group by w
  )
)
select w, ids from step where done
"""

# A word is a row per position; a position that is merged into the one before has no id.
# In a run of overlapping least pairs every second one is contracted, from its left end.
CONTRACT_LONG = """
with recursive step(w, place, id, done) using key (w, place) as (
  select w, place, id, false from (
    select w, unnest(range(len(ids))) as place, unnest(ids) as id from words
  )
  union
  select w, place, case when gone then null when hit then best else id end, best is null
  from (
    select *, coalesce(lag(hit) over (partition by w order by i), false) as gone
    from (
      select *, coalesce(rank = best and case
          when safe then (i - coalesce(max(case when rank = best then null else i end) over (
            partition by w order by i rows between unbounded preceding and current row), 0)) % 2 = 1
          else i = min(case when rank = best then i end) over (partition by w) end, false) as hit
      from (
        select s.*, m.id as rank, m.safe, min(m.id) over (partition by w) as best
        from (
          select w, place, id, lead(id) over o as following, row_number() over o as i
          from recurring.step where not done and id is not null
          window o as (partition by w order by place)
        ) s left join merges m on m.l = s.id and m.r = s.following
      )
    )
  )
)
select w, list(id order by place) as ids from step where id is not null group by w
"""

DECODE = """
select w, unhex(string_agg(token, '' order by place)) as raw
from positions join tokens using (id) group by w
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file with a base64 token and its rank per line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def _members(pattern: str, ranks: dict[bytes, int], chars: str) -> set[str]:
    """Which of ``chars`` the reference library counts to a character class."""
    import tiktoken

    coder = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return set(coder.decode_bytes(coder.encode_ordinary(chars)).decode())


class Splitter:
    """Splits texts by ``pattern`` with the character classes of the reference library.

    Releases of Unicode differ in which characters are letters or numbers. A text that holds
    one of the few that the two libraries see differently takes a pattern with the classes
    spelled out.
    """

    def __init__(self, pattern: str, ranks: dict[bytes, int]):
        chars = "".join(map(chr, itertools.chain(range(0xD800), range(0xE000, 0x110000))))
        if pattern.startswith(CONTRACTIONS + WORDS):
            pattern = WORDS + CONTRACTIONS + pattern.removeprefix(CONTRACTIONS + WORDS)
        self.plain = regex.compile(pattern)
        odd, spelled = set(), pattern
        for name in (r"\p{L}", r"\p{N}"):
            ours, theirs = set(regex.findall(name, chars)), _members(name, ranks, chars)
            for extra in (theirs - ours, ours - theirs):
                odd |= extra
            spelled = spelled.replace(name, self._class(theirs))
        self.odd = re.compile(f"[{self._class(odd)}]") if odd else None
        self.spelled = regex.compile(self._outside(spelled)) if odd else self.plain

    @staticmethod
    def _class(members: set[str]) -> str:
        numbers = np.array(sorted(map(ord, members)))
        cuts = np.flatnonzero(np.diff(numbers) > 1) + 1
        return "".join(f"\\U{run[0]:08x}-\\U{run[-1]:08x}" for run in np.split(numbers, cuts) if len(run))

    @staticmethod
    def _outside(spelled: str) -> str:
        """Brackets round each spelled class that is not inside a bracket already."""
        out, depth = [], 0
        for part in regex.split(r"(\[|\]|(?:\\U[0-9a-f]{8}-\\U[0-9a-f]{8})+)", spelled):
            depth += (part == "[") - (part == "]")
            out.append(f"[{part}]" if part.startswith("\\U") and not depth else part)
        return "".join(out)

    def words(self, text: str) -> Iterator[str]:
        odd = self.odd is not None and not text.isascii() and self.odd.search(text)
        return (m.group() for m in (self.spelled if odd else self.plain).finditer(text))

    def all_words(self, text: str) -> list[str]:
        odd = self.odd is not None and not text.isascii() and self.odd.search(text)
        return (self.spelled if odd else self.plain).findall(text)


class Codec:
    """Encodes and decodes with the ranks in the file at ``path``, in one DuckDB connection."""

    def __init__(self, path: str, pattern: str):
        import duckdb

        ranks = read_ranks(path)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "1GB", "temp_directory": ""})
        vocabulary = pa.table({"token": pa.array(list(ranks), pa.binary()), "id": pa.array(list(ranks.values()), pa.int32())})
        self._fill("vocabulary", vocabulary)
        self.con.execute("create table tokens as select hex(token) as token, id from vocabulary")
        self.con.execute(MERGES)
        self.splitter = Splitter(pattern, {bytes([i]): i for i in range(256)})
        self.byte_id = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.adjacent = np.zeros((256, 256), bool)
        joined = np.frombuffer(b"".join(ranks), np.uint8)
        inside = np.ones(len(joined), bool)
        inside[np.cumsum([len(token) for token in ranks]) - 1] = False
        at = np.flatnonzero(inside)
        self.adjacent[joined[at], joined[at + 1]] = True
        self.tokens = {}
        for token, rank in ranks.items():
            try:
                self.tokens[token.decode()] = rank.to_bytes(4, "little")
            except UnicodeDecodeError:  # part of a character, so never a word
                continue
        self.known = dict(self.tokens)

    def _fill(self, name: str, table: pa.Table) -> None:
        self.con.register("incoming", table)
        self.con.execute(f"create or replace table {name} as select * from incoming")
        self.con.unregister("incoming")

    def _contract(self, query: str, words: list[bytes]) -> list[bytes]:
        """The ids of each word, little-endian, by one recursive query over all of them."""
        ends = np.cumsum([len(w) for w in words])
        ids = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        lists = pa.ListArray.from_arrays(np.r_[0, ends].astype(np.int32), ids)
        self._fill("words", pa.table({"w": np.arange(len(words), dtype=np.int32), "ids": lists}))
        found = self.con.sql(query).to_arrow_table().combine_chunks()
        values = found.column("ids").combine_chunks()
        flat = values.flatten().to_numpy().astype("<u4")
        cuts = np.r_[0, np.cumsum(np.diff(values.offsets.to_numpy()))]
        out = [b""] * len(words)
        for w, low, high in zip(found.column("w").to_pylist(), cuts, cuts[1:]):
            out[w] = flat[low:high].tobytes()
        return out

    def _sections(self, word: bytes) -> list[bytes]:
        """``word`` cut where no token holds the two bytes side by side."""
        raw = np.frombuffer(word, np.uint8)
        cuts = np.flatnonzero(~self.adjacent[raw[:-1], raw[1:]]) + 1
        return [word[low:high] for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(word)])]

    def _encode_many(self, words: Iterable[bytes], query: str, size, limit: int) -> dict[bytes, bytes]:
        done: dict[bytes, bytes] = {}
        group, load = [], 0
        for word in words:
            if group and load + size(word) > limit:
                done |= zip(group, self._contract(query, group))
                group, load = [], 0
            group.append(word)
            load += size(word)
        return done | dict(zip(group, self._contract(query, group))) if group else done

    def learn(self, words: Iterable[str]) -> None:
        """Encode distinct words that are not known yet."""
        short = {w: w.encode() for w in words}
        long = {w: self._sections(short.pop(w)) for w in [w for w, raw in short.items() if len(raw) > SHORT]}
        sections = {s for parts in long.values() for s in parts}
        done = {s: int(self.byte_id[s[0]]).to_bytes(4, "little") for s in sections if len(s) == 1}
        done |= self._encode_many(
            {*short.values(), *(s for s in sections if 1 < len(s) <= SHORT)}, CONTRACT_SHORT, lambda w: len(w) ** 2, SQUARES
        ) | self._encode_many((s for s in sections if len(s) > SHORT), CONTRACT_LONG, len, LONG_BYTES)
        self.known |= {w: done[raw] for w, raw in short.items()}
        self.known |= {w: b"".join(map(done.__getitem__, parts)) for w, parts in long.items()}

    def _encode_lists(self, texts: list[list[str]]) -> list[bytes]:
        missing = set().union(*texts).difference(self.known)
        if missing:
            if len(self.known) + len(missing) > MAX_WORDS + len(self.tokens):
                self.known = dict(self.tokens)
                missing = set().union(*texts).difference(self.known)
            self.learn(missing)
        return [b"".join(map(self.known.__getitem__, words)) for words in texts]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little-endian unsigned 32 bits."""
        out: list[bytes] = []
        for long, some in itertools.groupby(texts, lambda x: len(x) > CHARS):
            if not long:
                out += self._encode_lists([self.splitter.all_words(x) for x in some])
                continue
            for text in some:
                words, parts = self.splitter.words(text), []
                while stretch := list(itertools.islice(words, MATCHES)):
                    parts += self._encode_lists([stretch])
                out.append(b"".join(parts))
        return out

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes of each sequence of ids; an id outside the vocabulary fails."""
        out = [bytearray() for _ in ids]
        flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
        owner = np.repeat(np.arange(len(ids), dtype=np.int32), [len(x) // 4 for x in ids])
        for low in range(0, len(flat), TOKENS):
            some = slice(low, low + TOKENS)
            positions = pa.table({"w": owner[some], "place": np.arange(len(flat[some]), dtype=np.int32), "id": flat[some]})
            self._fill("positions", positions)
            if unknown := self.con.sql("select min(id) from positions anti join tokens using (id)").fetchall()[0][0]:
                raise ValueError(f"no token has the id {unknown}")
            for w, raw in self.con.sql(DECODE).fetchall():
                out[w] += raw
        return [bytes(x) for x in out]


@lru_cache(2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _mapped(df: DataFrame, column: str, to: str, kind: T.DataType, work) -> DataFrame:
    """``df`` with the column ``to`` that ``work`` makes of lists of values of ``column``."""
    bounded_batches(df.sparkSession)
    df = df.drop(to)
    schema = T.StructType([*df.schema.fields, T.StructField(to, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column):
                values = part.column(part.schema.get_field_index(column)).to_pylist()
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(work(values), pa.binary())], [*part.schema.names, to])

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, path: str, text: str = "text", to: str = "ids", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``df`` with the ids of each whole text in column ``to``: little-endian unsigned 32 bits.

    ``path`` is a file of base64 tokens and ranks that every executor can read. Each match of
    ``pattern`` is encoded for itself, a match that is a token as that token; there are no
    special tokens. A null text is encoded as an empty one. Rows are kept as they are,
    repeated ones too, and a column named ``to`` is replaced. There is no shuffle, so neither
    long texts nor equal ones meet in a task that did not read them.
    """
    return _mapped(df, text, to, T.BinaryType(), lambda values: codec(path, pattern).encode([x or "" for x in values]))


def decode(df: DataFrame, path: str, ids: str = "ids", to: str = "decoded", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``df`` with the bytes that the ids in column ``ids`` stand for in column ``to``.

    Null ids give no bytes; an id that is no token fails. A column named ``to`` is replaced.
    """
    return _mapped(df, ids, to, T.BinaryType(), lambda values: codec(path, pattern).decode([x or b"" for x in values]))


def document_digests(df: DataFrame, path: str) -> DataFrame:
    """One row per document: token count and digests of its ids and of the bytes decoded from them."""
    ids = encode(df.select("doc_id", "text"), path).select("doc_id", "ids")
    return decode(ids, path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
