"""Byte-level BPE as recursive DuckDB queries, run per partition.

A text is cut by the public pattern. Each match is a word of token-position rows that start as
single bytes. A recursive query joins neighbouring tokens to the merge table and contracts the
leftmost pair of least rank of each word, until no word has a pair left. Decoding joins ids to
the vocabulary and puts the bytes together by an ordered aggregation.

Long words are cut first, at places that no occurrence of a vocabulary token goes across: no
contraction can either. Parts that are still long would need as many rounds as they have tokens,
so they go through a second query that contracts all places of the least rank at once. That is the same result unless a contraction can
open a pair of still lower rank; the merge table marks the ranks for which it can, and of those
only the leftmost place is contracted.

Words are worked out once per worker while they are remembered; the memory is bounded and changes
no result.

Defined results
---------------
* A NULL text is an empty one: no ids, no bytes. Special tokens are ordinary text.
* Ids that the vocabulary lacks cannot be decoded and raise.
* A NULL list of ids decodes to no bytes.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseloom.llm.batches import text_slices

#: Bytes of a word for the first query. Longer words are not remembered, so a memory of so many words is bounded.
SHORT_BYTES = 48
KEPT = 350_000
#: Rows that a query holds, about: the first one keeps those of all its rounds, the second one only the last.
ROWS = 1_500_000
#: Ids per decoding query.
IDS = 200_000
#: Bytes of text per batch.
SLICE = 2 << 20

#: One contraction per word and round. A row holds the place and token behind it, and what both merge to.
#: Places are below 256, as are the lengths of short words, so rank, place and next place make one number.
SHORT_WORDS = """
with recursive state(w, p, next_p, t, next_t, merged, round) as (
  select s.w, s.p, s.next_p, s.t, s.next_t, m.merged, 0::smallint
  from start s left join merges m on m.pair = s.t::bigint * 4294967296 + s.next_t
  union all
  (with best as (select w, min(merged::bigint * 65536 + p * 256 + next_p) as least
                 from state where merged is not null group by w),
   gone as (select b.w, (b.least // 256 % 256)::int as at, (b.least // 65536)::int as merged, s.p as removed, s.next_p, s.next_t
            from best b join state s on s.w = b.w and s.p = b.least % 256),
   left_over as (select s.w, s.p, (s.round + 1)::smallint as round,
       case when s.p = g.at then g.next_p else s.next_p end as next_p,
       case when s.p = g.at then g.merged else s.t end as t,
       case when s.p = g.at then g.next_t when s.next_p = g.at then g.merged else s.next_t end as next_t
     from state s join gone g on g.w = s.w where s.p <> g.removed)
   select l.w, l.p, l.next_p, l.t, l.next_t, m.merged, l.round
   from left_over l left join merges m on m.pair = l.t::bigint * 4294967296 + l.next_t)
)
select w, t from state join (select w, max(round) as last from state group by w) using (w) where round = last order by w, p
"""

#: All places of the least rank per word and round; rows of a removed token turn to -1.
LONG_WORDS = """
with recursive state(w, p, t) using key (w, p) as (
  select w, p, t from start
  union
  (with live as (select distinct w from state),
   pairs as (select w, p, t, lead(t) over word as next_t, lead(p) over word as next_p
             from recurring.state semi join live using (w) where t >= 0 window word as (partition by w order by p)),
   ranked as (select pairs.*, m.merged, m.alone, min(m.merged) over (partition by w) as least
              from pairs left join merges m on m.pair = pairs.t::bigint * 4294967296 + pairs.next_t),
   hits as (select w, p, next_p, merged, alone, row_number() over word as nth, lag(next_p) over word as before
            from ranked where merged = least window word as (partition by w order by p)),
   runs as (select *, sum(case when before = p then 0 else 1 end) over (partition by w order by p) as run from hits),
   chosen as (select w, p, next_p, merged
              from (select *, row_number() over (partition by w, run order by p) as k from runs)
              where k % 2 = 1 and (not alone or nth = 1))
   select w, p, merged from chosen union all select w, next_p, -1 from chosen)
)
select w, t from state where t >= 0 order by w, p
"""

#: The vocabulary holds bytes as characters of the same number, so that they can be aggregated as text.
DECODE = """
select s.w, string_agg(v.bytes, '' order by s.p) as bytes from tokens s join vocabulary v on v.id = s.id group by s.w
"""


@lru_cache(maxsize=2)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def merge_rows(vocabulary: dict[bytes, int]) -> list[tuple[int, int, int, bool]]:
    """(left id, right id, merged id, alone) for every cut of a token into two tokens."""
    rows = []
    for token, merged in vocabulary.items():
        for cut in range(1, len(token)):
            a, b = vocabulary.get(token[:cut]), vocabulary.get(token[cut:])
            if a is not None and b is not None:
                rows.append((a, b, merged))
    opening = {part for a, b, merged in rows for part in (a, b) if merged < part}
    return [(a, b, merged, merged in opening) for a, b, merged in rows]


class Memory(dict):
    """What is known of some words, bounded."""

    def __init__(self) -> None:
        self.again: set[str] = set()

    def unknown(self, wanted: set[str]) -> set[str]:
        """The wanted words that have to be learnt; makes room for them."""
        new = wanted.difference(self)
        if len(self) + len(new) > KEPT:
            kept = wanted - new
            if len(self.again) < KEPT // 2:
                kept |= self.again
            kept = {w: self[w] for w in kept}
            self.clear()
            self.update(kept)
            self.again = set()
        else:
            self.again |= wanted - new
        return new


class ByteBpe:
    """Encoder and decoder of one worker: DuckDB tables of merges and vocabulary, and what it remembers."""

    def __init__(self, path: str, pattern: str) -> None:
        self.ranks = ranks(path)
        self.pattern = regex.compile(pattern)
        self.single = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        merges = np.array(merge_rows(self.ranks), np.int64).reshape(-1, 4)
        pair = (merges[:, 0] << 32) + merges[:, 1]
        self._load("merges", {"pair": pair, "merged": merges[:, 2].astype(np.int32), "alone": merges[:, 3].astype(bool)})
        texts = [token.decode("latin-1") for token in self.ranks]
        self._load("vocabulary", {"id": pa.array(list(self.ranks.values()), pa.int32()), "bytes": pa.array(texts)})
        self.valid = np.zeros(max(self.ranks.values(), default=0) + 1, bool)
        self.valid[list(self.ranks.values())] = True
        self.words = Memory()
        self._finder: ahocorasick.Automaton | None = None

    @staticmethod
    @lru_cache(maxsize=2)
    def shared(path: str, pattern: str) -> ByteBpe:
        return ByteBpe(path, pattern)

    def _load(self, name: str, columns: dict) -> None:
        self.db.register("incoming", pa.table(columns))
        self.db.execute(f"create or replace table {name} as select * from incoming")
        self.db.unregister("incoming")

    def _parts(self, data: bytes) -> list[bytes]:
        """A word cut where no occurrence of a token goes across."""
        if len(data) <= SHORT_BYTES:
            return [data]
        if self._finder is None:
            # Bytes as characters of the same number.
            self._finder = ahocorasick.Automaton()
            for token in self.ranks:
                if len(token) > 1:
                    self._finder.add_word(token.decode("latin-1"), len(token))
            self._finder.add_word("\u0100", 1)
            self._finder.make_automaton()
        # Tokens that begin before a place, less those that have ended there.
        crossing = np.zeros(len(data) + 1, np.int64)
        for end, size in self._finder.iter(data.decode("latin-1")):
            crossing[end - size + 2] += 1
            crossing[end + 1] -= 1
        cuts = np.flatnonzero(np.cumsum(crossing)[1 : len(data)] == 0) + 1
        edges = [0, *cuts.tolist(), len(data)]
        return [data[a:b] for a, b in zip(edges, edges[1:], strict=False)]

    def _contract(self, words: list[bytes], query: str) -> Iterator[tuple[int, bytes]]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        w = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        p = (np.arange(len(w)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
        t = self.single[np.frombuffer(b"".join(words), np.uint8)]
        last = p == np.repeat(sizes - 1, sizes)
        following = {"next_p": pa.array(p + np.int32(1), mask=last), "next_t": pa.array(np.roll(t, -1), mask=last)}
        self._load("start", {"w": w, "p": p, "t": t, **following})
        found = self.db.sql(query).to_arrow_table()
        w, ids = found.column("w").to_numpy(), found.column("t").to_numpy().astype("<i4").tobytes()
        edges = np.flatnonzero(np.diff(w, prepend=-1, append=-1))
        ends = (4 * edges).tolist()
        for word, low, high in zip(w[edges[:-1]].tolist(), ends, ends[1:], strict=False):
            yield word, ids[low:high]

    def _learn(self, words: list[str]) -> None:
        short: dict[bytes, str] = {}
        cut: dict[str, list[bytes]] = {}
        for word in words:
            data = word.encode()
            whole = self.ranks.get(data)
            if whole is not None:
                self.words[word] = whole.to_bytes(4, "little")
            elif len(data) <= SHORT_BYTES:
                short[data] = word
            else:
                cut[word] = self._parts(data)
        parts = set().union(*cut.values())
        found: dict[bytes, bytes] = {}
        few = list(short.keys() | {p for p in parts if len(p) <= SHORT_BYTES})
        many = [p for p in parts if len(p) > SHORT_BYTES]
        for group, query in ((few, SHORT_WORDS), (many, LONG_WORDS)):
            rows = np.array([len(p) * min(len(p), SHORT_BYTES) // 2 for p in group], np.int64)
            edges = np.flatnonzero(np.diff(np.cumsum(rows) // ROWS, prepend=-1)).tolist()
            for low, high in zip(edges, [*edges[1:], len(group)], strict=False):
                part = group[low:high]
                for w, ids in self._contract(part, query):
                    found[part[w]] = ids
        self.words.update((word, found[data]) for data, word in short.items())
        self.words.update((word, b"".join([found[p] for p in parts])) for word, parts in cut.items())

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids per text as little-endian 32-bit numbers."""
        matches = [self.pattern.findall(t) for t in texts]
        new = self.words.unknown(set().union(*matches))
        self._learn(list(new))
        found = [b"".join(map(self.words.__getitem__, m)) for m in matches]
        for word in new:
            if len(word) > SHORT_BYTES:
                del self.words[word]
        return found

    def decode(self, lists: list[np.ndarray]) -> list[bytes]:
        """The bytes of each list of ids."""
        out = [b""] * len(lists)
        low = 0
        while low < len(lists):
            high, total = low, 0
            while high < len(lists) and (high == low or total + len(lists[high]) <= IDS):
                total += len(lists[high])
                high += 1
            ids = np.concatenate([np.asarray(x, np.int64) for x in lists[low:high]])
            if len(ids) and (ids.min() < 0 or ids.max() >= len(self.valid) or not self.valid[ids].all()):
                raise ValueError("an id is not in the vocabulary")
            w = np.repeat(np.arange(low, high), [len(x) for x in lists[low:high]])
            self._load("tokens", {"w": w, "p": np.arange(len(ids)), "id": ids.astype(np.int32)})
            found = self.db.sql(DECODE).to_arrow_table()
            for n, text in zip(found.column("w").to_pylist(), found.column("bytes").to_pylist(), strict=True):
                out[n] = text.encode("latin-1")
            low = high
        return out


def _sliced(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ByteBpe.shared(path, pattern)
        for part in text_slices(batches, SLICE):
            found = coder.encode([t or "" for t in part.column("text").to_pylist()])
            sizes = np.cumsum([0, *(len(f) // 4 for f in found)]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(found), "<i4"), pa.int32())
            ids = pa.ListArray.from_arrays(pa.array(sizes), values)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], ["doc_id", "ids"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids and decoded (binary) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ByteBpe.shared(path, pattern)
        for part in _sliced(batches):
            column = part.column("ids")
            values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
            lists = [values[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]
            decoded = pa.array(coder.decode(lists), pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), column, decoded], ["doc_id", "ids", "decoded"])

    source = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return source.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")
