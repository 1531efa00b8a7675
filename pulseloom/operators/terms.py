"""Weights of terms per document, with term counts exchanged as sorted hashes.

A table of (document, term) pairs is many times its texts, and it would move twice: to the
terms and back to the documents. Here each block of documents sends every term once, as a
hash and the number of its documents, and gets back the kept terms with their numbers in
all blocks. The pairs themselves are made where the document is, and never move.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pulseloom.functions.text import tokens, unigrams_and_bigrams
from pulseloom.session import materialise

_SENT = "block int, part int, hashes binary, marks binary, numbers binary, clash boolean"
_KEPT = "block int, hashes binary, numbers binary, clash boolean"
# Terms looked at in one go, and terms that wait to be merged with the others of their block.
_SLICE, _WAITING = 500_000, 1_000_000


class HashClash(Exception):
    """Two terms have one hash."""


def packed(values: np.ndarray) -> bytes:
    """Whole numbers with only the bytes that the largest needs, low bytes first: high ones are few and compress."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    width = data[0]
    raw = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, :width] = raw.T
    return out.reshape(-1).view("<u8")


def packed_sorted(values: np.ndarray) -> bytes:
    """Gaps are smaller than the numbers."""
    return packed(np.diff(values, prepend=np.uint64(0)))


def unpacked_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.uint64)


def summed(hashes: np.ndarray, marks: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Sorted hashes, each once, with their mark and the sum of their numbers; whether a hash has two marks."""
    if not len(hashes):
        return hashes, marks, numbers, False
    order = np.argsort(hashes, kind="stable")
    hashes, marks, numbers = hashes[order], marks[order], numbers[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    clash = bool(((hashes[1:] == hashes[:-1]) & (marks[1:] != marks[:-1])).any())
    return hashes[first], marks[first], np.add.reduceat(numbers, first), clash


def _lists(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column in a row, and the row of each."""
    lists = batch.column(column)
    sizes = np.diff(lists.offsets.to_numpy())
    return lists.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(batch.num_rows), sizes)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with ``_SLICE`` terms at most, or of one row."""
    ends, low = np.cumsum(np.diff(batch.column("hashes").offsets.to_numpy())), 0
    while low < batch.num_rows:
        before = int(ends[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + _SLICE, side="right")))
        yield batch.slice(low, high - low)
        low = high


def _send(parts: int):
    """Each block's terms, cut into ranges of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in (part for whole in batches for part in _slices(whole)):
            blocks = batch.column("block").to_numpy()
            hashes, row = _lists(batch, "hashes")
            marks = _lists(batch, "marks")[0].astype(np.int16).view(np.uint16)
            hashes = hashes.view(np.uint64)
            for block in np.unique(blocks):
                some = np.flatnonzero(blocks[row] == block)
                # Once per document: rows stay in order among equal hashes.
                some = some[np.argsort(hashes[some], kind="stable")]
                h, m, r = hashes[some], marks[some], row[some]
                clash = bool(((h[1:] == h[:-1]) & (m[1:] != m[:-1])).any())
                new = np.concatenate([[True], (h[1:] != h[:-1]) | (r[1:] != r[:-1])]) if len(h) else np.zeros(0, bool)
                h, m, n, more = summed(h[new], m[new], np.ones(int(new.sum()), np.int64))
                into = held.setdefault(int(block), [])
                into.append((h, m, n, clash or more))
                if sum(len(x[0]) for x in into[1:]) > max(_WAITING, len(into[0][0])):
                    held[int(block)] = [_merged(into)]
        for block in sorted(held):
            h, m, n, clash = _merged(held.pop(block))
            ends = np.searchsorted(h, [np.uint64(((p << 64) + parts - 1) // parts) for p in range(1, parts)])
            for part, (low, high) in enumerate(zip([0, *ends], [*ends, len(h)])):
                if high > low:
                    yield _batch(_SENT, block=block, part=part, hashes=packed_sorted(h[low:high]), marks=m[low:high].tobytes(), numbers=packed(n[low:high]), clash=clash)

    return run


def _merged(found: list) -> tuple:
    if len(found) == 1:
        return found[0]
    h, m, n, clash = summed(*(np.concatenate([x[i] for x in found]) for i in range(3)))
    return h, m, n, clash or any(x[3] for x in found)


def _batch(schema: str, **row) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = pa.schema([pa.field(n, kinds[k]) for n, k in (c.split() for c in schema.split(", "))])
    return pa.RecordBatch.from_pylist([row], schema=fields)


def _keep(least: int):
    """The terms of a range that enough documents hold, back to each block that has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                parts.setdefault(row["part"], []).append(row)
        for part in sorted(parts):
            rows = parts.pop(part)
            sent = [unpacked_sorted(r["hashes"]) for r in rows]
            marks = np.concatenate([np.frombuffer(r["marks"], np.uint16) for r in rows])
            numbers = np.concatenate([unpacked(r["numbers"]).astype(np.int64) for r in rows])
            h, _, n, clash = summed(np.concatenate(sent), marks, numbers)
            clash = clash or any(r["clash"] for r in rows)
            h, n = h[n >= least], n[n >= least]
            for r, own in zip(rows, sent):
                at = np.searchsorted(h, own)
                at = at[np.flatnonzero(np.take(h, at, mode="clip") == own)] if len(h) else at[:0]
                if len(at) or clash:
                    yield _batch(_KEPT, block=r["block"], hashes=packed_sorted(h[at]), numbers=packed(n[at]), clash=clash)

    return run


def _weigh(documents: int, kinds: pa.Schema):
    """(key, term, weight at unit length) of documents that come after the kept terms of their block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, waiting, kept, idf = None, [], np.zeros(0, np.uint64), np.zeros(0)
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            for low, high in _runs(blocks):
                part = batch.slice(low, high - low)
                if blocks[low] != block:
                    block, waiting, kept, idf = blocks[low], [], np.zeros(0, np.uint64), np.zeros(0)
                told = part.filter(pc.invert(part.column("is_text")))
                for h, n in zip(told.column("kept").to_pylist(), told.column("numbers").to_pylist()):
                    waiting.append((unpacked_sorted(h), unpacked(n)))
                texts = part.filter(part.column("is_text"))
                if not texts.num_rows:
                    continue
                if waiting:
                    kept, n = (np.concatenate(x) for x in zip(*waiting))
                    order, waiting = np.argsort(kept, kind="stable"), []
                    kept, idf = kept[order], np.log((1 + documents) / (1 + n[order].astype(float))) + 1
                for some in _slices(texts):
                    yield from _weighed(some, kept, idf, kinds)

    return run


def _runs(blocks: np.ndarray) -> list[tuple[int, int]]:
    cuts = np.flatnonzero(np.diff(blocks)) + 1
    return list(zip([0, *cuts], [*cuts, len(blocks)])) if len(blocks) else []


def _weighed(texts: pa.RecordBatch, kept: np.ndarray, idf: np.ndarray, kinds: pa.Schema) -> Iterator[pa.RecordBatch]:
    hashes, row = _lists(texts, "hashes")
    hashes = hashes.view(np.uint64)
    if not (len(kept) and len(hashes)):
        return
    at = np.searchsorted(kept, hashes)
    some = np.flatnonzero(np.take(kept, at, mode="clip") == hashes)
    # Equal terms of a document side by side, then counted.
    some = some[np.lexsort((at[some], row[some]))]
    a, r = at[some], row[some]
    if not len(some):
        return
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (r[1:] != r[:-1])]))
    count = np.diff([*first, len(some)])
    weight = (1 + np.log(count)) * idf[a[first]]
    length = np.sqrt(np.bincount(r[first], weight * weight, texts.num_rows))
    terms = texts.column("terms").flatten().take(pa.array(some[first]))
    keys = texts.column("key").take(pa.array(r[first]))
    yield pa.RecordBatch.from_arrays([keys, terms, pa.array(weight / length[r[first]])], schema=kinds)


def weights(df: DataFrame, key: str, text: str, min_documents: int) -> DataFrame:
    """(key, term, tfidf): (1 + ln count) * idf at unit length per document."""
    seed = 0
    while True:
        try:
            return _weights(df, key, text, min_documents, seed)
        except HashClash:
            # One in a hundred or less, at 500 million terms.
            seed += 1


def _grouped(rows: DataFrame, blocks: int, *keys: str) -> DataFrame:
    """Rows of one key are one document; they meet by block."""
    return rows.repartition(blocks, "block").groupBy(*keys).agg(F.collect_list("text").alias("texts"))


def _weights(df: DataFrame, key: str, text: str, least: int, seed: int) -> DataFrame:
    spark = df.sparkSession
    blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(blocks)).cast("int")
    plain = df.select(place.alias("block"), F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Words are found once: a variable of the outer list stands for them.
    terms = F.flatten(F.transform(F.transform("texts", tokens), unigrams_and_bigrams))
    hashes = lambda terms: F.transform(terms, lambda t: F.xxhash64(t, F.lit(seed)))
    split = _grouped(plain, blocks, "block", "key").select("block", terms.alias("terms"))
    marked = split.select("block", hashes("terms").alias("hashes"), F.transform("terms", lambda t: (F.hash(t) % 32768).cast("int")).alias("marks"))
    sent = marked.mapInArrow(_send(blocks), _SENT).repartitionById(blocks, "part")
    kept = materialise(sent.mapInArrow(_keep(least), _KEPT), "terms")
    if kept.where("clash").limit(1).count():
        raise HashClash
    documents = df.count()
    # The shuffle files of the first pass go with its last reference.
    del sent, marked, split
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    # Told terms and texts meet in one shuffle; the terms come first.
    kind = df.schema[key].dataType
    nothing = {"key": F.lit(None).cast(kind), "text": F.lit(None).cast("string")}
    told = kept.select("block", F.lit(False).alias("is_text"), "hashes", "numbers").withColumns(nothing)
    blank = F.lit(None).cast("binary")
    both = told.unionByName(plain.withColumns({"is_text": F.lit(True), "hashes": blank, "numbers": blank}))
    lined = _grouped(both, blocks, "block", "is_text", "hashes", "numbers", "key").sortWithinPartitions("block", "is_text")
    ready = lined.select("block", "is_text", F.col("hashes").alias("kept"), "numbers", "key", terms.alias("terms"))
    ready = ready.select("*", hashes("terms").alias("hashes"))
    schema = pa.schema([pa.field("key", to_arrow_type(kind)), pa.field("term", pa.string()), pa.field("tfidf", pa.float64())])
    found = ready.mapInArrow(_weigh(documents, schema), f"key {kind.simpleString()}, term string, tfidf double")
    return found.withColumnRenamed("key", key)
