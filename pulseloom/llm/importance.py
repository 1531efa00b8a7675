"""Importance resampling towards a target distribution, by hashed n-gram features.

Features are all runs of 1 to 3 consecutive words, counted in buckets by the CRC-32 of their bytes.
A bucket's gain is the logarithm of how much more frequent it is in the target than in the
documents, with one added to each count; a document weighs the sum of the gains of its features.
Adding Gumbel noise, seeded by the id, and taking the highest scores draws without replacement in
proportion to the weights.

A batch's texts are joined with a zero byte between them, which is no word letter. One pass of a
regular expression then finds the words of all of them; a search of their places among the
offsets of the documents tells which n-grams go across two documents, and these are left out of
the count. The checksum of an n-gram is put together from those of its words: appending n bytes
to a text is a linear map of its checksum, kept as a table per n.

Bounds: a task holds one batch of ``SLICE`` bytes of text, or of one document, and works on
``BLOCK`` bytes at a time. The driver holds one number per bucket. Ranks come from a range shuffle
of the scored rows with the columns to keep, so ids alone where no others are asked for.

Defined results
---------------
* A NULL or empty text, and one without a word letter, has no features and weighs 0.
* Only A-Z are folded; every character beyond ASCII is a word letter.
* Without target texts, or without documents, each count is 0 and the gains still follow the formula.
* A NULL doc_id counts as an empty text in the seed, and is the smallest one in ties.
* Rows that repeat a doc_id are rows of their own; ties of score and doc_id go by the number of features.
* The documents' other columns come back unchanged whatever their names.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseloom.functions.ordering import global_rank
from pulseloom.llm.batches import text_slices, texts_of
from pulseloom.llm.columns import spare
from pulseloom.session import materialise

BUCKETS = 10_000
#: Words in the longest feature.
LONGEST = 3
#: Bytes of text per batch and per block of it.
SLICE = 4 << 20
BLOCK = 2 << 20
#: Words whose checksum a worker remembers.
KEPT = 300_000
#: Lengths with a table of their own.
TABLED = 64

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
_IS_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_BLANK = zlib.crc32(b" ")


def _through(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][(crc >> 8) & 255] ^ table[2][(crc >> 16) & 255] ^ table[3][crc >> 24]


@lru_cache(maxsize=256)
def _append(length: int) -> np.ndarray:
    """What each byte of a checksum turns to when ``length`` zero bytes follow, as a table of 4 x 256."""
    if length == 0:
        return (np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    if length == 1:
        # One byte of CRC-32 without its initial and final inversion.
        one = np.array([zlib.crc32(bytes([v])) ^ zlib.crc32(b"\0") for v in range(256)], np.uint32)
        start = _append(0)
        return (start >> 8) ^ one[start & 255]
    half = _append(length // 2)
    double = _through(half, half)
    return _through(_append(1), double) if length % 2 else double


@lru_cache(maxsize=1)
def _tables() -> np.ndarray:
    return np.concatenate([_append(n).ravel() for n in range(TABLED)])


def shifted(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The checksums after as many zero bytes as given for each."""
    table, at = _tables(), (np.minimum(lengths, TABLED - 1) * 1024).astype(np.int32)
    letters = np.ascontiguousarray(crc, "<u4").view(np.uint8).reshape(-1, 4)
    out = table.take(at + letters[:, 0])
    for k in range(1, 4):
        at += 256
        out ^= table.take(at + letters[:, k])
    if len(lengths) and lengths.max() >= TABLED:
        for n in np.unique(lengths[lengths >= TABLED]).tolist():
            where = np.flatnonzero(lengths == n)
            out[where] = _through(_append(n), crc[where])
    return out


def _then_blank(crc: np.ndarray) -> np.ndarray:
    """The checksums with one space appended."""
    return (crc >> 8) ^ _append(1)[0].take(crc & 255) ^ np.uint32(_BLANK)


class _Codes(dict):
    """Checksum and length of words, as one number; forgets all when full, which changes no result."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT:
            self.clear()
        code = zlib.crc32(word) | len(word) << 32
        if len(word) < TABLED:
            self[word] = code
        return code


_codes = _Codes()


def _blocks(joined: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Start and code of all words, by blocks of about ``BLOCK`` bytes that end between two words."""
    low = 0
    while low < len(joined):
        gap = _GAP.search(joined, min(low + BLOCK, len(joined)))
        high = gap.start() if gap else len(joined)
        words = _WORD.findall(joined, low, high)
        inside = _IS_WORD[np.frombuffer(joined, np.uint8, high - low, low)]
        starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        yield low + (np.concatenate([[0], starts]) if inside[0] else starts), np.fromiter(map(_codes.__getitem__, words), np.int64, len(words))
        low = high


def features(texts: list[bytes], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per block of words: the document of each new word, and document and bucket of each feature that ends there."""
    joined = b"\0".join(texts).translate(_FOLD)
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    doc, crc, length = (np.zeros(0, t) for t in (np.int64, np.uint32, np.int64))
    for starts, codes in _blocks(joined):
        carried = len(doc)
        new = np.searchsorted(offsets, starts, side="right") - 1
        doc = np.concatenate([doc, new])
        crc = np.concatenate([crc, (codes & 0xFFFFFFFF).astype(np.uint32)])
        length = np.concatenate([length, codes >> 32])
        docs, hashes, run = [new], [crc[carried:]], crc
        for width in range(2, LONGEST + 1):
            # ``run`` holds the runs of one word less; entry i starts at word i.
            run = shifted(_then_blank(run[:-1]), length[width - 1 :]) ^ crc[width - 1 :]
            first, last = doc[: len(run)], doc[width - 1 :]
            own = first == last
            own[: max(0, carried - width + 1)] = False
            docs.append(last[own])
            hashes.append(run[own])
        yield new, np.concatenate(docs), np.concatenate(hashes) % np.uint32(buckets)
        doc, crc, length = (x[-(LONGEST - 1) :] for x in (doc, crc, length))


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in text_slices(batches, SLICE):
            for _, _, bucket in features(texts_of(part), buckets):
                total += np.bincount(bucket, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    # One row per bucket.
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket: a thousand times the log ratio of the smoothed frequencies, rounded down."""
    buckets = len(source)
    s, t = float(source.sum() + buckets), float(target.sum() + buckets)
    return np.array(
        [math.floor(1000 * math.log((float(b + 1) * s) / (float(a + 1) * t))) for a, b in zip(source.tolist(), target.tolist(), strict=True)],
        np.int64,
    )


def weigh(docs: DataFrame, gain: np.ndarray, keep: list[str] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """The kept columns (all by default) with the number of words and features and the weight of each row.

    The second value tells under which names, since the table may have columns of the same ones.
    """
    buckets, kept = len(gain), keep if keep is not None else docs.columns
    names = {n: spare(docs, n) for n in ("n_words", "n_features", "weight")}
    text = spare(docs, "_text")
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col("text").cast("string").alias(text))
    schema = source.drop(text).schema
    for name in names.values():
        schema = schema.add(name, "long", True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, SLICE, text):
            rows = part.num_rows
            words, counts, weights = (np.zeros(rows, np.int64) for _ in range(3))
            for new, doc, bucket in features(texts_of(part, text), buckets):
                words += np.bincount(new, minlength=rows)
                counts += np.bincount(doc, minlength=rows)
                # Sums of whole numbers, exact in doubles up to 2^53.
                weights += np.bincount(doc, weights=gain[bucket], minlength=rows).astype(np.int64)
            columns = [c for c, n in zip(part.columns, part.schema.names, strict=True) if n != text]
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, (words, counts, weights))], [*kept, *names.values()])

    return source.mapInArrow(run, schema), names


def noise(key: Column, seed: int) -> Column:
    """A thousand times a Gumbel number drawn by the key, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    unit = (h.cast("double") + F.lit(0.5).cast("double")) / F.lit(4294967296).cast("double")
    return F.floor(F.lit(-1000).cast("double") * F.log(-F.log(unit))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 5,
    least_words: int = 20,
    seed: int = 42,
    buckets: int = BUCKETS,
    keep: list[str] | None = None,
) -> tuple[DataFrame, Callable[[str], str]]:
    """The rows of ``docs`` with n_features, weight, score and rank; rank is NULL where a row is not drawn.

    Of the rows with ``least_words`` words, ``percent`` in a hundred are drawn. The second value
    gives the name under which one of these columns stands.
    """
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    weighed, names = weigh(docs, gain, keep)
    names |= {n: spare(docs, n) for n in ("score", "rank")}
    score = (F.col(names["weight"]) + noise(F.col("doc_id"), seed)).alias(names["score"])
    scored = materialise(weighed.select("*", score), "importance")
    # The rows travel as one column, so that no name of theirs meets those of the ranking.
    whole = F.struct(*[F.col(f"`{c}`") for c in scored.columns]).alias("kept")
    rows = scored.select(whole, F.col(names["n_words"]) >= least_words, F.col(names["score"]), F.col("doc_id"), F.col(names["n_features"]))
    rows = rows.toDF("kept", "enough", "by_score", "by_id", "by_size")
    drawn = percent * rows.where("enough").count() // 100
    order = [F.col("by_score").desc(), F.col("by_id").asc_nulls_first(), F.col("by_size")]
    ranked = global_rank(rows.where("enough"), order, "at").select("kept", F.when(F.col("at") <= drawn, F.col("at")).alias("at"))
    rest = rows.where("not enough").select("kept", F.lit(None).cast("long").alias("at"))
    both = ranked.unionByName(rest)
    return both.select(*[F.col("kept").getField(c).alias(c) for c in scored.columns], F.col("at").alias(names["rank"])), names.__getitem__
