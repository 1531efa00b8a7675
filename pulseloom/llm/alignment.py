"""Alignment of the tokens of two tokenizers over the same text, with corpus-wide counts of linked ids.

Both tokenizers encode a text with one leading space. Where tokens of both end at the same byte the
text is cut, which gives the groups; a token of the one is linked with each token of the other
whose bytes overlap with its own.

The alignment walks both lists of token ends at once. At a shift, the difference between the two
current indices, it compares slices of the two lists, each twice as long as the one before, and
narrows the last one down by halving: so a stretch of one-to-one tokens is jumped in a few
comparisons. At the first unequal end the two lists are walked token by token to the next common
end, which settles this group and the new shift.

A text is cut at single spaces between other letters, where no token of either tokenizer goes
across. Parts not met lately are put one after another, encoded and aligned as one text, and their
groups and links are remembered; the memory is bounded and changes no result. A second tokenizer
with pieces that hold an inner space gets its texts whole.

Scale: the texts are read once. A row keeps its distinct linked pairs and how often it has each, and
these are added up over the corpus. Pairs that hold one link in ``HOT`` or more are at most ``HOT``
in number; their counts go to all tasks and are looked up there. The rarer pairs of a row are
joined with their counts by a shuffle, in which no pair is frequent.

Defined results
---------------
* A NULL or empty text has no tokens, nor has one whose tokens do not give back its bytes.
* Special tokens are ordinary text.
* An empty table, or one without any token, gives no counts and zeros per row.
* Rows that repeat a doc_id, or have none, are rows of their own; each counts its links.
* Other columns of the table are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseloom.llm.batches import text_slices
from pulseloom.session import materialise

#: Most pairs whose counts go to every task.
HOT = 1 << 19
#: Bytes of text per batch.
SLICE = 1 << 20
#: Parts that a worker remembers; longer ones than KEPT_CHARS are encoded each time.
KEPT = 300_000
KEPT_CHARS = 48
#: Bytes of parts that are encoded and aligned as one text.
JOINED = 4096

#: A single space between letters that are no white space.
_CUT = re.compile(r"(?<=\S)(?= \S)")
#: Parts that may be put one after another and still be cut in the same places.
_JOINABLE = re.compile(r" \S(?:.*\S)?\Z", re.DOTALL)


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[list[int], list[int], list[int], list[int]]:
    """Links as two lists of token indices, and per group the number of tokens of both up to its end.

    Both arrays rise strictly and have the same last number.
    """
    size, width = len(ends_a), ends_a.itemsize
    a, b = ends_a.tobytes(), ends_b.tobytes()
    list_a, list_b = ends_a.tolist(), ends_b.tolist()
    links_a: list[int] = []
    links_b: list[int] = []
    groups_a: list[int] = []
    groups_b: list[int] = []
    i = j = 0
    while i < size:
        if list_a[i] == list_b[j]:
            # One-to-one: probe slices of 1, 2, 4, ... tokens, then halve.
            run, step = 1, 1
            while i + run < size and a[width * (i + run) : width * (i + run + step)] == b[width * (j + run) : width * (j + run + step)]:
                run += step
                step *= 2
            while step > 1:
                step //= 2
                if a[width * (i + run) : width * (i + run + step)] == b[width * (j + run) : width * (j + run + step)]:
                    run += step
            run = min(run, size - i)
            links_a.extend(range(i, i + run))
            links_b.extend(range(j, j + run))
            groups_a.extend(range(i + 1, i + run + 1))
            groups_b.extend(range(j + 1, j + run + 1))
            i += run
            j += run
            continue
        end_a, end_b = list_a[i], list_b[j]
        links_a.append(i)
        links_b.append(j)
        while end_a != end_b:
            if end_a < end_b:
                i += 1
                end_a = list_a[i]
            else:
                j += 1
                end_b = list_b[j]
            links_a.append(i)
            links_b.append(j)
        i += 1
        j += 1
        groups_a.append(i)
        groups_b.append(j)
    return links_a, links_b, groups_a, groups_b


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


#: What is known of a part of a text: its links as keys, its groups as text, and how many tokens of both and groups.
Part = tuple[bytes, str, int, int, int]


def _keys(ids_a: np.ndarray, ids_b: np.ndarray) -> np.ndarray:
    return ids_a.astype(np.int64) << 32 | ids_b


class PairCoder:
    """Both tokenizers of one worker, the bytes of their tokens, and the parts it remembers."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        letters = _byte_letters()
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, n in vocabulary.items():
            known = all(c in letters for c in token)
            self.bytes_a[n] = bytes(letters[c] for c in token) if known else token.encode()
        pieces = [self.b.id_to_piece(n) for n in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(n) else p.replace("▁", " ").encode() for n, p in enumerate(pieces)
        ]
        self.sizes_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.sizes_b = np.array([len(t) for t in self.bytes_b], np.int64)
        #: Each id followed by a comma, a bar and a semicolon.
        self.texts = [f"{n}{mark}" for n in range(max(len(self.bytes_a), len(self.bytes_b))) for mark in ",|;"]
        self.text_sizes = np.array([len(t) for t in self.texts], np.int64)
        #: A piece with an inner space could go across a cut.
        self.whole = any("▁" in p.lstrip("▁") for p in pieces)
        self.young: dict[str, Part | None] = {}
        self.old: dict[str, Part | None] = {}

    @staticmethod
    @lru_cache(maxsize=2)
    def shared(path_a: str, path_b: str) -> PairCoder:
        return PairCoder(path_a, path_b)

    def _aligned(self, parts: list[str]) -> list[Part | None] | None:
        """The parts encoded and aligned as one text; None where that does not give back their bytes."""
        text = "".join(parts)
        data = text.encode()
        a = np.array(self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
        b = np.array(self.b.encode(text[1:]), np.int64)
        for ids, table in ((a, self.bytes_a), (b, self.bytes_b)):
            if b"".join(map(table.__getitem__, ids.tolist())) != data:
                return None
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        ends = np.cumsum([len(p.encode()) for p in parts])
        links_a, links_b, groups_a, groups_b = (np.array(x) for x in align(ends_a, ends_b))
        keys = _keys(a[links_a], b[links_b]).tobytes()
        # In the text of a group its tokens of a come before those of b.
        sizes_a, sizes_b = np.diff(groups_a, prepend=0), np.diff(groups_b, prepend=0)
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + np.repeat(groups_b - sizes_b, sizes_a)] = 3 * a
        codes[np.arange(len(b)) + np.repeat(groups_a, sizes_b)] = 3 * b
        codes[groups_a - 1 + groups_b - sizes_b] += 1
        codes[groups_a + groups_b - 1] += 2
        words = "".join(map(self.texts.__getitem__, codes.tolist()))
        ends_text = np.cumsum(self.text_sizes[codes])
        at_a, at_b = np.searchsorted(ends_a, ends, side="right"), np.searchsorted(ends_b, ends, side="right")
        at_group, at_link = np.searchsorted(groups_a, at_a, side="right"), np.searchsorted(links_a, at_a)
        counts = [np.diff(at, prepend=0).tolist() for at in (at_a, at_b, at_group)]
        texts = ends_text[at_a + at_b - 1].tolist()
        links = (8 * at_link).tolist()
        spans = zip([0, *links], links, [0, *texts], texts, *counts, strict=False)
        return [(keys[x:y], words[u : v - 1], n_a, n_b, n) for x, y, u, v, n_a, n_b, n in spans]

    def _learn(self, parts: list[str]) -> dict[str, Part | None]:
        out: dict[str, Part | None] = {}
        blocks: list[list[str]] = []
        held = JOINED
        for part in parts:
            if len(part) > JOINED or not _JOINABLE.match(part):
                blocks.insert(0, [part])
                continue
            if held >= JOINED:
                blocks.append([])
                held = 0
            blocks[-1].append(part)
            held += len(part)
        for block in blocks:
            found = self._aligned(block)
            if found is None and len(block) > 1:
                # One of them does not give back its bytes: each on its own.
                found = [(self._aligned([p]) or [None])[0] for p in block]
            out.update(zip(block, found or [None], strict=True))
        return out

    def _known(self, wanted: set[str]) -> dict[str, Part | None]:
        out, new = {}, []
        for part in wanted:
            if part in self.young:
                out[part] = self.young[part]
            elif part in self.old:
                out[part] = self.young[part] = self.old[part]
            else:
                new.append(part)
        found = self._learn(new)
        out.update(found)
        self.young.update((p, f) for p, f in found.items() if len(p) <= KEPT_CHARS)
        if len(self.young) > KEPT // 2:
            self.old, self.young = self.young, {}
        return out

    def cut(self, texts: list[str]) -> tuple[list[list[str]], dict[str, Part | None]]:
        """The parts of each text, none for one without tokens, and what is known of all of them."""
        split = [[] if not t else [f" {t}"] if self.whole else _CUT.split(f" {t}") for t in texts]
        known = self._known(set().union(*split))
        if any(found is None for found in known.values()):
            for n, parts in enumerate(split):
                if any(known[p] is None for p in parts):
                    text = f" {texts[n]}"
                    known[text] = (self._aligned([text]) or [None])[0]
                    split[n] = [text] if known[text] else []
        return split, known


def _texts(part: pa.RecordBatch) -> list[str]:
    return [t or "" for t in part.column("text").to_pylist()]


def rows_of(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row: doc_id, its numbers of tokens, groups and links, the digest of its groups, and its linked pairs.

    ``pairs`` holds each linked pair once, as the first id times 2^32 plus the second one, and
    ``times`` how many links have it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = PairCoder.shared(path_a, path_b)
        for part in text_slices(batches, SLICE):
            split, known = coder.cut(_texts(part))
            rows, digests, pairs = [], [], []
            for parts in split:
                found = [known[p] for p in parts]
                keys = np.frombuffer(b"".join([f[0] for f in found]), np.int64)
                rows.append((*(sum([f[k] for f in found]) for k in (2, 3, 4)), len(keys)))
                text = ";".join([f[1] for f in found])
                digests.append(hashlib.sha256(text.encode()).hexdigest() if text else "")
                pairs.append(np.unique(keys, return_counts=True))
            offsets = pa.array(np.cumsum([0, *(len(k) for k, _ in pairs)]), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x), t)) for x, t in zip(zip(*pairs, strict=True), kinds, strict=True)]
            counts = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *counts, pa.array(digests), *lists], names)

    kinds = (pa.int64(), pa.int32())
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"
    return source.mapInArrow(run, schema)


def pair_counts(rows: DataFrame) -> DataFrame:
    """pair and n, the links of all texts that hold it."""
    each = rows.select(F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    return each.groupBy("pair").agg(F.sum("times").alias("n"))


def with_best(counts: DataFrame) -> DataFrame:
    """The counts with ``best``: whether the pair's count is the highest of its id of b."""
    second = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    keyed = counts.withColumn("id_b", second)
    # One row per id of the second vocabulary.
    highest = keyed.groupBy("id_b").agg(F.max("n").alias("highest"))
    return keyed.join(highest, "id_b").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, groups (the ids of both in each) and links (pairs of ids) per row, in the order of the text."""

    def ids(text: str) -> list[int]:
        return [int(n) for n in text.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = PairCoder.shared(path_a, path_b)
        numbers = pa.list_(pa.int32())
        groups = pa.list_(pa.struct([("a", numbers), ("b", numbers)]))
        links = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
        schema = pa.schema([("doc_id", pa.int64()), ("groups", groups), ("links", links)])
        for part in text_slices(batches, SLICE):
            split, known = coder.cut(_texts(part))
            rows = []
            for doc, parts in zip(part.column("doc_id").to_pylist(), split, strict=True):
                cells = [cell.split("|") for p in parts for cell in known[p][1].split(";")]
                keys = np.frombuffer(b"".join([known[p][0] for p in parts]), np.int64).tolist()
                found = {"groups": [{"a": ids(a), "b": ids(b)} for a, b in cells]}
                rows.append({"doc_id": doc, **found, "links": [{"a": k >> 32, "b": k & 0xFFFFFFFF} for k in keys]})
            yield pa.RecordBatch.from_pylist(rows, schema)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    groups = "array<struct<a:array<int>,b:array<int>>>"
    return source.mapInArrow(run, f"doc_id long, groups {groups}, links array<struct<a:int,b:int>>")


def _hot(spark: SparkSession, judged: DataFrame) -> tuple[int, list[np.ndarray]]:
    """The least count of a hot pair, and the hot pairs in order with their counts: ``HOT`` at most."""
    total = judged.agg(F.sum("n")).first()[0] or 0
    least = max(1, -(-total // HOT))
    table = judged.where(F.col("n") >= least).toArrow()
    pairs, n, best = (table.column(c).to_numpy() for c in ("pair", "n", "best"))
    order = np.argsort(pairs)
    return least, [pairs[order], n[order], best[order].astype(np.int64)]


def summarise(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    ``n_best`` counts the links whose pair is the most frequent one of its second id, and
    ``count_sum`` adds up the corpus-wide counts of the links' pairs. ``groups_sha256`` is that of
    the ids as text: commas within a side, a bar between the sides, a semicolon between groups.
    """
    spark = docs.sparkSession
    rows = rows_of(docs, path_a, path_b).withColumn("row", F.monotonically_increasing_id())
    rows = materialise(rows, "aligned")
    judged = materialise(with_best(materialise(pair_counts(rows), "pair-counts")), "pairs")
    least, hot = _hot(spark, judged)
    shared = spark.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_pairs, n, best = shared.value
        for batch in batches:
            lists = batch.column("pairs")
            offsets = lists.offsets.to_numpy()
            pairs = lists.values.to_numpy()[offsets[0] : offsets[-1]]
            times = batch.column("times").flatten().to_numpy().astype(np.int64)
            offsets = offsets - offsets[0]
            at = np.minimum(np.searchsorted(hot_pairs, pairs), max(len(hot_pairs) - 1, 0))
            known = hot_pairs[at] == pairs if len(hot_pairs) else np.zeros(len(pairs), bool)
            sums = np.zeros((3, len(pairs) + 1), np.int64)
            for row, values in zip(sums, (best, n), strict=False):
                row[1:][known] = values[at[known]] * times[known]
            sums[2, 1:] = ~known
            sums = np.cumsum(sums, axis=1)[:, offsets]
            cold = [pa.ListArray.from_arrays(pa.array(sums[2], pa.int32()), pa.array(x[~known])) for x in (pairs, times)]
            figures = [pa.array(x) for x in np.diff(sums[:2], axis=1)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *figures, *cold], ["row", "n_best", "count_sum", "pairs", "times"])

    schema = "row long, n_best long, count_sum long, pairs array<long>, times array<long>"
    found = materialise(rows.select("row", "pairs", "times").mapInArrow(run, schema), "judged")
    rare = found.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    counted = rare.join(judged.where(F.col("n") < least), "pair")
    rest = counted.select("row", (F.col("times") * F.col("best").cast("long")).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    sums = found.select("row", "n_best", "count_sum").unionByName(rest).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return rows.drop("pairs", "times").join(sums, "row").drop("row")
