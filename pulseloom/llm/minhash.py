"""Near-duplicate documents by circulant MinHash, banding and exact verification.

Two permutations of the 32-bit numbers make all coordinates of a signature: shingles go through
the first once, and coordinate k is the least value of the second one shifted by k places round
the circle. Bands of coordinates name buckets; documents that share a bucket are candidates, and
every link is confirmed on the full shingle sets.

How the work stays in proportion to the input
---------------------------------------------
* Documents with equal sets are one class from the start; only classes are compared.
* The classes of a bucket are first compared with one of them, its medoid by sketches, and linked
  classes become components. Buckets are cut into blocks of ``BLOCK`` for that, in another way in
  each band.
* Pairs of a bucket that are still in different components are then compared block against
  block, where they are: tasks first name the classes that have a likely partner, then get the
  sets of those and give the links only. A pair is compared in the first band that it shares.
* A pair is looked at more closely only if its sizes and its 8-bit coordinates allow the
  similarity. A pair at 0.8 fails the latter test with a chance of 2e-6 (240 coordinates, 0.12
  below), and has no common bucket with a chance of 5e-6 (40 bands of 6).

Defined results
---------------
* A NULL text, or one without words, has an empty set, no links and its own component.
* Fewer words than a shingle holds are one shingle as a whole.
* ``component_id`` is the smallest ``doc_id`` that links reach; NULL ids count as larger than all
  others, and a component of NULL ids only has NULL as its id and is kept.
* Rows that repeat ``doc_id`` and text share their result; ``survivors`` gives them once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseloom.llm.columns import spare, text_key
from pulseloom.llm.components import components
from pulseloom.session import materialise

BANDS, BAND_WIDTH = 40, 6
COORDINATES = BANDS * BAND_WIDTH
#: Share by which the estimate of a linked pair may fall short.
MARGIN = 0.12
#: Classes of a bucket that are compared with one another at a time.
BLOCK = 512

_ODD = np.uint64(0x9E3779B97F4A7C15)
_SHIFTS = np.arange(COORDINATES, dtype=np.uint32)[:, None]
_COLUMNS = 136


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _permute32(x: np.ndarray) -> np.ndarray:
    """A bijection of the 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit names of the shingles of ``width`` words."""
    # On bytes, lower() and split() know ASCII letters and white space only.
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    names = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    span = min(width, len(words))
    mixed = np.full(len(words) - span + 1, span, np.uint64)
    for k in range(span):
        mixed = (mixed ^ (mixed >> np.uint64(31))) * _ODD + names[k : len(words) - span + 1 + k]
    return np.unique(_mix64(mixed))


def signature(shingles: np.ndarray) -> np.ndarray:
    """COORDINATES minima of one non-empty set."""
    placed = _permute32((shingles >> np.uint64(32)).astype(np.uint32) ^ np.uint32(0x5BD1E995))
    least = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for low in range(0, len(placed), _COLUMNS):
        shifted = _permute32(placed[None, low : low + _COLUMNS] - _SHIFTS)
        np.minimum(least, shifted.min(axis=1), out=least)
    return least


def buckets_of(signatures: np.ndarray) -> np.ndarray:
    """BANDS bucket names per signature."""
    bands = signatures.reshape(-1, BANDS, BAND_WIDTH).astype(np.uint64)
    mixed = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bands.shape[:2])
    for k in range(BAND_WIDTH):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _ODD + bands[:, :, k]
    return _mix64(mixed).view(np.int64)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, text_key, n_shingles, set_key, buckets, sketch per row; the last three NULL without words."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                sizes, keys, rows = [], [], np.zeros((part.num_rows, COORDINATES), np.uint32)
                for i, text in enumerate(part.column("text").to_pylist()):
                    shingles = shingle_set(text, width)
                    sizes.append(len(shingles))
                    keys.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
                    if len(shingles):
                        rows[i] = signature(shingles)
                empty = pa.array([not n for n in sizes])
                names = buckets_of(rows).ravel()
                offsets = pa.array(np.arange(0, len(names) + 1, BANDS, dtype=np.int32))
                buckets = pa.ListArray.from_arrays(offsets, pa.array(names), mask=empty)
                small = (rows & np.uint32(0xFF)).astype(np.uint8)
                tails = pa.array([None if not n else r.tobytes() for n, r in zip(sizes, small, strict=True)], pa.binary())
                columns = [part.column("doc_id"), part.column("text_key"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [*columns, buckets, tails], ["doc_id", "text_key", "n_shingles", "set_key", "buckets", "sketch"]
                )

    schema = "doc_id long, text_key string, n_shingles long, set_key binary, buckets array<long>, sketch binary"
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), text_key().alias("text_key")
    )
    return source.mapInArrow(sketch, schema)


def _fixed(column: pa.ChunkedArray, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _near(sketch: np.ndarray, others: np.ndarray, percent: int) -> np.ndarray:
    return (others == sketch).sum(axis=1) >= (percent / 100 - MARGIN) * COORDINATES


def _alike(size: int, others: np.ndarray, percent: int) -> np.ndarray:
    return np.minimum(size, others) * 100 >= np.maximum(size, others) * percent


def _units(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """Tables and the ranges of their units: rows with equal keys, which come one after the other."""
    held: pa.Table | None = None

    def cut(table: pa.Table, whole: bool) -> tuple[pa.Table, list[tuple[int, int]], pa.Table]:
        columns = [table.column(k).to_numpy() for k in keys]
        change = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
        bounds = [0, *(np.flatnonzero(change) + 1).tolist(), table.num_rows]
        if not whole:
            bounds.pop()  # the last unit may go on in the next batch
        ranges = [(low, high) for low, high in zip(bounds, bounds[1:], strict=False) if high - low > 1]
        return table, ranges, table.slice(bounds[-1])

    for batch in batches:
        if batch.num_rows:
            table = pa.Table.from_batches([batch])
            table, ranges, held = cut(table if held is None else pa.concat_tables([held, table]), whole=False)
            yield table, ranges
    if held is not None and held.num_rows:
        yield cut(held, whole=True)[:2]


def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def texts_of(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """class and text for classes with their text_key."""
    texts = docs.select(text_key().alias("text_key"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(classes.select("class", "text_key"), "text_key").select("class", "text").dropDuplicates(["class"])


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) that reach the similarity on their full sets."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, None
        for batch in batches:
            keep = []
            texts = (batch.column(c).to_pylist() for c in ("a", "text_a", "text_b"))
            for a, text_a, text_b in zip(*texts, strict=True):
                if a != last:  # rows come sorted by a
                    last, last_set = a, shingle_set(text_a, width)
                other = shingle_set(text_b, width)
                common = len(np.intersect1d(last_set, other, assume_unique=True))
                keep.append(100 * common >= percent * (len(last_set) + len(other) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    pairs = materialise(pairs, "pairs")
    used = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct().join(classes, "class")
    texts = materialise(texts_of(used, docs), "texts")
    left = texts.select(F.col("class").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("class").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "b").hint("merge").join(left, "a").select("a", "b", "text_a", "text_b")
    return materialise(both.mapInArrow(test, "a long, b long"), "links")


def members_of_buckets(classes: DataFrame) -> DataFrame:
    """bucket, class, blocks for the buckets with several classes."""
    placed = classes.select(F.explode("buckets").alias("bucket"), "class")
    stats = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = placed.join(stats, "bucket").select("bucket", "class", F.ceil(F.col("members") / BLOCK).alias("blocks"))
    return materialise(members, "members")


def _block() -> Column:
    """The bucket's name takes part, so that each band is cut in another way."""
    return F.pmod(F.xxhash64("class", "bucket"), F.col("blocks"))


def medoid_pairs(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Likely pairs (a, b) of a class and the medoid of its block."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, ranges in _units(batches, ("bucket", "block")):
            names, sizes = table.column("class").to_numpy(), table.column("n").to_numpy()
            sketch = _fixed(table.column("sketch"), np.uint8, COORDINATES)
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for low, high in ranges:
                own = sketch[low:high]
                if high - low <= 8:
                    middle = low + int((own[:, None] == own).sum(axis=(1, 2)).argmax())
                else:
                    counts = np.bincount((own + 256 * np.arange(COORDINATES)).ravel(), minlength=256 * COORDINATES)
                    common = counts.reshape(COORDINATES, 256).argmax(axis=1)
                    middle = low + int((own == common).sum(axis=1).argmax())
                near = _near(sketch[middle], own, percent) & _alike(sizes[middle], sizes[low:high], percent)
                near[middle - low] = False
                other = names[low:high][near]
                found.append((np.minimum(other, names[middle]), np.maximum(other, names[middle])))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], ["a", "b"])

    rows = members.join(classes.select("class", F.col("n_shingles").alias("n"), "sketch"), "class")
    rows = rows.select("bucket", _block().alias("block"), "class", "n", "sketch")
    return _dealt(rows, "bucket", "block").mapInArrow(compare, "a long, b long").distinct()


def _open_partners(rows: dict[str, np.ndarray], x: int, others: np.ndarray, percent: int) -> np.ndarray:
    """Of other rows, those in another component that are likely and share no earlier band with x."""
    others = others[(rows["label"][others] != rows["label"][x]) & _alike(rows["n"][x], rows["n"][others], percent)]
    others = others[_near(rows["sketch"][x], rows["sketch"][others], percent)] if len(others) else others
    if len(others):
        first = (rows["buckets"][others] == rows["buckets"][x]).argmax(axis=1)
        others = others[rows["buckets"][x][first] == rows["bucket"][x]]
    return others


def _open_rows(table: pa.Table) -> dict[str, np.ndarray]:
    rows = {c: table.column(c).to_numpy() for c in ("bucket", "i", "j", "block", "class", "label", "n")}
    rows["sketch"] = _fixed(table.column("sketch"), np.uint8, COORDINATES)
    rows["buckets"] = table.column("buckets").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    return rows


def _sides(rows: dict[str, np.ndarray], low: int, high: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each row of block i, and the rows of block j that it meets."""
    i, j = rows["i"][low], rows["j"][low]
    block = rows["block"][low:high]
    own, other = low + np.flatnonzero(block == i), low + np.flatnonzero(block == j)
    for nth, x in enumerate(own):
        yield int(x), other[nth + 1 :] if i == j else other


def open_classes(rows: DataFrame, percent: int) -> DataFrame:
    """bucket, i, j, class: the rows with a likely partner in another component."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, ranges in _units(batches, ("bucket", "i", "j")):
            if not ranges:
                continue
            rows = _open_rows(table)
            marked = np.zeros(table.num_rows, bool)
            for low, high in ranges:
                label = rows["label"][low:high]
                if (label != label[0]).any():
                    for x, others in _sides(rows, low, high):
                        partners = _open_partners(rows, x, others, percent)
                        marked[partners] = True
                        marked[x] |= len(partners) > 0
            yield from table.select(["bucket", "i", "j", "class"]).filter(pa.array(marked)).to_batches()

    return _dealt(rows, "bucket", "i", "j").mapInArrow(mark, "bucket long, i long, j long, class long")


def open_links(members: DataFrame, labels: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) within buckets between components, confirmed on full sets.

    A unit stops at one link between two components, so it gives fewer links than it has rows.
    """

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, width).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("class"), pa.array(sets, pa.binary())], ["class", "names"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, ranges in _units(batches, ("bucket", "i", "j")):
            if not ranges:
                continue
            rows, sets = _open_rows(table), [np.frombuffer(x, np.uint64) for x in table.column("names").to_pylist()]
            a, b = [], []
            for low, high in ranges:
                joined: dict[int, int] = {}

                def root(label: int, joined: dict[int, int] = joined) -> int:
                    while label in joined:
                        label = joined[label]
                    return label

                for x, others in _sides(rows, low, high):
                    for y in _open_partners(rows, x, others, percent).tolist():
                        one, other = root(int(rows["label"][x])), root(int(rows["label"][y]))
                        if one == other:
                            continue
                        common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                        if 100 * common >= percent * (len(sets[x]) + len(sets[y]) - common):
                            joined[one] = other
                            a.append(min(rows["class"][x], rows["class"][y]))
                            b.append(max(rows["class"][x], rows["class"][y]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    labelled = members.join(labels, members["class"] == labels["node"], "left")
    labelled = labelled.withColumn("label", F.coalesce("component", "class")).drop("node", "component")
    mixed = labelled.groupBy("bucket").agg(F.min("label").alias("_l"), F.max("label").alias("_h")).where("_l <> _h").select("bucket")
    # A block meets itself and every other block of its bucket once.
    rows = labelled.join(mixed, "bucket").withColumn("block", _block())
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    pair = [F.least("block", "_other").alias("i"), F.greatest("block", "_other").alias("j")]
    rows = materialise(rows.select("bucket", *pair, "block", "class", "label"), "open")
    about = classes.select("class", F.col("n_shingles").alias("n"), "sketch", "buckets")
    marked = materialise(open_classes(rows.join(about, "class"), percent), "marked")
    used = marked.select("class").distinct().join(classes.select("class", "text_key"), "class")
    sets = materialise(texts_of(used, docs).mapInArrow(sets_of, "class long, names binary"), "sets")
    rows = rows.join(marked, ["bucket", "i", "j", "class"], "left_semi").join(about, "class").join(sets, "class")
    return _dealt(rows, "bucket", "i", "j").mapInArrow(link, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept per row."""
    rows = materialise(sketches(docs, width), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("doc_id"), F.col("text_key").alias("text_key")))
    classes = rows.where("set_key is not null").groupBy("set_key").agg(first.alias("_f"))
    classes = classes.select("set_key", F.col("_f.doc_id").alias("doc_id"), F.col("_f.text_key").alias("text_key"))
    # The sketch is read from the row that names the class; repeated rows give it once.
    named = rows.where("set_key is not null").select("set_key", "text_key", "n_shingles", "buckets", "sketch")
    classes = named.join(classes, ["set_key", "text_key"]).dropDuplicates(["set_key", "text_key"])
    classes = materialise(classes.withColumn("class", F.monotonically_increasing_id()), "classes")

    members = members_of_buckets(classes)
    links = confirmed(medoid_pairs(members, classes, percent), classes, docs, width, percent)
    labels = materialise(components(links), "labels")
    more = materialise(open_links(members, labels, classes, docs, width, percent), "links")
    # Components so far are stars, which keep what the first links say.
    joined = labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)
    labels = materialise(components(joined), "labels")

    # Only documents with a link or an equal set need a lookup; it is by set, one row each.
    owned = classes.join(labels, classes["class"] == labels["node"], "left")
    owned = owned.select("set_key", "doc_id", F.coalesce("component", "class").alias("component"))
    lowest = owned.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_set = owned.join(lowest, "component").select("set_key", "component_id")
    found = rows.select("doc_id", "text_key", "n_shingles", "set_key").join(by_set, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    found = found.select("doc_id", "text_key", "n_shingles", component.alias("component_id"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def survivors(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, with all its columns."""
    own, other = spare(docs, "key"), spare(docs, "kept_key")
    kept = near_duplicates(docs, width, percent).where("kept").select(F.col("text_key").alias(other)).distinct()
    keyed = docs.withColumn(own, text_key())
    found = keyed.join(kept, keyed[own] == kept[other], "left_semi")
    return found.dropDuplicates([own]).select(*docs.columns)
