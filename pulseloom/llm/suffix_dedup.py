"""Removal of byte passages that occur earlier in the corpus, by a family of suffix arrays.

Every string of ``WIDTH`` bytes that also starts earlier, in a smaller doc_id or before in the same
document, is removed; overlaps count, and strings are judged on the input.

1. *Contexts.* The ``GRAM`` bytes of least hash within a string, the leftmost ones of several, are
   its anchor. Neighbouring strings share anchors, so a text falls into contexts: an anchor with all
   strings around it that have it. Equal strings have equal anchors, so they lie in contexts of the
   same anchor bytes. A context travels as two hashes and a place.
2. *Equal contexts.* Sorted by the hashes, all but the first of equal contexts repeat it as a whole.
   Each slice of text keeps the first of its own equal contexts only, so that a passage in very many
   documents does not meet in one task; ranges of the sort order split frequent anchors.
3. *Open contexts* are those whose anchor has several different contexts: passages end there. Their
   bytes are fetched and dealt out by anchor. A task takes them in document order, batch by batch. A
   batch gets its suffix array, sorted by the ``WIDTH`` bytes that follow. Equal neighbours and
   strings that a merge scan finds in an older level have occurred before. What is new becomes a
   level, and levels of the same rank merge, so their sizes grow geometrically.
4. Anchors with over ``CROWDED`` open contexts, such as a line in very many documents, would be one
   task's work. Their strings are compared by a digest of 128 bits, pre-aggregated in every task.

Defined results
---------------
* A NULL or empty text, or one of less than ``WIDTH`` bytes, loses nothing.
* A NULL doc_id comes before all others. Rows of one doc_id come in the order of a hash of their
  texts; of repeated rows one keeps its text and the others lose all they hold of ``WIDTH`` bytes.
* The kept bytes may begin or end within a character.
* Other columns come back unchanged whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from pulseloom.llm.batches import text_slices, texts_of
from pulseloom.llm.columns import spare
from pulseloom.session import materialise

#: Bytes of a string that may not occur twice, and of an anchor.
WIDTH = 100
GRAM = 32
#: Bytes of text that are cut into contexts at a time, and the bits of a place among them.
SLICE = 1 << 20
_PLACE = 22
#: Open contexts per batch of a family, and per task.
BATCH = 4096
PER_TASK = 16_384
#: Open contexts of one anchor beyond which its strings are compared by digest.
CROWDED = 4096

_NONE = -(1 << 63)
_FACTOR = 0xD1342543DE82EF95
_WORD = 1 << 64


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(bytes([b])) for b in range(256)], np.uint64)


def gram_hashes(data: np.ndarray, length: int = GRAM) -> np.ndarray:
    """A hash of the ``length`` bytes (a power of two) from each byte on."""
    h, width = _letters()[data], 1
    while width < length:
        h = h[:-width] * np.uint64(pow(_FACTOR, width, _WORD)) + h[width:]
        width *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def contexts(data: np.ndarray, ends: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, ...]:
    """Of texts one after another: text, first and last start of a string, and anchor of each context, and its hash."""
    if len(data) < width:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    hashes = gram_hashes(data)
    # Equal hashes go by place: the leftmost counts.
    least = (hashes >> np.uint64(_PLACE) << np.uint64(_PLACE)) | np.arange(len(hashes), dtype=np.uint64)
    span, done = width - GRAM + 1, 1
    while done < span:
        step = min(done, span - done)
        least = np.minimum(least[:-step], least[step:])
        done += step
    anchor = (least & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
    start = np.arange(len(anchor))
    text = np.searchsorted(ends, start, side="right")
    inside = start + width <= ends[text]
    start, anchor, text = start[inside], anchor[inside], text[inside]
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    at = anchor[first]
    return text[first], start[first], start[last], at, hashes[at].view(np.int64)


def _segments(part: pa.RecordBatch) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Rows, offsets and bytes to be cut at a time: many texts, or a piece of one that overlaps with the next piece."""
    texts = texts_of(part, "text")
    if len(texts) > 1 or len(texts[0]) <= SLICE:
        yield list(range(len(texts))), [0] * len(texts), texts
        return
    for low in range(0, len(texts[0]), SLICE):
        yield [0], [low], [texts[0][low : low + SLICE + WIDTH - 1]]


#: doc and tag name a document in order; place holds start, whether covered, further strings and bytes before the anchor.
_ENTRY = "gram long, print long, doc long, tag long, place long"


def _entries(source: DataFrame) -> DataFrame:
    """Contexts of all texts; of equal ones within a slice all but the first are marked as covered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, SLICE):
            docs, tags = (part.column(c).to_numpy() for c in ("doc", "tag"))
            for rows, offsets, texts in _segments(part):
                joined = b"".join(texts)
                ends = np.cumsum([len(t) for t in texts])
                text, first, last, anchor, gram = contexts(np.frombuffer(joined, np.uint8), ends)
                spans = zip(first.tolist(), (last + WIDTH).tolist(), (anchor - first).tolist(), strict=True)
                print_ = np.array([xxhash.xxh3_64_intdigest(joined[a:b], seed=c) for a, b, c in spans], np.uint64).view(np.int64)
                row = np.array(rows, np.int64)[text]
                begin = first - np.concatenate([[0], ends])[text] + np.array(offsets, np.int64)[text]
                order = np.lexsort((begin, tags[row], docs[row], print_, gram))
                gram, print_, row, begin, first, last, anchor = (x[order] for x in (gram, print_, row, begin, first, last, anchor))
                again = np.zeros(len(gram), bool)
                again[1:] = (gram[1:] == gram[:-1]) & (print_[1:] == print_[:-1])
                place = begin << 17 | again.astype(np.int64) << 16 | (last - first) << 8 | (anchor - first)
                # Covered ones need no neighbour: they spread by the other hash and their place.
                gram = np.where(again, print_ ^ place * np.int64(0x9E3779B97F4A7C1), gram)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (gram, print_, docs[row], tags[row], place)], ["gram", "print", "doc", "tag", "place"])

    return source.mapInArrow(run, _ENTRY)


#: gram is NULL where the bytes are covered, otherwise the context is open.
_FOUND = "doc long, tag long, lo long, hi long, gram long"


def _judge(entries: DataFrame) -> DataFrame:
    """Covered and open contexts; the others cannot hold a string that occurs twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc", "tag", "lo", "hi", "gram"]

        def out(cols: dict[str, np.ndarray], where: np.ndarray, is_open: bool) -> pa.RecordBatch:
            place = cols["place"][where]
            lo = place >> 17
            gram = pa.array(cols["gram"][where]) if is_open else pa.nulls(len(lo), pa.int64())
            arrays = [pa.array(cols["doc"][where]), pa.array(cols["tag"][where]), pa.array(lo), pa.array(lo + (place >> 8 & 255) + WIDTH), gram]
            return pa.RecordBatch.from_arrays(arrays, names)

        # The first context of the last anchor so far, as long as no other one has come.
        waiting: dict[str, np.ndarray] | None = None
        last: tuple[int, int] | None = None
        several = True
        for batch in batches:
            cols = {n: batch.column(n).to_numpy() for n in batch.schema.names}
            marked = (cols["place"] >> 16 & 1).astype(bool)
            if marked.any():
                yield out(cols, np.flatnonzero(marked), False)
                cols = {n: c[~marked] for n, c in cols.items()}
            gram, print_ = cols["gram"], cols["print"]
            if not len(gram):
                continue
            before_gram = np.concatenate([[last[0] if last else ~gram[0]], gram[:-1]])
            before_print = np.concatenate([[last[1] if last else 0], print_[:-1]])
            new_gram = gram != before_gram
            first = new_gram | (print_ != before_print)
            yield out(cols, np.flatnonzero(~first), False)
            run_of = np.cumsum(new_gram)
            # Contexts per anchor; run 0 goes on from the batch before, whose contexts count too.
            number = np.bincount(run_of, weights=first, minlength=run_of[-1] + 1).astype(np.int64)
            if last is not None:
                if number[0] and waiting is not None:
                    yield out(waiting, np.arange(1), True)
                    waiting, several = None, True
                if run_of[-1] > 0:
                    waiting = None
            # The first anchor of a task may have begun in the one before.
            is_several = number > 1
            is_several[0] = several or number[0] > 1
            if last is None:
                is_several[min(1, len(number) - 1)] = True
            held = np.zeros(len(gram), bool)
            end = run_of[-1]
            if not is_several[end] and number[end]:
                held = first & (run_of == end)
                waiting = {n: c[held] for n, c in cols.items()}
            several = bool(is_several[end])
            yield out(cols, np.flatnonzero(first & is_several[run_of] & ~held), True)
            last = (int(gram[-1]), int(print_[-1]))
        if waiting is not None:
            # The last anchor of a task may go on in the next one.
            yield out(waiting, np.arange(1), True)

    order = ["gram", "print", "doc", "tag", "place"]
    # Ranges of both hashes: a frequent anchor is dealt to several tasks, one context is not.
    placed = entries.repartitionByRange("gram", "print").sortWithinPartitions(*order)
    return placed.mapInArrow(run, _FOUND)


def _fetch(source: DataFrame, opened: DataFrame) -> DataFrame:
    """gram, doc, tag, lo and bytes of the open contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, SLICE):
            rows = [(o["gram"], d, t, o["lo"], text[o["lo"] : o["hi"]]) for text, d, t, all_ in zip(
                texts_of(part), *(part.column(c).to_pylist() for c in ("doc", "tag", "opened")), strict=True
            ) for o in all_]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["gram", "doc", "tag", "lo", "bytes"])

    asked = opened.groupBy("doc", "tag").agg(F.collect_list(F.struct("gram", "lo", "hi")).alias("opened"))
    return source.join(asked, ["doc", "tag"]).mapInArrow(run, "gram long, doc long, tag long, lo long, bytes binary")


def _strings(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All strings of the contexts in a batch, the row of each and its start in the document."""
    texts = batch.column("bytes").to_pylist()
    sizes = np.array([len(t) for t in texts], np.int64)
    number = sizes - WIDTH + 1
    row = np.repeat(np.arange(len(texts)), number)
    within = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
    data = np.frombuffer(b"".join(texts), np.uint8)
    windows = np.lib.stride_tricks.sliding_window_view(data, WIDTH)
    at = (np.cumsum(sizes) - sizes)[row] + within
    return np.ascontiguousarray(windows[at]).view(f"S{WIDTH}").ravel(), row, batch.column("lo").to_numpy()[row] + within


class SuffixFamily:
    """Sorted arrays of the strings seen so far: the level of rank r holds about 2^r batches."""

    def __init__(self) -> None:
        self.levels: dict[int, np.ndarray] = {}

    def add(self, strings: np.ndarray) -> np.ndarray:
        """Whether each string has come before, in this batch or an earlier one; the batch is then taken in."""
        suffixes = np.argsort(strings, kind="stable")
        ordered = strings[suffixes]
        repeat = np.zeros(len(strings), bool)
        repeat[1:] = ordered[1:] == ordered[:-1]
        seen = np.zeros(len(strings), bool)
        seen[suffixes[repeat]] = True
        first, distinct = suffixes[~repeat], ordered[~repeat]
        for level in self.levels.values():
            # Both sides are sorted, so the search goes forward through the level.
            at = np.minimum(np.searchsorted(level, distinct), len(level) - 1)
            known = level[at] == distinct
            seen[first[known]] = True
            first, distinct = first[~known], distinct[~known]
        rank = 0
        if len(distinct):
            while rank in self.levels:
                level = self.levels.pop(rank)
                distinct = np.insert(level, np.searchsorted(level, distinct), distinct)
                rank += 1
            self.levels[rank] = distinct
        return seen


def _spans(batch: pa.RecordBatch, row: np.ndarray, start: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
    row, start = row[seen], start[seen]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
    low = np.flatnonzero(new)
    high = np.append(low[1:], len(row)) - 1 if len(low) else low
    doc, tag = (batch.column(c).to_numpy()[row[low]] for c in ("doc", "tag"))
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (doc, tag, start[low], start[high] + WIDTH)], ["doc", "tag", "lo", "hi"])


_SPAN = "doc long, tag long, lo long, hi long"


def _family_spans(opened: DataFrame, tasks: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = SuffixFamily()
        for batch in batches:
            for low in range(0, batch.num_rows, BATCH):
                part = batch.slice(low, BATCH)
                strings, row, start = _strings(part)
                yield _spans(part, row, start, family.add(strings))

    placed = opened.repartition(tasks, "gram").sortWithinPartitions("doc", "tag", "lo")
    return placed.mapInArrow(run, _SPAN)


def _digest_spans(crowded: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, BATCH):
                part = batch.slice(low, BATCH)
                strings, row, start = _strings(part)
                data, width = strings.tobytes(), WIDTH
                digests = b"".join([hashlib.blake2b(data[k : k + width], digest_size=16).digest() for k in range(0, len(data), width)])
                halves = np.frombuffer(digests, np.int64).reshape(-1, 2)
                columns = [halves[:, 0], halves[:, 1], part.column("doc").to_numpy()[row], part.column("tag").to_numpy()[row], start]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], ["h", "k", "doc", "tag", "lo"])

    each = crowded.mapInArrow(run, "h long, k long, doc long, tag long, lo long")
    place = F.struct("doc", "tag", "lo")
    firsts = each.groupBy("h", "k").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = each.join(firsts, ["h", "k"]).where(place != F.col("first"))
    return later.select("doc", "tag", "lo", (F.col("lo") + WIDTH).alias("hi"))


def _open_spans(source: DataFrame, opened: DataFrame) -> DataFrame:
    fetched = materialise(_fetch(source, opened), "open-contexts")
    per_anchor = fetched.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    sizes = materialise(per_anchor.where(F.col("n") > 1), "anchors")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    few = fetched.join(sizes.where(F.col("n") <= CROWDED).select("gram"), "gram", "left_semi")
    many = fetched.join(sizes.where(F.col("n") > CROWDED).select("gram"), "gram", "left_semi")
    return _family_spans(few, max(1, -(-total // PER_TASK))).unionByName(_digest_spans(many))


def _document(docs: DataFrame) -> tuple[Column, Column, bool]:
    """What names a document in order, and whether doc_ids repeat: only then the texts have to tell rows apart."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NONE))
    repeats = not docs.groupBy(doc.alias("doc")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    tag = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))) if repeats else F.lit(0).cast("long")
    return doc, tag, repeats


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc, tag and spans (lists of lo and hi, unmerged) of the documents that repeat something."""
    doc, tag, _ = _document(docs)
    return _repeated(docs.select(doc.alias("doc"), tag.alias("tag"), F.col("text").cast("string").alias("text")))


def _repeated(source: DataFrame) -> DataFrame:
    found = materialise(_judge(_entries(source)), "contexts")
    covered = found.where(F.col("gram").isNull()).drop("gram")
    spans = covered.unionByName(_open_spans(source, found.where(F.col("gram").isNotNull())))
    return spans.groupBy("doc", "tag").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def _cut(text: bytes, spans: list | None, whole: bool) -> tuple[int, int, list[dict], bytes]:
    """How many bytes there are and are removed, the merged spans, and the bytes that stay."""
    merged: list[list[int]] = []
    for lo, hi in [(0, len(text))] if whole else sorted((s["lo"], s["hi"]) for s in spans or ()):
        if merged and lo <= merged[-1][1]:
            merged[-1][1] = max(hi, merged[-1][1])
        else:
            merged.append([lo, hi])
    edges = [0, *(x for span in merged for x in span), len(text)]
    kept = b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)])
    return len(text), len(text) - len(kept), [{"lo": a, "hi": b} for a, b in merged], kept


def deduplicate(docs: DataFrame, keep: list[str] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """The kept columns (all by default) with n_bytes, n_removed, spans (maximal removed runs) and kept (bytes) per row.

    The second value tells under which names, since the table may have columns of the same ones.
    """
    columns = keep if keep is not None else docs.columns
    names = {n: spare(docs, n) for n in ("n_bytes", "n_removed", "spans", "kept")}
    doc, tag, repeats = _document(docs)
    own = [spare(docs, c) for c in ("_doc", "_tag", "_text", "_copy", "_spans")]
    id_, tag_, text_, copy_, spans_ = own
    text = F.col("text").cast("string")
    spans = _repeated(docs.select(doc.alias("doc"), tag.alias("tag"), text.alias("text")))
    spans = spans.select(F.col("doc").alias(id_), F.col("tag").alias(tag_), F.col("spans").alias(spans_))
    source = docs.select(*[F.col(f"`{c}`") for c in columns], doc.alias(id_), tag.alias(tag_), text.alias(text_))
    joined = source.join(spans, [id_, tag_], "left")
    copy = F.lit(1)
    if repeats:
        copy = F.row_number().over(Window.partitionBy(id_, tag_).orderBy(F.lit(1)))
    joined = joined.withColumn(copy_, copy).select(*[F.col(f"`{c}`") for c in columns], text_, spans_, copy_)
    schema = joined.drop(text_, spans_, copy_).schema
    runs = ArrayType(StructType().add("lo", "long").add("hi", "long"))
    for key, kind in zip(names, ("long", "long", runs, "binary"), strict=True):
        schema = schema.add(names[key], kind, True)
    span = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, SLICE, text_):
            texts, found, copies = texts_of(part, text_), part.column(spans_).to_pylist(), part.column(copy_).to_pylist()
            rows = [_cut(t, s, c > 1 and len(t) >= WIDTH) for t, s, c in zip(texts, found, copies, strict=True)]
            added = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), span, pa.binary()), strict=True)]
            old = [c for c, n in zip(part.columns, part.schema.names, strict=True) if n not in (text_, spans_, copy_)]
            yield pa.RecordBatch.from_arrays([*old, *added], [*columns, *names.values()])

    return joined.mapInArrow(run, schema), names
