"""Packing token sequences into windows by best-fit decreasing.

Texts are tokenised, and a document longer than a window is cut into full windows and a rest.
Pieces are then placed in order of falling length, each in the open window with the least room
that still takes it; a segment tree over the rooms finds that window.

Only lengths matter for that, and there are at most ``window`` of them. So the plan is made for
the histogram of lengths: equal pieces enter equal windows together, as intervals of ranks. The
driver sees ``window`` counts however many documents there are, and the packing is that of one
pass over all pieces. Each piece looks its rank among equally long pieces up in the plan.

Defined results
---------------
* A NULL text is an empty one; it has the closing token only.
* Cuts are free: a token is in exactly one piece. Ties between equal lengths go by ``doc_id``.
* Rows that repeat a document are packed each on their own.
* A window is padded to ``window`` tokens, unless what it holds is a power of two already.
* An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseloom.functions.ordering import global_rank
from pulseloom.llm.batches import text_slices
from pulseloom.llm.vocabulary import WordTokenizer
from pulseloom.session import materialise

WINDOW = 4096
#: The id that closes each document.
CLOSING_ID = 2
#: Texts that are split into words at a time, in rows and bytes.
SLICE_ROWS, SLICE_BYTES = 512, 2 << 20


class RoomTree:
    """Segment tree over rooms 0..size: which of them have an open window."""

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.open = [False] * (2 * self.leaves)

    def mark(self, room: int, is_open: bool) -> None:
        node = room + self.leaves
        self.open[node] = is_open
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest room of at least ``least`` with an open window."""
        node = least + self.leaves
        while not self.open[node]:
            # Step to the right neighbour, climbing past the ends of finished subtrees.
            while node & 1:
                node //= 2
            if node == 0:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.leaves


def plan(counts: Sequence[int], window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing for ``counts[length]`` pieces of each length up to ``window``.

    Gives (length, first rank, end rank, first window, windows, offset). The i-th of those
    pieces goes to window ``first + i % windows`` at ``offset + i // windows * length``: after a
    piece its window is the tightest one for the next, so windows of equal room fill up alike.
    """
    tree = RoomTree(window)
    stacks: list[list[tuple[int, int]]] = [[] for _ in range(window + 1)]  # by room: ranges of windows
    placed, opened = [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            stacks[room].append((first, n))
            tree.mark(room, True)

    for length in range(window, 0, -1):
        rank = 0
        while rank < counts[length]:
            left = counts[length] - rank
            room = tree.tightest(length)
            is_new = room is None
            if is_new:
                room, first, n = window, opened, left
            else:
                first, n = stacks[room].pop()
            fit = room // length
            used = min(n, left // fit) or 1
            taken = min(left, used * fit)
            placed.append((length, rank, rank + taken, first, used, window - room))
            rank += taken
            put(room - taken // used * length, first, used)
            if is_new:
                opened += used
            else:
                put(room, first + used, n - used)
                if not stacks[room]:
                    tree.mark(room, False)
    return placed


def pieces(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    closing: int = CLOSING_ID,
    keep_ids: bool = False,
    kept_words: int | None = None,
    lasting: bool = True,
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens per piece; with ``keep_ids`` the ids too.

    ``kept_words`` bounds the words that a worker remembers; unless ``lasting``, it forgets them at the
    end of each task. Neither changes a result.
    """
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * keep_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordTokenizer.shared(tokenizer, kept_words)
        try:
            yield from cut_by(encode, batches)
        finally:
            if not lasting:
                encode.forget()

    def cut_by(encode: WordTokenizer, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([closing], dtype="<u4").tobytes()
        for batch in batches:
            rows = (batch.slice(low, SLICE_ROWS) for low in range(0, batch.num_rows, SLICE_ROWS))
            for part in text_slices(rows, SLICE_BYTES):
                out: list[list] = [[], [], [], [], []]
                ids = []
                texts = [t or "" for t in part.column("text").to_pylist()]
                for doc_id, data in zip(part.column("doc_id").to_pylist(), encode.batch(texts), strict=True):
                    data += end
                    total = len(data) // 4
                    for start in range(0, total, window):
                        own = data[4 * start : 4 * (start + window)]
                        for column, value in zip(out, (doc_id, start, len(own) // 4, zlib.crc32(own), total), strict=True):
                            column.append(value)
                        if keep_ids:
                            ids.append(np.frombuffer(own, dtype="<u4").astype(np.int32))
                arrays = [pa.array(c, pa.int64()) for c in out]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if keep_ids:
                    arrays.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(cut, schema)


def pack(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """Add sequence_id and offset to pieces; sequence ids and offsets have no gaps."""
    spark = cut.sparkSession
    cut = materialise(cut, "pieces")
    counts = [0] * (window + 1)
    for length, n in cut.groupBy("length").count().collect():  # at most ``window`` rows
        counts[length] = n
    before, starts = 0, [0] * (window + 1)
    for length in range(window, 0, -1):
        starts[length] = before
        before += counts[length]
    rows = [(s, starts[s] + low, starts[s] + high, *where) for s, low, high, *where in plan(counts, window)]
    table = spark.createDataFrame(rows, "_length long, _low long, _high long, _first long, _windows long, _offset long")
    ranked = global_rank(cut, [-F.col("length"), F.col("doc_id"), F.col("start")], "_rank", start=-1)
    # The plan has a few intervals per length, whatever the number of pieces.
    at = [ranked["length"] == table["_length"], ranked["_rank"] >= table["_low"], ranked["_rank"] < table["_high"]]
    placed = ranked.join(F.broadcast(table), at)
    nth = F.col("_rank") - F.col("_low")
    sequence = (F.col("_first") + nth % F.col("_windows")).alias("sequence_id")
    offset = (F.col("_offset") + F.expr("(_rank - _low) div _windows") * F.col("length")).alias("offset")
    return placed.select(*cut.columns, sequence, offset)


def padded_length(tokens: Column, window: int = WINDOW) -> Column:
    """Tokens of a sequence with its padding."""
    is_power = F.bit_count(tokens) == 1
    return F.when(is_power, tokens).otherwise(F.lit(window))


def sequences(packed: DataFrame, window: int = WINDOW, padding_id: int = 0) -> DataFrame:
    """sequence_id, tokens and the padded ids per sequence, from packed pieces with their ids."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most ``window`` pieces
    grouped = packed.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), ordered.alias("_pieces"))
    ids = F.flatten(F.col("_pieces.ids"))
    padding = F.array_repeat(F.lit(padding_id), (padded_length(F.col("tokens"), window) - F.col("tokens")).cast("int"))
    return grouped.select("sequence_id", "tokens", F.concat(ids, padding).alias("ids"))
