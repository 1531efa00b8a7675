import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulseloom.llm import packing
from pulseloom.llm.vocabulary import WordTokenizer, vocabulary_path

VOCABULARY = vocabulary_path("word_bpe_49k.json")


def brute_rooms(sizes, window):
    rooms = []
    for size in sorted(sizes, reverse=True):
        open_ones = [(room, n) for n, room in enumerate(rooms) if room >= size]
        if open_ones:
            rooms[min(open_ones)[1]] -= size
        else:
            rooms.append(window - size)
    return sorted(rooms)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 40).flatmap(lambda w: st.tuples(st.just(w), st.lists(st.integers(1, w), max_size=120))))
def test_plan_is_best_fit_decreasing(case):
    window, sizes = case
    counts = [0] * (window + 1)
    for size in sizes:
        counts[size] += 1
    filled, seen = {}, [0] * (window + 1)
    for length, low, high, first, windows, offset in packing.plan(counts, window):
        assert low == seen[length]
        seen[length] = high
        for i in range(high - low):
            w = first + i % windows
            assert filled.get(w, 0) == offset + i // windows * length
            filled[w] = filled.get(w, 0) + length
    assert seen == counts and sorted(filled) == list(range(len(filled)))
    assert sorted(window - n for n in filled.values()) == brute_rooms(sizes, window)


def test_tree_finds_the_tightest_room():
    tree, rooms = packing.RoomTree(37), set()
    rng = random.Random(3)
    for _ in range(500):
        room = rng.randint(0, 37)
        rooms ^= {room}
        tree.mark(room, room in rooms)
        least = rng.randint(0, 37)
        assert tree.tightest(least) == min((r for r in rooms if r >= least), default=None)


@pytest.mark.parametrize("window", [16, 4096])
def test_pieces_cover_documents_and_sequences(docs_of, window):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["the", "Once", "naïve,", "12.5", "x=1"]) for _ in range(rng.randint(0, 60))) for _ in range(80)]
    rows = list(enumerate([*texts, None, "", "same text", "word " * 5000])) + [(82, "same text")]
    packed = packing.pack(packing.pieces(docs_of(rows, length="mine", sequence_id=1), VOCABULARY, window, keep_ids=True), window)
    found = packed.collect()
    tokenizer = WordTokenizer(VOCABULARY).tokenizer
    whole = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in rows}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        assert r.ids == whole[r.doc_id][r.start : r.start + r.length] and r.doc_tokens == len(whole[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, parts in by_doc.items():
        copies = sum(1 for j, _ in rows if j == i)
        assert sum(p.length for p in parts) == copies * len(whole[i])
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
    assert sorted(window - sum(p.length for p in s) for s in by_sequence.values()) == brute_rooms([r.length for r in found], window)
    full = packing.sequences(packed, window).collect()
    assert sum(r.tokens for r in full) == sum(r.length for r in found)
    assert all(len(r.ids) == (r.tokens if r.tokens & (r.tokens - 1) == 0 else window) for r in full)


def test_no_rows(docs_of):
    assert packing.pack(packing.pieces(docs_of([]), VOCABULARY)).count() == 0


def test_words_are_encoded_as_the_whole_text():
    coder = WordTokenizer(VOCABULARY)
    texts = ["a\0b c", "\0 x \0", "ÀÉ ß ΑΣ Σ ", "x" * 300 + " y", "a\x1cb \x85c d", "<|endoftext|> hi", "é ́x", "", "I'm 12½ don't!!"]
    for text in [*texts, " ".join(texts)]:
        want = coder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(coder.batch([text])[0], "<u4").tolist() == want


def test_special_tokens_in_texts_are_found_as_by_default():
    from tokenizers import Tokenizer

    plain, coder = Tokenizer.from_file(VOCABULARY), WordTokenizer(VOCABULARY)
    texts = ["hello <|endoftext|> world", "a<|endoftext|>b", "<|startoftext|>a", "<|endoftext|><|endoftext|>", "< |endoftext|>", "X<|EndOfText|>y"]
    texts += [f"{a}<|startoftext|>{b} c" for a in ("", " ", "é", "\0", "\n") for b in ("", "q", ".", " z")]
    for text in [*texts, " ".join(texts)]:
        assert np.frombuffer(coder.batch([text])[0], "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert plain.encode(texts[0], add_special_tokens=False).ids == [3306, 49407, 1002]


def test_forgetting_words_changes_nothing(monkeypatch):
    from pulseloom.llm import vocabulary

    texts = [" ".join(f"w{i * 7 % 50}{j}" for j in range(20)) for i in range(40)]
    want = WordTokenizer(VOCABULARY).batch(texts)
    monkeypatch.setattr(vocabulary, "KEPT_WORDS", 30)
    small = WordTokenizer(VOCABULARY)
    assert [small.batch([t])[0] for t in texts] == want


def test_kept_words_are_bounded_per_coder():
    texts = [" ".join(f"w{i * 7 % 50}{j}" for j in range(20)) for i in range(40)]
    small = WordTokenizer(VOCABULARY, 30)
    for text in texts:
        small.batch([text])
        assert len(small.known) <= 30
    assert WordTokenizer.shared(VOCABULARY, 30) is not WordTokenizer.shared(VOCABULARY)


def test_workers_forget_words_at_the_end_of_a_task(spark, docs_of):
    def words_held(kept):
        def count(batches):
            for _ in batches:
                yield pa.RecordBatch.from_arrays([pa.array([len(WordTokenizer.shared(VOCABULARY, kept).known)])], ["words"])

        return sum(r.words for r in spark.range(0, 40, 1, 8).mapInArrow(count, "words long").collect())

    docs = docs_of([(i, f"some words{i} here") for i in range(40)])
    lasting, passing = (packing.pieces(docs, VOCABULARY, kept_words=k, lasting=k == 777) for k in (777, 778))
    assert sorted(lasting.collect()) == sorted(passing.collect())
    assert any(words_held(777) for _ in range(10))
    assert not any(words_held(778) for _ in range(3))


def test_padding(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4095,), (4096,)], "n int")
    assert [r[0] for r in df.select(packing.padded_length(F.col("n"))).collect()] == [1, 2, 4096, 4096, 4096]
