import random

import numpy as np
import pytest
import tiktoken

from pulseloom.llm import byte_bpe
from pulseloom.llm.vocabulary import public_pattern, vocabulary_path

PATH, PATTERN = vocabulary_path("byte_bpe_multi_50k.tiktoken"), public_pattern()


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.ByteBpe(PATH, PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.ranks(PATH), special_tokens={})


def texts():
    rng = random.Random(1)
    letters = " \n\t\x0b\x0c\r\x1c\x1f\x85\xa0 　aZé中'st12½_-!.😀́"
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(600)]
    out += [" ".join(rng.choice(["the", "and", "thndhain,", "Über", "été."]) for _ in range(50)) for _ in range(50)]
    return [*out, "", " ", "  a", "a ", "<|endoftext|>", "I'll don't"]


def test_ids_are_those_of_the_library(coder, library):
    found = coder.encode(texts())
    assert [np.frombuffer(f, "<i4").tolist() for f in found] == [library.encode_ordinary(t) for t in texts()]


@pytest.mark.parametrize("word", ["a" * 1500, "ab" * 700, "=-" * 200, "abcdefgh" * 90, "é" * 300, " " * 900, "\n" * 333])
def test_long_words(coder, library, word):
    assert np.frombuffer(coder.encode([word])[0], "<i4").tolist() == library.encode_ordinary(word)


def test_very_long_words_take_seconds(coder, library):
    import base64
    import time

    rng = random.Random(5)
    started = time.perf_counter()
    letters = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200_000))
    blob = base64.b64encode(rng.randbytes(700_000)).decode()
    found = [np.frombuffer(coder.encode([w])[0], "<i4").tolist() for w in (letters, blob)]
    assert time.perf_counter() - started < 60
    # The library needs a long time for one long word, so both are compared with what they decode to and in part.
    assert [coder.decode([np.array(f, np.int32)])[0].decode() for f in found] == [letters, blob]
    cut = [m for m in coder.pattern.findall(blob) if len(m) < 2000]
    assert [i for w in cut[:4000] for i in library.encode_ordinary(w)] == [i for w in cut[:4000] for i in np.frombuffer(coder.encode([w])[0], "<i4").tolist()]


def test_parts_of_words_are_encoded_alone(coder, library):
    rng = random.Random(6)
    for size in (60, 500, 3000):
        word = "".join(rng.choice("abcxyzqé") for _ in range(size))
        parts = coder._parts(word.encode())
        assert b"".join(parts) == word.encode() and len(parts) > 1
        assert np.frombuffer(coder.encode([word])[0], "<i4").tolist() == library.encode_ordinary(word)


def test_random_long_words(coder, library):
    rng = random.Random(2)
    for size in (60, 300, 900):
        word = "".join(rng.choice("abcdefghij") for _ in range(size))
        assert np.frombuffer(coder.encode([word])[0], "<i4").tolist() == library.encode_ordinary(word)


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KEPT", 5)
    monkeypatch.setattr(byte_bpe, "ROWS", 60)
    small = byte_bpe.ByteBpe(PATH, PATTERN)
    for text in texts()[-40:]:
        ids = np.frombuffer(small.encode([text])[0], "<i4")
        assert ids.tolist() == library.encode_ordinary(text)
        assert small.decode([ids])[0] == text.encode()


def test_many_words_of_the_greatest_short_length(coder, library):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghij") for _ in range(byte_bpe.SHORT_BYTES)) for _ in range(12_000)]
    found = coder.encode(words)
    assert [np.frombuffer(f, "<i4").tolist() for f in found] == [library.encode_ordinary(w) for w in words]
    assert not [w for w in coder.words if len(w) > byte_bpe.SHORT_BYTES]


def test_decoding_any_ids(coder, library):
    rng = random.Random(3)
    lists = [np.array([rng.randrange(50_256) for _ in range(rng.randint(0, 60))], np.int32) for _ in range(100)]
    assert coder.decode(lists) == [library.decode_bytes(ids.tolist()) for ids in lists]
    for odd in (-1, 50_256, 10**6):
        with pytest.raises(ValueError, match="not in the vocabulary"):
            coder.decode([np.array([5, odd], np.int32)])


def test_frames(docs_of, library):
    rows = [*enumerate(texts()[:120]), (500, None), (1, "again"), (1, "again"), (None, "no id")]
    encoded = byte_bpe.encode(docs_of(rows, ids="mine", decoded=1), PATH, PATTERN)
    found = byte_bpe.decode(encoded, PATH, PATTERN).collect()
    got = sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in found), key=str)
    assert got == sorted(((i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows), key=str)


def test_no_rows_and_null_ids(docs_of, spark):
    assert byte_bpe.decode(byte_bpe.encode(docs_of([]), PATH, PATTERN), PATH, PATTERN).count() == 0
    row = byte_bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), PATH, PATTERN).first()
    assert row.ids == [] and bytes(row.decoded) == b""
