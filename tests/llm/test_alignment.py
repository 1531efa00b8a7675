"""Cross-tokenizer alignment against plain encoding of whole texts and a look at all token pairs."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from pulseloom.llm import alignment
from pulseloom.llm.catalog import QUERIES
from pulseloom.llm.vocabulary import vocabulary_path

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
PIECES = ["a", " ", "  ", "\n", "é", "語", "▁", " ", "\x1c", "\x85", "\0", "'s", "the", "<|endoftext|>", "<s>", "</s>", "<0x41>", "<unk>"]
PIECES += ["don", "12", ".", "\t", "x" * 60, "　", "ﬁ", "é", "​", "😀", " hello world", " wor", "n't", " The quick", ".\nNew"]


@pytest.fixture(scope="module")
def paths():
    return vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain(paths):
    """Ids and byte ends of a whole text, by the libraries and the vocabulary files alone."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(paths[0]), SentencePieceProcessor(model_file=paths[1])
    a.encode_special_tokens = True
    letters = alignment._byte_letters()

    def encode(text):
        if not text:
            return None
        ids_a, ids_b = a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in ids_b)]
        if not b"".join(bytes_a) == b"".join(bytes_b) == f" {text}".encode():
            return None
        return ids_a, ids_b, np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()

    return encode


def overlaps(ends_a, ends_b):
    starts_a, starts_b = [0, *ends_a[:-1]], [0, *ends_b[:-1]]
    links, low = [], 0
    for i in range(len(ends_a)):
        while ends_b[low] <= starts_a[i]:
            low += 1
        j = low
        while j < len(ends_b) and starts_b[j] < ends_a[i]:
            links.append((i, j))
            j += 1
    common = set(ends_a) & set(ends_b)
    return links, *([n + 1 for n, x in enumerate(ends) if x in common] for ends in (ends_a, ends_b))


def brute(rows, plain):
    found, counts = [], Counter()
    for _, text in rows:
        ids = plain(text)
        if ids is None:
            found.append(None)
            continue
        links, ga, gb = overlaps(ids[2], ids[3])
        pairs = [(ids[0][i], ids[1][j]) for i, j in links]
        counts.update(pairs)
        cells = [(ids[0][x:y], ids[1][u:v]) for x, y, u, v in zip([0, *ga], ga, [0, *gb], gb, strict=False)]
        found.append((len(ids[0]), len(ids[1]), cells, pairs))
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    out = []
    for (doc, _), f in zip(rows, found, strict=True):
        if f is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in f[2])
        best = sum(counts[p] == highest[p[1]] for p in f[3])
        out.append((doc, f[0], f[1], len(f[2]), len(f[3]), best, sum(counts[p] for p in f[3]), hashlib.sha256(text.encode()).hexdigest()))
    return out


def summary(docs, paths):
    return [tuple(r) for r in alignment.summarise(docs, *paths).select(*COLUMNS).collect()]


def test_diagonal_runs_equal_all_overlaps():
    pick = random.Random(2)
    for _ in range(1500):
        n = pick.randint(1, 60)
        dense = pick.random()
        shared = [x for x in range(1, n) if pick.random() < dense]
        ends_a, ends_b = (sorted({*shared, n, *[x for x in range(1, n) if pick.random() < 0.1]}) for _ in range(2))
        la, lb, ga, gb = alignment.align(np.array(ends_a), np.array(ends_b))
        assert (list(zip(la, lb, strict=True)), ga, gb) == overlaps(ends_a, ends_b)


def odd_rows(seed, n):
    pick = random.Random(seed)
    return [(d, "".join(pick.choices(PIECES, k=pick.randint(0, 10)))) for d in range(n)]


@pytest.mark.parametrize("hot", [alignment.HOT, 50, 1])
def test_matches_brute_force(docs_of, paths, plain, monkeypatch, hot):
    monkeypatch.setattr(alignment, "HOT", hot)
    rows = [*odd_rows(5, 400), (None, "the end"), (7, "the end"), (7, "the end"), (900, None), (901, "")]
    assert sorted(summary(docs_of(rows), paths), key=str) == sorted(brute(rows, plain), key=str)


def test_small_memory_changes_nothing(plain, paths, monkeypatch):
    monkeypatch.setattr(alignment, "KEPT", 20)
    monkeypatch.setattr(alignment, "JOINED", 60)
    coder = alignment.PairCoder(*paths)
    rows = odd_rows(11, 300)
    for low in range(0, len(rows), 25):
        texts = [t for _, t in rows[low : low + 25]]
        split, known = coder.cut(texts)
        for text, parts in zip(texts, split, strict=True):
            ids = plain(text)
            assert bool(parts) == (ids is not None)
            assert sum(known[p][2] for p in parts) == (len(ids[0]) if ids else 0)
    assert len(coder.young) + len(coder.old) < 400


def test_links_and_groups_of_documents(docs_of, paths, plain):
    rows = odd_rows(13, 40)
    for row in alignment.align_documents(docs_of(rows), *paths).collect():
        ids = plain(dict(rows)[row["doc_id"]])
        if ids is None:
            assert row["groups"] == [] and row["links"] == []
            continue
        links = overlaps(ids[2], ids[3])[0]
        assert [(x["a"], x["b"]) for x in row["links"]] == [(ids[0][i], ids[1][j]) for i, j in links]
        assert [i for g in row["groups"] for i in g["a"]] == ids[0]
        assert [i for g in row["groups"] for i in g["b"]] == ids[1]


def test_long_texts_empty_tables_and_other_columns(docs_of, paths, plain):
    pick = random.Random(3)
    rows = [(1, " ".join("".join(pick.choices("abcdeé.,", k=pick.randint(1, 9))) for _ in range(20_000))), (2, "ab" * 20_000)]
    docs = docs_of(rows, pair=1, row="r", n=2, Pairs=3)
    assert sorted(summary(docs, paths)) == sorted(brute(rows, plain))
    assert summary(docs_of([]), paths) == []


def test_query_matches_brute_force(spark, plain):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op12_diagonal_alignment"](spark, SF_DIR)
    assert dict(found.dtypes) == {c: "string" if c == "groups_sha256" else "bigint" for c in COLUMNS}
    assert sorted(map(tuple, found.select(*COLUMNS).collect())) == sorted(brute(rows, plain))
