"""The thin queries over the smallest tables, column by column, beside plain Python."""

import hashlib

import pyarrow.parquet as pq
import pytest
import tiktoken
from test_secret_scan import brute_base, brute_linked, joined

from pulseloom.llm import byte_bpe
from pulseloom.llm.catalog import QUERIES
from pulseloom.llm.vocabulary import public_pattern, vocabulary_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents():
    rows = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return [(r["doc_id"], r["text"] or "") for r in rows]


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_linked_secrets(spark, documents):
    found = QUERIES["op4_linked_secrets"](spark, SF)
    got = found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
    assert [t for _, t in got.dtypes] == ["bigint"] * 4 + ["string"] * 2
    want = []
    for doc_id, text in documents:
        base = brute_base(text)
        numbers = [sum(p[0] == kind for p in base) for kind in ("assign", "access", "hex")]
        want.append((doc_id, *numbers, sha256(joined(base)), joined(brute_linked(text))))
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_recursive_bpe(spark, documents):
    path = vocabulary_path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_pattern(), mergeable_ranks=byte_bpe.ranks(path), special_tokens={})
    got = QUERIES["op10_recursive_bpe"](spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert [t for _, t in got.dtypes] == ["bigint", "bigint", "string", "string"]
    ids = [(doc_id, text, library.encode_ordinary(text)) for doc_id, text in documents]
    want = [(doc_id, len(i), sha256(",".join(map(str, i))), sha256(text)) for doc_id, text, i in ids]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
