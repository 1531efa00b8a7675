import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from pulseloom.llm import secret_scan as scan

HEX = "0123456789abcdef" * 2
KEY = "AKIA" + "ABCD1234EFGH5678"
OPAQUE = "Zx9" * 9


def brute_base(text):
    """The contract's patterns one by one, without any shortcut."""
    text = text or ""
    assign = re.compile(
        "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        "[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    )
    found = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 8]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found, key=lambda p: (p[1], ["assign", "access", "hex"].index(p[0])))


def brute_linked(text):
    """Weak parts with a complement in the same block, block by block of the text."""
    text = text or ""
    strong = scan.strong_parts(text)
    parts = strong + scan.weak_parts(text, strong)
    out, low = list(strong), 0
    for edge in [*(m.start() + 1 for m in scan.BLANK_LINE.finditer(text)), len(text) + 1]:
        inside = [p for p in parts if low <= p[1] < edge]
        roles = {scan.ROLES[p[0]] for p in inside}
        weak = [p for p in inside if p[0] in ("user", "opaque", "endpoint")]
        out += [p for p in weak if ("secret" in roles if p[0] != "opaque" else roles & {"id", "place"})]
        low = edge
    return sorted(out, key=lambda p: (p[1], scan.KINDS.index(p[0])))


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def random_text(rng):
    parts = [
        f"password={HEX[:18]}", f'Token = "{HEX}{HEX[:8]}"', KEY, HEX, "user: bob", "https://db.example.org/x", OPAQUE, "\n\n", "\n \t\n",
        "ſecret=abcdefghij", "api_key:short", "password=token:abcdefghijk", "word " * 30, "filler text. ", "é€😀 ", "x" * 500 + " ",
    ]
    return " ".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))


def test_matches_brute_force(docs_of):
    rng = random.Random(1)
    rows = [(i, random_text(rng)) for i in range(150)] + [(200, None), (201, ""), (1, "user: bob " + KEY), (1, "user: bob " + KEY)]
    docs = docs_of(rows, row="x", parts="y", kind="z", start=1)
    found = scan.scan(docs).select("doc_id", scan.span_text(F.col("base")).alias("b"), scan.span_text(F.col("spans")).alias("s"))
    want = sorted(((i, joined(brute_base(t)), joined(brute_linked(t))) for i, t in rows), key=str)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("user: bob and nothing else", []),
        (f"see {OPAQUE}", []),
        ("https://db.example.org/x", []),
        (f"user: bob\n{OPAQUE}", ["user", "opaque"]),
        (f"user: bob\n\n{OPAQUE}", []),
        (f"user: bob {'x ' * 300}{OPAQUE}", ["user", "opaque"]),
        (f"https://db.example.org/x {'y ' * 2500}{OPAQUE} {'y ' * 2500}\n\nuser: bob", ["endpoint", "opaque"]),
        (f"https://db.example.org/x {OPAQUE}", ["endpoint", "opaque"]),
        ("https://db.example.org/x user: bob", []),
        (f"{KEY} https://db.example.org/x {HEX}", ["access", "endpoint", "hex"]),
    ],
)
def test_weak_parts_need_a_complement(docs_of, text, kinds):
    assert [s.kind for s in scan.scan(docs_of([(1, text)])).first().spans] == kinds


def test_redact(docs_of):
    text = f"é password={HEX[:18]} and {HEX}."
    rows = [(1, text), (1, text), (2, "clean"), (3, None), (4, ""), (None, KEY)]
    docs = docs_of(rows, marks="mine", key=3)
    found = scan.redact(docs)
    assert found.columns == docs.columns
    got = sorted(((r.doc_id, r.text, r.n_chars) for r in found.where("marks = 'mine' and key = 3").collect()), key=str)
    marked = "é [assign] and [hex]."
    want = [(1, marked, len(marked)), (1, marked, len(marked)), (2, "clean", 5), (3, None, None), (4, "", 0), (None, "[access]", 8)]
    assert got == sorted(want, key=str)


def test_many_parts_in_one_scope(docs_of):
    text = " ".join([f"user: bob{i}" for i in range(3000)] + [HEX])
    spans = scan.scan(docs_of([(1, text)])).first().spans
    assert [(s.kind, s.start, s.end) for s in spans] == brute_linked(text) and len(spans) == 3001


def test_no_rows(docs_of):
    assert scan.scan(docs_of([])).count() == 0
    assert scan.redact(docs_of([])).count() == 0


def test_digest_of_no_spans(docs_of):
    found = scan.scan(docs_of([(1, None)])).select(F.sha2(scan.span_text(F.col("base")), 256).alias("h")).first()
    assert found.h == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("size", [450, 2_001, 30_000])
def test_long_parts_are_linked_to_what_follows_them(docs_of, size):
    token = ("Zx9" * size)[:size]
    texts = [f"{token}\nhttps://db.example.org/x", f"password={'k' * size}\nuser: bob", f"https://db.example.org/{'p' * size} {OPAQUE}"]
    found = scan.scan(docs_of(list(enumerate(texts)))).collect()
    kinds = {r.doc_id: [s.kind for s in r.spans] for r in found}
    assert kinds == {0: ["opaque", "endpoint"], 1: ["assign", "user"], 2: ["endpoint", "opaque"]}


def test_parts_of_any_length_match_blocks(docs_of):
    rng = random.Random(2)
    make = [
        lambda n: ("Zx9" * n)[: max(20, n)], lambda n: "https://db.example.org/" + "p" * n, lambda n: "user: bob" + "b" * n,
        lambda n: "password=abcdefgh" + "a" * n, lambda n: "x " * (n // 2), lambda n: "\n\n", lambda n: "y " * 150,
    ]
    rows = [(i, " ".join(rng.choice(make)(rng.choice([5, 70, 390, 800, 2500])) for _ in range(rng.randint(2, 9)))) for i in range(200)]
    found = scan.scan(docs_of(rows)).collect()
    assert {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in found} == {i: brute_linked(t) for i, t in rows}
