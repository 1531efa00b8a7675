"""Secret scans that link the parts of a credential.

A scan finds parts of three roles: identifiers (access keys, user names), secrets (assignments,
long hex, opaque tokens) and endpoints. Assignments, access keys and long hex are strong and
always reported. User names, opaque tokens and endpoints are weak: they are reported only where
a complementary part stands in the same scope, a block between blank lines, however far apart.

The link is an interval join: a part lies in the scope that holds its start. Per document and
scope the roles that occur come to one row of three at most, and each weak part meets that row,
so the work grows with the parts and not with their pairs.

Defined results
---------------
* A NULL text is an empty one, without spans.
* Positions are code points of the whole text, ends exclusive.
* Spans stand by start, then kind in the order of ``KINDS``, and may overlap.
* Rows that repeat ``doc_id`` and text are scanned each and get the same spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseloom.llm.columns import spare, text_key
from pulseloom.session import materialise

#: Kinds of span in the order they are listed, strong ones first.
KINDS = ["assign", "access", "hex", "user", "opaque", "endpoint"]
STRONG = 3
ROLES = {"assign": "secret", "hex": "secret", "opaque": "secret", "access": "id", "user": "id", "endpoint": "place"}
#: What must stand in the scope of a weak part of a role.
COMPLEMENTS = {"id": ["secret"], "secret": ["id", "place"], "place": ["secret"]}

# The patterns of the strong kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_WORDS = ["password", "passwd", "secret", "token", "apikey", "api_key"]
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 8, 16, 32

USER = re.compile(r"""\b(user|username|login|client_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]{3,})""", re.ASCII | re.IGNORECASE)
USER_WORDS = ["user", "login", "client"]
ENDPOINT = re.compile(r"\b[a-z][a-z0-9+.-]{1,15}://[^\s\"'<>]{3,}", re.ASCII)
#: Whole runs of token characters; a run of hex digits lies inside one.
RUN = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{20,}")
BLANK_LINE = re.compile(r"\n[ \t\r]*\n")

Part = tuple[str, int, int]


def strong_parts(text: str) -> list[Part]:
    """Assignments, access keys and long hex, by kind."""
    found: list[Part] = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    for run in RUN.finditer(text):
        if len(run[0]) >= HEX_CHARS:
            spans = (m.span() for m in HEX.finditer(text, *run.span()))
            found += [("hex", low, high) for low, high in spans if high - low >= HEX_CHARS]
    return found


def _is_opaque(token: str) -> bool:
    return any(c.isdigit() for c in token) and any(c.isupper() for c in token) and any(c.islower() for c in token)


def weak_parts(text: str, strong: list[Part]) -> list[Part]:
    """User names, opaque tokens and endpoints that share no character with a strong part."""
    found: list[Part] = []
    lower = text.lower()
    if any(word in lower for word in USER_WORDS):
        found += [("user", *m.span()) for m in USER.finditer(text)]
    if "://" in text:
        found += [("endpoint", *m.span()) for m in ENDPOINT.finditer(text)]
    found += [("opaque", *m.span()) for m in RUN.finditer(text) if _is_opaque(m[0])]
    taken = sorted([p[1:] for p in strong] + [p[1:] for p in found if p[0] == "endpoint"])
    free, at, reached = [], 0, 0
    for part in sorted(found, key=lambda p: p[1]):
        while at < len(taken) and taken[at][0] < part[2]:
            if part[0] != "endpoint" or taken[at] != part[1:]:
                reached = max(reached, taken[at][1])
            at += 1
        if part[0] == "endpoint" or reached <= part[1]:
            free.append(part)
    return free


def find_parts(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and parts (kind, start, end, scope) per row."""
    part_type = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("scope", pa.int64())])

    def parts_of(text: str) -> list[dict]:
        strong = strong_parts(text)
        parts = strong + weak_parts(text, strong)
        if not parts:
            return []
        breaks = [m.start() for m in BLANK_LINE.finditer(text)]
        rows, scope = [], 0
        for kind, start, end in sorted(parts, key=lambda p: p[1]):
            while scope < len(breaks) and breaks[scope] < start:
                scope += 1
            rows.append({"kind": kind, "start": start, "end": end, "scope": scope})
        return rows

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = pa.array([parts_of(t or "") for t in batch.column("text").to_pylist()], pa.list_(part_type))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), parts], ["doc_id", "text_key", "parts"])

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), text_key().alias("text_key")
    )
    return source.mapInArrow(scan, "doc_id long, text_key string, parts array<struct<kind:string,start:long,end:long,scope:long>>")


def _case(column: Column, mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])[column]


def link_weak(parts: DataFrame) -> DataFrame:
    """The weak parts with a complement in their scope: row, kind, start, end."""
    placed = parts.select("row", F.explode("parts").alias("p")).select("row", "p.*").withColumn("role", _case(F.col("kind"), ROLES))
    scopes = placed.groupBy("row", "scope").agg(F.collect_set("role").alias("roles"))
    wanted = F.split(_case(F.col("role"), {r: "|".join(c) for r, c in COMPLEMENTS.items()}), r"\|")
    weak = placed.where(F.col("kind").isin(KINDS[STRONG:])).withColumn("wanted", wanted)
    return weak.join(scopes, ["row", "scope"]).where(F.arrays_overlap("wanted", "roles")).select("row", "kind", "start", "end")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, base and spans per row; both are arrays of (start, place, end, kind)."""
    found = materialise(find_parts(docs).withColumn("row", F.monotonically_increasing_id()), "parts")
    spans = "array<struct<start:long,place:int,end:long,kind:string>>"

    def listed(parts: Column) -> Column:
        place = lambda kind: F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind).cast("int")
        shaped = F.transform(parts, lambda p: F.struct(p["start"].alias("start"), place(p["kind"]).alias("place"), p["end"].alias("end"), p["kind"].alias("kind")))
        return F.array_sort(shaped).cast(spans)

    strong = F.filter("parts", lambda p: p["kind"].isin(KINDS[:STRONG]))
    # All parts of one row come from one text.
    linked = link_weak(found.where(F.size("parts") > 1)).groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("weak"))
    weak = F.coalesce("weak", F.array().cast("array<struct<kind:string,start:long,end:long>>"))
    bare = F.transform(strong, lambda p: F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end")))
    both = found.join(linked, "row", "left")
    return both.select("doc_id", "text_key", listed(bare).alias("base"), listed(F.concat(bare, weak)).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame) -> DataFrame:
    """The documents with a mark in place of every reported span, ``n_chars`` set to fit."""

    def blot(text: str, spans: list[dict]) -> str:
        out, at = [], 0
        for span in spans:
            if span["start"] >= at:
                out += [text[at : span["start"]], f"[{span['kind']}]"]
            at = max(at, span["end"])
        return "".join([*out, text[at:]])

    own, other, marks = (spare(docs, n) for n in ("key", "found_key", "marks"))

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("text").to_pylist(), batch.column(marks).to_pylist(), strict=True)
            texts = pa.array([blot(t, s) for t, s in rows], pa.string())
            names = [n for n in batch.schema.names if n != marks]
            yield pa.RecordBatch.from_arrays([texts if n == "text" else batch.column(n) for n in names], names)

    found = scan(docs).where(F.size("spans") > 0).select(F.col("text_key").alias(other), F.col("spans").alias(marks))
    found = materialise(found.dropDuplicates([other]), "spans")
    keyed = docs.withColumn(own, text_key())
    marked = keyed.join(found, keyed[own] == found[other], "left").select(*docs.columns, marks)
    clean = marked.where(F.col(marks).isNull()).select(*docs.columns)
    changed = marked.where(F.col(marks).isNotNull()).mapInArrow(rewrite, docs.schema)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        changed = changed.withColumn("n_chars", F.char_length("text").cast(kind))
    return clean.unionByName(changed)
