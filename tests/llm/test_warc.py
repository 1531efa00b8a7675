import base64
import hashlib
import io
import random
import struct
from collections import Counter

import pytest
import zstandard

from pulseloom.llm import warc
from pulseloom.session import scratch_path

PAGES = "page_id long, url string, html string, digest string, payload int"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, f"http://x/{i}?é", h, "mine", 1) for i, h in rows], PAGES)


def archive(records, **options):
    file = io.BytesIO()
    warc.write_records(file, iter(records))
    return file.getvalue()


def test_round_trip(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["<p>", "é", "word", "x" * 30]) for _ in range(rng.randint(0, 400))) for _ in range(200)]
    rows = [(i, rng.choice(texts[:40]) if i % 3 else texts[i]) for i in range(200)]
    rows += [(300, None), (301, ""), (302, None), (None, texts[0]), (400, "y" * 3_000_000), (500, "twice"), (500, "twice")]
    manifest = warc.write_archives(pages_of(spark, rows).repartition(3), scratch_path(spark, "warc"))
    found = warc.read_archives(manifest).withColumn("page_id", warc.page_of("record_id")).withColumn("to", warc.page_of("refers_to"))
    newest = {}
    for i, h in rows:
        newest[h or ""] = max(newest.get(h or "", -1), -1 if i is None else i)
    want = Counter()
    for i, h in rows:
        data, last = (h or "").encode(), newest[h or ""]
        is_response = i == last
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want[(i, len(data), digest, "response" if is_response else "revisit", None if is_response else last, data if is_response else None)] += 1
    got = Counter(
        (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.to, None if r.payload is None else bytes(r.payload)) for r in found.collect()
    )
    assert got == want
    assert found.where("problem is not null").count() == 0
    assert manifest.agg({"records": "sum"}).first()[0] == len(rows)


def test_no_rows(spark):
    manifest = warc.write_archives(pages_of(spark, []), scratch_path(spark, "warc"))
    assert warc.read_archives(manifest).count() == 0


def test_dictionary_is_in_the_leading_skippable_frame():
    records = [warc.record(i, "u", f"<html>{'some text ' * 20}{i}</html>".encode(), None, False) for i in range(400)]
    data = archive(records)
    magic, size = struct.unpack("<II", data[:8])
    assert magic == warc.SKIPPABLE_MAGIC and data[8 : 8 + size][:4] == b"\x37\xa4\x30\xec"
    assert [c for _, c in warc.frames(io.BytesIO(data))] == records
    packed = zstandard.ZstdCompressor().compress(data[8 : 8 + size])
    again = struct.pack("<II", magic, len(packed)) + packed + data[8 + size :]
    assert [c for _, c in warc.frames(io.BytesIO(again))] == records


def test_archive_without_dictionary_and_without_records():
    one = [warc.record(1, None, b"few", None, False)]
    assert [c for _, c in warc.frames(io.BytesIO(archive(one)))] == one
    assert list(warc.frames(io.BytesIO(archive([])))) == []


@pytest.mark.parametrize(
    ("change", "problem"),
    [
        (lambda r: r.replace(b"WARC/1.1", b"WORC/1.1"), "no version line"),
        (lambda r: r.replace(b"WARC-Date: ", b"X-Date: "), "no warc-date"),
        (lambda r: r.replace(b"WARC-Date: ", b"WARC-Date "), "broken headers"),
        (lambda r: r[:-6], "block cut short"),
        (lambda r: r[:-2], "not one record in its frame"),
        (lambda r: r + r, "not one record in its frame"),
        (lambda r: r.replace(b"payload text", b"PAYLOAD text"), "payload digest differs"),
        (lambda r: r.replace(b"Content-Length: 12", b"Content-Length: 13"), "payload length differs"),
    ],
)
def test_checks(change, problem):
    record = warc.record(1, "http://x", b"payload text", None, False)
    assert warc.parse(record)["problem"] is None
    assert warc.parse(change(record))["problem"] == problem


def test_revisits_are_checked():
    record = warc.record(1, "http://x", b"payload", 7, True)
    assert warc.parse(record) | {"problem": None} == warc.parse(record)
    assert b"\r\n\r\npayload" not in record
    assert warc.parse(record.replace(b"WARC-Refers-To", b"X-Refers-To"))["problem"] == "revisit of nothing"


def test_a_broken_frame_ends_its_archive(spark, tmp_path):
    records = [warc.record(i, "u", str(i).encode() * 200, None, False) for i in range(10)]
    data = archive(records)
    for name, broken in (("cut", data[:-3]), ("odd", data[:-40] + b"\0" * 40)):
        (tmp_path / name).write_bytes(broken)
    files = spark.createDataFrame([(str(tmp_path / n),) for n in ("cut", "odd")], "file string")
    found = warc.read_archives(files).collect()
    for name in ("cut", "odd"):
        own = [r for r in found if r.file.endswith(name)]
        assert len(own) >= 9 and [r.problem for r in own if r.problem][0].startswith("frame at")


def test_unknown_scheme_raises(spark):
    files = spark.createDataFrame([("nosuch://x/y",)], "file string")
    with pytest.raises(Exception, match="nosuch"):
        warc.read_archives(files).collect()
