"""File loads, the ledger, samples and the file stream."""

import datetime
import hashlib

import pytest
from pyspark.sql import functions as F

from pulseloom.sources import files, samples
from pulseloom.sources.ledger import StagingArea, ledger_status
from pulseloom.sources.profiles import LoadProfile
from pulseloom.streaming.jobs import StreamIngest

AS_OF = datetime.datetime(2024, 1, 1)
HEADER = "comment_id,subreddit,text,score,created_at\n"


@pytest.fixture
def area(spark, tmp_path):
    return StagingArea(spark, str(tmp_path / "staging"), {"raw_reddit": LoadProfile(file="present.csv"), "raw_allocine": LoadProfile(file="absent.csv")})


def put(tmp_path, name, text, encoding="utf-8"):
    path = tmp_path / name
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_same_content_loads_once_unless_forced(area, tmp_path):
    path = put(tmp_path, "a.csv", HEADER + "r1,tech,hello,5,2024-01-01\n")
    copy = put(tmp_path, "b.csv", HEADER + "r1,tech,hello,5,2024-01-01\n")
    assert area.load(path, "raw_reddit", AS_OF) == "LOADED"
    assert area.load(copy, "raw_reddit", AS_OF) == "SKIPPED_DUPLICATE"
    assert area.table("raw_reddit").count() == 1
    assert area.load(path, "raw_reddit", AS_OF, force=True) == "FORCED_RELOAD"
    assert area.table("raw_reddit").count() == 2
    log = [(r["log_id"], r["status"], r["row_count"]) for r in area.ledger().orderBy("log_id").collect()]
    assert log == [(1, "LOADED", 1), (2, "SKIPPED_DUPLICATE", 0), (3, "FORCED_RELOAD", 1)]
    assert area.ledger().first()["file_hash"] == hashlib.sha256(open(path, "rb").read()).hexdigest()


def test_load_all_statuses_and_truncate(area, tmp_path):
    put(tmp_path, "present.csv", HEADER + "r1,tech,hello,5,2024-01-01\n")
    assert area.load_all(str(tmp_path), AS_OF) == {"raw_reddit": "LOADED", "raw_allocine": "MISSING_FILE"}
    assert area.load_all(str(tmp_path), AS_OF)["raw_reddit"] == "SKIPPED_DUPLICATE"
    put(tmp_path, "absent.csv", "text,review_id,rating,review_date\nbien,a1,not a number,2024-01-01\n")
    assert area.load_all(str(tmp_path), AS_OF) == {"raw_reddit": "SKIPPED_DUPLICATE", "raw_allocine": "FAILED"}
    assert not area.truncate("raw_reddit") and area.table("raw_reddit").count() == 1
    assert area.truncate("raw_reddit", confirm=True) and area.table("raw_reddit").count() == 0
    assert area.load_all(str(tmp_path), AS_OF)["raw_reddit"] == "LOADED"


def test_latin_1_quotes_and_line_breaks(area, spark, tmp_path):
    path = put(tmp_path, "l.csv", HEADER + 'r1,fr,"café, ""trop""\ncher",5,2024-01-01\n', "latin-1")
    assert list(files.detect_encodings(spark, path).values()) == ["latin-1"]
    area.load(path, "raw_reddit", AS_OF)
    assert area.table("raw_reddit").first()["text"] == 'café, "trop"\ncher'


def test_profile_names_zoned_dates_and_notes(spark, tmp_path):
    area = StagingArea(spark, str(tmp_path / "staging"))
    path = put(tmp_path, "s.csv", '"0","1","Mon Apr 06 22:19:45 PDT 2009","NO_QUERY","ana","triste"\n"4","2","soon","NO_QUERY","bob","ok"\n')
    area.load(path, "raw_sentiment140", AS_OF)
    rows = {r["tweet_id"]: r for r in area.table("raw_sentiment140").collect()}
    assert str(rows[1]["tweet_date"]) == "2009-04-06 22:19:45" and rows[2]["tweet_date"] is None
    assert rows[1]["polarity"] == 0 and rows[1]["source_file"] == "s.csv"
    assert any("flag" in n for n in area.notes) and any("1 values of tweet_date" in n for n in area.notes)


def test_generated_ids_survive_a_reload(spark, tmp_path):
    area = StagingArea(spark, str(tmp_path / "staging"))
    path = put(tmp_path, "f.csv", "label,text\n1,super\n0,nul\n")
    area.load(path, "raw_twitter_fr", AS_OF)
    area.load(path, "raw_twitter_fr", AS_OF, force=True)
    ids = [r["tweet_id"] for r in area.table("raw_twitter_fr").collect()]
    assert len(ids) == 4 and len(set(ids)) == 2
    assert int(hashlib.md5(b"1|super").hexdigest(), 16) % 2**62 in ids
    assert any("tweet_date" in n for n in area.notes)


def test_unknown_suffix_and_table_raise(spark, area, tmp_path):
    with pytest.raises(ValueError):
        files.scan_delimited(spark, str(tmp_path / "x.pdf"))
    with pytest.raises(ValueError):
        area.load(put(tmp_path, "z.csv", "a\n1\n"), "raw_nothing", AS_OF)


def test_large_files_hash_in_blocks(spark, tmp_path):
    path = put(tmp_path, "big.bin", "x" * 10_000)
    from pyarrow import fs

    local = files.file_fingerprints(spark, path, filesystem=fs.LocalFileSystem()).first()["file_hash"]
    assert local == files.file_fingerprints(spark, path).first()["file_hash"] == hashlib.sha256(b"x" * 10_000).hexdigest()


@pytest.mark.parametrize("suffix", [".parquet", ".jsonl", ".csv"])
def test_structured_files_round_trip(spark, tmp_path, suffix):
    df = spark.createDataFrame([(1, 'é "q"\nx'), (2, None)], "id int, text string")
    path = str(tmp_path / f"deep/folder/t{suffix}")
    files.sink_structured(df, path)
    assert sorted((r["id"], r["text"] or "") for r in files.scan_structured(spark, path).collect()) == [(1, 'é "q"\nx'), (2, "")]


def test_json_array_is_read(spark, tmp_path):
    path = put(tmp_path, "a.json", '[{"id": 1, "text": "a"}, {"id": 2, "text": "b"}]')
    assert files.scan_structured(spark, path).count() == 2


def test_force_and_skip_in_bulk(spark):
    attempts = spark.createDataFrame([(1, "h", "t", False), (2, "h", "t", False), (3, "h", "t", True), (4, "h", "u", False)], "id int, file_hash string, table_name string, force boolean")
    found = {r["id"]: r["status"] for r in ledger_status(attempts, "id", "force").collect()}
    assert found == {1: "LOADED", 2: "SKIPPED_DUPLICATE", 3: "FORCED_RELOAD", 4: "LOADED"}


def test_comments_are_enriched_by_the_last_publication(spark):
    comments = spark.createDataFrame([("fb", "1", "c1", "x"), ("fb", "9", "c2", "y")], "plateforme string, id_publication string, id_commentaire string, texte string")
    posts = spark.createDataFrame([("fb", "1", "old", "BBC", 1), ("fb", "1", "new", "CNN", 2)], "plateforme string, id_publication string, texte string, ecole string, line int")
    found = {r["id_commentaire"]: (r["texte"], r["texte_publication"], r["ecole"]) for r in samples.enrich_comments(comments, posts, "line").collect()}
    assert found == {"c1": ("x", "new", "CNN"), "c2": ("y", None, None)}
    with pytest.raises(ValueError):
        samples.enrich_comments(comments.drop("texte"), posts, "line")


def test_sample_ids_are_numbered_in_hash_order(spark):
    df = spark.range(50).select("id", F.concat(F.lit("t"), "id").alias("review"), (F.col("id") % 2).alias("label"))
    rating = {"rating": samples.binary_rating(F.col("label"), F.lit(5), F.lit(1))}
    rows = samples.sample_extract(df, "id", 10, {"review": "text"}, rating, ("review_id", "al_")).collect()
    digest = lambda i: hashlib.md5(f"{i}-42".encode()).hexdigest()
    order = sorted(range(50), key=digest)[:10]
    assert {r["review_id"]: (r["text"], r["rating"]) for r in rows} == {f"al_{n}": (f"t{i}", 5 if i % 2 else 1) for n, i in enumerate(order)}


def test_stream_skips_known_content(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    ingest = StreamIngest(spark, str(tmp_path / "area"), "id int, text string")
    put(drop, "a.csv", "id,text\n1,x\n")
    put(drop, "same.csv", "id,text\n1,x\n")
    ingest.run(str(drop), str(tmp_path / "cp"))
    put(drop, "again.csv", "id,text\n1,x\n")
    put(drop, "new.csv", "id,text\n2,y\n")
    ingest.run(str(drop), str(tmp_path / "cp"))
    assert sorted((r["id"], r["text"]) for r in ingest.rows().collect()) == [(1, "x"), (2, "y")]
    assert sorted(r["status"] for r in ingest.ledger().collect()) == ["LOADED", "LOADED", "SKIPPED_DUPLICATE", "SKIPPED_DUPLICATE"]


def test_each_file_of_a_folder_has_its_own_encoding(spark, tmp_path):
    folder = tmp_path / "mixed.csv"
    folder.mkdir()
    (folder / "a.csv").write_bytes("id,note\n1,café\n".encode())
    (folder / "b.csv").write_bytes("id,note\n2,café\n".encode("latin-1"))
    found = files.scan_delimited(spark, str(folder)).collect()
    assert sorted((r["id"], r["note"]) for r in found) == [("1", "café"), ("2", "café")]


def test_new_rows_come_once_per_key_and_null_is_a_key(spark):
    from pulseloom.operators.capture import insert_if_absent

    old = spark.createDataFrame([(1, "old")], "k int, v string")
    new = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a"), (None, "z"), (None, "y")], "k int, v string")
    once = insert_if_absent(old, new, "k")
    want = [(1, "old"), (2, "a"), (None, "y")]
    assert sorted(map(tuple, once.collect()), key=str) == sorted(want, key=str)
    assert sorted(map(tuple, insert_if_absent(once, new, "k").collect()), key=str) == sorted(want, key=str)


def test_fingerprints_hold_empty_files_and_use_many_tasks(spark, tmp_path):
    import hashlib

    from pulseloom.sources import files

    contents = {f"f{i}.txt": b"x" * i for i in range(12)} | {"with space.txt": b"y", "empty too.txt": b""}
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    found = files.file_fingerprints(spark, str(tmp_path))
    rows = {r["path"].rsplit("/", 1)[1]: (r["length"], r["file_hash"]) for r in found.collect()}
    assert rows == {n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in contents.items()}
    assert found.rdd.getNumPartitions() >= 4


def test_files_are_inspected_in_one_pass(spark, tmp_path):
    folder = tmp_path / "kinds.csv"
    folder.mkdir()
    # A letter of two bytes that lies across two blocks, one that is cut off at the end, and no bytes.
    for name, data in {"a": b"x" * (4 * 1024 * 1024 - 1) + "é".encode(), "b": "café".encode()[:-1], "c": b"", "d": "café".encode("latin-1")}.items():
        (folder / f"{name}.csv").write_bytes(data)
    found = {r["path"][-5]: r for r in files.inspect_files(spark, str(folder)).collect()}
    assert {n: r["encoding"] for n, r in found.items()} == {"a": "utf-8", "b": "latin-1", "c": "utf-8", "d": "latin-1"}
    assert found["b"]["file_hash"] == hashlib.sha256("café".encode()[:-1]).hexdigest()


def test_a_load_counts_rows_and_losses_while_it_writes(spark, tmp_path):
    area = StagingArea(spark, str(tmp_path / "staging"))
    folder = tmp_path / "mixed.csv"
    folder.mkdir()
    (folder / "a.csv").write_bytes((HEADER + "r1,fr,café,5,2024-01-01\nr2,fr,x,5,soon\nr3,fr,x,5,\n").encode())
    (folder / "b.csv").write_bytes((HEADER + "r4,fr,café,5,later\n").encode("latin-1"))
    assert area.load(str(folder), "raw_reddit", AS_OF) == "LOADED"
    assert sorted(r["text"] for r in area.table("raw_reddit").collect()) == ["café", "café", "x", "x"]
    assert [(r["log_id"], r["column_name"], r["lost"]) for r in area.losses().collect()] == [(1, "created_at", 2)]
    assert area.ledger().first()["row_count"] == 4
    area.truncate("raw_reddit", confirm=True)
    assert area.losses().count() == 0


def test_a_file_without_rows_is_loaded(spark, tmp_path):
    area = StagingArea(spark, str(tmp_path / "staging"))
    assert area.load(put(tmp_path, "only.csv", HEADER), "raw_reddit", AS_OF) == "LOADED"
    assert area.load(put(tmp_path, "none.csv", ""), "raw_reddit", AS_OF) == "LOADED"
    assert [r["row_count"] for r in area.ledger().collect()] == [0, 0] and area.table("raw_reddit").count() == 0
    assert all(r["lost"] == 0 for r in area.losses().collect())


def test_stream_without_line_breaks(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    ingest = StreamIngest(spark, str(tmp_path / "area"), "id int, text string", multi_line=False)
    put(drop, "a.csv", "id,text\n1,x\n2,y\n")
    ingest.run(str(drop), str(tmp_path / "cp"))
    assert sorted((r["id"], r["text"]) for r in ingest.rows().collect()) == [(1, "x"), (2, "y")]
