"""Quantiles, ranks, hash choice, ids and times against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseloom.functions.hashing import flag_by_quota, stable_id
from pulseloom.functions.ordering import global_rank, running_sums
from pulseloom.functions.quantiles import exact_quantiles, mean, rows, rows_where, summarise
from pulseloom.functions.times import epoch_to_iso, hours_between, parse_timestamp


@pytest.fixture(scope="module")
def measured(spark):
    rng = random.Random(7)
    data = [("hot", rng.choice([rng.gauss(0, 1000), rng.random(), float(rng.randint(-5, 5)), 1e12])) for _ in range(3000)]
    data += [("cold", float(i % 7)) for i in range(50)] + [(None, 2.5), (None, 3.5), ("empty", None)]
    return data, spark.createDataFrame(data, "g string, v double").repartition(5)


@pytest.mark.parametrize("limit", [5, 100, 1_000_000])
def test_quantiles_equal_brute_force_on_both_ways(measured, limit):
    data, df = measured
    points = {"median": 0.5, "p90": 0.9, "low": 0.0, "high": 1.0}
    found = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", points, max_buffered=limit).collect()}
    assert set(found) == {"hot", "cold", None, "empty"}
    for group in ("hot", "cold", None):
        values = [v for g, v in data if g == group]
        for alias, p in points.items():
            assert found[group][alias] == pytest.approx(np.percentile(values, p * 100), rel=1e-12, abs=1e-12)
    assert found["empty"]["median"] is None


@pytest.mark.parametrize("limit", [5, 1_000_000])
def test_summary_measures_ride_along(measured, limit):
    data, df = measured
    measures = [rows("n"), mean("v", "avg"), rows_where(F.col("v") > 0, "positive")]
    found = {r["g"]: r for r in summarise(df, ["g"], "v", {"m": 0.5}, measures, max_buffered=limit).collect()}
    hot = [v for g, v in data if g == "hot"]
    assert found["hot"]["n"] == len(hot)
    assert found["hot"]["avg"] == pytest.approx(np.mean(hot), rel=1e-9)
    assert found["hot"]["positive"] == sum(v > 0 for v in hot)
    assert found["empty"]["n"] == 1 and found["empty"]["avg"] is None


def test_whole_frame_and_weighted_quantiles(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 5), (10.0, 2)], "v double, w long")
    for limit in (1, 1000):
        assert exact_quantiles(df, [], "v", {"m": 0.5}, weight="w", max_buffered=limit).first()["m"] == 2.0
    empty = summarise(df.where("v > 99"), [], "v", {"m": 0.5}, [rows("n")]).collect()
    assert len(empty) == 1 and empty[0]["n"] == 0 and empty[0]["m"] is None


def test_global_rank_with_one_key_on_most_rows(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), "id").repartition(6)
    ranked = global_rank(df, [F.col("k"), F.col("id")], "r", start=10).collect()
    assert sorted(r["r"] for r in ranked) == list(range(11, 5011))
    ordered = sorted(ranked, key=lambda r: r["r"])
    assert [(r["k"], r["id"]) for r in ordered] == sorted((r["k"], r["id"]) for r in ranked)


def test_ties_are_split_over_partitions(spark):
    df = spark.range(4000).select(F.lit(1).alias("k"))
    ranked = global_rank(df, [F.col("k")], "r").withColumn("p", F.spark_partition_id())
    assert ranked.select("r").distinct().count() == 4000


def test_running_sums(spark):
    df = spark.range(1000).select("id", (F.col("id") % 5).alias("v")).repartition(7)
    found = {r["id"]: r["s"] for r in running_sums(df, [F.col("id").desc()], {"s": "v"}).collect()}
    total = 0
    for i in range(999, -1, -1):
        total += i % 5
        assert found[i] == total


def test_quota_takes_the_smallest_hashes_exactly(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"))
    quotas = spark.createDataFrame([("a", 123), ("b", 5000)], "g string, _quota long")
    flagged = flag_by_quota(df, F.col("id"), ["g"], quotas, "taken").collect()
    digest = lambda i: hashlib.md5(f"{i}-42".encode()).hexdigest()
    expected = sorted((i for i in range(0, 3000, 3)), key=digest)[:123]
    assert {r["id"] for r in flagged if r["g"] == "a" and r["taken"]} == set(expected)
    assert sum(r["taken"] for r in flagged if r["g"] == "b") == 2000


def test_stable_id_is_md5_modulo_2_to_62(spark):
    data = [("salut", 3), (None, 4), ("été", None)]
    found = [r["id"] for r in spark.createDataFrame(data, "t string, n long").select(stable_id(["t", "n"]).alias("id")).collect()]
    for (t, n), value in zip(data, found):
        text = f"{'nan' if t is None else t}|{'nan' if n is None else n}"
        assert value == int(hashlib.md5(text.encode()).hexdigest(), 16) % 2**62


def test_timestamps_drop_the_zone_and_bad_text_is_null(spark):
    data = [("Mon Apr 06 22:19:45 PDT 2009",), ("2024-01-02 03:04:05",), ("2024-01-02",), ("soon",), (None,)]
    parsed = [str(r["p"]) for r in spark.createDataFrame(data, "t string").select(parse_timestamp(F.col("t")).alias("p")).collect()]
    assert parsed == ["2009-04-06 22:19:45", "2024-01-02 03:04:05", "2024-01-02 00:00:00", "None", "None"]


def test_delay_counts_second_boundaries(spark):
    row = spark.sql("select timestamp_ntz '2024-01-01 10:00:00.9' a, timestamp_ntz '2024-01-01 12:30:00.1' b")
    assert row.select(hours_between(F.col("a"), F.col("b"))).first()[0] == 2.5


def test_epoch_to_iso(spark):
    df = spark.createDataFrame([(1239056385.0,), (None,), (0.5,)], "e double")
    assert [r[0] for r in df.select(epoch_to_iso(F.col("e"))).collect()] == [
        "2009-04-06T22:19:45+00:00", None, "1970-01-01T00:00:00.500000+00:00",
    ]
