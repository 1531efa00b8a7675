"""Exact dedup against a persistent digest index.

The index is a table of digests, bucketed and sorted by digest. A batch is reduced to one row
per digest, the digests that the index lacks are found by a sort-merge anti-join, and those
are appended. Only built-in functions run; texts are read once and never shuffled.

Defined results
---------------
* A NULL text counts as empty; all empty texts are one group.
* Of equal texts the longest original stays (code points), then the smallest ``doc_id``;
  a NULL ``doc_id`` comes after all others.
* Rows that repeat both ``doc_id`` and text are one document: they share one decision, and
  ``survivors`` gives it once.
* A text that the index knew before the batch keeps the document which the index names.
* Other columns of the input, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseloom.llm.columns import spare
from pulseloom.session import materialise, scratch_path

SCHEMA = "digest string, keep_id bigint, group_size bigint"
#: A digest is hot from this share of a batch on; at most 1 / share digests can be.
HOT_SHARE = 0.001


def digest(text: Column) -> Column:
    """SHA-256, lower-case hex, of the text without ASCII white space."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")
    return F.sha2(F.encode(bare, "UTF-8"), 256)


@dataclass(frozen=True)
class DigestIndex:
    """A digest table at a path in the shared folder; opening a path again finds what it holds."""

    table: str
    buckets: int

    @classmethod
    def open(cls, spark: SparkSession, path: str, buckets: int | None = None) -> DigestIndex:
        """``buckets`` must be what the index was made with; by default the shuffle partitions."""
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        table = "digest_index_" + hashlib.md5(path.encode()).hexdigest()[:16]
        spark.sql(
            f"create table if not exists {table} ({SCHEMA}) using parquet "
            f"clustered by (digest) sorted by (digest) into {buckets} buckets location '{path}'"
        )
        return cls(table, buckets)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.table(self.table)

    def append_new(self, groups: DataFrame) -> None:
        """Add the digests that are not there yet. Running it again adds nothing."""
        spark = groups.sparkSession
        known = self.read(spark).select("digest").hint("merge")
        new = groups.hint("merge").join(known, "digest", "left_anti").select("digest", "keep_id", "group_size")
        writer = new.repartition(self.buckets, "digest").write.mode("append").format("parquet")
        writer.bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table)


def decide(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Take a batch into the index: doc_id, keep_id, group_size, kept, text_sha256 per row.

    ``group_size`` counts the rows of the batch that brought the text into the index.
    """
    text = F.col("text")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        digest(text).alias("digest"),
        F.char_length(F.coalesce(text, F.lit(""))).cast("long").alias("chars"),
    )
    rows = materialise(rows, "digests")
    best = F.min(F.struct(-F.col("chars"), F.col("doc_id").isNull(), F.col("doc_id").alias("doc_id")))
    groups = rows.groupBy("digest").agg(best["doc_id"].alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = materialise(groups, "digest-groups")
    index.append_new(groups)
    known = index.read(docs.sparkSession)
    # The rows of a hot digest would meet in one task of the join. Fewer than 1 / HOT_SHARE
    # digests can be hot, so these few are broadcast; all others are joined by their buckets.
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    hot = groups.where(F.col("group_size") > total * HOT_SHARE).select("digest")
    hot = materialise(known.join(F.broadcast(hot), "digest"), "hot-digests")
    hot = F.broadcast(hot)
    found = rows.join(hot, "digest").unionByName(
        rows.join(hot.select("digest"), "digest", "left_anti").hint("merge").join(known, "digest")
    )
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def survivors(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The documents that stay, with all their columns, each of them once."""
    own, of_id, of_text = (spare(docs, n) for n in ("digest", "kept_id", "kept_digest"))
    kept = decide(docs, index).where("kept").select(F.col("doc_id").alias(of_id), F.col("text_sha256").alias(of_text)).distinct()
    hashed = docs.withColumn(own, digest(F.col("text")))
    same = hashed["doc_id"].eqNullSafe(kept[of_id]) & (hashed[own] == kept[of_text])
    return hashed.join(kept, same, "left_semi").dropDuplicates(["doc_id", own]).select(*docs.columns)


def fresh_index(spark: SparkSession) -> DigestIndex:
    """An empty index of its own, below the shared folder."""
    return DigestIndex.open(spark, scratch_path(spark, "digest-index"))
