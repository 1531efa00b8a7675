"""The versioned post fact on Parquet: immutable buckets per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from pulseloom.operators.capture import current_snapshot, dedupe_latest, map_to_common, merge_versions, number_versions, scd2_summary
from pulseloom.schemas import MAPPINGS, VERSIONED_FACT
from pulseloom.session import materialise

#: ``path`` holds the bucket's files; the row of a batch as a whole has bucket -1 and no path.
_POINTERS = (
    "table_name string, source_id int, bucket int, buckets int, run_id string, batch_id bigint, version bigint, "
    "path string, has_kept boolean, last_post_id bigint, new_rows bigint, updated_rows bigint"
)
_BATCH = -1
BUCKETS = 16
_KEY = ["source_id", "external_post_id"]


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table, empty where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


class PostFact:
    """``fact_social_post`` split by source and by a hash of the natural key.

    A batch reads the buckets its keys fall into, shuffles them once, and writes those
    that change beside the old ones. One file of pointer rows then publishes all of
    them together: readers follow the newest pointer of each bucket, so a batch that
    dies midway is never seen, and a bucket without changes keeps its files.

    Versions go by source time where ``as_of`` is a column of the staged rows: a row
    no later than its current version changes nothing, so rows that come again cannot
    rewrite history.

    Batch ids count within a run: replaying one changes nothing, one older than the
    run's last is an error, and another run's ids say nothing about this one. The
    number of buckets is kept in the pointers; that of an existing store holds. One
    writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self.root = f"{root.rstrip('/')}/fact_social_post"
        self.buckets = self._pointers().agg(F.max("buckets")).first()[0] or buckets

    def _pointers(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/pointers", _POINTERS)

    def _newest(self) -> list[Row]:
        """The newest pointer of each bucket: sources x buckets rows, and one more per source."""
        newest = F.max_by(F.struct("path", "has_kept", "version", "last_post_id"), F.col("version")).alias("p")
        return self._pointers().groupBy("source_id", "bucket").agg(newest).select("source_id", "bucket", "p.*").collect()

    def _files(self, newest: list[Row], source_id: int | None, buckets: set[int] | None = None) -> DataFrame:
        paths = [
            f"{r['path']}/{part}/bucket={r['bucket']}"
            for r in newest
            if r["path"] and source_id in (None, r["source_id"]) and (buckets is None or r["bucket"] in buckets)
            for part in ("merged/kind=kept", "fresh")
            if part == "fresh" or r["has_kept"]
        ]
        if not paths:
            return self.spark.createDataFrame([], VERSIONED_FACT)
        return self.spark.read.schema(VERSIONED_FACT).parquet(*paths)

    def read(self, source_id: int | None = None) -> DataFrame:
        return self._files(self._newest(), source_id)

    def bucket_paths(self, source_id: int) -> dict[int, str]:
        """Where each bucket of a source lies."""
        return {r["bucket"]: r["path"] for r in self._newest() if r["source_id"] == source_id and r["path"]}

    def seen(self, source_id: int, batch_id: int, run_id: str = "") -> bool:
        """Whether the run has merged this batch; raises if it has merged a later one only."""
        own = self._pointers().where((F.col("source_id") == source_id) & (F.col("run_id") == run_id))
        last, here = own.agg(F.max("batch_id"), F.count_if(F.col("batch_id") == batch_id)).first()
        if not here and last is not None and last > batch_id:
            raise ValueError(f"batch {batch_id} of source {source_id} comes after batch {last} in run {run_id!r}")
        return here > 0

    def apply(self, staged: DataFrame, source_id: int, as_of: Column, batch_id: int, run_id: str = "") -> tuple[int, int] | None:
        """Merge deduplicated rows of one source and publish the result.

        Returns the numbers of new and of updated keys, or None for a batch seen before.
        """
        if self.seen(source_id, batch_id, run_id):
            return None
        newest = self._newest()
        last_id = max([r["last_post_id"] for r in newest], default=0)
        version = max([r["version"] for r in newest], default=0) + 1
        path = f"{self.root}/source_id={source_id}/run_id={run_id}/batch={batch_id}"
        staged = staged.withColumns({"source_id": F.col("source_id").cast("int"), "external_post_id": F.col("external_post_id").cast("string")})
        # The hash that deals rows to tasks: a multiple of the buckets in tasks leaves one bucket in each.
        bucket = F.pmod(F.hash(*_KEY), F.lit(self.buckets))
        tasks = self.buckets * max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")) // self.buckets)
        # At most as many as there are buckets.
        touched = {r[0] for r in staged.select(bucket.alias("b")).distinct().collect()}
        merged = merge_versions(self._files(newest, source_id, touched), staged, as_of, tasks)
        merged = merged.withColumns({"bucket": bucket, "kind": F.when(F.col("_fresh"), "born").otherwise("kept")})
        # What stays is written where it will be read.
        merged.write.mode("overwrite").partitionBy("kind", "bucket").parquet(f"{path}/merged")
        written = self.spark.read.schema(merged.schema).parquet(f"{path}/merged")
        per_bucket = written.groupBy("bucket").agg(
            F.count_if("_fresh").alias("born"), F.count_if("_update").alias("updated"), F.count_if(~F.col("_fresh")).alias("kept")
        )
        changed = [r for r in per_bucket.collect() if r["born"]]
        if changed:
            fresh = number_versions(written.where("kind = 'born'").drop("kind"), last_id)
            fresh.repartition(self.buckets, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/fresh")
        born, updated = sum(r["born"] for r in changed), sum(r["updated"] for r in changed)

        def pointer(bucket: int, where: str | None, kept: bool, fresh: int, replaced: int) -> tuple:
            place = ("fact_social_post", source_id, bucket, self.buckets, run_id, batch_id, version)
            return (*place, where, kept, last_id + born, fresh - replaced, replaced)

        rows = [pointer(r["bucket"], path, r["kept"] > 0, r["born"], r["updated"]) for r in changed]
        rows.append(pointer(_BATCH, None, False, born, updated))
        self.spark.createDataFrame(rows, _POINTERS).coalesce(1).write.mode("append").parquet(f"{self.root}/pointers")
        return born - updated, updated

    def transform_source(self, staging: DataFrame, table: str, as_of: Column, batch_id: int, run_id: str = "") -> DataFrame:
        """Map, deduplicate and merge one staging table; returns the summary row."""
        source_id = MAPPINGS[table][0]
        mapped = map_to_common(staging, table)
        # Written once, as the counts and the merge both read it.
        staged = materialise(dedupe_latest(mapped.where(F.col("external_post_id").isNotNull())), "staged")
        counted = self.apply(staged, source_id, as_of, batch_id, run_id)
        if counted is None:
            summary = scd2_summary(staging, staged, current_snapshot(self.read(source_id), source_id))
            return summary.withColumn("source", F.lit(table))
        raw = staging.agg(F.count(F.lit(1)).alias("staging_rows_raw"))
        deduped = staged.agg(F.count(F.lit(1)).alias("staging_rows_deduped"))
        new, updated = (F.lit(n).cast("long") for n in counted)
        # Two frames of one row.
        counts = raw.crossJoin(F.broadcast(deduped)).withColumns({"new": new, "updated": updated})
        unchanged = F.col("staging_rows_deduped") - F.col("new") - F.col("updated")
        return counts.withColumns({"unchanged": unchanged, "source": F.lit(table)})
