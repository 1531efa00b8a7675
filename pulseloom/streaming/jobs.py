"""Incremental forms of the batch operators, run until the source is used up.

Batch ids count from 0 for each checkpoint, so they name a batch only together with the id that
Spark keeps in the checkpoint, here called the run. Every sink is a folder per run and batch,
written over on a replay. A lost checkpoint therefore starts a new run: it sees all input again,
and what earlier runs have stored decides what of it is new.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pulseloom.operators.capture import dedupe_latest, map_to_common
from pulseloom.operators.kpi import kpi_daily
from pulseloom.operators.models import score_text
from pulseloom.operators.warehouse import PostFact, read_or_empty
from pulseloom.session import materialise
from pulseloom.sources.files import file_fingerprints

LEDGER = "file_hash string, path string, status string, run_id string, batch_id bigint"


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The name of the run that a checkpoint belongs to, kept in its folder; a new folder gets a new one."""
    place = f"{checkpoint.rstrip('/')}/run"
    held = read_or_empty(spark, place, "run_id string").first()
    if held is None:
        # Read again: what is stored counts.
        spark.createDataFrame([(uuid.uuid4().hex,)], "run_id string").coalesce(1).write.mode("overwrite").parquet(place)
        held = read_or_empty(spark, place, "run_id string").first()
    if held is None or not held[0]:
        raise RuntimeError(f"no run is named in {place}")
    return held[0]


def run_to_end(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, str, int], None], mode: str = "append") -> None:
    """Process all that is available: ``each`` gets a batch, its run and its id in that run."""
    run_id = run_of(stream.sparkSession, checkpoint)

    def one(batch: DataFrame, batch_id: int) -> None:
        each(batch, run_id, batch_id)

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer.foreachBatch(one).start().awaitTermination()


class StreamIngest:
    """Load dropped CSV files once per content.

    The stream's checkpoint knows paths only. Each batch fingerprints its files
    and leaves out those whose bytes the ledger, or an earlier path of the same
    batch, holds already. The ledger entry comes last and makes the rows of a
    batch visible, so a batch that died midway is loaded again and seen once.
    Quoted line breaks need ``multi_line``; without them a file can be split over tasks.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str, max_files: int = 1000, multi_line: bool = True):
        self.spark, self.root, self.schema, self.max_files = spark, root.rstrip("/"), schema, max_files
        self.multi_line = multi_line

    def rows(self) -> DataFrame:
        names = [part.split()[0] for part in self.schema.split(",")]
        stored = f"{self.schema}, source_file string, run_id string, batch_id bigint"
        written = read_or_empty(self.spark, f"{self.root}/rows", stored)
        # One row per batch.
        seen = self.ledger().select("run_id", "batch_id").distinct()
        return written.join(seen, ["run_id", "batch_id"], "left_semi").select(*names, "source_file")

    def ledger(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/ledger", LEDGER)

    def _batch(self, batch: DataFrame, run_id: str, batch_id: int) -> None:
        batch = batch.persist()
        # As many paths as the stream may take per batch.
        paths = [r[0] for r in batch.select("source_path").distinct().collect()]
        if paths:
            found = file_fingerprints(self.spark, paths).groupBy("file_hash").agg(
                F.min("path").alias("first"), F.collect_list("path").alias("paths")
            )
            own = (F.col("run_id") == run_id) & (F.col("batch_id") == batch_id)
            known = self.ledger().where(~own & (F.col("status") == "LOADED")).select("file_hash", F.lit(True).alias("known"))
            attempts = found.join(known.distinct(), "file_hash", "left").select(
                "file_hash", F.explode("paths").alias("path"), (F.col("known").isNull()).alias("new"), "first"
            )
            loaded = F.col("new") & (F.col("path") == F.col("first"))
            status = F.when(loaded, "LOADED").otherwise("SKIPPED_DUPLICATE")
            entries = materialise(attempts.select("file_hash", "path", status.alias("status")), "attempts")
            # binaryFile and the file metadata spell the same path differently by the number of slashes.
            bare = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
            keep = entries.where("status = 'LOADED'").select(bare(F.col("path")).alias("_path")).distinct()
            rows = batch.withColumn("_path", bare(F.col("source_path"))).join(keep, "_path", "left_semi")
            rows = rows.drop("_path").withColumnRenamed("source_path", "source_file")
            place = f"run_id={run_id}/batch_id={batch_id}"
            rows.write.mode("overwrite").parquet(f"{self.root}/rows/{place}")
            entries.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/ledger/{place}")
        batch.unpersist()

    def run(self, folder: str, checkpoint: str) -> None:
        stream = (
            self.spark.readStream.schema(self.schema)
            .options(header=True, multiLine=self.multi_line, quote='"', escape='"', maxFilesPerTrigger=self.max_files)
            .option("recursiveFileLookup", True)
            .csv(folder)
        )
        run_to_end(stream.withColumn("source_path", F.col("_metadata.file_path")), checkpoint, self._batch)


def stream_scd2(stream: DataFrame, fact: PostFact, mapping: tuple[int, int, list], checkpoint: str) -> None:
    """Merge each batch of staged rows into the versioned fact; a version begins at its row's ``ingested_at``.

    A batch that the fact has already seen in this run changes nothing. A new run
    brings all staged rows again: none of them is later than the current version of
    its key, so they change nothing either. Rows without a key or without a time are
    left out.
    """

    def each(batch: DataFrame, run_id: str, batch_id: int) -> None:
        usable = F.col("external_post_id").isNotNull() & F.col("ingested_at").isNotNull()
        # Written once: the merge looks at the keys first, then at the rows.
        staged = materialise(dedupe_latest(map_to_common(batch, mapping).where(usable)), "staged")
        if not staged.isEmpty():
            fact.apply(staged, mapping[0], F.col("ingested_at"), batch_id, run_id)

    run_to_end(stream, checkpoint, each)


def _latest_only(path: str) -> Callable[[DataFrame, str, int], None]:
    def each(batch: DataFrame, run_id: str, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return each


def stream_daily_kpi(posts: DataFrame, checkpoint: str, target: str) -> DataFrame:
    """Daily KPIs kept current in complete mode.

    The state has one row per day and one for posts without a date; a late post
    still counts for its day.
    """
    run_to_end(kpi_daily(posts), checkpoint, _latest_only(target), "complete")
    return posts.sparkSession.read.parquet(target)


def stream_hourly_activity(context: DataFrame, checkpoint: str, target: str, delay: str = "1 hour") -> DataFrame:
    """Comments with a valid delay per hour window; (window_start, comment_count)."""
    valid = context.where(F.col("reaction_delay_hours") >= 0)
    stamped = valid.withColumn("_ts", F.col("commented_at").cast("timestamp")).withWatermark("_ts", delay)
    hourly = stamped.groupBy(F.window("_ts", "1 hour")).agg(F.count(F.lit(1)).alias("comment_count"))
    shaped = hourly.select(F.col("window.start").alias("window_start"), "comment_count")
    run_to_end(shaped, checkpoint, _latest_only(target), "complete")
    return context.sparkSession.read.parquet(target)


def first_rows(posts: DataFrame) -> DataFrame:
    """Of each post the newest row of the first batch that holds it; later rows of it are dropped.

    The state has one flag per post and is looked up by key, so the work of a batch
    depends on its own rows, however many posts have come before.
    """
    order, columns = ["published_at", "text_content"], posts.columns

    def once(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            return
        best = None
        # A post may come in several frames: the best row so far goes with the next.
        for frame in frames:
            rows = frame if best is None else pd.concat([best, frame])
            best = rows.sort_values(order, na_position="first", kind="stable").tail(1)
        state.update((True,))
        if best is not None:
            yield best[columns]

    seen = "seen boolean"
    return posts.groupBy("post_id").applyInPandasWithState(once, posts.schema, seen, "append", GroupStateTimeout.NoTimeout)


def stream_score(posts: DataFrame, model: PipelineModel, model_id: int, checkpoint: str, target: str, buckets: int = 64) -> DataFrame:
    """Score posts as they arrive, however late: one prediction per post and model.

    Of the rows of a post in one batch the newest is scored. Keyed state leaves out the
    posts that an earlier batch of the run has scored. Predictions of earlier runs, after
    a lost checkpoint or a first load, lie in folders by a hash of the post: a batch reads
    the folders of its own posts only, and none where no other run has stored any.
    """
    spark = posts.sparkSession
    texts = posts.where(F.col("text_content").isNotNull()).select("post_id", "text_content", "published_at")
    empty = score_text(model, spark.createDataFrame([], texts.schema).drop("published_at"), "text_content").drop("text_content")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in empty.schema)
    bucket = F.pmod(F.xxhash64("post_id"), F.lit(buckets)).cast("int")
    mine, run = f"{target}/model_id={model_id}", run_of(spark, checkpoint)
    stored = read_or_empty(spark, mine, f"{schema}, bucket int, run_id string, batch_id bigint")
    # Asked once: while this run goes on, no other one writes here.
    others = stored.where(F.col("run_id") != run)
    repeats = not others.isEmpty()

    def each(batch: DataFrame, run_id: str, batch_id: int) -> None:
        fresh = batch.drop("published_at").withColumn("bucket", bucket)
        if repeats:
            fresh = materialise(fresh, "fresh")
            # At most ``buckets`` of them: they prune the folders.
            held = [r[0] for r in fresh.select("bucket").distinct().collect()]
            known = others.where(F.col("bucket").isin(held)).select("post_id")
            fresh = fresh.join(known, "post_id", "left_anti")
        scored = score_text(model, fresh, "text_content").drop("text_content")
        # One folder per bucket, run and batch: a replay writes over its own.
        place = {"run_id": F.lit(run_id), "batch_id": F.lit(batch_id)}
        scored.withColumns(place).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "bucket", "run_id", "batch_id"
        ).parquet(mine)

    run_to_end(first_rows(texts), checkpoint, each)
    done = read_or_empty(spark, target, f"{schema}, model_id int, bucket int, run_id string, batch_id bigint")
    return done.select(*[f.name for f in empty.schema], "model_id")
