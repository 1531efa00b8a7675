"""Stored sentiment predictions: what a refresh takes away and what it adds become visible together."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulseloom.functions.ordering import global_rank
from pulseloom.operators.models import score_candidates, score_text
from pulseloom.operators.warehouse import read_or_empty
from pulseloom.schemas import FACTS, column_types

_COLUMNS = FACTS["fact_sentiment_prediction"]
#: One row per commit and source. ``replaces`` puts an end to all earlier rows of the model and source.
_COMMITS = "version bigint, model_id int, source_id int, replaces boolean, path string, last_prediction_id bigint"


class PredictionStore:
    """``fact_sentiment_prediction`` as immutable files per commit, model and source.

    A commit writes its predictions into a folder of its own and then adds its rows to the log, in
    one file. Readers take, per model and source, the folders from the last replacing commit on. So
    deleting old predictions, scoring and adding new ones is one step to a reader: a run that dies
    midway leaves the old ones as they were, and an earlier version can still be read. One writer at
    a time; ids go on after the largest one ever given.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _log(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/log", _COMMITS)

    def version(self) -> int:
        """The last commit's number, 0 for an empty store."""
        return self._log().agg(F.max("version")).first()[0] or 0

    def read(self, model_id: int | None = None, source_ids: list[int] | None = None, version: int | None = None) -> DataFrame:
        """The predictions as of a version (the last one by default), with their source."""
        log = self._log()
        if version is not None:
            log = log.where(F.col("version") <= version)
        if model_id is not None:
            log = log.where(F.col("model_id") == model_id)
        if source_ids is not None:
            log = log.where(F.col("source_id").isin(list(source_ids)))
        since = F.max(F.when(F.col("replaces"), F.col("version"))).over(Window.partitionBy("model_id", "source_id"))
        live = log.withColumn("since", F.coalesce(since, F.lit(0))).where("version >= since and path is not null")
        # Names of folders: one per commit and source since the last refresh.
        paths = [f"{r['path']}/source_id={r['source_id']}" for r in live.select("path", "source_id").collect()]
        schema = f"{_COLUMNS}, source_id int"
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.root).parquet(*paths)

    def _commit(self, rows: DataFrame, model_id: int, source_ids: list[int], replaces: bool, last: int) -> int:
        """Write rows of these sources and publish them; returns how many there are."""
        version = self.version() + 1
        path = f"{self.root}/commit={version}-{uuid.uuid4().hex}"
        rows.select(*column_types(_COLUMNS), "source_id").write.partitionBy("source_id").parquet(path)
        written = read_or_empty(self.spark, path, f"{_COLUMNS}, source_id int")
        found = {r["source_id"]: r for r in written.groupBy("source_id").agg(F.count(F.lit(1)).alias("n"), F.max("prediction_id").alias("last")).collect()}
        top = max([last, *(r["last"] for r in found.values())])
        entries = [(version, model_id, s, replaces, path if s in found else None, top) for s in source_ids]
        self.spark.createDataFrame(entries, _COMMITS).coalesce(1).write.mode("append").parquet(f"{self.root}/log")
        return sum(r["n"] for r in found.values())

    def _last_id(self) -> int:
        return self._log().agg(F.max("last_prediction_id")).first()[0] or 0

    def load(self, predictions: DataFrame) -> None:
        """Take in predictions that have ids and sources, such as those of an older store."""
        for row in predictions.groupBy("model_id").agg(F.collect_set("source_id").alias("sources")).collect():
            mine = predictions.where(F.col("model_id") == row["model_id"])
            self._commit(mine, row["model_id"], sorted(row["sources"]), False, self._last_id())

    def score(
        self,
        model: PipelineModel,
        posts: DataFrame,
        model_id: int,
        source_ids: list[int],
        resume: bool = True,
        max_rows: int | None = None,
        current_only: bool = False,
    ) -> int:
        """Score posts of these sources and publish the predictions; returns how many there are.

        With ``resume`` only posts without a prediction by this model are scored, and
        added. Without it all are scored, and the new predictions take the place of
        those of this model on these sources. Otherwise as ``score_candidates``.
        """
        done = self.read(model_id, source_ids)
        due = score_candidates(posts, done, model_id, source_ids, resume, max_rows, current_only, keep=["post_id", "source_id", "text_content"])
        scored = score_text(model, due.dropDuplicates(["post_id"]), "text_content").drop("text_content")
        last = self._last_id()
        numbered = global_rank(scored, [F.col("post_id")], "prediction_id", last)
        marks = {"model_id": F.lit(model_id), "is_human_validated": F.lit(False)}
        return self._commit(numbered.withColumns(marks), model_id, list(source_ids), not resume, last)
