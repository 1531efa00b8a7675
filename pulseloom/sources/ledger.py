"""Staging loads: schema alignment, the content-hash ledger, and load-all."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, StringType, StructType, TimestampNTZType

from pulseloom.functions.hashing import stable_id
from pulseloom.functions.times import parse_timestamp
from pulseloom.schemas import TRACKING, table_schema
from pulseloom.session import materialise
from pulseloom.sources.files import inspect_files, path_exists, rename_columns, scan_delimited
from pulseloom.sources.profiles import PROFILES, LoadProfile

LOADED, FORCED, SKIPPED = "LOADED", "FORCED_RELOAD", "SKIPPED_DUPLICATE"
MISSING, FAILED = "MISSING_FILE", "FAILED"
LOSSES = "log_id bigint, table_name string, column_name string, lost bigint"


def add_stable_ids(df: DataFrame, id_columns: list[str]) -> DataFrame:
    """Add content-based ids: the same row gives the same id on every reload."""
    for name in id_columns:
        df = df.withColumn(name, stable_id([c for c in df.columns if c != name]))
    return df


def _as_declared(column: str, actual: DataType, declared: DataType) -> Column:
    if isinstance(declared, TimestampNTZType) and isinstance(actual, StringType):
        return parse_timestamp(F.col(column))
    if isinstance(declared, BooleanType) and isinstance(actual, StringType):
        return F.col(column).try_cast("boolean")
    return F.col(column).cast(declared)


@dataclass
class Alignment:
    frame: DataFrame
    missing: list[str]
    dropped: list[str]


def align_to_schema(
    df: DataFrame,
    schema: StructType,
    as_of: Column | None = None,
    source_file: Column | None = None,
    beside: dict[str, Column] | None = None,
) -> Alignment:
    """Bring a file frame to a declared staging table.

    Columns the file lacks become NULL and columns the table lacks are dropped;
    both are reported. Text is cast as an insert would, timestamps leniently.
    ``beside`` names columns to put behind the declared ones, for checks.
    """
    present = {f.name: f.dataType for f in df.schema}
    technical = {"ingested_at": as_of, "source_file": source_file}
    columns, missing = [], []
    for field in schema:
        if technical.get(field.name) is not None:
            columns.append(technical[field.name].cast(field.dataType).alias(field.name))
        elif field.name in present:
            columns.append(_as_declared(field.name, present[field.name], field.dataType).alias(field.name))
        else:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            if field.name not in technical:
                missing.append(field.name)
    declared = {f.name for f in schema}
    columns += [c.alias(n) for n, c in (beside or {}).items()]
    return Alignment(df.select(*columns), missing, [c for c in df.columns if c not in declared])


def timestamp_texts(df: DataFrame, schema: StructType) -> list[str]:
    """The declared timestamp columns that the frame holds as text."""
    texts = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    return [f.name for f in schema if isinstance(f.dataType, TimestampNTZType) and f.name in texts]


def ledger_status(attempts: DataFrame, order: str, force: str | None = None) -> DataFrame:
    """Status of each load attempt on (file_hash, table_name).

    The first attempt loads; a later one is skipped unless forced. Only the
    smallest ``order`` per key is needed, so a hash tried very often collapses
    before the shuffle.
    """
    keys = ["file_hash", "table_name"]
    first = attempts.groupBy(*keys).agg(F.min(order).alias("_first"))
    is_first = F.col(order) == F.col("_first")
    forced = F.col(force) if force else F.lit(False)
    status = F.when(is_first, LOADED).when(forced, FORCED).otherwise(SKIPPED)
    return attempts.join(first, keys).withColumn("status", status).drop("_first")


def content_hash() -> Column:
    """Aggregate: the hash of a file, or one hash over those of a folder's files in sorted order."""
    hashes = F.array_sort(F.collect_list("file_hash"))
    return F.when(F.count("file_hash") == 1, F.min("file_hash")).otherwise(F.sha2(F.array_join(hashes, ","), 256))


class StagingArea:
    """Staging tables and the ledger as Parquet folders below one root."""

    def __init__(self, spark: SparkSession, root: str, profiles: dict[str, LoadProfile] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.profiles = PROFILES if profiles is None else profiles
        self.notes: list[str] = []

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _read(self, table: str, schema: StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(self._path(table))
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], schema)

    def table(self, name: str) -> DataFrame:
        schema = table_schema(name)
        return self._read(name, schema).select(*schema.names)

    def ledger(self) -> DataFrame:
        return self._read("ingestion_log", StructType.fromDDL(TRACKING["ingestion_log"]))

    def losses(self) -> DataFrame:
        """Per load and timestamp column, the values that were text and became NULL."""
        written = self._read("load_losses", StructType.fromDDL(LOSSES)).select("log_id", "table_name", "column_name", "lost")
        return written.join(self.ledger().select("log_id", "table_name"), ["log_id", "table_name"], "left_semi")

    def _log(self, log_id: int, file_hash: str, name: str, table: str, rows: int, status: str, as_of) -> None:
        # A small table: one row per load attempt.
        row = [(log_id, file_hash, name, table, rows, status, as_of)]
        schema = StructType.fromDDL(TRACKING["ingestion_log"])
        self.spark.createDataFrame(row, schema).coalesce(1).write.mode("append").parquet(self._path("ingestion_log"))

    def load(self, path: str, table: str, as_of, force: bool = False, **explicit) -> str:
        """Load one file into its staging table and return the ledger status."""
        schema = table_schema(table)
        profile = self.profiles.get(table, LoadProfile()).override(**explicit)
        name = os.path.basename(path)
        # One row per file, as the readers need their paths.
        each = F.collect_list(F.struct("path", "encoding"))
        found = inspect_files(self.spark, path).agg(content_hash().alias("file_hash"), each.alias("files")).first()
        file_hash, encodings = found["file_hash"], {f["path"]: f["encoding"] for f in found["files"]}
        known = F.col("status").isin(LOADED, FORCED) & (F.col("table_name") == table) & (F.col("file_hash") == file_hash)
        so_far = self.ledger().agg(F.max("log_id").alias("last"), F.bool_or(known).alias("known")).first()
        prior, log_id = bool(so_far["known"]), (so_far["last"] or 0) + 1
        if prior and not force:
            self._log(log_id, file_hash, name, table, 0, SKIPPED, as_of)
            return SKIPPED
        frame = scan_delimited(
            self.spark, path, column_names=profile.column_names, sep=profile.sep, multi_line=profile.multi_line, encodings=encodings
        )
        if profile.rename_columns:
            frame = rename_columns(frame, profile.rename_columns)
        if profile.generate_id:
            frame = add_stable_ids(frame, profile.generate_id)
        stamps = timestamp_texts(frame, schema)
        texts = {f"_text_of_{c}": F.col(c) for c in stamps}
        aligned = align_to_schema(frame, schema, F.lit(as_of).cast("timestamp_ntz"), F.lit(name), texts)
        if aligned.missing:
            self.notes.append(f"{table}: columns absent from {name}: {', '.join(sorted(aligned.missing))}")
        if aligned.dropped:
            self.notes.append(f"{table}: undeclared columns dropped from {name}: {', '.join(sorted(aligned.dropped))}")
        # Rows and lost values are counted while the rows are written.
        lost = [F.count_if(F.col(f"_text_of_{c}").isNotNull() & F.col(c).isNull()).alias(f"lost_{c}") for c in stamps]
        counts = Observation()
        observed = aligned.frame.observe(counts, F.count(F.lit(1)).alias("rows"), *lost).select(*schema.names)
        # A load that died before its ledger entry is written over by the next try.
        observed.write.mode("overwrite").parquet(f"{self._path(table)}/load_id={log_id}")
        # Without any rows Spark may leave the counting out.
        seen = counts.get
        losses = [(log_id, table, c, seen.get(f"lost_{c}") or 0) for c in stamps]
        for _, _, column, count in losses:
            if count:
                self.notes.append(f"{table}: {count} values of {column} are not timestamps and became NULL")
        self.spark.createDataFrame(losses, LOSSES).coalesce(1).write.mode("overwrite").parquet(f"{self._path('load_losses')}/load_id={log_id}")
        status = FORCED if prior else LOADED
        self._log(log_id, file_hash, name, table, seen.get("rows") or 0, status, as_of)
        return status

    def load_all(self, folder: str, as_of, force: bool = False) -> dict[str, str]:
        """Load every profile that names a file; one failure does not stop the others."""
        summary = {}
        for table, profile in self.profiles.items():
            if not profile.file:
                continue
            path = f"{folder.rstrip('/')}/{profile.file}"
            try:
                found = path_exists(self.spark, path)
                summary[table] = self.load(path, table, as_of, force) if found else MISSING
            except Exception as error:
                self.notes.append(f"{table}: {type(error).__name__}: {error}")
                summary[table] = FAILED
        return summary

    def truncate(self, table: str, confirm: bool = False) -> bool:
        """Empty one table and forget its loads. Does nothing without ``confirm``."""
        schema = table_schema(table)
        if not confirm:
            return False
        # The kept rows come from the folder being replaced, so they are written elsewhere first.
        kept = materialise(self.ledger().where(F.col("table_name") != table), "ledger")
        self.spark.createDataFrame([], schema).write.mode("overwrite").parquet(self._path(table))
        kept.coalesce(1).write.mode("overwrite").parquet(self._path("ingestion_log"))
        return True


def table_status(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
