"""Delimited and structured file sources and sinks, and file fingerprints."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_READ_BLOCK = 4 * 1024 * 1024


def _suffix(path: str) -> str:
    return os.path.splitext(path.rstrip("/"))[1].lower()


def detect_encodings(spark: SparkSession, path: str) -> dict[str, str]:
    """utf-8 or latin-1 per file below a path.

    Spark never fails on bad UTF-8, so bytes are checked line by line, in one
    pass: a newline byte is never part of a longer UTF-8 sequence. latin-1
    accepts every byte, hence no later fallback can be reached. Empty files are
    not listed.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), (~F.is_valid_utf8("value")).alias("bad"))
    # One row per file, as the readers need their paths.
    return {r["file"]: "latin-1" if r["bad"] else "utf-8" for r in lines.groupBy("file").agg(F.bool_or("bad").alias("bad")).collect()}


def scan_delimited(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    column_names: list[str] | None = None,
    sep: str | None = None,
    encoding: str | None = None,
    multi_line: bool = True,
    encodings: dict[str, str] | None = None,
) -> DataFrame:
    """Read CSV or TSV, told apart by suffix.

    Columns come from the header, or from ``column_names`` for a headerless file.
    Values are text unless a schema is given; nothing is inferred. Quoted line
    breaks need ``multi_line``; switch it off where there are none, since only
    then can one file be split over tasks. Without an ``encoding`` each file of a
    folder is read in its own; ``encodings`` names it per file where
    ``inspect_files`` has found it already, which saves a pass.
    """
    kind = _suffix(path)
    if kind not in (".csv", ".tsv"):
        raise ValueError(f"unsupported format: {kind}")
    separator = "\t" if kind == ".tsv" else (sep or ",")
    reader = spark.read.options(
        sep=separator,
        quote='"',
        escape='"',
        multiLine=multi_line,
        header=not column_names,
        mode="PERMISSIVE",
    )
    if schema is None and column_names:
        schema = StructType([StructField(n, StringType()) for n in column_names])
    if schema is not None:
        # A header may order columns differently from the schema.
        reader = reader.schema(schema).option("enforceSchema", bool(column_names))

    def read(where: str | list[str], kind: str) -> DataFrame:
        return reader.option("encoding", "ISO-8859-1" if kind == "latin-1" else "UTF-8").csv(where)

    if encoding:
        return read(path, encoding)
    found = detect_encodings(spark, path) if encodings is None else encodings
    kinds = sorted(set(found.values())) or ["utf-8"]
    if len(kinds) == 1:
        return read(path, kinds[0])
    by_kind = [read([f for f, own in found.items() if own == k], k) for k in kinds]
    return by_kind[0].unionByName(by_kind[1], allowMissingColumns=True)


def scan_structured(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read Parquet, a JSON array, JSON lines, or else CSV, told apart by suffix."""
    kind = _suffix(path)
    if kind == ".parquet":
        return spark.read.parquet(path)
    if kind in (".json", ".jsonl"):
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.option("multiLine", kind == ".json").json(path)
    reader = spark.read.options(header=True, multiLine=True, quote='"', escape='"')
    return (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)


def sink_structured(df: DataFrame, path: str) -> None:
    """Write by suffix. JSON output is one object per line for ``.json`` too."""
    kind = _suffix(path)
    writer = df.write.mode("overwrite")
    if kind == ".parquet":
        writer.parquet(path)
    elif kind in (".json", ".jsonl"):
        writer.option("ignoreNullFields", False).json(path)
    else:
        writer.options(header=True, quote='"', escape='"', quoteAll=False).csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; other errors of the listing are raised."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def inspect_files(spark: SparkSession, path: str | list[str], filesystem=None, tasks: int | None = None) -> DataFrame:
    """(path, length, file_hash, encoding) per file, empty files included, in one pass.

    ``file_hash`` is the SHA-256 of the bytes, ``encoding`` utf-8 where they are valid
    UTF-8 and else latin-1. Files are streamed in blocks where the task runs, whatever
    their size. They are dealt to ``tasks`` tasks, by default one and a half times as
    many as the shuffle has or the cores there are.
    ``filesystem`` is the Arrow file system to read them with, for stores that
    need credentials; by default the scheme decides (``s3a`` and ``s3n`` are
    ``s3``), and a scheme that Arrow does not know raises.
    """

    def read_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import codecs
        import hashlib

        from pyarrow import fs

        for batch in batches:
            digests, encodings = [], []
            for uri in batch["path"]:
                scheme, _, rest = uri.partition(":")
                if filesystem is not None:
                    system, location = filesystem, rest.lstrip("/") if scheme != "file" else "/" + rest.lstrip("/")
                else:
                    system, location = fs.FileSystem.from_uri(quote(f"s3:{rest}" if scheme in ("s3a", "s3n") else uri, safe=":/"))
                digest, decoder, encoding = hashlib.sha256(), codecs.getincrementaldecoder("utf-8")(), "utf-8"
                with system.open_input_stream(location) as stream:
                    more = True
                    while more:
                        block = stream.read(_READ_BLOCK)
                        more = bool(block)
                        digest.update(block)
                        if encoding == "utf-8":
                            try:
                                decoder.decode(block, final=not more)
                            except UnicodeDecodeError:
                                encoding = "latin-1"
                digests.append(digest.hexdigest())
                encodings.append(encoding)
            yield batch.assign(file_hash=digests, encoding=encodings)[["path", "length", "file_hash", "encoding"]]

    # Listing puts many files in one task. A number of tasks that is named is kept by the
    # adaptive plan, which would otherwise put these short rows together again.
    wide = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    files = spark.read.format("binaryFile").load(path)
    listed = files.select("path", "length")
    dealt = listed.repartition(tasks or wide + wide // 2, "path")
    read = dealt.mapInPandas(read_blocks, "path string, length bigint, file_hash string, encoding string")
    # The scan leaves empty files out; the listing has them. One spelling of local paths for both.
    names = [(re.sub("^file:/+", "file:/", unquote(p)),) for p in files.inputFiles()]
    empty = spark.createDataFrame(names, "path string").join(
        listed.select(F.regexp_replace("path", "^file:/+", "file:/").alias("path")), "path", "left_anti"
    )
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return read.unionByName(
        empty.select("path", F.lit(0).cast("long").alias("length"), nothing.alias("file_hash"), F.lit("utf-8").alias("encoding"))
    )


def file_fingerprints(spark: SparkSession, path: str | list[str], filesystem=None, tasks: int | None = None) -> DataFrame:
    """SHA-256 of each file's bytes: (path, length, file_hash), empty files included; see ``inspect_files``."""
    return inspect_files(spark, path, filesystem, tasks).drop("encoding")
