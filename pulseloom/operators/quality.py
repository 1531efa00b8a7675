"""Quality checks and profiling: one scan per table."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from pulseloom.functions.times import parse_timestamp

COUNTERS = ["likes", "comments", "shares", "views"]
ENGAGEMENT_PARTS = ["likes", "shares", "comments"]
# Bounds of the main corpus. Toxicity is on 0 to 100.
MAIN_CORPUS_BOUNDS = {
    "sentiment_positive": (0.0, 1.0),
    "sentiment_negative": (0.0, 1.0),
    "sentiment_neutral": (0.0, 1.0),
    "cross_platform_spread": (0.0, 1.0),
    "toxicity_score": (0.0, 100.0),
    "engagement_rate_per_1k_followers": (0.0, None),
    "viral_coefficient": (0.0, None),
}
DUPLICATE_LIMIT = 0.01
NULL_LIMIT = 0.05
TECHNICAL = ["ingested_at", "source_file"]


@dataclass(frozen=True)
class Check:
    """A named count of failing rows, and the largest share that still passes."""

    name: str
    failed: Column
    limit: float = 0.0
    strict: bool = False
    otherwise: str = "WARN"

    def result(self, failed: Column, rows: Column) -> Column:
        share = F.coalesce(F.try_divide(failed.cast("double"), rows.cast("double")), F.lit(0.0))
        passed = share < self.limit if self.strict else share <= self.limit
        return F.when(passed, "PASS").otherwise(self.otherwise)


@dataclass
class Suite:
    checks: list[Check] = field(default_factory=list)

    def run(self, df: DataFrame, table: str) -> DataFrame:
        """One aggregation for all checks, then one row per check."""
        counts = df.agg(
            F.count(F.lit(1)).alias("_rows"), *[c.failed.cast("long").alias(f"_f{i}") for i, c in enumerate(self.checks)]
        )
        rows = F.col("_rows")
        entries = [
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(c.name).alias("check_name"),
                c.result(F.col(f"_f{i}"), rows).alias("check_result"),
                rows.alias("rows_checked"),
                F.col(f"_f{i}").alias("rows_failed"),
            )
            for i, c in enumerate(self.checks)
        ]
        return counts.select(F.inline(F.array(*entries)))


def row_count_check() -> Check:
    # An empty table fails with one failed row; the share is then 0, so the count decides.
    empty = F.when(F.count(F.lit(1)) > 0, 0).otherwise(1)
    return _RowCount("row_count_positive", empty, otherwise="FAIL")


class _RowCount(Check):
    def result(self, failed: Column, rows: Column) -> Column:
        return F.when(rows > 0, "PASS").otherwise(self.otherwise)


def duplicate_check(columns: list[str]) -> Check:
    # Digests of whole rows, NULL fields kept: rows themselves, texts included, are not shuffled.
    whole = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    extra = F.count(F.lit(1)) - F.count_distinct(F.sha2(whole, 256))
    return Check("duplicate_rate", extra, DUPLICATE_LIMIT, strict=True)


def null_checks(df: DataFrame, keys: list[str], limit: float = NULL_LIMIT) -> list[Check]:
    return [Check(f"null_rate_{c}", F.count_if(F.col(c).isNull()), limit) for c in keys if c in df.columns]


def non_negative_checks(df: DataFrame) -> list[Check]:
    """Counters only: a net score may be negative."""
    numeric = [c for c in df.columns if c in COUNTERS and isinstance(df.schema[c].dataType, NumericType)]
    return [Check(f"type_consistency_{c}_non_negative", F.count_if(F.col(c) < 0)) for c in numeric]


def range_checks(df: DataFrame, bounds: dict[str, tuple[float, float | None]]) -> list[Check]:
    checks = []
    for column, (low, high) in bounds.items():
        if column in df.columns:
            outside = F.col(column) < low
            if high is not None:
                outside = outside | (F.col(column) > high)
            checks.append(Check(f"range_{column}", F.count_if(outside)))
    return checks


def engagement_check(df: DataFrame) -> list[Check]:
    if not {"total_engagement", *ENGAGEMENT_PARTS} <= set(df.columns):
        return []
    parts = reduce(lambda a, b: a + b, [F.col(c) for c in ENGAGEMENT_PARTS])
    return [Check("engagement_total_consistent", F.count_if(F.col("total_engagement") != parts))]


def quality_suite(df: DataFrame, table: str, keys: list[str], main_corpus: bool = False) -> DataFrame:
    """All checks of a table as (table_name, check_name, check_result, rows_checked, rows_failed)."""
    checks = [row_count_check(), duplicate_check(df.columns), *null_checks(df, keys), *non_negative_checks(df)]
    if main_corpus:
        checks += [*range_checks(df, MAIN_CORPUS_BOUNDS), *engagement_check(df)]
    return Suite(checks).run(df, table)


def run_checks(df: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    return Suite(checks).run(df, table)


def profile_columns(df: DataFrame) -> DataFrame:
    """Per column: NULL share, distinct count, a sample cut to 40 characters, a flag.

    The frame is unpivoted to (column, digest of the text, its first 40 characters)
    and counted, so texts are not shuffled and repeated values collapse before it.
    The sample is the beginning of the smallest value, which does not depend on the
    row order.
    """
    text = {c: F.col(c).cast("string") for c in df.columns}
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.sha2(v, 256).alias("_v"), F.substring(v, 1, 40).alias("_s")) for c, v in text.items()
    ]
    values = df.select(F.inline(F.array(*entries))).groupBy("column_name", "_v", "_s").agg(F.count(F.lit(1)).alias("_n"))
    per_column = values.groupBy("column_name").agg(
        F.sum("_n").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("_v").isNull(), F.col("_n"))), F.lit(0)).alias("null_count"),
        F.count("_v").alias("distinct_count"),
        F.min("_s").alias("sample_value"),
    )
    percent = F.col("null_count") * F.lit(100).cast("double") / F.col("row_count")
    return per_column.withColumn("null_percent", percent).withColumn("mostly_null", F.col("null_percent") > 50)


def diagnose_empty_columns(df: DataFrame) -> DataFrame:
    """INFO when one column of many is empty, WARN when the file's names are likely wrong.

    No row when every column has a value.
    """
    names = [c for c in df.columns if c not in TECHNICAL]
    filled = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"_c{i}") for i, c in enumerate(names)])
    empty = F.array_compact(F.array(*[F.when(F.col(f"_c{i}") == 0, F.lit(c)) for i, c in enumerate(names)]))
    single = (F.size("_e") == 1) & (F.lit(2) < F.lit(len(names)))
    return (
        filled.where("_rows > 0")
        .select(empty.alias("_e"))
        .where(F.size("_e") > 0)
        .select(
            F.when(single, "INFO").otherwise("WARN").alias("severity"),
            F.size("_e").alias("empty_count"),
            F.array_join("_e", ", ").alias("empty_columns"),
        )
    )


def audit_dataset(df: DataFrame, date_columns: list[str]) -> DataFrame:
    """Rows, column count, missing values per column and the range of each date column.

    One row per column of the frame; the range is NULL for other columns.
    """
    def stamp(c: str) -> Column:
        return parse_timestamp(F.col(c)) if df.schema[c].dataType.typeName() == "string" else F.col(c).cast("timestamp_ntz")

    aggregates = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(df.columns):
        aggregates.append(F.count_if(F.col(c).isNull()).alias(f"_m{i}"))
        if c in date_columns:
            aggregates += [F.min(stamp(c)).alias(f"_lo{i}"), F.max(stamp(c)).alias(f"_hi{i}")]
    none = F.lit(None).cast("timestamp_ntz")
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("_rows").alias("row_count"),
            F.lit(len(df.columns)).alias("column_count"),
            F.col(f"_m{i}").alias("missing_count"),
            (F.col(f"_lo{i}") if c in date_columns else none).alias("first_date"),
            (F.col(f"_hi{i}") if c in date_columns else none).alias("last_date"),
        )
        for i, c in enumerate(df.columns)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def audit_files(spark, folder: str, datasets: dict[str, dict]) -> dict[str, DataFrame | None]:
    """One audit per expected file; None marks a missing one.

    ``datasets`` maps a file name to the options of ``scan_delimited`` and its
    ``date_columns``.
    """
    from pulseloom.sources.files import path_exists, scan_delimited

    result: dict[str, DataFrame | None] = {}
    for name, options in datasets.items():
        options = dict(options)
        dates = options.pop("date_columns", [])
        path = f"{folder.rstrip('/')}/{name}"
        if not path_exists(spark, path):
            result[name] = None
            continue
        result[name] = audit_dataset(scan_delimited(spark, path, **options), dates)
    return result


def audit_report(spark, folder: str, datasets: dict[str, dict]) -> DataFrame:
    """All expected files in one frame: (file_name, status, column_name, ...); a missing file is one row of status MISSING."""
    found = audit_files(spark, folder, datasets)
    names = "column_name string, row_count bigint, column_count int, missing_count bigint, first_date timestamp_ntz, last_date timestamp_ntz"
    declared = spark.createDataFrame([(n, "MISSING" if d is None else "PRESENT") for n, d in found.items()], "file_name string, status string")
    audits = [d.select(F.lit(n).alias("file_name"), "*") for n, d in found.items() if d is not None]
    columns = reduce(DataFrame.unionByName, audits, spark.createDataFrame([], f"file_name string, {names}"))
    # One row per declared file on the left.
    return declared.join(columns, "file_name", "left")


def quality_of_tables(tables: dict[str, DataFrame], keys: dict[str, list[str]], main_corpus: str | None = None) -> DataFrame:
    """The suite of each table with its declared key columns, one below the other."""
    suites = [quality_suite(df, name, keys.get(name, []), name == main_corpus) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, suites)


def dq_result_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("check_result").agg(F.count(F.lit(1)).alias("check_count"))


def dq_log_newest(log: DataFrame) -> DataFrame:
    return log.orderBy(F.col("check_id").desc())
