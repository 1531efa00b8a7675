"""Mapping to the common post shape, change capture (SCD2) and key checks."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from pulseloom.functions.ordering import global_rank
from pulseloom.schemas import COMMON_FIELDS, MAPPINGS, VERSIONED_FACT, column_types
from pulseloom.session import materialise

# The fields whose change makes a new version.
TRACKED_FIELDS = ["text_content", "likes", "comments", "shares", "views"]
_TYPES = column_types(VERSIONED_FACT)


def map_to_common(df: DataFrame, mapping: tuple[int, int, list[str | None]] | str) -> DataFrame:
    """Constant source and platform ids and the seven common fields.

    ``mapping`` is an entry of ``MAPPINGS`` or its table name. ``ingested_at``
    is kept for the choice of the newest row.
    """
    source_id, platform_id, fields = MAPPINGS[mapping] if isinstance(mapping, str) else mapping
    columns = [F.lit(source_id).alias("source_id"), F.lit(platform_id).alias("platform_id")]
    for target, source in zip(COMMON_FIELDS, fields, strict=True):
        value = F.lit(None) if source is None else F.col(source)
        columns.append(value.cast(_TYPES[target]).alias(target))
    if "ingested_at" in df.columns:
        columns.append(F.col("ingested_at"))
    return df.select(*columns)


def null_key_rejects(staged: DataFrame) -> DataFrame:
    """Rows without a natural key: they cannot be matched, so they are set apart."""
    return staged.where(F.col("external_post_id").isNull())


def dedupe_latest(staged: DataFrame, keys: list[str] | None = None, newest: str = "ingested_at") -> DataFrame:
    """The newest row per natural key; ties go to the larger content.

    ``max_by`` keeps one row per key on the map side, so a key with very many
    copies does not travel.
    """
    keys = keys or ["source_id", "external_post_id"]
    rest = [c for c in staged.columns if c not in keys]
    payload = F.struct(*rest)
    rank = F.struct(newest, *[c for c in rest if c != newest])
    return staged.groupBy(*keys).agg(F.max_by(payload, rank).alias("_row")).select(*keys, "_row.*").select(*staged.columns)


def current_snapshot(fact: DataFrame, source_id: int) -> DataFrame:
    return fact.where((F.col("source_id") == source_id) & F.col("is_current"))


def _text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def _differs(old: str, new: str) -> Column:
    """True where any tracked field differs; NULL counts as the empty text."""
    return reduce(lambda a, b: a | b, [_text(F.col(f"{old}.{f}")) != _text(F.col(f"{new}.{f}")) for f in TRACKED_FIELDS])


def _tracked_digest() -> Column:
    """Stands for the tracked fields; lengths keep neighbours apart. NULL counts as the empty text."""
    parts = [F.concat(F.length(_text(F.col(f))).cast("string"), F.lit(":"), _text(F.col(f))) for f in TRACKED_FIELDS]
    return F.sha2(F.concat(*parts), 256)


def detect_changes(staged: DataFrame, current: DataFrame) -> DataFrame:
    """Staged rows that are new (``is_update`` false) or changed (true).

    Of the current versions only the key and a digest of the tracked fields travel.
    Both sides have one row per key, so no key is hot here.
    """
    versions = current.select("source_id", "external_post_id", _tracked_digest().alias("_known"))
    joined = staged.withColumn("_own", _tracked_digest()).join(versions, ["source_id", "external_post_id"], "left")
    known = F.col("_known").isNotNull()
    changed = joined.where(~known | (F.col("_known") != F.col("_own")))
    return changed.select(*[F.col(f"`{c}`") for c in staged.columns], known.alias("is_update"))


def merge_versions(fact: DataFrame, staged: DataFrame, starts: Column, tasks: int | None = None) -> DataFrame:
    """The versions that stay, some of them expired, and the new ones, still without a key.

    ``starts`` says when a staged row begins to hold; it may be a column of the staged
    rows, such as their source time. A staged row makes a version if its key is new, or
    if it differs from the current version and begins after it. One that begins no later
    is a replay, or came too late to be told from one, and changes nothing.

    One full join of the current versions with the batch gives all of this, dealt by
    the key to ``tasks`` tasks if given; closed versions are not shuffled. ``_fresh``
    marks new versions, ``_update`` those that replace another.
    """
    fact = fact.select(*[F.col(name).cast(kind) for name, kind in _TYPES.items()])
    rows, current = staged.withColumn("_starts", starts.cast("timestamp_ntz")), fact.where("is_current")
    if tasks:
        rows, current = (df.repartition(tasks, "source_id", "external_post_id") for df in (rows, current))
    same_key = (F.col("s.source_id") == F.col("c.source_id")) & (F.col("s.external_post_id") == F.col("c.external_post_id"))
    joined = current.alias("c").join(rows.alias("s"), same_key, "full")
    known, given = F.col("c.external_post_id").isNotNull(), F.col("s.external_post_id").isNotNull()
    later = F.coalesce(F.col("s._starts") > F.col("c.effective_date"), F.col("c.effective_date").isNull())
    update = given & known & _differs("c", "s") & later
    fresh = (given & ~known) | update
    old = {name: F.col(f"c.{name}") for name in _TYPES}
    old |= {"is_current": ~update, "expiration_date": F.when(update, F.col("s._starts")).otherwise(F.col("c.expiration_date"))}
    born = {name: F.col(f"s.{name}") if name in staged.columns else F.lit(None) for name in _TYPES}
    born |= {"post_id": F.lit(None), "load_date": F.col("s._starts"), "effective_date": F.col("s._starts")}
    born |= {"expiration_date": F.lit(None), "is_current": F.lit(True)}

    def row(values: dict[str, Column], *marks: Column) -> Column:
        fields = [values[name].cast(kind).alias(name) for name, kind in _TYPES.items()]
        return F.struct(*fields, *[m.alias(n) for m, n in zip(marks, ("_fresh", "_update"), strict=True)])

    no = F.lit(False)
    both = F.array(F.when(known, row(old, no, no)), F.when(fresh, row(born, F.lit(True), F.coalesce(update, no))))
    merged = joined.select(F.inline(F.filter(both, lambda v: v.isNotNull())))
    closed = fact.where(~F.col("is_current")).withColumns({"_fresh": no, "_update": no})
    return merged.unionByName(closed)


def number_versions(fresh: DataFrame, last_id: int) -> DataFrame:
    """New versions with their keys after ``last_id``, in the order of the natural key: a rerun gives the same."""
    bare = fresh.drop("post_id", "_fresh", "_update")
    numbered = global_rank(bare, [F.col("source_id"), F.col("external_post_id")], "post_id", last_id)
    extra = [c for c in bare.columns if c not in _TYPES]
    return numbered.select(*_TYPES, *extra)


def scd2_apply(fact: DataFrame, staged: DataFrame, as_of: Column, last_id: int = 0) -> DataFrame:
    """All versions after a batch of deduplicated rows.

    The fact is shuffled once, see ``merge_versions``; its result is written, as the
    keys of the new versions need their order.
    """
    merged = materialise(merge_versions(fact, staged, as_of), "versions")
    kept = merged.where(~F.col("_fresh")).select(*_TYPES)
    return kept.unionByName(number_versions(merged.where("_fresh"), last_id))


def scd2_summary(staging: DataFrame, staged: DataFrame, current: DataFrame) -> DataFrame:
    """Counts of raw, deduplicated, new, updated and unchanged rows; zeros when empty."""
    raw = staging.agg(F.count(F.lit(1)).alias("staging_rows_raw"))
    deduped = staged.agg(F.count(F.lit(1)).alias("staging_rows_deduped"))
    changes = detect_changes(staged, current).agg(
        F.count_if(~F.col("is_update")).alias("new"), F.count_if("is_update").alias("updated")
    )
    # Three frames of exactly one row each.
    counts = raw.crossJoin(F.broadcast(deduped)).crossJoin(F.broadcast(changes))
    return counts.withColumn("unchanged", F.col("staging_rows_deduped") - F.col("new") - F.col("updated"))


def assign_surrogate_key(df: DataFrame, order: list[Column], alias: str, start: int = 0) -> DataFrame:
    """``start + 1, start + 2, ...`` over the whole frame in the given order."""
    return global_rank(df, order, alias, start)


def insert_if_absent(existing: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """``existing`` plus one row per key that it lacks. Running it twice adds nothing.

    Of several new rows with one key the one that sorts first by its other columns
    goes in. NULL is a key like any other.
    """
    rest = [c for c in existing.columns if c != key]
    one = rows.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row")).select(key, "_row.*") if rest else rows.select(key).distinct()
    known = existing.select(F.col(key).alias("_known")).distinct()
    new = one.join(known, one[key].eqNullSafe(known["_known"]), "left_anti")
    return existing.unionByName(new.select(*existing.columns))


def check_foreign_key(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    parents = parent.select(F.col(parent_column).alias(column)).distinct()
    return child.where(F.col(column).isNotNull()).join(parents, column, "left_anti").select(*child.columns)


def check_key_and_not_null(df: DataFrame, key: str, required: list[str]) -> DataFrame:
    """Violations as (violation, column_name, key_value, row_count)."""
    duplicates = (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).cast("string").alias("key_value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where("row_count > 1")
        .select(F.lit("duplicate_key").alias("violation"), F.lit(key).alias("column_name"), "key_value", "row_count")
    )
    names = list(dict.fromkeys([key, *required]))
    entries = [F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("row_count")) for c in names]
    nulls = (
        df.agg(F.array(*entries).alias("_n"))
        .select(F.inline("_n"))
        .where("row_count > 0")
        .select(
            F.lit("null_value").alias("violation"),
            "column_name",
            F.lit(None).cast("string").alias("key_value"),
            "row_count",
        )
    )
    return duplicates.unionByName(nulls)


def schema_diff(spark: SparkSession, declared: dict[str, StructType], actual: dict[str, StructType]) -> DataFrame:
    """Additive changes needed: (table_name, column_name, data_type, action)."""
    rows = []
    for table, schema in declared.items():
        present = set(actual[table].names) if table in actual else set()
        action = "add_column" if table in actual else "create_table"
        rows += [(table, f.name, f.dataType.simpleString(), action) for f in schema if f.name not in present]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, action string")


def stored_schemas(spark: SparkSession, paths: dict[str, str]) -> dict[str, StructType]:
    """The schemas of Parquet tables as their files have them, old and new ones merged; tables not there are left out."""
    found = {}
    for table, path in paths.items():
        try:
            found[table] = spark.read.option("mergeSchema", True).parquet(path).schema
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    return found


def migrate(spark: SparkSession, declared: dict[str, StructType], paths: dict[str, str], dry_run: bool = True) -> DataFrame:
    """Bring stored tables up to their declared schemas; returns the changes, (table_name, column_name, data_type, action).

    A missing table becomes an empty one. A missing column comes with one more file that
    has the column and no rows, so no stored row is written again; readers merge the
    schemas and find NULL. Nothing is ever dropped, retyped or renamed. With ``dry_run``
    the changes are reported only.
    """
    actual = stored_schemas(spark, paths)
    report = schema_diff(spark, declared, actual)
    if not dry_run:
        # As many as there are declared tables.
        for table in {r["table_name"] for r in report.select("table_name").distinct().collect()}:
            fields = {f.name: f for f in actual.get(table, StructType())} | {f.name: f for f in declared[table] if f.name not in actual.get(table, StructType()).names}
            whole = StructType([StructField(f.name, f.dataType, True) for f in fields.values()])
            spark.createDataFrame([], whole).coalesce(1).write.mode("append").parquet(paths[table])
    return report


def evolve_schema(df: DataFrame, declared: StructType) -> DataFrame:
    """Add declared columns the frame lacks, as NULL. Never drops, retypes or renames."""
    added = [F.lit(None).cast(f.dataType).alias(f.name) for f in declared if f.name not in df.columns]
    return df.select("*", *added)
