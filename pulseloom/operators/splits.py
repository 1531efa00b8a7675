"""Train/test splits, samples, targets and baselines."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from pulseloom.functions.hashing import flag_by_quota
from pulseloom.functions.ordering import global_rank
from pulseloom.functions.quantiles import exact_quantiles
from pulseloom.session import materialise

MIN_ROWS = 100
SEED = 42


def chronological_split(posts: DataFrame, ts: str = "published_at", tiebreak: str = "post_id", share: float = 0.8) -> DataFrame:
    """Add ``is_train``: the first ``int(n * share)`` rows in time order."""
    ranked = global_rank(posts, [F.col(ts), F.col(tiebreak)], "time_rank")
    rows = ranked.count()
    if rows < MIN_ROWS:
        raise ValueError(f"the corpus has {rows} rows; a reliable benchmark needs {MIN_ROWS}")
    return ranked.withColumn("is_train", F.col("time_rank") <= int(rows * share))


def nth_row(df: DataFrame, ts: str, tiebreak: str, place: int) -> Row | None:
    """Time and tiebreak of the row at a place (from 1) in time order, NULL times first.

    Counts per day tell the day, counts per moment within that day the moment, and
    only the rows of that moment are put in order. No frame is sorted as a whole.
    """
    day = F.col(ts).cast("date")
    upto = Window.orderBy(F.col("at").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def holding(rows: DataFrame, key: Column, place: int) -> Row | None:
        # One row per day, or per moment of one day.
        counts = rows.groupBy(key.alias("at")).agg(F.count(F.lit(1)).alias("n")).withColumn("upto", F.sum("n").over(upto))
        return counts.where(F.col("upto") >= place).orderBy("upto").first()

    on = holding(df, day, place)
    if on is None:
        return None
    rows, place = df.where(day.eqNullSafe(F.lit(on["at"]))), place - (on["upto"] - on["n"])
    moment = holding(rows, F.col(ts), place)
    rows, place = rows.where(F.col(ts).eqNullSafe(F.lit(moment["at"]).cast(df.schema[ts].dataType))), place - (moment["upto"] - moment["n"])
    return global_rank(rows.select(ts, tiebreak), [F.col(tiebreak)], "_at").where(F.col("_at") == place).select(ts, tiebreak).first()


def chronological_cut(posts: DataFrame, ts: str = "published_at", tiebreak: str = "post_id", share: float = 0.8) -> Column:
    """The condition that holds on the first ``int(n * share)`` rows in time order, as ``chronological_split`` marks them.

    It is a plain filter, so the posts themselves are neither sorted nor written.
    """
    narrow = posts.select(ts, tiebreak)
    rows = narrow.count()
    if rows < MIN_ROWS:
        raise ValueError(f"the corpus has {rows} rows; a reliable benchmark needs {MIN_ROWS}")
    last = nth_row(narrow, ts, tiebreak, int(rows * share))
    if last is None:
        return F.lit(False)
    moment = F.lit(last[ts]).cast(posts.schema[ts].dataType)
    same = F.col(ts).eqNullSafe(moment) & (F.col(tiebreak).isNull() | (F.col(tiebreak) <= F.lit(last[tiebreak])))
    earlier = F.col(ts).isNull() & moment.isNotNull() | F.coalesce(F.col(ts) < moment, F.lit(False))
    return earlier | F.coalesce(same, F.lit(False))


def log_engagement(value: Column) -> Column:
    """log1p of the value clipped at 0; NULL stays NULL."""
    return F.when(value.isNotNull(), F.log1p(F.greatest(value, F.lit(0)).cast("double")))


def baseline_regressor(train: DataFrame, target: str, rows: DataFrame, alias: str = "prediction", **options) -> DataFrame:
    """Predict the train median everywhere."""
    median = exact_quantiles(train, [], target, {alias: 0.5}, **options)
    return rows.crossJoin(F.broadcast(median.agg(F.max(alias).alias(alias))))


def viral_label(train: DataFrame, rows: DataFrame, group: str = "platform", value: str = "viral_coefficient", **options) -> DataFrame:
    """Add ``viral``: 1 at or above the train p90 of the row's platform, else 0.

    A platform unseen in train, and a NULL platform or value, give 0.
    """
    known = train.where(F.col(group).isNotNull())
    thresholds = materialise(exact_quantiles(known, [group], value, {"viral_threshold": 0.9}, **options), "p90")
    flag = F.coalesce((F.col(value) >= F.col("viral_threshold")).cast("int"), F.lit(0))
    return rows.join(thresholds, group, "left").withColumn("viral", flag)


def baseline_classifier(train: DataFrame, label: str) -> DataFrame:
    """Class priors: one row per label with its share; the most frequent is predicted."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("row_count"))
    # One row per class.
    total = counts.agg(F.sum("row_count").alias("_n"), F.max(F.struct("row_count", label)).alias("_top"))
    return counts.crossJoin(F.broadcast(total)).select(
        label,
        "row_count",
        (F.col("row_count") / F.col("_n")).alias("prior"),
        (F.col(label) == F.col(f"_top.{label}")).alias("is_predicted"),
    )


def balanced_weights(df: DataFrame, label: str, alias: str = "weight") -> DataFrame:
    """Add n / (classes * n_class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_c"))
    totals = counts.agg(F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_k"))
    factors = counts.crossJoin(F.broadcast(totals)).select(label, (F.col("_n") / (F.col("_k") * F.col("_c"))).alias(alias))
    # Written first: its real size then decides the join, and the hot class need not move.
    return df.join(materialise(factors, "weights"), label)


# Label spellings of the two labelled corpora.
LABELS_01 = {"0": "negative", "1": "positive"}
LABELS_04 = {"0": "negative", "4": "positive"}


def normalise_corpus(df: DataFrame, text: str, label: str, names: dict[str, str], language: str | Column) -> DataFrame:
    """(text, label, language) with labels mapped; rows with a NULL or unknown label drop out."""
    code = F.col(label).cast("string")
    mapped = F.lit(None).cast("string")
    for raw, name in names.items():
        mapped = F.when(code == raw, name).otherwise(mapped)
    tag = F.lit(language) if isinstance(language, str) else language
    rest = [c for c in df.columns if c not in (text, label)]
    shaped = df.select(*rest, F.col(text).alias("text"), mapped.alias("label"), tag.alias("language"))
    return shaped.where(F.col("text").isNotNull() & F.col("label").isNotNull())


def normalise_corpora(*corpora: DataFrame) -> DataFrame:
    result = corpora[0]
    for other in corpora[1:]:
        result = result.unionByName(other)
    return result


def stratified_quotas(df: DataFrame, label: str, n: int) -> DataFrame:
    """Rows per label that add up to exactly ``n``, by largest remainder."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_c"))
    everything = Window.partitionBy()
    exact = F.col("_c") * F.lit(n) / F.sum("_c").over(everything)
    parts = counts.withColumn("_exact", exact).withColumn("_floor", F.floor("_exact"))
    missing = F.lit(n) - F.sum("_floor").over(everything)
    place = F.row_number().over(Window.orderBy((F.col("_exact") - F.col("_floor")).desc(), F.col(label)))
    # These windows hold one row per class.
    ranked = parts.withColumn("_missing", missing).withColumn("_place", place)
    return ranked.select(label, (F.col("_floor") + (F.col("_place") <= F.col("_missing")).cast("long")).alias("_quota"))


def stratified_sample(df: DataFrame, key: str, label: str, max_rows: int, seed: int = SEED) -> DataFrame:
    """Exactly ``max_rows`` rows, labels in proportion; the whole frame if it is no larger."""
    if df.limit(max_rows + 1).count() <= max_rows:
        return df
    quotas = stratified_quotas(df, label, max_rows)
    return flag_by_quota(df, F.col(key), [label], quotas, "_in", seed).where("_in").drop("_in")


def stratified_split(df: DataFrame, key: str, label: str, share: float = 0.8, seed: int = SEED) -> DataFrame:
    """Add ``is_train``: true on floor(share * n) rows of each label."""
    exact = Fraction(repr(share)).limit_denominator(1_000_000)
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_c"))
    quotas = counts.select(label, F.expr(f"_c * {exact.numerator} div {exact.denominator}").alias("_quota"))
    return flag_by_quota(df, F.col(key), [label], quotas, "is_train", seed)
