"""Source, sink and ingestion queries. File operators read files that Spark derives from the tables."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from pulseloom.functions.hashing import stable_id
from pulseloom.functions.times import epoch_to_iso, parse_timestamp, to_iso
from pulseloom.plans.bindings import TABLES, table, view
from pulseloom.plans.registry import query
from pulseloom.schemas import table_schema
from pulseloom.session import scratch_path
from pulseloom.sources import files, ledger, samples

_DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
_QUOTED = {"quote": '"', "escape": '"'}
AS_OF = datetime.datetime(2024, 1, 1)


@query("scan_delimited", "select doc_id, text, lang, source, n_chars from documents")
def scan_delimited(spark, sf_dir):
    """Documents with quotes and line breaks through a semicolon file."""
    path = scratch_path(spark, "csv") + "/documents.csv"
    table(spark, sf_dir, "documents").write.options(header=True, sep=";", **_QUOTED).csv(path)
    read = files.scan_delimited(spark, path, sep=";")
    return read.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in _DOC.split(", ")])


@query("scan_headerless", "select event_id, user_id, event_type, props from events")
def scan_headerless(spark, sf_dir):
    path = scratch_path(spark, "tsv") + "/events.tsv"
    columns = ["event_id", "user_id", "event_type", "props"]
    table(spark, sf_dir, "events").select(*columns).write.options(header=False, sep="\t", **_QUOTED).csv(path)
    read = files.scan_delimited(spark, path, column_names=columns)
    return read.withColumns({c: F.col(c).cast("bigint") for c in columns[:2]})


@query("scan_encoding_fallback", "select doc_id, concat(source, ' café trop cher ', lang) as note from documents")
def scan_encoding_fallback(spark, sf_dir):
    path = scratch_path(spark, "latin") + "/notes.csv"
    note = F.concat("source", F.lit(" café trop cher "), "lang").alias("note")
    notes = table(spark, sf_dir, "documents").select("doc_id", note)
    notes.write.options(header=True, encoding="ISO-8859-1").csv(path)
    return files.scan_delimited(spark, path).withColumn("doc_id", F.col("doc_id").cast("bigint"))


@query("scan_structured", "select doc_id, text, lang, source, n_chars from documents")
def scan_structured(spark, sf_dir):
    path = scratch_path(spark, "jsonl") + "/documents.jsonl"
    files.sink_structured(files.scan_structured(spark, f"{sf_dir}/documents.parquet"), path)
    return files.scan_structured(spark, path).select("doc_id", "text", "lang", "source", "n_chars")


@query(
    "sink_structured",
    """select o_orderkey, o_orderpriority, 'parquet' as kind from orders union all
       select o_orderkey, o_orderpriority, 'json' from orders union all
       select o_orderkey, o_orderpriority, 'csv' from orders""",
)
def sink_structured(spark, sf_dir):
    root = scratch_path(spark, "sink")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    result = None
    for kind, suffix in (("parquet", ".parquet"), ("json", ".jsonl"), ("csv", ".csv")):
        files.sink_structured(orders, f"{root}/orders{suffix}")
        back = files.scan_structured(spark, f"{root}/orders{suffix}")
        back = back.select(F.col("o_orderkey").cast("bigint"), "o_orderpriority", F.lit(kind).alias("kind"))
        result = back if result is None else result.unionByName(back)
    return result


@query("rename_columns", "select c_custkey as customer_id, c_name as name, c_nationkey, c_acctbal, c_mktsegment as segment from customer")
def rename_columns(spark, sf_dir):
    names = {"c_custkey": "customer_id", "c_name": "name", "c_mktsegment": "segment"}
    return files.rename_columns(table(spark, sf_dir, "customer"), names)


def _tweets(spark, sf_dir):
    """Events as headerless tweets with zoned dates."""
    stamp = F.concat(F.date_format("ts", "EEE MMM dd HH:mm:ss"), F.lit(" PDT "), F.date_format("ts", "yyyy"))
    return table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", 0).otherwise(4).alias("polarity"),
        F.col("event_id").alias("tweet_id"),
        stamp.alias("tweet_date"),
        F.lit("NO_QUERY").alias("flag"),
        F.concat(F.lit("user"), "user_id").alias("user_handle"),
        F.col("props").alias("text"),
    )


_TWEETS = """select event_id as tweet_id, props as text, cast(case when event_type = 'error' then 0 else 4 end as int) as polarity,
  date_trunc('second', ts) as tweet_date, concat('user', user_id) as user_handle from events"""


@query("load_profile", _TWEETS)
def load_profile(spark, sf_dir):
    """A headerless corpus loaded by its profile alone."""
    root = scratch_path(spark, "load")
    _tweets(spark, sf_dir).write.options(header=False, **_QUOTED).csv(f"{root}/Sentiment140.csv")
    area = ledger.StagingArea(spark, f"{root}/staging")
    area.load(f"{root}/Sentiment140.csv", "raw_sentiment140", AS_OF)
    return area.table("raw_sentiment140").drop("ingested_at", "source_file")


@query(
    "load_losses",
    """select 'raw_sentiment140' as table_name, 'tweet_date' as column_name, count(*) filter (event_id % 5 = 0) as lost,
         count(*) as row_count from events""",
)
def load_losses(spark, sf_dir):
    """Every fifth date is no date; the load counts it while it writes."""
    root = scratch_path(spark, "load")
    dated = F.when(F.col("tweet_id") % 5 == 0, "soon").otherwise(F.col("tweet_date"))
    _tweets(spark, sf_dir).withColumn("tweet_date", dated).write.options(header=False, **_QUOTED).csv(f"{root}/Sentiment140.csv")
    area = ledger.StagingArea(spark, f"{root}/staging")
    area.load(f"{root}/Sentiment140.csv", "raw_sentiment140", AS_OF, multi_line=False)
    loads = area.ledger().select("log_id", "table_name", F.col("row_count").cast("long").alias("row_count"))
    return area.losses().join(loads, ["log_id", "table_name"]).drop("log_id")


@query(
    "load_all",
    """select 'raw_sentiment140' as table_name, 'LOADED' as status, count(*) as row_count from events
       union all select 'raw_twitter_fr', 'LOADED', count(*) from documents
       union all select t, 'MISSING_FILE', 0 from (values ('raw_youtube_comments'), ('raw_allocine'),
         ('raw_amazon_reviews'), ('raw_reddit'), ('raw_facebook_comments'), ('raw_multi_platform_posts')) v(t)""",
)
def load_all(spark, sf_dir):
    root = scratch_path(spark, "load")
    _tweets(spark, sf_dir).write.options(header=False, **_QUOTED).csv(f"{root}/Sentiment140.csv")
    french = table(spark, sf_dir, "documents").select((F.col("doc_id") % 2).alias("label"), "text")
    french.write.options(header=True, **_QUOTED).csv(f"{root}/french_tweets.csv")
    area = ledger.StagingArea(spark, f"{root}/staging")
    summary = area.load_all(root, AS_OF)
    # One row per declared profile.
    status = spark.createDataFrame(list(summary.items()), "table_name string, status string")
    counts = ledger.table_status({t: area.table(t) for t in summary})
    return status.join(counts, "table_name")


@query(
    "align_to_schema",
    """select cast(o_orderkey as varchar) as comment_id, cast(null as varchar) as subreddit, o_orderpriority as text,
         cast(o_custkey as int) as score, o_orderdate as created_at, timestamp '2024-01-01 00:00:00' as ingested_at,
         'orders' as source_file from orders""",
)
def align_to_schema(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("comment_id"),
        F.col("o_orderpriority").alias("text"),
        F.col("o_custkey").cast("string").alias("score"),
        F.col("o_orderdate").cast("string").alias("created_at"),
        F.col("o_totalprice").alias("not_declared"),
    )
    schema = table_schema("raw_reddit")
    return ledger.align_to_schema(orders, schema, F.lit("2024-01-01 00:00:00"), F.lit("orders")).frame


@query(
    "coerce_timestamp",
    """select event_id, case event_id % 3 when 0 then date_trunc('second', ts) when 1 then ts else null end as parsed
       from events""",
)
def coerce_timestamp(spark, sf_dir):
    zoned = F.concat(F.date_format("ts", "EEE MMM dd HH:mm:ss"), F.lit(" PDT "), F.date_format("ts", "yyyy"))
    text = F.when(F.col("event_id") % 3 == 0, zoned).when(F.col("event_id") % 3 == 1, F.col("ts").cast("string"))
    text = text.otherwise(F.concat(F.lit("not a date "), "event_id"))
    return table(spark, sf_dir, "events").select("event_id", parse_timestamp(text).alias("parsed"))


@query(
    "stable_id",
    """select doc_id, cast(('0x' || substring(h, 18, 15))::ubigint
         + ('0x' || substring(h, 17, 1))::ubigint % 4 * 1152921504606846976 as bigint) as row_id
       from (select doc_id, md5(concat_ws('|', coalesce(text, 'nan'), coalesce(lang, 'nan'), coalesce(source, 'nan'),
               cast(n_chars as varchar))) as h from documents)""",
)
def stable_id_query(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", stable_id(["text", "lang", "source", "n_chars"]).alias("row_id"))


@query(
    "file_fingerprint",
    r"""select concat('part=', part) as file_name, sum(strlen(line) + 1) as length,
          sha256(string_agg(concat(line, chr(10)), '' order by o_orderkey)) as file_hash
        from (select o_orderkey % 7 as part, o_orderkey, concat(o_orderkey, ' ', o_orderpriority) as line from orders) group by part""",
)
def file_fingerprint(spark, sf_dir):
    """The orders as seven text files."""
    folder = scratch_path(spark, "texts")
    line = F.concat_ws(" ", F.col("o_orderkey").cast("string"), "o_orderpriority").alias("line")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 7).alias("part"), line)
    # One file per part, as each part is in one task.
    sorted_rows = orders.repartition("part").sortWithinPartitions("part", "o_orderkey")
    sorted_rows.select("part", "line").write.partitionBy("part").text(folder)
    found = files.file_fingerprints(spark, f"{folder}/*/*.txt")
    return found.select(F.element_at(F.split("path", "/"), -2).alias("file_name"), "length", "file_hash")


@query("fingerprint_tables")
def fingerprint_tables(spark, sf_dir):
    """The files of the given tables by their bytes."""
    found = files.file_fingerprints(spark, [f"{sf_dir}/{t}.parquet" for t in TABLES])
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "length", "file_hash")


@query(
    "value_to_iso",
    """select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') as stamp, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' as zoned,
         strftime(ts, '%Y-%m-%d') as day, event_type as kept,
         strftime(make_timestamp((1600000000 + event_id) * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' as number from events""",
)
def value_to_iso(spark, sf_dir):
    """Times with and without a zone, days, text that is kept, and epoch seconds."""
    seconds = F.date_trunc("second", F.col("ts").cast("timestamp"))
    values = {"stamp": seconds.cast("timestamp_ntz"), "zoned": seconds, "day": F.col("ts").cast("date"), "kept": F.col("event_type")}
    events = table(spark, sf_dir, "events").select("event_id", *[c.alias(n) for n, c in values.items()], (F.col("event_id") + 1_600_000_000).alias("number"))
    kinds = {f.name: f.dataType.typeName() for f in events.schema}
    return events.select("event_id", *[to_iso(F.col(c), kinds[c]).alias(c) for c in (*values, "number")])


@query(
    "ingestion_ledger",
    """select log_id, file_hash, table_name, case when log_id = min(log_id) over (partition by file_hash, table_name)
         then 'LOADED' when force then 'FORCED_RELOAD' else 'SKIPPED_DUPLICATE' end as status from attempts""",
)
def ingestion_ledger(spark, sf_dir):
    status = ledger.ledger_status(view(spark, sf_dir, "attempts"), "log_id", "force")
    return status.select("log_id", "file_hash", "table_name", "status")


@query(
    "sample_extract",
    """select concat('al_', row_number() over (order by md5(concat(cast(doc_id as varchar), '-42'))) - 1) as review_id, text,
         case when label = 'positive' then 5.0::double else 1.0::double end as rating, cast(null as timestamp) as review_date
       from reviews order by md5(concat(cast(doc_id as varchar), '-42')) limit 200""",
)
def sample_extract(spark, sf_dir):
    reviews = view(spark, sf_dir, "reviews").withColumn("code", (F.col("label") == "positive").cast("int"))
    high, low = F.lit(5).cast("double"), F.lit(1).cast("double")
    synthesised = {
        "rating": samples.binary_rating(F.col("code"), high, low),
        "review_date": F.lit(None).cast("timestamp_ntz"),
    }
    return samples.sample_extract(reviews, "doc_id", 200, {"text": "text"}, synthesised, ("review_id", "al_"))


@query(
    "epoch_to_iso",
    """select event_id, case when event_id % 7 = 0 then null else
         strftime(make_timestamp((1600000000 + event_id * 977) * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' end as created_at
       from events""",
)
def epoch_to_iso_query(spark, sf_dir):
    epoch = F.when(F.col("event_id") % 7 != 0, F.col("event_id") * 977 + 1_600_000_000)
    return table(spark, sf_dir, "events").select("event_id", epoch_to_iso(epoch).alias("created_at"))


@query(
    "enrich_comments",
    """select 'facebook' as plateforme, cast(e.event_id as varchar) as id_publication,
         concat('c', e.event_id) as id_commentaire, e.props as texte, d.text as texte_publication,
         case when d.doc_id is not null then concat(d.lang, '-2') end as ecole
       from events e left join documents d on d.doc_id = e.event_id""",
)
def enrich_comments(spark, sf_dir):
    """Every publication stands twice in its file; most comments match none."""
    comments = table(spark, sf_dir, "events").select(
        F.lit("facebook").alias("plateforme"),
        F.col("event_id").cast("string").alias("id_publication"),
        F.concat(F.lit("c"), "event_id").alias("id_commentaire"),
        F.col("props").alias("texte"),
    )
    documents = table(spark, sf_dir, "documents")
    copies = documents.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("line"))
    publications = copies.select(
        F.lit("facebook").alias("plateforme"),
        F.col("doc_id").cast("string").alias("id_publication"),
        F.when(F.col("line") == 2, F.col("text")).otherwise("an earlier text").alias("texte"),
        F.concat_ws("-", "lang", "line").alias("ecole"),
        "line",
    )
    return samples.enrich_comments(comments, publications, "line")


@query(
    "truncate_table",
    """select 'raw_sentiment140' as table_name, 0 as row_count union all select 'raw_twitter_fr', count(*) from documents
       union all select 'ingestion_log', 1""",
)
def truncate_table(spark, sf_dir):
    """Two corpora are loaded; emptying one leaves the other and its ledger rows."""
    root = scratch_path(spark, "load")
    _tweets(spark, sf_dir).write.options(header=False, **_QUOTED).csv(f"{root}/Sentiment140.csv")
    french = table(spark, sf_dir, "documents").select((F.col("doc_id") % 2).alias("label"), "text")
    french.write.options(header=True, **_QUOTED).csv(f"{root}/french_tweets.csv")
    area = ledger.StagingArea(spark, f"{root}/staging")
    area.load_all(root, AS_OF)
    area.truncate("raw_sentiment140", confirm=True)
    tables = {t: area.table(t) for t in ("raw_sentiment140", "raw_twitter_fr")}
    return ledger.table_status({**tables, "ingestion_log": area.ledger()})
