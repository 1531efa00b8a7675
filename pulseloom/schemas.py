"""Declared tables: columns, technical columns, keys and reference rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

STAGING_COLUMNS = "ingested_at TIMESTAMP_NTZ, source_file STRING"
SCD2_COLUMNS = (
    "load_date TIMESTAMP_NTZ, effective_date TIMESTAMP_NTZ, expiration_date TIMESTAMP_NTZ, is_current BOOLEAN"
)

# The declared columns of each table, in order.
STAGING = {
    "raw_youtube_comments": """comment_id STRING, video_id STRING, channel_id STRING, text STRING,
        sentiment_category STRING, sentiment_score DOUBLE, likes INT, published_at TIMESTAMP_NTZ""",
    "raw_sentiment140": "tweet_id BIGINT, text STRING, polarity INT, tweet_date TIMESTAMP_NTZ, user_handle STRING",
    "raw_twitter_fr": "tweet_id BIGINT, text STRING, sentiment STRING, tweet_date TIMESTAMP_NTZ",
    "raw_allocine": "review_id STRING, text STRING, rating DOUBLE, review_date TIMESTAMP_NTZ",
    "raw_reddit": "comment_id STRING, subreddit STRING, text STRING, score INT, created_at TIMESTAMP_NTZ",
    "raw_amazon_reviews": """review_id STRING, product_id STRING, text STRING, star_rating INT,
        review_date TIMESTAMP_NTZ, verified_purchase BOOLEAN""",
    "raw_facebook_comments": """plateforme STRING, id_commentaire STRING, id_publication STRING,
        pseudo_auteur STRING, texte STRING, date_commentaire TIMESTAMP_NTZ, langue STRING,
        texte_publication STRING, date_publication TIMESTAMP_NTZ, type_contenu STRING, ecole STRING,
        likes INT, partages INT, vues INT, nb_commentaires INT""",
    "raw_multi_platform_posts": """post_id STRING, platform STRING, timestamp TIMESTAMP_NTZ, date DATE,
        hour_of_day INT, day_of_week STRING, is_weekend BOOLEAN, user_id STRING, followers BIGINT,
        account_age_days INT, verified BOOLEAN, topic STRING, language STRING, content_length INT,
        media_type STRING, num_hashtags INT, sentiment_category STRING, sentiment_positive DOUBLE,
        sentiment_negative DOUBLE, sentiment_neutral DOUBLE, likes BIGINT, shares BIGINT, comments BIGINT,
        views BIGINT, total_engagement BIGINT, engagement_rate_per_1k_followers DOUBLE,
        hours_since_post DOUBLE, viral_coefficient DOUBLE, cross_platform_spread DOUBLE,
        toxicity_score DOUBLE, location STRING""",
}
DIMENSIONS = {
    "dim_source_dataset": """source_id INT, source_name STRING, provenance STRING, language STRING,
        license STRING, is_synthetic BOOLEAN""",
    "dim_platform": "platform_id INT, platform_name STRING, content_type STRING",
    "dim_model": "model_id INT, model_name STRING, model_version STRING, model_family STRING",
}
# Counters are BIGINT here: several corpora count in BIGINT, and narrowing would overflow.
FACTS = {
    "fact_social_post": """post_id BIGINT, source_id INT, platform_id INT, external_post_id STRING,
        text_content STRING, published_at TIMESTAMP_NTZ, likes BIGINT, comments BIGINT, shares BIGINT,
        views BIGINT""",
    "fact_post_analytics": """analytics_id BIGINT, source_id INT, external_post_id STRING,
        platform_name STRING, published_at TIMESTAMP_NTZ, followers BIGINT, topic STRING, language STRING,
        media_type STRING, num_hashtags INT, sentiment_category STRING, sentiment_positive DOUBLE,
        sentiment_negative DOUBLE, sentiment_neutral DOUBLE, likes BIGINT, shares BIGINT, comments BIGINT,
        views BIGINT, total_engagement BIGINT, engagement_rate_per_1k_followers DOUBLE,
        viral_coefficient DOUBLE, cross_platform_spread DOUBLE, toxicity_score DOUBLE""",
    "agg_platform_kpis": """platform_name STRING, post_count BIGINT, median_engagement DOUBLE,
        average_engagement DOUBLE, average_engagement_rate DOUBLE, viral_post_count BIGINT,
        average_toxicity DOUBLE""",
    "agg_daily_kpis": """activity_date DATE, post_count BIGINT, total_engagement BIGINT,
        average_viral_coefficient DOUBLE, average_toxicity DOUBLE""",
    "agg_segment_kpis": """segment_id BIGINT, dimension_name STRING, dimension_value STRING,
        post_count BIGINT, median_engagement DOUBLE, average_engagement DOUBLE,
        average_engagement_rate DOUBLE, viral_post_count BIGINT, average_toxicity DOUBLE""",
    "fact_sentiment_prediction": """prediction_id BIGINT, post_id BIGINT, model_id INT,
        sentiment_label STRING, positive_probability DOUBLE, negative_probability DOUBLE,
        neutral_probability DOUBLE, confidence DOUBLE, is_human_validated BOOLEAN""",
    "dim_post_theme": """external_post_id STRING, page_name STRING, media_type STRING, theme STRING,
        matched_keywords STRING, match_count INT, published_at TIMESTAMP_NTZ, post_likes BIGINT,
        post_shares BIGINT""",
    "fact_comment_context": """comment_id STRING, external_post_id STRING, author_pseudo STRING,
        page_name STRING, theme STRING, media_type STRING, language STRING, commented_at TIMESTAMP_NTZ,
        published_at TIMESTAMP_NTZ, reaction_delay_hours DOUBLE, comment_hour INT, is_weekend BOOLEAN,
        comment_length INT""",
    "agg_author_behavior": """author_pseudo STRING, comment_count BIGINT, segment STRING,
        distinct_posts BIGINT, distinct_themes BIGINT, distinct_pages BIGINT, median_delay_hours DOUBLE,
        avg_comment_length DOUBLE, first_seen_at TIMESTAMP_NTZ, last_seen_at TIMESTAMP_NTZ,
        active_days BIGINT""",
    "agg_theme_reaction": """theme STRING, page_name STRING, post_count BIGINT, comment_count BIGINT,
        comments_per_post DOUBLE, distinct_authors BIGINT, median_delay_hours DOUBLE,
        avg_comment_length DOUBLE, median_post_likes DOUBLE""",
}
TRACKING = {
    "model_run": """run_id BIGINT, model_id INT, source_id INT, task_type STRING, hyperparameters STRING,
        train_rows INT, test_rows INT, split_seed INT, run_at TIMESTAMP_NTZ""",
    "model_metric": "metric_id BIGINT, run_id BIGINT, metric_name STRING, metric_value DOUBLE, class_label STRING",
    "recommendation": """recommendation_id BIGINT, platform_name STRING, recommendation_type STRING,
        recommendation_text STRING, evidence STRING, score DOUBLE, generated_at TIMESTAMP_NTZ""",
    "alert": """alert_id BIGINT, platform_name STRING, alert_type STRING, alert_text STRING,
        severity STRING, evidence STRING, generated_at TIMESTAMP_NTZ""",
    "dq_checks": """check_id BIGINT, table_name STRING, check_name STRING, check_result STRING,
        rows_checked BIGINT, rows_failed BIGINT, checked_at TIMESTAMP_NTZ""",
    "pipeline_runs": """run_id BIGINT, trigger_type STRING, started_at TIMESTAMP_NTZ,
        finished_at TIMESTAMP_NTZ, status STRING, sources_processed INT, total_new_rows INT,
        total_updated_rows INT, error_message STRING""",
    "ingestion_log": """log_id BIGINT, file_hash STRING, file_name STRING, table_name STRING,
        row_count BIGINT, status STRING, loaded_at TIMESTAMP_NTZ""",
}

# Columns a corpus cannot do without, checked for NULLs.
KEY_COLUMNS = {
    "raw_sentiment140": ["tweet_id", "text"],
    "raw_twitter_fr": ["tweet_id", "text"],
    "raw_allocine": ["review_id", "text"],
    "raw_reddit": ["comment_id", "text"],
    "raw_youtube_comments": ["comment_id"],
    "raw_amazon_reviews": ["review_id", "text"],
    "raw_multi_platform_posts": ["post_id"],
    "raw_facebook_comments": ["id_commentaire", "texte"],
}

# Constant source and platform, then the corpus column per common field.
COMMON_FIELDS = ["external_post_id", "text_content", "published_at", "likes", "comments", "shares", "views"]
MAPPINGS = {
    "raw_sentiment140": (2, 2, ["tweet_id", "text", "tweet_date", None, None, None, None]),
    "raw_twitter_fr": (3, 2, ["tweet_id", "text", "tweet_date", None, None, None, None]),
    "raw_allocine": (4, 3, ["review_id", "text", "review_date", None, None, None, None]),
    "raw_reddit": (5, 4, ["comment_id", "text", "created_at", "score", None, None, None]),
    "raw_youtube_comments": (1, 1, ["comment_id", "text", "published_at", "likes", None, None, None]),
    "raw_amazon_reviews": (6, 5, ["review_id", "text", "review_date", None, None, None, None]),
    "raw_facebook_comments": (
        7, 6, ["id_commentaire", "texte", "date_commentaire", None, "nb_commentaires", "partages", "vues"],
    ),
    "raw_multi_platform_posts": (8, 9, ["post_id", None, "timestamp", "likes", "comments", "shares", "views"]),
}

# The reference rows of the three dimensions.
SOURCE_ROWS = [
    (1, "YouTube Comments Sentiment", "public_dataset", "en", "voir page Hugging Face", False),
    (2, "Sentiment140", "public_dataset", "en", "voir page Kaggle", False),
    (3, "French Twitter Sentiment", "public_dataset", "fr", "voir page Kaggle", False),
    (4, "Allociné Reviews", "public_dataset", "fr", "voir page Hugging Face", False),
    (5, "Reddit Comments", "public_dataset", "en", "voir page Hugging Face", False),
    (6, "Amazon Reviews", "public_dataset", "en", "voir page source", False),
    (7, "Facebook Comments + Publications", "public_dataset", "en", "dataset local", False),
    (8, "Multi-platform Social Sentiment Evolution", "public_dataset", "multi", "dataset local", False),
]
PLATFORM_ROWS = [
    (1, "YouTube", "vidéo"),
    (2, "Twitter/X", "texte"),
    (3, "Allociné", "texte"),
    (4, "Reddit", "texte"),
    (5, "Amazon", "texte"),
    (6, "Facebook", "mixte"),
    (7, "Instagram", "mixte"),
    (8, "LinkedIn", "texte"),
    (9, "Multi-platform", "mixte"),
]
MODEL_ROWS = [
    (1, "DummyClassifier", "1.0", "baseline"),
    (2, "LogisticRegression", "1.0", "linear"),
    (3, "RandomForestClassifier", "1.0", "tree_ensemble"),
    (4, "HistGradientBoosting", "1.0", "tree_ensemble"),
    (5, "XGBoost", "1.0", "tree_ensemble"),
    (6, "cardiffnlp/twitter-xlm-roberta-base-sentiment", "1.0", "transformer"),
    (7, "DistilCamemBERT-sentiment", "1.0", "transformer"),
    (8, "Ridge", "1.0", "linear"),
    (9, "RandomForestRegressor", "1.0", "tree_ensemble"),
    (10, "DummyRegressor", "1.0", "baseline"),
    (11, "TFIDF-LogisticRegression", "1.0", "linear"),
    (12, "TFIDF-LinearSVM", "1.0", "linear"),
]
_REFERENCE_ROWS = {
    "dim_source_dataset": SOURCE_ROWS,
    "dim_platform": PLATFORM_ROWS,
    "dim_model": MODEL_ROWS,
}


def column_types(ddl: str) -> dict[str, str]:
    """Column name to type name, in order."""
    return dict(part.split() for part in ddl.split(","))


# All columns of the versioned fact.
VERSIONED_FACT = f"{FACTS['fact_social_post']}, {SCD2_COLUMNS}"


def declared_tables() -> dict[str, StructType]:
    """Every declared table with the technical columns of its layer."""
    tables = {name: StructType.fromDDL(f"{ddl}, {STAGING_COLUMNS}") for name, ddl in STAGING.items()}
    for group in (DIMENSIONS, FACTS):
        tables.update({name: StructType.fromDDL(f"{ddl}, {SCD2_COLUMNS}") for name, ddl in group.items()})
    tables.update({name: StructType.fromDDL(ddl) for name, ddl in TRACKING.items()})
    return tables


def table_schema(name: str) -> StructType:
    tables = declared_tables()
    if name not in tables:
        raise ValueError(f"table '{name}' is not declared")
    return tables[name]


def reference_rows(spark: SparkSession, table: str) -> DataFrame:
    """The seed rows of a dimension."""
    return spark.createDataFrame(_REFERENCE_ROWS[table], StructType.fromDDL(DIMENSIONS[table]))
