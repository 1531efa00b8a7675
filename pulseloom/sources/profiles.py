"""Load profiles: per-table defaults that an explicit argument overrides."""

from __future__ import annotations

from dataclasses import dataclass

import yaml


@dataclass(frozen=True)
class LoadProfile:
    file: str | None = None
    sep: str | None = None
    column_names: list[str] | None = None
    rename_columns: dict[str, str] | None = None
    generate_id: list[str] | None = None
    #: Quoted line breaks need it; without them a large file can be split over tasks.
    multi_line: bool = True

    def override(self, **explicit) -> "LoadProfile":
        """The profile with every argument that was given put in place."""
        given = {k: v for k, v in explicit.items() if v is not None}
        return LoadProfile(**{**self.__dict__, **given})


# The corpora's file names and file columns.
PROFILES = {
    "raw_sentiment140": LoadProfile(
        file="Sentiment140.csv",
        column_names=["polarity", "tweet_id", "tweet_date", "flag", "user_handle", "text"],
    ),
    "raw_twitter_fr": LoadProfile(
        file="french_tweets.csv", rename_columns={"label": "sentiment"}, generate_id=["tweet_id"]
    ),
    "raw_youtube_comments": LoadProfile(
        file="youtube-comments-sentiment.csv",
        rename_columns={
            "CommentID": "comment_id",
            "VideoID": "video_id",
            "AuthorChannelID": "channel_id",
            "CommentText": "text",
            "Sentiment": "sentiment_category",
            "Likes": "likes",
            "PublishedAt": "published_at",
        },
    ),
    "raw_allocine": LoadProfile(file="allocine_hf_sample.csv"),
    "raw_amazon_reviews": LoadProfile(file="amazon_reviews_hf_sample.csv"),
    "raw_reddit": LoadProfile(file="reddit_hf_sample.csv"),
    "raw_facebook_comments": LoadProfile(file="dataset_facebook_joint.csv", sep=";"),
    "raw_multi_platform_posts": LoadProfile(file="multi_platform_social_sentiment_evolution.csv"),
}


def read_profiles(path: str) -> dict[str, LoadProfile]:
    """Profiles from a YAML file with a ``profiles`` map of the same fields."""
    with open(path, encoding="utf-8") as handle:
        entries = yaml.safe_load(handle)["profiles"] or {}
    return {table: LoadProfile(**entry) for table, entry in entries.items()}
