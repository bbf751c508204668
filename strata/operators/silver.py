"""Bronze → silver transforms.

Each transform is a single projection of native expressions (plus one
filter for comments), so a silver job is scan → Project → Filter inside one
whole-stage-codegen span with no shuffle. Inputs are bronze frames whose
column names are already normalised (``functions.columns``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.decode import decode_text_columns, decoded_filter
from strata.functions.expressions import (
    age_days, as_timestamp, is_active, non_empty_flag, score_category,
    text_length, timestamp_col,
)

COMMENTS_SCHEMA = T.StructType([
    T.StructField("comment_id", T.LongType()),
    T.StructField("post_id", T.LongType()),
    T.StructField("score", T.LongType()),
    T.StructField("comment_text", T.StringType()),
    T.StructField("creation_date", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("user_display_name", T.StringType()),
    T.StructField("score_category", T.StringType()),
    T.StructField("text_length", T.IntegerType()),
    T.StructField("comment_year", T.IntegerType()),
    T.StructField("comment_month", T.IntegerType()),
    T.StructField("comment_day", T.IntegerType()),
    T.StructField("has_user_display_name", T.BooleanType()),
    T.StructField("load_date", T.TimestampNTZType()),
])

BADGES_COLUMNS = ["badge_id", "user_id", "badge_name", "award_date", "badge_class",
                  "is_tag_based", "badge_year", "badge_month", "load_date"]

USERS_COLUMNS = ["user_id", "reputation", "creation_date", "display_name",
                 "last_access_date", "about_me", "views", "up_votes", "down_votes",
                 "website_url", "location", "account_id", "user_age_days", "is_active",
                 "load_date"]

POSTS_BRONZE_COLUMNS = [
    "id", "post_type_id", "accepted_answer_id", "creation_date", "score", "view_count",
    "body", "owner_user_id", "owner_display_name", "last_editor_user_id",
    "last_editor_display_name", "last_edit_date", "last_activity_date", "title", "tags",
    "answer_count", "comment_count", "favorite_count", "content_license", "parent_id",
    "community_owned_date", "closed_date",
]
POSTS_COLUMNS = ["post_id"] + POSTS_BRONZE_COLUMNS[1:] + [
    "post_year", "post_month", "post_day", "load_date"]

# Binary text columns decoded per dataset.
TEXT_COLUMNS = {
    "comments": ["text", "user_display_name"],
    "badges": ["name"],
    "users": ["display_name", "about_me", "website_url", "location"],
    "posts": ["body", "title", "tags", "owner_display_name",
              "last_editor_display_name", "content_license"],
}


def _year_column(df: DataFrame, year, ts: Column) -> Column:
    """Source year: a literal for per-year sources, a column (e.g. a
    discovered ``year=`` partition) or, when not given, the year of ``ts``."""
    if year is None:
        return F.year(ts)
    if isinstance(year, Column):
        return year.cast("int")
    if isinstance(year, str) and year in df.columns:
        return F.col(year).cast("int")
    return F.lit(int(year))


def comments_to_silver(df: DataFrame, year=None, load_ts=None, errors: str = "strict",
                       decoded_only: str = "valid") -> DataFrame:
    """14-column silver comments.

    ``errors``: ``strict`` (notebook job) or ``ignore`` (scheduled job).
    ``decoded_only``: see ``functions.decode.decoded_filter``; the scheduled
    job corresponds to ``errors='ignore', decoded_only='none'``.
    """
    if errors == "strict":
        df = df.where(decoded_filter(df, "text", decoded_only))
    d = decode_text_columns(df, TEXT_COLUMNS["comments"], errors)
    ts = timestamp_col(d, "creation_date")
    return d.select(
        F.col("id").cast("long").alias("comment_id"),
        F.col("post_id").cast("long"),
        F.col("score").cast("long"),
        F.col("text").alias("comment_text"),
        F.col("creation_date"),
        F.col("user_id").cast("long"),
        F.col("user_display_name"),
        score_category("score").alias("score_category"),
        text_length("text").alias("text_length"),
        _year_column(d, year, ts).alias("comment_year"),
        F.month(ts).alias("comment_month"),
        F.dayofmonth(ts).alias("comment_day"),
        non_empty_flag("user_display_name").alias("has_user_display_name"),
        as_timestamp(load_ts).alias("load_date"),
    )


def badges_to_silver(df: DataFrame, load_ts=None, errors: str = "strict") -> DataFrame:
    d = decode_text_columns(df, TEXT_COLUMNS["badges"], errors)
    ts = timestamp_col(d, "date")
    return d.select(
        F.col("id").alias("badge_id"),
        F.col("user_id"),
        F.col("name").alias("badge_name"),
        F.col("date").alias("award_date"),
        F.col("class").alias("badge_class"),
        F.col("tag_based").alias("is_tag_based"),
        F.year(ts).alias("badge_year"),
        F.month(ts).alias("badge_month"),
        as_timestamp(load_ts).alias("load_date"),
    )


def users_to_silver(df: DataFrame, load_ts=None, as_of=None, errors: str = "strict") -> DataFrame:
    """``as_of`` is the run date for age/activity (default ``current_date()``)."""
    d = decode_text_columns(df, TEXT_COLUMNS["users"], errors)
    created = timestamp_col(d, "creation_date")
    accessed = timestamp_col(d, "last_access_date")
    return d.select(
        F.col("id").alias("user_id"),
        "reputation", "creation_date", "display_name", "last_access_date", "about_me",
        "views", "up_votes", "down_votes", "website_url", "location", "account_id",
        age_days(created, as_of).alias("user_age_days"),
        is_active(accessed, as_of).alias("is_active"),
        as_timestamp(load_ts).alias("load_date"),
    )


def posts_to_silver(df: DataFrame, year=None, load_ts=None, errors: str = "strict") -> DataFrame:
    d = decode_text_columns(df, TEXT_COLUMNS["posts"], errors)
    ts = timestamp_col(d, "creation_date")
    return d.select(
        F.col("id").alias("post_id"),
        *POSTS_BRONZE_COLUMNS[1:],
        _year_column(d, year, ts).alias("post_year"),
        F.month(ts).alias("post_month"),
        F.dayofmonth(ts).alias("post_day"),
        as_timestamp(load_ts).alias("load_date"),
    )


def empty_comments(spark: SparkSession) -> DataFrame:
    """Zero-row silver comments frame with the declared 14-column schema."""
    return spark.createDataFrame([], COMMENTS_SCHEMA)


@dataclass
class SourceOutcome:
    name: str
    ok: bool
    error: str | None = None


def union_sources(sources: Iterable[tuple[str, Callable[[], DataFrame]]],
                  empty: Callable[[], DataFrame] | None = None
                  ) -> tuple[DataFrame | None, list[SourceOutcome]]:
    """Union the frames of several sources by column name, keeping duplicates.

    A source whose reader raises (missing path, failed contract, no sound file) is skipped
    and reported; when every source fails the ``empty`` frame is returned. Only plans
    are built.
    """
    frames: list[DataFrame] = []
    outcomes: list[SourceOutcome] = []
    for name, make in sources:
        try:
            frames.append(make())
            outcomes.append(SourceOutcome(name, True))
        except Exception as exc:  # a failing source must not stop the others
            outcomes.append(SourceOutcome(name, False, f"{type(exc).__name__}: {exc}"))
    if not frames:
        return (empty() if empty else None), outcomes
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out, outcomes
