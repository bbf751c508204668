"""Silver → gold metric tables.

Shape rules that keep these plans cheap at scale:

* Aggregate before joining. Every per-user measure is reduced with a
  partial (map-side) aggregate before it meets the users table, so a hot key
  (a third of all posts by one owner, or all NULL-user comments) collapses
  to one row per task before the shuffle instead of landing in one join
  task.
* The aggregate's exchange is on the join key, so the following join reuses
  that partitioning; Spark broadcasts a side only when its measured size is
  under ``spark.sql.autoBroadcastJoinThreshold`` (checked by the planner and
  again by AQE at run time), otherwise it sort-merge joins.
* Where a later GROUP BY includes columns from the joined side, the
  pre-aggregated partials are re-combined after the join (sums of counts and
  sums), which is exact even when the dimension has duplicate keys.

Run time stamps (``fecha_cargue``) are parameters; ``None`` means now.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.expressions import as_timestamp


def user_post_metrics(posts: DataFrame, run_ts=None) -> DataFrame:
    """Questions, answers and all posts per non-null owner."""
    return (posts
            .where(F.col("owner_user_id").isNotNull())
            .groupBy(F.col("owner_user_id").alias("user_id"))
            .agg(F.count_if(F.col("post_type_id") == 1).alias("question_count"),
                 F.count_if(F.col("post_type_id") == 2).alias("answer_count"),
                 F.count(F.lit(1)).alias("total_posts"))
            .withColumn("fecha_cargue", as_timestamp(run_ts)))


#: Badge classes 1, 2, 3.
METALS = ("gold", "silver", "bronze")


def badges_summary(badges: DataFrame) -> DataFrame:
    """Badge counts per non-null user; ``fecha_cargue`` = newest load_date."""
    cls = F.col("badge_class")
    return (badges
            .where(F.col("user_id").isNotNull())
            .groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("total_badges"),
                 F.count_distinct("badge_name").alias("distinct_badge_types"),
                 *(F.count_if(cls == i + 1).alias(f"{metal}_badges") for i, metal in enumerate(METALS)),
                 F.max("load_date").alias("fecha_cargue")))


def _count_per(df: DataFrame, key: str, name: str) -> DataFrame:
    return (df.where(F.col(key).isNotNull())
              .groupBy(F.col(key).alias("user_id"))
              .agg(F.count(F.lit(1)).alias(name)))


def user_engagement_score(users: DataFrame, posts: DataFrame, comments: DataFrame,
                          badges: DataFrame, run_ts=None) -> DataFrame:
    """Every user with post/comment/badge counts (0 when none) and their sum."""
    return _engagement(users, _count_per(posts, "owner_user_id", "total_posts"),
                       _count_per(comments, "user_id", "total_comments"),
                       _count_per(badges, "user_id", "total_badges"), run_ts)


def user_engagement_from_parts(users: DataFrame, post_metrics: DataFrame,
                               comments_by_user: DataFrame, badge_summary: DataFrame,
                               run_ts=None) -> DataFrame:
    """The same table from per-user aggregates another gold job already
    produced: ``user_post_metrics`` (total_posts), ``comments_per_user`` (n)
    and ``badges_summary`` (total_badges). A gold run that writes those
    tables anyway then needs no further scan of posts, comments or badges."""
    return _engagement(
        users, post_metrics.select("user_id", "total_posts"),
        comments_by_user.where(F.col("user_id").isNotNull())
                        .select("user_id", F.col("n").alias("total_comments")),
        badge_summary.select("user_id", "total_badges"), run_ts)


def _engagement(users: DataFrame, p: DataFrame, c: DataFrame, b: DataFrame,
                run_ts) -> DataFrame:
    u = users.select("user_id", "display_name", "load_date")
    j = u.join(p, "user_id", "left").join(c, "user_id", "left").join(b, "user_id", "left")
    tp = F.coalesce(F.col("total_posts"), F.lit(0))
    tc = F.coalesce(F.col("total_comments"), F.lit(0))
    tb = F.coalesce(F.col("total_badges"), F.lit(0))
    return j.select(
        "user_id", "display_name", "load_date",
        tp.alias("total_posts"), tc.alias("total_comments"), tb.alias("total_badges"),
        (tp + tc + tb).alias("engagement_score"),
        as_timestamp(run_ts).alias("fecha_cargue"))


def comment_activity(comments: DataFrame) -> DataFrame:
    """Per (comment_year, comment_month): volume, distinct commenters, mean
    length and high-score count."""
    return (comments
            .groupBy("comment_year", "comment_month")
            .agg(F.count(F.lit(1)).alias("total_comments"),
                 F.count_distinct("user_id").alias("unique_users"),
                 F.avg("text_length").alias("avg_length"),
                 F.sum(F.when(F.col("score_category") == "high", 1).otherwise(0))
                  .alias("high_score_comments")))


def user_comment_engagement(comments: DataFrame, users: DataFrame) -> DataFrame:
    """Per commenter (user_id, display_name, is_active): comment count, mean
    length, newest comment. Comments without a user (NULL or unknown id)
    stay, with NULL name and flag.

    Comments are reduced per user_id first; the NULL-user group — often the
    largest — is thus one row per task before any exchange.
    """
    return user_comment_engagement_from(comments_per_user(comments), users)


def comments_per_user(comments: DataFrame) -> DataFrame:
    """Per user_id (NULL included): count, length sum/count, newest date —
    the partial aggregate both per-user comment measures are built from."""
    return (comments
            .groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum("text_length").alias("len_sum"),
                 F.count("text_length").alias("len_n"),
                 F.max("creation_date").alias("last_date")))


def user_comment_engagement_from(per_user: DataFrame, users: DataFrame) -> DataFrame:
    u = users.select("user_id", "display_name", "is_active")
    return (per_user.join(u, "user_id", "left")
            .groupBy("user_id", "display_name", "is_active")
            .agg(F.sum("n").alias("total_comments"),
                 F.try_divide(F.sum("len_sum").cast("double"), F.sum("len_n"))
                  .alias("avg_comment_length"),
                 F.max("last_date").alias("last_comment_date")))


def post_summary(posts: DataFrame) -> DataFrame:
    """Per (post_year, post_month, post_type_id): posts and distinct authors."""
    return (posts
            .groupBy("post_year", "post_month", "post_type_id")
            .agg(F.count(F.lit(1)).alias("total_posts"),
                 F.count_distinct("owner_user_id").alias("unique_authors")))


def badge_distribution(badges: DataFrame) -> DataFrame:
    """Per (badge_name, badge_year): awards and distinct holders."""
    return (badges
            .groupBy("badge_name", "badge_year")
            .agg(F.count(F.lit(1)).alias("total_awards"),
                 F.count_distinct("user_id").alias("unique_users")))

