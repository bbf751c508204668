from pyspark.sql import functions as F

from strata.operators import gold, silver
from strata.operators.silver import COMMENTS_SCHEMA, union_sources


def test_empty_comments_frame(spark):
    df = silver.empty_comments(spark)
    assert df.count() == 0
    assert len(df.columns) == 14 and df.schema == COMMENTS_SCHEMA


def test_union_sources_skips_failures_and_falls_back(spark):
    def bad():
        raise FileNotFoundError("missing")

    df, outcomes = union_sources([("a", bad), ("b", bad)], lambda: silver.empty_comments(spark))
    assert df.count() == 0 and [o.ok for o in outcomes] == [False, False]
    ok = spark.range(3)
    df, outcomes = union_sources([("a", bad), ("b", lambda: ok), ("c", lambda: ok)])
    assert df.count() == 6 and [o.ok for o in outcomes] == [False, True, True]


def test_comments_year_literal_and_derivations(spark):
    b = spark.createDataFrame(
        [(1, 10, 7, bytearray(b"hi"), "2020-03-04 05:06:07", 3, bytearray(b"")),
         (2, 10, None, None, "not a date", None, None)],
        "id long, post_id long, score long, text binary, creation_date string, user_id long, "
        "user_display_name binary")
    out = silver.comments_to_silver(b, year=2021, load_ts="2024-01-01 00:00:00").orderBy("comment_id")
    r = out.collect()
    assert [c for c in out.columns] == [f.name for f in COMMENTS_SCHEMA.fields]
    assert (r[0].comment_year, r[0].comment_month, r[0].comment_day) == (2021, 3, 4)
    assert (r[0].score_category, r[0].text_length, r[0].has_user_display_name) == (
        "high", 2, False)
    # unparsable date → NULL parts (no ANSI error); NULL text kept in 'valid' mode
    assert (r[1].comment_month, r[1].text_length, r[1].score_category) == (None, 0, "low")
    ref = silver.comments_to_silver(b, year=2021, decoded_only="reference")
    assert ref.count() == 1  # NULL text dropped, as the original job did


def test_group_keys_present(spark):
    posts = spark.createDataFrame([(1, 1, 5), (2, 2, 5), (3, 1, None)],
                                  "post_id long, post_type_id int, owner_user_id long")
    m = gold.user_post_metrics(posts, run_ts="2024-01-01 00:00:00")
    assert m.columns[:4] == ["user_id", "question_count", "answer_count", "total_posts"]
    assert [(r.user_id, r.question_count, r.answer_count) for r in m.collect()] == [(5, 1, 1)]


def test_user_comment_engagement_exact_with_duplicate_users(spark):
    comments = spark.createDataFrame(
        [(1, 4, "2020-01-01"), (1, 6, "2020-02-01"), (None, 3, "2020-01-05"), (9, 1, "2020-01-01")],
        "user_id long, text_length int, creation_date string").withColumn(
        "creation_date", F.col("creation_date").cast("timestamp_ntz"))
    users = spark.createDataFrame([(1, "a", True), (1, "a", True), (2, "b", False)],
                                  "user_id long, display_name string, is_active boolean")
    got = gold.user_comment_engagement(comments, users)
    naive = (comments.join(users, "user_id", "left")
             .groupBy("user_id", "display_name", "is_active")
             .agg(F.count(F.lit(1)).alias("total_comments"),
                  F.avg("text_length").alias("avg_comment_length"),
                  F.max("creation_date").alias("last_comment_date")))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, naive.collect()),
                                                                 key=str)
