import os

import pytest

import __spark_entry__ as E

SMALL = "/root/testdata/sf0.001"

# a fast representative subset; STRATA_FULL_ORACLE=1 runs every oracle
SUBSET = ["gold_user_engagement_score", "gold_user_comment_engagement", "query_user_engagement",
          "query_posts_per_named_user_top20", "silver_comments", "silver_posts",
          "merge_upsert", "merge_upsert_composite", "join_left_fact_dim", "decode_utf8_strict",
          "normalize_columns_split_caps", "bronze_land_bounded", "overwrite_dynamic_partitions",
          "load_history", "verify_table"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "engagement_score" in df.columns


def test_registry_shape():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 90


def _names():
    return list(E.oracle_sql()) if os.environ.get("STRATA_FULL_ORACLE") else SUBSET


@pytest.mark.parametrize("name", _names())
def test_matches_oracle(spark, name):
    from tools.check_oracle import compare
    ok, msg = compare(spark, name, SMALL)
    assert ok, msg


def test_trailing_slash_in_sf_dir(spark):
    q = E.queries()
    a = q["scan_parquet_file"](spark, SMALL + "/").count()
    b = q["silver_posts"](spark, SMALL + "/").count()
    assert a == b > 0
