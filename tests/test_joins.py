from pyspark.sql import functions as F

from strata.operators.joins import left_join_fact_dim, salted_join


def _skewed(spark):
    # a third of the fact rows on one key, a third with NULL key
    hot = spark.range(0, 300).select(F.lit(7).cast("long").alias("k"), F.col("id").alias("f"))
    nul = spark.range(300, 600).select(F.lit(None).cast("long").alias("k"), F.col("id").alias("f"))
    rest = spark.range(600, 900).select((F.col("id") % 50).alias("k"), F.col("id").alias("f"))
    fact = hot.unionByName(nul).unionByName(rest)
    dim = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("d"))
    return fact, dim


def _plain(fact, dim, how):
    return fact.join(dim, "k", how)


def test_salted_left_join_equals_plain(spark):
    fact, dim = _skewed(spark)
    want = sorted(map(tuple, _plain(fact, dim, "left").select("k", "f", "d").collect()), key=str)
    for hot in (None, [7], [7, 3]):
        got = left_join_fact_dim(fact, dim, "k", hot_keys=hot, hot_buckets=8)
        assert got.columns == ["k", "f", "d"]
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_salted_anti_and_inner_equal_plain(spark):
    fact, dim = _skewed(spark)
    for how in ("left_anti", "inner", "left_semi"):
        want = sorted(map(tuple, _plain(fact, dim, how).collect()), key=str)
        got = salted_join(fact, dim, "k", how, hot_keys=[7], hot_buckets=4)
        assert sorted(map(tuple, got.collect()), key=str) == want, how


def test_null_and_hot_rows_spread_over_partitions(spark):
    fact, dim = _skewed(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        j = left_join_fact_dim(fact, dim, "k", buckets=8, hot_keys=[7], hot_buckets=8)
        per_part = (j.where(F.col("k").isNull() | (F.col("k") == 7))
                    .groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert len(per_part) >= 4  # not one task
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
