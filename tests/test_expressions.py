import datetime as dt

from pyspark.sql import functions as F

from strata.functions.expressions import is_active, non_empty_flag, score_category


def test_score_bucket(spark):
    df = spark.createDataFrame([(None,), (0,), (1,), (4,), (5,)], "s long")
    assert [r[0] for r in df.select(score_category("s")).collect()] == [
        "low", "low", "medium", "medium", "high"]


def test_empty_name_flag(spark):
    df = spark.createDataFrame([(None,), ("",), ("a",)], "n string")
    assert [r[0] for r in df.select(non_empty_flag("n")).collect()] == [False, False, True]


def test_is_active(spark):
    as_of = dt.date(2024, 1, 1)
    rows = [(None,), (as_of - dt.timedelta(days=365),), (as_of - dt.timedelta(days=366),)]
    df = spark.createDataFrame(rows, "d date").select(F.col("d").cast("timestamp_ntz").alias("d"))
    assert [r[0] for r in df.select(is_active("d", as_of)).collect()] == [None, True, False]
