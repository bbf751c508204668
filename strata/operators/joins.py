"""Equi-joins that keep a NULL-key hot group out of one task.

A left (or anti) join keeps left rows whose key is NULL, but those rows can
never match; in a shuffled join they all hash to one partition, and NULL is
often the largest "key" of a fact table (deleted users, anonymous rows).

The join below adds one extra join key, ``_salt``: 0 on the right side and
for non-NULL left keys (so real matches are unchanged), and a deterministic
hash bucket of the row for NULL-key left rows — those still match nothing,
but now spread over all shuffle partitions. One scan of each side, no
re-union. The salt is a hash of the row, not ``rand()``, so a recomputed map
task routes every row exactly as before (safe under executor loss). The
join strategy itself (broadcast when the planner's size check allows,
sort-merge otherwise) is left to Spark, and so are hot non-NULL keys: AQE
splits their partitions from the sizes it measured, without a limit on how
many there are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SALT = "_salt"


def _keys(keys: str | list[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def null_salt(df: DataFrame, keys: list[str], buckets: int) -> Column:
    """0 for rows with every key set, else a stable bucket in [1, buckets]."""
    return (F.when(any_null(keys), F.pmod(F.xxhash64(*df.columns), F.lit(buckets)) + 1)
            .otherwise(F.lit(0)).cast("int"))


def _buckets(spark: SparkSession, buckets: int | None) -> int:
    if buckets:
        return buckets
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def _in_hot(keys: list[str], hot: list[tuple]) -> Column:
    """TRUE for rows whose key tuple is one of the ``hot`` tuples."""
    if len(keys) == 1:
        return F.col(keys[0]).isin([h[0] for h in hot])
    return reduce(lambda a, b: a | b, [
        reduce(lambda x, y: x & y, [F.col(k) == F.lit(v) for k, v in zip(keys, h)])
        for h in hot])


def salted_join(left: DataFrame, right: DataFrame, keys: str | list[str], how: str,
                buckets: int | None = None, hot_keys: list | None = None,
                hot_buckets: int = 32) -> DataFrame:
    """``left JOIN right USING (keys)`` for ``how`` in inner / left /
    left_anti / left_semi. Output columns as for the plain USING join.

    NULL-key left rows are salted across partitions. ``hot_keys`` (known heavy
    key values, e.g. from a previous run's statistics) are split too: their
    left rows take a row-hash bucket in ``[1, hot_buckets]`` and the right
    rows of those keys — one per key in a keyed dimension — are replicated
    once per bucket, so each hot key is joined by ``hot_buckets`` tasks
    instead of one. All other keys join on salt 0, unchanged.
    """
    ks = _keys(keys)
    n = _buckets(left.sparkSession, buckets)
    salt = null_salt(left, ks, n)
    rgt = right.withColumn(SALT, F.lit(0))
    if hot_keys:
        hot = [h if isinstance(h, (tuple, list)) else (h,) for h in hot_keys]
        row_bucket = F.pmod(F.xxhash64(*left.columns), F.lit(hot_buckets)) + 1
        salt = F.when(_in_hot(ks, hot), row_bucket.cast("int")).otherwise(salt)
        # one pass over the right side: hot-key rows fan out to every bucket
        rgt = right.withColumn(SALT, F.explode(
            F.when(_in_hot(ks, hot), F.sequence(F.lit(1), F.lit(hot_buckets)))
             .otherwise(F.array(F.lit(0)))))
    lft = left.withColumn(SALT, salt)
    return lft.join(rgt, ks + [SALT], how).drop(SALT)


def left_join_fact_dim(fact: DataFrame, dim: DataFrame, keys: str | list[str],
                       buckets: int | None = None, hot_keys: list | None = None,
                       hot_buckets: int = 32) -> DataFrame:
    """``fact LEFT JOIN dim USING (keys)``: fact columns, then the
    dimension's non-key columns (NULL for unmatched rows)."""
    ks = _keys(keys)
    dim_cols = [c for c in dim.columns if c not in ks]
    return (salted_join(fact, dim, ks, "left", buckets, hot_keys, hot_buckets)
            .select(*fact.columns, *dim_cols))
