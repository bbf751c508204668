"""Keyed upsert (MERGE … UPDATE SET * / INSERT *) as a DataFrame operator.

``merged = source ∪ (target ▷ source)`` — every source row is written (it
either replaces its matched target row or is new) and target rows whose key
the source does not carry are kept. Keys compare with ``=``, so NULL keys
never match: a NULL-key source row is inserted again on every run and a
NULL-key target row is always kept, as in SQL MERGE. For a target with
unique keys per non-null key (what the sink maintains) this equals MERGE
exactly.

Cost: the anti-join moves only the source *keys*; source payload columns are
not shuffled. The planner broadcasts the key set when its size is under the
broadcast threshold (then the target is filtered map-side and never
shuffled); otherwise both sides hash-partition on the keys. That size is an
estimate from file sizes and column widths, which for the keys of a wide, well
compressed table is far too low, so a source known to be large is kept
out of the driver by a hint (``large``). NULL-key
target rows cannot match and are salted across partitions, so a hot NULL
key does not pile into one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.joins import salted_join


class MergeCardinalityError(ValueError):
    """Several source rows match one target row."""


def _keys(keys: str | list[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def any_null_key(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def align_source(source: DataFrame, target_columns: list[str]) -> DataFrame:
    """Source in target column order; a missing target column is an error
    (``UPDATE SET *`` needs every column)."""
    missing = [c for c in target_columns if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    return source.select(*target_columns)


def merge_conflicts(source: DataFrame, target: DataFrame, keys: str | list[str]) -> DataFrame:
    """Keys that several source rows carry *and* that exist in the target —
    the rows MERGE rejects. Columns: the keys and ``n_source_rows``.

    The source is reduced per key with a map-side partial count before its
    exchange; only the duplicate keys (usually none) meet the target keys.
    """
    ks = _keys(keys)
    dup = (source.where(~any_null_key(ks)).groupBy(*ks)
           .agg(F.count(F.lit(1)).alias("n_source_rows"))
           .where(F.col("n_source_rows") > 1))
    return dup.join(target.select(*ks), ks, "left_semi")


def check_merge_cardinality(source: DataFrame, target: DataFrame,
                            keys: str | list[str]) -> None:
    """Raise ``MergeCardinalityError`` when a target row would be matched
    by several source rows. Reads the target keys only if the source has
    duplicate keys at all; however many there are, they are not broadcast."""
    ks = _keys(keys)
    dup = (source.where(~any_null_key(ks)).groupBy(*ks)
           .agg(F.count(F.lit(1)).alias("n_source_rows"))
           .where(F.col("n_source_rows") > 1))
    if dup.isEmpty():
        return
    bad = dup.join(target.select(*ks).hint("merge"), ks, "left_semi").limit(5).collect()
    if bad:
        raise MergeCardinalityError(
            f"several source rows match one target row for keys {ks}: "
            f"{[r.asDict() for r in bad]}")


def check_unique_keys(df: DataFrame, keys: str | list[str]) -> None:
    """Raise ``MergeCardinalityError`` when a non-NULL key occurs more than once."""
    ks = _keys(keys)
    twice = (df.where(~any_null_key(ks)).groupBy(*ks).agg(F.count(F.lit(1)).alias("n_source_rows"))
             .where(F.col("n_source_rows") > 1).limit(5).collect())
    if twice:
        raise MergeCardinalityError(f"keys {ks} occur more than once: {[r.asDict() for r in twice]}")


def unmatched_target(target: DataFrame, source: DataFrame,
                     keys: str | list[str], large: bool = False) -> DataFrame:
    """Target rows no source row matches (NULL keys never match).

    One scan of the target; NULL-key target rows are salted across the
    anti-join's partitions instead of hashing into one (``joins.salted_join``).
    The keys of a ``large`` source are never broadcast.
    """
    ks = _keys(keys)
    src_keys = source.select(*ks).where(~any_null_key(ks))
    if large:
        src_keys = src_keys.hint("merge")
    return salted_join(target, src_keys, ks, "left_anti")


def merge_upsert(target: DataFrame, source: DataFrame, keys: str | list[str],
                 null_keys: str = "insert") -> DataFrame:
    """The table after ``MERGE target USING source ON keys`` with update-all
    and insert-all. ``null_keys='reject'`` drops NULL-key source rows
    instead of inserting them again."""
    ks = _keys(keys)
    src = align_source(source, target.columns)
    if null_keys == "reject":
        src = src.where(~any_null_key(ks))
    elif null_keys != "insert":
        raise ValueError("null_keys must be 'insert' or 'reject'")
    return src.unionByName(unmatched_target(target, src, ks))
