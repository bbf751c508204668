"""Partitioned Parquet writes, with and without an exchange before them.

Into few partitions every task writes its own rows, one file for each partition it has
rows of, so nothing is shuffled or sorted and the number of files grows with the data as
the tasks do. Into many partitions the rows are brought together by partition first (AQE
splits large partitions and merges small ones), so they are not cut into tiny files.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Fixed value: most partitions that tasks write without an exchange. Below 32 the open
#: cost (4 MB a file) that Spark counts per 128 MB split keeps the files of a table that is
#: rewritten again and again from multiplying.
FEW = 24
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def few_partitions(df: DataFrame, parts: list[str]) -> bool:
    """Are the rows in at most FEW partitions? Only the partition columns are read."""
    return df.select(*parts).distinct().limit(FEW + 1).count() <= FEW


@contextmanager
def _open_writers(spark: SparkSession) -> Iterator[None]:
    """A task keeps a file open for each of its partitions instead of sorting its rows."""
    before = spark.conf.get(WRITERS, None)
    spark.conf.set(WRITERS, str(FEW))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(WRITERS)
        else:
            spark.conf.set(WRITERS, before)


def write_partitioned(df: DataFrame, path: str, parts: list[str], few: bool, mode: str = "overwrite",
                      obs: Observation | None = None, **options: str) -> None:
    """Write ``df`` under ``path`` in ``parts``; ``obs`` counts its rows (``rows``)."""
    if not few:
        df = df.hint("rebalance", *parts)
    if obs is not None:
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = df.write.mode(mode).options(**options).partitionBy(*parts)
    if few:
        with _open_writers(df.sparkSession):
            w.parquet(path)
    else:
        w.parquet(path)
