"""Parquet footers and readability of many files, found by Spark jobs.

The driver lists names only (as every Spark reader does); tasks open the footers of
their files, so a folder of a million files takes one job and no loop. What reaches the
driver is one row for each *schema class* (files with the same column names) with the
names of its files.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FOOTERS = "path string, columns array<string>, n_rows long, error string, unreached boolean"


@dataclass
class SchemaClass:
    """Files with the same column names, or (``error``) without a readable footer."""

    columns: list[str] = field(default_factory=list)
    files: list[str] = field(default_factory=list)
    error: str | None = None


def listed(spark: SparkSession, *paths: str) -> DataFrame:
    """(path) of every Parquet file in ``paths`` (files or folders). No content is read:
    only the path column of the listing is."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(list(paths))
            .select("path"))


def footers(files: DataFrame) -> DataFrame:
    """(path, columns, n_rows, error, unreached) of ``files`` (path): each footer is opened in
    a task. ``unreached`` marks files on a filesystem that the workers cannot open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        def open_footer(path: str) -> tuple:
            scheme, _, rest = path.partition(":")
            try:
                if scheme == "file" or not _:
                    where, name = pafs.LocalFileSystem(), "/" + rest.lstrip("/") if _ else path
                else:
                    where, name = pafs.FileSystem.from_uri(path.replace(scheme, {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme), 1))
            except Exception as exc:  # no client of this filesystem on the worker
                return path, None, None, f"{type(exc).__name__}: {exc}"[:300], True
            try:
                with where.open_input_file(name) as f:
                    meta = pq.ParquetFile(f).metadata
                    return path, meta.schema.to_arrow_schema().names, meta.num_rows, None, False
            except Exception as exc:  # a file that is no Parquet file is reported, not raised
                return path, None, None, f"{type(exc).__name__}: {exc}"[:300], False

        for b in batches:
            rows = [open_footer(p) for p in b.column(0).to_pylist()]
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (
                pa.string(), pa.list_(pa.string()), pa.int64(), pa.string(), pa.bool_()))],
                names=["path", "columns", "n_rows", "error", "unreached"])

    return files.select("path").mapInArrow(run, _FOOTERS)


def schema_classes(spark: SparkSession, path: str) -> list[SchemaClass]:
    """The schema classes of the Parquet files of ``path``, by one job over their footers.

    Where workers cannot open the filesystem themselves, Spark's own reader gives each
    file's columns instead, one small read a file."""
    found = (footers(listed(spark, path)).groupBy("columns", "unreached", F.when(F.col("columns").isNull(), F.col("error")).alias("error"))
             .agg(F.sort_array(F.collect_list("path")).alias("files")).collect())
    out = [SchemaClass(list(r.columns or []), list(r.files), r.error) for r in found if not r.unreached]
    by_columns: dict[tuple, SchemaClass] = {}
    for f in (f for r in found if r.unreached for f in r.files):
        try:
            columns, error = spark.read.parquet(f).columns, None
        except AnalysisException as exc:
            columns, error = [], f"{type(exc).__name__}: {exc}"[:300]
        by_columns.setdefault((*columns, error), SchemaClass(columns, [], error)).files.append(f)
    return out + list(by_columns.values())


def damaged_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(path, error) of the ``files`` (path, columns, n_rows, error, unreached; see ``footers``)
    that cannot be read whole: those without a footer, and those of whose rows not all can
    be decoded. One scan for each schema class counts the rows of every file that Spark
    reads, all columns decoded, and leaves the rest of a damaged file out."""
    out = files.where("error IS NOT NULL AND NOT unreached").select("path", "error")
    fine = files.where("error IS NULL")
    for cls in fine.groupBy("columns").agg(F.collect_list("path").alias("paths")).collect():
        read = spark.read.option("ignoreCorruptFiles", "true").parquet(*cls.paths)
        whole = F.xxhash64(*read.columns)  # every column of the row is decoded
        uri = F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B")
        counts = (read.select(F.regexp_replace(F.url_decode(uri), "^([a-z0-9]+):/+", "$1:/").alias("name"), whole.alias("whole"))
                  .groupBy("name").agg((F.count_if(F.col("whole") >= 0) + F.count_if(F.col("whole") < 0)).alias("readable")))
        own = fine.where(F.col("columns") == F.lit(cls.columns)).withColumn("name", F.regexp_replace("path", "^([a-z0-9]+):/+", "$1:/"))
        out = out.unionByName(own.join(counts, "name", "left").where(F.coalesce("readable", F.lit(0)) < F.col("n_rows")).select(
            "path", F.concat(F.lit("readable rows: "), F.coalesce("readable", F.lit(0)).cast("string"), F.lit(" of "),
                             F.col("n_rows").cast("string")).alias("error")))
    return out


__all__ = ["SchemaClass", "damaged_files", "footers", "listed", "schema_classes"]
