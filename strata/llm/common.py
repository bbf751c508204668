"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.sources import fs


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: later jobs
    neither recompute it nor depend on the executors that made it."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._strata_path = path
    return out


def drop(df: DataFrame) -> None:
    """Remove a staged table that no later plan reads."""
    path = getattr(df, "_strata_path", None)
    if path:
        fs.delete(df.sparkSession, path)


def id_remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus`` (NULL keys count as '')."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def text_slices(batches: Iterator[pa.RecordBatch], max_bytes: int = 2 << 20,
                column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows with about ``max_bytes`` of text, so a
    task holds a bounded number of documents as Python objects (one document is
    never cut)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
        begin, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > max_bytes:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += int(size)
        yield batch.slice(begin)
        del batch, col, sizes
        pa.default_memory_pool().release_unused()


def member(ids: DataFrame, bits: int = 1 << 25):
    """Column function: may the id be among ``ids`` (column id)? Never false for one
    that is. What is broadcast is a bitmap of ``bits`` bits, however many ids there are."""
    shared = ids.sparkSession.sparkContext.broadcast(bitmap(ids, bits))

    @F.arrow_udf("boolean")  # no pandas in the workers: some 40 MB of each
    def maybe(column: pa.Array) -> pa.Array:
        return pa.array(in_bitmap(column.to_numpy(zero_copy_only=False), np.frombuffer(shared.value, np.uint8)), pa.bool_())

    return maybe


NO_KEY = -(1 << 63)  # stands for a NULL key


def keyed(column: Column) -> Column:
    return F.coalesce(column.cast("long"), F.lit(NO_KEY))


def without(docs: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """``docs`` less the rows whose key is in ``gone`` (column id, see ``keyed``). Only rows
    that may be there are moved; the others stay where they were read."""
    there = member(gone)(keyed(F.col(key)))
    ids = gone.select(F.col("id").alias("_gone_key")).distinct().hint("merge")
    moved = docs.where(there).join(ids, keyed(F.col(key)) == F.col("_gone_key"), "left_anti")
    return docs.where(~there).unionByName(moved)


def identified(docs: DataFrame, key: str, text: str, numbered: bool = True) -> DataFrame:
    """``docs`` with what tells their rows apart: _doc, the key (NULL keys last), and _part,
    a hash of the text, so rows are one only if key and text are equal. With ``numbered``
    the rows without a key are staged and _part is their number, so none is another's."""
    doc, part = F.coalesce(F.col(key).cast("long"), F.lit((1 << 63) - 1)), F.xxhash64(F.col(text).cast("string"))
    if not numbered:
        return docs.withColumns({"_doc": doc, "_part": part})
    no_key = F.col(key).cast("long").isNull()
    keyless = staged(docs.where(no_key).withColumns({"_doc": doc, "_part": F.monotonically_increasing_id()}), "keyless")
    return docs.where(~no_key).withColumns({"_doc": doc, "_part": part}).unionByName(keyless)


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` (see ``identified``) less the rows in ``gone`` (_doc, _part). Only rows that may
    be there are moved."""
    there = member(gone.select(F.col("_doc").alias("id")))("_doc")
    moved = docs.where(there).join(gone.distinct().hint("merge"), ["_doc", "_part"], "left_anti")
    return docs.where(~there).unionByName(moved).drop("_doc", "_part")


def importable(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it, if
    it was put on the driver's ``sys.path`` only (installed packages and
    ``--py-files`` need nothing), and bound the bytes of a batch that they are sent where
    the session sets no bound (one row may still be larger)."""
    if spark.conf.get(BATCH_BYTES, None) in (None, "67108864b"):  # Spark's default
        spark.conf.set(BATCH_BYTES, str(8 << 20))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def bitmap(ids: DataFrame, bits: int) -> bytes:
    """Bitmap of ``bits`` bits with those of ``id`` modulo ``bits`` set (column id).
    Tasks make its pieces; only the bitmap reaches the driver, however many ids
    there are."""
    piece = min(bits, 1 << 15)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for b in batches:
            at, own = b.column(0).to_numpy(), b.column(1).to_numpy()
            for p in np.unique(at).tolist():
                here = own[at == p]
                np.bitwise_or.at(made.setdefault(p, np.zeros(piece // 8, np.uint8)), here >> 3, (1 << (here & 7)).astype(np.uint8))
        yield pa.record_batch([pa.array(list(made), pa.int64()), pa.array([x.tobytes() for x in made.values()], pa.binary())],
                              names=["piece", "bits"])

    slot = F.pmod(F.col("id"), F.lit(bits))
    slots = ids.select((slot / piece).cast("long").alias("piece"), (slot % piece).alias("at")).distinct()
    whole = bytearray(bits // 8)
    for r in slots.repartition("piece").mapInArrow(run, "piece long, bits binary").collect():
        whole[r.piece * piece // 8:(r.piece + 1) * piece // 8] = r.bits
    return bytes(whole)


def in_bitmap(ids: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which ids may be in the bitmap (uint8 view)."""
    slot = ids % (8 * len(bits))
    return (bits[slot >> 3] >> (slot & 7)) & 1 == 1
