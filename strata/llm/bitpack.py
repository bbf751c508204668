"""Token ids in fixed-width bit packing.

File format: Parquet rows of *blocks*, written by Spark so that commits survive
lost executors and any Hadoop store works. A block holds whole documents, about
``block_ids`` ids:

* ``shard``, ``block``: place in the order of the ids;
* ``n_ids``, ``bits``: ids in the block, bits per id (the least that holds the
  vocabulary's largest id);
* ``payload``: ids as consecutive ``bits``-wide little-endian fields;
* ``doc_ids``, ``doc_starts``: documents of the block and the place of their first
  id, so document i is found at bit ``doc_starts[i] * bits`` without reading others.

A second small table, ``shards``, holds the ids before every shard.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import text_slices
from strata.llm.tokens import encoder


def bits_for(vocabulary: int) -> int:
    """Least width that holds the ids 0 .. vocabulary - 1."""
    return max(1, int(vocabulary - 1).bit_length())


def pack_ids(ids: np.ndarray, bits: int) -> bytes:
    """Ids (each below 2**bits) as consecutive ``bits``-wide little-endian fields."""
    if bits in (8, 16, 32):  # the fields are machine integers
        return ids.astype(f"<u{bits // 8}").tobytes()
    lanes = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(lanes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_ids(payload: bytes, bits: int, start: int, n: int) -> np.ndarray:
    """Ids ``start`` .. ``start + n - 1`` of a packed block, reading only their bytes."""
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f"<u{bits // 8}", n, start * bits // 8).astype(np.uint32)
    first = start * bits
    raw = np.frombuffer(payload, np.uint8)[first // 8:-(-(first + n * bits) // 8)]
    lanes = np.unpackbits(raw, bitorder="little")[first % 8:][:n * bits].reshape(n, bits)
    return (lanes.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(1, dtype=np.uint32)


_BLOCK = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int64()), ("bits", pa.int32()),
                    ("payload", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
                    ("doc_starts", pa.list_(pa.int64()))])
_BLOCK_DDL = ("shard int, block int, n_ids long, bits int, payload binary, doc_ids array<long>, "
              "doc_starts array<long>")


def shard_edges(own: DataFrame) -> list[tuple]:
    """Last (key is set, key, hash of text) of every shard of ``own`` (doc_id, text): as many
    as the session's shuffle partitions, with about equal numbers of rows. Only keys and
    hashes are range-partitioned for it; the driver gets one row of each."""
    shards = int(own.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = own.select("doc_id", F.xxhash64("text").alias("h"))
    last = F.max(F.struct(F.col("doc_id").isNotNull().alias("set"), F.coalesce("doc_id", F.lit(0)).alias("doc"), "h"))
    parts = keys.repartitionByRange(shards, F.asc_nulls_first("doc_id"), "h").groupBy(F.spark_partition_id()).agg(last.alias("last"))
    return sorted(tuple(r["last"]) for r in parts.collect())


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, vocabulary: int, end_id: int, *,
              key: str = "doc_id", text: str = "text", block_ids: int = 1 << 16) -> None:
    """Encode whole texts and write them under ``path`` in ascending key order.

    NULL text is empty (only the end id); NULL keys come first; rows with equal keys
    keep all their ids, in order of a hash of text, and may lie in several shards; an empty
    table writes no block; other columns are not read. Texts are encoded where they are
    read; only ids, as machine integers, are moved to their shard, a range of keys.
    """
    bits, end = bits_for(vocabulary), int(end_id).to_bytes(4, "little")
    own = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    edges = shard_edges(own)
    held_as = "<u2" if bits <= 16 else "<u4"
    encoded_schema = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("h", pa.int64()), ("ids", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path, False)
        for b in text_slices(batches, 4 << 20):
            made = [np.frombuffer(x + end, "<u4").astype(held_as).tobytes() for x in enc.encode(b.column(1))]
            shard = [min(bisect_left(edges, (k is not None, k or 0, h)), len(edges) - 1)
                     for k, h in zip(b.column(0).to_pylist(), b.column(2).to_pylist())]
            yield pa.record_batch([pa.array(shard, pa.int32()), b.column(0), b.column(2), pa.array(made, pa.binary())], schema=encoded_schema)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, n = -1, 0, 0
        held: list[bytes] = []
        ids_of: list[int | None] = []
        starts: list[int] = []

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), held_as)
            return pa.record_batch([pa.array([x], t.type) for x, t in zip(
                [shard, block, n, bits, pack_ids(ids, bits), ids_of, starts], _BLOCK)], schema=_BLOCK)

        for b in batches:
            for own_shard, doc, ids in zip(*(b.column(i).to_pylist() for i in (0, 1, 3))):
                if ids_of and (n >= block_ids or own_shard != shard):
                    yield flush()
                    held, ids_of, starts, n, block = [], [], [], 0, block + 1
                shard = own_shard
                ids_of.append(doc)
                starts.append(n)
                held.append(ids)
                n += len(ids) // (2 if bits <= 16 else 4)
        if ids_of:
            yield flush()

    encoded = own.withColumn("h", F.xxhash64("text")).mapInArrow(encode, "shard int, doc_id long, h long, ids binary")
    ordered = encoded.repartitionById(max(1, len(edges)), "shard").sortWithinPartitions(F.asc_nulls_first("doc_id"), "h")
    ordered.mapInArrow(blocks, _BLOCK_DDL).write.parquet(f"{path}/blocks")
    spark = docs.sparkSession
    sums = (spark.read.schema(_BLOCK_DDL).parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_ids").alias("n_ids")))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    sums.select("shard", "n_ids", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start")) \
        .write.parquet(f"{path}/shards")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks with ``start``, the ids of all documents before the block."""
    blocks = spark.read.schema(_BLOCK_DDL).parquet(f"{path}/blocks")
    places = spark.read.schema(_BLOCK_DDL).parquet(f"{path}/blocks").select("shard", "block", "n_ids")
    shards = spark.read.schema("shard int, n_ids long, start long").parquet(f"{path}/shards")
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (places.select("shard", "block", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("inside"))
              .join(shards.select("shard", "start"), "shard")
              .select("shard", "block", (F.col("start") + F.col("inside")).alias("start")))
    return blocks.join(starts, ["shard", "block"])


def read_documents(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """Documents as read back from the files: doc_id, start, n_tokens, ids_crc32
    (and ``ids`` with ``keep_ids``)."""
    names = ["doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if keep_ids else [])]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), *([pa.list_(pa.int32())] if keep_ids else [])]
    schema = pa.schema(list(zip(names, types)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                n, bits, base = (b.column(k)[i].as_py() for k in ("n_ids", "bits", "start"))
                payload = b.column("payload")[i].as_py()
                starts = np.array(b.column("doc_starts")[i].as_py(), np.int64)
                lengths = np.diff(np.append(starts, n))
                own = [unpack_ids(payload, bits, int(s), int(k)) for s, k in zip(starts, lengths)]
                cols = [b.column("doc_ids")[i].as_py(), starts + base, lengths,
                        [zlib.crc32(x.astype("<u4").tobytes()) for x in own]]
                if keep_ids:
                    cols.append([x.astype(np.int32) for x in own])
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], schema=schema)

    ddl = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    return read_blocks(spark, path).mapInArrow(run, ddl)
