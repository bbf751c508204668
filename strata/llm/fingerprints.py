"""I-Match document fingerprints over randomised lexicon subsets.

The lexicon keeps the terms whose document frequency lies in a band; a document's
fingerprint is one hash of its sorted distinct lexicon terms, plus one for each of
many random subsets of the lexicon (of several densities, so that short and long
documents both have subsets that hold a few of their terms). Two fingerprints are
alike by the share of equal hashes among the subsets that hold a term of either.

Terms are white-space words, lower-cased and stripped of punctuation, hashed to
``buckets`` ids, so the lexicon is a bitmap of bounded size however many distinct
words the corpus has; frequencies are exact counts of those ids over all documents.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import bitmap, drop, in_bitmap, member, staged, text_slices

PUNCTUATION = ".,;:!?\"'()[]{}<>*_-`~/\\|"
BUCKETS = 1 << 22
#: A subset of level j holds a term with probability 2 ** -j.
LEVELS = range(2, 12)
SUBSETS_EACH = 12


def terms_of(text: str) -> set[str]:
    return {w.strip(PUNCTUATION) for w in set(text.lower().split())} - {""}


class _Ids(dict):
    """Ids of terms; the first ``room`` distinct ones are kept."""

    room = 300_000

    def __missing__(self, term: str) -> int:
        found = xxhash.xxh64_intdigest(term) % BUCKETS
        if len(self) < self.room:
            self[term] = found
        return found


_IDS = _Ids()


def term_ids(terms: set[str]) -> np.ndarray:
    """Sorted distinct ids of the terms."""
    return np.unique(np.fromiter(map(_IDS.__getitem__, terms), np.int64, len(terms)))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SEEDS = _mix(np.arange(1, SUBSETS_EACH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_MASKS = np.array([(1 << j) - 1 for j in LEVELS], np.uint64)


class Lexicon:
    """Bitmap of the ids in the band."""

    def __init__(self, bitmap: bytes):
        self.bits = np.frombuffer(bitmap, np.uint8)

    def fingerprint(self, text: str) -> str:
        """Hashes joined by '.', the whole lexicon first, '' where no term is in
        the subset. A subset's hash is the sum of its distinct terms' hashes, which
        no order or repetition of words changes. A text without lexicon terms is
        hashed over all its terms."""
        ids = term_ids(terms_of(text))
        own = ids[in_bitmap(ids, self.bits)]
        if not len(own):
            own = ids
        own = own.astype(np.uint64)
        values = _mix(own + np.uint64(1))
        draws = _mix(own[None, :] ^ _SEEDS[:, None])
        inside = ((draws[:, None, :] & _MASKS[None, :, None]) == 0).reshape(len(_SEEDS) * len(_MASKS), len(own))
        sums = np.where(inside, values, np.uint64(0)).sum(1, dtype=np.uint64) >> np.uint64(40)
        whole = int(values.sum(dtype=np.uint64) >> np.uint64(40)) if len(own) else None
        hashes = [f"{whole:06x}" if whole is not None else ""]
        hashes += [f"{x:06x}" if some else "" for x, some in zip(sums.tolist(), inside.any(1).tolist())]
        return ".".join(hashes)


def likeness(a: str, b: str) -> float:
    """Share of equal hashes among the subsets that hold a term of either text
    (1 if the fingerprints are equal)."""
    if a == b:
        return 1.0
    pairs = [(x, y) for x, y in zip(a.split("."), b.split(".")) if x or y]
    return sum(x == y for x, y in pairs) / len(pairs) if pairs else 0.0


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(id, df) over all documents, summed in the tasks first; id -1 counts the
    documents and -2 their characters."""
    schema = pa.schema([("id", pa.int64()), ("df", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n, chars = np.zeros(BUCKETS, np.int32), 0, 0
        for b in text_slices(batches):
            texts = [t or "" for t in b.column(0).to_pylist()]
            n, chars = n + len(texts), chars + sum(map(len, texts))
            ids = np.sort(np.concatenate([term_ids(terms_of(t)) for t in texts]))
            heads = np.nonzero(np.append(True, ids[1:] != ids[:-1]))[0] if len(ids) else ids
            counts[ids[heads]] += np.diff(np.append(heads, len(ids))).astype(np.int32)
        at = np.nonzero(counts)[0]
        yield pa.record_batch([pa.array(np.append(at, [-1, -2])), pa.array(np.append(counts[at], [n, chars]).astype(np.int64))],
                              schema=schema)

    return docs.select("text").mapInArrow(run, "id long, df long").groupBy("id").agg(F.sum("df").alias("df"))


def fit_lexicon(docs: DataFrame, least_df: int, most_share: float) -> tuple[Lexicon, int]:
    """Lexicon of the ids with ``least_df`` <= df <= ``most_share`` of the
    documents, and the characters of the table."""
    counts = staged(document_frequencies(docs), "document_frequencies")
    sums = {r.id: r.df for r in counts.where("id < 0").collect()}
    band = counts.where((F.col("id") >= 0) & (F.col("df") >= least_df) & (F.col("df") <= most_share * sums.get(-1, 0)))
    bits = bitmap(band.select("id"), BUCKETS)
    drop(counts)
    return Lexicon(bits), int(sums.get(-2, 0))


def in_key_order(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows (bucket, tail, order_key, h, doc_id, text) of ``docs`` (order_key, h, doc_id, text):
    every bucket holds a range of (key, hash of text), about as many rows as any other,
    and after it, with ``tail``, the first document of the next range (after the last:
    of the first), so a task that reads a bucket in order sees each document's successor.

    The ranges are Spark's range partitions of keys and hashes alone, of which the driver
    gets the first and last; rows without a key or with a repeated one are split by hash."""
    place = F.struct("order_key", "h")
    parts = (docs.select("order_key", "h").repartitionByRange(buckets, "order_key", "h").groupBy(F.spark_partition_id())
             .agg(F.min(place).alias("first"), F.max(place).alias("last")).collect())
    parts = sorted((tuple(r["first"]), tuple(r["last"])) for r in parts)
    ends = [last for _, last in parts]

    @F.pandas_udf(T.IntegerType())
    def bucket_of(keys: pd.Series, hashes: pd.Series) -> pd.Series:
        most = len(ends) - 1
        return pd.Series([min(bisect_left(ends, x), most) for x in zip(keys.tolist(), hashes.tolist())], dtype=np.int32)

    own = docs.withColumn("bucket", bucket_of("order_key", "h"))
    spark = docs.sparkSession
    before = [(first[0], first[1], (i - 1) % len(parts)) for i, (first, _) in enumerate(parts)]
    tails = spark.createDataFrame(before, "order_key long, h long, bucket int")
    some = member(tails.select(F.xxhash64("order_key", "h").alias("id")))(F.xxhash64("order_key", "h"))
    heads = docs.where(some).dropDuplicates(["order_key", "h"])  # equal keys and hashes: equal texts
    again = heads.join(tails.hint("merge"), ["order_key", "h"])
    columns = ["bucket", "tail", "order_key", "h", "doc_id", "text"]
    return own.withColumn("tail", F.lit(False)).select(*columns).unionByName(again.withColumn("tail", F.lit(True)).select(*columns))


def fingerprint_edits(docs: DataFrame, *, key: str = "doc_id", text: str = "text", least_df: int = 2,
                      most_share: float = 0.02, bucket_chars: int = 16 << 20) -> DataFrame:
    """Fingerprints of every document, of its edited text (second half replaced by
    the start of the next document in key order) and their likeness.

    NULL text is empty; a text without any term has the fingerprint of no terms;
    NULL keys come first in the order; rows with equal keys follow each other in
    order of a hash of text; a single document is its own successor; an empty table gives no
    rows; other columns are not read.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(key).cast("long").alias("doc_id"),
                      F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    lexicon, chars = fit_lexicon(own, least_df, most_share)
    shared = spark.sparkContext.broadcast(lexicon)  # a bitmap of BUCKETS bits
    keyed = own.withColumns({"order_key": F.coalesce("doc_id", F.lit(-(1 << 62))), "h": F.xxhash64("text")})
    rows = in_key_order(keyed, max(1, -(-chars // bucket_chars)))
    ordered = (rows.repartitionById(max(1, -(-chars // bucket_chars)), "bucket")
               .sortWithinPartitions("bucket", "tail", "order_key", "h"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                        ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, held, done = shared.value, None, []
        for b in text_slices(batches):
            for bucket, tail, doc, t in zip(*(b.column(i).to_pylist() for i in range(4))):
                if held and held[0] != bucket:
                    held = None
                if held and not held[1]:
                    last, last_text, last_print = held[2:]
                    half = len(last_text) // 2
                    edited = last_text[:len(last_text) - half] + t[:half]
                    nxt, edit = lex.fingerprint(t), lex.fingerprint(edited)
                    done.append((last, len(last_text), hashlib.sha256(edited.encode()).hexdigest(), last_print, edit,
                                 likeness(last_print, edit), likeness(last_print, nxt)))
                    held = (bucket, tail, doc, t, nxt)
                elif held is None:
                    held = (bucket, tail, doc, t, lex.fingerprint(t))
            if done:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
                done = []

    return ordered.select("bucket", "tail", "doc_id", "text").mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
