"""Set-similarity join on word n-grams by T-occurrence search (DivideSkip).

A document with n distinct shingles can only reach Jaccard similarity s with
documents that share at least T = ceil(s * n) of them. Its inverted lists are taken
in a global order from short to long and divided: the n - T + c shortest are merged
(a partner must occur in at least c of them), the remaining long ones are not read,
but probed by binary search for the partners that the merge returns; the search
ends as soon as the required overlap is out of reach. Two sets of sizes n and m that
must share o shingles share c of the first n - o + c and m - o + c in the order, so only
these lists count for the pair. Short lists that hold nobody else bound the overlap of a document with anyone, which keeps the copies of one
text from being paired with each other where the sum of their edits is too much. A partner may
hold such a shingle beyond its own short part only; then it has its whole short part before
that shingle, of which it shares no more than the lists that hold others.

Distributed: documents with equal sets are one class; the merge is a shuffle of the
short lists by shingle, of which a pair must share one (c = 1: further lists of a large
group of near copies would be the text that all of it has, and make its pairs by the square
of its size); the longer short part, c = 1 + n // 32, bounds the overlap; the probe runs on
the sorted sets of the pairs that passed. The order comes from counts of hashed shingles over all
documents (a table of fixed size); any order is exact, a good one keeps very common
shingles out of the short lists.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import bitmap, identified, in_bitmap, staged, text_slices, without_rows
from strata.llm.linking import compare, linked_groups

BUCKETS = 1 << 18
_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text (A-Z lower-cased words
    between ASCII white space; fewer than ``width`` words are one shingle)."""
    words = [(t or "").encode().lower().split() for t in texts]
    code = {w: i for i, w in enumerate(set().union(*words))}
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in code), np.uint64, len(code))
    line = hashes[np.fromiter((code[w] for own in words for w in own), np.int64, sum(map(len, words)))]
    m = max(0, len(line) - width + 1)
    rolled = np.zeros(m, np.uint64)
    for j in range(width):
        rolled += _mix(line[j:j + m] ^ np.uint64(_ODD[j % 5] + j // 5))
    rolled, out, at = _mix(rolled), [], 0
    for own in words:
        n = len(own)
        if n >= width:
            out.append(np.unique(rolled[at:at + n - width + 1].view(np.int64)))
        elif n:
            few = xxhash.xxh64_intdigest(b" ".join(own), seed=n)
            out.append(np.array([few], np.uint64).view(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
        at += n
    return out


def class_id(shingles: np.ndarray) -> int:
    """Hash of a whole set; documents with equal sets are one class."""
    return int(np.int64(xxhash.xxh64_intdigest(shingles.tobytes()) >> 1)) if len(shingles) else -1


def least_overlap(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def shared_least(n: int) -> int:
    """c: how many short lists of a set of n shingles a partner must be in."""
    return 1 + n // 32


def overlap_reaches(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for sorted sets: the smaller one's
    elements are probed in the larger by binary search, block by block, until the
    required overlap is reached or out of reach."""
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    need = -(-percent * (len(a) + len(b)) // (100 + percent))
    found = 0
    for i in range(0, len(a), 256):
        if found + len(a) - i < need:
            return False
        own = a[i:i + 256]
        at = np.searchsorted(b, own)
        found += int((b[np.minimum(at, len(b) - 1)] == own).sum())
        if found >= need:
            return True
    return found >= need


def _describe(docs: DataFrame, width: int) -> DataFrame:
    """Rows (doc_id, part, cid, n) of all documents, and (NULL, NULL, bucket, count) of all shingles."""
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.int64()), ("counts", pa.bool_()), ("cid", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for b in text_slices(batches):
            sets = shingle_sets(b.column(2).to_pylist(), width)
            counts += np.bincount(np.concatenate(sets) & (BUCKETS - 1), minlength=BUCKETS)
            yield pa.record_batch([b.column(0), b.column(1), pa.array([False] * len(sets)), pa.array([class_id(s) for s in sets], pa.int64()),
                                   pa.array([len(s) for s in sets], pa.int64())], schema=schema)
        at = np.nonzero(counts)[0]
        for i in range(0, len(at), 50_000):
            own = at[i:i + 50_000]
            yield pa.record_batch([pa.nulls(len(own), pa.int64()), pa.nulls(len(own), pa.int64()), pa.array([True] * len(own)), pa.array(own),
                                   pa.array(counts[own])], schema=schema)

    return docs.mapInArrow(run, "doc_id long, part long, counts boolean, cid long, n long")


def _short_lists(docs: DataFrame, width: int, percent: int, frequency) -> DataFrame:
    """(key, id, n, place): the short part of every class's lists in order, once per
    class and task."""
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("place", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, order = set(), frequency.value
        for b in text_slices(batches):
            keys, ids, sizes, places = [], [], [], []
            for s in shingle_sets(b.column(1).to_pylist(), width):
                n, cid = len(s), class_id(s)
                if not n or cid in seen:
                    continue
                seen.add(cid)
                short = min(n, n - least_overlap(n, percent) + shared_least(n))
                by = np.lexsort((s, order[s & (BUCKETS - 1)]))[:short]
                keys.append(s[by])
                ids.append(np.full(short, cid))
                sizes.append(np.full(short, n))
                places.append(np.arange(short))
            if keys:
                yield pa.record_batch([pa.array(np.concatenate(x).astype(np.int64)) for x in (keys, ids, sizes, places)],
                                      schema=schema)

    return docs.mapInArrow(run, "key long, id long, n long, place long")


def _sets(docs: DataFrame, width: int, ids: DataFrame) -> DataFrame:
    """(id, value): the set of every class, once per task, of the rows (doc_id, text) without a
    doc_id or with one that may be among ``ids`` (column id). The bitmap is read where the sets
    are made: a filter before it would keep a second Python worker for every task."""
    schema = pa.schema([("id", pa.int64()), ("value", pa.binary())])
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(ids, 1 << 25))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for b in batches:
            doc = b.column(0)
            own = pc.fill_null(doc, 0).to_numpy(zero_copy_only=False)
            yield b.filter(pa.array(in_bitmap(own, bits) | doc.is_null().to_numpy(zero_copy_only=False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for b in text_slices(asked(batches)):
            new = {class_id(s): s.tobytes() for s in shingle_sets(b.column(1).to_pylist(), width)}
            new = {k: v for k, v in new.items() if k not in seen}
            seen.update(new)
            yield pa.record_batch([pa.array(list(new), pa.int64()), pa.array(list(new.values()), pa.binary())], schema=schema)

    return docs.mapInArrow(run, "id long, value binary")


def near_groups(docs: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80,
                rounds: int = 1) -> DataFrame:
    """doc_id, n_shingles, component_id of every document.

    Documents link when 100 * shared >= percent * union over their distinct shingles of
    ``width`` words; a component is named by its smallest doc_id. NULL or empty texts have no
    shingles and link with nothing; rows with a NULL key take part without naming a
    component and have component_id NULL if alone; repeated rows give one row each; an
    empty table gives no rows; other columns are not read. Sets are compared by 64-bit
    hashes of shingles.
    """
    own = docs.select(F.col(key).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("part"), F.col(text).cast("string").alias("text"))
    named = _grouped(own, width, percent, rounds)
    names = named.where("n > 0").groupBy("_group").agg(F.min("doc_id").alias("component_id"))
    with_words = named.where("n > 0").join(names.hint("merge"), "_group").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    without = named.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return with_words.unionByName(without)


def _grouped(own: DataFrame, width: int, percent: int, rounds: int) -> DataFrame:
    """(doc_id, part, cid, n, _group) of every row (columns doc_id, part, text); _group is NULL
    without shingles."""
    spark, described = own.sparkSession, staged(_describe(own, width), "jaccard_docs")
    own = own.select("doc_id", "text")
    counts = described.where("counts").groupBy("cid").agg(F.sum("n").alias("n")).toPandas()  # at most BUCKETS rows
    order = np.zeros(BUCKETS, np.int64)
    order[counts["cid"].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
    frequency = spark.sparkContext.broadcast(order)  # BUCKETS numbers
    members = described.where("not counts")

    in_list = F.count("*").over(Window.partitionBy("key"))
    lists = (_short_lists(own, width, percent, frequency).repartition("key").dropDuplicates(["key", "id"])
             .withColumn("_many", in_list).where("_many > 1").drop("_many"))
    lists = staged(lists, "jaccard_lists")
    def merged(n: Column) -> Column:
        """Short lists of a set of n shingles."""
        return F.least(n, n - F.floor((n * percent + 99) / 100) + 1 + F.floor(n / 32))

    smallest = F.floor((F.col("n") * percent + 99) / 100)  # a partner has at least as many shingles
    hopeful = (lists.groupBy("id", "n").agg(F.count("*").alias("hits"))
               .withColumn("own", merged(F.col("n")) - F.col("hits"))  # lists with nobody else in a short part
               .where(F.col("hits") >= 1 + F.floor(smallest / 32)))
    hopeful = staged(hopeful.select("id", "own"), "jaccard_hopeful")
    counted = lists.where(F.col("place") < F.col("n") - smallest + 1)  # those any pair may share first
    postings = staged(counted.join(hopeful.hint("merge"), "id"), "jaccard_postings")

    def needed(a: str, b: str) -> Column:
        """Shared shingles that the two sizes ask for."""
        return F.floor(((F.col(f"{a}_n") + F.col(f"{b}_n")) * percent + 99 + percent) / (100 + percent))

    def admissible(a: str, b: str) -> Column:
        """Can the sizes, less the lists with nobody else, reach the overlap, and does the
        shared list come early enough in both orders? Of n shingles at most n - own are
        shared, or, if the partner holds one of these lists beyond its short part, all of its
        long part and short(n) - own of its short part."""
        n, m = F.col(f"{a}_n"), F.col(f"{b}_n")
        long_a, long_b = n - merged(n), m - merged(m)
        most_a = n - F.col(f"{a}_own") + F.greatest(F.lit(0), long_b - long_a)
        most_b = m - F.col(f"{b}_own") + F.greatest(F.lit(0), long_a - long_b)
        early = (F.col(f"{a}_place") <= n - needed(a, b)) & (F.col(f"{b}_place") <= m - needed(a, b))
        return early & (F.least(most_a, most_b) >= needed(a, b))

    reps = members.join(hopeful.hint("merge"), members.cid == hopeful.id, "left_semi").groupBy("cid").agg(F.min("doc_id").alias("id"))
    sets = staged(_sets(own, width, reps.where("id is not null").select("id")), "jaccard_sets")

    def linked(a: list[pa.Scalar], b: list[pa.Scalar]) -> list[bool]:
        return [overlap_reaches(np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64), percent) for x, y in zip(a, b)]

    groups = linked_groups(
        postings, lambda pairs: compare(pairs, sets, "a long, b long", linked), extras=["n", "own"],
        places=["place"], admissible=admissible, central=["own"], rounds=rounds)
    named = members.join(groups.hint("merge"), members.cid == groups.id, "left").select(
        "doc_id", "part", "cid", "n", F.coalesce("component", "cid").alias("_group"))
    return named.withColumn("_group", F.when(F.col("n") > 0, F.col("_group")))


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80,
             rounds: int = 1) -> DataFrame:
    """``docs`` with all their columns: one document of each group stays, the one
    with the smallest key (NULL keys last; of several texts under one key the first by
    hash). Rows are one document only if key and text are equal; every row without a key
    is one of its own; documents without words stay."""
    rows = identified(docs, key, text)
    own = rows.select(F.col("_doc").alias("doc_id"), F.col("_part").alias("part"), F.col(text).cast("string").alias("text"))
    named = staged(_grouped(own, width, percent, rounds).where("n > 0").select("doc_id", "part", "_group"), "near_named")
    first = named.groupBy("_group").agg(F.min(F.struct("doc_id", "part")).alias("first"))
    copies = named.join(first.hint("merge"), "_group").where(F.struct("doc_id", "part") != F.col("first"))
    return without_rows(rows, staged(copies.select(F.col("doc_id").alias("_doc"), F.col("part").alias("_part")), "near_copies"))
