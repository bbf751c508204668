"""Language-model scoring by prediction by partial matching (PPM).

The model is a byte-context trie with contexts of 0 to ``order`` bytes, escape
estimation C (an escape counts as often as the context has distinct successors)
and symbol exclusion: after an escape the symbols of the longer context take no
part in the shorter one. A document is coded as its bytes (A-Z lower-cased) and an
end symbol; the bytes before its start are a start symbol. The model is pretrained
on the training documents and its code length is a probability over all texts.

Distribution. A byte's probability depends on the ``order`` bytes before it and
itself only: a *gram*, packed into 64 bits. Documents are dealt into bundles of
bounded size; every bundle asks once for each distinct gram it holds:

1. bundle -> its distinct grams with their counts in training documents;
2. grams meet by their last two context bytes, so a task has every longer context
   below them and computes the trie's counts, shadows and log-probabilities (orders
   0 and 1 have at most 258 * 257 counts and are broadcast);
3. grams go back to the bundles that asked; documents are scored by lookup.

Nothing but orders 0 and 1 is broadcast, so the trie grows with the corpus. The
word unigram baseline asks for its counts the same way.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import id_remainder, staged, text_slices

END, START, BITS = 256, 257, 9
SYMBOLS = 257  # bytes and the end
END_WORD = -1  # key of the word baseline's end token; words have 63-bit keys


def grams_of(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of all positions (bytes and end) of the texts, and where each text begins."""
    lengths = np.array([len(t) for t in texts], np.int64)
    room = lengths + order + 1
    first = np.cumsum(room) - room
    line = np.full(int(room.sum()) if len(texts) else 0, START, np.int64)
    for at, t in zip(first + order, texts):
        line[at:at + len(t)] = np.frombuffer(t, np.uint8)
        line[at + len(t)] = END
    key = np.zeros(max(0, len(line) - order), np.int64)
    for j in range(order + 1):
        key = (key << BITS) | line[j:len(line) - order + j]
    key = key[(key & ((1 << BITS) - 1)) != START] if len(texts) else key
    return key, np.cumsum(lengths + 1) - (lengths + 1)


def word_key(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) >> 1


def low(grams: np.ndarray, k: int) -> np.ndarray:
    """Order-k gram of longer ones."""
    return grams & ((1 << BITS * (k + 1)) - 1)


# ---- trie arithmetic on sorted arrays ------------------------------------

class Level:
    """Counts of the order-k grams; contexts with totals and distinct successors."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.grams, at = np.unique(grams, return_inverse=True)
        self.counts = np.bincount(at, counts, len(self.grams))
        self.contexts, at = np.unique(self.grams >> BITS, return_inverse=True)
        self.context_of = at
        self.totals = np.bincount(at, self.counts, len(self.contexts))
        self.kinds = np.bincount(at, self.counts > 0, len(self.contexts))

    def find(self, grams: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.grams, grams)


class Shallow:
    """Orders 0 and 1 as dense tables (at most 258 * 257 counts)."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.one = np.zeros((START + 1, SYMBOLS))
        self.one[grams >> BITS, grams & ((1 << BITS) - 1)] = counts
        self.zero = self.one.sum(0)
        self.totals, self.kinds = self.one.sum(1), (self.one > 0).sum(1)
        unseen = SYMBOLS - (self.zero > 0).sum()
        room = self.zero.sum() - ((self.one > 0) * self.zero).sum(1)
        kinds = (self.zero > 0).sum() - self.kinds
        escape = _escape(room, kinds)[:, None] - np.log10(max(unseen, 1))
        self.below_one = np.where(self.zero > 0, _log(self.zero[None, :], (room + kinds)[:, None]), escape)


def _log(n: np.ndarray, of: np.ndarray) -> np.ndarray:
    n, of = np.broadcast_arrays(n, of)
    return np.log10(np.where((n > 0) & (of > 0), n, 1.0) / np.where((n > 0) & (of > 0), of, 1.0))


def _escape(total: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """log10 of the escape probability; 0 where the context offers nothing."""
    return _log(kinds, total + kinds)


def log_probabilities(grams: np.ndarray, counts: np.ndarray, order: int, shallow: Shallow) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct order-``order`` grams and the log10 probability of their last
    symbol. ``grams`` must hold every gram that shares their last two context bytes."""
    levels = {order: Level(grams, counts)}
    for k in range(order - 1, 1, -1):
        levels[k] = Level(low(levels[k + 1].grams, k), levels[k + 1].counts)
    below = None  # log-probability in orders < k of the order-k grams, given the exclusions of order k
    for k in range(2, order + 1):
        own = levels[k]
        if k == 2:
            context, symbol = (low(own.grams, 1) >> BITS), own.grams & ((1 << BITS) - 1)
            lesser, total, kinds = shallow.one[context, symbol], shallow.totals[context], shallow.kinds[context]
            deeper = shallow.below_one[context, symbol]
        else:
            at = levels[k - 1].find(low(own.grams, k - 1))
            up = levels[k - 1].context_of[at]
            lesser, total, kinds = levels[k - 1].counts[at], levels[k - 1].totals[up], levels[k - 1].kinds[up]
            deeper = below[at]
        hidden = np.bincount(own.context_of, np.where(own.counts > 0, lesser, 0), len(own.contexts))[own.context_of]
        total, kinds = total - hidden, kinds - own.kinds[own.context_of]
        below = np.where(lesser > 0, _log(lesser, total + kinds), _escape(total, kinds) + deeper)
    top = levels[order]
    total, kinds = top.totals[top.context_of], top.kinds[top.context_of]
    return top.grams, np.where(top.counts > 0, _log(top.counts, total + kinds), _escape(total, kinds) + below)


# ---- Spark ------------------------------------------------------------------

GRAMS, WORDS, PAIRS, DOCS = 0, 1, 2, 3  # what a row between stages is about
_ASK = pa.schema([("bundle", pa.int32()), ("part", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()), ("n", pa.binary())])
_ASK_DDL = "bundle int, part int, kind int, keys binary, n binary"


def _pack(x: np.ndarray, rising: bool = False) -> bytes:
    """Compressed little-endian column; rising integers as their differences."""
    x = np.diff(x, prepend=x.dtype.type(0)) if rising else x
    lanes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes()
    return len(x).to_bytes(4, "little") + pa.compress(lanes, codec="zstd", asbytes=True)


def _unpack(blob: bytes, dtype: type, rising: bool = False) -> np.ndarray:
    n, width = int.from_bytes(blob[:4], "little"), np.dtype(dtype).itemsize
    lanes = pa.decompress(blob[4:], decompressed_size=n * width, codec="zstd", asbytes=True) if n else b""
    x = np.frombuffer(lanes, np.uint8).reshape(width, n).T.copy().view(dtype).reshape(n)
    return np.cumsum(x) if rising else x


def _sum_by_key(keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, back = np.unique(np.concatenate(keys), return_inverse=True)
    return every, np.bincount(back, np.concatenate(n), len(every)).astype(np.int64)


def _part_of(keys: np.ndarray, kind: int, parts: int) -> np.ndarray:
    """Grams are dealt by their last two context bytes, words by their key."""
    at = (keys >> BITS) & ((1 << 2 * BITS) - 1) if kind == GRAMS else keys
    return ((at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % parts


def _bundles_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of rows that belong to one bundle (rows come sorted by bundle)."""
    for b in batches:
        ids = b.column(0).to_numpy()
        cuts = [0, *(np.nonzero(np.diff(ids))[0] + 1).tolist(), len(ids)]
        for i, j in zip(cuts, cuts[1:]):
            if j > i:
                yield b.slice(i, j - i)


def asked(bundled: DataFrame, order: int, parts: int) -> DataFrame:
    """The distinct grams and words of every bundle with their occurrences in its
    training documents, one row per bundle, kind and part; and its order-1 counts."""

    def rows(bundle: int, kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        to = _part_of(keys, kind, parts) if kind != PAIRS else np.zeros(len(keys), np.int64)
        by = np.argsort(to, kind="stable")  # keys stay rising within a part
        keys, n, to = keys[by], n[by], to[by]
        cuts = [0, *(np.nonzero(np.diff(to))[0] + 1).tolist(), len(to)]
        spans = [(i, j) for i, j in zip(cuts, cuts[1:]) if j > i]
        return pa.record_batch([pa.array([bundle] * len(spans), pa.int32()), pa.array([int(to[i]) for i, _ in spans], pa.int32()),
                                pa.array([kind] * len(spans), pa.int32()), pa.array([_pack(keys[i:j], True) for i, j in spans], pa.binary()),
                                pa.array([_pack(n[i:j].astype(np.int32)) for i, j in spans], pa.binary())], schema=_ASK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, keys, n, words = None, [], [], Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            grams, count = _sum_by_key(keys, n)
            yield rows(bundle, GRAMS, grams, count)
            yield rows(bundle, PAIRS, *_sum_by_key([low(grams, 1)], [count]))
            yield rows(bundle, WORDS, *_sum_by_key([np.fromiter(words.keys(), np.int64, len(words))],
                                                   [np.fromiter(words.values(), np.int64, len(words))]))

        for b in text_slices(_bundles_in(batches)):
            if bundle is not None and b.column(0)[0].as_py() != bundle:
                yield from flush()
                keys, n, words = [], [], Counter()
            bundle = b.column(0)[0].as_py()
            held = b.column(1).to_pylist()
            texts = [(t or "").encode().lower() for t in b.column(3).to_pylist()]
            for training in (True, False):
                some = [t for t, h in zip(texts, held) if h != training]
                if not some:
                    continue
                own, count = np.unique(grams_of(some, order)[0], return_counts=True)
                keys.append(own)
                n.append(count if training else np.zeros(len(own), np.int64))
                for w, c in Counter(w for t in some for w in t.split()).items():
                    words[word_key(w)] += c if training else 0
                words[END_WORD] += len(some) if training else 0
            if len(keys) > 4:
                keys, n = ([x] for x in _sum_by_key(keys, n))
        if bundle is not None:
            yield from flush()

    return bundled.mapInArrow(run, _ASK_DDL)


def totals(asks: DataFrame, kind: int) -> DataFrame:
    """(key, n) over all bundles: order-1 counts, or (-, tokens) and (-, distinct) of words."""
    schema = pa.schema([("key", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, at = [], [], []
        for b in batches:
            for part, k, c in zip(b.column(1).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist()):
                keys.append(_unpack(k, np.int64, True))
                n.append(_unpack(c, np.int32).astype(np.int64))
            if len(keys) > 64:
                keys, n = ([x] for x in _sum_by_key(keys, n))
        if keys:
            every, count = _sum_by_key(keys, n)
            if kind == WORDS:
                every, count = np.array([0, 1]), np.array([count.sum(), (count > 0).sum()])
            yield pa.record_batch([pa.array(every), pa.array(count)], schema=schema)

    rows = asks.where(F.col("kind") == kind)
    rows = rows.repartition("part") if kind == WORDS else rows
    return rows.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def answered(asks: DataFrame, order: int, shallow: Shallow, parts: int) -> DataFrame:
    """Every ask with, instead of the counts, the log10 probability of its grams or
    the training count of its words."""
    shared = asks.sparkSession.sparkContext.broadcast(shallow)  # at most 258 * 257 counts

    def answer(kind: int, rows: list) -> Iterator[pa.RecordBatch]:
        keys = [_unpack(r[3], np.int64, True) for r in rows]
        n = [_unpack(r[4], np.int32) for r in rows]
        if kind == GRAMS:
            every, values = log_probabilities(np.concatenate(keys), np.concatenate(n), order, shared.value)
        else:
            every, values = _sum_by_key(keys, n)
        values = values.astype(np.float32 if kind == GRAMS else np.int64)
        for r, k in zip(rows, keys):
            yield pa.record_batch([pa.array([x], t.type) for x, t in zip(
                [*r[:4], _pack(values[np.searchsorted(every, k)])], _ASK)], schema=_ASK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if now != r[1:3] and held:
                    yield from answer(now[1], held)
                    held = []
                now = r[1:3]
                held.append(r)
        if held:
            yield from answer(now[1], held)

    dealt = asks.where(F.col("kind") != PAIRS).repartition(parts, "part").sortWithinPartitions("part", "kind")
    return dealt.mapInArrow(run, _ASK_DDL)


def score_documents(docs: DataFrame, held_out: Column | None = None, *, key: str = "doc_id", text: str = "text",
                    order: int = 5, bundle_bytes: int = 16 << 20) -> DataFrame:
    """PPM and word-unigram scores of every whole document.

    Rows: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10
    probabilities). Documents with ``held_out`` true are scored but not learned from
    (default: crc32 of the key as text modulo 7 is 2). NULL text is empty: it has the
    end symbol and the end token only; a NULL key counts as '' for the split; repeated
    rows are learned from and scored as often as they occur; without training
    documents the model is the uniform one; an empty table gives no rows; other
    columns are not read.
    """
    held_out = F.coalesce(id_remainder(F.col(key), 7) == 2 if held_out is None else held_out, F.lit(False))
    own = docs.select(F.col(key).cast("long").alias("doc_id"), held_out.alias("held_out"),
                      F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    size = own.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    bundles = max(1, -(-size // bundle_bytes))
    bundled = own.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(bundles)).cast("int").alias("bundle"),
                         "held_out", "doc_id", "text")
    asks = staged(asked(bundled.repartition(bundles, "bundle").sortWithinPartitions("bundle"), order, bundles), "ppm_asks")
    words = {r.key: int(r.n) for r in totals(asks, WORDS).collect()}
    total, kinds = words.get(0, 0), words.get(1, 0)
    pairs = totals(asks, PAIRS).toPandas()  # at most 258 * 257 rows
    shallow = Shallow(pairs["key"].to_numpy(np.int64), pairs["n"].to_numpy(np.float64))
    nothing = F.lit(None)
    rows = (answered(asks, order, shallow, bundles)
            .select("bundle", "kind", "keys", F.col("n").alias("value"), nothing.cast("long").alias("doc_id"),
                    nothing.cast("boolean").alias("held_out"), nothing.cast("string").alias("text"))
            .unionByName(bundled.select("bundle", F.lit(DOCS).alias("kind"), nothing.cast("binary").alias("keys"),
                                        nothing.cast("binary").alias("value"), "doc_id", "held_out", "text")))
    ordered = rows.repartition(bundles, "bundle").sortWithinPartitions("bundle", "kind")
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                        ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
                        ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, tables = None, {}
        for b in text_slices(_bundles_in(batches)):
            if b.column(0)[0].as_py() != bundle:
                bundle, tables = b.column(0)[0].as_py(), {GRAMS: [], WORDS: []}
            kind = b.column(1).to_numpy()
            for k, keys, value in zip(kind.tolist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                if k != DOCS:
                    tables[k].append((_unpack(keys, np.int64, True), _unpack(value, np.float32 if k == GRAMS else np.int64)))
            some = b.filter(pa.array(kind == DOCS))
            if not some.num_rows:
                continue
            for k in (GRAMS, WORDS):
                if not isinstance(tables[k], tuple):
                    tables[k] = (pd.Index(np.concatenate([x for x, _ in tables[k]])), np.concatenate([x for _, x in tables[k]]))
            texts = [t.encode().lower() for t in some.column(6).to_pylist()]
            grams, first = grams_of(texts, order)
            score = np.add.reduceat(tables[GRAMS][1][tables[GRAMS][0].get_indexer(grams)].astype(np.float64), first)
            words = [t.split() for t in texts]
            vocabulary = {w: i for i, w in enumerate(set().union(*words))}
            keys = np.fromiter((word_key(w) for w in vocabulary), np.int64, len(vocabulary))
            known = tables[WORDS][1][tables[WORDS][0].get_indexer(np.append(keys, END_WORD))]
            codes = np.fromiter((c for own in words for c in (*map(vocabulary.__getitem__, own), len(vocabulary))), np.int64)
            n = np.array([len(w) + 1 for w in words], np.int64)
            at = np.cumsum(n) - n
            base = np.log10((known + 1) / (total + kinds + 1))[codes]
            yield pa.record_batch([some.column(4), some.column(5), pa.array(n),
                                   pa.array(np.add.reduceat((known > 0).astype(np.int64)[codes], at)),
                                   pa.array(np.full(len(n), total)), pa.array(np.add.reduceat(base, at)),
                                   pa.array(score)], schema=schema)

    return ordered.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                   "base_score double, score double")
