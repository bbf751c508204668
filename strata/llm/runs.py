"""Periodic runs in word sequences, found with an enhanced suffix array.

A run is a maximal stretch of words with smallest period q that holds at least
``repeats`` periods. Its last square of two periods, at i, is a *branching tandem
repeat*: the suffixes at i and i + q share exactly q words, so both lie in the LCP
interval of depth q, in different children of it. For every LCP interval the suffixes of
all children but the largest ask for the interval's other suffixes at i + depth and
i - depth by their place in the suffix array (no tree is built; every suffix is asked
O(log n) times). The squares found are rotated to the left while the word before equals
the last one, and squares of one stretch are merged into its run.

The suffix array covers the documents of a slice at once: words of different documents
are different symbols, so no interval spans two of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import text_slices


def suffix_array(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array, its inverse, and the positions whose next ``depth`` symbols (rounded
    down to a power of two) occur elsewhere too, by prefix doubling over the suffixes that
    are not yet told apart. The last symbol of every document must occur once."""
    n = len(symbols)
    sa = np.argsort(symbols, kind="stable")
    rank, slots, h = np.empty(n, np.int64), np.arange(n), 1
    order, key, shared = sa, symbols[sa], None
    while True:
        new = np.empty(len(key), bool)
        new[:1], new[1:] = True, key[1:] != key[:-1]
        rank[order] = slots[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
        alone = new.copy()
        alone[:-1] &= new[1:]
        slots = slots[~alone]
        if 2 * h > depth and shared is None:
            shared = sa[slots]
        if not len(slots):
            return sa, rank, shared
        own = sa[slots]
        key = rank[own] * n + rank[own + h]
        by = np.argsort(key, kind="stable")
        key, order = key[by], own[by]
        sa[slots] = order
        h *= 2


def lcp_array(symbols: np.ndarray, sa: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Symbols that the suffix at each slot shares with the one before (-1 at both ends)."""
    out = np.full(len(sa) + 1, -1, np.int64)
    s, places, slots, made, h = memoryview(symbols), memoryview(sa), memoryview(rank), memoryview(out), 0
    for i in range(len(sa)):
        slot = slots[i]
        if slot:
            j = places[slot - 1]
            while s[i + h] == s[j + h]:
                h += 1
            made[slot] = h
            if h:
                h -= 1
        else:
            h = 0
    return out


def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """The nearest place to the left with a smaller value (the first value is the least):
    each place follows the pointers of those before it."""
    left = np.zeros(len(values), np.int64)
    v, to = memoryview(np.ascontiguousarray(values)), memoryview(left)
    for i in range(1, len(values)):
        own, j = v[i], i - 1
        while j and v[j] >= own:
            j = to[j]
        to[i] = j
    return left


def tandem_repeats(sa: np.ndarray, rank: np.ndarray, lcp: np.ndarray, repeats: int) -> tuple[np.ndarray, np.ndarray]:
    """Branching tandem repeats (place, depth) that ``repeats`` - 2 further copies precede."""
    n = len(sa)
    low = nearest_smaller(lcp[:n])
    backwards = nearest_smaller(lcp[::-1])
    high = n - 1 - backwards[::-1][:n]  # last slot of the interval
    at = np.nonzero((lcp[:n] >= 1) & (high - low + 1 >= repeats))[0]  # a run's interval holds all its copies
    if not len(at):
        return at, at
    at = at[np.argsort(low[at] * (n + 1) + high[at], kind="stable")]
    lo, hi, depth = low[at], high[at], lcp[at]
    first = np.ones(len(at), bool)
    first[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    node = np.cumsum(first) - 1  # children: up to each border, and after a node's last one
    heads = np.nonzero(first)[0]
    last = np.append(heads[1:], len(at)) - 1
    begin = np.concatenate([np.where(first, lo, np.append(0, at[:-1])), at[last]])
    end = np.concatenate([at, hi[last] + 1])
    of = np.concatenate([node, np.arange(len(heads))])
    by = np.lexsort((begin - end, of))  # the largest child of each node first
    head = np.ones(len(by), bool)
    head[1:] = of[by][1:] != of[by][:-1]
    small = by[~head]
    begin, end, of = begin[small], end[small], of[small]
    sizes = end - begin
    child = np.repeat(np.arange(len(small)), sizes)
    slot = np.arange(len(child)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begin[child]
    of = of[child]
    lo, hi, depth = lo[heads][of], hi[heads][of], depth[heads][of]
    begin, end, place = begin[child], end[child], sa[slot]

    def inside(where: np.ndarray, some: slice | np.ndarray = slice(None)) -> np.ndarray:
        other = rank[np.clip(where, 0, n - 1)]
        return (where >= 0) & (where < n) & (other >= lo[some]) & (other <= hi[some])

    found = []
    for other, square in ((place + depth, place), (place - depth, place - depth)):
        r = rank[np.clip(other, 0, n - 1)]
        some = np.nonzero(inside(other) & ((r < begin) | (r >= end)))[0]
        for j in range(1, repeats - 1):
            some = some[inside(square[some] - j * depth[some], some)]
        found.append(square[some] * (n + 1) + depth[some])
    key = np.unique(np.concatenate(found))
    return key // (n + 1), key % (n + 1)


def rotated(symbols: np.ndarray, place: int, period: int) -> int:
    """How far left the square at ``place`` can be rotated: the run's start."""
    step = 32
    while place:
        low = max(0, place - step)
        apart = np.nonzero(symbols[low:place] != symbols[low + period:place + period])[0]
        if len(apart):
            return low + int(apart[-1]) + 1
        place, step = low, 2 * step
    return 0


def find_runs(codes: np.ndarray, lengths: np.ndarray, min_length: int, repeats: int) -> np.ndarray:
    """Runs of consecutive documents (``codes``: a number for each word; ``lengths``: words of
    each document) as rows (document, start, length, period), in this order."""
    none = np.empty((0, 4), np.int64)
    if not len(codes):
        return none
    # words of a run that come back a period later: documents without so long a repeat have none
    overlap = min(max(min_length - q, (repeats - 1) * q) for q in range(1, min_length + 1))
    docs = np.repeat(np.arange(len(lengths)), lengths + 1)
    ends = np.cumsum(lengths + 1) - 1
    width = int(codes.max()) + 2
    symbols = np.full(len(docs), width - 1, np.int64)
    inner = np.ones(len(docs), bool)
    inner[ends] = False
    symbols[inner] = codes
    symbols += docs * width
    sa, rank, shared = suffix_array(symbols, overlap)
    some = np.zeros(len(lengths), bool)
    some[docs[shared]] = True
    use = some[docs]  # a document's suffixes have the slots that its words have in the text
    if not use.any():
        return none
    moved = (np.cumsum(use) - 1)
    symbols, docs, sa = symbols[use], docs[use], moved[sa[use]]
    rank = np.empty(len(sa), np.int64)
    rank[sa] = np.arange(len(sa))
    places, periods = tandem_repeats(sa, rank, lcp_array(symbols, sa, rank), repeats)
    out, merged = [], {}
    stops = places + 2 * periods
    for i in np.lexsort((periods, stops)).tolist():
        period, stop = int(periods[i]), int(stops[i])
        starts = merged.setdefault(stop, [])
        if any(start <= stop - 2 * period for start in starts):
            continue  # several periods of a run found before
        start = rotated(symbols, int(places[i]), period)
        starts.append(start)
        if stop - start >= min_length:
            out.append((start, stop - start, period))
    if not out:
        return none
    found = np.array(out, np.int64)
    doc = docs[found[:, 0]]
    begin = np.searchsorted(docs, doc)
    found = np.column_stack([doc, found[:, 0] - begin, found[:, 1:]])
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_DDL = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def periodic_runs(docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_length: int = 6, repeats: int = 4,
                  word_order: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """Per row of ``docs``: the key, n_words, ``runs`` (start, length, period; by start, then
    period) and ``collapsed``, the words joined by blanks without those that a run holds
    after its first period.

    Words are what ASCII white space separates in the whole text. ``repeats`` is the least
    number of periods, two or more. ``word_order(key, n words)`` may give the places of the
    words to take in place of the text's own order. NULL and empty texts have no words, no
    run and an empty ``collapsed``; rows with NULL or equal keys stay rows of their own; an
    empty table gives no rows; other columns are not read. A text is handled whole in one
    task, with about 100 bytes of memory a word.
    """
    schema = pa.schema([("_key", pa.int64()), ("n_words", pa.int64()), ("runs", _RUNS), ("collapsed", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, 1 << 20, "_text"):
            split = pc.ascii_split_whitespace(pc.fill_null(b.column(1), ""))
            owner = np.repeat(np.arange(b.num_rows), pc.list_value_length(split).to_numpy(zero_copy_only=False))
            words = split.flatten().dictionary_encode()
            codes, names = words.indices.to_numpy().astype(np.int64), words.dictionary
            full = np.append(pc.binary_length(names).to_numpy(zero_copy_only=False) > 0, False)[codes]
            codes, owner = codes[full], owner[full]
            lengths = np.bincount(owner, minlength=b.num_rows)
            starts = np.cumsum(lengths) - lengths
            if word_order is not None:
                for k, at, n in zip(b.column(0).to_pylist(), starts.tolist(), lengths.tolist()):
                    if (order := word_order(k, n)) is not None:
                        codes[at:at + n] = codes[at:at + n][order]
            found = find_runs(codes, lengths, min_length, repeats)
            edges = np.zeros(len(codes) + 1, np.int64)
            begin = starts[found[:, 0]] + found[:, 1]
            np.add.at(edges, begin + found[:, 3], 1)
            np.add.at(edges, begin + found[:, 2], -1)
            kept = np.cumsum(edges[:-1]) == 0
            offsets = lambda counts: pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
            left = pa.ListArray.from_arrays(offsets(np.bincount(owner[kept], minlength=b.num_rows)), names.take(pa.array(codes[kept])))
            rows = pa.StructArray.from_arrays([pa.array(found[:, i]) for i in (1, 2, 3)], names=["start", "length", "period"])
            runs = pa.ListArray.from_arrays(offsets(np.bincount(found[:, 0], minlength=b.num_rows)), rows)
            yield pa.record_batch([b.column(0), pa.array(lengths), runs.cast(_RUNS), pc.binary_join(left, " ")], schema=schema)

    own = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).cast("string").alias("_text"))
    return own.mapInArrow(run, "_key long, " + _DDL).withColumnRenamed("_key", key)


def run_digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """What ``periodic_runs`` found, in short: n_runs, the run of the greatest exact length /
    period (ties: the first) with floor(1000 * length / period), and SHA-256 digests of all
    runs (``start,length,period`` and a newline each) and of the collapsed text."""
    better = lambda best, x: best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"])
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    best = F.reduce("runs", none, lambda best, x: F.when(better(best, x), x).otherwise(best))
    line = lambda x: F.concat_ws(",", x["start"], x["length"], x["period"])
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    rows = found.withColumn("_best", best)
    return rows.select(key, F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
                       F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
                       F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
