"""Best-fit packing by linear grouping.

Documents become token pieces of at most ``capacity`` ids (only longer documents
are cut, the first piece takes the remainder). Piece lengths are integers up to
the capacity, so their histogram has at most ``capacity`` entries whatever the
size of the corpus, and the packing is planned on the histogram:

1. *Linear grouping*: lengths above ``small`` are put into groups of equal
   cardinality and rounded up to the largest length of their group.
2. *Few-size configurations*: for the few rounded sizes, take the largest size
   still in demand, fill the rest of its sequence as full as the other demands
   allow (bounded knapsack over the sizes), use that configuration as often as
   the demand lasts, repeat.
3. *Substitution*: actual lengths take the places of the rounded ones; this
   leaves bins that are classes (contents, count), not single sequences.
4. *Best fit*: the small lengths, longest first, fill the classes with the least
   room that holds them; what fits nowhere opens new sequences.

The plan is a list of (length, first rank, sequence, copies, offset) slots,
bounded by the capacity. Every piece finds its slot from its rank among the
pieces of equal length; ranks are partition-local counts plus prefix sums, so no
length, however frequent, meets in one task.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import staged, text_slices
from strata.llm.tokens import encoder

Contents = tuple[tuple[int, int], ...]  # (length, copies), in order of place
#: Bytes of text encoded at a time and distinct chunks kept by a Python worker, which
#: shares its executor's memory with all that came before in a chain of operators.
SLICE, CACHED = 1 << 20, 250_000


# ---- plan on the histogram (driver; at most ``capacity`` entries) ------------

def linear_groups(hist: dict[int, int], groups: int) -> list[list[tuple[int, int]]]:
    """Equal-cardinality groups of (length, count), longest first; a length whose
    count crosses a group boundary is shared between groups."""
    total = sum(hist.values())
    if not total:
        return []
    width = max(1, -(-total // groups))
    out: list[list[tuple[int, int]]] = [[]]
    room = width
    for length in sorted(hist, reverse=True):
        count = hist[length]
        while count:
            take = min(count, room)
            out[-1].append((length, take))
            count, room = count - take, room - take
            if not room:
                out.append([])
                room = width
    return [g for g in out if g]


def best_fill(sizes: list[int], demand: list[int], room: int) -> dict[int, int]:
    """Bounded knapsack: copies per size index that fill ``room`` the most."""
    reach = np.full(room + 1, -1, np.int32)  # index of the item that reached this fill last
    reach[0] = len(sizes)
    came = np.zeros(room + 1, np.int32)
    for i, (size, left) in enumerate(zip(sizes, demand)):
        for _ in range(min(left, room // size if size else 0)):
            new = (reach[:-size] >= 0) & (reach[size:] < 0)
            if not new.any():
                break
            at = np.nonzero(new)[0] + size
            reach[at], came[at] = i, at - size
    at = int(np.nonzero(reach >= 0)[0][-1])
    used: dict[int, int] = defaultdict(int)
    while at:
        used[int(reach[at])] += 1
        at = int(came[at])
    return used


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(copies per size index, how many sequences) covering the whole demand."""
    demand, out = list(demand), []
    for first in range(len(sizes)):  # longest first
        while demand[first]:
            demand[first] -= 1
            used = best_fill(sizes, demand, capacity - sizes[first])
            demand[first] += 1
            used[first] = used.get(first, 0) + 1
            times = min(demand[i] // n for i, n in used.items())
            for i, n in used.items():
                demand[i] -= n * times
            out.append((dict(used), times))
    return out


def substitute(groups: list[list[tuple[int, int]]], configs) -> list[tuple[int, Contents]]:
    """Classes (sequences, contents) with actual lengths in the places of the rounded ones."""
    queue = [[list(x) for x in g] for g in groups]

    def take(i: int, n: int) -> list[list[int]]:
        runs = []
        while n:
            head = queue[i][0]
            m = min(n, head[1])
            runs.append([head[0], m])
            head[1] -= m
            n -= m
            if not head[1]:
                queue[i].pop(0)
        return runs

    classes = []
    for used, times in configs:
        places = [take(i, times) for i, n in sorted(used.items()) for _ in range(n)]
        left = times
        while left:
            run = min(p[0][1] for p in places)
            lengths = [p[0][0] for p in places]
            classes.append((run, tuple((x, lengths.count(x)) for x in dict.fromkeys(lengths))))
            for p in places:
                p[0][1] -= run
                if not p[0][1]:
                    p.pop(0)
            left -= run
    return classes


def best_fit(classes: list[tuple[int, Contents]], small: dict[int, int], capacity: int):
    """Fill small lengths, longest first, into the fullest class with room."""
    by_room: dict[int, list[tuple[int, Contents]]] = defaultdict(list)
    rooms = np.zeros(capacity + 1, np.int64)

    def put(n: int, contents: Contents) -> None:
        if n:
            room = capacity - sum(x * k for x, k in contents)
            by_room[room].append((n, contents))
            rooms[room] += 1

    for n, contents in classes:
        put(n, contents)
    for size in sorted(small, reverse=True):
        count = small[size]
        while count:
            fits = np.nonzero(rooms[size:])[0]
            if len(fits):
                room = int(fits[0]) + size
                n, contents = by_room[room].pop()
                rooms[room] -= 1
            else:
                room, contents = capacity, ()
                n = -(-count // (capacity // size))
            copies = room // size
            full = min(n, count // copies)
            put(full, (*contents, (size, copies)))
            count -= full * copies
            if full < n and 0 < count < copies:
                put(1, (*contents, (size, count)))
                n, count = n - 1, 0
            if contents:
                put(n - full, contents)
    return [x for room in sorted(by_room) for x in by_room[room]]


def plan_slots(hist: dict[int, int], capacity: int, groups: int = 512, small: int | None = None) -> dict[str, np.ndarray]:
    """Slots sorted by (length, first rank) for every piece of the histogram."""
    small = capacity // 4 if small is None else small
    classes: list[tuple[int, Contents]] = []
    if hist.get(capacity):
        classes.append((hist[capacity], ((capacity, 1),)))
    large = {k: v for k, v in hist.items() if small < k < capacity}
    grouped = linear_groups(large, groups)
    sizes = [max(x for x, _ in g) for g in grouped]
    classes += substitute(grouped, configurations(sizes, [sum(n for _, n in g) for g in grouped], capacity))
    classes = best_fit(classes, {k: v for k, v in hist.items() if k <= small}, capacity)
    rows, ranks, sequence = [], defaultdict(int), 0
    for n, contents in classes:
        offset = 0
        for size, copies in contents:
            rows.append((size, ranks[size], sequence, copies, offset))
            ranks[size] += n * copies
            offset += size * copies
        sequence += n
    assert all(ranks[k] == v for k, v in hist.items()), "a piece has no place"
    rows.sort()
    names = ("length", "first", "sequence", "copies", "offset")
    return dict(zip(names, np.array(rows, np.int64).reshape(-1, 5).T.copy()))


# ---- Spark ------------------------------------------------------------------

def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) pieces of a document of ``n`` ids: the remainder first."""
    head = n % capacity
    starts = ([0] if head else []) + list(range(head, n, capacity))
    return [(s, head if head and s == 0 else capacity) for s in starts]


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, *,
                     key: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece with its partition and its rank among the partition's
    pieces of equal length."""
    end = int(end_id).to_bytes(4, "little")
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64()), ("part", pa.int32()), ("rank", pa.int64())]
    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"
    if keep_ids:
        fields.append(("ids", pa.list_(pa.int32())))
        ddl += ", ids array<int>"
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, enc = TaskContext.get().partitionId(), encoder(tokenizer_path, True, CACHED)
        ranks: dict[int, int] = defaultdict(int)
        for b in text_slices(batches, SLICE):
            cols: list[list] = [[] for _ in fields]
            for doc, ids in zip(b.column(0).to_pylist(), enc.encode(pc.fill_null(b.column(1), ""))):
                ids = memoryview(ids + end)
                for i, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * start:4 * (start + length)]
                    row = [doc, i, start, length, zlib.crc32(own), part, ranks[length]]
                    if keep_ids:
                        row.append(np.frombuffer(own, "<u4").astype(np.int32))
                    ranks[length] += 1
                    for c, x in zip(cols, row):
                        c.append(x)
            yield pa.record_batch([pa.array(c, f[1]) for c, f in zip(cols, fields)], schema=schema)

    own = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return own.mapInArrow(run, ddl)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, *, key: str = "doc_id",
         text: str = "text", groups: int = 512, small: int | None = None, keep_ids: bool = False) -> DataFrame:
    """Pack whole documents into sequences of at most ``capacity`` ids.

    Rows: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ``ids``
    with ``keep_ids``). NULL or empty text is one end id; a NULL key stays NULL;
    repeated rows are packed as often as they occur; an empty table gives no rows;
    other columns of ``docs`` are not read. Pieces of a sequence lie gapless from
    offset 0. Documents of equal length take places in (partition, row) order.
    """
    pieces = staged(tokenised_pieces(docs, tokenizer_path, capacity, end_id, key=key, text=text,
                                     keep_ids=keep_ids), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    hist = {int(r.length): int(r.n) for r in
            pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    slots = plan_slots(hist, capacity, groups, small)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["part", "length"])
    more = ["ids"] if keep_ids else []
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32",
                           (F.col("base") + F.col("rank")).alias("rank"), *more)
    span = int(max(slots["first"], default=0)) + 1
    found_by = slots["length"] * span + slots["first"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            at = np.searchsorted(found_by, length * span + np.minimum(rank, span - 1), "right") - 1
            local, copies = rank - slots["first"][at], slots["copies"][at]
            sequence = slots["sequence"][at] + local // copies
            offset = slots["offset"][at] + local % copies * length
            yield pa.record_batch([*b.columns[:5], pa.array(sequence), pa.array(offset), *b.columns[6:]],
                                  names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
                                         *more])

    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(place, ddl + (", ids array<int>" if keep_ids else ""))
