"""Fuzzy line de-duplication.

Lines are normalised (lower case, words without surrounding punctuation) and equal
ones are one class. A class is described by SIX SimHashes, its blocks: every word is dealt
to a block by its hash, and a block is the 64-bit SimHash of its distinct words. An edit touches
the block of the word that goes and that of the word that comes, so (pigeonhole) lines
that differ in k words agree on at least 6 - 2k blocks, whatever the words' number. Two
classes are candidates if they agree on one block (20 words and more), on two (12 and
more) or on three that hold two fifths of the line (shorter lines).

Candidates are verified by edit similarity of the normalised lines, and of every
connected group of lines one occurrence stays: the first by (doc_id, line number); of
several texts under one doc_id, those with the lower hash come first.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import identified, member, staged, text_slices
from strata.llm.linking import compare, linked_groups

BLOCKS = 6
PUNCTUATION = ".,;:!?\"'()[]{}<>*_-`~/\\|#$%&@^+="


def split_words(lines: pa.Array | list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Normalised words of lines: the distinct ones ('' for punctuation only), their letters, and
    for every word of every line its place among them and its line. Words are lower-cased,
    between ASCII white space, without surrounding punctuation."""
    if isinstance(lines, list):
        lines = pa.array(lines, pa.string())
    split = pc.ascii_split_whitespace(pc.utf8_lower(lines))
    words = split.flatten().dictionary_encode()
    names = pc.utf8_trim(words.dictionary, PUNCTUATION)  # joined and split: the quickest way to Python strings
    every = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names), " ")[0].as_py()
    plain = every.split(" ") if len(names) else []
    lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    return plain, pc.utf8_length(names).to_numpy(), words.indices.to_numpy(), np.repeat(np.arange(len(lines), dtype=np.int32), lengths)


def normalised(lines: list[str]) -> list[str]:
    """The normalised words of each line, joined by blanks."""
    plain, _, words, line = split_words(lines)
    out: list[list[str]] = [[] for _ in lines]
    for i, w in zip(line.tolist(), words.tolist()):
        if plain[w]:
            out[i].append(plain[w])
    return [" ".join(x) for x in out]


def _simhash(hashes: np.ndarray, words: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """64-bit majority vote over the word hashes of every group (``words`` index
    ``hashes``; a group's words are n from first). Votes are byte counters, eight to a
    machine word, so groups are summed in runs of at most 255 words."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
    lanes = np.ascontiguousarray(bits).view(np.uint64)  # (words, 8): a byte for each bit
    runs = -(-n // 255)
    group = np.repeat(np.arange(len(n)), runs)
    inside = np.arange(len(group)) - np.repeat(np.cumsum(runs) - runs, runs)
    sums = np.add.reduceat(lanes[words], first[group] + 255 * inside, axis=0).view(np.uint8)
    votes = np.add.reduceat(sums, np.cumsum(runs) - runs, axis=0, dtype=np.int32) if len(group) > len(n) else sums
    return np.packbits(votes.astype(np.int32) * 2 > n[:, None], axis=1).view(np.int64).ravel()


def halves(words: list[str]) -> list[int]:
    """Hashes of the first and last half of the letters, for this length and the next lower."""
    s = "".join(words)
    cuts = len(s) // 2, (len(s) - 1) // 2
    return [xxhash.xxh64_intdigest(x) >> 1 for h in cuts for x in (f"{h}<{s[:h]}", f"{h}>{s[-h:]}")]


def describe_lines(lines: pa.Array | list[str]) -> tuple[np.ndarray, ...]:
    """Words, length when normalised, class id (63-bit hash of the normalised words in order),
    block SimHashes (lines x 6; 0 without words), the blocks' letters (6 x 10 bits, at
    most 1023 each) and halves (lines x 4; 0 for lines of 12 words and more or of less than
    10 letters, which no edit may change) of every line; lines without words have class -1."""
    plain, size, words, line = split_words(lines)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, plain), np.uint64, len(plain))
    keep = size[words] > 0
    if not keep.all():
        words, line = words[keep], line[keep]
    n = np.bincount(line, minlength=len(lines))
    length = (np.bincount(line, size[words], len(lines)) + np.maximum(n - 1, 0)).astype(np.int64)
    full = np.nonzero(n)[0]
    cid = np.full(len(lines), -1, np.int64)
    blocks, letters = np.zeros((len(lines), BLOCKS), np.int64), np.zeros(len(lines), np.int64)
    half = np.zeros((len(lines), 4), np.int64)
    if len(full):
        first = np.cumsum(n) - n
        place = (np.arange(len(line)) - first[line]).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        mixed = hashes[words] * place
        mixed = (mixed ^ (mixed >> np.uint64(29))) * (place * np.uint64(0xBF58476D1CE4E5B9))
        mixed ^= mixed >> np.uint64(32)
        cid[full] = (np.add.reduceat(mixed, first[full]) >> np.uint64(1)).astype(np.int64)
        dealt = ((hashes >> np.uint64(40)) % np.uint64(BLOCKS)).astype(np.int8)[words]
        pairs = line.astype(np.int64) << 32 | words
        for b in range(BLOCKS):
            own = np.sort(pairs[dealt == b])  # every word of a line votes once, so none that it repeats decides alone
            own = own[np.append(True, own[1:] != own[:-1])] if len(own) else own
            of, own = own >> 32, own & 0xFFFFFFFF
            m = np.bincount(of, minlength=len(lines))
            some = np.nonzero(m)[0]
            if len(some):
                blocks[some, b] = _simhash(hashes, own, (np.cumsum(m) - m)[some], m[some])
                letters |= np.minimum(np.bincount(of, size[own], len(lines)), 1023).astype(np.int64) << 10 * b
        for i in np.nonzero((n > 0) & (n <= 12) & (length - n + 1 >= 10))[0].tolist():
            half[i] = halves([plain[w] for w in words[first[i]:first[i] + n[i]].tolist()])
    return n, length, cid, blocks, letters, half


def edit_distance(a: str, b: str, most: int | None = None) -> int:
    """Levenshtein distance, bit-parallel over the shorter string; any number above
    ``most`` as soon as it must exceed that."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b)
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    mask, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score = mask, 0, len(a)
    left = len(b)
    for c in b:
        left -= 1
        if most is not None and score - left - 1 > most:
            return score
        match = at.get(c, 0)
        flat = (((match & up) + up) ^ up) | match | down
        rise, fall = down | (mask & ~(flat | up)), up & flat
        score += bool(rise & last) - bool(fall & last)
        rise = (rise << 1 | 1) & mask
        up = ((fall << 1) & mask) | (mask & ~(flat | rise))
        down = rise & flat
    return score


def word_edits(x: list[str], y: list[str], most: int) -> int:
    """No less than the edit distance of two lines of words: unequal runs between equal words
    that are at most eight words on cost their longer side. Ends above ``most``."""
    i = j = cost = 0
    while cost <= most:
        while i < len(x) and j < len(y) and x[i] == y[j]:
            i, j = i + 1, j + 1
        left, right = x[i:], y[j:]
        if left and right:
            meets = ((d, s - d) for s in range(1, 9) for d in range(s + 1)
                     if d < len(left) and s - d < len(right) and left[d] == right[s - d])
            d, e = next(meets, (len(left), len(right)))
            left, right = left[:d], right[:e]
        if not left and not right:
            return cost
        cost += max(sum(map(len, left)) + len(left), sum(map(len, right)) + len(right))
        i, j = i + len(left), j + len(right)
    return cost


def similar(a: str, b: str, percent: int) -> bool:
    """Is the edit distance at most (100 - percent) % of the longer string? Bounds that are
    quick to have decide most pairs; they never differ from the distance."""
    most = (100 - percent) * max(len(a), len(b)) // 100
    if abs(len(a) - len(b)) > most:
        return False
    x, y = a.split(" "), b.split(" ")
    if len(x) == len(y) and sum(max(len(p), len(q)) for p, q in zip(x, y) if p != q) <= most:
        return True  # words changed in their places
    front = len(commonprefix((a, b)))
    a, b = a[front:], b[front:]
    back = len(commonprefix((a[::-1], b[::-1])))
    a, b = a[:len(a) - back], b[:len(b) - back]
    if max(len(a), len(b)) <= most:
        return True
    # an edit touches three of the three-letter pieces of a; the others are in b
    pieces = {b[i:i + 3] for i in range(len(b) - 2)}
    missing = sum(a[i:i + 3] not in pieces for i in range(len(a) - 2))
    if missing > 3 * most:
        return False
    if 2 * missing <= 3 * most and word_edits(x, y, most) <= most:
        return True  # words that came or went
    return edit_distance(a, b, most) <= most


def _within(left: list[str], right: list[str], most: np.ndarray) -> np.ndarray:
    """Which pairs, longest ``right`` first, have an edit distance of at most ``most``: the bit-parallel
    columns of all pairs at once, 64 letters of ``left`` to a word, and of these only the words
    near the diagonal, as a path that leaves it by more than ``most`` costs more."""
    m, n = (np.fromiter(map(len, x), np.int64, len(x)) for x in (left, right))
    count, band, columns, words = len(m), int(most.max()), int(n[0]), max(1, -(-int(m.max()) // 64))
    x, y = (np.frombuffer("".join(t).encode("utf-32-le", "surrogatepass"), np.uint32) for t in (left, right))
    seen = np.zeros(0x110000, bool)
    seen[x] = seen[y] = True
    alphabet, rank = int(seen.sum()), np.cumsum(seen) - 1

    def placed(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths), np.repeat(np.arange(count), lengths)

    place, pair = placed(m)
    masks = np.zeros((words, count * alphabet), np.uint64)
    np.bitwise_or.at(masks, (place >> 6, pair * alphabet + rank[x]), np.uint64(1) << (place & 63).astype(np.uint64))
    place, pair = placed(n)
    letter = np.zeros((columns, count), np.int32)
    letter[place, pair] = pair * alphabet + rank[y]
    up, down = np.full((words, count), ~np.uint64(0)), np.zeros((words, count), np.uint64)
    one, last = np.uint64(1), np.uint64(63)
    score, above, first = m.copy(), np.zeros(count, np.int64), 0  # above: distance over the first word
    for j in range(columns):
        while first < words - 1 and 64 * (first + 1) <= j - band:
            above += np.bitwise_count(up[first]).astype(np.int64) - np.bitwise_count(down[first])
            first += 1
        own, left_over = (int(np.searchsorted(-n, -i)) for i in (j, j + 1))
        near = range(first, min(words, (j + band) // 64 + 1))
        plus, minus = one, np.uint64(0)
        for w in near:
            u, d = up[w, :own], down[w, :own]
            match = masks[w][letter[j, :own]]
            flat = match | d
            match |= minus
            across = (((match & u) + u) ^ u) | match
            rise, fall = d | ~(across | u), u & across
            after = rise >> last, fall >> last
            rise, fall = rise << one | plus, fall << one | minus
            up[w, :own], down[w, :own] = fall | ~(flat | rise), rise & flat
            plus, minus = after
        above += 1
        if left_over < own:
            ended = slice(left_over, own)
            score[ended] = above[ended]
            for w in near:
                held = np.clip(m[ended] - 64 * w, 0, 64).astype(np.uint64)
                bits = np.where(held == 64, ~np.uint64(0), (one << (held & last)) - one)
                score[ended] += np.bitwise_count(up[w, ended] & bits).astype(np.int64) - np.bitwise_count(down[w, ended] & bits)
    return score <= most


#: Letters up to which lines are compared many at once, pairs that make this worth while, and the
#: letters, and words of their bit masks, that such a batch of pairs may have.
LONG, SEVERAL, LETTERS, MASKS = 2_000, 16, 1 << 20, 1 << 21


def similar_pairs(left: list[str], right: list[str], percent: int) -> list[bool]:
    """``similar`` of each pair. Pairs that their lengths or the words in their places do not
    decide are compared many at once."""
    found, rest = [False] * len(left), []
    for i, (a, b) in enumerate(zip(left, right)):
        long = max(len(a), len(b))
        most = (100 - percent) * long // 100
        if long > LONG:
            found[i] = similar(a, b, percent)
        elif abs(len(a) - len(b)) <= most:
            x, y = a.split(" "), b.split(" ")
            if len(x) == len(y) and sum(max(len(p), len(q)) for p, q in zip(x, y) if p != q) <= most:
                found[i] = True
            else:
                rest.append((long, most, i))
    rest.sort(reverse=True)
    while rest:
        long = max(rest[0][0], 1)
        alphabet = len(set().union(*(left[i] + right[i] for _, _, i in rest[:LETTERS // long]))) if len(rest) >= SEVERAL else 1
        n = max(1, min(LETTERS // long, MASKS // (alphabet * (long // 64 + 1))))
        some, rest = rest[:n], rest[n:]
        if len(some) < SEVERAL:
            for _, _, i in some:
                found[i] = similar(left[i], right[i], percent)
            continue
        pairs = [sorted((left[i], right[i]), key=len) for _, _, i in some]
        for (_, _, i), ok in zip(some, _within([a for a, _ in pairs], [b for _, b in pairs], np.array([x for _, x, _ in some])).tolist()):
            found[i] = ok
    return found


#: Columns that describe a line: number of words, letters and SimHashes of the blocks, halves.
SIGNATURE = ["words", "letters", *(f"b{i}" for i in range(BLOCKS)), *(f"half{i}" for i in range(4))]


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers, every bit of which hangs on all those of ``x`` (uint64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def keys_of(n: np.ndarray, letters: np.ndarray, blocks: list[np.ndarray], half: list[np.ndarray]) -> pa.ListArray:
    """The keys of every line, see ``line_keys``."""
    held = [letters >> 10 * b & 1023 for b in range(BLOCKS)]
    whole = 2 * sum(held)
    own = [_mixed(x.view(np.uint64) + np.uint64((b + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) for b, x in enumerate(blocks)]
    schemes = ((1, lambda x: x >= 16, n >= 19), (2, lambda x: x >= 16, (n >= 11) & (n <= 20)), (3, lambda x: 5 * x >= whole, n <= 12))
    made, there = [], []
    for r, enough, use in schemes:
        for chosen in combinations(range(BLOCKS), r):
            made.append(_mixed(sum((own[b] for b in chosen), np.uint64(r))).view(np.int64))
            there.append(use & enough(sum(held[b] for b in chosen)))
    for i, x in enumerate(half):
        made.append(x)
        there.append((n <= 12) & (x != 0) & np.logical_and.reduce([x != y for y in half[:i]] or [True]))
    there = np.stack(there, axis=1)
    ends = np.append(0, np.cumsum(there.sum(axis=1)))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.stack(made, axis=1)[there]))


def line_keys() -> Column:
    """The keys of a line (columns SIGNATURE): one for each block, each two or each three
    blocks, if these hold enough of the line to be its own, and the halves of short lines.
    Lines near a limit of their numbers of words have the keys of both sides."""
    @F.arrow_udf("array<bigint>")
    def keys(*columns: pa.Array) -> pa.Array:
        n, letters, *rest = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
        return keys_of(n, letters, rest[:BLOCKS], rest[BLOCKS:])

    return keys(*SIGNATURE)


def _occurrences(own: DataFrame) -> DataFrame:
    """(doc, part, line, length, cid, SIGNATURE) of every line with words."""
    small = ("line", "words")
    schema = pa.schema([(x, pa.int32() if x in small else pa.int64()) for x in ("doc", "part", "line", "length", "cid", *SIGNATURE)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, 2 << 20):
            split = pc.split_pattern(pc.fill_null(b.column(2), ""), "\n")
            n, length, cid, blocks, letters, half = describe_lines(split.flatten())
            lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False)
            line = np.arange(len(cid)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            docs, parts = (np.repeat(b.column(i).to_numpy(), lengths) for i in (0, 1))
            ok = n > 0
            columns = [docs, parts, line.astype(np.int32), length, cid, n.astype(np.int32), letters, *blocks.T, *half.T]
            yield pa.record_batch([pa.array(x[ok], t.type) for x, t in zip(columns, schema)], schema=schema)

    return own.mapInArrow(run, ", ".join(f"{f.name} {'int' if f.name in small else 'long'}" for f in schema))


def _texts_of(own: DataFrame, places: DataFrame) -> DataFrame:
    """(id, value): the normalised lines at ``places`` (id, doc, part, line). Only documents
    that may hold one are moved."""
    wanted = places.groupBy("doc", "part").agg(F.collect_list(F.struct("id", "line")).alias("wanted"))
    held = own.where(member(places.select(F.col("doc").alias("id")).distinct())("doc")).dropDuplicates(["doc", "part"]).join(
        wanted.hint("merge"), ["doc", "part"])
    schema = pa.schema([("id", pa.int64()), ("value", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            ids, found = [], []
            for t, some in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                split = (t or "").split("\n")
                ids += [x["id"] for x in some]
                found += [split[x["line"]] for x in some]
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(normalised(found), pa.string())],
                                  schema=schema)

    return held.select("text", "wanted").mapInArrow(run, "id long, value string")


def removed_lines(own: DataFrame, percent: int, rounds: int) -> DataFrame:
    """(doc, part, lines): numbers of the lines that go, per document (columns doc, part, text)."""
    found = staged(_occurrences(own), "lines")
    classes = staged(found.groupBy("cid").agg(*(F.min(c).alias(c) for c in (*SIGNATURE, "length")),  # equal in a class
                                              F.min(F.struct("doc", "part", "line")).alias("first"), F.count("*").alias("n")),
                     "line_classes")
    postings = classes.select(F.explode(line_keys()).alias("key"), F.col("cid").alias("id"), "length", (-F.col("n")).alias("few"))

    def near(n: Column, m: Column) -> Column:
        """Lengths that the edits allowed can bridge."""
        return F.abs(n - m) <= F.floor((100 - percent) * F.greatest(n, m) / 100)

    # keys of one class go, and keys of two that are too different in length
    of_key = Window.partitionBy("key")
    both = near(F.min("length").over(of_key), F.max("length").over(of_key))
    postings = postings.withColumn("_many", F.count("*").over(of_key)).withColumn("_both", both)
    postings = staged(postings.where((F.col("_many") > 2) | (F.col("_many") == 2) & F.col("_both")).drop("_many", "_both"),
                      "line_postings")

    def linked(a: list[pa.Scalar], b: list[pa.Scalar]) -> list[bool]:
        return similar_pairs([x.as_py() for x in a], [x.as_py() for x in b], percent)

    def verify(pairs: DataFrame) -> DataFrame:
        if pairs.isEmpty():
            return pairs
        ids = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
        places = staged(classes.join(ids.hint("merge"), "cid").select(F.col("cid").alias("id"), "first.*"), "line_places")
        return compare(pairs, staged(_texts_of(own, places), "line_texts"), "a long, b long", linked)

    groups = linked_groups(postings, verify, extras=["length", "few"], central=["few"], rounds=rounds, centres=4,
                           admissible=lambda a, b: near(F.col(f"{a}_length"), F.col(f"{b}_length")))
    # the first occurrence of every group of more than one line
    named = classes.join(groups.hint("merge"), classes.cid == groups.id, "left").select("cid", "first", "n", F.col("component").alias("group"))
    of_group = named.where("group is not null").groupBy("group").agg(F.min("first").alias("first"))
    linked_classes = named.where("group is not null").select("cid", "group").join(of_group, "group").select("cid", "first")
    repeated = named.where("group is null and n > 1").select("cid", "first").unionByName(linked_classes)
    gone = found.join(staged(repeated, "line_repeats").hint("merge"), "cid").where(
        F.struct("doc", "part", "line") != F.col("first"))
    return staged(gone.groupBy("doc", "part").agg(F.collect_set("line").alias("lines")), "line_removals")


def dedup_lines(docs: DataFrame, *, key: str = "doc_id", text: str = "text", percent: int = 90,
                rounds: int = 1, counts: bool = True, drop_emptied: bool = False) -> DataFrame:
    """``docs`` with all their columns and ``text`` without the lines that repeat
    elsewhere, exactly after normalisation or nearly (edit similarity of ``percent``).

    With ``counts``, columns n_lines and n_removed are set (replacing any of that
    name). With ``drop_emptied``, documents that lost every line with words go. Lines
    without words always stay. NULL text stays NULL and has no lines; empty text has one
    blank line; rows with equal keys and texts count as one document, so their lines share
    one fate, and every row without a key as one of its own; NULL keys come last in the
    order; an empty table gives no rows.
    """
    rows = identified(docs, key, text)
    own = rows.select(F.col("_doc").alias("doc"), F.col("_part").alias("part"), F.col(text).cast("string").alias("text"))
    gone = removed_lines(own, percent, rounds)
    base = rows.drop(*("n_lines", "n_removed") if counts else ())
    some = member(gone.select(F.col("doc").alias("id")))("_doc")
    removals = gone.select(F.col("doc").alias("_doc"), F.col("part").alias("_part"), F.col("lines").alias("_gone")).hint("merge")  # grows with the corpus
    joined = base.where(some).join(removals, ["_doc", "_part"], "left").unionByName(
        base.where(~some).withColumn("_gone", F.lit(None).cast("array<int>"))).drop("_doc", "_part")
    split = F.split(F.col(text), "\n", -1)
    places = F.array_except(F.sequence(F.lit(0), F.size("_all") - 1), "_gone")
    kept = F.transform(places, lambda i: F.get("_all", i))
    out = joined.withColumn("_all", split).withColumn("_kept", F.when(F.col("_gone").isNull(), F.col("_all")).otherwise(kept))
    if drop_emptied:
        blank = F.forall("_kept", lambda x: F.trim(x) == "")
        out = out.where(F.col("_gone").isNull() | ~F.coalesce(blank, F.lit(False)))
    out = out.withColumn(text, F.when(F.col("_gone").isNull(), F.col(text)).otherwise(F.array_join("_kept", "\n")))
    if counts:
        out = out.withColumn("n_lines", F.coalesce(F.size("_all"), F.lit(0)).cast("long")) \
                 .withColumn("n_removed", (F.coalesce(F.size("_all"), F.lit(0)) - F.coalesce(F.size("_kept"), F.lit(0))).cast("long"))
    return out.drop("_gone", "_all", "_kept")
