"""Prefix trie of conversations as a distributed z-fast trie.

A node is a distinct sequence of first turns, named by its depth and two 64-bit hashes of
the sequence (the exclusive or of hashes of place and turn, so running values of a
conversation come from window functions). Only the *compacted* trie is built: an edge ends
where conversations part or end, and at every multiple of ``BLOCK`` turns, so labels and
the rows of a conversation are bounded. The edges are one table, hashed by their *handle*:
the prefix at the 2-fattest depth (the one divisible by the greatest power of two) of those
that the edge covers.

Conversations are inserted in batches that double in size. Each block of a conversation
finds where it leaves the trie by fat binary search: it looks its prefix at the 2-fattest
depth of the open interval up among the handles; a hit moves the interval's lower end to
the edge's end, a miss its upper end below. Only what lies below the exit is new: edges
are cut at the exits, and the new prefixes of the batch, counted once each, make up new
edges (the prefixes of an edge have the same number of conversations and the same smallest).

Whole-subtree figures are summed by pointer doubling over the compacted trie: the rounds
grow with the logarithm of its height. At last the edges are expanded to all nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import drop, staged

BLOCK = 1024
NOBODY = hashlib.sha256(b"").hexdigest()

_NODE = "struct<d:long,h1:long,h2:long>"


def node(depth: Column, at: Column) -> Column:
    return F.struct(depth.cast("long").alias("d"), at["h1"].alias("h1"), at["h2"].alias("h2"))


def nowhere(spread: Column) -> Column:
    """A node that no trie holds, another one for each row: rows with nothing to look up
    are spread over the tasks of a join."""
    return F.struct(F.lit(-1).cast("long").alias("d"), F.xxhash64(spread).alias("h1"), F.lit(0).cast("long").alias("h2"))


def fattest(low: str, high: str) -> Column:
    """The number in (low, high] that the greatest power of two divides."""
    bit = f"(length(bin({low} ^ {high})) - 1)"
    return F.expr(f"shiftleft(shiftright({high}, {bit}), {bit})")


def numbered_turns(conversations: DataFrame, *, key: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Turns (conv, at from 0, h1, h2, chars) and conversations (conv, n).

    Turns are ordered by ``turn`` (NULL first), equal numbers by hashes of role and text;
    repeated turns are turns of their own. NULL roles and texts are empty. Rows without a
    key belong to no conversation. Turns are numbered by range partitions of all turns, so
    a conversation that holds a third of them is numbered by many tasks."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    rows = conversations.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv"), F.col(turn).alias("turn"), F.xxhash64(F.lit(1), *said).alias("h1"),
        F.xxhash64(F.lit(2), *reversed(said)).alias("h2"), F.length(said[1]).cast("long").alias("chars"))
    order = [F.asc_nulls_first("turn"), "h1", "h2"]
    dealt = staged(rows.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id()), "turns")
    parts = dealt.groupBy("conv", "part").agg(F.count("*").alias("n"))
    of = Window.partitionBy("conv")
    before = of.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = staged(parts.select("conv", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
                                 F.sum("n").over(of).alias("n")), "turn_starts")
    inside = F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order)) - 1
    turns = (dealt.withColumn("inside", inside).join(starts.drop("n").hint("merge"), ["conv", "part"])
             .select("conv", (F.col("start") + F.col("inside")).alias("at"), "h1", "h2", "chars"))
    return turns, starts.select("conv", "n").distinct()


def grafted(turns: DataFrame, convs: DataFrame, family: int = 100, most: int = 6) -> DataFrame:
    """Turns of rebuilt conversations: the first h turns of the family's first conversation
    (key less its remainder by ``family``; all it has if fewer), then the own turns after the
    first h, where h is crc32 of the key as text modulo ``most``."""
    turns = staged(turns, "numbered")
    own = convs.select("conv", "n", (F.col("conv") - F.pmod(F.col("conv"), F.lit(family))).alias("first"),
                       (F.crc32(F.col("conv").cast("string").cast("binary")) % most).alias("h"))
    heads = turns.where(F.col("at") < most - 1).withColumnRenamed("conv", "first")
    given = (own.select("conv", "first", "h").join(heads, "first").where("at < h").select("conv", "at", "h1", "h2", "chars"))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    # a conversation's own turns need only be moved down where the first one has fewer than h
    short = (own.join(convs.select(F.col("conv").alias("first"), F.col("n").alias("there")), "first", "left")
             .select("conv", (F.col("h") - F.least("h", F.coalesce("there", F.lit(0)))).alias("less")).where("less > 0"))
    kept = turns.where(F.col("at") >= h)
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("at"), F.lit(16)))
    shifts = short.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(15).cast("long"))))
    kept = salted.join(shifts, ["conv", "salt"], "left").select(
        "conv", (F.col("at") - F.coalesce("less", F.lit(0))).alias("at"), "h1", "h2", "chars")
    return given.unionByName(kept)


def _paths(turns: DataFrame) -> DataFrame:
    """(conv, block, top, top_c, path): for every block of a conversation's turns the node
    above it, the code points up to there, and hashes and code points up to each turn."""
    rows = turns.withColumn("block", F.expr(f"at div {BLOCK}")).withColumns(
        {x: F.xxhash64("at", F.lit(i), "h1", "h2") for i, x in enumerate(("x1", "x2"))})
    so_far = Window.partitionBy("conv", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.select("conv", "block", "at", F.bit_xor("x1").over(so_far).alias("h1"), F.bit_xor("x2").over(so_far).alias("h2"),
                      F.sum("chars").over(so_far).alias("c"))
    blocks = staged(run.groupBy("conv", "block").agg(F.array_sort(F.collect_list(F.struct("at", "h1", "h2", "c"))).alias("path")),
                    "trie_blocks")
    last = F.element_at("path", -1)
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = blocks.select("conv", "block", last["h1"].alias("h1"), last["h2"].alias("h2"), last["c"].alias("c"))
    all_before = {"h1": F.bit_xor("h1"), "h2": F.bit_xor("h2"), "c": F.sum("c")}
    above = ends.select("conv", "block", *(x.over(before).alias(f"t_{c}") for c, x in all_before.items())).where("block > 0")
    zero = [F.lit(0).cast("long").alias(f"t_{c}") for c in ("h1", "h2", "c")]
    own = blocks.where("block = 0").select("*", *zero).unionByName(blocks.where("block > 0").join(above, ["conv", "block"]))
    moved = F.transform("path", lambda x: F.struct(x["h1"].bitwiseXOR(F.col("t_h1")).alias("h1"), x["h2"].bitwiseXOR(F.col("t_h2")).alias("h2"),
                                                   (x["c"] + F.col("t_c")).alias("c")))
    top = F.struct((F.col("block") * BLOCK).alias("d"), F.col("t_h1").alias("h1"), F.col("t_h2").alias("h2"))
    return own.select("conv", "block", top.alias("top"), F.col("t_c").alias("top_c"), moved.alias("path"))


def exits(edges: DataFrame, paths: DataFrame, longest: int) -> DataFrame:
    """``paths`` with ``exit``, the depth at which each block leaves the trie, and ``into``,
    the end of the edge that it leaves midway (NULL: at a node). ``longest``: turns of the
    longest block."""
    at = lambda depth: F.get("path", (depth - 1 - F.col("top.d")).cast("int"))  # noqa: E731  hashes at a depth of the block
    spread = F.struct("conv", "block")
    table = edges.withColumn("f", fattest("top.d", "end.d")).select(
        node(F.col("f"), F.get("labels", (F.col("f") - F.col("top.d") - 1).cast("int"))).alias("probe"),
        F.col("end").alias("to"), F.col("top.d").alias("above"))
    known = edges.select(F.col("end").alias("top")).withColumn("known", F.lit(True))
    first = paths.where("block = 0").withColumn("known", F.lit(True)).unionByName(
        paths.where("block > 0").join(known, "top", "left").select(*paths.columns, F.coalesce("known", F.lit(False)).alias("known")))
    rows = first.withColumns({"lo": F.col("top.d"), "hi": F.when(F.col("known"), F.col("top.d") + F.size("path")).otherwise(F.col("top.d"))})
    for _ in range(longest.bit_length() + 1):
        rows = rows.withColumn("f", F.when(F.col("lo") < F.col("hi"), fattest("lo", "hi")))
        rows = rows.withColumn("probe", F.when(F.col("f").isNotNull(), node(F.col("f"), at(F.col("f")))).otherwise(nowhere(spread)))
        rows = rows.join(table, "probe", "left")
        there = at(F.col("to.d"))
        whole = F.coalesce((there["h1"] == F.col("to.h1")) & (there["h2"] == F.col("to.h2")), F.lit(False))
        hit = F.col("to").isNotNull()
        rows = rows.withColumns({
            "lo": F.when(hit & whole, F.col("to.d")).when(hit, F.col("above")).otherwise(F.col("lo")),
            # a hit that goes on beside the edge's end: the exit is there, the interval closes
            "hi": F.when(hit & whole, F.col("hi")).when(hit, F.col("above")).otherwise(F.coalesce(F.col("f") - 1, "hi")),
        }).drop("f", "probe", "to", "above")
    # the edge below the deepest node that matched, by its first prefix
    below = edges.select(node(F.col("top.d") + 1, F.get("labels", F.lit(0))).alias("probe"), F.col("end").alias("to"), "labels")
    step = at(F.col("lo") + 1)
    rows = rows.withColumn("probe", F.when(F.col("known") & step.isNotNull(), node(F.col("lo") + 1, step)).otherwise(nowhere(spread)))
    rows = rows.join(below, "probe", "left")
    own = F.slice("path", (F.col("lo") - F.col("top.d") + 1).cast("int"), F.greatest(F.size("labels"), F.lit(0)))
    same = F.zip_with(own, "labels", lambda x, y: (x["h1"] == y["h1"]) & (x["h2"] == y["h2"]))
    shared = F.coalesce(F.size(F.filter(same, lambda x: x)), F.lit(0))
    rows = rows.withColumn("exit", F.col("lo") + F.when(F.col("to").isNull(), 0).otherwise(shared))
    return rows.select(*paths.columns, "exit", F.when(F.col("exit") < F.col("to.d"), F.col("to")).alias("into"))


def cut(edges: DataFrame, places: DataFrame) -> DataFrame:
    """``edges`` cut at ``places`` (into: an edge's end, exit: a depth on it)."""
    cuts = places.groupBy(F.col("into").alias("end")).agg(F.collect_set("exit").alias("cuts"))  # fewer than BLOCK
    all_ = edges.join(cuts, "end", "left").withColumn(
        "cuts", F.array_sort(F.array_union(F.coalesce("cuts", F.array().cast("array<long>")), F.array("end.d"))))
    rows = all_.select("*", F.posexplode("cuts").alias("i", "to")).withColumn(
        "from", F.when(F.col("i") == 0, F.col("top.d")).otherwise(F.get("cuts", F.col("i") - 1)))
    label = lambda depth: F.get("labels", (depth - F.col("top.d") - 1).cast("int"))
    whole = F.col("i") == 0
    return rows.select(F.when(whole, F.col("top")).otherwise(node(F.col("from"), label(F.col("from")))).alias("top"),
                       F.when(whole, F.col("top_c")).otherwise(label(F.col("from"))["c"]).alias("top_c"),
                       node(F.col("to"), label(F.col("to"))).alias("end"),
                       F.slice("labels", (F.col("from") - F.col("top.d") + 1).cast("int"), (F.col("to") - F.col("from")).cast("int")).alias("labels"))


def grown(left: DataFrame) -> DataFrame:
    """Edges of what the blocks ``left`` (paths with exit) hold below their exits."""
    new = left.select("conv", "block", "top", "top_c", "path", "exit", F.posexplode(
        F.slice("path", (F.col("exit") - F.col("top.d") + 1).cast("int"), F.lit(BLOCK))).alias("i", "label"))
    before = F.get("path", (F.col("d") - F.col("top.d") - 2).cast("int"))
    above = F.when(before.isNull(), F.struct(F.col("top.h1").alias("h1"), F.col("top.h2").alias("h2"), F.col("top_c").alias("c"))).otherwise(before)
    rows = new.withColumn("d", F.col("exit") + F.col("i") + 1).select(
        "conv", "block", "d", "label.h1", "label.h2", "label.c", above.alias("above"))
    nodes = rows.groupBy("block", "d", "h1", "h2").agg(
        F.count("*").alias("n"), F.min("conv").alias("least"), F.min("c").alias("c"), F.min("above").alias("above"))
    made = nodes.groupBy("least", "n", "block").agg(F.array_sort(F.collect_list(F.struct("d", "h1", "h2", "c"))).alias("own"),
                                                    F.min(F.struct("d", "above")).alias("first"))
    labels = F.transform("own", lambda x: F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"), x["c"].alias("c")))
    end = F.element_at("own", -1)
    return made.select(node(F.col("first.d") - 1, F.col("first.above")).alias("top"), F.col("first.above.c").alias("top_c"),
                       node(end["d"], end).alias("end"), labels.alias("labels"))


def build(paths: DataFrame, batches: int = 2) -> DataFrame:
    """Edges (top, top_c, end, labels) of the compacted trie."""
    longest = paths.agg(F.max(F.size("path"))).first()[0] or 0
    # batch i is twice as large as batch i - 1
    batch = F.floor(F.log2(F.pmod(F.xxhash64(F.lit("batch"), "conv"), F.lit((1 << batches) - 1)) + 1.5))
    edges = None
    for i in range(batches):
        some = paths.where(batch == i)
        if edges is None:
            new = staged(grown(some.withColumn("exit", F.col("top.d"))), "trie")
        else:
            left = staged(exits(edges, some, longest), "trie_exits")
            new = staged(cut(edges, left.where("into is not null").select("into", "exit"))
                         .unionByName(grown(left)), "trie")
            drop(left)
            drop(edges)
        edges = new
    return edges


def _summed(nodes: DataFrame, sums: list[str]) -> DataFrame:
    """``nodes`` (node, anc, least, sums) with ``least`` and ``sums`` over their whole
    subtrees. In round i every node holds its descendants nearer than 2**i and points to
    its ancestor 2**i above, to which it gives what it holds."""
    now = staged(nodes, "trie_sums")
    while not now.where("anc is not null").isEmpty():
        given = now.where("anc is not null").groupBy(F.col("anc").alias("node")).agg(
            F.min("least").alias("g_least"), *(F.sum(c).alias(f"g_{c}") for c in sums))
        # the root has no ancestor: the many nodes right below it need not look
        key = F.when(F.col("anc.d") > 0, F.col("anc")).otherwise(nowhere(F.col("node")))
        up = now.select(F.col("node").alias("key"), F.col("anc").alias("next"))
        rows = now.withColumn("key", key).join(up, "key", "left").drop("key").join(given, "node", "left")
        new = staged(rows.select("node", F.col("next").alias("anc"), F.least("least", "g_least").alias("least"),
                                 *((F.col(c) + F.coalesce(f"g_{c}", F.lit(0))).alias(c) for c in sums)), "trie_sums")
        drop(now)
        now = new
    return now


def _digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ``conv`` of every ``node``, comma-joined. Tasks over ranges of
    (node, conv) join ids to long strings; a node's task only streams these."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            d, h1, h2 = (b.column(i).to_numpy() for i in range(3))
            new = (d[1:] != d[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            starts = pa.array([0, *(new.nonzero()[0] + 1).tolist()], pa.int32())
            ids = pa.ListArray.from_arrays(pa.concat_arrays([starts, pa.array([b.num_rows], pa.int32())]), b.column(3).cast(pa.string()))
            yield pa.record_batch([*(b.column(i).take(starts) for i in range(4)), pc.binary_join(ids, ",")],
                                  names=["d", "h1", "h2", "first", "ids"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, state = None, None
        row = lambda: pa.record_batch([*(pa.array([x], pa.int64()) for x in of), pa.array([state.hexdigest()])],
                                      names=["d", "h1", "h2", "sha"])
        for b in batches:
            for *at, ids in zip(*(b.column(i).to_pylist() for i in (0, 1, 2, 4))):
                if at == of:
                    state.update(b",")
                else:
                    if of is not None:
                        yield row()
                    of, state = at, hashlib.sha256()
                state.update(ids.encode())
        if of is not None:
            yield row()

    key = ["d", "h1", "h2"]
    rows = ends.select("node.*", "conv").repartitionByRange(*key, "conv").sortWithinPartitions(*key, "conv")
    joined = rows.mapInArrow(strings, "d long, h1 long, h2 long, first long, ids string")
    done = joined.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(hashes, "d long, h1 long, h2 long, sha string")
    return done.select(F.struct(*key).alias("node"), "sha")


def prefix_trie(turns: DataFrame, convs: DataFrame, batches: int = 2) -> DataFrame:
    """Every node of the prefix trie of the conversations ``convs`` (conv; those without
    turns end at the root), given their ``turns`` (conv, at, h1, h2, chars; see
    ``numbered_turns``).

    A node has the columns conv_id (its smallest member), depth, parent_conv_id (its
    parent's conv_id), n_convs (members), n_children, n_leaves (childless nodes of its
    subtree, itself included), saved_tokens (over its subtree: members less one, times the
    code points of the node's last text) and ends_sha256 (digest of the members that end
    there). Equal conversations share all nodes; an empty table gives no node.
    """
    paths = staged(_paths(turns), "trie_paths")
    edges = build(paths, batches)
    last = F.element_at("path", -1)
    found = paths.groupBy("conv").agg(F.max(F.struct((F.col("top.d") + F.size("path")).alias("d"), last["h1"].alias("h1"),
                                                     last["h2"].alias("h2"), last["c"].alias("c"))).alias("e"))
    e = F.coalesce("e", F.struct(*(F.lit(0).cast("long").alias(x) for x in ("d", "h1", "h2", "c"))))
    ends = staged(convs.select("conv").distinct().join(found, "conv", "left").select(
        "conv", node(e["d"], e).alias("node"), e["c"].alias("c")), "trie_ends")
    here = ends.groupBy("node").agg(F.count("*").alias("n"), F.min("conv").alias("least"), F.sum("c").alias("read"))
    children = edges.groupBy(F.col("top").alias("node")).agg(F.count("*").alias("children"))
    root = F.struct(*(F.lit(0).cast("long").alias(x) for x in ("d", "h1", "h2")))
    explicit = edges.select(F.col("end").alias("node"), F.col("top").alias("anc"), (F.get("labels", F.size("labels") - 1)["c"] - F.col("top_c")).alias("chars"))
    explicit = explicit.unionByName(convs.limit(1).select(root.alias("node"), F.lit(None).cast(_NODE).alias("anc"), F.lit(0).cast("long").alias("chars")))
    own = (explicit.join(here, "node", "left").join(children, "node", "left")
           .select("node", "anc", "least", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("read", F.lit(0)).alias("read"),
                   "chars", F.when(F.col("children").isNull(), 1).otherwise(0).cast("long").alias("leaves")))
    sums = _summed(own, ["n", "read", "chars", "leaves"])
    facts = staged(sums.drop("anc").join(children, "node", "left").join(_digests(ends), "node", "left").select(
        "node", "least", "n", "read", "chars", "leaves", F.coalesce("children", F.lit(0)).alias("children"),
        F.coalesce("sha", F.lit(NOBODY)).alias("sha")), "trie_facts")
    top = facts.where("node.d = 0").first()
    least = F.lit(top.least if top else None).cast("long")
    parents = facts.where("node.d > 0").select(F.col("node").alias("key"), F.col("least").alias("top_least"))
    below = edges.withColumn("key", F.when(F.col("top.d") > 0, F.col("top")).otherwise(nowhere(F.col("end"))))
    below = below.join(parents, "key", "left").join(facts, F.col("end") == F.col("node"))
    rows = below.select("*", F.posexplode("labels").alias("i", "label"))
    inner = F.col("i") < F.size("labels") - 1
    above = F.when(F.col("i") == 0, F.col("top_c")).otherwise(F.get("labels", F.col("i") - 1)["c"])  # code points up to the parent
    saved = (F.col("read") - F.col("n") * above) - (F.col("chars") - (above - F.col("top_c")))
    nodes = rows.select(
        F.col("least").alias("conv_id"), (F.col("top.d") + F.col("i") + 1).alias("depth"),
        F.when(F.col("i") > 0, F.col("least")).otherwise(F.coalesce("top_least", least)).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(inner, F.lit(1).cast("long")).otherwise(F.col("children")).alias("n_children"),
        F.col("leaves").alias("n_leaves"), saved.alias("saved_tokens"),
        F.when(inner, F.lit(NOBODY)).otherwise(F.col("sha")).alias("ends_sha256"))
    return nodes.unionByName(facts.where("node.d = 0").select(
        F.col("least").alias("conv_id"), F.col("node.d").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("read") - F.col("chars")).alias("saved_tokens"), F.col("sha").alias("ends_sha256")))
