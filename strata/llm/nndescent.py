"""Embedding near-duplicates by NN-descent.

A neighbour list per vector is started from random-projection buckets and refined
by joins of neighbours with neighbours: at every vector, all vectors that list it or
that it lists meet, and each keeps the nearest it has met. A list whose every entry is
above the threshold is saturated and may hide more links: it becomes twice as wide and
its vector is refined again, until its last entry is no link or it is ``widest`` wide
(in a large group of copies lists as long as the group would be its square). Recall is
audited on sampled queries against all vectors; refinement goes on until it is high
enough. Lists that are saturated even so may hide links to other groups (a group: the
vectors reachable over links). So every vector then meets the
nearest of other groups in new projection buckets, and groups are joined until no such
link is found and the audit is passed; links that the audit finds are used as well.
Links are counted by comparing a group's vectors in blocks that return counts only.

Vectors with equal label and components are one class, so copies cost nothing.
Cosines are computed in double precision; labels never mix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import drop, staged
from strata.llm.linking import connected_components


def _rows(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """(n, d) float64 matrix of a list column whose lists are equally long."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _even(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that all vectors (column vec) of one are equally long."""
    for b in batches:
        lengths = pc.list_value_length(b.column("vec")).to_numpy(zero_copy_only=False)
        for n in np.unique(lengths):
            yield b if (lengths == n).all() else b.filter(pa.array(lengths == n))


def usable(vec: Column, label: Column, key: Column) -> Column:
    """Does the row have a key, a label and a vector that can have a cosine?"""
    fine = F.forall(vec, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce(key.isNotNull() & label.isNotNull() & fine & F.exists(vec, lambda x: x != 0), F.lit(False))


def start_lists(classes: DataFrame, trees: int, width: int, leaf: int, worst: float = -2.0, seed: int = 7) -> DataFrame:
    """(u, v, sim): up to ``width`` nearest per vector within its bucket of each of
    ``trees`` random projections, if nearer than ``worst`` and of another component (column
    component); buckets hold about ``leaf`` vectors, larger ones are cut by hash."""
    most = int(classes.agg(F.max("bits")).first()[0] or 0)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _even(batches):
            x = _unit(_rows(b.column("vec")))
            signs = x @ np.random.default_rng(seed).standard_normal((x.shape[1], trees * max(1, most))) > 0
            used = np.arange(max(1, most))[None, :] < b.column("bits").to_numpy()[:, None]
            for t in range(trees):
                own = signs[:, t * max(1, most):(t + 1) * max(1, most)] & used
                code = (own * (1 << np.arange(max(1, most), dtype=np.int64))).sum(1)
                yield pa.record_batch([pa.array(np.full(len(x), t)), pa.array(code), b.column("id"), b.column("group"),
                                       b.column("component"), b.column("vec")],
                                      names=["tree", "code", "id", "group", "component", "vec"])

    coded = classes.select("id", "group", "bits", "component", "vec").mapInArrow(
        keys, "tree long, code long, id long, group string, component long, vec array<double>")
    bucket = ["tree", "group", "code"]
    parts = coded.groupBy(*bucket).agg(F.ceil(F.count("*") / (4 * leaf)).alias("parts"))
    dealt = coded.join(parts, bucket).withColumn("part", F.pmod(F.xxhash64("id", "tree", F.lit(seed)), F.col("parts")))

    def near(table: pa.Table) -> pa.Table:
        ids, x = table.column("id").to_numpy(), _unit(_rows(table.column("vec")))
        component, sims = table.column("component").to_numpy(), x @ x.T
        sims[component[:, None] == component[None, :]] = -3.0
        return _nearest(ids, sims, np.full(len(ids), worst), np.full(len(ids), width))

    return dealt.groupBy(*bucket, "part").applyInArrow(near, "u long, v long, sim double")


def _nearest(ids: np.ndarray, sims: np.ndarray, worst: np.ndarray, widths: np.ndarray) -> pa.Table:
    """The nearest others per row, at most ``widths`` of them, if nearer than ``worst``."""
    np.fill_diagonal(sims, -3.0)
    k = min(int(widths.max(initial=0)), len(ids) - 1)
    if k < 1:
        return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64()), "sim": pa.array([], pa.float64())})
    at = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    s = np.take_along_axis(sims, at, 1)
    order = np.argsort(-s, axis=1)
    at, s = np.take_along_axis(at, order, 1), np.take_along_axis(s, order, 1)
    ok = (s > worst[:, None]) & (np.arange(k)[None, :] < widths[:, None])
    return pa.table({"u": np.repeat(ids, k)[ok.ravel()], "v": ids[at].ravel()[ok.ravel()], "sim": s.ravel()[ok.ravel()]})


def best(edges: DataFrame, width: int, widths: DataFrame | None = None) -> DataFrame:
    """One row per vector: its nearest as an array of (sim, v), nearest first, and the
    ``width`` of the list, which ``widths`` (u, width) gives for the vectors that it names."""
    one = edges.groupBy("u", "v").agg(F.max("sim").alias("sim"))
    one = one.withColumn("width", F.lit(width)) if widths is None else one.join(widths, "u", "left").withColumn(
        "width", F.coalesce("width", F.lit(width)))
    place = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("sim"), "v"))
    top = one.withColumn("place", place).where(F.col("place") <= F.col("width"))
    lists = top.groupBy("u").agg(F.collect_list(F.struct("sim", "v")).alias("near"), F.max("width").alias("width"))
    return lists.select("u", F.sort_array("near", asc=False).alias("near"), "width")


def enlarged(lists: DataFrame, threshold: float, most: int) -> DataFrame:
    """Widths (u, width) for the next round: twice as wide where every entry of a full list is
    a link (a saturated list may hide more), up to ``most``."""
    full = (F.size("near") >= F.col("width")) & (F.element_at("near", -1)["sim"] >= threshold)
    return lists.select("u", F.when(full, F.least(2 * F.col("width"), F.lit(most))).otherwise(F.col("width")).alias("width"))


def refine(classes: DataFrame, lists: DataFrame, widths: DataFrame) -> DataFrame:
    """New (u, v, sim) found by joining neighbours with neighbours: every vector gathers the
    vectors it lists and, lowest hash first, as many that list it as its list is wide
    (``widths``: of the lists to come)."""
    forward = lists.select("u", F.explode("near").alias("e")).select(F.col("u").alias("w"), F.col("e.v").alias("id"))
    back = forward.select(F.col("id").alias("w"), F.col("w").alias("id"))
    place = F.row_number().over(Window.partitionBy("w").orderBy(F.xxhash64("w", "id"), "id"))
    room = widths.select(F.col("u").alias("w"), "width")
    back = back.withColumn("place", place).join(room, "w").where(F.col("place") <= F.col("width")).select("w", "id")
    met = forward.union(back).union(lists.select(F.col("u").alias("w"), F.col("u").alias("id"))).distinct()
    own = lists.select("u", "near").join(widths, "u").select(
        F.col("u").alias("id"), "width", F.when(F.size("near") >= F.col("width"), F.element_at("near", -1)["sim"]).otherwise(-2.0).alias("worst"))
    rows = met.join(classes.select("id", "vec").join(own, "id", "left"), "id")

    def near(table: pa.Table) -> pa.Table:
        ids, x = table.column("id").to_numpy(), _unit(_rows(table.column("vec")))
        return _nearest(ids, x @ x.T, table.column("worst").fill_null(-2.0).to_numpy(), table.column("width").fill_null(1).to_numpy())

    return rows.select("w", "id", "vec", "worst", "width").groupBy("w").applyInArrow(near, "u long, v long, sim double")


def links_across(classes: DataFrame, groups: DataFrame, trees: int, width: int, leaf: int, threshold: float, seed: int) -> DataFrame:
    """(a, b): links between groups that new projection buckets show."""
    own = classes.join(groups, "id", "left").withColumn("component", F.coalesce("component", "id"))
    return start_lists(own, trees, width, leaf, float(np.nextafter(threshold, -1)), seed).select(
        F.col("u").alias("a"), F.col("v").alias("b"))


def audit(classes: DataFrame, groups: DataFrame, threshold: float, queries: int, turn: int = 0) -> tuple[float, DataFrame]:
    """Share of the sampled vectors with links that have all of them in their own group,
    and the links (a, b) that leave it. Links are found by comparing the sample with all
    vectors of the label; it has ``queries`` of all vectors and one vector each of
    ``queries`` groups (lowest hashes)."""
    spark = classes.sparkSession
    low = F.xxhash64("id", F.lit(turn))
    some = classes.select("id").orderBy(low, "id").limit(queries)
    of_groups = groups.groupBy("component").agg(F.min_by("id", low).alias("id")).select("id").orderBy(low, "id").limit(queries)
    sample = classes.join(some.union(of_groups).distinct(), "id").select("id", "group", "vec").collect()
    of: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for g in {r.group for r in sample}:
        own = [r for r in sample if r.group == g]
        of[g] = np.array([r.id for r in own]), _unit(np.array([r.vec for r in own], np.float64))
    shared = spark.sparkContext.broadcast(of)  # at most ``queries`` vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _even(batches):
            ids, x, group = b.column("id").to_numpy(), _unit(_rows(b.column("vec"))), np.array(b.column("group").to_pylist())
            for g in set(group.tolist()) & set(shared.value):
                at = np.nonzero(group == g)[0]
                q, v = shared.value[g]
                i, j = np.nonzero(v @ x[at].T >= threshold)
                keep = q[i] != ids[at][j]
                yield pa.record_batch([pa.array(q[i][keep]), pa.array(ids[at][j][keep])], names=["a", "b"])

    true = classes.select("id", "group", "vec").mapInArrow(run, "a long, b long")
    true = staged(true, "nn_audit")
    one = (true.join(groups.select(F.col("id").alias("a"), F.col("component").alias("ca")), "a", "left")
           .join(groups.select(F.col("id").alias("b"), F.col("component").alias("cb")), "b", "left"))
    inside = F.coalesce(F.col("ca") == F.col("cb"), F.lit(False))
    got = one.groupBy("a").agg(F.bool_and(inside).alias("ok")).agg(F.count("*").alias("n"), F.count_if("ok").alias("ok")).first()
    return got.ok / got.n if got.n else 1.0, one.where(~inside).select("a", "b")


def links_within(classes: DataFrame, groups: DataFrame, threshold: float, block: int = 2048) -> DataFrame:
    """(id, linked): for every class of a group, how many other vectors of the group
    it links to, copies counted. Blocks of a group meet pairwise; only counts leave."""
    members = classes.join(groups, "id")
    parts = members.groupBy("component").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    cut = members.join(parts, "component").withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    each = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    rows = cut.select("component", F.col("own").alias("i"), each.alias("j"), F.lit(0).alias("side"), "id", "copies", "vec").union(
        cut.select("component", each.alias("i"), F.col("own").alias("j"), F.lit(1).alias("side"), "id", "copies", "vec"))

    def count(table: pa.Table) -> pa.Table:
        side, x = table.column("side").to_numpy(), _unit(_rows(table.column("vec")))
        ids, copies = table.column("id").to_numpy(), table.column("copies").to_numpy()
        a, b = np.nonzero(side == 0)[0], np.nonzero(side == 1)[0]
        linked = [((x[own] @ x[b].T >= threshold) & (ids[own][:, None] != ids[b][None, :])) @ copies[b]
                  for own in np.split(a, range(256, len(a), 256))]
        return pa.table({"id": ids[a], "linked": np.concatenate(linked).astype(np.int64)})

    counted = rows.groupBy("component", "i", "j").applyInArrow(count, "id long, linked long")
    return counted.groupBy("id").agg(F.sum("linked").alias("linked"))


def near_duplicates(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    threshold: float = 0.93, width: int = 8, widest: int = 64, trees: int = 8, leaf: int = 64,
                    recall: float = 0.98, rounds: int = 4, queries: int = 256) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector.

    Vectors of one label and length link at cosine >= ``threshold``; a component is
    named by its smallest vec_id, which is the one kept. Rows with a NULL key or label
    and vectors that are NULL, empty, zero or hold NULL or non-finite numbers link with
    nothing; repeated rows are copies of each other and count as links; an empty table
    gives no rows; other columns are not read.
    """
    own = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"),
                         F.col(vector).cast("array<double>").alias("vec"))
    own = own.withColumn("usable", usable(F.col("vec"), F.col("label"), F.col("id")))
    grouped = own.where("usable").withColumn("group", F.concat_ws("|", F.size("vec").cast("string"), "label"))
    classes = staged(grouped.groupBy("group", "vec").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "nn_vectors")
    sizes = classes.groupBy("group").agg(F.greatest(F.lit(0), F.ceil(F.log2(F.count("*") / leaf))).cast("int").alias("bits"))
    classes = staged(classes.join(sizes, "group"), "nn_classes")
    edges, lists, groups, widths = start_lists(classes.withColumn("component", F.col("id")), trees, width, leaf), None, None, None
    for turn in range(rounds + 1):
        if lists is not None:
            edges = edges.union(lists.select("u", F.explode("near").alias("e")).select("u", F.col("e.v").alias("v"), F.col("e.sim").alias("sim")))
        old, lists = lists, staged(best(edges, width, widths), "nn_lists")
        if old is not None:
            drop(old)
            drop(widths)
        widths = staged(enlarged(lists, threshold, widest), "nn_widths")
        grown = staged(lists.select("u", F.col("width").alias("was")).join(widths, "u").where("width > was").select("u"), "nn_grown")
        grows = not grown.isEmpty()
        if turn:
            links = (lists.select("u", F.explode("near").alias("e")).where(F.col("e.sim") >= threshold)
                     .select(F.col("u").alias("a"), F.col("e.v").alias("b")))
            groups = staged(connected_components(links), "nn_groups")
            if not grows and audit(classes, groups, threshold, queries)[0] >= recall:
                break
        if turn < rounds:
            edges = refine(classes, lists, widths)
            if grows:  # what a list let go while it was too short is met again in new buckets
                wide = min(widest, width << (turn + 1))
                again = start_lists(classes.withColumn("component", F.col("id")), 2, wide, leaf, seed=70 + turn)
                edges = edges.union(again.join(grown, "u", "left_semi"))
    turn, share = 0, 0.0
    while share < recall:  # every turn but the last joins groups
        turn += 1
        new = staged(links_across(classes, groups, trees, width, leaf, threshold, 7 + turn), "nn_across")
        if new.isEmpty():
            share, new = audit(classes, groups, threshold, queries, turn)
        links = staged(links.union(new), "nn_links")
        groups = staged(connected_components(links), "nn_groups")
    linked = links_within(classes, groups, threshold)
    named = classes.join(linked, "id", "left").join(groups, "id", "left").select(
        "group", "vec", F.coalesce("component", "id").alias("component_id"),
        (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    found = grouped.join(named, ["group", "vec"]).select(F.col("id").alias("vec_id"), "n_links", "component_id")
    alone = own.where("not usable").select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
                                           F.col("id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
