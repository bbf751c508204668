"""Groups of linked records: candidate pairs from shared keys, verified links,
connected components, without expanding large groups into all their pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import drop, member, staged


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the partition's edges: each id with its least reachable one."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            u, v = find(u), find(v)
            root[max(u, v)] = min(u, v)
    pairs = [(x, find(x)) for x in root]
    pairs = [(x, r) for x, r in pairs if x != r]
    yield pa.record_batch([pa.array([x for x, _ in pairs], pa.int64()), pa.array([r for _, r in pairs], pa.int64())],
                          names=["u", "v"])


def connected_components(links: DataFrame, part_edges: int = 200_000) -> DataFrame:
    """(id, component) of the ids in ``links`` (a, b): the smallest id reachable.

    Parts of about ``part_edges`` links are first contracted by union-find, each in a
    task of its own; what several parts leave goes through alternating large-star and
    small-star steps, each a grouped minimum and a join written to shared scratch, so no
    neighbourhood is gathered and the rounds grow with the logarithm of the longest chain.
    """

    def star(edges: DataFrame) -> DataFrame:
        least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return edges.join(least, "u")

    def step(edges: DataFrame) -> DataFrame:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = star(large)  # every v is below its u
        return (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                .union(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())

    raw = staged(links.select(F.col("a").alias("u"), F.col("b").alias("v")), "links")
    parts = max(1, -(-raw.count() // part_edges))
    edges = staged(raw.coalesce(parts).mapInArrow(_contract, "u long, v long"), "links")
    drop(raw)
    print_of = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    now = print_of(edges) if parts > 1 else (0,)
    while now[0]:
        new = staged(step(edges), "links")
        was, now = now, print_of(new)
        drop(edges)
        edges = new
        if was == now:
            break
    return (edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .union(edges.select("v", "v").distinct()))


def compare(pairs: DataFrame, items: DataFrame, ddl: str, linked: Callable, most: int = 5_000) -> DataFrame:
    """The pairs (a, b) for which ``linked(values of a, values of b)``, given many pairs at once, says so.

    ``items`` (id, value) are moved to the pairs of their a; the pairs of one a are
    dealt to several groups of about ``most``, each with its own copy of a's value, and
    streamed, so a hot a neither meets in one task nor is held in memory.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / most).alias("parts"))
    dealt = pairs.join(sizes, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"), "b")
    wanted = (sizes.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
                           F.lit(0).alias("kind"), F.col("a").alias("id"))
              .union(dealt.select("a", "part", F.lit(1).alias("kind"), F.col("b").alias("id"))))
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    values = items.where(member(ids)("id")).select("id", "value")  # only those that may be asked for are moved
    rows = (wanted.join(values.hint("merge"), "id").repartition("a", "part")
            .sortWithinPartitions("a", "part", "kind").select("a", "part", "kind", "id", "value"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, value = None, None
        for b in batches:
            left, right, own, others = [], [], [], []
            values = b.column(4)
            for i, (a, kind, other) in enumerate(zip(b.column(0).to_pylist(), b.column(2).to_pylist(),
                                                     b.column(3).to_pylist())):
                if kind == 0:
                    first, value = a, values[i]
                elif first == a:
                    left.append(a)
                    right.append(other)
                    own.append(value)
                    others.append(values[i])
            same = linked(own, others)
            left, right = ([x for x, ok in zip(ids, same) if ok] for ids in (left, right))
            yield pa.record_batch([pa.array(left, pa.int64()), pa.array(right, pa.int64())], schema=schema)

    return rows.mapInArrow(run, ddl)


def linked_groups(postings: DataFrame, verify: Callable[[DataFrame], DataFrame], *, extras: list[str] = (),
                  admissible: Callable[[str, str], Column] | None = None,
                  enough: Callable[[str, str, Column], Column] | None = None, central: list[str] = (),
                  places: list[str] = (), rounds: int = 1, centres: int = 1) -> DataFrame:
    """(id, component) of linked ids, from postings (key, id, extras), one row per key and id.

    Two ids are candidates if they share a key, ``admissible(prefix of a, prefix of b)``
    holds on their extras (and ``places``, columns of the single posting) and
    ``enough(a, b, number of such keys)`` does. First come
    ``rounds`` in which every key's ids are only compared with one centre of the key
    (the least by the extras ``central``, later ones by a hash); keys of more than 64 ids have
    ``centres``, the least of as many parts of their ids. Then every candidate pair whose two ids are still in
    different components is compared, so no link between components is lost, while
    pairs inside a component, which cannot change the result, are never made.
    """
    extras = list(extras)
    links, groups = None, None
    side = lambda p: [F.col("id").alias(p), F.col("comp").alias(f"{p}_comp"), *(F.col(x).alias(f"{p}_{x}") for x in [*extras, *places])]
    for turn in range(rounds + 1):
        if groups is None:
            rows = postings.withColumn("comp", F.col("id"))
        else:
            rows = postings.join(groups.hint("merge"), "id", "left").withColumn("comp", F.coalesce("component", "id"))
        family = Window.partitionBy("key")
        centre = F.min_by(F.struct("id", "comp", *extras, *places), F.struct(
            *(central if turn == 0 else ()), F.xxhash64("id", F.lit(turn)), "id")).over(family)
        apart = F.min("comp").over(family) < F.max("comp").over(family)
        rows = rows.select("key", "id", "comp", *extras, *places).withColumn("_apart", apart)
        if turn < rounds and centres > 1:
            parts = F.when(F.count("*").over(family) > 64, centres).otherwise(1)
            own = rows.withColumn("_deal", F.pmod(F.xxhash64(F.lit(turn), "id"), parts)).where("_apart")
            heads = own.groupBy("key", "_deal").agg(F.min_by(F.struct(*side("a")), F.struct(*central, "id")).alias("_centre"))
            met = own.select("key", *side("b")).join(heads.select("key", "_centre.*"), "key").where("a_comp <> b_comp")
        elif turn < rounds:
            met = rows.withColumn("_centre", centre).where("_apart").select(
                *side("b"), F.col("_centre.id").alias("a"), F.col("_centre.comp").alias("a_comp"),
                *(F.col(f"_centre.{x}").alias(f"a_{x}") for x in [*extras, *places]))
            met = met.where("a_comp <> b_comp")
        else:
            own = rows.where("_apart")
            met = own.select("key", *side("a")).join(own.select("key", *side("b")), "key").where("a_comp < b_comp")
        if admissible is not None:
            met = met.where(admissible("a", "b"))
        keys = ["a", "b", *(f"{p}_{x}" for p in "ab" for x in extras)]
        pairs = met.groupBy(*keys).agg(F.count("*").alias("hits"))
        if enough is not None:
            pairs = pairs.where(enough("a", "b", F.col("hits")))
        pairs = staged(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
        new = verify(pairs)
        links = staged(new if links is None else links.union(new), "verified")
        drop(pairs)
        groups = staged(connected_components(links), "groups")
    return groups
