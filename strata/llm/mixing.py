"""Mixing sources to target weights by hierarchical budgeting (DataFrame functions only).

Documents hang below the leaves of a tree (domain, language, source). A token budget
goes down the tree: a node shares its budget among its children by weight, no child
gets more than its subtree can give in ``epochs`` passes, and what a child cannot take
goes to its siblings by weight; since a node's own share is limited by its subtree in
the same way, a shortage reaches the ancestors' siblings only when all siblings are
full. Every leaf then takes a token-prefix of its seeded epochs: whole passes first,
and of the next pass the documents in the order of a seeded hash.

The prefix is found without sorting a leaf in one place: tokens are summed by leaf and
hash bucket, running totals over the buckets tell where the prefix ends, and
documents are ordered within (leaf, bucket) only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import NO_KEY, staged

Weights = dict[str, dict[str, int]]


def word_count(text: Column) -> Column:
    """Words between ASCII white space; 0 for NULL or empty text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def weight_of(level: str, weights: Weights) -> Column:
    """Whole-number weight of a node by its name; 1 unless given."""
    out = F.lit(1)
    for name, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == name, F.lit(int(w))).otherwise(out)
    return out.cast("long")


def share(nodes: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Water-filling: nodes (parents, name, weight, capacity, budget of the parent) get
    ``quota``. Sorted by capacity per weight, children are full up to the first that
    its siblings' common level does not fill; from there on they share by weight."""
    family = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    by_room = family.orderBy(F.col("capacity") / F.col("weight"), name)
    out = nodes.withColumn("_row", F.row_number().over(by_room))
    out = out.withColumn("_rest", F.col("budget") - F.coalesce(F.sum("capacity").over(
        by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = out.withColumn("_weights", F.sum("weight").over(by_room.rowsBetween(0, Window.unboundedFollowing)))
    open_ = F.col("_rest") * F.col("weight") <= F.col("capacity") * F.col("_weights")
    out = out.withColumn("_first", F.min(F.when(open_, F.col("_row"))).over(family))
    at_first = F.col("_row") == F.col("_first")
    out = out.withColumn("_r", F.max(F.when(at_first, F.col("_rest"))).over(family)) \
             .withColumn("_w", F.max(F.when(at_first, F.col("_weights"))).over(family))
    shared = F.least("capacity", F.expr("(weight * _r) div _w"))
    quota = F.when(F.col("_first").isNull() | (F.col("_row") < F.col("_first")), F.col("capacity")).otherwise(shared)
    return out.withColumn("quota", quota).drop("_row", "_rest", "_weights", "_first", "_r", "_w")


def budgets(leaves: DataFrame, levels: list[str], weights: Weights, tokens: int, epochs: int) -> DataFrame:
    """``leaves`` (levels, available) with ``quota`` tokens each."""
    leaves = leaves.withColumn("capacity", F.col("available") * epochs)
    parent = None
    for i, level in enumerate(levels):
        nodes = leaves.groupBy(*levels[:i + 1]).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.withColumn("weight", weight_of(level, weights))
        if parent is None:
            nodes = nodes.withColumn("budget", F.lit(tokens).cast("long"))
        else:
            nodes = nodes.join(parent.withColumnRenamed("quota", "budget"), levels[:i])
        parent = share(nodes, levels[:i], level).select(*levels[:i + 1], "quota")
    return leaves.drop("capacity").join(parent, levels)


def mix(docs: DataFrame, levels: dict[str, Column], weights: Weights, *, share_of_tokens: float | None = None,
        tokens: int | None = None, epochs: int = 1, seed: int = 0, key: str = "doc_id", text: str = "text",
        n_tokens: Column | None = None, identity: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows doc_id, levels, n_tokens, passes, taken of the documents in the mixture, and the
    columns ``keep``. ``n_tokens`` gives the tokens where they are known; documents are
    drawn by ``identity`` (default: the key).

    ``levels`` names the tree's levels from the top and gives their columns; NULL there
    is a node named ''. The budget is ``tokens``, or ``share_of_tokens`` of all tokens,
    at most ``epochs`` times all. ``passes`` counts the epochs a document is read in,
    the last perhaps in part; ``taken`` is the tokens taken over all. Tokens are words
    between white space. Documents without words take no part; NULL keys hash as ''; repeated
    rows are documents of their own; an empty table gives no rows; other columns are
    not read.
    """
    names = list(levels)
    drawn_by = F.coalesce(F.col(key).cast("long").cast("string") if identity is None else identity, F.lit(""))
    own = staged(docs.select(F.col(key).cast("long").alias("doc_id"), *keep, drawn_by.alias("_identity"),
                             *(F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()),
                             (word_count(F.col(text)) if n_tokens is None else n_tokens).alias("n_tokens")).where("n_tokens > 0"),
                 "mix_documents")
    leaves = staged(own.groupBy(*names).agg(F.sum("n_tokens").alias("available")), "mix_leaves")
    total = int(leaves.agg(F.sum("available")).first()[0] or 0)
    wanted = int(tokens if tokens is not None else share_in_tokens(total, share_of_tokens if share_of_tokens is not None else 1.0))
    quotas = budgets(leaves, names, weights, min(wanted, total * epochs), epochs)
    whole = F.expr("quota div available")
    quotas = quotas.select(*names, whole.alias("whole"), (F.col("quota") - whole * F.col("available")).alias("rest"))
    drawn = own.join(quotas, names)  # one row per leaf; AQE splits a hot leaf
    drawn = drawn.withColumn("_draw", F.md5(F.concat_ws(":", F.lit(str(seed)), (F.col("whole") + 1).cast("string"),
                                                        F.col("_identity")).cast("binary")))
    drawn = staged(drawn.withColumn("_bucket", F.substring("_draw", 1, 3)), "mix_drawn")
    order = Window.partitionBy(*names).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = drawn.groupBy(*names, "_bucket").agg(F.sum("n_tokens").alias("_sum"))
    starts = starts.select(*names, "_bucket", F.coalesce(F.sum("_sum").over(order), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*names, "_bucket").orderBy("_draw", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    placed = drawn.join(starts, [*names, "_bucket"])
    before = F.col("_start") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    last = F.greatest(F.lit(0), F.least("n_tokens", F.col("rest") - F.col("_before")))
    placed = placed.withColumn("_before", before).withColumn("_last", last)
    return placed.select("doc_id", *keep, *names, "n_tokens", (F.col("whole") + (F.col("_last") > 0).cast("int")).alias("passes"),
                         (F.col("whole") * F.col("n_tokens") + F.col("_last")).alias("taken")).where("taken > 0")


def keep_mixture(docs: DataFrame, levels: dict[str, Column], weights: Weights, *, key: str = "doc_id", text: str = "text",
                 **options) -> DataFrame:
    """The rows of ``docs`` that one pass of the mixture takes, with their columns.

    Every row is drawn and kept on its own: by its key if no other row has it, else by
    key, a hash of all its columns and its number among the rows that are equal in all
    columns. Of such rows as many stay as are drawn, whichever. Rows without words go.
    """
    docs = docs.select("*", F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("_doc"), F.xxhash64(*docs.columns).alias("_part"))
    named = {f"_l{i}": F.coalesce(c.cast("string"), F.lit("")) for i, c in enumerate(levels.values())}
    rows = docs.select("_doc", "_part", F.col(key).cast("long").alias("doc_id"), *(c.alias(n) for n, c in named.items()),
                       word_count(F.col(text)).alias("_tokens")).where("_tokens > 0")
    own = staged(rows.groupBy(*rows.columns).agg(F.count("*").alias("_copies")), "mix_rows")
    shared = own.groupBy("_doc").agg(F.sum("_copies").alias("_of_key")).where((F.col("_of_key") > 1) & (F.col("_doc") != NO_KEY))
    marked = own.where(F.col("_doc") != NO_KEY).join(shared, "_doc", "left").unionByName(
        own.where(F.col("_doc") == NO_KEY).withColumn("_of_key", F.lit(2).cast("long")))
    each = marked.withColumn("_number", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    alone = F.col("doc_id").cast("string")
    identity = F.when(F.col("_of_key").isNull(), alone).otherwise(F.concat_ws(":", alone, F.col("_part"), F.col("_number")))
    taken = mix(each, dict(zip(levels, map(F.col, named))), weights, key="doc_id", n_tokens=F.col("_tokens"), identity=identity,
                keep=("_doc", "_part"), epochs=1, **options)
    counts = taken.groupBy("_doc", "_part").agg(F.count("*").alias("_taken"))
    kept = staged(own.select("_doc", "_part", "_copies").join(counts, ["_doc", "_part"]), "mixture")
    whole = docs.join(kept.where("_taken = _copies").select("_doc", "_part"), ["_doc", "_part"], "left_semi")
    some = docs.join(kept.where("_taken < _copies").select("_doc", "_part", "_taken"), ["_doc", "_part"])
    some = some.groupBy(*some.columns).agg(F.count("*").alias("_n")).withColumn("_again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_taken"))))
    return whole.unionByName(some.select(*docs.columns)).drop("_doc", "_part")


def share_in_tokens(total: int, share: float) -> int:
    """Tokens of a share given to a millionth, in whole numbers."""
    return total * round(share * 1_000_000) // 1_000_000
