import duckdb
import pytest
from pyspark.sql import functions as F

from strata.llm import mixing
from strata.llm.queries import MIX_WEIGHTS, ORACLES, QUERIES, mix_levels


def fill(budget, nodes):
    """Whole-number water-filling of {name: (weight, capacity)}."""
    left, out = dict(nodes), {}
    while left:
        total = sum(w for w, _ in left.values())
        full = [k for k, (w, c) in left.items() if budget * w > c * total]
        if not full:
            return out | {k: min(c, budget * w // total) for k, (w, c) in left.items()}
        k = min(full, key=lambda k: left[k][1] / left[k][0])
        out[k] = left[k][1]
        budget -= left.pop(k)[1]
    return out


def test_budgets_go_to_siblings_before_ancestors(spark):
    leaves = [("a", "x", "1", 100), ("a", "x", "2", 5), ("a", "y", "1", 10), ("b", "x", "1", 1000), ("b", "z", "9", 3), ("c", "x", "1", 7)]
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, available long")
    weights = {"domain": {"a": 3}, "lang": {"x": 2}, "source": {"2": 5}}
    levels = ["domain", "lang", "source"]
    for tokens, epochs in ((50, 1), (200, 1), (200, 2), (1125, 1), (5000, 2)):
        tokens = min(tokens, sum(x[3] for x in leaves) * epochs)
        got = {(r.domain, r.lang, r.source): r.quota for r in mixing.budgets(df, levels, weights, tokens, epochs).collect()}

        def go(path, budget):
            depth = len(path)
            if depth == 3:
                return {path: budget}
            names = {x[depth] for x in leaves if x[:depth] == path}
            nodes = {n: (weights[levels[depth]].get(n, 1), epochs * sum(x[3] for x in leaves if x[:depth + 1] == (*path, n))) for n in names}
            return {k: v for n, b in fill(budget, nodes).items() for k, v in go((*path, n), b).items()}

        assert got == go((), tokens)
        assert tokens - 10 <= sum(got.values()) <= tokens


@pytest.mark.parametrize("edges", [False, True])
def test_mixture_equals_sql(spark, edge_docs, tmp_path, edges):
    sf = "/root/testdata/sf0.001"
    if edges:
        sf = str(tmp_path)
        edge_docs.write.parquet(f"{sf}/documents.parquet")
    got = QUERIES["op6_source_mixing"](spark, sf)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet{'/*.parquet' if edges else ''}'")
    want = db.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLES['op6_source_mixing']}) o").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.collect()) and want


def test_epochs_and_empty_tables(spark, no_docs):
    docs = spark.createDataFrame([(i, "w " * (i + 1), "en", "src1") for i in range(20)], "doc_id long, text string, lang string, source string")
    for epochs, tokens in ((1, 100), (3, 400), (3, 10_000)):
        got = mixing.mix(docs, {"lang": F.col("lang")}, {}, tokens=tokens, epochs=epochs).collect()
        assert sum(r.taken for r in got) == min(tokens, 210 * epochs)
        assert max(r.passes for r in got) - min([r.passes for r in got] + [0] * (len(got) < 20)) <= 1
    assert mixing.mix(no_docs, mix_levels(), MIX_WEIGHTS, share_of_tokens=0.5).count() == 0
    plan = mixing.mix(docs, mix_levels(), MIX_WEIGHTS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rows_without_a_key_or_with_a_repeated_one_are_drawn_on_their_own(spark):
    text = "ten words are in every one of these short texts"
    for rows in ([(None, f"{text} {i}") for i in range(400)], [(5, f"{text} {i}") for i in range(400)],
                 [(i // 2, f"{text} {i}") for i in range(400)], [(None, f"{text} same")] * 400, [(7, f"{text} same")] * 400,
                 [(i, f"{text} {i}") for i in range(400)]):
        docs = spark.createDataFrame([(k, t, "en", "src0", i % 1) for i, (k, t) in enumerate(rows)],
                                     "doc_id long, text string, lang string, source string, n_chars long")
        kept = mixing.keep_mixture(docs, mix_levels(), MIX_WEIGHTS, share_of_tokens=0.9, seed=1)
        assert kept.columns == docs.columns and kept.count() in (360, 361)
        assert kept.exceptAll(docs).count() == 0
