import random
import zlib

import numpy as np

from strata.llm import language, queries


def textbook_grams(text):
    out, kept = set(), []
    for c in text:
        c = c.lower()[0] if c.isalpha() else " "
        if c != " " or (kept and kept[-1] != " "):
            kept.append(c)
    s = " " + "".join(kept).strip() + "  "
    if not s.strip():
        return out
    for n in (1, 2, 3):
        out |= {s[i:i + n] for i in range(len(s) - n + 1)}
    return out - {"  "}


def unpack(g):
    letters = []
    while g:
        letters.append(chr(g & ((1 << 21) - 1)))
        g >>= 21
    return "".join(reversed(letters))


def test_grams_are_the_distinct_ones_of_the_whole_text():
    rng = random.Random(1)
    texts = ["", "  \n", "123 !", "a", "Ab ab", "Émile, naïve; 中文😀x", *("".join(rng.choice("abC é.1") for _ in range(rng.randrange(60))) for _ in range(200))]
    for t in texts:
        assert [unpack(g) for g in language.grams(t).tolist()] == sorted(textbook_grams(t), key=lambda g: (len(g), [ord(c) for c in g]))


def test_product_is_the_presence_kernel():
    texts = ["the cat sat", "the dog", "", "le chat", "42"]
    sets = [language.grams(t) for t in texts]
    known = np.unique(np.concatenate(sets))
    by_gram = np.array([[k in set(s.tolist()) for s in sets] for k in known.tolist()], float)
    got = language.Presence.of(sets, known).times(by_gram / np.sqrt(np.maximum(1, [len(s) for s in sets])))
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            x, y = textbook_grams(a), textbook_grams(b)
            assert abs(got[i, j] - (len(x & y) / (len(x) * len(y)) ** 0.5 if x and y else 0)) < 1e-12


def test_product_in_pieces():
    rng = np.random.default_rng(3)
    known, matrix = np.arange(3000), rng.random((3000, 2000))  # 2097 n-grams at once
    sets = [np.sort(rng.choice(4000, n, replace=False)) for n in (0, 900, 1200, 3900, 0, 5, 2500, 1)]
    got = language.Presence.of(sets, known).times(matrix)
    for s, row in zip(sets, got):
        assert np.allclose(row, matrix[s[s < 3000]].sum(0) / max(1, len(s)) ** 0.5)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries.QUERIES["op12_string_kernel_language"](spark, "/root/testdata/sf0.01")
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.collect()
    true = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert len(rows) == len(true) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    wrong = [r.doc_id for r in held if r.lang_pred != true[r.doc_id]]
    assert len(wrong) <= 0.03 * len(held), wrong
    assert all(0 <= r.score <= 1 for r in rows)


def test_edges(spark, edge_docs, no_docs):
    rows = language.identify(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (1, 2, 3))
    assert {by_id[i].lang_pred for i in (0, 4, 5, 6)} == {"en"}  # the only language taught
    assert language.identify(no_docs).count() == 0
    untaught = edge_docs.selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {(r.lang_pred, r.score) for r in language.identify(untaught).collect()} == {("und", 0.0)}
    # labels are never inputs of a prediction
    texts = [("der hund und die katze sind im haus", "de"), ("the dog and the cat are in the house", "en")] * 40
    docs = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(texts)], "doc_id long, text string, lang string")
    assert {(r.doc_id % 2, r.lang_pred) for r in language.identify(docs).collect()} == {(0, "de"), (1, "en")}
