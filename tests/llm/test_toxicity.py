from pyspark.sql import functions as F

from strata.llm import toxicity
from strata.llm.common import table

SF = "/root/testdata/sf0.01"


def test_features():
    f = dict(zip(toxicity.FEATURES, toxicity.features_of("You IDIOT, you 1d10t and st*pid cl0wn!!", frozenset({"and"}))))
    assert f["seed_density"] > 0.3 and f["near_you_density"] > 0 and f["disguised_density"] > 0
    assert f["learned_density"] > 0 and f["capital_rate"] > 0 and f["exclamation_rate"] > 0 and f["shout_rate"] > 0
    for empty in ("", "  \n"):
        assert toxicity.features_of(empty, frozenset()) == [0.0] * len(toxicity.FEATURES)
    assert toxicity.undisguised("i.d.i.o.t") == "idiot" and toxicity.undisguised("stuuuupid") == "stupid"


def test_held_out_accuracy_and_pipeline_filter(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = toxicity.score_documents(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").toPandas()
    held = got[got.held_out]
    ranks = held.score.rank()
    bad = held.toxic == 1
    auc = (ranks[bad].sum() - bad.sum() * (bad.sum() + 1) / 2) / (bad.sum() * (~bad).sum())
    assert auc > 0.9 and (held.predicted[~bad] == 0).mean() > 0.97
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()


def test_every_row_goes_by_its_own_text(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    scores = toxicity.score_documents(docs, labels)
    ends = scores.where("score >= 0.5").limit(3).union(scores.where("score < 0.2").limit(3)).select("doc_id", "score")
    some = docs.join(ends, "doc_id").withColumn("row", F.col("doc_id")).collect()
    odd = [(key, r.text, r.row) for r in some for key in (None, -5)]
    model_docs = docs.select("doc_id", "text").withColumn("row", F.lit(None).cast("long"))
    odd_docs = spark.createDataFrame(odd, "doc_id long, text string, row long")
    kept = toxicity.keep_clean(model_docs.unionByName(odd_docs), labels).where("row is not null").collect()
    assert sorted((str(r.doc_id), r.row) for r in kept) == sorted((str(k), r.row) for r in some if r.score < 0.5 for k in (None, -5))


def test_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2 if i < 9 else None) for i in range(11)] + [(None, 1), (3, 0)], "doc_id long, toxic int")
    got = toxicity.score_documents(edge_docs, labels).collect()
    assert len(got) == edge_docs.count() and all(0 <= r.score <= 1 for r in got)
    one_class = toxicity.score_documents(edge_docs, labels.where("toxic = 1")).collect()
    assert {r.score for r in one_class} == {1.0}
    unlabelled = toxicity.score_documents(edge_docs, labels.limit(0)).collect()
    assert {r.score for r in unlabelled} == {0.0}
    assert toxicity.score_documents(no_docs, labels).count() == 0
    kept = toxicity.keep_clean(edge_docs, labels.where("toxic = 1"))
    assert kept.columns == edge_docs.columns and kept.count() == 0
    assert toxicity.keep_clean(edge_docs, labels.limit(0)).count() == edge_docs.count()
    assert edge_docs.where(F.lit(False)).count() == 0
