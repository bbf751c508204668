import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from strata.llm import toxicity
from strata.llm.common import staged, table
from test_jaccard_lines import components, deduped, shingles

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("name,stage", C.STAGES)
def test_stage_edges(spark, edge_docs, no_docs, name, stage):
    for docs in (edge_docs, edge_docs.select(*COLUMNS), no_docs):
        out = stage(spark, docs, SF)
        rows = out.collect()
        if stage is not C.packed:
            assert out.columns == docs.columns
        if docs is no_docs:
            assert not rows


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_every_stage_equals_brute_force_on_its_own_input(spark):
    assert [f for _, f in C.STAGES] == [C.without_toxic, C.without_repeated_lines, C.without_near_copies, C.mixed, C.packed]
    docs = table(spark, SF, "documents")
    before = rows_of(docs)

    clean = staged(C.without_toxic(spark, docs, SF), "test_clean")
    scores = toxicity.score_documents(docs, table(spark, SF, "labels"))
    assert set(rows_of(clean)) == set(before) - {r.doc_id for r in scores.where("score >= 0.5").collect()}
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    gone = set(before) - set(rows_of(clean))
    assert all(labels.get(d, 1) for d in gone)  # no labelled clean document went

    apart = staged(C.without_repeated_lines(spark, clean, SF), "test_lines")
    places = [(d, i, x) for d, r in sorted(rows_of(clean).items()) for i, x in enumerate((r.text or "").split("\n"))]
    left = deduped(places)
    whole = {d: (r.text or "").split("\n") for d, r in rows_of(clean).items()}
    expected = {d: "\n".join(left[d]) for d in whole if len(left[d]) == len(whole[d]) or any(x.strip(" ") for x in left[d])}
    got = rows_of(apart)
    assert {d: r.text for d, r in got.items()} == expected
    assert all(r.n_chars == len(r.text) for r in got.values())

    single = staged(C.without_near_copies(spark, apart, SF), "test_single")
    sets = {d: shingles(r.text, 5) for d, r in got.items()}
    of = components(sorted(sets), lambda a, b: bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    assert set(rows_of(single)) == {d for d in sets if of[d] == d}

    mixture = staged(C.mixed(spark, single, SF), "test_mixed")
    from strata.llm import oracle_sql
    db = duckdb.connect()
    db.register("documents", single.toPandas())
    sql = (oracle_sql.SOURCE_MIXING.replace("* 600000 //", "* 900000 //").replace("SUM(available) * 3 AS", "SUM(available) * 1 AS"))
    assert set(rows_of(mixture)) == {r[0] for r in db.execute(f"SELECT doc_id FROM ({sql}) o").fetchall()}
    assert 0 < mixture.count() < single.count()

    pieces = C.packed(spark, mixture, SF).collect()
    used, total = {}, 0
    for r in pieces:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
        total += r.length
    for places in used.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    assert {r.doc_id for r in pieces} == set(rows_of(mixture)) and len(used) <= -(-total // 2048) + 2


def test_run_gives_the_packed_sequences(spark):
    out = C.run(spark, SF)
    assert out.where(F.col("offset") + F.col("length") > 2048).count() == 0
    assert set(out.columns) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} and out.count() > 0
