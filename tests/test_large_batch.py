import pytest
from pyspark.sql import functions as F

from strata.operators.upsert import MergeCardinalityError
from strata.session import scratch_path
from strata.sources import bronze, lakehouse, partitioned
from strata.sources.lakehouse import Lakehouse

DDL = "id long, y int, v string"
OLD = [(1, 1, "a"), (2, 1, "b"), (3, 2, "c"), (4, None, "d"), (None, 1, "n"), (5, 3, "e"), (6, 2, "f")]


def merged(spark, batch, scope, monkeypatch, large, **kw):
    monkeypatch.setattr(lakehouse, "LARGE_BATCH", large)
    lake = Lakehouse(spark, scratch_path(spark, "large"), register=False)
    by = {"partition_by": ["y"]} if scope == "partitions" else {"buckets": 3}
    lake.merge(spark.createDataFrame(OLD, DDL), "l", "t", "id", scope=scope, **by)
    res = lake.merge(spark.createDataFrame(batch, DDL), "l", "t", "id", scope=scope, **by, **kw)
    rows = sorted(map(tuple, lake.read("l", "t").select("id", "y", "v").collect()), key=str)
    return rows, (res.added_records, res.deleted_records, res.total_records, res.summary)


@pytest.mark.parametrize("scope", ["partitions", "buckets"])
@pytest.mark.parametrize("batch", [
    [(1, 1, "A"), (3, 2, "C"), (7, 9, "new")],  # rows stay beside the batch's
    [(i, y, v.upper()) for i, y, v in OLD],  # nothing but the NULL key stays
    [(5, 1, "moved"), (4, 2, "moved"), (None, 2, "m"), (8, None, "x")],  # partitions are left
])
def test_a_large_batch_gives_what_a_small_one_gives(spark, monkeypatch, scope, batch):
    small = merged(spark, batch, scope, monkeypatch, 10**9)
    for stage in (True, False):
        assert merged(spark, batch, scope, monkeypatch, 2, stage=stage) == small


@pytest.mark.parametrize("scope", ["partitions", "buckets"])
def test_a_large_batch_may_not_match_a_row_twice(spark, monkeypatch, scope):
    with pytest.raises(MergeCardinalityError):
        merged(spark, [(1, 1, "x"), (1, 2, "y")], scope, monkeypatch, 1)
    fresh = merged(spark, [(9, 1, "x"), (9, 2, "y")], scope, monkeypatch, 1)  # no target row has the key
    assert fresh == merged(spark, [(9, 1, "x"), (9, 2, "y")], scope, monkeypatch, 10**9)


@pytest.mark.parametrize("scope", ["partitions", "buckets"])
def test_a_full_reload_neither_copies_the_batch_nor_moves_whole_target_rows(spark, monkeypatch, scope):
    staged, whole = [], []
    copy, join = Lakehouse._staged, lakehouse.unmatched_target
    monkeypatch.setattr(Lakehouse, "_staged", lambda self, df, commit, name: staged.append(name) or copy(self, df, commit, name))
    monkeypatch.setattr(lakehouse, "unmatched_target", lambda *a: whole.append(a) or join(*a))
    rows, _ = merged(spark, [(i, y, "z") for i, y, _ in OLD], scope, monkeypatch, 2, stage=False)
    assert len(rows) == len(OLD) + 1 and not whole and staged.count("rows") == 1  # the first load's


def test_few_partitions_are_written_without_an_exchange(spark, tmp_path, monkeypatch):
    seen = []
    hint = type(spark.range(1)).hint
    monkeypatch.setattr(type(spark.range(1)), "hint", lambda self, *a: seen.append(a) or hint(self, *a))
    df = spark.range(1000).withColumn("y", F.col("id") % 5)
    assert spark.read.parquet(bronze.land(df, str(tmp_path / "few"), partition_by=["y"], gather=False)).count() == 1000
    assert not seen
    many = df.withColumn("y", F.col("id") % 100)
    assert spark.read.parquet(bronze.land(many, str(tmp_path / "many"), partition_by=["y"], gather=False)).count() == 1000
    assert seen == [("rebalance", "y")]
    assert spark.conf.get(partitioned.WRITERS, "0") == "0"


def broadcast_ids(spark, monkeypatch, scope, batch, large):
    """Joins of a merge whose plans broadcast ids."""
    seen, frame = [], type(spark.range(1))
    join = frame.join

    def joined(self, other, *a):
        out = join(self, other, *a)
        if "id" in self.columns and "id" in other.columns:
            plan = out._jdf.queryExecution().executedPlan().toString()
            seen.extend(x for x in plan.split("\n") if "BroadcastHashJoin" in x and "[id#" in x)
        return out

    with monkeypatch.context() as m:
        m.setattr(frame, "join", joined)
        merged(spark, batch, scope, m, large)
    return seen


@pytest.mark.parametrize("scope", ["partitions", "buckets", "table"])
@pytest.mark.parametrize("batch", [
    [(i, y, "z") for i, y, _ in OLD],  # a full reload
    [(5, 1, "moved"), (4, 2, "moved"), (1, 1, "A")],  # partitions are left
    [(1, 1, "A"), (2, 1, "B"), (7, 2, "new"), (8, 2, "new"), (9, 3, "new")],  # rows stay beside the batch's
])
def test_the_keys_of_a_large_batch_are_not_broadcast(spark, monkeypatch, scope, batch):
    """The files are small, so the planner would, as it would the keys of wide tables, whose
    size it takes from compressed files, at any number of rows."""
    assert broadcast_ids(spark, monkeypatch, scope, batch, 10**9)
    assert not broadcast_ids(spark, monkeypatch, scope, batch, 2)
