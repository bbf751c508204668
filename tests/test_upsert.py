import pytest
from pyspark.sql import functions as F

from strata.operators.upsert import (
    MergeCardinalityError, check_merge_cardinality, merge_upsert, unmatched_target,
)

SCHEMA = "k long, v string"


def rows(df):
    return sorted(df.collect(), key=lambda r: (r.k is None, r.k or 0, r.v or ""))


def test_null_keys_kept_on_both_sides(spark):
    t = spark.createDataFrame([(None, "t-null"), (1, "t1")], SCHEMA)
    s = spark.createDataFrame([(None, "s-null"), (1, "s1")], SCHEMA)
    got = [(r.k, r.v) for r in rows(merge_upsert(t, s, "k"))]
    assert got == [(1, "s1"), (None, "s-null"), (None, "t-null")]


def test_two_source_rows_for_one_target_row_is_an_error(spark):
    t = spark.createDataFrame([(1, "t1")], SCHEMA)
    s = spark.createDataFrame([(1, "a"), (1, "b")], SCHEMA)
    with pytest.raises(MergeCardinalityError):
        check_merge_cardinality(s, t, "k")


def test_duplicate_new_keys_are_fine(spark):
    t = spark.createDataFrame([(1, "t1")], SCHEMA)
    s = spark.createDataFrame([(2, "a"), (2, "b")], SCHEMA)
    check_merge_cardinality(s, t, "k")  # no target row matched twice


def test_upsert_laws(spark):
    t = spark.range(0, 100).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    s = spark.range(50, 150).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    m = merge_upsert(t, s, "k")
    # count = |t| + |s \ t|
    assert m.count() == 100 + 50
    # untouched target rows unchanged, matched ones replaced
    assert m.where("k < 50 AND v = 'old'").count() == 50
    assert m.where("k >= 50").where("v = 'new'").count() == 100
    # idempotent on non-null keys
    assert sorted(merge_upsert(m, s, "k").collect()) == sorted(m.collect())


def test_composite_keys_and_anti_join(spark):
    t = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (None, 3, "c")], "a long, b long, v string")
    s = spark.createDataFrame([(1, 2, "B"), (None, 3, "C")], "a long, b long, v string")
    um = sorted((r.a, r.b, r.v) for r in unmatched_target(t, s, ["a", "b"]).collect()
                if r.a is not None) + [
        (r.a, r.b, r.v) for r in unmatched_target(t, s, ["a", "b"]).collect() if r.a is None]
    assert um == [(1, 1, "a"), (None, 3, "c")]


def test_source_missing_target_column(spark):
    t = spark.createDataFrame([(1, "x")], SCHEMA)
    s = spark.createDataFrame([(1,)], "k long")
    with pytest.raises(ValueError, match="lacks target columns"):
        merge_upsert(t, s, "k")


def test_lakehouse_merge_history(lake, spark):
    t = spark.range(0, 10).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    s = spark.range(5, 15).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    r1 = lake.merge(t, "silver", "t", "k")
    r2 = lake.merge(s, "silver", "t", "k")
    r3 = lake.merge(s, "silver", "t", "k")
    assert (r1.operation, r1.added_records, r1.total_records) == ("append", 10, 10)
    assert (r2.operation, r2.added_records, r2.deleted_records, r2.total_records) == (
        "merge", 10, 5, 15)
    assert (r3.added_records, r3.deleted_records, r3.total_records) == (10, 10, 15)
    assert lake.read("silver", "t").count() == 15
    assert lake.read("silver", "t", version=1).count() == 10  # old versions stay readable
    h = lake.history("silver", "t").collect()
    assert [r.version for r in h] == [3, 2, 1]
    assert h[0].summary["added-records"] == "10"
    assert spark.table("silver.t").count() == 15
    rep = {r.table_name: (r.n_loads, r.merged) for r in lake.merge_report("silver").collect()}
    assert rep["t"] == (3, True)


def test_lakehouse_merge_rejects_cardinality(lake, spark):
    lake.create(spark.createDataFrame([(1, "a")], SCHEMA), "silver", "c")
    with pytest.raises(MergeCardinalityError):
        lake.merge(spark.createDataFrame([(1, "x"), (1, "y")], SCHEMA), "silver", "c", "k")
    assert lake.read("silver", "c").count() == 1  # current version untouched


def test_overwrite_partitions_keeps_other_partitions(lake, spark):
    df = spark.createDataFrame([(1, 2020, "a"), (2, 2021, "b")], "k long, y int, v string")
    lake.create(df, "silver", "p", partition_by=["y"])
    lake.overwrite_partitions(spark.createDataFrame([(3, 2021, "c")], "k long, y int, v string"),
                              "silver", "p", ["y"])
    got = sorted((r.k, r.y, r.v) for r in lake.read("silver", "p").collect())
    assert got == [(1, 2020, "a"), (3, 2021, "c")]


def test_partition_scoped_merge_equals_full_merge(spark, tmp_path):
    from strata.sources.lakehouse import Lakehouse
    t = spark.range(0, 60).select(F.col("id").alias("k"), (F.col("id") % 3).cast("int").alias("y"),
                                  F.lit("old").alias("v"))
    s = spark.range(40, 80).select(F.col("id").alias("k"), (F.col("id") % 3).cast("int").alias("y"),
                                   F.lit("new").alias("v")).where("y <> 0")
    full = Lakehouse(spark, str(tmp_path / "full"))
    part = Lakehouse(spark, str(tmp_path / "part"))
    for lk, scope in ((full, "table"), (part, "partitions")):
        lk.create(t, "silver", "t", partition_by=["y"])
        r = lk.merge(s, "silver", "t", "k", partition_by=["y"], scope=scope)
    a = sorted(map(tuple, full.read("silver", "t").select("k", "y", "v").collect()))
    b = sorted(map(tuple, part.read("silver", "t").select("k", "y", "v").collect()))
    assert a == b
    assert r.total_records == len(b)


def test_partition_scoped_merge_handles_moved_keys(spark, tmp_path):
    from strata.sources.lakehouse import Lakehouse
    lk = Lakehouse(spark, str(tmp_path / "mv"))
    lk.create(spark.createDataFrame([(1, 2020, "a"), (2, 2021, "b"), (3, 2019, "c"),
                                     (4, 2019, "d")], "k long, y int, v string"),
              "silver", "t", partition_by=["y"])
    # key 1 moves 2020 → 2021 (2020 becomes empty), key 3 moves 2019 → 2021
    r = lk.merge(spark.createDataFrame([(1, 2021, "m1"), (3, 2021, "m3")],
                                       "k long, y int, v string"),
                 "silver", "t", "k", partition_by=["y"], scope="partitions")
    got = sorted(map(tuple, lk.read("silver", "t").select("k", "y", "v").collect()))
    assert got == [(1, 2021, "m1"), (2, 2021, "b"), (3, 2021, "m3"), (4, 2019, "d")]
    assert "/v000001_" in r.location  # still in place, partition-scoped
    with pytest.raises(ValueError, match="rewritten in place"):
        lk.read("silver", "t", version=1)
    assert (r.added_records, r.deleted_records, r.total_records) == (2, 2, 4)


def test_partition_scoped_merge_sees_null_partitions(spark, tmp_path):
    from strata.sources.lakehouse import Lakehouse
    lk = Lakehouse(spark, str(tmp_path / "np"))
    ddl = "k long, y int, v string"
    lk.create(spark.createDataFrame([(1, None, "old"), (2, 2021, "b"), (3, 2020, "c"), (4, None, "d")], ddl),
              "silver", "t", partition_by=["y"])
    r = lk.merge(spark.createDataFrame([(1, 2021, "NEW"), (3, None, "x")], ddl), "silver", "t", "k",
                 partition_by=["y"], scope="partitions")
    got = sorted(map(tuple, lk.read("silver", "t").select("k", "y", "v").collect()))
    assert got == [(1, 2021, "NEW"), (2, 2021, "b"), (3, None, "x"), (4, None, "d")]
    assert (r.added_records, r.deleted_records, r.total_records) == (2, 2, 4)


def test_partition_scoped_merge_of_several_partition_columns(spark, tmp_path):
    from strata.sources.lakehouse import Lakehouse
    lk = Lakehouse(spark, str(tmp_path / "two"), register=False)
    ddl = "k long, y int, c string, v string"
    lk.create(spark.createDataFrame([(1, 2020, "a b", "o"), (2, 2021, "c", "o"), (3, 2020, None, "o")], ddl),
              "silver", "t", partition_by=["y", "c"])
    lk.merge(spark.createDataFrame([(1, 2021, "c", "n"), (3, 2022, "d", "n")], ddl), "silver", "t", "k",
             partition_by=["y", "c"], scope="partitions")
    got = sorted(map(tuple, lk.read("silver", "t").select("k", "y", "c", "v").collect()))
    assert got == [(1, 2021, "c", "n"), (2, 2021, "c", "o"), (3, 2022, "d", "n")]


def test_sequential_writers_lose_no_commit(spark, tmp_path):
    from strata.sources.lakehouse import Lakehouse
    root, ddl = str(tmp_path / "seq"), "k long, y int, v string"
    a, b = Lakehouse(spark, root, register=False), Lakehouse(spark, root, register=False)
    a.create(spark.createDataFrame([(1, 2020, "a")], ddl), "silver", "t", partition_by=["y"])
    for lk, k in ((a, 2), (b, 3), (a, 4)):
        lk.merge(spark.createDataFrame([(k, 2020, "m")], ddl), "silver", "t", "k", partition_by=["y"],
                 scope="partitions")
    h = [(r.version, r.total_records) for r in b.history("silver", "t").collect()]
    assert h == [(4, 4), (3, 3), (2, 2), (1, 1)]


def test_properties_survive_a_commit_of_another_writer(spark, tmp_path):
    from strata.sources.lakehouse import Lakehouse
    root = str(tmp_path / "props")
    Lakehouse(spark, root).create(spark.range(3), "props_ns", "t", properties={"team": "data"})
    Lakehouse(spark, root).replace(spark.range(4), "props_ns", "t")
    assert Lakehouse(spark, root).properties("props_ns", "t")["team"] == "data"
    names = [r[0] for r in Lakehouse(spark, root).list_namespaces().collect()]
    assert "props_ns" in names


def test_first_load_rejects_duplicate_keys(lake, spark):
    with pytest.raises(MergeCardinalityError):
        lake.merge(spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], SCHEMA), "silver", "first", "k")
    lake.merge(spark.createDataFrame([(1, "x"), (None, "y"), (None, "z")], SCHEMA), "silver", "first", "k")
    assert lake.read("silver", "first").count() == 3


def test_partition_scoped_merge_of_string_partitions(spark, tmp_path):
    from strata.sources.lakehouse import Lakehouse
    lk = Lakehouse(spark, str(tmp_path / "mvs"))
    lk.create(spark.createDataFrame([(1, "a/x", "a"), (2, "b", "b")], "k long, y string, v string"),
              "silver", "t", partition_by=["y"])
    r = lk.merge(spark.createDataFrame([(1, "b", "moved")], "k long, y string, v string"),
                 "silver", "t", "k", partition_by=["y"], scope="partitions")
    got = sorted(map(tuple, lk.read("silver", "t").select("k", "y", "v").collect()))
    assert got == [(1, "b", "moved"), (2, "b", "b")]
    assert "/v000001_" in r.location
    assert not any("a%2Fx" in f for f in lk.read("silver", "t").inputFiles())


def test_partition_merge_of_empty_batch_is_a_noop(spark, tmp_path):
    from strata.sources.lakehouse import Lakehouse
    lk = Lakehouse(spark, str(tmp_path / "e"))
    lk.create(spark.createDataFrame([(1, 2020, "a")], "k long, y int, v string"), "silver", "t",
              partition_by=["y"])
    empty = spark.createDataFrame([], "k long, y int, v string")
    r = lk.merge(empty, "silver", "t", "k", partition_by=["y"], scope="partitions")
    assert (r.version, r.added_records, r.total_records) == (1, 0, 1)
    assert lk.read("silver", "t").count() == 1


def test_two_writers_do_not_clobber_versions(spark, tmp_path):
    from strata.sources.lakehouse import Lakehouse
    root = str(tmp_path / "shared")
    a, b = Lakehouse(spark, root, register=False), Lakehouse(spark, root, register=False)
    t = spark.range(0, 10).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    a.create(t, "silver", "t")
    b.read("silver", "t")  # b caches version 1
    a.merge(spark.range(10, 12).select(F.col("id").alias("k"), F.lit("a2").alias("v")),
            "silver", "t", "k")  # version 2 by writer a
    r = b.merge(spark.range(20, 21).select(F.col("id").alias("k"), F.lit("b").alias("v")),
                "silver", "t", "k")
    assert r.version == 3
    got = sorted(x.k for x in a.read("silver", "t").collect())
    assert got == list(range(12)) + [20]  # b merged onto a's version 2


def test_leftover_of_a_killed_attempt_is_ignored(spark, tmp_path):
    from strata.sources.lakehouse import Lakehouse
    lk = Lakehouse(spark, str(tmp_path / "k"), register=False)
    lk.create(spark.range(3), "silver", "t")
    spark.range(99).write.parquet(lk._version_path("silver", "t", 2, "dead"))  # never committed
    r = lk.replace(spark.range(5), "silver", "t")
    assert r.version == 2 and lk.read("silver", "t").count() == 5


def test_history_commit_times_follow_versions(lake, spark):
    for i in range(3):
        lake.replace(spark.range(i + 1), "gold", "h")
    h = lake.history("gold", "h", newest_first=False).collect()
    assert [r.version for r in h] == [1, 2, 3]
    assert [r.committed_at for r in h] == sorted(r.committed_at for r in h)
    assert [r.operation for r in h] == ["overwrite"] * 3
    assert [r.summary["total-records"] for r in h] == ["1", "2", "3"]


def test_overwrite_partitions_history_counts(lake, spark):
    df = spark.createDataFrame([(1, 2020), (2, 2021), (3, 2021), (4, 2022)], "k long, y int")
    lake.create(df, "silver", "pc", partition_by=["y"])
    r = lake.overwrite_partitions(spark.createDataFrame([(9, 2021)], "k long, y int"),
                                  "silver", "pc", ["y"])
    assert (r.added_records, r.deleted_records, r.total_records) == (1, 2, 3)
    assert lake.read("silver", "pc").count() == 3


def test_compact_history_keeps_every_commit(lake, spark):
    for i in range(4):
        lake.replace(spark.range(i + 1), "gold", "c")
    before = [(r.version, r.total_records) for r in lake.history("gold", "c").collect()]
    removed = lake.compact_history()
    assert removed >= 4
    after = [(r.version, r.total_records) for r in lake.history("gold", "c").collect()]
    assert after == before == [(4, 4), (3, 3), (2, 2), (1, 1)]
    assert len(spark.read.parquet(lake.history_path).inputFiles()) == 1
    lake.replace(spark.range(9), "gold", "c")  # commits continue after compaction
    assert lake.history("gold", "c").first().version == 5


def _bucket_merge(spark, root, batch, n=2000, buckets=32):
    from strata.sources.lakehouse import Lakehouse
    lk = Lakehouse(spark, str(root))
    old = spark.range(n).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    old = old.unionByName(spark.createDataFrame([(None, "t-null")], SCHEMA))
    lk.merge(old, "silver", "b", "k", scope="buckets", buckets=buckets)
    return lk, lk.merge(batch, "silver", "b", "k", scope="buckets")


def test_bucket_merge_reads_and_writes_only_the_buckets_of_the_batch(spark, tmp_path):
    import os
    from strata.sources.lakehouse import BUCKET
    lk, first = _bucket_merge(spark, tmp_path / "one", spark.createDataFrame([], SCHEMA))
    assert (first.version, first.added_records, first.total_records) == (1, 0, 2001)  # nothing to do
    loc = first.location
    files = {f: os.stat(f).st_mtime_ns for f in (x.removeprefix("file:") for x in spark.read.parquet(loc).inputFiles())}
    rows = spark.read.parquet(loc).where("k IN (5, 77)").select(BUCKET).distinct().collect()
    touched = {r[0] for r in rows} | {r[0] for r in spark.createDataFrame([(5000,)], "k long").select(
        F.pmod(F.xxhash64("k"), F.lit(32)).cast("int")).collect()}
    r = lk.merge(spark.createDataFrame([(5, "new"), (77, "new"), (5000, "new")], SCHEMA), "silver", "b", "k", scope="buckets")
    assert (r.version, r.added_records, r.deleted_records, r.total_records) == (2, 3, 2, 2002)
    per = {x[BUCKET]: x["count"] for x in spark.range(2000).select(F.pmod(F.xxhash64("id"), F.lit(32)).cast("int").alias(BUCKET))
           .groupBy(BUCKET).count().collect()}
    h = lk.history("silver", "b").first().summary
    assert h["rewritten-buckets"] == str(len(touched)) and h["read-records"] == str(sum(per[b] for b in touched))
    after = {f: os.stat(f).st_mtime_ns for f in (x.removeprefix("file:") for x in spark.read.parquet(loc).inputFiles())}
    same = [f for f in files if f in after and after[f] == files[f]]
    assert {int(f.split(f"{BUCKET}=")[1].split("/")[0]) for f in files} - {int(f.split(f"{BUCKET}=")[1].split("/")[0]) for f in same} == touched
    got = {(x.k, x.v) for x in lk.read("silver", "b").collect()}
    assert lk.read("silver", "b").columns == ["k", "v"]
    assert got == {(i, "new" if i in (5, 77) else "old") for i in range(2000)} | {(5000, "new"), (None, "t-null")}


def test_bucket_merge_equals_the_whole_merge(spark, tmp_path):
    batch = spark.range(1500, 2500).select(F.col("id").alias("k"), F.lit("new").alias("v")).unionByName(
        spark.createDataFrame([(None, "s-null"), (None, "s-null")], SCHEMA))
    lk, r = _bucket_merge(spark, tmp_path / "all", batch)
    target = spark.range(2000).select(F.col("id").alias("k"), F.lit("old").alias("v")).unionByName(
        spark.createDataFrame([(None, "t-null")], SCHEMA))
    key = lambda x: (x.k is None, x.k or 0, x.v)
    assert sorted(lk.read("silver", "b").collect(), key=key) == sorted(merge_upsert(target, batch, "k").collect(), key=key)
    with pytest.raises(MergeCardinalityError):
        lk.merge(spark.createDataFrame([(1, "x"), (1, "y")], SCHEMA), "silver", "b", "k", scope="buckets")
    for wrong in ("table", "partitions"):
        with pytest.raises(ValueError, match="laid out by buckets"):
            lk.merge(batch, "silver", "b", "k", scope=wrong)
    with pytest.raises(ValueError, match="buckets of k"):
        lk.merge(batch, "silver", "b", "v", scope="buckets")


@pytest.mark.parametrize("scope", ["table", "partitions", "buckets"])
def test_a_commit_that_another_writer_overtook_raises(spark, tmp_path, monkeypatch, scope):
    from strata.sources import lakehouse
    root, ddl = str(tmp_path / scope), "k long, y int, v string"
    parts = ["y"] if scope == "partitions" else None
    a, b = (lakehouse.Lakehouse(spark, root, register=False) for _ in range(2))
    a.merge(spark.createDataFrame([(1, 2020, "a")], ddl), "silver", "t", "k", partition_by=parts, scope=scope)
    check = lakehouse.check_merge_cardinality

    def overtaken(*args):  # b commits between a's read of the version and its write
        monkeypatch.setattr(lakehouse, "check_merge_cardinality", check)
        b.merge(spark.createDataFrame([(2, 2020, "b")], ddl), "silver", "t", "k", partition_by=parts, scope=scope)
        return check(*args)

    monkeypatch.setattr(lakehouse, "check_merge_cardinality", overtaken)
    with pytest.raises(lakehouse.ConcurrentCommitError):
        a.merge(spark.createDataFrame([(3, 2020, "c")], ddl), "silver", "t", "k", partition_by=parts, scope=scope)
    assert sorted(r.k for r in a.read("silver", "t").collect()) == [1, 2]  # b's rows are not lost
    a.merge(spark.createDataFrame([(3, 2020, "c")], ddl), "silver", "t", "k", partition_by=parts, scope=scope)
    assert sorted(r.k for r in b.read("silver", "t").collect()) == [1, 2, 3]


def test_a_staged_batch_is_a_view_until_it_is_merged(spark, lake):
    lake.create(spark.createDataFrame([(1, "old"), (2, "old")], SCHEMA), "silver", "sv")
    with lake.staged_view(spark.createDataFrame([(2, "new"), (3, "new")], SCHEMA), "batch_of_sv") as batch:
        new = spark.sql("SELECT count(*) AS n FROM batch_of_sv b LEFT ANTI JOIN silver.sv t ON b.k = t.k").first().n
        assert new == 1
        lake.merge(batch, "silver", "sv", "k")
    assert not spark.catalog.tableExists("batch_of_sv")
    assert sorted(map(tuple, lake.read("silver", "sv").collect())) == [(1, "old"), (2, "new"), (3, "new")]
