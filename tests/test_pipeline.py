from strata.plans import pipeline
from strata.sources.lakehouse import Lakehouse

SF = "/root/testdata/sf0.001"


def test_run_silver_then_gold_then_rerun_merges(spark, tmp_path):
    root = str(tmp_path)
    bronze = pipeline.land_roles(spark, SF, f"{root}/bronze")
    lake = Lakehouse(spark, f"{root}/lake")
    v1, report = pipeline.run_silver(spark, bronze, lake, "2024-06-01 00:00:00", "2001-12-31")
    assert all(ok for _, ok, _ in report.stages)
    counts = {r.table_name: r.n_rows for r in v1.collect()}
    assert counts["posts"] == spark.read.parquet(f"{SF}/orders.parquet").count()
    # a second run merges the same batch: keyed tables keep their size
    v2, report = pipeline.run_silver(spark, bronze, lake, "2024-06-02 00:00:00", "2001-12-31")
    assert all(ok for _, ok, _ in report.stages), report.stages
    again = {r.table_name: (r.n_rows, r.n_loads) for r in v2.collect()}
    for t in ("comments", "users", "badges", "posts"):
        assert again[t] == (counts[t], 2)
        dates = {str(r.load_date) for r in lake.read("silver", t).select("load_date").distinct().collect()}
        assert dates == {"2024-06-02 00:00:00"}, t
    gold = {r.table_name: r.n_rows for r in pipeline.run_gold_activity(lake).collect()}
    assert set(gold) == set(pipeline.GOLD_ACTIVITY) and all(n > 0 for n in gold.values())
    assert spark.table("gold.post_summary").count() == gold["post_summary"]


def test_medallion_raises_when_a_silver_stage_fails(spark, tmp_path, monkeypatch):
    import pytest
    from pyspark.sql import functions as F

    def twice(bronze_root, make=pipeline.land_roles):
        out = make(spark, SF, bronze_root)
        users = spark.read.parquet(f"{out}/users").limit(1).withColumn("DisplayName", F.lit(b"again"))
        users.select(*spark.read.parquet(f"{out}/users").columns).write.mode("append").parquet(f"{out}/users")
        return out

    monkeypatch.setattr(pipeline, "land_roles", lambda spark, sf, root: twice(root))
    with pytest.raises(RuntimeError, match="silver.users"):
        pipeline.run_medallion(spark, SF, str(tmp_path / "m"), "2024-06-01 00:00:00", "2001-12-31")


def test_damaged_files_of_a_year_are_left_out_and_named(spark, tmp_path):
    root = pipeline.land_roles(spark, SF, str(tmp_path / "bronze"))
    years = sorted(int(p.name[5:]) for p in (tmp_path / "bronze" / "comments").glob("year=*"))
    one, gone = years[1], years[2]
    whole = pipeline.yearly_silver(spark, root, "comments", "2024-06-01 00:00:00", years)
    per_year = {r.comment_year: r["count"] for r in whole.groupBy("comment_year").count().collect()}
    folder = tmp_path / "bronze" / "comments" / f"year={one}"
    good = sorted(folder.glob("*.parquet"))
    (folder / "broken.parquet").write_bytes(b"PAR1 not a footer PAR1")
    data = good[0].read_bytes()
    n = len(data) // 3
    (folder / "torn.parquet").write_bytes(data[:n // 4] + b"\xff" * 2 * n + data[2 * n + n // 4:])  # pages, not the footer
    for f in (tmp_path / "bronze" / "comments" / f"year={gone}").glob("*.parquet"):
        f.write_bytes(b"PAR1")
    report = pipeline.StageReport()
    got = pipeline.yearly_silver(spark, root, "comments", "2024-06-01 00:00:00", [*years, 1990], report, True)
    assert {r.comment_year: r["count"] for r in got.groupBy("comment_year").count().collect()} == {
        y: n for y, n in per_year.items() if y != gone}
    failed = {name.rsplit("/", 1)[-1]: note for name, ok, note in report.stages if not ok}
    assert set(failed) == {"broken.parquet", "torn.parquet", f"comments_{gone}", "comments_1990"}
    assert "readable rows" in failed["torn.parquet"]


def test_cli_keeps_the_sessions_settings(spark):
    from strata.session import get_session
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        assert get_session().conf.get("spark.sql.shuffle.partitions") == "400"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    import pytest
    from strata import session
    monkeypatch.setattr(session, "_is_local", lambda spark: False)
    monkeypatch.setattr(session, "CHECKPOINT_CONF", "spark.checkpoint.dir.unset")
    with pytest.raises(RuntimeError, match="not set"):
        session.checkpoint_root(spark)


def test_listing_errors_are_raised(spark, monkeypatch):
    import pytest
    from strata.sources import fs
    monkeypatch.setattr(fs, "_hadoop", lambda spark, path: (None, None))
    assert not fs.exists(spark, "/tmp/no-such-folder-here")
    with pytest.raises(Exception):
        fs.exists(spark, "noscheme://somewhere/else")


def test_cli_medallion(spark, tmp_path, capsys):
    from strata.__main__ import main
    main(["medallion", "--source", SF, "--root", str(tmp_path), "--as-of", "2001-12-31"])
    out = capsys.readouterr().out
    assert "user_engagement" in out and "badge_distribution" in out


def test_gold_run_shares_per_user_pieces_exactly(spark, tmp_path):
    from pyspark.sql import functions as F
    from strata.operators import gold
    root = str(tmp_path)
    bronze = pipeline.land_roles(spark, SF, f"{root}/bronze")
    lake = Lakehouse(spark, f"{root}/lake")
    pipeline.run_silver(spark, bronze, lake, "2024-06-01 00:00:00", "2001-12-31")
    pipeline._run_gold(lake, pipeline.GOLD_USER_METRICS + pipeline.GOLD_ACTIVITY,
                       "2024-06-02 00:00:00")
    s = pipeline._silver(lake)
    direct = {
        "user_engagement": gold.user_engagement_score(s["users"], s["posts"], s["comments"],
                                                      s["badges"], "2024-06-02 00:00:00"),
        "user_comment_engagement": gold.user_comment_engagement(s["comments"], s["users"]),
    }
    for name, want in direct.items():
        got = lake.read("gold", name).select(*want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, name
    assert lake.read("work", "comments_per_user").where(F.col("user_id").isNull()).count() == 1


def test_refresh_by_changed_keys_equals_the_full_rebuild(spark, tmp_path):
    from pyspark.sql import functions as F

    from strata.plans import registry as R
    run_ts, now = "2024-06-02 00:00:00", R.silvers(spark, SF)
    lake, full = Lakehouse(spark, str(tmp_path / "a"), register=False), Lakehouse(spark, str(tmp_path / "b"), register=False)
    first = {t: df.where(F.col(pipeline.SILVER_KEYS[t][0]) % 5 != 0) for t, df in now.items()}
    second = {t: df.where(F.col(pipeline.SILVER_KEYS[t][0]) % 50 == 0) for t, df in now.items()}
    second["posts"] = now["posts"].where("post_id % 50 <= 1").withColumn("owner_user_id", F.lit(7).cast("long")).withColumn(
        "post_month", F.lit(None).cast("int"))  # one owner takes over, others may lose their last post
    second["comments"] = now["comments"].where("comment_id % 50 <= 1").withColumn("user_id", F.lit(None).cast("long"))
    for lk in (lake, full):
        changes = {t: pipeline.load_tracked(lk, t, df) for t, df in first.items()}
        if lk is lake:
            pipeline.refresh_gold(lk, changes, run_ts=run_ts)
        changes = {t: pipeline.load_tracked(lk, t, df) for t, df in second.items()}
    pipeline.refresh_gold(lake, changes, run_ts=run_ts)
    for name, want in pipeline.gold_frames(pipeline._silver(full), run_ts).items():
        got = lake.read("gold", name).select(*want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, name
    one = pipeline.load_tracked(lake, "badges", now["badges"].where("badge_id = 1").withColumn("badge_name", F.lit("new")))
    assert one.count() == 2  # its old group and its new one
    pipeline.refresh_gold(lake, {"badges": one}, run_ts=run_ts)
    h = {r.table_name: r for r in lake.history("gold").where("version = 3").collect()}
    assert set(h) == {"badges_summary", "user_engagement", "badge_distribution"}  # of posts and comments nothing changed
    assert int(h["badges_summary"].summary["rewritten-buckets"]) == 1 and h["badges_summary"].added_records == 1
