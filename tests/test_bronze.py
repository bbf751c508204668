import pytest
from pyspark.sql import functions as F

from strata.functions.columns import SchemaContractError
from strata.sources import bronze as B


def _comments(spark, n=3, pascal=True):
    df = spark.range(n).select(
        F.col("id").alias("Id"), F.col("id").alias("PostId"), F.lit("t").alias("Text"),
        F.lit(1).cast("long").alias("UserId"),
        F.lit("2020-01-01").cast("timestamp_ntz").alias("CreationDate"))
    return df if pascal else df.toDF(*[c.lower() for c in df.columns])


def test_resolver_prefers_layout_then_reference_names(spark, tmp_path):
    base = str(tmp_path / "bronze")
    _comments(spark).write.parquet(f"{base}/Comments_2020.parquet")
    assert B.resolve_bronze_path(spark, base, "comments", 2020).endswith("Comments_2020.parquet")
    _comments(spark).write.parquet(f"{base}/comments/year=2020")
    assert B.resolve_bronze_path(spark, base, "comments", 2020).endswith("comments/year=2020")


def test_resolver_error_lists_attempts(spark, tmp_path):
    base = str(tmp_path / "bronze")
    with pytest.raises(FileNotFoundError) as e:
        B.resolve_bronze_path(spark, base, "posts", 2021)
    msg = str(e.value)
    assert "Posts_2021.parquet" in msg and "post_2021" in msg


def test_resolver_skips_contract_mismatch(spark, tmp_path):
    base = str(tmp_path / "bronze")
    spark.range(2).write.parquet(f"{base}/comments_2020.parquet")  # wrong dataset
    _comments(spark).write.parquet(f"{base}/comments_2020")
    assert B.resolve_bronze_path(spark, base, "comments", 2020).endswith("comments_2020")


def test_read_bronze_contract_and_limit(spark, tmp_path):
    base = str(tmp_path / "bronze")
    _comments(spark, 50).write.parquet(f"{base}/comments/year=2020")
    df = B.read_bronze(spark, base, "comments", 2020, limit=5)
    assert df.columns == ["id", "post_id", "text", "user_id", "creation_date"]
    assert [r.id for r in df.collect()] == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        B.read_bronze(spark, base, "users", 2020)
    spark.range(3).write.parquet(f"{base}/posts_bad")
    with pytest.raises(SchemaContractError):
        B.read_bronze(spark, base, "posts", path=f"{base}/posts_bad")


def test_first_valid_file(spark, tmp_path):
    folder = str(tmp_path / "loader")
    spark.range(2).coalesce(1).write.parquet(f"{folder}")            # not comments
    _comments(spark).coalesce(1).write.mode("append").parquet(folder)  # comments
    f = B.first_valid_file(spark, folder, "comments")
    assert "Id" in spark.read.parquet(f).columns
    # reading all files of the folder that hold comments vs only the first
    assert B.read_bronze(spark, None, "comments", path=f, pick="first").count() == 3


def test_land_batched_and_bounded(spark, tmp_path):
    df = spark.range(0, 1000).withColumn("v", F.col("id") * 2)
    dest = str(tmp_path / "landed")
    B.land(df, dest, batch_rows=100)
    assert len(spark.read.parquet(dest).inputFiles()) >= 10
    assert spark.read.parquet(dest).count() == 1000
    B.land_bounded(df, str(tmp_path / "bounded"), "id", batches=2, batch_rows=50)
    got = sorted(r.id for r in spark.read.parquet(str(tmp_path / "bounded")).collect())
    assert got == list(range(100))


def test_land_folder_excludes(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.range(3).write.parquet(f"{src}/a.parquet")
    spark.range(5).write.parquet(f"{src}/b.parquet")
    landed = B.land_folder(spark, src, str(tmp_path / "dst"), exclude={"b.parquet"})
    assert [d for d, _ in landed] == ["a"]
    assert [(r.dataset, r.n_rows) for r in B.landed_counts(spark, landed).collect()] == [("a", 3)]


def test_catalog_helpers(lake, spark):
    lake.create(spark.range(3), "silver", "nums")
    assert lake.table_exists("silver", "nums")
    assert "nums" in [r.tableName for r in lake.list_tables("silver").collect()]
    assert [r.col_name for r in lake.describe("silver", "nums").collect()] == ["id"]


def test_table_properties_survive_commits(lake, spark):
    lake.create(spark.range(3), "silver", "props", properties={"layer": "silver", "format-version": "2"})
    lake.replace(spark.range(5), "silver", "props")
    props = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES silver.props").collect()}
    assert props["layer"] == "silver" and props["format-version"] == "2"


def test_resolver_finds_loader_nested_folder(spark, tmp_path):
    base = str(tmp_path / "bronze")
    _comments(spark).write.parquet(f"{base}/comments_2021/comments_2021")
    p = B.resolve_bronze_path(spark, base, "comments", 2021)
    assert p.endswith("comments_2021/comments_2021")
    assert B.read_bronze(spark, base, "comments", 2021).count() == 3


def test_fs_fallback_without_jvm_gateway(spark, tmp_path, monkeypatch):
    from strata.sources import fs
    base = str(tmp_path / "ds")
    spark.range(3).write.parquet(f"{base}/year=2020")
    spark.range(3).write.parquet(f"{base}/year=2021")
    want = fs.list_names(spark, base)
    monkeypatch.setattr(fs, "_hadoop", lambda s, p: (None, None))
    assert fs.exists(spark, base) and not fs.exists(spark, base + "_missing")
    got = fs.list_names(spark, base)
    assert [n for n in got if n.startswith("year=")] == ["year=2020", "year=2021"]
    assert [n for n in want if n.startswith("year=")] == ["year=2020", "year=2021"]


def test_mixed_loader_folder_reads_the_conforming_files(spark, tmp_path):
    import pytest
    folder = tmp_path / "Users"
    cols = ["Id", "Reputation", "CreationDate", "DisplayName", "LastAccessDate", "AboutMe", "Views", "UpVotes",
            "DownVotes", "WebsiteUrl", "Location", "AccountId"]
    good = spark.createDataFrame([tuple("1" for _ in cols)], cols)
    other = spark.createDataFrame([("x",)], ["_dlt_id"])
    for i in range(150):  # the only valid file is the last of many
        (folder / "many").mkdir(parents=True, exist_ok=True)
        if i < 3 or i == 149:
            (good if i == 149 else other).coalesce(1).write.parquet(str(tmp_path / f"part{i}"))
            src = next((tmp_path / f"part{i}").glob("*.parquet"))
        (folder / "many" / f"f{i:03d}.parquet").write_bytes(src.read_bytes())
    path = str(folder / "many")
    assert B.read_bronze(spark, None, "users", path=path).count() == 1
    assert B.read_bronze(spark, None, "users", path=path, pick="first").count() == 1
    fine, others = B.conforming_files(spark, path, "users")
    assert (len(fine), len(others)) == (1, 149)
    with pytest.raises(Exception):
        B.read_bronze(spark, None, "comments", path=path)


def test_candidate_names_have_no_repeats():
    names = B.candidate_paths("/b", "comments", 2021)
    assert len(set(names)) == len(names)
    assert "/b/Comments_2021.parquet" in names and "/b/comment_2021" in names
    assert "/b/comments_2021/comments_2021" in names


def test_first_rows_is_exact_over_any_partitioning(spark):
    df = spark.range(0, 1000).repartition(7).selectExpr("(id * 37) % 1000 as k", "id")
    for n in (1, 10, 999, 1000, 5000):
        got = sorted(r.k for r in B.first_rows(df, ["k"], n).collect())
        assert got == list(range(min(n, 1000)))
