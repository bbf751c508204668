import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strata.functions.columns import SchemaContractError
from strata.sources import bronze as B
from strata.sources import footers


def _jobs(spark, action):
    """Result of ``action`` and the number of Spark jobs it ran."""
    group, sc = uuid.uuid4().hex, spark.sparkContext
    sc.setJobGroup(group, "counted")
    try:
        out = action()
        return out, len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setJobGroup("", "")


@pytest.fixture(scope="module")
def many_files(tmp_path_factory):
    """2000 files: comments in two spellings, every tenth of another kind, one without a footer."""
    folder = tmp_path_factory.mktemp("many") / "comments_2021"
    folder.mkdir()
    row = {"PostId": [1], "Text": ["t"], "UserId": [2], "CreationDate": ["2021-01-01"]}
    kinds = [pa.table({"Id": [1], **row}), pa.table({"Id": [2], **row, "Score": [3]}), pa.table({"_loader_id": ["x"]})]
    for i, t in enumerate(kinds):
        pq.write_table(t, str(folder.parent / f"kind{i}"))
    bytes_of = [(folder.parent / f"kind{i}").read_bytes() for i in range(3)]
    for i in range(2000):
        kind = 2 if i % 10 == 0 else i % 2
        (folder / f"part {i:04d}+%é.parquet").write_bytes(b"PAR1 no footer" if i == 1234 else bytes_of[kind])
    return folder


def test_two_thousand_footers_take_a_bounded_number_of_jobs(spark, many_files):
    df, jobs = _jobs(spark, lambda: B.read_bronze(spark, str(many_files.parent), "comments", 2021))
    assert jobs <= 8  # listing, footers (two stages), schema; not one for each file
    _, few = _jobs(spark, lambda: B.conforming_files(spark, str(many_files), "comments"))
    assert few <= 3
    assert df.count() == 2000 - 200 - 1


def test_classes_and_reports(spark, many_files):
    good, others = B.conforming_files(spark, str(many_files), "comments")
    assert len(good) == 1799 and len(others) == 201 and good == sorted(good)
    assert sum("unreadable" in o and "1234" in o for o in others) == 1
    assert sum("missing ['creation_date'" in o for o in others) == 200
    classes = footers.schema_classes(spark, str(many_files))
    assert sorted(len(c.files) for c in classes) == [1, 200, 799, 1000]
    assert B.first_valid_file(spark, str(many_files), "comments").endswith("part 0001+%é.parquet")
    assert B.read_bronze(spark, str(many_files.parent), "comments", 2021, pick="first").count() == 1
    with pytest.raises(SchemaContractError, match="unreadable"):
        B.read_bronze(spark, None, "badges", path=str(many_files))


def test_filesystems_that_workers_cannot_open_are_read_by_spark(spark, many_files, monkeypatch):
    real = footers.footers
    monkeypatch.setattr(footers, "footers", lambda files: real(files.where("path LIKE '%part 000%'")).withColumn("unreached", F.lit(True)))
    classes = footers.schema_classes(spark, str(many_files))
    assert sorted(len(c.files) for c in classes) == [1, 4, 5]


def test_damaged_files_are_named(spark, tmp_path):
    folder = tmp_path / "part=1 +"
    folder.mkdir()
    table = pa.table({"k": list(range(50_000)), "v": [f"value {i * 7919 % 50_000}" for i in range(50_000)]})
    for name in ("a.parquet", "b.parquet", "c.parquet"):
        pq.write_table(table, str(folder / name), row_group_size=10_000, compression="snappy", use_dictionary=False)
    whole = (folder / "b.parquet").read_bytes()
    (folder / "b.parquet").write_bytes(whole[:len(whole) // 3] + b"\xff" * (len(whole) // 3) + whole[2 * (len(whole) // 3):])  # pages, not the footer
    (folder / "c.parquet").write_bytes(b"PAR1")
    bad = {r.path.rsplit("/", 1)[1]: r.error for r in footers.damaged_files(
        spark, footers.footers(footers.listed(spark, str(folder)))).collect()}
    assert set(bad) == {"b.parquet", "c.parquet"} and " of 50000" in bad["b.parquet"]


def test_empty_folder_and_single_file(spark, tmp_path):
    pq.write_table(pa.table({"Id": [1], "DisplayName": ["x"], "CreationDate": ["d"]}), str(tmp_path / "Users.parquet"))
    assert B.read_bronze(spark, str(tmp_path), "users").count() == 1
    assert B.conforming_files(spark, str(tmp_path / "Users.parquet"), "users")[1] == []
