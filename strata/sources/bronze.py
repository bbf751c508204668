"""Bronze: reading raw Parquet drops and landing sources into the layout.

Layout written by the landing operators (one layout, any Hadoop path)::

    <bronze>/<dataset>/                 single-file datasets (users, badges)
    <bronze>/<dataset>/year=<y>/        per-year datasets (comments, posts)

Reading also accepts the names a manual upload produces
(``comments_2020.parquet``, ``Comments_2020.parquet``, ``comments_2021/``,
singular forms …), tried in a fixed order. Path probing reads Parquet
footers only (schema inference), never data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.columns import (
    CONTRACTS, SchemaContractError, check_contract, missing_columns, normalize_columns, normalized_names,
)
from strata.session import scratch_path
from strata.sources import footers, fs
from strata.sources.partitioned import few_partitions, write_partitioned

YEARLY = {"comments", "posts", "post"}
SINGLE = {"badges", "users"}
#: Fixed value: rows per batch of the bounded (test-mode) landing.
BOUNDED_BATCH_ROWS = 200_000


def scan_parquet_file(spark: SparkSession, path: str) -> DataFrame:
    """One Parquet file (or folder written as one dataset)."""
    return spark.read.parquet(path)


def scan_parquet_glob(spark: SparkSession, folder: str, pattern: str = "*.parquet",
                      recursive: bool = False) -> DataFrame:
    """Every file under ``folder`` whose name matches ``pattern``."""
    r = spark.read.option("pathGlobFilter", pattern)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.parquet(folder)


def candidate_paths(base: str, dataset: str, year: int | None = None) -> list[str]:
    """Names tried, in order, for a dataset (and year): the landed layout, then
    upload names — {plural, singular} x {capitalised, as is} x {file, folder} —
    with the folder a loader nests inside its own."""
    base, ds = base.rstrip("/"), dataset.lower()
    if year is None:
        return [f"{base}/{ds}", f"{base}/{ds}.parquet", f"{base}/{ds.capitalize()}.parquet"]
    out = [f"{base}/{ds}/year={year}"]
    for noun in dict.fromkeys((ds, ds.removesuffix("s"))):
        plain = f"{noun}_{year}"
        out += [f"{base}/{plain.capitalize()}.parquet", f"{base}/{plain}.parquet",
                f"{base}/{plain}/{plain}", f"{base}/{plain}"]
    return out


def _fits(df: DataFrame, dataset: str, mode: str) -> list[str]:
    """Contract columns that the frame lacks."""
    return missing_columns(normalize_columns(df, mode).columns, dataset)


def _sorted_out(spark: SparkSession, path: str, dataset: str, mode: str) -> tuple[list[str], list[str], int]:
    """(conforming files, reports on the others, number of others) of a folder or file:
    one job opens the footers, the contract is checked once for each schema class."""
    good, reports, others = [], [], 0
    for cls in footers.schema_classes(spark, path):
        miss = [] if cls.error else missing_columns(normalized_names(cls.columns, mode), dataset)
        if not cls.error and not miss:
            good += cls.files
            continue
        others += len(cls.files)
        why = f"unreadable: {cls.error}" if cls.error else f"contract: missing {miss}"
        reports += [f"({why}) {f}" for f in cls.files]
    return sorted(good), sorted(reports, key=lambda r: r.rsplit(") ", 1)[-1]), others


def conforming_files(spark: SparkSession, path: str, dataset: str, mode: str = "standard"
                     ) -> tuple[list[str], list[str]]:
    """(files whose own columns satisfy the contract, reports on the others), in name
    order. Only footers are read, by the tasks of one job."""
    good, reports, _ = _sorted_out(spark, path, dataset, mode)
    return good, reports


def _probe(spark: SparkSession, path: str, dataset: str, mode: str) -> tuple[list[str], list[str]]:
    """(paths to read, reports) for a candidate: the path itself if it is a partitioned
    folder or all of its files conform, else its conforming files."""
    if not path_exists(spark, path):
        return [], [f"(missing) {path}"]
    if any("=" in n for n in list_names(spark, path)):
        miss = _fits(spark.read.parquet(path), dataset, mode)
        return ([], [f"(contract: missing {miss}) {path}"]) if miss else ([path], [])
    if not any(n.endswith(".parquet") for n in [path, *list_names(spark, path)]):
        return [], [f"(no Parquet file) {path}"]
    good, reports, others = _sorted_out(spark, path, dataset, mode)
    return ([path] if good and not others else good), reports


def _resolve(spark: SparkSession, base: str, dataset: str, year: int | None, mode: str) -> tuple[str, list[str]]:
    """The first candidate that holds a conforming file, and what to read of it."""
    tried = []
    for cand in candidate_paths(base, dataset, year):
        good, other = _probe(spark, cand, dataset, mode)
        if good:
            return cand, good
        tried += other
    raise FileNotFoundError(
        f"no bronze path for dataset={dataset!r} year={year} under {base}:\n  - "
        + "\n  - ".join(tried))


def resolve_bronze_path(spark: SparkSession, base: str, dataset: str,
                        year: int | None = None, mode: str = "standard") -> str:
    """First candidate path that holds a file satisfying the dataset contract;
    the error lists every attempt. For a per-year dataset without a year the
    whole dataset folder is read (every ``year=`` partition)."""
    return _resolve(spark, base, dataset, year, mode)[0]


def first_valid_file(spark: SparkSession, folder: str, dataset: str,
                     mode: str = "standard") -> str:
    """The first file of ``folder`` (in name order) whose columns satisfy the
    contract — for loader folders that mix file kinds. One job reads the footers."""
    good, notes = conforming_files(spark, folder, dataset, mode)
    if not good:
        raise FileNotFoundError(f"no valid {dataset} file in {folder}: {notes[:3]}")
    return good[0]


def read_bronze(spark: SparkSession, base: str, dataset: str, year: int | None = None,
                mode: str = "standard", limit: int | None = None,
                order_by: str | list[str] | None = None, pick: str = "all",
                path: str | None = None) -> DataFrame:
    """Resolve → read → normalise names → check contract → optional cap.

    ``pick='first'`` reads only the first valid file of a folder (the
    notebook behaviour); the default reads every file that satisfies the
    contract and leaves out the others of a mixed folder. ``limit`` keeps the
    first ``limit`` rows in ``order_by`` order (default: the ``id`` column
    when present), so the cap is deterministic.
    """
    ds, paths = dataset.lower(), None
    if path is None:
        if ds in SINGLE and year is not None:
            raise ValueError(f"dataset {dataset!r} takes no year")
        path, paths = _resolve(spark, base, ds, year, mode)
    if pick == "first":
        paths = [first_valid_file(spark, path, ds, mode)] if paths in (None, [path]) else paths[:1]
    elif paths is None:
        paths, others = _probe(spark, path, ds, mode)
        if not paths:
            raise SchemaContractError(f"{path}: {'; '.join(others)}")
    df = check_contract(normalize_columns(spark.read.parquet(*paths), mode), ds, path)
    if limit is not None:
        keys = order_by or (["id"] if "id" in df.columns else df.columns[:1])
        keys = [keys] if isinstance(keys, str) else keys
        df = df.orderBy(*[F.asc_nulls_last(k) for k in keys]).limit(int(limit))
    return df


def read_files(spark: SparkSession, files: list[str], dataset: str, mode: str = "standard") -> DataFrame:
    """The given files of a dataset, names normalised, contract checked."""
    return check_contract(normalize_columns(spark.read.parquet(*files), mode), dataset.lower(), files[0])


def sound_files(spark: SparkSession, base: str, dataset: str, years: list[int], mode: str = "standard"
                ) -> tuple[dict[int, list[str]], list[tuple[int, str, str]]]:
    """Files of each year that can be read whole, and (year, file or folder, error) of what
    cannot: years without a conforming source, files without a footer, and files of
    whose rows not all can be decoded. However many years and files, one listing, one
    footer job and one scan for each schema; nothing is copied."""
    paths: dict[int, list[str]] = {}
    bad: list[tuple[int, str, str]] = []
    for y in years:
        try:
            where, good = _resolve(spark, base, dataset, y, mode)
            _, reports = ([], []) if good == [where] else _probe(spark, where, dataset, mode)
            bad += [(y, r.rsplit(") ", 1)[-1], r[1:].split(") ", 1)[0]) for r in reports]
            paths[y] = good
        except FileNotFoundError as exc:
            bad.append((y, f"{base}/{dataset}", f"{type(exc).__name__}: {exc}"[:500]))
    if not paths:
        return {}, bad
    found = [footers.listed(spark, *p).withColumn("year", F.lit(y)) for y, p in paths.items()]
    listing = found[0]
    for f in found[1:]:
        listing = listing.unionByName(f)
    scratch = scratch_path(spark, "footers")
    opened = footers.footers(listing.select("path")).join(listing, "path")
    opened.write.parquet(scratch)
    opened = spark.read.schema(opened.schema).parquet(scratch)
    damaged = {r.path: r.error for r in footers.damaged_files(spark, opened.drop("year")).collect()}
    out: dict[int, list[str]] = {}
    for r in opened.groupBy("year").agg(F.sort_array(F.collect_list("path")).alias("files")).collect():
        bad += [(r.year, f, damaged[f]) for f in r.files if f in damaged]
        if left := [f for f in r.files if f not in damaged]:
            out[r.year] = left
    fs.delete(spark, scratch)
    return out, bad


# ---- landing ----------------------------------------------------------------

def land(df: DataFrame, dest: str, batch_rows: int | None = None,
         partition_by: list[str] | None = None, mode: str = "overwrite",
         compression: str = "snappy", gather: bool = True) -> str:
    """Write a source into bronze with disposition ``replace`` (default) or
    ``append``. ``batch_rows`` caps rows per output file (default: none, files
    follow the tasks). Rows of a partitioned landing are brought together by
    partition first; with ``gather=False`` only if the partitions are many, which is
    found by a scan of the partition columns."""
    options = {"compression": compression}
    if batch_rows:
        options["maxRecordsPerFile"] = str(int(batch_rows))
    if partition_by:
        write_partitioned(df, dest, partition_by, not gather and few_partitions(df, partition_by), mode, **options)
    else:
        df.write.mode(mode).options(**options).parquet(dest)
    return dest


def first_rows(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The first ``n`` rows in the order of ``keys`` (unique per row, NULLs last) as a
    filter on the n-th key, found without a single-task sort: the keys are
    range-partitioned, the partitions counted, and only the one that holds row ``n``
    is ranked."""
    spark, order = df.sparkSession, [F.asc_nulls_last(k) for k in keys]
    path = scratch_path(spark, "first_rows")
    (df.select(*keys).repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
     .write.parquet(path))
    placed = spark.read.parquet(path)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    parts = (placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
             .where((F.col("_before") < n) & (F.col("_before") + F.col("_n") >= n)).collect())
    if not parts:  # fewer than n rows
        fs.delete(spark, path)
        return df
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    last = (placed.where(F.col("_part") == parts[0]["_part"]).withColumn("_rank", rank)
            .where(F.col("_rank") == n - parts[0]["_before"]).first())
    fs.delete(spark, path)
    upto, same = F.lit(False), F.lit(True)
    for k in keys:
        c, v = F.col(k), F.lit(last[k]).cast(df.schema[k].dataType)
        lower = c.isNotNull() if last[k] is None else F.coalesce(c < v, F.lit(False))
        upto, same = upto | (same & lower), same & c.eqNullSafe(v)
    return df.where(upto | same)


def land_bounded(df: DataFrame, dest: str, order_by: str | list[str], batches: int = 2,
                 batch_rows: int = BOUNDED_BATCH_ROWS) -> str:
    """Test-mode landing: only the first ``batches`` batches of
    ``batch_rows`` rows in ``order_by`` order (which must be unique per row)."""
    keys = [order_by] if isinstance(order_by, str) else order_by
    return land(first_rows(df, keys, batches * batch_rows), dest, batch_rows=batch_rows)


def path_exists(spark: SparkSession, path: str) -> bool:
    return fs.exists(spark, path)


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Entry names directly in ``folder`` (driver-side metadata listing)."""
    return fs.list_names(spark, folder)


def _list_parquet(spark: SparkSession, folder: str) -> list[str]:
    return [n for n in list_names(spark, folder) if n.endswith(".parquet")]


def partition_years(spark: SparkSession, base: str, dataset: str) -> list[int]:
    """Years present as ``year=<y>`` folders of a per-year dataset."""
    names = list_names(spark, f"{base.rstrip('/')}/{dataset}")
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("year="))


def land_folder(spark: SparkSession, src_folder: str, bronze: str,
                exclude: set[str] | frozenset[str] = frozenset(),
                batch_rows: int | None = None) -> list[tuple[str, str]]:
    """Land every ``*.parquet`` dataset of a folder except ``exclude``; one
    Spark read/write per dataset. Returns (dataset, destination) pairs."""
    out = []
    for name in _list_parquet(spark, src_folder):
        if name in exclude:
            continue
        ds = name[: -len(".parquet")]
        dest = f"{bronze.rstrip('/')}/{ds}"
        land(spark.read.parquet(f"{src_folder.rstrip('/')}/{name}"), dest, batch_rows)
        out.append((ds, dest))
    return out


def landed_counts(spark: SparkSession, landed: list[tuple[str, str]]) -> DataFrame:
    """Rows per landed dataset, as one Spark job over the written data."""
    frames = [spark.read.parquet(dest).agg(F.count(F.lit(1)).alias("n_rows"))
              .select(F.lit(ds).alias("dataset"), "n_rows") for ds, dest in landed]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


__all__ = [
    "CONTRACTS", "SchemaContractError", "candidate_paths", "conforming_files", "first_rows",
    "first_valid_file", "read_files", "sound_files", "land", "land_bounded", "land_folder", "landed_counts", "read_bronze", "resolve_bronze_path",
    "scan_parquet_file", "scan_parquet_glob",
]
