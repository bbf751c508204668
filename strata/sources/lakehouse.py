"""Versioned Parquet tables with a load history — the silver/gold sink.

Layout under ``root`` (any Hadoop path: hdfs://, s3a://, file:)::

    <root>/<layer>/<table>/v000001_<commit>/   one folder per full commit
    <root>/_history/                           append-only load history (Parquet)

* **create / replace / merge** write a *new* version folder named after a
  unique commit id, so a merge never overwrites what it reads, a failed or
  killed job leaves the current version untouched (the history row is appended
  only after the data commit), and two writers never share a folder.
* The current version is read from the history before every commit.
* **overwrite_partitions** and ``merge`` with ``scope='partitions'`` or ``'buckets'`` replace
  partitions of the current folder in place by Spark's dynamic partition overwrite:
  the cost follows the batch, no older state is kept (``read(version=...)`` of a
  rewritten folder raises), and a driver killed while Spark commits leaves some
  partitions replaced; running it again completes it.
* One writer per table at a time. A writer that finds the current version moved since
  it read it raises ``ConcurrentCommitError`` and adds nothing to the history.
* A table merged with ``scope='buckets'`` is laid out by ``key_bucket``, a hash bucket of
  its keys, so a batch reads and rewrites only the buckets of its own keys. The column
  belongs to the layout: ``read`` leaves it out.
* ``replace(cluster_by=(column, n))`` writes Spark buckets of a column and registers them,
  so aggregates by it and joins of tables that share it need no exchange;
  ``replace(sort_by=column)`` orders the rows by it over all files, with Bloom filters, so a
  look-up by its value reads few row groups.
* Counts for the history come from ``Observation``s on the single write.
* Each table is also registered in the session catalog as ``<layer>.<table>``
  (external, pointing at the current version) so ``spark.table`` and SQL work.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.upsert import (
    MergeCardinalityError, align_source, any_null_key, check_merge_cardinality, check_unique_keys, unmatched_target,
)
from strata.sources import fs
from strata.sources.partitioned import FEW, few_partitions, write_partitioned

HISTORY_SCHEMA = T.StructType([
    T.StructField("layer", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("committed_at", T.TimestampNTZType()),
    T.StructField("operation", T.StringType()),
    T.StructField("added_records", T.LongType()),
    T.StructField("deleted_records", T.LongType()),
    T.StructField("total_records", T.LongType()),
    T.StructField("location", T.StringType()),
    T.StructField("summary", T.MapType(T.StringType(), T.StringType())),
    T.StructField("commit_id", T.StringType()),
])


@dataclass
class LoadResult:
    layer: str
    table: str
    version: int
    operation: str
    added_records: int
    deleted_records: int
    total_records: int
    location: str
    summary: dict[str, str] = field(default_factory=dict)


class ConcurrentCommitError(RuntimeError):
    """Another writer committed to the table after this one read its version."""


BUCKET = "key_bucket"
#: Fixed value: rows from which a batch counts as large, so the keys of both sides meet
#: before any whole row is moved, and no keys pass through the driver in a broadcast (the
#: planner's estimate for the keys of a wide table may be far too low).
LARGE_BATCH = 500_000


def bucket_of(keys: list[str], buckets: int):
    """Hash bucket of the keys; rows with a NULL key, which never match, have one of their own."""
    return F.when(any_null_key(keys), F.lit(buckets)).otherwise(F.pmod(F.xxhash64(*keys), F.lit(buckets))).cast("int").alias(BUCKET)


def _folder():
    """Folder of a row's file, as a path."""
    uri = F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B")
    return F.regexp_replace(F.url_decode(uri), "/[^/]*$", "")


def _any_null(parts: list[str]):
    return reduce(lambda a, b: a | b, [F.col(p).isNull() for p in parts])


def in_partitions(df: DataFrame, scope: DataFrame, parts: list[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` that are (``left_semi``) or are not (``left_anti``) in one of the
    partitions of ``scope``; NULL is a partition like any other. The equality branch
    lets Spark prune partitions from the (measured-small) scope at run time."""
    named = df.where(~_any_null(parts)).join(scope.where("in_scope = true"), parts, how)
    again = scope.select(*(F.col(p).alias(f"_{p}") for p in parts))
    same = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"_{p}")) for p in parts])
    return named.unionByName(df.where(_any_null(parts)).join(again, same, how))


class Lakehouse:
    def __init__(self, spark: SparkSession, root: str, register: bool = True,
                 compression: str = "snappy"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.register = register
        self.compression = compression
        self._namespaces: set[str] = set()
        self._history_seen = False

    # ---- paths and catalog ------------------------------------------------

    @property
    def history_path(self) -> str:
        return f"{self.root}/_history"

    def _version_path(self, layer: str, table: str, version: int, commit: str) -> str:
        return f"{self.root}/{layer}/{table}/v{version:06d}_{commit}"

    def ensure_namespace(self, layer: str) -> None:
        """``CREATE NAMESPACE IF NOT EXISTS`` with its folder under the root."""
        if layer in self._namespaces:
            return
        self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS `{layer}` "
                       f"LOCATION '{self.root}/{layer}'")
        self._namespaces.add(layer)

    def properties(self, layer: str, table: str) -> dict[str, str]:
        """The table properties given at creation, as the catalog has them."""
        if not self.register or not self.spark.catalog.tableExists(f"{layer}.{table}"):
            return {}
        rows = self.spark.sql(f"SHOW TBLPROPERTIES `{layer}`.`{table}`").collect()
        return {r["key"]: r["value"] for r in rows if not r["key"].startswith("spark.")}

    def _bind(self, layer: str, table: str, location: str, properties: dict[str, str] | None = None,
              summary: dict[str, str] | None = None) -> None:
        """Point catalog table ``layer.table`` at ``location``.

        The entry is re-created on every commit: a moved location would keep
        the old schema and, for partitioned tables, the old partition list;
        creating over the location infers both (and recovers partitions). Its
        properties are read back first. DataFrames analysed earlier keep
        reading the version they resolved.
        """
        if not self.register:
            return
        self.ensure_namespace(layer)
        name = f"`{layer}`.`{table}`"
        props = self.properties(layer, table) | (properties or {})
        tbl = columns = clustered = ""
        if "clusters" in (summary or {}):
            by, n = summary["clustered-by"], summary["clusters"]
            columns = " (" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                                       for f in self.spark.read.parquet(location).schema.fields) + ")"
            clustered = f" CLUSTERED BY (`{by}`) INTO {n} BUCKETS"
        if props:
            tbl = " TBLPROPERTIES (" + ", ".join(
                f"'{k}' = '{v}'" for k, v in sorted(props.items())) + ")"
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.spark.sql(f"CREATE TABLE {name}{columns} USING parquet{clustered} LOCATION '{location}'{tbl}")

    # ---- history ---------------------------------------------------------

    def history(self, layer: str | None = None, table: str | None = None,
                newest_first: bool = True) -> DataFrame:
        """Load history rows (all tables, or one), newest or oldest first."""
        if self._has_history():
            # one row per commit even while a compaction is half done
            h = (self.spark.read.schema(HISTORY_SCHEMA).parquet(self.history_path)
                 .dropDuplicates(["commit_id"]))
        else:
            h = self.spark.createDataFrame([], HISTORY_SCHEMA)
        if layer is not None:
            h = h.where(F.col("layer") == layer)
        if table is not None:
            h = h.where(F.col("table_name") == table)
        order = F.desc("version") if newest_first else F.asc("version")
        return h.orderBy(F.asc("layer"), F.asc("table_name"), order)

    def _has_history(self) -> bool:
        if self._history_seen:
            return True
        self._history_seen = fs.exists(self.spark, self.history_path)
        return self._history_seen

    def _commits(self, layer: str, table: str) -> list:
        """(version, location, committed_at) of a table's commits, newest first."""
        if not self._has_history():
            return []
        return (self.history(layer, table).select("version", "location", "committed_at")
                .orderBy(F.desc("version"), F.desc("committed_at")).collect())

    def _current(self, layer: str, table: str) -> tuple[int, str | None, dict[str, str]]:
        """Newest version, its folder and summary, read from the history each time, so
        commits of other writers are seen."""
        if not self._has_history():
            return 0, None, {}
        rows = (self.spark.read.schema(HISTORY_SCHEMA).parquet(self.history_path)
                .where((F.col("layer") == layer) & (F.col("table_name") == table))
                .orderBy(F.desc("version"), F.desc("committed_at"))
                .select("version", "location", "summary").limit(1).collect())
        return (rows[0]["version"], rows[0]["location"], rows[0]["summary"] or {}) if rows else (0, None, {})

    def _expect(self, layer: str, table: str, version: int, cause: Exception | None = None) -> None:
        now = self._current(layer, table)[0]
        if now != version:
            raise ConcurrentCommitError(f"{layer}.{table} is at version {now}; this writer started from "
                                        f"version {version}. Run it again") from cause

    def exists(self, layer: str, table: str) -> bool:
        return self._current(layer, table)[1] is not None

    def read(self, layer: str, table: str, version: int | None = None) -> DataFrame:
        """Current (or a given) version of a table. A version whose folder a later
        partition-scoped commit rewrote in place no longer exists and raises."""
        if version is None:
            _, loc, summary = self._current(layer, table)
            if loc and self.register and "clusters" in summary:
                return self.spark.table(f"`{layer}`.`{table}`")  # knows its buckets
        else:
            commits = self._commits(layer, table)
            loc = next((r["location"] for r in commits if r["version"] == version), None)
            later = [r["version"] for r in commits if r["location"] == loc and r["version"] > version]
            if loc and later:
                raise ValueError(f"version {version} of {layer}.{table} was rewritten in place by "
                                 f"version {min(later)}")
        if loc is None:
            raise FileNotFoundError(f"{layer}.{table} has no version {version or ''}".strip())
        return self.spark.read.parquet(loc).drop(BUCKET)

    def _append_history(self, res: LoadResult, commit: str) -> None:
        self._expect(res.layer, res.table, res.version - 1)
        summary = {"added-records": str(res.added_records),
                   "deleted-records": str(res.deleted_records),
                   "total-records": str(res.total_records), **res.summary}
        row = (res.layer, res.table, res.version, dt.datetime.now(dt.timezone.utc)
               .replace(tzinfo=None), res.operation, res.added_records, res.deleted_records,
               res.total_records, res.location, summary, commit)
        (self.spark.createDataFrame([row], HISTORY_SCHEMA).coalesce(1)
         .write.mode("append").parquet(self.history_path))
        self._history_seen = True

    # ---- writes ----------------------------------------------------------

    def _write(self, df: DataFrame, path: str, partition_by: list[str] | None,
               obs: Observation, few: bool = False) -> None:
        """One write. Rows of a partitioned table are first brought together by partition,
        unless it has ``few``: then every task writes its own (``sources.partitioned``)."""
        if partition_by:
            write_partitioned(df, path, partition_by, few, obs=obs, compression=self.compression)
        else:
            (df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
             .option("compression", self.compression).parquet(path))

    def _write_clustered(self, df: DataFrame, path: str, by: str, n: int, commit: str, obs: Observation) -> None:
        """Spark buckets of ``by``. Spark writes these as a table; a name of the commit's own
        holds it until the table itself is bound to the folder. A hot key's bucket is
        written by several tasks."""
        name = f"default.strata_{commit}"
        rows = df.hint("rebalance", n, by).observe(obs, F.count(F.lit(1)).alias("rows"))
        (rows.write.format("parquet").option("path", path).option("compression", self.compression)
         .bucketBy(n, by).saveAsTable(name))
        self.spark.sql(f"DROP TABLE {name}")  # external: the files stay

    def _write_sorted(self, df: DataFrame, path: str, by: str, obs: Observation) -> None:
        """Range partitions of ``by`` (equal values are spread by a hash of the row), sorted."""
        spread = F.xxhash64(*df.columns)
        rows = df.repartitionByRange(F.col(by), spread).sortWithinPartitions(by).observe(obs, F.count(F.lit(1)).alias("rows"))
        (rows.write.mode("overwrite").option("compression", self.compression)
         .option(f"parquet.bloom.filter.enabled#{by}", "true").option("parquet.block.size", str(32 << 20)).parquet(path))

    def _staged(self, df: DataFrame, commit: str, name: str) -> DataFrame:
        """``df`` written once under the table root, for plans that read it several times."""
        path = f"{self.root}/_batches/{commit}/{name}"
        df.write.mode("overwrite").option("compression", self.compression).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _clear(self, commit: str) -> None:
        fs.delete(self.spark, f"{self.root}/_batches/{commit}")

    def _commit(self, df: DataFrame, layer: str, table: str, operation: str,
                partition_by: list[str] | None, version: int,
                properties: dict[str, str] | None = None, summary: dict[str, str] | None = None,
                few: bool = False) -> LoadResult:
        commit = uuid.uuid4().hex[:12]
        path = self._version_path(layer, table, version, commit)
        obs = Observation(f"write_{layer}_{table}_{commit}")
        if "clusters" in (summary or {}):
            self._write_clustered(df, path, summary["clustered-by"], int(summary["clusters"]), commit, obs)
        elif "sorted-by" in (summary or {}):
            self._write_sorted(df, path, summary["sorted-by"], obs)
        else:
            self._write(df, path, partition_by, obs, few)
        n = obs.get["rows"]
        res = LoadResult(layer, table, version, operation, n, 0, n, path, summary or {})
        self._append_history(res, commit)
        self._bind(layer, table, path, properties, summary)
        return res

    def create(self, df: DataFrame, layer: str, table: str,
               partition_by: list[str] | None = None,
               properties: dict[str, str] | None = None) -> LoadResult:
        """Create a table from a frame; error if it exists. ``properties``
        become catalog table properties (kept across later commits)."""
        if self.exists(layer, table):
            raise ValueError(f"{layer}.{table} already exists")
        return self._commit(df, layer, table, "append", partition_by, 1,
                            {str(k): str(v) for k, v in (properties or {}).items()})

    def replace(self, df: DataFrame, layer: str, table: str, partition_by: list[str] | None = None,
                cluster_by: tuple[str, int] | None = None, sort_by: str | None = None) -> LoadResult:
        """Full rebuild; the new version takes the frame's schema (so added
        columns appear — the merge-schema request of a full replace).
        ``cluster_by`` (column, number) writes Spark buckets, which need the catalog;
        ``sort_by`` orders the rows by a column."""
        if sum(x is not None for x in (partition_by, cluster_by, sort_by)) > 1:
            raise ValueError("a table has one layout: partition_by, cluster_by or sort_by")
        if cluster_by and not self.register:
            raise ValueError("cluster_by needs tables registered in the catalog")
        summary = {"clustered-by": cluster_by[0], "clusters": str(cluster_by[1])} if cluster_by else {}
        summary |= {"sorted-by": sort_by} if sort_by else {}
        return self._commit(df, layer, table, "overwrite", partition_by,
                            self._current(layer, table)[0] + 1, summary=summary)

    def overwrite_partitions(self, df: DataFrame, layer: str, table: str,
                             partition_by: list[str]) -> LoadResult:
        """Replace only the partitions present in ``df``, in place; others are
        kept. First load creates the table."""
        version, loc, _ = self._current(layer, table)
        if loc is None:
            return self._commit(df, layer, table, "append", partition_by, 1)
        commit = uuid.uuid4().hex[:12]
        batch = self._staged(df, commit, "rows")
        scope = self._staged(batch.select(*partition_by).distinct()
                             .withColumn("in_scope", F.lit(True)), commit, "partitions")
        replaced = in_partitions(self.spark.read.parquet(loc), scope, partition_by).count()
        obs = Observation(f"ovw_{layer}_{table}_{commit}")
        self._replace(batch, layer, table, version, loc, partition_by, obs)
        self._clear(commit)
        return self._committed_in_place(layer, table, version + 1, "overwrite", obs.get["rows"],
                                        replaced, loc, commit)

    def _replace(self, rows: DataFrame, layer: str, table: str, version: int, loc: str,
                 parts: list[str], obs: Observation, few: bool = False) -> None:
        """Put ``rows`` in the place of the partitions that they are in: one write, whose
        commit swaps whole partitions once every task has ended (so ``rows`` may be made
        from the partitions that they replace)."""
        self._expect(layer, table, version)
        write_partitioned(rows, loc, parts, few, obs=obs, partitionOverwriteMode="dynamic", compression=self.compression)

    def _committed_in_place(self, layer: str, table: str, version: int, operation: str, added: int,
                            deleted: int, loc: str, commit: str,
                            summary: dict[str, str] | None = None) -> LoadResult:
        total = self.spark.read.parquet(loc).count()  # from footers
        res = LoadResult(layer, table, version, operation, added, deleted, total, loc, summary or {})
        self._append_history(res, commit)
        self._bind(layer, table, loc)
        return res

    @contextmanager
    def staged_view(self, source: DataFrame, view: str) -> Iterator[DataFrame]:
        """``source`` written once and registered as the temporary view ``view``, so SQL can
        read a batch before (or without) its merge; ``merge`` takes the frame without writing
        it again. The view and the copy are gone afterwards."""
        commit = uuid.uuid4().hex[:12]
        batch = self._staged(source, commit, "rows")
        batch._strata_batch = commit
        batch.createOrReplaceTempView(view)
        try:
            yield batch
        finally:
            self.spark.catalog.dropTempView(view)
            self._clear(commit)

    def merge(self, source: DataFrame, layer: str, table: str, keys: str | list[str],
              partition_by: list[str] | None = None, check_cardinality: bool = True,
              null_keys: str = "insert", scope: str = "table",
              verify_partition_keys: bool = True, buckets: int = 16, stage: bool = True) -> LoadResult:
        """Upsert ``source`` into the table by ``keys``; creates it on first
        load. Matched rows are replaced by the source row, unmatched source
        rows inserted, other target rows kept. The batch is written once and
        every check and join reads that copy; with ``stage=False`` they read the
        source itself, which must give the same rows each time (a projection of files).

        The keys of a large batch (``LARGE_BATCH`` rows) first meet those of the target in one
        exchange without other columns; whole target rows are only moved if many of
        them are kept.

        ``check_cardinality`` raises when several source rows match one target
        row, and on the first load when a key occurs twice.
        ``scope='table'`` writes the merged table as a new immutable version.
        ``scope='partitions'`` (partitioned tables) replaces in place only the
        partitions the source touches and those that matched keys leave (their
        partition value moved, to or from NULL as well); that search reads key
        and partition columns alone. ``verify_partition_keys=False`` skips it for
        tables whose partition column derives from an immutable attribute.
        ``scope='buckets'`` lays the table out by ``buckets`` hash buckets of the keys (the
        first load's number stays) and replaces only those that the source's keys fall
        into; the others are not read. In both, an empty batch changes nothing and
        writes no version.
        """
        keys = [keys] if isinstance(keys, str) else list(keys)
        if scope not in ("table", "partitions", "buckets"):
            raise ValueError("scope must be 'table', 'partitions' or 'buckets'")
        version, loc, summary = self._current(layer, table)
        if loc is not None and (scope == "buckets") != ("buckets" in summary):
            raise ValueError(f"{layer}.{table} is{'' if 'buckets' in summary else ' not'} laid out by buckets; "
                             f"it cannot be merged with scope={scope!r}")
        if scope == "buckets":
            if partition_by:
                raise ValueError("a table laid out by buckets has no other partitions")
            summary = {"buckets": summary.get("buckets", str(buckets)), "bucket-keys": summary.get("bucket-keys", ",".join(keys))}
            if summary["bucket-keys"] != ",".join(keys):
                raise ValueError(f"{layer}.{table} is laid out by buckets of {summary['bucket-keys']}")
        commit = uuid.uuid4().hex[:12]
        target = None if loc is None else self.spark.read.parquet(loc)
        src = source if loc is None else align_source(source, [c for c in target.columns if c != BUCKET])
        if null_keys == "reject":
            src = src.where(~any_null_key(keys))
        if stage and not hasattr(source, "_strata_batch"):
            src = self._staged(src, commit, "rows")
        if scope == "buckets":
            src = src.withColumn(BUCKET, bucket_of(keys, int(summary["buckets"])))
        try:
            if loc is None:
                if check_cardinality:
                    check_unique_keys(src, keys)
                few = int(summary["buckets"]) < FEW if scope == "buckets" else bool(partition_by) and few_partitions(src, partition_by)
                return self._commit(src, layer, table, "append", [BUCKET] if scope == "buckets" else partition_by, 1,
                                    summary=summary if scope == "buckets" else None, few=few)
            touched = None
            if scope == "buckets":
                touched = sorted(r[0] for r in src.select(BUCKET).distinct().collect())  # at most buckets + 1
                if not touched:
                    return LoadResult(layer, table, version, "merge", 0, 0, target.count(), loc)
                target = target.where(F.col(BUCKET).isin(touched))  # prunes the other folders
            by_key = scope == "buckets" or scope == "partitions" and bool(partition_by) and verify_partition_keys
            many = src.count() >= LARGE_BATCH
            large = by_key and many
            if check_cardinality and not large:
                check_merge_cardinality(src, target, keys)
            if scope == "buckets":
                met = self._meet(src, target, keys, commit, check_cardinality) if large else None
                return self._merge_buckets(src, target, layer, table, keys, touched, version, loc, commit, summary, met)
            if scope == "partitions" and partition_by:
                return self._merge_partitions(src, target, layer, table, keys, partition_by,
                                              version, loc, commit, verify_partition_keys, large, check_cardinality, many)
            return self._merge_table(src, target, layer, table, keys, partition_by, version, commit, many)
        except ConcurrentCommitError:
            raise
        except Exception as exc:
            self._expect(layer, table, version, exc)  # files that another writer replaced are gone
            raise
        finally:
            self._clear(commit)

    def replace_keys(self, rows: DataFrame, changed: DataFrame, layer: str, table: str,
                     keys: list[str], buckets: int = 16) -> LoadResult:
        """Put ``rows`` in the place of all rows whose ``keys`` are in ``changed`` (the keys, NULL
        being a value like any other); keys that ``rows`` lacks are gone. The table is laid
        out by ``buckets`` hash buckets of the keys, of which only those of changed keys
        are read and rewritten; the first load creates it."""
        version, loc, summary = self._current(layer, table)
        if loc is not None and summary.get("bucket-keys") != ",".join(keys):
            raise ValueError(f"{layer}.{table} is not laid out by buckets of {', '.join(keys)}")
        n = int(summary.get("buckets", buckets))
        summary = {"buckets": str(n), "bucket-keys": ",".join(keys)}
        bucket = F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int").alias(BUCKET)
        if loc is None:
            return self._commit(rows.select("*", bucket), layer, table, "append", [BUCKET], 1, summary=summary)
        commit = uuid.uuid4().hex[:12]
        try:
            target = self.spark.read.parquet(loc)
            scope = self._staged(changed.select(*keys).distinct().select("*", bucket), commit, "changed")
            touched = sorted(r[0] for r in scope.select(BUCKET).distinct().collect())
            if not touched:
                return LoadResult(layer, table, version, "refresh", 0, 0, target.count(), loc)
            new = self._staged(rows.select(*[c for c in target.columns if c != BUCKET]), commit, "rows").select("*", bucket)
            seen = [Observation(f"refresh_{x}_{commit}") for x in ("new", "target", "kept", "all")]
            count = F.count(F.lit(1)).alias("rows")
            within = target.where(F.col(BUCKET).isin(touched)).observe(seen[1], count)
            other = scope.select(*(F.col(k).alias(f"_{k}") for k in keys))
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
            kept = within.join(other, same, "left_anti").observe(seen[2], count)
            # a bucket that is left without a row is not in the write, so it goes by hand
            left = new.select(BUCKET).union(target.where(F.col(BUCKET).isin(touched)).join(other, same, "left_anti").select(BUCKET))
            emptied = sorted(set(touched) - {r[0] for r in left.distinct().collect()})
            folders = [] if not emptied else [r[0] for r in target.where(F.col(BUCKET).isin(emptied)).select(_folder().alias("f")).distinct().collect()]
            self._replace(new.observe(seen[0], count).unionByName(kept), layer, table, version, loc, [BUCKET], seen[3])
            for folder in folders:
                fs.delete(self.spark, folder)
            n_new, n_target, n_kept = (o.get["rows"] for o in seen[:3])
            return self._committed_in_place(
                layer, table, version + 1, "refresh", n_new, n_target - n_kept, loc, commit,
                summary | {"rewritten-buckets": str(len(touched)), "read-records": str(n_target)})
        finally:
            self._clear(commit)

    def _meet(self, src: DataFrame, target: DataFrame, keys: list[str], commit: str, check_cardinality: bool,
              touched: DataFrame | None = None, parts: list[str] = ()) -> tuple[DataFrame, int]:
        """Target keys that no source row matches, and those that match outside of the
        partitions ``touched`` (keys, ``parts``, _in, _n: number of source rows or NULL),
        staged, and how many target rows match. Raises if several source rows match one.
        One exchange of the keys of both sides finds all of it."""
        counts = src.where(~any_null_key(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        rows = target.select(*dict.fromkeys([*keys, *parts])).where(~any_null_key(keys))
        if touched is None:
            rows = rows.withColumn("_in", F.lit(True))
        else:
            own = touched.select(*(F.col(p).alias(f"_{p}") for p in parts), F.lit(True).alias("_in"))
            same = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"_{p}")) for p in parts])
            rows = rows.join(own, same, "left").select(*rows.columns, F.coalesce("_in", F.lit(False)).alias("_in"))
        obs = Observation(f"meet_{commit}")
        met = rows.join(counts.hint("merge"), keys, "left").observe(obs, F.count("_n").alias("rows"))
        met = self._staged(met.where("_n IS NULL AND _in OR _n > 1 OR _n IS NOT NULL AND NOT _in"), commit, "met")
        bad = met.where("_n > 1").select(*keys, F.col("_n").alias("n_source_rows")).distinct().limit(5).collect() if check_cardinality else []
        if bad:
            raise MergeCardinalityError(f"several source rows match one target row for keys {keys}: {[r.asDict() for r in bad]}")
        return met, obs.get["rows"]

    def _kept(self, src: DataFrame, target: DataFrame, keys: list[str], met: tuple[DataFrame, int] | None, commit: str,
              many: bool = False):
        """(target rows that stay, number of those that go, once the write has ended). Of a
        large batch that replaces nearly all of the target only the few rows that stay are looked up."""
        seen = [Observation(f"kept_{x}_{commit}") for x in ("target", "kept")]
        count = F.count(F.lit(1)).alias("rows")
        stay = None if met is None else self._staged(met[0].where("_n IS NULL").select(*keys).distinct(), commit, "stay")
        n = 0 if stay is None else stay.count()
        if stay is None or n >= LARGE_BATCH:
            kept = unmatched_target(target.observe(seen[0], count), src, keys, many).observe(seen[1], count)
            return kept, lambda: (seen[0].get["rows"], seen[1].get["rows"])
        kept = target.where(any_null_key(keys))
        if n:
            kept = kept.unionByName(target.join(stay, keys, "left_semi").select(*target.columns))
        return kept.observe(seen[1], count), lambda: (met[1] + seen[1].get["rows"], seen[1].get["rows"])

    def _merge_buckets(self, src: DataFrame, target: DataFrame, layer: str, table: str, keys: list[str],
                       touched: list[int], version: int, loc: str, commit: str, summary: dict[str, str],
                       met: tuple[DataFrame, int] | None = None) -> LoadResult:
        """``target``: the rows of the buckets ``touched``, all that is read of the table."""
        seen = [Observation(f"bmerge_{x}_{commit}") for x in ("source", "all")]
        kept, counted = self._kept(src, target, keys, met, commit, met is not None)
        self._replace(src.observe(seen[0], F.count(F.lit(1)).alias("rows")).unionByName(kept), layer, table, version, loc,
                      [BUCKET], seen[1], few=met is not None and len(touched) <= FEW)
        n_target, n_kept = counted()
        return self._committed_in_place(
            layer, table, version + 1, "merge", seen[0].get["rows"], n_target - n_kept, loc, commit,
            summary | {"rewritten-buckets": str(len(touched)), "read-records": str(n_target)})

    def _merge_table(self, src: DataFrame, target: DataFrame, layer: str, table: str, keys: list[str],
                     partition_by: list[str] | None, version: int, commit: str, many: bool = False) -> LoadResult:
        seen = [Observation(f"merge_{x}_{commit}") for x in ("source", "target", "kept", "all")]
        count = F.count(F.lit(1)).alias("rows")
        kept = unmatched_target(target.observe(seen[1], count), src, keys, many).observe(seen[2], count)
        path = self._version_path(layer, table, version + 1, commit)
        self._write(src.observe(seen[0], count).unionByName(kept), path, partition_by, seen[3])
        n_source, n_target, n_kept = (o.get["rows"] for o in seen[:3])
        res = LoadResult(layer, table, version + 1, "merge", n_source, n_target - n_kept,
                         n_source + n_kept, path)
        self._append_history(res, commit)
        self._bind(layer, table, path)
        return res

    def _merge_partitions(self, src: DataFrame, target: DataFrame, layer: str, table: str,
                          keys: list[str], parts: list[str], version: int, loc: str, commit: str,
                          verify_keys: bool, large: bool = False, check_cardinality: bool = True, many: bool = False) -> LoadResult:
        touched = src.select(*parts).distinct().withColumn("in_scope", F.lit(True))
        if touched.isEmpty():  # empty batch: nothing to change
            return LoadResult(layer, table, version, "merge", 0, 0, target.count(), loc)
        own = touched = self._staged(touched, commit, "touched")
        emptied: list[str] = []
        met = self._meet(src, target, keys, commit, check_cardinality, touched, parts) if large else None
        if met is not None and not met[0].where("NOT _in AND _n IS NOT NULL").isEmpty():
            met = None
        if verify_keys and met is None:  # partitions that matched keys leave
            elsewhere = in_partitions(target.select(*dict.fromkeys([*keys, *parts])), touched, parts, "left_anti")
            own_keys = src.select(*keys).where(~any_null_key(keys))
            left = (elsewhere.join(own_keys.hint("merge") if many else own_keys, keys, "left_semi")
                    .select(*parts).distinct().withColumn("in_scope", F.lit(True)))
            left = self._staged(left, commit, "left")
            if not left.isEmpty():
                touched = self._staged(own.unionByName(left), commit, "partitions")
                emptied = self._emptied(src, target, left, keys, parts, many)
        seen = [Observation(f"pmerge_{x}_{commit}") for x in ("source", "all")]
        kept, counted = self._kept(src, in_partitions(target, touched, parts), keys, met, commit, many)
        self._replace(src.observe(seen[0], F.count(F.lit(1)).alias("rows")).unionByName(kept), layer, table, version, loc, parts,
                      seen[1], few=large and touched.limit(FEW + 1).count() <= FEW)
        for folder in emptied:  # Spark's overwrite replaces partitions; it does not remove any
            fs.delete(self.spark, folder)
        n_target, n_kept = counted()
        return self._committed_in_place(layer, table, version + 1, "merge", seen[0].get["rows"],
                                        n_target - n_kept, loc, commit)

    def _emptied(self, src: DataFrame, target: DataFrame, left: DataFrame, keys: list[str], parts: list[str],
                 many: bool = False) -> list[str]:
        """Folders of the partitions ``left`` (which the source is not in) of whose rows none stays."""
        rows = in_partitions(target.select(*dict.fromkeys([*keys, *parts]), _folder().alias("_folder")), left, parts)
        stays = unmatched_target(rows, src, keys, many).select("_folder").distinct()
        return [r[0] for r in rows.select("_folder").distinct().join(stays, "_folder", "left_anti").collect()]

    def compact_history(self) -> int:
        """Rewrite the load history (one small file per commit) as one file:
        append the consolidated rows, then delete the files they came from.
        Reads ignore the duplicates a crash between the two steps would
        leave. Returns the number of files removed."""
        if not self._has_history():
            return 0
        raw = self.spark.read.schema(HISTORY_SCHEMA).parquet(self.history_path)
        files = raw.inputFiles()
        if len(files) <= 1:
            return 0
        (raw.dropDuplicates(["commit_id"]).coalesce(1)
         .write.mode("append").parquet(self.history_path))
        for f in files:
            fs.delete(self.spark, f)
        return len(files)

    # ---- catalog helpers ---------------------------------------------------

    def table_exists(self, layer: str, table: str) -> bool:
        """Catalog check (``spark.catalog.tableExists``), falling back to the
        load history when tables are not registered."""
        if self.register:
            return self.spark.catalog.tableExists(f"{layer}.{table}")
        return self.exists(layer, table)

    def list_namespaces(self) -> DataFrame:
        """``SHOW NAMESPACES`` as a DataFrame."""
        return self.spark.sql("SHOW NAMESPACES")

    def list_tables(self, layer: str) -> DataFrame:
        """``SHOW TABLES IN layer`` as a DataFrame."""
        return self.spark.sql(f"SHOW TABLES IN `{layer}`")

    def describe(self, layer: str, table: str) -> DataFrame:
        """Column listing (name, type) of the current version."""
        return self.spark.createDataFrame(
            [(f.name, f.dataType.simpleString()) for f in self.read(layer, table).schema.fields],
            "col_name string, data_type string")

    # ---- reports ---------------------------------------------------------

    def load_counts(self, layer: str | None = None) -> DataFrame:
        """Number of loads per table."""
        return (self.history(layer).groupBy("layer", "table_name")
                .agg(F.count(F.lit(1)).alias("n_loads")))

    def verify(self, layer: str, tables: list[str]) -> DataFrame:
        """One row per table: columns, loads, has ``load_date``, rows.

        Row counts are one Spark job (a union of per-table aggregates); the
        schema facts are catalog metadata.
        """
        frames = {t: self.read(layer, t) for t in tables}
        counts = None
        for t, df in frames.items():
            c = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(t).alias("table_name"), "n_rows")
            counts = c if counts is None else counts.unionByName(c)
        meta = self.spark.createDataFrame(
            [(t, len(df.columns), "load_date" in df.columns) for t, df in frames.items()],
            "table_name string, n_columns int, has_load_date boolean")
        loads = self.load_counts(layer).drop("layer")
        return (meta.join(loads, "table_name", "left").join(counts, "table_name", "left")
                .select("table_name", F.col("n_columns").cast("long").alias("n_columns"),
                        F.coalesce("n_loads", F.lit(0)).alias("n_loads"),
                        "has_load_date", "n_rows"))

    def merge_report(self, layer: str) -> DataFrame:
        """Per table: loads so far and whether a merge has been applied
        (more than one load)."""
        return (self.load_counts(layer)
                .select("table_name", "n_loads", (F.col("n_loads") > 1).alias("merged")))
