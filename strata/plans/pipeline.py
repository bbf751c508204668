"""End-to-end jobs: bronze landing → silver upserts → gold rebuilds.

Each stage is an ordinary Spark job; stages run in order on the driver and
report their outcome. Silver stages are independent (a failing dataset does
not stop the others); a gold stage error aborts the gold run, as in the
original jobs. Data never passes through the driver: stages hand each other
table names, not rows, and every table is a written version in the lakehouse
(which also cuts lineage between stages).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import gold, silver
from strata.session import scratch_path
from strata.sources import roles
from strata.sources.bronze import land, read_bronze, read_files, sound_files
from strata.sources.lakehouse import Lakehouse, in_partitions

SILVER_KEYS = {"comments": ["comment_id"], "badges": ["badge_id"], "users": ["user_id"],
               "posts": ["post_id"]}
SILVER_PARTITIONS = {"comments": ["comment_year"], "posts": ["post_year"]}
GOLD_USER_METRICS = ["user_post_metrics", "badges_summary", "user_engagement"]
GOLD_ACTIVITY = ["comment_activity", "user_comment_engagement", "post_summary",
                 "badge_distribution"]


@dataclass
class StageReport:
    stages: list[tuple[str, bool, str]] = field(default_factory=list)

    def ok(self, name: str, note: str = "") -> None:
        self.stages.append((name, True, note))

    def failed(self, name: str, exc: Exception) -> None:
        self.stages.append((name, False, f"{type(exc).__name__}: {exc}"[:500]))


def land_roles(spark: SparkSession, sf_dir: str, bronze_root: str) -> str:
    """Land the Q&A role frames of the test tables as bronze: raw names,
    text as bytes, per-year datasets partitioned by ``year``."""
    for ds in ("users", "badges"):
        land(roles.bronze(spark, sf_dir, ds), f"{bronze_root}/{ds}")
    for ds in ("comments", "posts"):
        b = roles.bronze(spark, sf_dir, ds).withColumn("year", F.year("CreationDate"))
        land(b, f"{bronze_root}/{ds}", partition_by=["year"], gather=False)
    return bronze_root


def yearly_silver(spark: SparkSession, bronze_root: str, dataset: str, load_ts,
                  years: list[int] | None = None, report: StageReport | None = None,
                  isolate: bool = False, **options) -> DataFrame:
    """Silver frame of a per-year dataset (``comments`` or ``posts``).

    Without ``years``: one scan of the whole dataset, the source year taken
    from the ``year=`` partition column (one file listing, one scan however
    many years). With ``years``: one source per year, each with its year as
    a literal, unioned; missing or invalid years are skipped and reported.
    With ``isolate`` the files of all years are read through once first, and those
    that cannot be read whole are left out and named in the report. ``options`` go to
    the transform (``errors``, and ``decoded_only`` for comments).
    """
    transform = silver.comments_to_silver if dataset == "comments" else silver.posts_to_silver

    def to_silver(df, **kw):
        return transform(df, **kw, **options)

    if years is None:
        df = to_silver(read_bronze(spark, bronze_root, dataset), year="year", load_ts=load_ts)
        if report is not None:
            report.ok(f"{dataset}_all_years")
        return df

    files, bad = sound_files(spark, bronze_root, dataset, years) if isolate else ({}, [])

    def source(y):
        def make():
            if not isolate:
                rows = read_bronze(spark, bronze_root, dataset, year=y)
            elif y in files:
                rows = read_files(spark, files[y], dataset)
            else:
                raise FileNotFoundError("; ".join(f"{f}: {e}" for at, f, e in bad if at == y))
            return to_silver(rows, year=y, load_ts=load_ts)
        return make

    empty = (lambda: silver.empty_comments(spark)) if dataset == "comments" else None
    df, outcomes = silver.union_sources(((f"{dataset}_{y}", source(y)) for y in years), empty)
    if report is not None:
        report.stages += [(f"{dataset}_{y}: {f}", False, e) for y, f, e in bad if y in files]
    if report is not None:
        for o in outcomes:
            report.stages.append((o.name, o.ok, o.error or ""))
    if df is None:
        raise FileNotFoundError(f"no readable {dataset} source under {bronze_root}")
    return df


def run_silver(spark: SparkSession, bronze_root: str, lake: Lakehouse, load_ts=None,
               as_of=None, years: list[int] | None = None, errors: str = "strict",
               decoded_only: str = "valid", datasets: list[str] | None = None,
               buckets: int = 16) -> tuple[DataFrame, StageReport]:
    """Comments (multi-year) then badges, users, posts (or only ``datasets``), each merged
    into ``silver``; returns the verification frame and the stage report.

    Comments and posts are merged by year partition; badges and users, which have none,
    by ``buckets`` hash buckets of their key, so a load rewrites only the buckets of its
    keys. Their sources are projections of bronze files, which the checks and the write read
    where they are, so the files must stay as they are until the job ends. The scheduled comments job is ``errors='ignore', decoded_only='none'``.
    """
    report = StageReport()
    lake.ensure_namespace("silver")
    jobs = {
        "comments": lambda: yearly_silver(spark, bronze_root, "comments", load_ts, years, report,
                                          True, errors=errors, decoded_only=decoded_only),
        "badges": lambda: silver.badges_to_silver(
            read_bronze(spark, bronze_root, "badges"), load_ts=load_ts, errors=errors),
        "users": lambda: silver.users_to_silver(
            read_bronze(spark, bronze_root, "users"), load_ts=load_ts, as_of=as_of, errors=errors),
        "posts": lambda: yearly_silver(spark, bronze_root, "posts", load_ts, years, report,
                                       True, errors=errors),
    }
    done = []
    for ds in datasets or jobs:
        try:
            parts = SILVER_PARTITIONS.get(ds)
            res = lake.merge(jobs[ds](), "silver", ds, SILVER_KEYS[ds], partition_by=parts,
                             scope="partitions" if parts else "buckets", buckets=buckets, stage=False)
            report.ok(f"silver.{ds}", f"v{res.version} {res.operation} {res.total_records}")
            done.append(ds)
        except Exception as exc:  # one dataset failing must not stop the rest
            report.failed(f"silver.{ds}", exc)
    if not done:
        raise RuntimeError(f"every silver stage failed: {report.stages}")
    return lake.verify("silver", done), report


def _silver(lake: Lakehouse) -> dict[str, DataFrame]:
    return {t: lake.read("silver", t) for t in ("users", "posts", "comments", "badges")}


#: How each gold table is made from the silver tables.
GOLD_BUILDERS = {
    "user_post_metrics": lambda s, run_ts: gold.user_post_metrics(s["posts"], run_ts),
    "badges_summary": lambda s, run_ts: gold.badges_summary(s["badges"]),
    "user_engagement": lambda s, run_ts: gold.user_engagement_score(s["users"], s["posts"], s["comments"], s["badges"], run_ts),
    "comment_activity": lambda s, run_ts: gold.comment_activity(s["comments"]),
    "user_comment_engagement": lambda s, run_ts: gold.user_comment_engagement(s["comments"], s["users"]),
    "post_summary": lambda s, run_ts: gold.post_summary(s["posts"]),
    "badge_distribution": lambda s, run_ts: gold.badge_distribution(s["badges"]),
}


def gold_frames(s: dict[str, DataFrame], run_ts=None) -> dict[str, DataFrame]:
    return {name: make(s, run_ts) for name, make in GOLD_BUILDERS.items()}


def _run_gold(lake: Lakehouse, names: list[str], run_ts) -> DataFrame:
    """Write the named gold tables in order; the first error aborts.

    Per-user pieces are shared instead of recomputed: the engagement score
    is built from the written ``user_post_metrics`` / ``badges_summary``
    tables (when this run writes them) and from one per-user comment
    aggregate, which is itself written once (a lineage cut) when both
    per-user comment tables need it. A full run thus scans each large
    silver table twice, not three times.
    """
    lake.ensure_namespace("gold")
    s = _silver(lake)
    frames = gold_frames(s, run_ts)
    cpu = None
    if "user_engagement" in names or "user_comment_engagement" in names:
        cpu = gold.comments_per_user(s["comments"])
        if "user_engagement" in names and "user_comment_engagement" in names:
            lake.replace(cpu, "work", "comments_per_user")
            cpu = lake.read("work", "comments_per_user")
    order = sorted(names, key=lambda n: n == "user_engagement")  # engagement last
    written: dict[str, DataFrame] = {}
    for name in order:
        if name == "user_engagement":
            pm = written.get("user_post_metrics")
            bs = written.get("badges_summary")
            df = gold.user_engagement_from_parts(
                s["users"], pm if pm is not None else gold.user_post_metrics(s["posts"], run_ts),
                cpu, bs if bs is not None else gold.badges_summary(s["badges"]), run_ts)
        elif name == "user_comment_engagement":
            df = gold.user_comment_engagement_from(cpu, s["users"])
        else:
            df = frames[name]
        lake.replace(df, "gold", name)
        written[name] = lake.read("gold", name)
    return lake.verify("gold", names)


# ---- refresh by changed keys ------------------------------------------------

#: Columns of a silver row that decide which gold rows it is counted in.
CHANGE_COLUMNS = {"users": ["user_id"], "posts": ["owner_user_id", "post_year", "post_month", "post_type_id"],
                  "comments": ["user_id", "comment_year", "comment_month"],
                  "badges": ["user_id", "badge_name", "badge_year"]}
#: Keys of every gold table, and of which silver columns they come.
GOLD_KEYS = {
    "user_post_metrics": {"posts": {"user_id": "owner_user_id"}},
    "badges_summary": {"badges": {"user_id": "user_id"}},
    "user_engagement": {"users": {"user_id": "user_id"}, "posts": {"user_id": "owner_user_id"},
                        "comments": {"user_id": "user_id"}, "badges": {"user_id": "user_id"}},
    "comment_activity": {"comments": {"comment_year": "comment_year", "comment_month": "comment_month"}},
    "user_comment_engagement": {"comments": {"user_id": "user_id"}, "users": {"user_id": "user_id"}},
    "post_summary": {"posts": {c: c for c in ("post_year", "post_month", "post_type_id")}},
    "badge_distribution": {"badges": {"badge_name": "badge_name", "badge_year": "badge_year"}},
}


def load_tracked(lake: Lakehouse, dataset: str, batch: DataFrame, buckets: int = 16) -> DataFrame:
    """Merge a batch into a silver table; returns what it changed: CHANGE_COLUMNS of its rows
    and of the rows that they replace, each once, written before the merge."""
    spark, key = lake.spark, SILVER_KEYS[dataset]
    parts, columns = SILVER_PARTITIONS.get(dataset), CHANGE_COLUMNS[dataset]
    path = scratch_path(spark, "changes", dataset)
    with lake.staged_view(batch, f"batch_{dataset}") as staged:
        changed = staged.select(*columns)
        if lake.exists("silver", dataset):
            old = lake.read("silver", dataset).select(*dict.fromkeys([*key, *columns]))
            changed = changed.unionByName(old.join(staged.select(*key), key, "left_semi").select(*columns))
        changed.distinct().write.parquet(path)
        lake.merge(staged, "silver", dataset, key, partition_by=parts, scope="partitions" if parts else "buckets", buckets=buckets)
    return spark.read.schema(changed.schema).parquet(path)


def changed_keys(changes: dict[str, DataFrame], table: str) -> DataFrame | None:
    """The keys of a gold table that the changes of silver tables may alter."""
    out = None
    for dataset, columns in GOLD_KEYS[table].items():
        if dataset in changes:
            own = changes[dataset].select(*(F.col(c).alias(k) for k, c in columns.items()))
            out = own if out is None else out.unionByName(own)
    return None if out is None else out.distinct()


def _of(rows: DataFrame, keys: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The rows of a silver table whose ``columns`` hold one of the keys (NULL is a key too)."""
    scope = keys.select(*(F.col(k).alias(c) for k, c in columns.items())).withColumn("in_scope", F.lit(True))
    return in_partitions(rows, scope, list(columns.values()))


def refresh_gold(lake: Lakehouse, changes: dict[str, DataFrame], tables: list[str] | None = None, run_ts=None,
                 buckets: int = 16) -> DataFrame:
    """Bring gold tables up to date after loads (``changes``: silver table -> what
    ``load_tracked`` returned). Only the groups of changed keys are recomputed, from the
    silver rows of these keys, and put in the place of the old ones; a group that has no
    row any more goes. A table that is not there yet is built whole. Rows of other groups
    keep their ``fecha_cargue``."""
    lake.ensure_namespace("gold")
    tables = tables or GOLD_USER_METRICS + GOLD_ACTIVITY
    spark = lake.spark
    s = {d: lake.read("silver", d) for d in dict.fromkeys(d for t in tables for d in GOLD_KEYS[t])}
    for table in tables:
        keys = list(next(iter(GOLD_KEYS[table].values())))
        first = not lake.exists("gold", table)
        changed = changed_keys(changes, table)
        if first:
            lake.replace_keys(GOLD_BUILDERS[table](s, run_ts), None, "gold", table, keys, buckets)
        elif changed is not None:
            path = scratch_path(spark, "changed_keys", table)
            changed.write.parquet(path)
            changed = spark.read.schema(changed.schema).parquet(path)
            own = s | {d: _of(s[d], changed, columns) for d, columns in GOLD_KEYS[table].items()}
            lake.replace_keys(GOLD_BUILDERS[table](own, run_ts), changed, "gold", table, keys, buckets)
    return lake.verify("gold", tables)


def run_gold_user_metrics(lake: Lakehouse, run_ts=None) -> DataFrame:
    return _run_gold(lake, GOLD_USER_METRICS, run_ts)


def run_gold_activity(lake: Lakehouse, run_ts=None) -> DataFrame:
    return _run_gold(lake, GOLD_ACTIVITY, run_ts)


def run_medallion(spark: SparkSession, sf_dir: str, root: str, load_ts=None, as_of=None,
                  run_ts=None) -> DataFrame:
    """Land → silver → all gold tables; returns the gold verification. Every gold
    table needs silver, so a failed silver stage ends the run."""
    bronze_root = land_roles(spark, sf_dir, f"{root}/bronze")
    lake = Lakehouse(spark, f"{root}/lakehouse")
    _, report = run_silver(spark, bronze_root, lake, load_ts, as_of)
    failed = [f"{name}: {note}" for name, ok, note in report.stages if not ok]
    if failed:
        raise RuntimeError(f"silver failed, gold not built: {failed}")
    return _run_gold(lake, GOLD_USER_METRICS + GOLD_ACTIVITY, run_ts)
