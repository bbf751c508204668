"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory, each paired (where SQL can state it) with the
DuckDB oracle in ``oracle_sql``.

Inputs are the role frames of ``sources.roles`` run through the silver
transforms with fixed load time / as-of date, so results are reproducible.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions import expressions as X
from strata.functions.columns import check_contract, normalize_columns
from strata.functions.decode import decode_utf8
from strata.operators import gold, silver, upsert
from strata.operators.joins import left_join_fact_dim
from strata.plans import analytics, pipeline
from strata.plans import oracle_sql as O
from strata.session import scratch_path
from strata.sources import bronze as B
from strata.sources import roles
from strata.sources.lakehouse import Lakehouse

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(spark, str(sf_dir).rstrip("/"))
        run.__name__, run.__doc__, run.__wrapped__ = fn.__name__, fn.__doc__, fn
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# ---- shared inputs ------------------------------------------------------

def bronze(spark: SparkSession, sf: str, dataset: str) -> DataFrame:
    """Normalised bronze role frame (text as bytes)."""
    return normalize_columns(roles.bronze(spark, sf, dataset))


def silver_frame(spark: SparkSession, sf: str, dataset: str, **kw) -> DataFrame:
    b = bronze(spark, sf, dataset)
    if dataset == "comments":
        return silver.comments_to_silver(b, load_ts=O.LOAD_TS, **kw)
    if dataset == "posts":
        return silver.posts_to_silver(b, load_ts=O.LOAD_TS, **kw)
    if dataset == "badges":
        return silver.badges_to_silver(b, load_ts=O.LOAD_TS, **kw)
    if dataset == "users":
        return silver.users_to_silver(b, load_ts=O.LOAD_TS, as_of=O.AS_OF, **kw)
    raise ValueError(dataset)


def silvers(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {d: silver_frame(spark, sf, d) for d in ("users", "posts", "comments", "badges")}


# ---- gold tables --------------------------------------------------------

@register("gold_user_post_metrics", O.GOLD_USER_POST_METRICS)
def q_gold_user_post_metrics(spark, sf):
    return gold.user_post_metrics(silver_frame(spark, sf, "posts"), run_ts=O.RUN_TS)


@register("gold_badges_summary", O.GOLD_BADGES_SUMMARY)
def q_gold_badges_summary(spark, sf):
    return gold.badges_summary(silver_frame(spark, sf, "badges"))


@register("gold_user_engagement_score", O.GOLD_USER_ENGAGEMENT)
def q_gold_user_engagement_score(spark, sf):
    s = silvers(spark, sf)
    return gold.user_engagement_score(s["users"], s["posts"], s["comments"], s["badges"],
                                      run_ts=O.RUN_TS)


@register("gold_comment_activity", O.GOLD_COMMENT_ACTIVITY)
def q_gold_comment_activity(spark, sf):
    return gold.comment_activity(silver_frame(spark, sf, "comments"))


@register("gold_user_comment_engagement", O.GOLD_USER_COMMENT_ENGAGEMENT)
def q_gold_user_comment_engagement(spark, sf):
    s = silvers(spark, sf)
    return gold.user_comment_engagement(s["comments"], s["users"])


@register("gold_post_summary", O.GOLD_POST_SUMMARY)
def q_gold_post_summary(spark, sf):
    return gold.post_summary(silver_frame(spark, sf, "posts"))


@register("gold_badge_distribution", O.GOLD_BADGE_DISTRIBUTION)
def q_gold_badge_distribution(spark, sf):
    return gold.badge_distribution(silver_frame(spark, sf, "badges"))


# ---- console queries ----------------------------------------------------

@register("query_posts_per_user_top20", O.QUERY_POSTS_PER_USER_TOP20)
def q_posts_per_user_top20(spark, sf):
    return analytics.posts_per_user_top(silver_frame(spark, sf, "posts"))


@register("query_posts_per_named_user_top20", O.QUERY_POSTS_PER_NAMED_USER_TOP20)
def q_posts_per_named_user_top20(spark, sf):
    s = silvers(spark, sf)
    return analytics.posts_per_named_user_top(s["posts"], s["users"])


@register("query_badge_statistics", O.QUERY_BADGE_STATISTICS)
def q_badge_statistics(spark, sf):
    return analytics.badge_statistics(silver_frame(spark, sf, "badges"))


@register("query_user_engagement", O.QUERY_USER_ENGAGEMENT)
def q_user_engagement(spark, sf):
    s = silvers(spark, sf)
    return analytics.user_engagement(s["users"], s["posts"], s["comments"], s["badges"])


# ---- silver transforms --------------------------------------------------

@register("silver_comments", O.with_ctes(["silver_comments"], "SELECT * FROM silver_comments"))
def q_silver_comments(spark, sf):
    return silver_frame(spark, sf, "comments")


@register("silver_badges", O.with_ctes(["silver_badges"], "SELECT * FROM silver_badges"))
def q_silver_badges(spark, sf):
    return silver_frame(spark, sf, "badges")


@register("silver_users", O.with_ctes(["silver_users"], "SELECT * FROM silver_users"))
def q_silver_users(spark, sf):
    return silver_frame(spark, sf, "users")


@register("silver_posts", O.with_ctes(["silver_posts"], "SELECT * FROM silver_posts"))
def q_silver_posts(spark, sf):
    return silver_frame(spark, sf, "posts")


# =========================================================================
# Operator-level queries. Each reads the whole base tables.
# =========================================================================

W = O.with_ctes


def _lake(spark) -> Lakehouse:
    return Lakehouse(spark, scratch_path(spark, "lakehouse"))


def _landed_raw(spark, sf, dataset: str) -> str:
    """Land the string-typed raw role of ``dataset`` into a fresh bronze root."""
    root = scratch_path(spark, "bronze")
    B.land(roles.raw(spark, sf, dataset), f"{root}/{dataset}")
    return root


# ---- 2.1 scans, sources, bronze ------------------------------------------

@register("scan_parquet_file", "SELECT * FROM orders")
def q_scan_parquet_file(spark, sf):
    return B.scan_parquet_file(spark, f"{sf}/orders.parquet")


@register("scan_parquet_glob", "SELECT * FROM orders")
def q_scan_parquet_glob(spark, sf):
    return B.scan_parquet_glob(spark, sf, "order*.parquet")


@register("read_bronze", W(["bronze_users"], "SELECT * FROM bronze_users"))
def q_read_bronze(spark, sf):
    return B.read_bronze(spark, _landed_raw(spark, sf, "users"), "users")


@register("normalize_columns_split_caps", W(["bronze_comments"], "SELECT * FROM bronze_comments"))
def q_normalize_split_caps(spark, sf):
    return normalize_columns(roles.raw(spark, sf, "comments"), "split_caps")


@register("normalize_columns_two_pass", W(["bronze_posts"], "SELECT * FROM bronze_posts"))
def q_normalize_two_pass(spark, sf):
    return normalize_columns(roles.raw(spark, sf, "posts"), "two_pass")


@register("schema_contract", W(["bronze_badges"], "SELECT * FROM bronze_badges"))
def q_schema_contract(spark, sf):
    return check_contract(normalize_columns(roles.raw(spark, sf, "badges")), "badges")


@register("bounded_read", W(["bronze_users"], "SELECT * FROM bronze_users ORDER BY id LIMIT 1000"))
def q_bounded_read(spark, sf):
    return B.read_bronze(spark, _landed_raw(spark, sf, "users"), "users", limit=1000)


@register("bronze_land_replace", "SELECT * FROM orders")
def q_bronze_land_replace(spark, sf):
    dest = scratch_path(spark, "bronze", "replace")
    B.land(spark.read.parquet(f"{sf}/lineitem.parquet"), dest)
    B.land(spark.read.parquet(f"{sf}/orders.parquet"), dest)  # replaces the first landing
    return spark.read.parquet(dest)


@register("bronze_land_batched", "SELECT * FROM lineitem")
def q_bronze_land_batched(spark, sf):
    dest = scratch_path(spark, "bronze", "batched")
    B.land(spark.read.parquet(f"{sf}/lineitem.parquet"), dest, batch_rows=5000)
    return spark.read.parquet(dest)


@register("bronze_land_bounded", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10000")
def q_bronze_land_bounded(spark, sf):
    dest = scratch_path(spark, "bronze", "bounded")
    B.land_bounded(spark.read.parquet(f"{sf}/orders.parquet"), dest, "o_orderkey",
                   batches=2, batch_rows=5000)
    return spark.read.parquet(dest)


LAND_EXCLUDE = frozenset({"documents.parquet", "pages.parquet", "embeddings.parquet",
                          "conversations.parquet"})
_LANDED = ["benchmark", "customer", "events", "labels", "lineitem", "nation", "orders",
           "part", "region", "supplier"]


@register("bronze_land_exclude", " UNION ALL ".join(
    f"SELECT '{t}' AS dataset, COUNT(*) AS n_rows FROM {t}" for t in _LANDED))
def q_bronze_land_exclude(spark, sf):
    landed = B.land_folder(spark, sf, scratch_path(spark, "bronze", "folder"),
                           exclude=LAND_EXCLUDE)
    return B.landed_counts(spark, landed)


def _private_layer(name: str = "silver") -> str:
    """A namespace of its own for queries that read through the session
    catalog, so no other query can re-point their tables meanwhile."""
    return f"{name}_{uuid.uuid4().hex[:10]}"


@register("scan_table", W(["silver_posts"], "SELECT * FROM silver_posts"))
def q_scan_table(spark, sf):
    lake, ns = _lake(spark), _private_layer()
    lake.create(silver_frame(spark, sf, "posts"), ns, "posts")
    return spark.table(f"{ns}.posts")


@register("browse_limit", W(["silver_badges"],
                            "SELECT * FROM silver_badges ORDER BY badge_id LIMIT 10"))
def q_browse_limit(spark, sf):
    lake = _lake(spark)
    lake.create(silver_frame(spark, sf, "badges"), "silver", "badges")
    return analytics.browse(lake.read("silver", "badges"), 10, "badge_id")


BROWSE_USER = 7


@register("browse_by_key", W(["silver_posts"], f"""
SELECT * FROM silver_posts WHERE owner_user_id = {BROWSE_USER} ORDER BY post_id LIMIT 10"""))
def q_browse_by_key(spark, sf):
    lake = _lake(spark)
    lake.create(silver_frame(spark, sf, "posts"), "silver", "posts")
    return analytics.browse_by_key(lake.read("silver", "posts"), "owner_user_id", BROWSE_USER,
                                   10, "post_id")


@register("browse_by_key_sorted", W(["silver_posts"], f"""
SELECT * FROM silver_posts WHERE owner_user_id = {BROWSE_USER} ORDER BY post_id LIMIT 10"""))
def q_browse_by_key_sorted(spark, sf):
    """The same look-up on rows ordered by the key: most row groups are skipped."""
    lake = _lake(spark)
    lake.replace(silver_frame(spark, sf, "posts"), "silver", "posts", sort_by="owner_user_id")
    return analytics.browse_by_key(lake.read("silver", "posts"), "owner_user_id", BROWSE_USER,
                                   10, "post_id")


USER_OF = {"users": "user_id", "posts": "owner_user_id", "comments": "user_id", "badges": "user_id"}


def colocated_silver(spark, sf, tables=tuple(USER_OF), clusters: int = 16) -> dict[str, DataFrame]:
    """Silver tables in Spark buckets of their user, read through the catalog."""
    lake, ns = _lake(spark), _private_layer()
    for t in tables:
        lake.replace(silver_frame(spark, sf, t), ns, t, cluster_by=(USER_OF[t], clusters))
    return {t: lake.read(ns, t) for t in tables}


# ---- 2.2 sinks, upsert, load history --------------------------------------

@register("create_table_if_absent", W(["silver_badges"], "SELECT * FROM silver_badges"))
def q_create_table_if_absent(spark, sf):
    lake = _lake(spark)
    lake.create(silver_frame(spark, sf, "badges"), "silver", "badges")
    return lake.read("silver", "badges")


@register("replace_table", O.GOLD_BADGE_DISTRIBUTION)
def q_replace_table(spark, sf):
    lake = _lake(spark)
    b = silver_frame(spark, sf, "badges")
    lake.replace(gold.badges_summary(b), "gold", "badges")
    lake.replace(gold.badge_distribution(b), "gold", "badges")
    return lake.read("gold", "badges")


@register("replace_table_merge_schema", O.GOLD_USER_POST_METRICS)
def q_replace_table_merge_schema(spark, sf):
    lake = _lake(spark)
    m = gold.user_post_metrics(silver_frame(spark, sf, "posts"), run_ts=O.RUN_TS)
    lake.replace(m.drop("fecha_cargue"), "gold", "user_post_metrics")
    lake.replace(m, "gold", "user_post_metrics")  # new column appears
    return lake.read("gold", "user_post_metrics")


@register("overwrite_partitioned", W(["silver_comments"], "SELECT * FROM silver_comments"))
def q_overwrite_partitioned(spark, sf):
    lake = _lake(spark)
    lake.replace(silver_frame(spark, sf, "comments"), "silver", "comments",
                 partition_by=["comment_year"])
    return lake.read("silver", "comments")


RELOAD_TS = "2024-07-01 00:00:00"
RELOAD_FROM_YEAR = 2000


@register("overwrite_dynamic_partitions", W(["silver_comments"], f"""
SELECT * REPLACE (CASE WHEN comment_year >= {RELOAD_FROM_YEAR}
                       THEN TIMESTAMP '{RELOAD_TS}' ELSE load_date END AS load_date)
FROM silver_comments"""))
def q_overwrite_dynamic_partitions(spark, sf):
    lake = _lake(spark)
    lake.create(silver_frame(spark, sf, "comments"), "silver", "comments",
                partition_by=["comment_year"])
    reload = silver.comments_to_silver(bronze(spark, sf, "comments"), load_ts=RELOAD_TS)
    lake.overwrite_partitions(reload.where(F.col("comment_year") >= RELOAD_FROM_YEAR),
                              "silver", "comments", ["comment_year"])
    return lake.read("silver", "comments")


def upsert_target(spark, sf):
    return silver_frame(spark, sf, "posts").where(
        F.col("creation_date") < F.lit(O.UPSERT_SPLIT_OLD).cast("timestamp_ntz"))


def upsert_source(spark, sf):
    return (silver_frame(spark, sf, "posts")
            .where(F.col("creation_date") >= F.lit(O.UPSERT_SPLIT_NEW).cast("timestamp_ntz"))
            .withColumn("score", F.col("score") + 1))


def upsert_source_dup(spark, sf):
    again = (silver_frame(spark, sf, "posts").where(F.col("post_year") == O.CONFLICT_YEAR)
             .withColumn("score", F.col("score") + 2))
    return upsert_source(spark, sf).unionByName(again)


_MERGED_ONE_KEY = W(["upsert_target", "upsert_source"], """
SELECT * FROM upsert_source UNION ALL
SELECT * FROM upsert_target t
WHERE NOT EXISTS (SELECT 1 FROM upsert_source s WHERE s.post_id = t.post_id)""")

_UNMATCHED_TWO_KEYS = """
SELECT * FROM upsert_target t
WHERE NOT EXISTS (SELECT 1 FROM upsert_source s
                  WHERE s.post_id = t.post_id AND s.owner_user_id = t.owner_user_id)"""


@register("merge_upsert", _MERGED_ONE_KEY)
def q_merge_upsert(spark, sf):
    lake = _lake(spark)
    lake.create(upsert_target(spark, sf), "silver", "posts")
    lake.merge(upsert_source(spark, sf), "silver", "posts", ["post_id"])
    return lake.read("silver", "posts")


@register("merge_upsert_partitioned", _MERGED_ONE_KEY)
def q_merge_upsert_partitioned(spark, sf):
    """Same upsert on a year-partitioned table, rewriting only touched years."""
    lake = _lake(spark)
    lake.create(upsert_target(spark, sf), "silver", "posts", partition_by=["post_year"])
    lake.merge(upsert_source(spark, sf), "silver", "posts", ["post_id"],
               partition_by=["post_year"], scope="partitions")
    return lake.read("silver", "posts")


def day_batch(spark, sf):
    """A day's posts, changed: a batch that is small beside its table."""
    day = F.col("creation_date").cast("date") == F.lit(O.MERGE_DAY).cast("date")
    return silver_frame(spark, sf, "posts").where(day).withColumn("score", F.col("score") + 1)


def _merged_by_bucket(spark, sf) -> Lakehouse:
    lake = _lake(spark)
    for rows in (silver_frame(spark, sf, "posts"), day_batch(spark, sf)):
        lake.merge(rows, "silver", "posts", ["post_id"], scope="buckets", buckets=64)
    return lake


@register("merge_upsert_buckets", W(["silver_posts", "day_batch"], """
SELECT * FROM day_batch UNION ALL
SELECT * FROM silver_posts t WHERE NOT EXISTS (SELECT 1 FROM day_batch s WHERE s.post_id = t.post_id)"""))
def q_merge_upsert_buckets(spark, sf):
    """The upsert on a table without partitions of its own, laid out by hash buckets of the key."""
    return _merged_by_bucket(spark, sf).read("silver", "posts")


@register("merge_buckets_history", W(["silver_posts", "day_batch"], """
SELECT CAST(2 AS BIGINT) AS version, 'merge' AS operation, (SELECT COUNT(*) FROM day_batch) AS added,
       (SELECT COUNT(*) FROM silver_posts) AS total, TRUE AS read_the_touched_buckets_only"""))
def q_merge_buckets_history(spark, sf):
    """The history of that upsert: the records it read are those of the batch's buckets."""
    lake = _merged_by_bucket(spark, sf)
    bucket = F.pmod(F.xxhash64("post_id"), F.lit(64)).alias("bucket")
    of_batch = day_batch(spark, sf).select(bucket).distinct()
    should = lake.read("silver", "posts").select(bucket).join(of_batch, "bucket", "left_semi").agg(
        F.count("*").alias("n_rows"), F.count_distinct("bucket").alias("buckets")).first()
    s = F.col("summary")
    only = ((s["read-records"].cast("long") == should["n_rows"])
            & (s["rewritten-buckets"].cast("long") == should["buckets"]))
    return lake.history("silver", "posts").where("version = 2").select(
        "version", "operation", s["added-records"].cast("long").alias("added"),
        s["total-records"].cast("long").alias("total"), only.alias("read_the_touched_buckets_only"))


@register("merge_staged_view", W(["upsert_target", "upsert_source"], """
SELECT s.post_year, COUNT(*) AS n_rows, COUNT(t.post_id) AS n_updates
FROM upsert_source s LEFT JOIN upsert_target t ON s.post_id = t.post_id GROUP BY s.post_year"""))
def q_merge_staged_view(spark, sf):
    """What a staged batch is about to change, in SQL over its temporary view before the merge."""
    lake, ns = _lake(spark), _private_layer()
    lake.create(upsert_target(spark, sf), ns, "posts")
    with lake.staged_view(upsert_source(spark, sf), f"batch_{ns}") as batch:
        preview = spark.sql(f"""
            SELECT s.post_year, count(*) AS n_rows, count(t.post_id) AS n_updates
            FROM batch_{ns} s LEFT JOIN {ns}.posts t ON s.post_id = t.post_id GROUP BY s.post_year""")
        path = scratch_path(spark, "previews")
        preview.write.parquet(path)
        lake.merge(batch, ns, "posts", ["post_id"])
    return spark.read.parquet(path)


@register("merge_upsert_partitioned_moved", W(["upsert_target", "upsert_source_moved"], """
SELECT * FROM upsert_source_moved UNION ALL
SELECT * FROM upsert_target t
WHERE NOT EXISTS (SELECT 1 FROM upsert_source_moved s WHERE s.post_id = t.post_id)"""))
def q_merge_upsert_partitioned_moved(spark, sf):
    """Partition-scoped upsert whose batch moves matched keys to another year."""
    moved = upsert_source(spark, sf).withColumn(
        "post_year", F.when(F.col("post_year") == O.CONFLICT_YEAR, F.col("post_year") + 1)
                      .otherwise(F.col("post_year")))
    lake = _lake(spark)
    lake.create(upsert_target(spark, sf), "silver", "posts", partition_by=["post_year"])
    lake.merge(moved, "silver", "posts", ["post_id"], partition_by=["post_year"],
               scope="partitions")
    return lake.read("silver", "posts")


@register("merge_upsert_null_partition", W(["null_year_target", "null_year_source"], """
SELECT * FROM null_year_source UNION ALL
SELECT * FROM null_year_target t
WHERE NOT EXISTS (SELECT 1 FROM null_year_source s WHERE s.post_id = t.post_id)"""))
def q_merge_upsert_null_partition(spark, sf):
    """Partition-scoped upsert that moves keys out of and into the NULL year."""
    def undated(df, some):
        return df.withColumn("post_year", F.when(some, F.lit(None).cast("int")).otherwise(F.col("post_year")))
    lake = _lake(spark)
    lake.create(undated(upsert_target(spark, sf), F.col("post_id") % 3 == 0), "silver", "posts",
                partition_by=["post_year"])
    lake.merge(undated(upsert_source(spark, sf), F.col("post_id") % 5 == 1), "silver", "posts",
               ["post_id"], partition_by=["post_year"], scope="partitions")
    return lake.read("silver", "posts")


@register("read_bronze_mixed_folder", W(["bronze_comments"], "SELECT * FROM bronze_comments"))
def q_read_bronze_mixed_folder(spark, sf):
    """A loader folder with conforming files and a foreign one: exactly the former."""
    root = scratch_path(spark, "bronze")
    B.land(roles.raw(spark, sf, "badges"), f"{root}/comments_2021")
    B.land(roles.raw(spark, sf, "comments"), f"{root}/comments_2021", mode="append")
    return B.read_bronze(spark, root, "comments", 2021)


@register("merge_upsert_composite", W(["upsert_target", "upsert_source"],
                                      "SELECT * FROM upsert_source UNION ALL"
                                      + _UNMATCHED_TWO_KEYS))
def q_merge_upsert_composite(spark, sf):
    lake = _lake(spark)
    lake.create(upsert_target(spark, sf), "silver", "posts")
    lake.merge(upsert_source(spark, sf), "silver", "posts", ["post_id", "owner_user_id"])
    return lake.read("silver", "posts")


@register("merge_cardinality_check", W(["upsert_target", "upsert_source_dup"], """
SELECT post_id, COUNT(*) AS n_source_rows FROM upsert_source_dup
WHERE post_id IS NOT NULL GROUP BY post_id
HAVING COUNT(*) > 1 AND post_id IN (SELECT post_id FROM upsert_target)"""))
def q_merge_cardinality_check(spark, sf):
    return upsert.merge_conflicts(upsert_source_dup(spark, sf), upsert_target(spark, sf),
                                  ["post_id"])


@register("join_merge_match", W(["upsert_target", "upsert_source"], _UNMATCHED_TWO_KEYS))
def q_join_merge_match(spark, sf):
    return upsert.unmatched_target(upsert_target(spark, sf), upsert_source(spark, sf),
                                   ["post_id", "owner_user_id"])


def _merged_twice(spark, sf) -> Lakehouse:
    """create(target) → merge(source) → merge(source) again."""
    lake = _lake(spark)
    lake.create(upsert_target(spark, sf), "silver", "posts")
    lake.merge(upsert_source(spark, sf), "silver", "posts", ["post_id"])
    lake.merge(upsert_source(spark, sf), "silver", "posts", ["post_id"])
    return lake


@register("load_history", W(["upsert_target", "upsert_source"], """
SELECT CAST(1 AS BIGINT) AS version, 'append' AS operation,
       CAST((SELECT COUNT(*) FROM upsert_target) AS VARCHAR) AS added_records,
       '0' AS deleted_records
UNION ALL
SELECT 2, 'merge', CAST((SELECT COUNT(*) FROM upsert_source) AS VARCHAR),
       CAST((SELECT COUNT(*) FROM upsert_target
             WHERE post_id IN (SELECT post_id FROM upsert_source)) AS VARCHAR)
UNION ALL
SELECT 3, 'merge', CAST((SELECT COUNT(*) FROM upsert_source) AS VARCHAR),
       CAST((SELECT COUNT(*) FROM upsert_source) AS VARCHAR)"""))
def q_load_history(spark, sf):
    h = _merged_twice(spark, sf).history("silver", "posts", newest_first=True)
    return h.select("version", "operation",
                    F.col("summary")["added-records"].alias("added_records"),
                    F.col("summary")["deleted-records"].alias("deleted_records"))


@register("load_history_chronological", W(["upsert_target", "upsert_source"], """
SELECT CAST(1 AS BIGINT) AS version, 'append' AS operation, (SELECT COUNT(*) FROM upsert_target) AS added,
       (SELECT COUNT(*) FROM upsert_target) AS total, TRUE AS times_ascend
UNION ALL
SELECT v, 'merge', (SELECT COUNT(*) FROM upsert_source),
       (SELECT COUNT(*) FROM silver_posts), TRUE FROM (VALUES (2), (3)) later(v)"""))
def q_load_history_chronological(spark, sf):
    """Oldest first; commit times themselves differ by run, so their order is returned."""
    h = _merged_twice(spark, sf).history("silver", "posts", newest_first=False)
    earlier = F.lag("committed_at").over(Window.partitionBy("table_name").orderBy("version"))
    return h.select("version", "operation", F.col("summary")["added-records"].cast("long").alias("added"),
                    F.col("summary")["total-records"].cast("long").alias("total"),
                    F.coalesce(F.col("committed_at") > earlier, F.lit(True)).alias("times_ascend"))


@register("load_count", W(["upsert_target", "upsert_source"], """
SELECT 'posts' AS table_name, CAST(COUNT(*) AS BIGINT) AS n_loads
FROM (SELECT 1 WHERE EXISTS (FROM upsert_target)
      UNION ALL SELECT 1 FROM (VALUES (2), (3)) again WHERE EXISTS (FROM upsert_source)) loads"""))
def q_load_count(spark, sf):
    return _merged_twice(spark, sf).load_counts("silver").select("table_name", "n_loads")


_SILVER_WIDTH = {"comments": 14, "badges": 9, "users": 15, "posts": 26}


def _verify_sql(tables: dict[str, int], loads: dict[str, int] | None = None) -> str:
    loads = loads or {}
    return W([f"silver_{t}" for t in tables], " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST({w} AS BIGINT) AS n_columns, "
        f"CAST({loads.get(t, 1)} AS BIGINT) AS n_loads, TRUE AS has_load_date, "
        f"COUNT(*) AS n_rows FROM silver_{t}" for t, w in tables.items()))


@register("verify_table", _verify_sql(_SILVER_WIDTH))
def q_verify_table(spark, sf):
    lake = _lake(spark)
    for t in _SILVER_WIDTH:
        lake.create(silver_frame(spark, sf, t), "silver", t)
    return lake.verify("silver", list(_SILVER_WIDTH))


@register("verify_merge_history", """
SELECT 'badges' AS table_name, CAST(1 AS BIGINT) AS n_loads, FALSE AS merged UNION ALL
SELECT 'posts', 2, TRUE UNION ALL SELECT 'users', 1, FALSE""")
def q_verify_merge_history(spark, sf):
    lake = _lake(spark)
    for t in ("badges", "users", "posts"):
        lake.merge(silver_frame(spark, sf, t), "silver", t, pipeline.SILVER_KEYS[t])
    lake.merge(silver_frame(spark, sf, "posts"), "silver", "posts", ["post_id"])
    return lake.merge_report("silver")


# ---- 2.3 projections, filters, predicates ---------------------------------

@register("project_rename", W(["bronze_badges"], """
SELECT id AS badge_id, user_id, name AS badge_name, "date" AS award_date,
       "class" AS badge_class, tag_based AS is_tag_based FROM bronze_badges"""))
def q_project_rename(spark, sf):
    return normalize_columns(roles.raw(spark, sf, "badges")).withColumnsRenamed(
        {"id": "badge_id", "name": "badge_name", "date": "award_date", "class": "badge_class",
         "tag_based": "is_tag_based"})


@register("project_select", W(["silver_users"],
                              "SELECT user_id, display_name, load_date FROM silver_users"))
def q_project_select(spark, sf):
    return silver_frame(spark, sf, "users").select("user_id", "display_name", "load_date")


@register("project_alias", W(["bronze_comments"], """
SELECT id AS comment_id, post_id, text AS comment_text FROM bronze_comments"""))
def q_project_alias(spark, sf):
    b = normalize_columns(roles.raw(spark, sf, "comments"))
    return b.select(F.col("id").alias("comment_id"), "post_id",
                    F.col("text").alias("comment_text"))


_POSTS_PER_OWNER = ("(SELECT owner_user_id, COUNT(*) AS total_posts FROM silver_posts "
                    "WHERE owner_user_id IS NOT NULL GROUP BY owner_user_id)")


@register("project_drop", W(["silver_users", "silver_posts"], f"""
SELECT u.user_id, u.display_name, p.total_posts
FROM silver_users u LEFT JOIN {_POSTS_PER_OWNER} p ON u.user_id = p.owner_user_id"""))
def q_project_drop(spark, sf):
    u = silver_frame(spark, sf, "users").select("user_id", "display_name")
    p = (silver_frame(spark, sf, "posts").where(F.col("owner_user_id").isNotNull())
         .groupBy("owner_user_id").agg(F.count(F.lit(1)).alias("total_posts")))
    return u.join(p, u.user_id == p.owner_user_id, "left").drop("owner_user_id")


@register("project_derive", W(["silver_comments"], """
SELECT comment_id, score_category, text_length, has_user_display_name FROM silver_comments"""))
def q_project_derive(spark, sf):
    b = normalize_columns(roles.raw(spark, sf, "comments"))
    return b.withColumns({
        "score_category": X.score_category("score"),
        "text_length": X.text_length("text"),
        "has_user_display_name": X.non_empty_flag("user_display_name"),
    }).select(F.col("id").alias("comment_id"), "score_category", "text_length",
              "has_user_display_name")


@register("literal_column", W(["bronze_posts"], f"""
SELECT id AS post_id, 2021 AS post_year, TIMESTAMP '{O.LOAD_TS}' AS load_date
FROM bronze_posts"""))
def q_literal_column(spark, sf):
    b = normalize_columns(roles.raw(spark, sf, "posts"))
    return b.select(F.col("id").alias("post_id"), F.lit(2021).alias("post_year"),
                    X.as_timestamp(O.LOAD_TS).alias("load_date"))


@register("filter_not_null", W(["silver_posts"], """
SELECT post_id, owner_user_id FROM silver_posts WHERE owner_user_id IS NOT NULL"""))
def q_filter_not_null(spark, sf):
    return (silver_frame(spark, sf, "posts").where(F.col("owner_user_id").isNotNull())
            .select("post_id", "owner_user_id"))


@register("filter_equals", W(["silver_users"],
                             f"SELECT * FROM silver_users WHERE user_id = {BROWSE_USER}"))
def q_filter_equals(spark, sf):
    return silver_frame(spark, sf, "users").where(F.col("user_id") == BROWSE_USER)


@register("filter_decoded", W(["silver_comments"], """
SELECT * FROM silver_comments
WHERE comment_text IS NOT NULL AND NOT contains(comment_text, '[DECODE_ERROR]')"""))
def q_filter_decoded(spark, sf):
    return silver_frame(spark, sf, "comments", decoded_only="reference")


@register("predicate_compare", W(["silver_comments"], """
SELECT comment_id, score FROM silver_comments WHERE score >= 5 OR score <= 0 OR score = 2"""))
def q_predicate_compare(spark, sf):
    s = F.col("score")
    return (silver_frame(spark, sf, "comments").where((s >= 5) | (s <= 0) | (s == 2))
            .select("comment_id", "score"))


@register("predicate_logic", W(["silver_comments"], """
SELECT comment_id FROM silver_comments
WHERE (user_display_name IS NULL OR user_display_name = '') AND NOT (score >= 5)"""))
def q_predicate_logic(spark, sf):
    d, s = F.col("user_display_name"), F.col("score")
    return (silver_frame(spark, sf, "comments").where((d.isNull() | (d == "")) & ~(s >= 5))
            .select("comment_id"))


@register("predicate_null", W(["silver_comments"], """
SELECT comment_id, post_id FROM silver_comments
WHERE user_id IS NULL AND comment_text IS NOT NULL"""))
def q_predicate_null(spark, sf):
    return (silver_frame(spark, sf, "comments")
            .where(F.col("user_id").isNull() & F.col("comment_text").isNotNull())
            .select("comment_id", "post_id"))


@register("case_bucket", W(["silver_comments"],
                           "SELECT comment_id, score, score_category FROM silver_comments"))
def q_case_bucket(spark, sf):
    return silver_frame(spark, sf, "comments").select("comment_id", "score", "score_category")


@register("case_flag", W(["silver_comments"], """
SELECT comment_id, user_display_name, has_user_display_name FROM silver_comments"""))
def q_case_flag(spark, sf):
    return silver_frame(spark, sf, "comments").select(
        "comment_id", "user_display_name", "has_user_display_name")


# ---- 2.4 joins -------------------------------------------------------------

@register("join_left_equi_expr", W(["silver_users", "silver_posts"], f"""
SELECT u.user_id, u.display_name, p.owner_user_id, p.total_posts
FROM silver_users u LEFT JOIN {_POSTS_PER_OWNER} p ON u.user_id = p.owner_user_id"""))
def q_join_left_equi_expr(spark, sf):
    u = silver_frame(spark, sf, "users").select("user_id", "display_name")
    p = (silver_frame(spark, sf, "posts").where(F.col("owner_user_id").isNotNull())
         .groupBy("owner_user_id").agg(F.count(F.lit(1)).alias("total_posts")))
    return u.join(p, u.user_id == p.owner_user_id, "left")


@register("join_left_using", W(["silver_users", "silver_comments", "silver_badges"], """
SELECT u.user_id, u.display_name, c.total_comments, b.total_badges
FROM silver_users u
LEFT JOIN (SELECT user_id, COUNT(*) AS total_comments FROM silver_comments
           WHERE user_id IS NOT NULL GROUP BY user_id) c USING (user_id)
LEFT JOIN (SELECT user_id, COUNT(*) AS total_badges FROM silver_badges
           WHERE user_id IS NOT NULL GROUP BY user_id) b USING (user_id)"""))
def q_join_left_using(spark, sf):
    return left_join_using(silvers(spark, sf))


def left_join_using(s: dict[str, DataFrame]) -> DataFrame:
    return (s["users"].select("user_id", "display_name")
            .join(gold._count_per(s["comments"], "user_id", "total_comments"), "user_id", "left")
            .join(gold._count_per(s["badges"], "user_id", "total_badges"), "user_id", "left"))


@register("join_left_using_colocated", ORACLES["join_left_using"])
def q_join_left_using_colocated(spark, sf):
    """The same join of tables bucketed by user: no row of a fact table is exchanged."""
    return left_join_using(colocated_silver(spark, sf, ("users", "comments", "badges")))


@register("gold_user_engagement_colocated", O.GOLD_USER_ENGAGEMENT)
def q_gold_user_engagement_colocated(spark, sf):
    s = colocated_silver(spark, sf)
    return gold.user_engagement_score(s["users"], s["posts"], s["comments"], s["badges"], run_ts=O.RUN_TS)


@register("join_left_fact_dim", W(["silver_comments", "silver_users"], """
SELECT c.comment_id, c.user_id, u.display_name, u.is_active
FROM silver_comments c LEFT JOIN silver_users u ON c.user_id = u.user_id"""))
def q_join_left_fact_dim(spark, sf):
    s = silvers(spark, sf)
    return left_join_fact_dim(s["comments"].select("comment_id", "user_id"),
                              s["users"].select("user_id", "display_name", "is_active"),
                              "user_id")


@register("join_inner_equi", W(["silver_posts", "silver_users"], """
SELECT p.post_id, u.user_id, u.display_name
FROM silver_posts p JOIN silver_users u ON p.owner_user_id = u.user_id"""))
def q_join_inner_equi(spark, sf):
    s = silvers(spark, sf)
    p = s["posts"].select("post_id", "owner_user_id")
    u = s["users"].select("user_id", "display_name")
    return p.join(u, p.owner_user_id == u.user_id, "inner").select("post_id", "user_id",
                                                                   "display_name")


@register("join_left_derived", W(["silver_users", "activity"], """
SELECT u.user_id, u.display_name, NULLIF(a.total_posts, 0) AS total_posts,
       NULLIF(a.total_comments, 0) AS total_comments, NULLIF(a.total_badges, 0) AS total_badges
FROM silver_users u LEFT JOIN activity a ON a.user_id = u.user_id"""))
def q_join_left_derived(spark, sf):
    s = silvers(spark, sf)
    return (s["users"].select("user_id", "display_name")
            .join(gold._count_per(s["posts"], "owner_user_id", "total_posts"), "user_id", "left")
            .join(gold._count_per(s["comments"], "user_id", "total_comments"), "user_id", "left")
            .join(gold._count_per(s["badges"], "user_id", "total_badges"), "user_id", "left"))


# ---- 2.5 aggregations ------------------------------------------------------

@register("agg_count_star", W(["silver_comments"], """
SELECT post_id, COUNT(*) AS total_comments FROM silver_comments GROUP BY post_id"""))
def q_agg_count_star(spark, sf):
    return (silver_frame(spark, sf, "comments").groupBy("post_id")
            .agg(F.count(F.lit(1)).alias("total_comments")))


@register("agg_count_if", W(["silver_posts"], """
SELECT owner_user_id, COUNT(CASE WHEN post_type_id = 1 THEN 1 END) AS question_count
FROM silver_posts GROUP BY owner_user_id"""))
def q_agg_count_if(spark, sf):
    return (silver_frame(spark, sf, "posts").groupBy("owner_user_id")
            .agg(F.count_if(F.col("post_type_id") == 1).alias("question_count")))


@register("agg_sum_case", W(["silver_badges"], """
SELECT user_id, CAST(SUM(CASE WHEN badge_class = 1 THEN 1 ELSE 0 END) AS BIGINT) AS gold_badges
FROM silver_badges GROUP BY user_id"""))
def q_agg_sum_case(spark, sf):
    return (silver_frame(spark, sf, "badges").groupBy("user_id")
            .agg(F.sum(F.when(F.col("badge_class") == 1, 1).otherwise(0)).alias("gold_badges")))


@register("agg_count_distinct", W(["silver_comments"], """
SELECT comment_year, COUNT(DISTINCT user_id) AS unique_users FROM silver_comments
GROUP BY comment_year"""))
def q_agg_count_distinct(spark, sf):
    return (silver_frame(spark, sf, "comments").groupBy("comment_year")
            .agg(F.count_distinct("user_id").alias("unique_users")))


@register("agg_avg", W(["silver_comments"], """
SELECT comment_year, comment_month, AVG(text_length) AS avg_length FROM silver_comments
GROUP BY comment_year, comment_month"""))
def q_agg_avg(spark, sf):
    return (silver_frame(spark, sf, "comments").groupBy("comment_year", "comment_month")
            .agg(F.avg("text_length").alias("avg_length")))


@register("agg_max", W(["silver_comments"], """
SELECT user_id, MAX(creation_date) AS last_comment_date FROM silver_comments GROUP BY user_id"""))
def q_agg_max(spark, sf):
    return (silver_frame(spark, sf, "comments").groupBy("user_id")
            .agg(F.max("creation_date").alias("last_comment_date")))


@register("agg_group_multi_key", W(["silver_posts"], """
SELECT post_year, post_month, post_type_id, owner_user_id, COUNT(*) AS total_posts
FROM silver_posts GROUP BY post_year, post_month, post_type_id, owner_user_id"""))
def q_agg_group_multi_key(spark, sf):
    return (silver_frame(spark, sf, "posts")
            .groupBy("post_year", "post_month", "post_type_id", "owner_user_id")
            .agg(F.count(F.lit(1)).alias("total_posts")))


@register("agg_global_count", W(["silver_comments"],
                                "SELECT COUNT(*) AS n_rows FROM silver_comments"))
def q_agg_global_count(spark, sf):
    return silver_frame(spark, sf, "comments").agg(F.count(F.lit(1)).alias("n_rows"))


# ---- 2.7 sort, limit, top-k ------------------------------------------------

def _ranked(sql: str, order: str) -> str:
    return f"SELECT *, ROW_NUMBER() OVER (ORDER BY {order}) AS place FROM ({sql}) g"


def _with_place(spark, df, order) -> DataFrame:
    """The sorted rows with the place they come in: the sort is written and read back
    in order, one file per range partition, and the partitions' rows are counted up."""
    path = scratch_path(spark, "sorted")
    (df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()).write.parquet(path))
    back = spark.read.parquet(path)  # id = partition * 2^33 + row, ascending in the sort's order
    part = F.shiftright("_id", 33)
    counts = back.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (back.withColumn("_part", part).join(starts, "_part")
            .select(*df.columns, (F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("place")))


@register("sort_asc_multi", _ranked(O.GOLD_COMMENT_ACTIVITY, "comment_year NULLS LAST, comment_month NULLS LAST"))
def q_sort_asc_multi(spark, sf):
    return _with_place(spark, gold.comment_activity(silver_frame(spark, sf, "comments")),
                       [F.asc_nulls_last("comment_year"), F.asc_nulls_last("comment_month")])


@register("sort_desc", _ranked(O.GOLD_BADGE_DISTRIBUTION, "total_awards DESC NULLS LAST, badge_name, badge_year"))
def q_sort_desc(spark, sf):
    return _with_place(spark, gold.badge_distribution(silver_frame(spark, sf, "badges")),
                       [F.desc_nulls_last("total_awards"), F.asc_nulls_last("badge_name"), F.asc_nulls_last("badge_year")])


@register("topk_multi_desc", O.QUERY_POSTS_PER_USER_TOP20)
def q_topk_multi_desc(spark, sf):
    return analytics.posts_per_user_top(silver_frame(spark, sf, "posts"), 20)


@register("limit_rows", W(["silver_posts"], "SELECT * FROM silver_posts ORDER BY post_id LIMIT 100"))
def q_limit_rows(spark, sf):
    return analytics.browse(silver_frame(spark, sf, "posts"), 100, "post_id")


# ---- 2.8 set operations ----------------------------------------------------

UNION_SPLIT = "1998-01-01"


@register("union_all_sources", W(["silver_comments"], "SELECT * FROM silver_comments"))
def q_union_all_sources(spark, sf):
    b = bronze(spark, sf, "comments")
    cut = F.lit(UNION_SPLIT).cast("timestamp_ntz")
    df, _ = silver.union_sources([
        ("early", lambda: silver.comments_to_silver(b.where(F.col("creation_date") < cut),
                                                    load_ts=O.LOAD_TS)),
        ("late", lambda: silver.comments_to_silver(b.where(F.col("creation_date") >= cut),
                                                   load_ts=O.LOAD_TS)),
    ])
    return df


# ---- 2.9 scalar functions --------------------------------------------------

@register("fn_to_timestamp", """
SELECT event_id, ts AS parsed, CAST(NULL AS TIMESTAMP) AS unparsable FROM events""")
def q_fn_to_timestamp(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").select(
        "event_id", F.col("ts").cast("string").alias("ts_text"), "props")
    return e.select("event_id", X.timestamp_col(e, "ts_text").alias("parsed"),
                    X.timestamp_col(e, "props").alias("unparsable"))


@register("fn_year", W(["silver_badges"], "SELECT badge_id, badge_year FROM silver_badges"))
def q_fn_year(spark, sf):
    b = normalize_columns(roles.raw(spark, sf, "badges"))
    return b.select(F.col("id").alias("badge_id"), F.year("date").alias("badge_year"))


@register("fn_month", W(["silver_posts"], "SELECT post_id, post_month FROM silver_posts"))
def q_fn_month(spark, sf):
    return silver_frame(spark, sf, "posts").select("post_id", "post_month")


@register("fn_dayofmonth", W(["silver_posts"], "SELECT post_id, post_day FROM silver_posts"))
def q_fn_dayofmonth(spark, sf):
    return silver_frame(spark, sf, "posts").select("post_id", "post_day")


@register("fn_datediff_age", W(["silver_users"], "SELECT user_id, user_age_days FROM silver_users"))
def q_fn_datediff_age(spark, sf):
    return silver_frame(spark, sf, "users").select("user_id", "user_age_days")


@register("fn_is_active", W(["silver_users"],
                            "SELECT user_id, last_access_date, is_active FROM silver_users"))
def q_fn_is_active(spark, sf):
    return silver_frame(spark, sf, "users").select("user_id", "last_access_date", "is_active")


@register("fn_current_date", W(["bronze_users"], """
SELECT id AS user_id, CAST(date_diff('day', CAST(creation_date AS DATE), today) AS INTEGER) AS user_age_days,
       date_diff('day', CAST(last_access_date AS DATE), today) <= 365 AS is_active
FROM bronze_users CROSS JOIN (SELECT CAST(now() AT TIME ZONE 'UTC' AS DATE) AS today)"""))
def q_fn_current_date(spark, sf):
    u = silver.users_to_silver(bronze(spark, sf, "users"), load_ts=O.LOAD_TS, as_of=None)
    return u.select("user_id", "user_age_days", "is_active")


@register("fn_current_timestamp", "SELECT * EXCLUDE (fecha_cargue), TRUE AS stamped_in_run FROM ("
          + O.GOLD_USER_POST_METRICS + ") g")
def q_fn_current_timestamp(spark, sf):
    """The stamp differs by run, so whether it lies within the run is returned."""
    began = dt.datetime.now(dt.timezone.utc) - dt.timedelta(seconds=1)
    m = gold.user_post_metrics(silver_frame(spark, sf, "posts"), run_ts=None)
    stamp = F.col("fecha_cargue").cast("timestamp")
    within = (stamp >= F.lit(began)) & (stamp <= F.current_timestamp())
    return m.withColumn("stamped_in_run", within).drop("fecha_cargue")


@register("fn_cast_timestamp", W(["silver_badges"], "SELECT badge_id, load_date FROM silver_badges"))
def q_fn_cast_timestamp(spark, sf):
    return silver_frame(spark, sf, "badges").select("badge_id", "load_date")


@register("fn_length", """
SELECT doc_id AS id, CAST(LENGTH(text) AS INTEGER) AS text_length FROM documents""")
def q_fn_length(spark, sf):
    d = roles.documents_bronze(spark, sf)
    return d.select("id", X.text_length(decode_utf8("text")).alias("text_length"))


@register("fn_contains", W(["silver_comments"], """
SELECT comment_id, COALESCE(contains(comment_text, 'RR'), FALSE) AS has_rr
FROM silver_comments"""))
def q_fn_contains(spark, sf):
    c = silver_frame(spark, sf, "comments")
    return c.select("comment_id",
                    F.coalesce(F.col("comment_text").contains("RR"), F.lit(False)).alias("has_rr"))


@register("fn_coalesce_zero", W(["silver_users", "silver_badges"], """
SELECT u.user_id, COALESCE(b.total_badges, 0) AS total_badges FROM silver_users u
LEFT JOIN (SELECT user_id, COUNT(*) AS total_badges FROM silver_badges
           WHERE user_id IS NOT NULL GROUP BY user_id) b ON u.user_id = b.user_id"""))
def q_fn_coalesce_zero(spark, sf):
    s = silvers(spark, sf)
    j = s["users"].select("user_id").join(
        gold._count_per(s["badges"], "user_id", "total_badges"), "user_id", "left")
    return j.select("user_id", F.coalesce("total_badges", F.lit(0)).alias("total_badges"))


@register("fn_add", "SELECT user_id, engagement_score FROM (" + O.GOLD_USER_ENGAGEMENT + ") g")
def q_fn_add(spark, sf):
    return q_gold_user_engagement_score(spark, sf).select("user_id", "engagement_score")


@register("fn_map_get", W(["upsert_target", "upsert_source"], """
SELECT CAST(3 AS BIGINT) AS version,
       CAST((SELECT COUNT(*) FROM upsert_source) AS VARCHAR) AS added_records,
       CAST(NULL AS VARCHAR) AS missing
UNION ALL
SELECT 2, CAST((SELECT COUNT(*) FROM upsert_source) AS VARCHAR), NULL
UNION ALL
SELECT 1, CAST((SELECT COUNT(*) FROM upsert_target) AS VARCHAR), NULL"""))
def q_fn_map_get(spark, sf):
    h = _merged_twice(spark, sf).history("silver", "posts")
    return h.select("version", F.col("summary")["added-records"].alias("added_records"),
                    F.try_element_at("summary", F.lit("no-such-key")).alias("missing"))


@register("fn_case", W(["silver_comments"], """
SELECT comment_id, score_category, has_user_display_name FROM silver_comments"""))
def q_fn_case(spark, sf):
    return silver_frame(spark, sf, "comments").select(
        "comment_id", "score_category", "has_user_display_name")


# ---- 2.11 decode -------------------------------------------------------------

def _decoded_sql(mode: str) -> str:
    return (f"SELECT id, text, CAST(COALESCE(LENGTH(text), 0) AS INTEGER) AS text_length "
            f"FROM (SELECT doc_id AS id, {O.bad_bytes_text(mode)} AS text FROM documents) d")


@register("decode_utf8_strict", _decoded_sql("strict"))
def q_decode_utf8_strict(spark, sf):
    d = roles.documents_bad_bytes(spark, sf).select("id", decode_utf8("text").alias("text"))
    return d.select("id", "text", X.text_length("text").alias("text_length"))


@register("decode_utf8_ignore", _decoded_sql("ignore"))
def q_decode_utf8_ignore(spark, sf):
    d = roles.documents_bad_bytes(spark, sf).select("id", decode_utf8("text", "ignore").alias("text"))
    return d.select("id", "text", X.text_length("text").alias("text_length"))


def _bad_comments(spark, sf, **kw) -> DataFrame:
    return silver.comments_to_silver(roles.comments_bad_bytes(spark, sf), load_ts=O.LOAD_TS, **kw)


@register("silver_comments_bad_bytes", O.bad_comments_sql("strict", " WHERE doc_id % 3 <> 0"))
def q_silver_comments_bad_bytes(spark, sf):
    """Undecodable comments go; text with a genuine U+FFFD stays."""
    return _bad_comments(spark, sf)


@register("filter_decoded_bad_bytes", O.bad_comments_sql("strict", """
WHERE decoded IS NOT NULL AND NOT contains(decoded, '[DECODE_ERROR]')"""))
def q_filter_decoded_bad_bytes(spark, sf):
    return _bad_comments(spark, sf, decoded_only="reference")


@register("silver_comments_scheduled_bad_bytes", O.bad_comments_sql("ignore"))
def q_silver_comments_scheduled_bad_bytes(spark, sf):
    return _bad_comments(spark, sf, errors="ignore", decoded_only="none")


# ---- 2.12 composite silver/gold jobs ----------------------------------------

@register("silver_comments_scheduled", W(["silver_comments"], "SELECT * FROM silver_comments"))
def q_silver_comments_scheduled(spark, sf):
    return silver_frame(spark, sf, "comments", errors="ignore", decoded_only="none")


MISSING_YEAR = 1990


@register("silver_comments_multi_source", W(["silver_comments"], "SELECT * FROM silver_comments"))
def q_silver_comments_multi_source(spark, sf):
    root = scratch_path(spark, "bronze")
    b = roles.bronze(spark, sf, "comments").withColumn("year", F.year("CreationDate"))
    B.land(b, f"{root}/comments", partition_by=["year"])
    years = B.partition_years(spark, root, "comments") + [MISSING_YEAR]  # one source missing
    return pipeline.yearly_silver(spark, root, "comments", O.LOAD_TS, years, isolate=True)


@register("silver_other_datasets", _verify_sql({"badges": 9, "users": 15, "posts": 26}))
def q_silver_other_datasets(spark, sf):
    root = pipeline.land_roles(spark, sf, scratch_path(spark, "bronze"))
    years = B.partition_years(spark, root, "posts") + [MISSING_YEAR]
    verify, _ = pipeline.run_silver(spark, root, _lake(spark), O.LOAD_TS, O.AS_OF, years,
                                    datasets=["badges", "users", "posts"])
    return verify


def _silver_lake(spark, sf, loads: tuple[str, ...] = (O.LOAD_TS,)) -> Lakehouse:
    """A lakehouse after the silver job has run once per load time."""
    root = pipeline.land_roles(spark, sf, scratch_path(spark, "bronze"))
    lake = _lake(spark)
    for ts in loads:
        _, report = pipeline.run_silver(spark, root, lake, ts, O.AS_OF)
        assert all(ok for _, ok, _ in report.stages), report.stages
    return lake


def _register_silver_rows() -> None:
    """The rows of every silver table through the job, after one and after two loads."""
    for t in _SILVER_WIDTH:
        register(f"run_silver_{t}", W([f"silver_{t}"], f"SELECT * FROM silver_{t}"))(
            lambda spark, sf, t=t: _silver_lake(spark, sf).read("silver", t))
        register(f"run_silver_twice_{t}", W(
            [f"silver_{t}"], f"SELECT * REPLACE (TIMESTAMP '{RELOAD_TS}' AS load_date) FROM silver_{t}"))(
            lambda spark, sf, t=t: _silver_lake(spark, sf, (O.LOAD_TS, RELOAD_TS)).read("silver", t))


_register_silver_rows()


@register("load_history_partitioned", " UNION ALL ".join(
    W([f"silver_{t}"], f"SELECT '{t}' AS table_name, CAST(v AS BIGINT) AS version, "
      f"CASE v WHEN 1 THEN 'append' ELSE 'merge' END AS operation, n AS added_records, "
      f"CASE v WHEN 1 THEN 0 ELSE n END AS deleted_records, n AS total_records "
      f"FROM (SELECT COUNT(*) AS n FROM silver_{t}) c CROSS JOIN (VALUES (1), (2)) loads(v)")
    for t in ("comments", "posts")).replace("WITH", "SELECT * FROM (WITH", 1).replace(
        " UNION ALL WITH", ") a UNION ALL SELECT * FROM (WITH", 1) + ") b")
def q_load_history_partitioned(spark, sf):
    """Two silver loads of the year-partitioned tables: no commit is lost."""
    h = _silver_lake(spark, sf, (O.LOAD_TS, RELOAD_TS)).history("silver")
    return h.where(F.col("table_name").isin("comments", "posts")).select(
        "table_name", "version", "operation", "added_records", "deleted_records", "total_records")


@register("run_silver", _verify_sql(_SILVER_WIDTH))
def q_run_silver(spark, sf):
    root = pipeline.land_roles(spark, sf, scratch_path(spark, "bronze"))
    verify, _ = pipeline.run_silver(spark, root, _lake(spark), O.LOAD_TS, O.AS_OF)
    return verify


_GOLD_WIDTH = {"user_post_metrics": 5, "badges_summary": 7, "user_engagement": 8,
               "comment_activity": 6, "user_comment_engagement": 6, "post_summary": 5,
               "badge_distribution": 4}
_GOLD_SQL = {"user_post_metrics": O.GOLD_USER_POST_METRICS,
             "badges_summary": O.GOLD_BADGES_SUMMARY,
             "user_engagement": O.GOLD_USER_ENGAGEMENT,
             "comment_activity": O.GOLD_COMMENT_ACTIVITY,
             "user_comment_engagement": O.GOLD_USER_COMMENT_ENGAGEMENT,
             "post_summary": O.GOLD_POST_SUMMARY,
             "badge_distribution": O.GOLD_BADGE_DISTRIBUTION}


def _gold_verify_sql(names: list[str]) -> str:
    parts = []
    for n in names:
        parts.append(
            f"SELECT '{n}' AS table_name, CAST({_GOLD_WIDTH[n]} AS BIGINT) AS n_columns, "
            f"CAST(1 AS BIGINT) AS n_loads, "
            f"{'TRUE' if n == 'user_engagement' else 'FALSE'} AS has_load_date, "
            f"(SELECT COUNT(*) FROM ({_GOLD_SQL[n]}) g) AS n_rows")
    return " UNION ALL ".join(parts)


@register("run_gold_user_metrics", _gold_verify_sql(pipeline.GOLD_USER_METRICS))
def q_run_gold_user_metrics(spark, sf):
    return pipeline.run_gold_user_metrics(_silver_lake(spark, sf), run_ts=O.RUN_TS)


@register("run_gold_activity", _gold_verify_sql(pipeline.GOLD_ACTIVITY))
def q_run_gold_activity(spark, sf):
    return pipeline.run_gold_activity(_silver_lake(spark, sf), run_ts=O.RUN_TS)


REFRESH_YEAR = 1997


def _refreshed(spark, sf, table: str) -> DataFrame:
    """A gold table after a load of what changed in its silver tables and a refresh by the
    changed keys. Their old state has no rows from some year on, and that year's rows
    under other users, months and names."""
    lake, batches = _lake(spark), {}
    moved = {"posts": {"owner_user_id": F.col("owner_user_id") + 1, "post_type_id": F.lit(3)},
             "comments": {"user_id": F.coalesce(F.col("user_id"), F.lit(5)), "comment_month": F.lit(1)},
             "badges": {"user_id": F.coalesce(F.col("user_id") + 1, F.lit(3)), "badge_name": F.lit("old name")},
             "users": {"display_name": F.lit("before")}}
    for t in pipeline.GOLD_KEYS[table]:
        now = silver_frame(spark, sf, t)
        year = F.col("badge_year") if t == "badges" else F.year("creation_date")
        at = now.agg(F.max(year)).first()[0] if t == "badges" else REFRESH_YEAR  # events lie in years of their own
        old = now if t == "users" else now.where(year <= at)
        for c, value in moved[t].items():
            old = old.withColumn(c, F.when(year >= at, value.cast(now.schema[c].dataType)).otherwise(F.col(c)))
        pipeline.load_tracked(lake, t, old)
        batches[t] = now.where(year >= at)
    pipeline.refresh_gold(lake, {}, [table], O.RUN_TS)  # the first build
    pipeline.refresh_gold(lake, {t: pipeline.load_tracked(lake, t, b) for t, b in batches.items()}, [table], O.RUN_TS)
    return lake.read("gold", table)


def _register_refreshed_rows() -> None:
    """The rows of every gold table after a load and a refresh by its changed keys."""
    for name, sql in _GOLD_SQL.items():
        register(f"refresh_gold_{name}", sql)(lambda spark, sf, name=name: _refreshed(spark, sf, name))


_register_refreshed_rows()


def _register_gold_rows() -> None:
    """The rows of every gold table through the whole chain."""
    def make(name):
        def query(spark, sf):
            root = scratch_path(spark, "medallion")
            pipeline.run_medallion(spark, sf, root, load_ts=O.LOAD_TS, as_of=O.AS_OF, run_ts=O.RUN_TS)
            return Lakehouse(spark, f"{root}/lakehouse").read("gold", name)
        return query
    for name, sql in _GOLD_SQL.items():
        register(f"run_medallion_{name}", sql)(make(name))


_register_gold_rows()


@register("run_medallion", _gold_verify_sql(pipeline.GOLD_USER_METRICS + pipeline.GOLD_ACTIVITY))
def q_run_medallion(spark, sf):
    return pipeline.run_medallion(spark, sf, scratch_path(spark, "medallion"),
                                  load_ts=O.LOAD_TS, as_of=O.AS_OF, run_ts=O.RUN_TS)


# ---- console queries through spark.sql over the silver catalog tables -----

def _silver_catalog(spark, sf, query: str) -> str:
    """The silver tables that a console query names, written to a fresh lakehouse and
    registered in a namespace of their own; returns the namespace for the SQL text."""
    lake, ns = _lake(spark), _private_layer()
    for t in analytics.CONSOLE_SQL[query][0]:
        lake.create(silver_frame(spark, sf, t), ns, t)
    return ns


@register("query_posts_per_user_top20_sql", O.QUERY_POSTS_PER_USER_TOP20)
def q_posts_per_user_top20_sql(spark, sf):
    return analytics.console_sql(spark, "posts_per_user_top20",
                                 _silver_catalog(spark, sf, "posts_per_user_top20"))


@register("query_posts_per_named_user_top20_sql", O.QUERY_POSTS_PER_NAMED_USER_TOP20)
def q_posts_per_named_user_top20_sql(spark, sf):
    return analytics.console_sql(spark, "posts_per_named_user_top20",
                                 _silver_catalog(spark, sf, "posts_per_named_user_top20"))


@register("query_badge_statistics_sql", O.QUERY_BADGE_STATISTICS)
def q_badge_statistics_sql(spark, sf):
    return analytics.console_sql(spark, "badge_statistics",
                                 _silver_catalog(spark, sf, "badge_statistics"))


@register("query_user_engagement_sql", O.QUERY_USER_ENGAGEMENT)
def q_user_engagement_sql(spark, sf):
    return analytics.console_sql(spark, "user_engagement",
                                 _silver_catalog(spark, sf, "user_engagement"))


@register("browse_by_key_sql", W(["silver_posts"], f"""
SELECT * FROM silver_posts WHERE owner_user_id = {BROWSE_USER} ORDER BY post_id LIMIT 10"""))
def q_browse_by_key_sql(spark, sf):
    return analytics.console_sql(spark, "browse_posts_by_owner",
                                 _silver_catalog(spark, sf, "browse_posts_by_owner"), key=BROWSE_USER)
