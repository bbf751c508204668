"""Reference SQL for the registered queries, runnable by DuckDB.

The base test tables are pre-registered views. Bronze role frames and the
silver derivations are written once here as CTEs; each oracle is built as
``WITH <needed CTEs> <query>``. Typing follows Spark: YEAR/MONTH/DAY/LENGTH
and date differences are cast to INTEGER, SUMs of integers to BIGINT.
"""

from __future__ import annotations

# Fixed run parameters shared by queries() and the oracles.
LOAD_TS = "2024-06-01 00:00:00"
RUN_TS = "2024-06-02 00:00:00"
AS_OF = "2001-12-31"

_CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    _CTES[name] = (deps, body)


def with_ctes(needed: list[str], query: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    if not order:
        return query
    parts = [f"{n} AS (\n{_CTES[n][1]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + query


cte("bronze_users", [], """
SELECT c.c_custkey AS id, CAST(FLOOR(c.c_acctbal) AS BIGINT) AS reputation,
       o.first_order AS creation_date, c.c_name AS display_name,
       o.last_order AS last_access_date, c.c_mktsegment AS about_me,
       CAST(c.c_nationkey AS BIGINT) AS views, o.n_orders AS up_votes,
       o.n_finished AS down_votes, CAST(NULL AS VARCHAR) AS website_url,
       n.n_name AS location, c.c_custkey AS account_id
FROM customer c
LEFT JOIN (SELECT o_custkey, MIN(o_orderdate) AS first_order, MAX(o_orderdate) AS last_order,
                  COUNT(*) AS n_orders,
                  COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS n_finished
           FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")

cte("bronze_posts", [], """
SELECT o_orderkey AS id,
       CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS post_type_id,
       CAST(NULL AS BIGINT) AS accepted_answer_id, o_orderdate AS creation_date,
       CAST(FLOOR(o_totalprice / 10000) AS BIGINT) AS score,
       CAST(FLOOR(o_totalprice) AS BIGINT) AS view_count,
       'order ' || CAST(o_orderkey AS VARCHAR) AS body,
       CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_custkey END AS owner_user_id,
       CAST(NULL AS VARCHAR) AS owner_display_name, CAST(NULL AS BIGINT) AS last_editor_user_id,
       CAST(NULL AS VARCHAR) AS last_editor_display_name,
       CAST(NULL AS TIMESTAMP) AS last_edit_date, o_orderdate AS last_activity_date,
       o_orderpriority AS title, o_orderstatus AS tags,
       CAST(NULL AS INTEGER) AS answer_count, CAST(NULL AS INTEGER) AS comment_count,
       CAST(NULL AS INTEGER) AS favorite_count, 'CC BY-SA 4.0' AS content_license,
       CAST(NULL AS BIGINT) AS parent_id, CAST(NULL AS TIMESTAMP) AS community_owned_date,
       CAST(NULL AS TIMESTAMP) AS closed_date
FROM orders""")

cte("bronze_comments", [], """
SELECT (((l_orderkey * 10 + l_linenumber) * 20011 + l_partkey) * 1009 + l_suppkey) * 3001
         + date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS id, l_orderkey AS post_id,
       CASE WHEN l_orderkey % 23 = 0 THEN NULL
            ELSE CAST(FLOOR(l_quantity / 5) AS BIGINT) END AS score,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE REPEAT(l_returnflag, l_linenumber) END AS text,
       l_shipdate AS creation_date,
       CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE l_partkey END AS user_id,
       CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN '' ELSE l_linestatus END
           AS user_display_name
FROM lineitem""")

cte("bronze_badges", [], """
SELECT event_id AS id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE user_id END AS user_id,
       event_type AS name, ts AS "date",
       CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 ELSE 3 END AS "class",
       value >= 100 AS tag_based
FROM events""")

cte("silver_users", ["bronze_users"], f"""
SELECT id AS user_id, reputation, creation_date, display_name, last_access_date, about_me,
       views, up_votes, down_votes, website_url, location, account_id,
       CAST(date_diff('day', CAST(creation_date AS DATE), DATE '{AS_OF}') AS INTEGER)
           AS user_age_days,
       date_diff('day', CAST(last_access_date AS DATE), DATE '{AS_OF}') <= 365 AS is_active,
       TIMESTAMP '{LOAD_TS}' AS load_date
FROM bronze_users""")

POSTS_COLS = ("post_type_id, accepted_answer_id, creation_date, score, view_count, body, "
              "owner_user_id, owner_display_name, last_editor_user_id, "
              "last_editor_display_name, last_edit_date, last_activity_date, title, tags, "
              "answer_count, comment_count, favorite_count, content_license, parent_id, "
              "community_owned_date, closed_date")

cte("silver_posts", ["bronze_posts"], f"""
SELECT id AS post_id, {POSTS_COLS},
       CAST(year(creation_date) AS INTEGER) AS post_year,
       CAST(month(creation_date) AS INTEGER) AS post_month,
       CAST(day(creation_date) AS INTEGER) AS post_day,
       TIMESTAMP '{LOAD_TS}' AS load_date
FROM bronze_posts""")


def silver_comments_sql(where: str = "") -> str:
    return f"""
SELECT id AS comment_id, post_id, score, text AS comment_text, creation_date, user_id,
       user_display_name,
       CASE WHEN score >= 5 THEN 'high' WHEN score >= 1 THEN 'medium' ELSE 'low' END
           AS score_category,
       CAST(COALESCE(LENGTH(text), 0) AS INTEGER) AS text_length,
       CAST(year(creation_date) AS INTEGER) AS comment_year,
       CAST(month(creation_date) AS INTEGER) AS comment_month,
       CAST(day(creation_date) AS INTEGER) AS comment_day,
       COALESCE(user_display_name <> '', FALSE) AS has_user_display_name,
       TIMESTAMP '{LOAD_TS}' AS load_date
FROM bronze_comments{where}"""


cte("silver_comments", ["bronze_comments"], silver_comments_sql())

# ---- invalid bytes: strict gives the marker, ignore drops FF and the lone C3 ----
MARKER = "[DECODE_ERROR: invalid UTF-8]"


def bad_bytes_text(mode: str) -> str:
    """Decoded text of the documents with invalid bytes (``roles.documents_bad_bytes``)."""
    left, right = "substr(text, 1, length(text) // 2)", "substr(text, length(text) // 2 + 1)"
    broken = f"'{MARKER}'" if mode == "strict" else f"{left} || '(' || chr(65533) || {right}"
    return (f"CASE WHEN text IS NULL THEN NULL WHEN doc_id % 3 = 0 THEN {broken} "
            f"WHEN doc_id % 3 = 1 THEN {left} || chr(65533) || {right} ELSE text END")


def bad_comments_sql(mode: str, where: str = "") -> str:
    """Silver comments over ``roles.comments_bad_bytes``."""
    return f"""
SELECT doc_id AS comment_id, doc_id % 100 AS post_id, doc_id % 7 AS score, decoded AS comment_text,
       made AS creation_date, doc_id % 50 AS user_id, source AS user_display_name,
       CASE WHEN doc_id % 7 >= 5 THEN 'high' WHEN doc_id % 7 >= 1 THEN 'medium' ELSE 'low' END AS score_category,
       CAST(COALESCE(LENGTH(decoded), 0) AS INTEGER) AS text_length,
       CAST(year(made) AS INTEGER) AS comment_year, CAST(month(made) AS INTEGER) AS comment_month,
       CAST(day(made) AS INTEGER) AS comment_day,
       COALESCE(source <> '', FALSE) AS has_user_display_name, TIMESTAMP '{LOAD_TS}' AS load_date
FROM (SELECT *, {bad_bytes_text(mode)} AS decoded,
             TIMESTAMP '2020-01-01' + to_days(CAST(doc_id % 1000 AS INTEGER)) AS made FROM documents) d{where}"""


cte("silver_badges", ["bronze_badges"], f"""
SELECT id AS badge_id, user_id, name AS badge_name, "date" AS award_date,
       "class" AS badge_class, tag_based AS is_tag_based,
       CAST(year("date") AS INTEGER) AS badge_year,
       CAST(month("date") AS INTEGER) AS badge_month,
       TIMESTAMP '{LOAD_TS}' AS load_date
FROM bronze_badges""")

# ---- gold ---------------------------------------------------------------

GOLD_USER_POST_METRICS = with_ctes(["silver_posts"], f"""
SELECT owner_user_id AS user_id,
       COUNT(*) FILTER (WHERE post_type_id = 1) AS question_count,
       COUNT(*) FILTER (WHERE post_type_id = 2) AS answer_count,
       COUNT(*) AS total_posts,
       TIMESTAMP '{RUN_TS}' AS fecha_cargue
FROM silver_posts WHERE owner_user_id IS NOT NULL GROUP BY owner_user_id""")

BADGES_SUMMARY_SELECT = """
SELECT user_id, COUNT(*) AS total_badges, COUNT(DISTINCT badge_name) AS distinct_badge_types,
       COUNT(*) FILTER (WHERE badge_class = 1) AS gold_badges,
       COUNT(*) FILTER (WHERE badge_class = 2) AS silver_badges,
       COUNT(*) FILTER (WHERE badge_class = 3) AS bronze_badges,
       MAX(load_date) AS fecha_cargue
FROM silver_badges GROUP BY user_id HAVING user_id IS NOT NULL"""

GOLD_BADGES_SUMMARY = with_ctes(["silver_badges"], BADGES_SUMMARY_SELECT)

# activity of a user: one row per event of any kind, counted by kind
cte("activity", ["silver_posts", "silver_comments", "silver_badges"], """
SELECT user_id, COUNT(*) FILTER (WHERE kind = 'p') AS total_posts,
       COUNT(*) FILTER (WHERE kind = 'c') AS total_comments,
       COUNT(*) FILTER (WHERE kind = 'b') AS total_badges, COUNT(*) AS engagement_score
FROM (SELECT owner_user_id AS user_id, 'p' AS kind FROM silver_posts
      UNION ALL SELECT user_id, 'c' FROM silver_comments
      UNION ALL SELECT user_id, 'b' FROM silver_badges) events
GROUP BY user_id""")

_ACTIVITY_OF_USER = ", ".join(f"COALESCE({c}, 0) AS {c}" for c in (
    "total_posts", "total_comments", "total_badges", "engagement_score"))

GOLD_USER_ENGAGEMENT = with_ctes(["silver_users", "activity"], f"""
SELECT u.user_id, display_name, load_date, {_ACTIVITY_OF_USER}, TIMESTAMP '{RUN_TS}' AS fecha_cargue
FROM silver_users u LEFT JOIN activity a ON a.user_id = u.user_id""")

GOLD_COMMENT_ACTIVITY = with_ctes(["silver_comments"], """
SELECT comment_year, comment_month, COUNT(*) AS total_comments,
       COUNT(DISTINCT user_id) AS unique_users, AVG(text_length) AS avg_length,
       COUNT(*) FILTER (WHERE score_category = 'high') AS high_score_comments
FROM silver_comments GROUP BY comment_year, comment_month""")

GOLD_USER_COMMENT_ENGAGEMENT = with_ctes(["silver_comments", "silver_users"], """
SELECT c.user_id, u.display_name, u.is_active, COUNT(*) AS total_comments,
       AVG(c.text_length) AS avg_comment_length, MAX(c.creation_date) AS last_comment_date
FROM silver_comments c LEFT JOIN silver_users u ON c.user_id = u.user_id
GROUP BY c.user_id, u.display_name, u.is_active""")

GOLD_POST_SUMMARY = with_ctes(["silver_posts"], """
SELECT post_year, post_month, post_type_id, COUNT(*) AS total_posts,
       COUNT(DISTINCT owner_user_id) AS unique_authors
FROM silver_posts GROUP BY post_year, post_month, post_type_id""")

GOLD_BADGE_DISTRIBUTION = with_ctes(["silver_badges"], """
SELECT badge_name, badge_year, COUNT(*) AS total_awards, COUNT(DISTINCT user_id) AS unique_users
FROM silver_badges GROUP BY badge_name, badge_year""")

# ---- console queries ----------------------------------------------------

cte("asked_and_answered", ["silver_posts"], """
SELECT owner_user_id AS user_id, COUNT(*) FILTER (WHERE post_type_id = 1) AS question_count,
       COUNT(*) FILTER (WHERE post_type_id = 2) AS answer_count
FROM silver_posts GROUP BY ALL HAVING user_id IS NOT NULL""")

_RANKED = "ORDER BY question_count DESC, answer_count DESC, user_id"

QUERY_POSTS_PER_USER_TOP20 = with_ctes(
    ["asked_and_answered"], f"SELECT * FROM asked_and_answered {_RANKED} LIMIT 20")

QUERY_POSTS_PER_NAMED_USER_TOP20 = with_ctes(["asked_and_answered", "silver_users"], f"""
SELECT user_id, display_name, CAST(SUM(question_count) AS BIGINT) AS question_count,
       CAST(SUM(answer_count) AS BIGINT) AS answer_count
FROM silver_users INNER JOIN asked_and_answered USING (user_id) GROUP BY ALL
{_RANKED}, display_name NULLS LAST LIMIT 20""")

QUERY_BADGE_STATISTICS = with_ctes(["silver_badges"], BADGES_SUMMARY_SELECT
                                   + "\nORDER BY total_badges DESC, user_id")

QUERY_USER_ENGAGEMENT = with_ctes(["silver_users", "activity"], f"""
SELECT u.user_id, display_name, {_ACTIVITY_OF_USER}, fecha_cargue
FROM (SELECT user_id, display_name, MAX(load_date) AS fecha_cargue FROM silver_users
      GROUP BY ALL HAVING user_id IS NOT NULL) u
LEFT JOIN activity a ON a.user_id = u.user_id
ORDER BY engagement_score DESC, user_id""")

# ---- upsert fixtures: an older table and a newer batch of posts -----------
# target: posts created before 2000; source: posts created from 1999 on, with
# a changed score. 1999 posts are updated, 2000+ inserted, older kept.
UPSERT_SPLIT_OLD = "2000-01-01"
UPSERT_SPLIT_NEW = "1999-01-01"
CONFLICT_YEAR = 1999

cte("upsert_target", ["silver_posts"],
    f"SELECT * FROM silver_posts WHERE creation_date < TIMESTAMP '{UPSERT_SPLIT_OLD}'")
cte("upsert_source", ["silver_posts"],
    f"SELECT * REPLACE (score + 1 AS score) FROM silver_posts "
    f"WHERE creation_date >= TIMESTAMP '{UPSERT_SPLIT_NEW}'")
cte("upsert_source_dup", ["silver_posts", "upsert_source"],
    f"SELECT * FROM upsert_source UNION ALL "
    f"SELECT * REPLACE (score + 2 AS score) FROM silver_posts "
    f"WHERE post_year = {CONFLICT_YEAR}")

# the same batch with its 1999 posts re-dated into 2000: matched keys move partition
cte("upsert_source_moved", ["upsert_source"],
    f"SELECT * REPLACE (CASE WHEN post_year = {CONFLICT_YEAR} THEN post_year + 1 "
    f"ELSE post_year END AS post_year) FROM upsert_source")

# a table with posts of unknown year (a third of the ids), and a batch that dates them
# while it makes another part of them undated
cte("null_year_target", ["upsert_target"],
    "SELECT * REPLACE (CASE WHEN post_id % 3 = 0 THEN NULL ELSE post_year END AS post_year) FROM upsert_target")
cte("null_year_source", ["upsert_source"],
    "SELECT * REPLACE (CASE WHEN post_id % 5 = 1 THEN NULL ELSE post_year END AS post_year) FROM upsert_source")

# one day's posts, changed: a batch that is small beside its table
MERGE_DAY = "1996-05-15"
cte("day_batch", ["silver_posts"],
    f"SELECT * REPLACE (score + 1 AS score) FROM silver_posts WHERE CAST(creation_date AS DATE) = DATE '{MERGE_DAY}'")
