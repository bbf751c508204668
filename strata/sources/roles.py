"""Q&A-shaped bronze frames derived from the generic test tables.

The test tables are a TPC-H-like star schema plus an event stream; these
role frames give them the raw Stack Overflow shape the jobs expect:
Pascal-case column names (as in the public dump) and, in the ``bronze_*``
variants, text columns as UTF-8 bytes. NULLs are planted where the dump has
them (missing owners, deleted users, unscored comments). Every role reads
its whole base table; nothing is sampled.

| role     | base                         | key        |
| users    | customer ⟕ orders-per-customer ⟕ nation | Id = c_custkey |
| posts    | orders                       | Id = o_orderkey |
| comments | lineitem                     | Id = order, line, part, supplier and ship day in one number |
| badges   | events                       | Id = event_id |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT_FIELDS = {
    "comments": ["Text", "UserDisplayName"],
    "posts": ["Body", "Title", "Tags", "OwnerDisplayName", "LastEditorDisplayName",
              "ContentLicense"],
    "badges": ["Name"],
    "users": ["DisplayName", "AboutMe", "WebsiteUrl", "Location"],
}


_READERS: dict[str, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. The test tables are read-only, so the resolved reader
    (file listing + footer schema) is reused while the same session is in
    use; no data is cached."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    df = _READERS.get(path)
    if df is None or df.sparkSession is not spark:
        df = _READERS[path] = spark.read.parquet(path)
    return df


def _null(t: str):
    return F.lit(None).cast(t)


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    o = (table(spark, sf_dir, "orders")
         .groupBy("o_custkey")
         .agg(F.min("o_orderdate").alias("first_order"),
              F.max("o_orderdate").alias("last_order"),
              F.count(F.lit(1)).alias("n_orders"),
              F.count_if(F.col("o_orderstatus") == "F").alias("n_finished")))
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (c.join(o, c.c_custkey == o.o_custkey, "left")
          .join(n, c.c_nationkey == n.n_nationkey, "left"))
    return j.select(
        F.col("c_custkey").alias("Id"),
        F.floor("c_acctbal").cast("long").alias("Reputation"),
        F.col("first_order").alias("CreationDate"),
        F.col("c_name").alias("DisplayName"),
        F.col("last_order").alias("LastAccessDate"),
        F.col("c_mktsegment").alias("AboutMe"),
        F.col("c_nationkey").cast("long").alias("Views"),
        F.col("n_orders").alias("UpVotes"),
        F.col("n_finished").alias("DownVotes"),
        _null("string").alias("WebsiteUrl"),
        F.col("n_name").alias("Location"),
        F.col("c_custkey").alias("AccountId"),
    )


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("Id"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2)
         .otherwise(3).alias("PostTypeId"),
        _null("long").alias("AcceptedAnswerId"),
        F.col("o_orderdate").alias("CreationDate"),
        F.floor(F.col("o_totalprice") / 10000).cast("long").alias("Score"),
        F.floor("o_totalprice").cast("long").alias("ViewCount"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("Body"),
        F.when(F.col("o_orderkey") % 50 == 0, _null("long")).otherwise(F.col("o_custkey"))
         .alias("OwnerUserId"),
        _null("string").alias("OwnerDisplayName"),
        _null("long").alias("LastEditorUserId"),
        _null("string").alias("LastEditorDisplayName"),
        _null("timestamp_ntz").alias("LastEditDate"),
        F.col("o_orderdate").alias("LastActivityDate"),
        F.col("o_orderpriority").alias("Title"),
        F.col("o_orderstatus").alias("Tags"),
        _null("int").alias("AnswerCount"),
        _null("int").alias("CommentCount"),
        _null("int").alias("FavoriteCount"),
        F.lit("CC BY-SA 4.0").alias("ContentLicense"),
        _null("long").alias("ParentId"),
        _null("timestamp_ntz").alias("CommunityOwnedDate"),
        _null("timestamp_ntz").alias("ClosedDate"),
    )


def raw_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber")
    # (order, line) repeats in the test tables; part, supplier and day tell the rows apart
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date"))
    key = F.col("l_orderkey") * 10 + n
    for part, radix in ((F.col("l_partkey"), 20011), (F.col("l_suppkey"), 1009), (day, 3001)):
        key = key * radix + part
    return li.select(
        key.alias("Id"),
        F.col("l_orderkey").alias("PostId"),
        F.when(F.col("l_orderkey") % 23 == 0, _null("long"))
         .otherwise(F.floor(F.col("l_quantity") / 5).cast("long")).alias("Score"),
        F.when(n == 7, _null("string")).otherwise(F.repeat(F.col("l_returnflag"), n))
         .alias("Text"),
        F.col("l_shipdate").alias("CreationDate"),
        F.when(F.col("l_partkey") % 10 == 0, _null("long")).otherwise(F.col("l_partkey"))
         .alias("UserId"),
        F.when(n == 1, _null("string")).when(n == 2, F.lit("")).otherwise(F.col("l_linestatus"))
         .alias("UserDisplayName"),
    )


def raw_badges(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    t = F.col("event_type")
    return e.select(
        F.col("event_id").alias("Id"),
        F.when(F.col("event_id") % 10 == 0, _null("long")).otherwise(F.col("user_id"))
         .alias("UserId"),
        t.alias("Name"),
        F.col("ts").alias("Date"),
        F.when(t == "signup", 1).when(t == "purchase", 2).otherwise(3).alias("Class"),
        (F.col("value") >= 100).alias("TagBased"),
    )


RAW = {"users": raw_users, "posts": raw_posts, "comments": raw_comments, "badges": raw_badges}


def encode_text(df: DataFrame, fields: list[str]) -> DataFrame:
    """String columns → UTF-8 bytes, as text is stored in the bronze dump."""
    return df.withColumns({f: F.encode(F.col(f), "UTF-8") for f in fields if f in df.columns})


def raw(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """Pascal-case role frame with text as strings."""
    return RAW[dataset](spark, sf_dir)


def bronze(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """Pascal-case role frame with text as UTF-8 bytes (the bronze shape)."""
    return encode_text(raw(spark, sf_dir, dataset), TEXT_FIELDS[dataset])


def documents_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode input: documents with their whole text as UTF-8 bytes."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("id"), F.encode("text", "UTF-8").alias("text"))


def documents_bad_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode input with invalid bytes: every third document gets the bytes FF, C3 28
    (a lead byte without its continuation) and EF BF BD (a genuine U+FFFD) in the
    middle of its text, every third only the genuine U+FFFD; the rest is clean."""
    d = table(spark, sf_dir, "documents")
    text, at = F.col("text"), F.floor(F.length("text") / 2).cast("int")
    left, right = F.encode(F.substring(text, F.lit(1), at), "UTF-8"), F.encode(F.substr(text, at + 1), "UTF-8")
    kind = F.col("doc_id") % 3
    bad = F.concat(left, F.lit(bytearray(b"\xff\xc3(\xef\xbf\xbd")), right)
    genuine = F.concat(left, F.lit(bytearray(b"\xef\xbf\xbd")), right)
    return d.select(F.col("doc_id").alias("id"), F.col("source"),
                    F.when(kind == 0, bad).when(kind == 1, genuine).otherwise(F.encode("text", "UTF-8")).alias("text"))


def comments_bad_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised comments whose text holds invalid bytes (one row per document)."""
    made = F.timestamp_add("DAY", (F.col("id") % 1000).cast("int"), F.lit("2020-01-01").cast("timestamp_ntz"))
    return (documents_bad_bytes(spark, sf_dir)
            .select("id", (F.col("id") % 100).alias("post_id"), (F.col("id") % 7).alias("score"), "text",
                    made.alias("creation_date"), (F.col("id") % 50).alias("user_id"),
                    F.encode("source", "UTF-8").alias("user_display_name")))
