"""Source queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur import fixed_values as fv
from murmur import schemas
from murmur.plans.registry import query
from murmur.streaming import runner
from murmur.sources import files, messages, tables

SEC = "epoch_us(ts) // 1000000"


def raw_likes(t):
    """Likes as JSON text; one in a hundred is cut off, one in a hundred is null."""
    body = F.to_json(F.struct("like_id", "post_id", "user_id",
                              F.unix_millis("ts").alias("timestamp")))
    cut = F.col("like_id") % 100 == 7
    return t.likes.withColumn("body", body).select(
        F.col("like_id").alias("offset"),
        F.when(cut, F.expr("left(body, length(body) - 5)")).when(
            F.col("like_id") % 100 != 9, F.col("body")).alias("value"))


@query("src_json_events", "likes", f"""
SELECT like_id AS "offset", CASE WHEN ok THEN like_id END AS like_id, CASE WHEN ok THEN post_id END AS post_id,
  CASE WHEN ok THEN user_id END AS user_id, CASE WHEN ok THEN {SEC} END AS ts_s, NOT ok AS is_error
FROM (SELECT *, like_id % 100 NOT IN (7, 9) AS ok FROM likes)""")
def _(t):
    rows = messages.decode(raw_likes(t), schemas.LIKE)
    return rows.select("offset", "like_id", "post_id", "user_id",
                       F.unix_seconds("ts").alias("ts_s"),
                       F.col("is_bad").alias("is_error"))


@query("src_multi_topic", "posts likes comments", """
SELECT 'posts' AS topic, post_id, user_id, CAST(NULL AS BIGINT) AS like_id,
  CAST(NULL AS BIGINT) AS comment_id FROM posts
UNION ALL SELECT 'likes', post_id, user_id, like_id, NULL FROM likes
UNION ALL SELECT 'comments', post_id, user_id, NULL, comment_id FROM comments""")
def _(t):
    merged = messages.merge_topics({
        "posts": t.posts.select("post_id", "user_id"),
        "likes": t.likes.drop("ts"), "comments": t.comments.drop("ts")})
    return merged.select("topic", "post_id", "user_id", "like_id", "comment_id")


MARK = "TIMESTAMP '1998-06-01'"


def order_batch(t):
    mark = (F.to_timestamp_ntz(F.lit("1998-06-01 00:00:00")), F.lit(500))
    return tables.incremental(t.orders, "o_orderdate", "o_orderkey", mark, 1000, "orders-db")


ORDERS_SQL = f"""
SELECT * FROM orders WHERE o_orderdate > {MARK} OR (o_orderdate = {MARK} AND o_orderkey > 500)
ORDER BY o_orderdate, o_orderkey LIMIT 1000"""


@query("src_jdbc_incremental", "", f"""
SELECT o_orderkey, o_totalprice, 'orders-db' AS source_system FROM ({ORDERS_SQL})""")
def _(t):
    return order_batch(t).select("o_orderkey", "o_totalprice", "source_system")


@query("src_jdbc_mark", "", f"""
SELECT epoch_us(o_orderdate) // 1000000 AS updated_s, o_orderkey FROM ({ORDERS_SQL})
ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1""")
def _(t):
    mark = tables.next_mark(order_batch(t), "o_orderdate", "o_orderkey")
    return mark.select(F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("updated_s"),
                       "o_orderkey")


@query("src_jdbc_bulk", "", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def _(t):
    return t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


def account_marks(t):
    """What was read up to the middle of the month; errors have no mark yet."""
    until = F.to_timestamp(F.lit("2024-01-15"))
    return t.ev.filter((F.col("ts") < until) & (F.col("event_type") != "error")).groupBy(
        "event_type", "user_id").agg(F.max("event_id").alias("last_id"))


MARKS_SQL = """
SELECT event_type, user_id, max(event_id) AS last_id FROM ev
WHERE ts < TIMESTAMP '2024-01-15' AND event_type <> 'error' GROUP BY 1, 2"""


@query("src_since_id", "ev", f"""
SELECT event_id, event_type, user_id FROM ev LEFT JOIN ({MARKS_SQL}) USING (event_type, user_id)
WHERE event_id > coalesce(last_id, -1)""")
def _(t):
    return tables.since_id(t.ev, account_marks(t), ["event_type", "user_id"], "event_id").select(
        "event_id", "event_type", "user_id")


@query("src_since_id_marks", "ev", """
SELECT event_type, user_id, max(event_id) AS last_id FROM ev GROUP BY 1, 2""")
def _(t):
    keys = ["event_type", "user_id"]
    fresh = tables.since_id(t.ev, account_marks(t), keys, "event_id")
    return tables.new_marks(fresh, account_marks(t), keys, "event_id")


@query("src_file_metadata")
def _(t):
    found = files.file_metadata(t.spark, t.folder, "*.parquet")
    return found.select("file_id", "filename", "size_bytes", "checksum", "mime_type")


@query("src_file_metadata_stream")
def _(t):
    """Files of the tables as they arrive; a restart would read only newer ones."""
    found = files.file_metadata_stream(t.spark, t.folder, "*.parquet")
    return runner.finished(t.spark, found, "files").select(
        "file_id", "filename", "size_bytes", "checksum", "mime_type")


@query("src_page_metadata", "", f"""
SELECT substr(sum, 1, 16) AS file_id, name AS filename, octet_length(encode(html)) AS size_bytes,
  sum AS checksum, CASE lower(regexp_extract(name, '[^.](\\.[^.]+)$', 1))
    {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fv.MIME_TYPES.items())}
    ELSE '{fv.DEFAULT_MIME_TYPE}' END AS mime_type
FROM (SELECT html, sha256(html) AS sum, string_split(url, '/')[-1] AS name FROM pages)""")
def _(t):
    """The same description of stored pages."""
    content = F.encode("html", "UTF-8")
    pages = t.pages.select(F.col("url").alias("path"), F.length(content).cast("long").alias(
        "length"), F.lit(None).cast("timestamp").alias("modificationTime"),
        F.sha2(content, 256).alias("checksum"))
    return files.described(pages).select(
        "file_id", "filename", "size_bytes", "checksum", "mime_type")


@query("src_topic_route", "ev", """
SELECT event_id, CASE WHEN k % 2 = 0 THEN 'cdc.' || event_type ELSE event_type || '.raw' END AS topic
FROM ev""")
def _(t):
    topic = F.when(F.col("k") % 2 == 0, F.concat(F.lit("server.public."), F.col("event_type"))
                   ).otherwise(F.concat(F.col("event_type"), F.lit(".raw")))
    return t.ev.select("event_id", messages.route(topic).alias("topic"))
