"""The social entities as views over the given tables, for Spark and for DuckDB.

Both definitions of a view must give equal rows. ``k`` is the number 0..99 held in
``events.props``; it stands in for attributes the event table lacks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.functions.columns import first_match, lookup


class Tables:
    """Lazy access to the given tables and to the entities derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return VIEWS[name](self)
        if name in TABLE_NAMES:
            return self.read(name)
        raise AttributeError(name)


TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations").split()


def event_rows(events: DataFrame) -> DataFrame:
    """Typed events; also used on streams of the same files."""
    k = F.get_json_object("props", "$.k").cast("long")
    return events.select("event_id", F.col("ts").cast("timestamp").alias("ts"),
                         "user_id", "event_type", "value", k.alias("k"))


INTERACTION_TYPES = {"view": "VIEW", "click": "LIKE", "signup": "COMMENT", "purchase": "SHARE"}


def interactions_from(ev: DataFrame) -> DataFrame:
    return ev.select(
        "event_id", "ts", "user_id", F.col("k").alias("content_id"),
        lookup(F.col("event_type"), INTERACTION_TYPES, "UNKNOWN").alias("interaction_type"),
        F.col("value").alias("duration_s"), "k")


def posts_from(ev: DataFrame) -> DataFrame:
    k = F.col("k")
    first = F.concat(F.lit("t"), k % 8)
    second = F.concat(F.lit("t"), k % 3)
    tags = first_match(
        [(k % 5 == 0, F.array().cast("array<string>")), (k % 8 == k % 3, F.array(first))],
        F.array(first, second))
    tail = F.when(k % 5 == 0, F.lit("")).otherwise(
        F.concat(F.lit(" #T"), k % 8, F.lit(" and #t"), k % 3, F.lit(" @u"), F.col("user_id")))
    media = F.element_at(F.array(*[F.lit(m) for m in ("text", "image", "video", "link")]),
                         (k % 4 + 1).cast("int"))
    return ev.select(
        F.col("event_id").alias("post_id"), "ts", "user_id", tags.alias("hashtags"),
        F.concat(F.lit("post "), F.col("event_id"), tail).alias("content"),
        media.alias("media_type"), F.col("value").alias("engagement_score"), "k")


def reactions_from(ev: DataFrame, event_type: str, name: str, reach: int) -> DataFrame:
    post = F.col("event_id") - 1 - F.col("k") % reach
    return (ev.filter(F.col("event_type") == event_type)
            .select(F.col("event_id").alias(name), post.alias("post_id"), "user_id", "ts")
            .filter(F.col("post_id") >= 0))


def _users(t: Tables) -> DataFrame:
    customer, nation = t.customer, t.nation
    return (customer.join(nation, customer.c_nationkey == nation.n_nationkey)
            .select(F.col("c_custkey").alias("user_id"),
                    (18 + F.col("c_custkey") % 48).alias("age"),
                    F.col("n_name").alias("city"), F.col("c_mktsegment").alias("tier"),
                    F.col("c_acctbal").alias("balance")))


def changelog_from(ev: DataFrame) -> DataFrame:
    value = F.concat("event_type", F.lit("-"), F.col("k"))
    return ev.select(
        F.col("event_id").alias("log_offset"), F.col("user_id").alias("log_key"),
        (F.col("k") % 20).alias("version"), F.col("ts").alias("updated_at"),
        F.when(F.col("event_type") != "error", value).alias("payload"))


def _logs(t: Tables) -> DataFrame:
    kind, k = F.col("event_type"), F.col("k")
    level = lookup(kind, {"error": "ERROR", "purchase": "WARNING"}, "INFO")
    return t.ev.select(
        "event_id", "ts", kind.alias("logger"), F.concat(F.lit("trace-"), k).alias("trace_id"),
        level.alias("level"),
        F.when(kind == "error", F.concat(F.lit("E"), k % 6)).alias("error"),
        F.col("value").alias("latency_ms"))


# What the moderation rules look for, appended to the documents by source so that
# every branch is met.
TAILS = {
    "src0": " BUY NOW while stocks last", "src1": " act fast, friends",
    "src2": " \U0001F600\U0001F601\U0001F602\U0001F603\U0001F604\U0001F605\U0001F606"
            "\U0001F607\U0001F680\U0001F681\U0001F300",
    "src3": " this is ILLEGAL here", "src4": " alcohol and Gambling tonight",
    "src5": " a shocking story", "src6": " you won't believe it", "src7": " love this great game",
    "src8": " awful software update", "src9": " http://a.example http://b.example!!",
    "src10": " breaking news, sad", "src11": " spam or scam", "src12": " steam",
    "src13": " #Tag1 #tag1 #Été @ann @bob",
}


def _text_posts(t: Tables) -> DataFrame:
    return t.documents.select(
        F.col("doc_id").alias("post_id"), F.col("source").alias("user_id"), "lang",
        F.concat("text", lookup(F.col("source"), TAILS, "")).alias("content"),
        (F.col("lang") == "fr").alias("has_image"))


def edges_of(t: Tables) -> DataFrame:
    """Friends: the suppliers that a customer has ever bought from, some 40 each and up to 100."""
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("friend_id"))
    return (t.orders.select("o_orderkey", F.col("o_custkey").alias("user_id"))
            .join(lines, "o_orderkey").select("user_id", "friend_id").distinct())


VIEWS = {
    "ev": lambda t: event_rows(t.events),
    "interactions": lambda t: interactions_from(t.ev),
    "posts": lambda t: posts_from(t.ev),
    "likes": lambda t: reactions_from(t.ev, "click", "like_id", 7),
    "comments": lambda t: reactions_from(t.ev, "signup", "comment_id", 5),
    "users": _users,
    # Some users have no profile, for the joins that must meet that.
    "profiles": lambda t: t.users.filter(F.col("balance") >= 0),
    "changelog": lambda t: changelog_from(t.ev),
    "logs": _logs,
    "text_posts": _text_posts,
    "edges": edges_of,
}


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_TAIL_CASE = ("CASE source " + " ".join(
    f"WHEN {_sql_text(s)} THEN {_sql_text(tail)}" for s, tail in TAILS.items()) + " ELSE '' END")

# name -> (views it needs, SQL)
DUCK_VIEWS: dict[str, tuple[str, str]] = {
    "ev": ("", """
SELECT event_id, ts, user_id, event_type, value,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"""),
    "interactions": ("ev", """
SELECT event_id, ts, user_id, k AS content_id,
  CASE event_type WHEN 'view' THEN 'VIEW' WHEN 'click' THEN 'LIKE' WHEN 'signup' THEN 'COMMENT'
    WHEN 'purchase' THEN 'SHARE' ELSE 'UNKNOWN' END AS interaction_type,
  value AS duration_s, k FROM ev"""),
    "posts": ("ev", """
SELECT event_id AS post_id, ts, user_id,
  CASE WHEN k % 5 = 0 THEN CAST([] AS VARCHAR[]) WHEN k % 8 = k % 3 THEN ['t' || (k % 8)]
    ELSE ['t' || (k % 8), 't' || (k % 3)] END AS hashtags,
  concat('post ', event_id, CASE WHEN k % 5 = 0 THEN ''
    ELSE concat(' #T', k % 8, ' and #t', k % 3, ' @u', user_id) END) AS content,
  CASE k % 4 WHEN 0 THEN 'text' WHEN 1 THEN 'image' WHEN 2 THEN 'video' ELSE 'link' END AS media_type,
  value AS engagement_score, k FROM ev"""),
    "likes": ("ev", """
SELECT event_id AS like_id, event_id - 1 - k % 7 AS post_id, user_id, ts
FROM ev WHERE event_type = 'click' AND event_id - 1 - k % 7 >= 0"""),
    "comments": ("ev", """
SELECT event_id AS comment_id, event_id - 1 - k % 5 AS post_id, user_id, ts
FROM ev WHERE event_type = 'signup' AND event_id - 1 - k % 5 >= 0"""),
    "users": ("", """
SELECT c_custkey AS user_id, 18 + c_custkey % 48 AS age, n_name AS city, c_mktsegment AS tier,
  c_acctbal AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey"""),
    "profiles": ("users", "SELECT * FROM users WHERE balance >= 0"),
    "changelog": ("ev", """
SELECT event_id AS log_offset, user_id AS log_key, k % 20 AS version, ts AS updated_at,
  CASE WHEN event_type <> 'error' THEN concat(event_type, '-', k) END AS payload FROM ev"""),
    "logs": ("ev", """
SELECT event_id, ts, event_type AS logger, concat('trace-', k) AS trace_id,
  CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARNING' ELSE 'INFO' END AS level,
  CASE WHEN event_type = 'error' THEN concat('E', k % 6) END AS error, value AS latency_ms FROM ev"""),
    "text_posts": ("", f"""
SELECT doc_id AS post_id, source AS user_id, lang, text || {_TAIL_CASE} AS content,
  lang = 'fr' AS has_image FROM documents"""),
    "edges": ("", """
SELECT DISTINCT o_custkey AS user_id, l_suppkey AS friend_id
FROM orders JOIN lineitem ON l_orderkey = o_orderkey"""),
}
