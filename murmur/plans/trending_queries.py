"""Trend queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur.operators import trending
from murmur.plans.registry import query


@query("flat_hashtag_array", "posts", """
SELECT post_id, user_id, unnest(hashtags) AS hashtag, epoch_us(ts) // 1000000 AS ts_s
FROM posts WHERE len(hashtags) > 0""")
def _(t):
    return trending.hashtag_rows(t.posts).select(
        "post_id", "user_id", "hashtag", F.unix_seconds("ts").alias("ts_s"))


TRENDS_SQL = """
SELECT hashtag, count(*) AS mention_count, count(DISTINCT user_id) AS unique_users,
  epoch_us(arg_max(ts, post_id)) // 1000000 AS latest_s
FROM (SELECT post_id, user_id, ts, unnest(hashtags) AS hashtag FROM posts) GROUP BY hashtag"""


def _trends(t):
    return trending.hashtag_trends(trending.hashtag_rows(t.posts)).select(
        "hashtag", "mention_count", "unique_users", F.unix_seconds("latest_ts").alias("latest_s"))


@query("agg_hashtag_trends", "posts", TRENDS_SQL)
def _(t):
    return _trends(t)


@query("agg_trending_top", "posts", f"""
SELECT * FROM ({TRENDS_SQL}) ORDER BY mention_count DESC, hashtag LIMIT 10""")
def _(t):
    return trending.trending_top(_trends(t))
