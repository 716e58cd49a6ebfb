"""Queries on engagement, windows and trends per user, post and hashtag."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur.operators import engagement, messages, scoring, trending, windows
from murmur.plans.registry import query
from murmur.plans.row_queries import (
    AS_OF_S, USER_METRICS_SQL, feature_contents, feature_users, rounded, user_metrics)

SEC = "epoch_us(ts) // 1000000"
DAY = 86400


@query("agg_user_activity", "posts", f"""
SELECT user_id, {SEC} // 300 * 300 AS window_start, count(*) AS post_count,
  epoch_us(arg_max(ts, post_id)) // 1000000 AS last_activity_s
FROM posts GROUP BY user_id, {SEC} // 300 * 300""")
def _(t):
    return windows.user_activity(t.posts).withColumn(
        "last_activity_s", F.unix_seconds("last_activity")).drop("last_activity")


WEIGHT_SQL = """CASE interaction_type WHEN 'VIEW' THEN 0.1::DOUBLE WHEN 'LIKE' THEN 1 WHEN 'COMMENT' THEN 5
  WHEN 'SHARE' THEN 10 ELSE 0 END"""


def weight():
    return scoring.window_weight(F.col("interaction_type"))


@query("agg_window_score", "interactions", f"""
SELECT content_id, round(sum(window_score), 6) AS score FROM (
  SELECT content_id, {SEC} // 86400 * 86400 AS window_start, sum({WEIGHT_SQL}) AS window_score
  FROM interactions GROUP BY 1, 2)
WHERE window_start >= {AS_OF_S} - 3 * 86400 GROUP BY content_id""")
def _(t):
    recent = t.interactions.filter(windows.in_windows(
        F.col("ts"), AS_OF_S - 3 * DAY, 1 << 40, DAY))
    per_window = windows.window_scores(recent, weight(), DAY)
    return rounded(windows.score_at(per_window, AS_OF_S, DAY))


@query("agg_top_scores", "interactions", f"""
SELECT content_id, round(sum({WEIGHT_SQL}), 6) AS score FROM interactions
WHERE {SEC} // 86400 * 86400 >= {AS_OF_S} - 3 * 86400
GROUP BY content_id ORDER BY round(sum({WEIGHT_SQL}), 6) DESC, content_id LIMIT 10""")
def _(t):
    scores = rounded(windows.recent_score(t.interactions, weight(), AS_OF_S, DAY))
    return windows.top_scores(scores)


REPUTATION_SQL = """
SELECT *, CASE WHEN score >= 2000 THEN 'platinum' WHEN score >= 500 THEN 'gold'
    WHEN score >= 100 THEN 'silver' ELSE 'bronze' END AS tier
FROM (SELECT user_id, count(*) FILTER (interaction_type = 'LIKE') AS like_count,
    count(*) FILTER (interaction_type = 'COMMENT') AS comment_count,
    count(*) FILTER (interaction_type = 'SHARE') AS share_count,
    CAST(sum(CASE interaction_type WHEN 'LIKE' THEN 1 WHEN 'COMMENT' THEN 2 WHEN 'SHARE' THEN 5 ELSE 0 END)
      AS BIGINT) AS score FROM interactions GROUP BY user_id)"""


@query("agg_reputation", "interactions", REPUTATION_SQL)
def _(t):
    return engagement.reputation(t.interactions)


@query("agg_reputation_stats", "interactions", f"""
SELECT count(*) AS total_users, CAST(sum(score) AS BIGINT) AS total_points,
  round(avg(score), 6) AS average_score, count(*) FILTER (tier = 'bronze') AS bronze,
  count(*) FILTER (tier = 'silver') AS silver, count(*) FILTER (tier = 'gold') AS gold,
  count(*) FILTER (tier = 'platinum') AS platinum FROM ({REPUTATION_SQL})""")
def _(t):
    return rounded(engagement.reputation_stats(engagement.reputation(t.interactions)))


@query("agg_top_users", "interactions",
       f"SELECT * FROM ({REPUTATION_SQL}) ORDER BY score DESC, user_id LIMIT 10")
def _(t):
    return engagement.top_users(engagement.reputation(t.interactions))


@query("agg_post_engagement", "interactions", f"""
SELECT content_id, count(*) FILTER (interaction_type = 'LIKE') AS likes,
  count(*) FILTER (interaction_type = 'SHARE') AS shares,
  count(*) FILTER (interaction_type = 'COMMENT') AS comments, max({SEC}) AS last_s
FROM interactions WHERE interaction_type IN ('LIKE', 'SHARE', 'COMMENT') GROUP BY content_id""")
def _(t):
    return engagement.post_engagement(t.interactions).withColumn(
        "last_s", F.unix_seconds("last_updated")).drop("last_updated")


PER_USER_SQL = f"""
SELECT user_id, metric_type, sum(metric_value) AS metric_value, max(ts) AS processed_at
FROM ({USER_METRICS_SQL}) GROUP BY user_id, metric_type"""


@query("agg_user_metrics", "interactions", f"""
SELECT user_id, metric_type, round(metric_value, 4) AS metric_value FROM ({PER_USER_SQL})""")
def _(t):
    return rounded(engagement.user_metrics(user_metrics(t)).drop("processed_at"), 4)


@query("agg_metric_summary", "interactions", f"""
SELECT metric_type, round(sum(metric_value), 3) AS total_value, count(*) AS user_count
FROM ({PER_USER_SQL}) GROUP BY metric_type""")
def _(t):
    return rounded(engagement.metric_summary(engagement.user_metrics(user_metrics(t))), 3)


@query("agg_metric_recent", "interactions", f"""
SELECT metric_type, count(*) AS events, max(epoch_us(processed_at) // 1000000) AS last_s
FROM ({PER_USER_SQL}) WHERE processed_at > TIMESTAMP '2024-01-30 12:00:00' GROUP BY metric_type""")
def _(t):
    since = F.to_timestamp(F.lit("2024-01-30 12:00:00"))
    out = engagement.recent_metrics(engagement.user_metrics(user_metrics(t)), since)
    return out.withColumn("last_s", F.unix_seconds("last_update")).drop("last_update")


def tag_rows(t):
    return messages.hashtag_occurrences(t.posts, 2)


HOP_SQL = rf"""
SELECT tag, s AS window_start, count(*) AS mention_count, count(DISTINCT user_id) AS unique_users,
  sum(engagement_score) AS total_engagement
FROM (SELECT user_id, engagement_score, tag, unnest(generate_series(p - 1500, p, 300)) AS s FROM (
  SELECT user_id, engagement_score, {SEC} // 300 * 300 AS p,
    unnest(regexp_extract_all(lower(content), '#([\p{{L}}\p{{N}}_]+)', 1)) AS tag FROM posts)
  WHERE length(tag) >= 2) GROUP BY tag, s"""


@query("agg_hop_hashtags", "posts", f"""
SELECT tag, window_start, mention_count, unique_users, round(total_engagement, 4) AS total_engagement
FROM ({HOP_SQL})""")
def _(t):
    return rounded(windows.hopping_tags(tag_rows(t)), 4)


SCORE_SQL = f"""
SELECT tag, window_start, mention_count, unique_users, mention_count - before AS velocity,
  round(0.5::DOUBLE * CASE WHEN mention_count <= before THEN 0 ELSE ln(1 + mention_count - before) / 10 END
    + 0.3::DOUBLE * least(total_engagement / greatest(mention_count, 1) / 100, 1.0::DOUBLE)
    + 0.2::DOUBLE * exp(-(({AS_OF_S} - (window_start + 1800)) / 3600.0::DOUBLE) * (1 - 0.95::DOUBLE)), 6)
    AS score
FROM (SELECT *, lag(mention_count, 1, 0) OVER (PARTITION BY tag ORDER BY window_start) AS before
  FROM ({HOP_SQL}) WHERE mention_count >= 5)"""


def trend_scores(t):
    hops = windows.hopping_tags(tag_rows(t))
    return rounded(trending.trending_scores(hops, AS_OF_S).drop("total_engagement"))


@query("agg_trending_score", "posts", SCORE_SQL)
def _(t):
    return trend_scores(t)


@query("agg_trending_rank", "posts", f"""
SELECT *, row_number() OVER (ORDER BY score DESC, tag, window_start) AS rank FROM ({SCORE_SQL})
QUALIFY rank <= 100""")
def _(t):
    return trending.trending_rank(trend_scores(t))


@query("agg_trend_worker", "posts", rf"""
WITH x AS (SELECT user_id, {SEC} AS s, ts,
    unnest(regexp_extract_all(lower(content), '#([\p{{L}}\p{{N}}_]+)', 1)) AS tag FROM posts),
a AS (SELECT tag, count(*) AS count, count(DISTINCT user_id) AS unique_users,
    count(*) FILTER (epoch_us(ts) BETWEEN ({AS_OF_S} - 2 * 86400)::BIGINT * 1000000
      AND ({AS_OF_S} - 86400)::BIGINT * 1000000) AS recent FROM x GROUP BY tag)
SELECT tag, count, unique_users, round(recent / 86400.0::DOUBLE * 60, 6) AS velocity,
  round(recent / 86400.0::DOUBLE * 60 * (1 + unique_users * 0.1::DOUBLE), 6) AS trend_score
FROM a WHERE recent >= 3 ORDER BY recent / 86400.0::DOUBLE * 60 * (1 + unique_users * 0.1::DOUBLE) DESC, tag
LIMIT 10""")
def _(t):
    return rounded(trending.worker_trends(
        messages.hashtag_occurrences(t.posts), AS_OF_S - DAY, seconds=DAY))


TAG_WINDOW_SQL = rf"""
SELECT tag, s // 3600 * 3600 AS window_start, count(*) AS n FROM (
  SELECT {SEC} AS s, unnest(regexp_extract_all(lower(content), '#([\p{{L}}\p{{N}}_]+)', 1)) AS tag
  FROM posts) GROUP BY 1, 2"""


def tag_windows(t, from_s=None):
    """Hourly counts per tag; with ``from_s`` of the windows from there to the present."""
    posts = t.posts if from_s is None else t.posts.filter(
        windows.in_windows(F.col("ts"), from_s, AS_OF_S, 3600))
    return windows.tumbling_counts(messages.hashtag_occurrences(posts), "tag", 3600)


@query("win_fetch", "posts", f"""
SELECT * FROM ({TAG_WINDOW_SQL}) WHERE tag = 't1'
  AND window_start BETWEEN ({AS_OF_S} - 200000) // 3600 * 3600 AND {AS_OF_S}""")
def _(t):
    aligned = (AS_OF_S - 200000) // 3600 * 3600
    return windows.fetch(tag_windows(t, aligned), "tag", "t1", AS_OF_S - 200000, AS_OF_S, 3600)


RECENT_SQL = f"""
SELECT * FROM ({TAG_WINDOW_SQL}) WHERE window_start BETWEEN {AS_OF_S} - 200000 AND {AS_OF_S}"""


def recent_windows(t):
    return windows.fetch_all(tag_windows(t, AS_OF_S - 200000), AS_OF_S - 200000, AS_OF_S)


@query("win_fetch_all", "posts", RECENT_SQL)
def _(t):
    return recent_windows(t)


@query("win_trending_velocity", "posts", f"""
SELECT tag, CAST(sum(n) AS BIGINT) AS total_count, count(*) AS windows,
  CAST(CASE WHEN count(*) >= 2 THEN sum(CASE WHEN age <= 2 THEN n ELSE -n END) ELSE 0 END AS BIGINT)
    AS velocity,
  CASE WHEN count(*) >= 2 AND sum(CASE WHEN age <= 2 THEN n ELSE -n END) > 0 THEN 'up' ELSE 'down' END
    AS trend
FROM (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY window_start DESC) AS age
  FROM ({RECENT_SQL})) GROUP BY tag ORDER BY sum(n) DESC, tag LIMIT 10""")
def _(t):
    return windows.velocity(recent_windows(t), "tag")


@query("win_hashtag_stats", "posts", f"""
SELECT tag, count(*) AS windows, CAST(sum(n) AS BIGINT) AS total_count, round(avg(n), 6) AS average
FROM ({TAG_WINDOW_SQL}) GROUP BY tag""")
def _(t):
    return rounded(windows.key_stats(tag_windows(t), "tag"))


@query("agg_merge_partials", "posts", rf"""
SELECT tag, s // 3600 * 3600 AS window_start, count(*) AS n FROM (
  SELECT {SEC} AS s, unnest(regexp_extract_all(lower(content), '#([\p{{L}}\p{{N}}_]+)', 1)) AS tag
  FROM posts) GROUP BY 1, 2""")
def _(t):
    tags = messages.hashtag_occurrences(t.posts)
    parts = windows.tumbling_counts(tags, ["media_type", "tag"], 3600)
    return windows.merge_partials([parts], "tag")


DECAY_SQL = """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM interactions),
g AS (SELECT user_id, count(*) FILTER (interaction_type = 'LIKE') AS likes,
    count(*) FILTER (interaction_type = 'COMMENT') AS comments,
    count(*) FILTER (interaction_type = 'SHARE') AS shares, max(CASE WHEN rn = 1 THEN epoch_us(ts) END) AS l,
    max(CASE WHEN rn = 2 THEN epoch_us(ts) END) AS b FROM r GROUP BY user_id)
SELECT user_id, likes, comments, shares, l // 1000000 AS last_s,
  round_even((likes + 2.0::DOUBLE * comments + 3.0::DOUBLE * shares)
    * exp(-coalesce(l - b, 0) / 3.6e9::DOUBLE / 24), 2) AS score FROM g"""


def decayed(t):
    return engagement.decayed_engagement(t.interactions).withColumn(
        "last_s", F.unix_seconds("last_update")).drop("last_update")


@query("agg_decay_engagement", "interactions", DECAY_SQL)
def _(t):
    return decayed(t)


@query("agg_decay_top", "interactions",
       f"SELECT * FROM ({DECAY_SQL}) ORDER BY score DESC, user_id LIMIT 10")
def _(t):
    return engagement.top_users(decayed(t))


@query("agg_saturating_score", "interactions", """
SELECT user_id, s AS engagement_score, s * 0.9::DOUBLE AS c1, s * 0.5::DOUBLE AS c5
FROM (SELECT user_id, least(1.0::DOUBLE, 0.5::DOUBLE + count(*) FILTER (interaction_type = 'LIKE') * 0.1::DOUBLE
  + count(*) FILTER (interaction_type = 'SHARE') * 0.2::DOUBLE) AS s FROM interactions GROUP BY user_id)""")
def _(t):
    return engagement.saturating_score(t.interactions).select(
        "user_id", "engagement_score", F.col("confidences")[0].alias("c1"),
        F.col("confidences")[4].alias("c5"))


BOARD_SQL = """
SELECT hashtag, count(*) AS count, max(epoch_us(ts) // 1000000) AS last_updated,
  count(*) * 1.0::DOUBLE AS trend_score
FROM (SELECT ts, unnest(hashtags) AS hashtag FROM posts) GROUP BY hashtag"""


def board(t):
    tags = trending.hashtag_rows(t.posts)
    return tags.groupBy("hashtag").agg(
        F.count(F.lit(1)).alias("count"), F.max(F.unix_seconds("ts")).alias("last_updated")
    ).withColumn("trend_score", F.col("count").cast("double"))


@query("agg_leaderboard", "posts", f"""
SELECT * FROM ({BOARD_SQL}) ORDER BY trend_score DESC, count DESC, hashtag LIMIT 50""")
def _(t):
    return trending.leaderboard(board(t))


@query("agg_leaderboard_stats", "posts", f"""
SELECT count(*) AS total_hashtags, CAST(sum(count) AS BIGINT) AS total_mentions,
  round(avg(count), 6) AS avg_mentions, max(count) AS max_mentions, min(last_updated) AS oldest_update,
  max(last_updated) AS latest_update FROM ({BOARD_SQL})""")
def _(t):
    return rounded(trending.leaderboard_stats(board(t)))


@query("agg_table_stats", "users interactions", """
SELECT 'user_profiles' AS table_name, 'total' AS measure, count(*)::DOUBLE AS value FROM users
UNION ALL SELECT 'user_profiles', 'avg_followers', round(avg(floor(balance)), 4) FROM users
UNION ALL SELECT 'user_profiles', 'avg_engagement_rate', round(avg(balance / 10000), 4) FROM users
UNION ALL SELECT 'content_metadata', 'total', count(*) FROM part
UNION ALL SELECT 'content_metadata', 'avg_views', round(avg((p_size - 1) * 1000), 4) FROM part
UNION ALL SELECT 'user_interactions', 'total', count(*) FROM interactions""")
def _(t):
    return engagement.table_stats({
        "user_profiles": (feature_users(t.users), {"avg_followers": "follower_count",
                                             "avg_engagement_rate": "engagement_rate"}),
        "content_metadata": (feature_contents(t), {"avg_views": "view_count"}),
        "user_interactions": (t.interactions, {}),
    })


@query("agg_like_once", "likes", """
SELECT post_id, count(DISTINCT user_id) AS likes_count FROM likes GROUP BY post_id""")
def _(t):
    return engagement.like_once(t.likes)
