"""Hashtag trends."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmur import fixed_values as fv
from murmur.functions.columns import count_if
from murmur.functions.ranking import ranked_top, top


def hashtag_rows(posts: DataFrame) -> DataFrame:
    """One row per post and element of its hashtag array; empty arrays give none."""
    return (posts.filter(F.size("hashtags") > 0)
            .select("post_id", "user_id", "ts", F.explode("hashtags").alias("hashtag")))


def hashtag_user_counts(tags: DataFrame) -> DataFrame:
    """Mentions per (hashtag, user), on tables and on streams."""
    return tags.groupBy("hashtag", "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("post_id").alias("last_id"),
        F.max_by("ts", "post_id").alias("last_ts"))


def hashtag_totals(by_user: DataFrame) -> DataFrame:
    return by_user.groupBy("hashtag").agg(
        F.sum("n").alias("mention_count"),
        F.count("user_id").alias("unique_users"),
        F.max_by("last_ts", "last_id").alias("latest_ts"))


def hashtag_trends(tags: DataFrame) -> DataFrame:
    """Per hashtag: mentions, distinct users and the timestamp of the latest offset.

    Rows are merged to (hashtag, user) first, so a hot hashtag is spread over its
    users before the final count.
    """
    return hashtag_totals(hashtag_user_counts(tags))


def trending_top(trends: DataFrame, n: int = 10) -> DataFrame:
    return top(trends, [F.desc("mention_count"), F.asc("hashtag")], n)


def trending_scores(windows: DataFrame, as_of_s: float, size_s: int = 1800) -> DataFrame:
    """Score of every hopping window with enough mentions.

    Velocity compares with the previous scored window of the same hashtag. The window
    function sees one row per (hashtag, window), not the events.
    """
    w = fv.TREND_WEIGHTS
    scored = windows.filter(F.col("mention_count") >= fv.TREND_MIN_MENTIONS)
    before = F.lag("mention_count", 1, 0).over(
        Window.partitionBy("tag").orderBy("window_start"))
    scored = scored.withColumn("velocity", F.col("mention_count") - before)
    rise = F.when(F.col("velocity") <= 0, F.lit(0.0)).otherwise(
        F.log1p(F.col("velocity")) / F.lit(10.0))
    average = F.col("total_engagement") / F.greatest(F.col("mention_count"), F.lit(1))
    engagement = F.least(average / F.lit(100.0), F.lit(1.0))
    hours = (F.lit(float(as_of_s)) - (F.col("window_start") + size_s)) / F.lit(3600.0)
    recency = F.exp(-hours * F.lit(1 - fv.TREND_DECAY_RATE))
    return scored.withColumn("score", rise * w["velocity"] + engagement * w["engagement"]
                             + recency * w["recency"])


def trending_rank(scores: DataFrame, n: int = fv.TREND_TOP_K) -> DataFrame:
    return ranked_top(scores, [F.desc("score"), F.asc("tag"), F.asc("window_start")], n)


def worker_trends(tags: DataFrame, as_of_s: float, n: int = 10,
                  seconds: int = fv.WORKER_WINDOW_SECONDS) -> DataFrame:
    """Hashtags of the last minutes by velocity times audience.

    ``count`` and the users are all-time, the velocity counts the window only.
    """
    start = as_of_s - seconds
    recent = (F.col("ts") >= F.timestamp_seconds(F.lit(start))) & (
        F.col("ts") <= F.timestamp_seconds(F.lit(as_of_s)))
    by_user = tags.groupBy("tag", "user_id").agg(
        F.count(F.lit(1)).alias("n"), count_if(recent).alias("recent"))
    sums = by_user.groupBy("tag").agg(
        F.sum("n").alias("count"), F.sum("recent").alias("recent"),
        F.count("user_id").alias("unique_users"))
    rate = F.col("recent") / F.lit(seconds) * F.lit(60)
    out = (sums.filter(F.col("recent") >= fv.WORKER_MIN_MENTIONS)
           .withColumn("velocity", rate)
           .withColumn("trend_score",
                       F.col("velocity") * (F.lit(1) + F.col("unique_users") * F.lit(0.1))))
    return top(out.drop("recent"), [F.desc("trend_score"), F.asc("tag")], n)


def leaderboard(table: DataFrame, n: int = 50) -> DataFrame:
    return top(table, [F.desc("trend_score"), F.desc("count"), F.asc("hashtag")], n)


def leaderboard_stats(table: DataFrame) -> DataFrame:
    return table.agg(
        F.count(F.lit(1)).alias("total_hashtags"), F.sum("count").alias("total_mentions"),
        F.avg("count").alias("avg_mentions"), F.max("count").alias("max_mentions"),
        F.min("last_updated").alias("oldest_update"), F.max("last_updated").alias("latest_update"))
