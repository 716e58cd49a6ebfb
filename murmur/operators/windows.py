"""Tumbling and hopping windows and reads of windowed tables.

Window starts are epoch seconds. The functions that take ``df`` also accept streams
unless they say otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.functions.columns import count_if, window_start
from murmur.functions.ranking import top


def tumbling_counts(df: DataFrame, keys: str | list[str], seconds: int,
                    ts: str = "ts") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else keys
    return df.groupBy(*keys, window_start(F.col(ts), seconds).alias("window_start")).agg(
        F.count(F.lit(1)).alias("n"))


def user_activity(posts: DataFrame, seconds: int = 300) -> DataFrame:
    """Posts per user and window with the latest timestamp by offset."""
    return posts.groupBy("user_id", window_start(F.col("ts"), seconds).alias("window_start")).agg(
        F.count(F.lit(1)).alias("post_count"),
        F.max_by("ts", "post_id").alias("last_activity"))


def window_scores(df: DataFrame, weight: Column, seconds: int = 300) -> DataFrame:
    return df.groupBy(
        "content_id", window_start(F.col("ts"), seconds).alias("window_start")).agg(
        F.sum(weight).alias("window_score"))


def score_at(windows: DataFrame, as_of_s: float, seconds: int = 300, keep: int = 3) -> DataFrame:
    """Score per content from the windows that start in the last ``keep`` sizes."""
    recent = F.col("window_start") >= as_of_s - keep * seconds
    return windows.filter(recent).groupBy("content_id").agg(F.sum("window_score").alias("score"))


def recent_score(df: DataFrame, weight: Column, as_of_s: float, seconds: int = 300,
                 keep: int = 3) -> DataFrame:
    """``score_at`` over raw events; the time limit reaches the scan."""
    first = -(-int(as_of_s - keep * seconds) // seconds) * seconds
    recent = df.filter(F.col("ts") >= F.timestamp_seconds(F.lit(first)))
    return recent.groupBy("content_id").agg(F.sum(weight).alias("score"))


def top_scores(scores: DataFrame, n: int = 10) -> DataFrame:
    return top(scores, [F.desc("score"), F.asc("content_id")], n)


def hopping_tags(tags: DataFrame, size_s: int = 1800, hop_s: int = 300) -> DataFrame:
    """Per hashtag and hopping window: mentions, distinct users, total engagement.

    Events are first merged to panes of one hop per (hashtag, user). A user counts in a
    window at the first of its panes there, and a pane is the first one in just those
    windows that begin after the user's pane before it. So each pane tells by its
    distance to that one how many windows it adds the user to; these numbers are summed
    per (hashtag, pane), and only the sums are copied to the windows. Batch only.
    """
    pane = window_start(F.col("ts"), hop_s)
    panes = tags.groupBy("tag", "user_id", pane.alias("pane")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("engagement_score").alias("engagement"))
    return windows_of_panes(panes, size_s, hop_s)


def windows_of_panes(panes: DataFrame, size_s: int = 1800, hop_s: int = 300) -> DataFrame:
    """The windows of ``hopping_tags`` from one row per (hashtag, user, pane)."""
    hops = size_s // hop_s
    # A (hashtag, user) has at most one row per pane here.
    before = F.lag("pane").over(Window.partitionBy("tag", "user_id").orderBy("pane"))
    reach = F.least(F.coalesce((F.col("pane") - before) / hop_s, F.lit(hops)), F.lit(hops))
    spread = panes.withColumn("reach", F.when(F.col("user_id").isNotNull(), reach))
    per_pane = spread.groupBy("tag", "pane").agg(
        F.sum("n").alias("n"), F.sum("engagement").alias("engagement"),
        F.array(*[count_if(F.col("reach") > i) for i in range(hops)]).alias("new_users"))
    return per_pane.select("tag", "pane", "n", "engagement", F.posexplode("new_users").alias(
        "back", "users")).groupBy(
        "tag", (F.col("pane") - F.col("back") * hop_s).alias("window_start")).agg(
        F.sum("n").alias("mention_count"), F.sum("users").alias("unique_users"),
        F.sum("engagement").alias("total_engagement"))


def in_windows(ts: Column, from_s: int, to_s: int, seconds: int) -> Column:
    """Whether a time lies in a window that starts in [from_s, to_s]; reaches the scan."""
    first = -(-from_s // seconds) * seconds
    end = to_s // seconds * seconds + seconds
    return (ts >= F.timestamp_seconds(F.lit(first))) & (ts < F.timestamp_seconds(F.lit(end)))


def fetch(windows: DataFrame, key: str, value: str, from_s: int, to_s: int,
          seconds: int) -> DataFrame:
    """Windows of one key; the lower bound is aligned down to a window start."""
    aligned = from_s // seconds * seconds
    return windows.filter((F.col(key) == value) & F.col("window_start").between(aligned, to_s))


def fetch_all(windows: DataFrame, from_s: int, to_s: int) -> DataFrame:
    """Windows of all keys; the lower bound is not aligned."""
    return windows.filter(F.col("window_start").between(from_s, to_s))


def velocity(windows: DataFrame, key: str, n: int = 10) -> DataFrame:
    """Total, velocity and direction per key; the best n by total.

    Velocity is the sum of the last two windows less that of the older ones, and 0
    with fewer than two windows. Needs one row per (key, window).
    """
    newest = Window.partitionBy(key).orderBy(F.desc("window_start"))
    ranked = windows.withColumn("age", F.row_number().over(newest))
    sign = F.when(F.col("age") <= 2, F.col("n")).otherwise(-F.col("n"))
    sums = ranked.groupBy(key).agg(
        F.sum("n").alias("total_count"), F.count(F.lit(1)).alias("windows"),
        F.sum(sign).alias("v"))
    out = sums.withColumn(
        "velocity", F.when(F.col("windows") >= 2, F.col("v")).otherwise(0)).drop("v")
    out = out.withColumn("trend", F.when(F.col("velocity") > 0, "up").otherwise("down"))
    return top(out, [F.desc("total_count"), F.asc(key)], n)


def key_stats(windows: DataFrame, key: str) -> DataFrame:
    return windows.groupBy(key).agg(
        F.count(F.lit(1)).alias("windows"), F.sum("n").alias("total_count"),
        F.avg("n").alias("average"))


def merge_partials(parts: list[DataFrame], key: str) -> DataFrame:
    """Counts of the same key and window from several instances, added up."""
    merged = parts[0]
    for other in parts[1:]:
        merged = merged.unionByName(other)
    return merged.groupBy(key, "window_start").agg(F.sum("n").alias("n"))
