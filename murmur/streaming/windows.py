"""Windowed aggregations on streams; the same code also runs on tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.functions.ranking import ranked_top


def tumbling(df: DataFrame, key: str, size: str, delay: str) -> DataFrame:
    """Counts per key and window; closed windows leave the state after ``delay``."""
    out = df.withWatermark("ts", delay).groupBy(F.window("ts", size), key).agg(
        F.count(F.lit(1)).alias("n"))
    return out.select(key, F.unix_seconds("window.start").alias("window_start"), "n")


def _per_user(tags: DataFrame, size: str, hop: str, delay: str) -> DataFrame:
    return tags.withWatermark("ts", delay).groupBy(
        F.window("ts", size, hop), "tag", "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("engagement_score").alias("engagement"))


def _totals() -> list[Column]:
    return [F.sum("n").alias("mention_count"), F.count("user_id").alias("unique_users"),
            F.sum("engagement").alias("total_engagement")]


def hopping_closed(tags: DataFrame, size: str, hop: str, delay: str) -> DataFrame:
    """Mentions, users and engagement per hashtag and hopping window, once it is closed.

    Users are counted exactly by two aggregations in a row: the state of a hot hashtag
    is spread over its users and no set of users is kept. Append mode only.
    """
    out = _per_user(tags, size, hop, delay).groupBy("window", "tag").agg(*_totals())
    return out.select("tag", F.unix_seconds("window.start").alias("window_start"),
                      "mention_count", "unique_users", "total_engagement")


def user_panes(tags: DataFrame, hop: str, delay: str) -> DataFrame:
    """Sums per pane of one hop, hashtag and user, for update mode: one state row per event
    at most. ``operators.windows.windows_of_panes`` fills hopping windows from them."""
    out = tags.withWatermark("ts", delay).groupBy(F.window("ts", hop), "tag", "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("engagement_score").alias("engagement"))
    return out.select("tag", "user_id", F.unix_seconds("window.start").alias("pane"), "n",
                      "engagement")


def per_second(tags: DataFrame, delay: str) -> DataFrame:
    """Mentions per hashtag and second, for update mode; seconds leave the state after
    ``delay``, and a hot hashtag is spread over its seconds."""
    out = tags.withWatermark("ts", delay).groupBy(F.window("ts", "1 second"), "tag").agg(
        F.count(F.lit(1)).alias("n"))
    return out.select("tag", F.unix_seconds("window.start").alias("second"), "n")


def log_totals(seconds: DataFrame, reach: int) -> DataFrame:
    """Mentions per hashtag in the ``reach`` seconds up to its newest mention."""
    newest = seconds.groupBy("tag").agg(F.max("second").alias("newest"))
    return (seconds.join(newest, "tag").filter(F.col("second") >= F.col("newest") - reach)
            .groupBy("tag").agg(F.sum("n").alias("n")))


def sliding_counts(tags: DataFrame, reach: int) -> DataFrame:
    """Batch form of the same report."""
    return log_totals(tags.groupBy("tag", F.unix_seconds("ts").alias("second")).agg(
        F.count(F.lit(1)).alias("n")), reach)


def open_ranking(windows: DataFrame, now_s: int, size_s: int, grace_s: int,
                 n: int) -> DataFrame:
    """Rank the windows that have not expired at ``now``, closed or not."""
    alive = F.col("window_start") + size_s + grace_s > now_s
    return ranked_top(windows.filter(alive), [
        F.desc("n"), F.asc("tag"), F.asc("window_start")], n)


def interval_join(posts: DataFrame, likes: DataFrame, reach: str, delay: str,
                  how: str = "inner") -> DataFrame:
    """Likes within ``reach`` before or after their post.

    Both sides carry a watermark and the condition bounds the time, so Spark can drop
    the state that no later row can match.
    """
    p = posts.withWatermark("ts", delay).alias("p")
    likes = likes.withWatermark("ts", delay).alias("l")
    near = F.expr(f"p.post_id = l.post_id AND l.ts >= p.ts - INTERVAL {reach} "
                  f"AND l.ts <= p.ts + INTERVAL {reach}")
    return p.join(likes, near, how).select(
        F.col("p.post_id").alias("post_id"), F.col("p.ts").alias("post_ts"),
        F.col("l.like_id").alias("like_id"))


def interval_left_counts(posts: DataFrame, likes: DataFrame, comments: DataFrame, reach: str,
                         size: str, delay: str, min_score: int) -> DataFrame:
    """Hourly engagement of posts by two left interval joins in a row and an aggregate.

    As in ``operators.joins.interval_counts`` likes and comments multiply, and the window is that
    of the post. A post without a partner leaves a join, with nulls, once the watermark has
    passed its reach; every join holds the watermark of what it passes on back by its reach, so
    that a window closes when no post of it can change any more. Append mode only.
    """
    p = posts.withWatermark("ts", delay).select(
        "post_id", "user_id", "content", F.col("ts").alias("post_ts"))
    like = likes.withWatermark("ts", delay).select(
        F.col("post_id").alias("liked"), "like_id", F.col("ts").alias("like_ts"))
    comment = comments.withWatermark("ts", delay).select(
        F.col("post_id").alias("commented"), "comment_id", F.col("ts").alias("comment_ts"))

    def near(key: str, ts: str) -> Column:
        return F.expr(f"post_id = {key} AND {ts} >= post_ts - INTERVAL {reach} "
                      f"AND {ts} <= post_ts + INTERVAL {reach}")

    pairs = p.join(like, near("liked", "like_ts"), "left").join(
        comment, near("commented", "comment_ts"), "left")
    out = pairs.groupBy(F.window("post_ts", size), "post_id").agg(
        F.any_value("user_id").alias("user_id"), F.any_value("content").alias("content"),
        F.count("like_id").alias("total_likes"), F.count("comment_id").alias("total_comments"))
    score = F.col("total_likes") + 3 * F.col("total_comments")
    return out.select("post_id", "user_id", "content", F.unix_seconds("window.start").alias(
        "window_start"), "total_likes", "total_comments", score.alias("engagement_score")).where(
        F.col("engagement_score") > min_score)


def once_per_id(df: DataFrame, key: str, memory: str) -> DataFrame:
    """The first row per id; ids are forgotten after ``memory``."""
    return df.withWatermark("ts", memory).dropDuplicatesWithinWatermark([key])
