"""Engagement per user, post and metric."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur import fixed_values as fv
from murmur.functions.columns import count_if, first_match, lookup
from murmur.functions.ranking import top, top_per_key


def tier(score: Column) -> Column:
    rules = [(score >= floor, name) for name, floor in fv.TIERS if floor is not None]
    return first_match(rules, fv.TIERS[-1][0])


def reputation(df: DataFrame) -> DataFrame:
    """Counts, score and tier per user; needs user_id, interaction_type."""
    kind = F.col("interaction_type")
    scored = df.groupBy("user_id").agg(
        count_if(kind == "LIKE").alias("like_count"),
        count_if(kind == "COMMENT").alias("comment_count"),
        count_if(kind == "SHARE").alias("share_count"),
        F.sum(lookup(kind, fv.REPUTATION_POINTS, 0)).cast("long").alias("score"))
    return scored.withColumn("tier", tier(F.col("score")))


def reputation_stats(scores: DataFrame) -> DataFrame:
    """One row with totals, the average and a column per tier."""
    return scores.agg(
        F.count(F.lit(1)).alias("total_users"),
        F.coalesce(F.sum("score"), F.lit(0)).alias("total_points"),
        F.coalesce(F.avg("score"), F.lit(0.0)).alias("average_score"),
        *[count_if(F.col("tier") == name).alias(name) for name, _ in reversed(fv.TIERS)])


def top_users(scores: DataFrame, n: int = 10) -> DataFrame:
    return top(scores, [F.desc("score"), F.asc("user_id")], n)


def post_engagement(df: DataFrame) -> DataFrame:
    """Likes, shares, comments and the last update per post."""
    kind = F.col("interaction_type")
    return df.filter(kind.isin("LIKE", "SHARE", "COMMENT")).groupBy("content_id").agg(
        count_if(kind == "LIKE").alias("likes"), count_if(kind == "SHARE").alias("shares"),
        count_if(kind == "COMMENT").alias("comments"), F.max("ts").alias("last_updated"))


def user_metrics(metric_rows: DataFrame) -> DataFrame:
    return metric_rows.groupBy("user_id", "metric_type").agg(
        F.sum("metric_value").alias("metric_value"), F.max("ts").alias("processed_at"))


def metric_summary(metrics: DataFrame) -> DataFrame:
    """Per metric over all users; needs one row per (user, metric)."""
    return metrics.groupBy("metric_type").agg(
        F.sum("metric_value").alias("total_value"),
        F.count(F.lit(1)).alias("user_count")).orderBy(F.desc("total_value"), "metric_type")


def recent_metrics(metrics: DataFrame, since: Column) -> DataFrame:
    return metrics.filter(F.col("processed_at") > since).groupBy("metric_type").agg(
        F.count(F.lit(1)).alias("events"), F.max("processed_at").alias("last_update"))


def decayed_engagement(df: DataFrame, offset: str = "event_id") -> DataFrame:
    """State per user after the last event.

    The score is the weighted count so far times e^(-h/24), where h are the hours
    between the last event and the one before it. Only totals and the last two events
    matter for the final state, so no running window is needed.
    """
    kind = F.col("interaction_type")
    totals = df.groupBy("user_id").agg(
        count_if(kind == "LIKE").alias("likes"), count_if(kind == "COMMENT").alias("comments"),
        count_if(kind == "SHARE").alias("shares"))
    two = top_per_key(df.select("user_id", "ts", offset), ["user_id"], [F.desc(offset)], 2)
    times = two.groupBy("user_id").agg(
        F.max(F.when(F.col("rank") == 1, F.unix_micros("ts"))).alias("last_us"),
        F.max(F.when(F.col("rank") == 2, F.unix_micros("ts"))).alias("before_us"))
    points = fv.DECAY_POINTS
    base = (F.col("likes") * points["LIKE"] + F.col("comments") * points["COMMENT"]
            + F.col("shares") * points["SHARE"])
    hours = F.coalesce(F.col("last_us") - F.col("before_us"), F.lit(0)) / F.lit(3.6e9)
    return (totals.join(times, "user_id")
            .withColumn("score", F.bround(base * F.exp(-hours / 24.0), 2))
            .withColumn("last_update", F.timestamp_micros("last_us"))
            .drop("last_us", "before_us"))


def saturating_score(df: DataFrame) -> DataFrame:
    """Score from 0.5 that stops at 1, with five falling confidences."""
    kind = F.col("interaction_type")
    score = F.least(F.lit(1.0), F.lit(0.5) + count_if(kind == "LIKE") * 0.1
                    + count_if(kind == "SHARE") * 0.2)
    factors = F.array(*[F.lit(x) for x in (0.9, 0.8, 0.7, 0.6, 0.5)])
    scored = df.groupBy("user_id").agg(score.alias("engagement_score"))
    return scored.withColumn("confidences", F.transform(
        factors, lambda x: x * F.col("engagement_score")))


def like_once(likes: DataFrame) -> DataFrame:
    """Likes per post when every user counts once."""
    return likes.select("post_id", "user_id").distinct().groupBy("post_id").agg(
        F.count(F.lit(1)).alias("likes_count"))


def table_stats(tables: dict[str, tuple[DataFrame, dict[str, str]]]) -> DataFrame:
    """Row count and averages of several tables as (table, measure, value) rows."""
    out = None
    for name, (df, averages) in tables.items():
        measures = {"total": F.count(F.lit(1)).cast("double")} | {
            m: F.round(F.avg(c), 4) for m, c in averages.items()}
        row = df.agg(*[e.alias(m) for m, e in measures.items()])
        rows = row.unpivot([], list(measures), "measure", "value").select(
            F.lit(name).alias("table_name"), "measure", "value")
        out = rows if out is None else out.unionByName(rows)
    return out
