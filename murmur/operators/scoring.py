"""Scores and features of single interactions, users and contents."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur import fixed_values as fv
from murmur.functions.columns import lookup, md5_mod
from murmur.functions.ranking import newest_per_key, top_per_key


def window_weight(kind: Column) -> Column:
    return lookup(F.upper(kind), fv.WINDOW_SCORE_WEIGHTS, 0.0)


def recency_factor(age_hours: Column) -> Column:
    """1 for the first hour, then an exponential decay that reaches 0.3 at 24 hours."""
    rate = -math.log(fv.RECENCY_FLOOR) / 23.0
    return (F.when(age_hours <= 1, F.lit(1.0))
            .when(age_hours >= 24, F.lit(fv.RECENCY_FLOOR))
            .otherwise(F.exp(F.lit(-rate) * (age_hours - 1))))


def ranking_signals(df: DataFrame, as_of_s: float, level: str = "regular_user") -> DataFrame:
    """Score valid interactions; needs user_id, content_id, interaction_type, ts_s."""
    age = (F.lit(float(as_of_s)) - F.col("ts_s")) / F.lit(3600.0)
    reputation = fv.REPUTATION_LEVELS.get(level, 1.0)
    weight = lookup(F.col("interaction_type"), fv.RECENCY_WEIGHTS, fv.RECENCY_DEFAULT_WEIGHT)
    scored = df.withColumn("base_weight", weight).withColumn("recency_factor", recency_factor(age))
    return (scored
            .withColumn("user_reputation", F.lit(reputation))
            .withColumn("engagement_score", F.bround(
                F.col("base_weight") * F.col("recency_factor") * F.lit(reputation), 4))
            .withColumn("recency_factor", F.bround("recency_factor", 4)))


def user_features(df: DataFrame) -> DataFrame:
    """Needs follower_count, following_count, account_age_days, engagement_rate, interests."""
    ratio = F.try_divide(F.coalesce("following_count", F.lit(0)),
                         F.coalesce("follower_count", F.lit(1)))
    interests = F.coalesce(F.size("interests"), F.lit(0)).cast("long")
    return df.select(
        "user_id",
        F.least(F.coalesce(F.col("follower_count"), F.lit(0)) / F.lit(10000), F.lit(1.0))
        .alias("follower_count_normalized"),
        F.least(F.coalesce(ratio, F.lit(0.0)), F.lit(10.0)).alias("following_ratio"),
        F.least(F.coalesce(F.col("account_age_days"), F.lit(0)) / F.lit(365), F.lit(1.0))
        .alias("account_maturity"),
        F.coalesce(F.col("engagement_rate"), F.lit(0.0)).alias("engagement_rate"),
        F.greatest(interests, F.lit(0)).alias("interest_count"),
        (interests > 0).cast("long").alias("has_interests"))


def content_features(df: DataFrame) -> DataFrame:
    """Needs engagement_score, view_count, tags, category."""
    views = F.coalesce(F.col("view_count"), F.lit(0))
    tags = F.greatest(F.coalesce(F.size("tags"), F.lit(0)), F.lit(0))
    return df.select(
        "content_id",
        F.least(F.coalesce(F.col("engagement_score"), F.lit(0.0)) / F.lit(100), F.lit(1.0))
        .alias("engagement_score_normalized"),
        F.when(views <= 0, F.lit(0.0)).otherwise(F.log10(views + 1) / F.lit(6))
        .alias("view_count_log"),
        tags.cast("long").alias("tag_count"),
        lookup(F.lower("category"), fv.CATEGORY_CODES, 0).cast("long").alias("category_encoded"))


def interaction_features(df: DataFrame) -> DataFrame:
    code = lookup(F.lower(F.coalesce(F.col("interaction_type"), F.lit("view"))),
                  fv.INTERACTION_CODES, 0)
    return df.withColumns({
        "interaction_type_encoded": code.cast("long"),
        "duration_normalized": F.least(
            F.coalesce(F.col("duration_seconds"), F.lit(0)) / F.lit(300), F.lit(1.0)),
    })


def with_feature_lookup(interactions: DataFrame, users: DataFrame,
                        contents: DataFrame) -> DataFrame:
    """Attach user and content features; unmatched sides stay null.

    Both lookup sides hold one row per key, so a hot user or content only makes the
    interaction side skewed, which Spark splits at run time.
    """
    u = users.select("user_id", F.col("follower_count_normalized").alias("user_follower_norm"),
                     F.col("engagement_rate").alias("user_engagement"),
                     F.col("account_maturity").alias("user_maturity"))
    c = contents.select(
        "content_id", F.col("engagement_score_normalized").alias("content_engagement"),
        F.col("view_count_log").alias("content_views_log"),
        F.col("category_encoded").alias("content_category"))
    return interaction_features(interactions).join(u, "user_id", "left").join(
        c, "content_id", "left")


def event_features(df: DataFrame) -> DataFrame:
    """Needs event_type, dwell_time, interactions, viral_score."""
    return df.withColumns({
        "engagement_weight": lookup(F.col("event_type"), fv.FEATURE_WEIGHTS,
                                    fv.FEATURE_DEFAULT_WEIGHT),
        "dwell": F.least(F.coalesce(F.col("dwell_time"), F.lit(0.0)) / F.lit(300.0), F.lit(1.0)),
        "interaction_depth": F.least(
            F.coalesce(F.col("interactions"), F.lit(0)) / F.lit(10.0), F.lit(1.0)),
        "virality_signal": F.coalesce(F.col("viral_score"), F.lit(0.0)),
    })


def content_scores(features: DataFrame, as_of_s: float, history: int = 10) -> DataFrame:
    """State per (user, content) after the last event.

    Needs user_id, content_id, event_id, ts_s, engagement_weight, virality_signal. The
    history of an event includes the event itself. It is kept by second: of the events of
    one second the last counts, though each is an update.
    """
    keys = ["user_id", "content_id"]
    now = F.lit(float(as_of_s))
    by_second = newest_per_key(features.withColumn("second", F.floor("ts_s")),
                               [*keys, "second"], ["ts_s", "event_id"])
    recent = top_per_key(by_second, keys, [F.desc("ts_s"), F.desc("event_id")], history)
    decay = F.exp(F.lit(-0.1) * (now - F.col("ts_s")) / F.lit(86400.0))
    scored = recent.groupBy(*keys).agg(
        (F.sum(F.col("engagement_weight") * decay) / F.count(F.lit(1))).alias("past"),
        F.max_by(F.struct("engagement_weight", "virality_signal", "ts_s"),
                 F.struct("ts_s", "event_id")).alias("last"))
    updates = features.groupBy(*keys).agg(F.count(F.lit(1)).alias("update_count"))
    last_ts = F.col("last.ts_s")
    parts = {
        "engagement": F.least(
            (F.col("past") + F.col("last.engagement_weight")) / F.lit(2), F.lit(1.0)),
        "relevance": md5_mod(F.col("user_id").cast("string"), 100) / F.lit(100.0),
        "virality": F.col("last.virality_signal"),
        "freshness": F.when(last_ts == 0, F.lit(0.5)).otherwise(
            F.exp(F.lit(-math.log(2)) * (now - last_ts) / F.lit(3600.0) / F.lit(24.0))),
    }
    total = sum((F.col(n) * F.lit(w) for n, w in fv.CONTENT_SCORE_WEIGHTS.items()), F.lit(0.0))
    return (scored.withColumns(parts).withColumn("total_score", total)
            .join(updates, keys).drop("past", "last"))


def recommendations(scores: DataFrame, n: int = fv.RECOMMENDATIONS_PER_USER) -> DataFrame:
    """The best contents per user with their position and the length of the list."""
    best = top_per_key(scores, ["user_id"], [F.desc("total_score"), F.asc("content_id")], n)
    lists = best.groupBy("user_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "content_id", "total_score"))).alias("items"))
    return lists.withColumn("n", F.size("items").cast("long"))
