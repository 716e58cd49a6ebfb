"""Spam, policy and enrichment of posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur import fixed_values as fv
from murmur.functions import text
from murmur.functions.columns import (
    any_hit, clamp01, computed_once, count_chars, count_if, count_text, first_match, hits,
    md5_mod)


def spam_score(content: Column) -> Column:
    w = fv.SPAM_WEIGHTS
    content = F.coalesce(content, F.lit(""))
    size = F.length(content)
    upper = count_chars(content, r"\p{Lu}") / F.greatest(size, F.lit(1))
    return clamp01(
        F.lit(w["base"])
        + F.lit(w["url_count"]) * count_text(content, "http")
        + F.lit(w["all_caps_ratio"]) * upper
        + F.lit(w["exclamation_count"]) * count_text(content, "!")
        + F.lit(w["emoji_count"]) * count_chars(content, fv.EMOJI_CLASS)
        + F.lit(w["content_length"]) * (size / F.lit(1000.0)))


LOW = "__low"


def with_lower(posts: DataFrame) -> DataFrame:
    """Lower-case text as a column of its own, made once for all the tests on it.

    Missing text counts as empty.
    """
    return posts.withColumn("content", F.coalesce("content", F.lit(""))).withColumn(
        LOW, F.lower("content"))


def spam_reason(content: Column, lowered: Column, reputation: Column | None = None) -> Column:
    """The first tier that fires, or 'clean'."""
    known = F.lit(fv.DEFAULT_REPUTATION) if reputation is None else F.coalesce(
        reputation, F.lit(fv.DEFAULT_REPUTATION))
    return first_match([
        (text.holds_words(content, lowered, fv.SPAM_PHRASES), "keyword_match"),
        (count_chars(content, fv.EMOJI_CLASS) > fv.SPAM_EMOJI_LIMIT, "emoji_spam"),
        (spam_score(content) > fv.SPAM_SCORE_LIMIT, "ml_detected"),
        (known < fv.SPAM_MIN_REPUTATION, "behavior_anomaly"),
    ], "clean")


def policy(content: Column, lowered: Column) -> Column:
    """struct<action, violations>."""
    mature = F.filter(
        F.array(*[F.when(content.rlike(text.whole_words([w])), F.lit("mature_content"))
                  for w in fv.MATURE_WORDS]),
        lambda v: v.isNotNull())

    def verdict(action: str, violations: Column) -> Column:
        return F.struct(F.lit(action).alias("action"), violations.alias("violations"))

    return first_match([
        (text.holds_words(content, lowered, fv.PROHIBITED_WORDS),
         verdict("REMOVE", F.array(F.lit("prohibited_content")))),
        (text.holds_words(content, lowered, fv.MATURE_WORDS), verdict("RESTRICT", mature)),
        (text.holds_any(content, lowered, fv.CLICKBAIT_PHRASES),
         verdict("DEPRIORITIZE", F.array(F.lit("low_quality")))),
    ], verdict("ALLOW", F.array().cast("array<string>")))


def user_reputation(user: Column) -> Column:
    return md5_mod(user, 50) + F.lit(50)


def category(lowered: Column) -> Column:
    return first_match([(any_hit(lowered, words), name)
                        for name, words in fv.CATEGORY_WORDS.items()], fv.DEFAULT_CATEGORY)


def engagement_prediction(content: Column, reputation: Column, has_image: Column) -> Column:
    size = F.length(content)
    by_size = F.when(size > 500, F.lit(-0.1)).when(size < 50, F.lit(-0.2)).otherwise(F.lit(0.0))
    image = F.when(has_image, F.lit(0.2)).otherwise(F.lit(0.0))
    return clamp01(F.lit(0.5) + (reputation - 50) / F.lit(100) * F.lit(0.3) + by_size + image)


def sentiment(lowered: Column) -> Column:
    good, bad = hits(lowered, fv.POSITIVE_WORDS), hits(lowered, fv.NEGATIVE_WORDS)
    return first_match([(good > bad, "positive"), (bad > good, "negative")], "neutral")


def enrich(posts: DataFrame) -> DataFrame:
    """Add reputation, category, engagement prediction and sentiment."""
    user = F.coalesce(F.col("user_id").cast("string"), F.lit("unknown"))
    prepared = with_lower(posts).withColumn("user_reputation", user_reputation(user))
    return prepared.withColumns({
        "category": category(F.col(LOW)),
        "engagement_prediction": engagement_prediction(
            F.col("content"), F.col("user_reputation"), F.col("has_image")),
        "sentiment": sentiment(F.col(LOW)),
    }).drop(LOW)


def with_spam_reason(posts: DataFrame, reputation: Column | None = None) -> DataFrame:
    rows = with_lower(posts)
    return computed_once(rows, "spam_reason", spam_reason(
        F.col("content"), F.col(LOW), reputation)).drop(LOW)


def with_policy(posts: DataFrame) -> DataFrame:
    return computed_once(with_lower(posts), "policy", policy(
        F.col("content"), F.col(LOW))).drop(LOW)


def judged(posts: DataFrame) -> DataFrame:
    """Add the spam reason and, for rows that are no spam, the policy verdict."""
    content, lowered = F.col("content"), F.col(LOW)
    rows = computed_once(with_lower(posts), "spam_reason", spam_reason(content, lowered))
    return computed_once(rows, "policy", F.when(
        F.col("spam_reason") == "clean", policy(content, lowered))).drop(LOW)


def moderate(posts: DataFrame) -> DataFrame:
    """Drop spam and removable posts, enrich the rest and attach the verdict."""
    kept = judged(posts).filter(
        (F.col("spam_reason") == "clean") & (F.col("policy.action") != "REMOVE"))
    return (enrich(kept)
            .withColumn("policy_action", F.col("policy.action"))
            .withColumn("policy_violations", F.col("policy.violations"))
            .drop("spam_reason", "policy"))


def funnel(posts: DataFrame) -> DataFrame:
    """Counts at every stage and per reason, in one pass, as (stage, n) rows."""
    action, reason = F.col("policy.action"), F.col("spam_reason")
    # A restricted post is enriched but does not count as passing the policy.
    stages = {
        "received": F.lit(True),
        "after_spam": reason == "clean",
        "after_policy": action.isin("ALLOW", "DEPRIORITIZE"),
        "enriched": action != "REMOVE",
        **{f"spam_{r}": reason == r
           for r in ("keyword_match", "emoji_spam", "ml_detected", "behavior_anomaly")},
        **{f"policy_{a}": action == a for a in ("REMOVE", "RESTRICT")},
    }
    counts = judged(posts).agg(*[count_if(cond).alias(name) for name, cond in stages.items()])
    return counts.unpivot([], list(stages), "stage", "n")


def violation_flags(posts: DataFrame) -> DataFrame:
    lowered = F.lower("content")
    return (posts.filter(any_hit(lowered, fv.VIOLATION_WORDS))
            .select("post_id", F.lit("content_violation").alias("reason"),
                    F.lit("high").alias("severity")))


def is_toxic(content: Column) -> Column:
    return any_hit(F.lower(content), fv.TOXIC_WORDS)
