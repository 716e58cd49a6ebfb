"""Conflict resolution between copies of a record.

``seq`` is the order of arrival. The batch forms below are closed forms of the
pairwise fold "resolve(existing, incoming)" over that order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.functions import scans


def last_write_wins(df: DataFrame, key: str) -> DataFrame:
    """Newest ``updated_at`` (else ``created_at``) per key.

    On a tie the earlier arrival stays. A first copy without any time can never be
    replaced.
    """
    ts = F.coalesce("updated_at", "created_at")
    row = F.struct(*[c for c in df.columns if c != key])
    out = df.groupBy(key).agg(
        F.min_by(F.struct(ts.alias("ts"), row.alias("row")), "seq").alias("first"),
        F.max_by(row, F.when(ts.isNotNull(), F.struct(ts, -F.col("seq")))).alias("best"))
    winner = F.when(F.col("first.ts").isNull(), F.col("first.row")).otherwise(F.col("best"))
    return out.select(key, winner.alias("w")).select(key, "w.*")


def merge_profiles(df: DataFrame, key: str = "user_id") -> DataFrame:
    """Merge copies of a profile.

    The user name is the last one, counts and rate are maxima, interests are united and
    everything else keeps its last known value. The distinct interests are found before
    they are gathered, so a key gathers its vocabulary, not its copies.
    """
    known = ["username", "follower_count", "following_count", "engagement_rate", "interests",
             "updated_at", "seq", key]
    others = [c for c in df.columns if c not in known]
    merged = df.groupBy(key).agg(
        F.max_by("username", "seq").alias("username"),
        F.max("follower_count").alias("follower_count"),
        F.max("following_count").alias("following_count"),
        F.max("engagement_rate").alias("engagement_rate"),
        F.max("updated_at").alias("updated_at"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c) for c in others])
    words = df.select(key, F.explode("interests").alias("word")).distinct()
    lists = words.groupBy(key).agg(F.sort_array(F.collect_list("word")).alias("interests"))
    none = F.array().cast("array<string>")
    return merged.join(lists, key, "left").withColumn("interests", F.coalesce("interests", none))


def merge_contents(df: DataFrame, key: str = "content_id",
                   chunk: Column | None = None) -> DataFrame:
    """Newest copy per key with the highest score among the accepted copies.

    A copy is accepted when its time exceeds those of all copies before it.
    """
    seen = scans.scan(
        df, [key], ["seq"], chunk if chunk is not None else scans.by_offset("seq"),
        maxima={"__seen": F.col("updated_at")}, include_current=False)
    row = F.struct(*[c for c in df.columns if c != key])
    # A null order value is not chosen, so only first and accepted copies compete.
    newer = F.col("updated_at") > F.col("__seen")
    out = seen.groupBy(key).agg(
        F.min_by(row, "seq").alias("first"),
        F.max_by(row, F.when(newer, F.col("seq"))).alias("last"),
        F.max(F.when(newer, F.col("engagement_score"))).alias("best"))
    fixed = F.col("first.updated_at").isNull() | F.col("last").isNull()
    score = F.when(fixed, F.col("first.engagement_score")).otherwise(
        F.greatest("best", "first.engagement_score"))
    winner = F.when(fixed, F.col("first")).otherwise(F.col("last"))
    return (out.select(key, winner.alias("w"), score.alias("s")).select(key, "w.*", "s")
            .withColumn("engagement_score", F.col("s")).drop("s"))


def is_newer(source: str, sequence: str, ts: str, other: str = "other_") -> Column:
    """Version vectors: by sequence within a source, by time across sources.

    This is no total order and must not be used to sort.
    """
    same = F.col(source) == F.col(other + source)
    return F.when(same, F.col(sequence) > F.col(other + sequence)).otherwise(
        F.col(ts) > F.col(other + ts))


RESOLVERS = {"user_profile": merge_profiles, "content_metadata": merge_contents}


def resolve(record_type: str, df: DataFrame, key: str) -> DataFrame:
    return RESOLVERS.get(record_type, last_write_wins)(df, key)
