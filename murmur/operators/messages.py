"""Mapping of raw messages: versions, platforms, headers, partitions, notifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur import fixed_values as fv
from murmur.functions import text
from murmur.functions.columns import first_match, lookup, md5_mod


def normalize_platform(df: DataFrame, source: str) -> DataFrame:
    """One platform's messages in the common layout; incomplete rows are dropped.

    ios has seconds, android an ISO text and web milliseconds.
    """
    if source == "ios":
        user, post, action, ts = "user", "postId", "action", (F.col("ts") * 1000)
    elif source == "android":
        user, post, action = "userId", "post_id", "event_type"
        ts = F.unix_millis(F.try_to_timestamp(F.col("timestamp")))
    elif source == "web":
        user, post, action, ts = "user_id", "target", "reaction_kind", F.col("occurred_at")
    else:
        raise ValueError(f"unknown platform {source}")
    out = df.select(
        F.col(user).cast("string").alias("user_id"), F.col(post).cast("string").alias("post_id"),
        F.lower(F.col(action).cast("string")).alias("action"), ts.cast("long").alias("timestamp"),
        F.lit(source).alias("source"))
    return out.dropna(how="any", subset=["user_id", "post_id", "action", "timestamp"])


def normalize_platforms(streams: dict[str, DataFrame]) -> DataFrame:
    frames = [normalize_platform(df, source) for source, df in streams.items()]
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other)
    return out


def normalize_versions(df: DataFrame) -> DataFrame:
    """Profiles of versions v1 to v3 in the superset layout.

    Needs schema_version, avatar_url, premium_badge, subscription_tier. ``error`` is
    set for an unknown version.
    """
    version = F.coalesce(F.col("schema_version"), F.lit("v1"))
    from_v2, v3 = version.isin("v2", "v3"), version == "v3"
    known = version.isin("v1", "v2", "v3")
    # Columns that a version does not know are dropped, even when the record holds them.
    return df.withColumns({
        "version": version,
        "avatar_url": F.when(from_v2, F.col("avatar_url")),
        "premium_badge": F.when(v3, F.col("premium_badge")),
        "subscription_tier": F.when(v3, F.col("subscription_tier")),
        "has_avatar": from_v2 & F.col("avatar_url").isNotNull(),
        "is_premium": v3 & F.col("premium_badge").isNotNull(),
        "error": F.when(~known, F.concat(F.lit("Unknown schema version: "), version)),
    }).drop("schema_version")


def detect_version(poll: str = "poll_data", media: str = "media") -> Column:
    return first_match([(F.col(media).isNotNull(), "v3"), (F.col(poll).isNotNull(), "v2")], "v1")


def version_extras(poll: str = "poll_data", media: str = "media") -> Column:
    """Summary of the optional parts, 'none' without any.

    poll is struct<question, options>, media is struct<media_type, urls>.
    """
    poll_text = F.when(F.col(poll).isNotNull(), F.concat(
        F.lit("Poll("), F.col(f"{poll}.question"), F.lit(", "),
        F.size(F.col(f"{poll}.options")), F.lit(" options)")))
    media_text = F.when(F.col(media).isNotNull(), F.concat(
        F.lit("Media("), F.col(f"{media}.media_type"), F.lit(", "),
        F.size(F.col(f"{media}.urls")), F.lit(" items)")))
    joined = F.concat_ws(", ", poll_text, media_text)
    return F.when(joined == "", "none").otherwise(joined)


def with_headers(df: DataFrame, headers: str = "headers") -> DataFrame:
    """Read trace context, feature flags and the extra processing time from headers.

    ``headers`` is array<struct<key, value>>; of a repeated header the last one counts. The
    trace needs both of its ids and the flags need a user segment.
    """
    def at(key: str) -> Column:
        own = F.filter(headers, lambda h: h["key"] == key)
        return F.nullif(F.try_element_at(own, F.lit(-1))["value"], F.lit(""))

    traced = at("trace-id").isNotNull() & at("span-id").isNotNull()
    flags = F.when(at("user-segment").isNotNull(),
                   F.from_json(at("feature-flags"), "map<string,boolean>"))

    def on(flag: str) -> Column:
        return F.coalesce(F.element_at(F.col("flags"), F.lit(flag)), F.lit(False))

    return (df
            .withColumn("trace_id", F.when(traced, at("trace-id")))
            .withColumn("span_id", F.when(traced, at("span-id")))
            .withColumn("service_name", F.when(
                traced, F.coalesce(at("service-name"), F.lit("unknown"))))
            .withColumn("flags", flags)
            .withColumn("user_segment", F.when(F.col("flags").isNotNull(), at("user-segment")))
            .withColumn("processing_ms", F.lit(50)
                        + F.when(on("enhanced_recommendations"), 30).otherwise(0)
                        + F.when(on("new_feed_algorithm"), 25).otherwise(0)))


def key_partition(prefix: str, key: Column, partitions: int) -> Column:
    return md5_mod(F.concat(F.lit(prefix), key.cast("string")), partitions)


def geo_partition(key: Column, healthy: Column, value: Column, partitions: int = 12,
                  unknown_partition: int = 0) -> Column:
    """First healthy preferred partition of the region named in the key.

    ``healthy`` is array<int>. Without a healthy one the region's first choice is
    taken; a null key is spread by the value; an unknown region has one partition.
    """
    parts = F.split(key, ":")
    region = F.when(F.size(parts) > 1, parts[1]).otherwise(fv.DEFAULT_REGION)
    table = F.create_map(*[x for name, prefs in fv.REGION_PARTITIONS.items()
                           for x in (F.lit(name), F.array(*[F.lit(p) for p in prefs]))])
    preferred = F.element_at(table, region)
    usable = F.filter(preferred, lambda p: F.array_contains(healthy, p))
    chosen = F.when(F.size(usable) > 0, usable[0]).otherwise(preferred[0])
    return first_match([
        (key.isNull(), md5_mod(value, partitions)),
        (preferred.isNull(), F.lit(unknown_partition).cast("long")),
    ], chosen.cast("long"))


def domain_notifications(df: DataFrame, site: str = "the network") -> DataFrame:
    """Message to the acting user; needs event_type, user_id, username, post_id."""
    short = F.concat(F.substring("post_id", 1, 8), F.lit("..."))
    message = first_match([
        (F.col("event_type") == "UserRegistered",
         F.concat(F.lit(f"Welcome to {site}, "), F.col("username"),
                  F.lit("! Start sharing your thoughts."))),
        (F.col("event_type") == "PostCreated",
         F.concat(F.lit("Your post "), short, F.lit(" is now live!"))),
        (F.col("event_type") == "PostLiked", F.concat(F.lit("You liked post "), short)),
    ])
    return (df.withColumn("message", message).filter(F.col("message").isNotNull())
            .select("user_id", "event_type", "message"))


def social_notifications(df: DataFrame) -> DataFrame:
    """Follows notify the followed user, comments the owner of the post.

    Needs event_type, user_id, followed_user_id, post_owner_id.
    """
    actor = F.col("user_id").cast("string")
    follow = F.col("event_type") == "follow"
    comment = ((F.col("event_type") == "comment") & F.col("post_owner_id").isNotNull()
               & (F.col("post_owner_id") != F.col("user_id")))
    return df.filter(follow | comment).select(
        F.when(follow, F.col("followed_user_id")).otherwise(F.col("post_owner_id"))
        .alias("recipient"),
        F.when(follow, "new_follower").otherwise("comment").alias("type"),
        F.when(follow, F.concat(F.lit("User "), actor, F.lit(" started following you")))
        .otherwise(F.concat(F.lit("User "), actor, F.lit(" commented on your post")))
        .alias("message"))


def log_field(name: str, column: str | None = None, message: str = "message") -> Column:
    """A structured field, else the field of that name in a JSON message."""
    inner = F.when(F.ltrim(F.col(message)).startswith("{"),
                   F.get_json_object(F.col(message), f"$.{name}"))
    own = F.nullif(F.col(column).cast("string"), F.lit("")) if column else F.lit(None)
    return F.coalesce(own, inner)


def post_metrics(df: DataFrame) -> DataFrame:
    return df.select("post_id", "user_id",
                     F.length("content").cast("long").alias("content_length"), "ts")


def hashtag_occurrences(df: DataFrame, min_length: int = 1) -> DataFrame:
    """One row per hashtag in the text, in lower case."""
    found = text.hashtags(F.col("content"))
    return (df.withColumn("tag", F.explode(found)).withColumn("tag", F.lower("tag"))
            .filter(F.length("tag") >= min_length))


def mention_and_tag_events(df: DataFrame) -> DataFrame:
    """Notifications for the first mentions and index rows for the first tags."""
    def row(kind: str, target) -> Column:
        return F.struct(F.lit(kind).alias("type"), target.alias("target"))

    m = F.transform(F.slice(text.mentions(F.col("content")), 1, fv.MAX_MENTIONS_PER_POST),
                    lambda x: row("mention_notification", x))
    h = F.transform(F.slice(text.hashtags(F.col("content")), 1, fv.MAX_TAGS_PER_POST),
                    lambda x: row("hashtag_index", F.lower(x)))
    return df.select(
        "post_id", "user_id", F.explode(F.concat(m, h)).alias("e"),
        F.substring("content", 1, 100).alias("preview")).select(
        "post_id", "user_id", F.col("e.type").alias("type"), F.col("e.target").alias("target"),
        F.when(F.col("e.type") == "mention_notification", F.col("preview"))
        .alias("content_preview"))


def user_metric_rows(df: DataFrame) -> DataFrame:
    """Metric increments per interaction; needs user_id, interaction_type, duration."""
    kind = F.col("interaction_type")

    def metric(name, value) -> Column:
        return F.struct(name.alias("metric_type"), value.cast("double").alias("metric_value"))

    viewed = F.array(
        metric(F.lit("total_view_time"), F.coalesce(F.col("duration"), F.lit(1.0))),
        metric(F.lit("view_count"), F.lit(1)))
    engaged = F.array(
        metric(F.concat(F.lower(kind), F.lit("_count")), F.lit(1)),
        metric(F.lit("engagement_score"), lookup(kind, fv.METRIC_POINTS, 1)))
    rows = F.when(kind == "VIEW", viewed).when(kind.isin(*fv.METRIC_POINTS), engaged)
    return (df.select("user_id", F.explode(rows).alias("m"), "ts")
            .select("user_id", "m.metric_type", "m.metric_value", "ts"))
