"""Row validation, error classes and dead letters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur import fixed_values as fv
from murmur.functions import text
from murmur.functions.columns import any_hit, first_match, is_blank, lookup


def with_required(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep rows in which none of the columns is null or empty."""
    return df.filter(~reduce(lambda a, b: a | b, [is_blank(F.col(c)) for c in columns]))


def interaction_reason(user: str, post: str, kind: str, ts_s: str) -> Column:
    """First reason to reject an interaction, or 'Valid'."""
    broken = (is_blank(F.col(user)) | is_blank(F.col(post))
              | ~F.coalesce(F.col(kind).isin("LIKE", "SHARE", "COMMENT", "VIEW"), F.lit(False))
              | ~F.coalesce(F.col(ts_s) > 0, F.lit(False)))
    return first_match(
        [(broken, "Invalid structure"), (F.col(user).rlike(fv.BOT_PATTERN), "Bot account detected")],
        "Valid")


def with_part(df: DataFrame, reason: str = "reason") -> DataFrame:
    """Adds ``part``, valid or invalid, in one pass; accepted rows lose their reason."""
    ok = F.col(reason) == "Valid"
    return df.withColumns({"part": F.when(ok, "valid").otherwise("invalid"),
                           reason: F.when(~ok, F.col(reason))})


def valid_engagements(df: DataFrame, stored: DataFrame, kinds: list[str]) -> DataFrame:
    """Complete engagements of a known kind whose id is not stored yet."""
    checked = with_required(df, ["user_id", "content_id", "engagement_type"])
    checked = checked.filter(F.col("engagement_type").isin(*kinds))
    return checked.join(stored.select("event_id"), "event_id", "left_anti")


def process_posts(df: DataFrame, max_length: int = 280) -> DataFrame:
    """Clean posts and extract tags; ``reason`` is null for accepted rows.

    Needs columns offset, user_id, content, ts.
    """
    missing = [(F.col(c).isNull(), f"Missing required field: {c}")
               for c in ("user_id", "content", "ts")]
    too_long = (F.length("content") > max_length, "Content exceeds maximum length")
    cleaned = text.clean(F.col("content"))
    return (df.withColumn("reason", first_match([*missing, too_long]))
            .withColumn("id", F.concat_ws("_", F.lit("post"), F.col("offset"), F.col("user_id")))
            .withColumn("content", cleaned)
            .withColumn("hashtags", text.hashtags(F.col("content")))
            .withColumn("mentions", text.mentions(F.col("content"))))


# Row rules: (column, kind, argument). The first broken rule names the error.
FORMATS = {
    "email": r"^[^@\s]+@[^@\s]+\.[^@\s]+$",
    "uri": r"^[a-zA-Z][a-zA-Z0-9+.-]*:\S+$",
    "date-time": r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})?$",
    "uuid": r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
}


def _broken(column: str, kind: str, arg: object) -> Column:
    value = F.col(column)
    if kind == "required":
        return value.isNull()
    if kind == "enum":
        return ~value.isin(*arg)
    if kind == "pattern":
        return ~value.rlike(arg)
    if kind == "max_length":
        return F.length(value) > arg
    if kind == "max_items":
        return F.size(value) > arg
    if kind == "format":
        return ~value.rlike(FORMATS[arg])
    if kind == "items_format":
        return F.exists(value, lambda x: ~x.rlike(FORMATS[arg]))
    raise ValueError(f"unknown rule {kind}")


def validate_rows(df: DataFrame, rules: list[tuple[str, str, object]],
                  one_of: list[str] | None = None) -> DataFrame:
    """Add ``is_valid``, ``error`` and ``error_path``.

    ``one_of`` lists columns of which exactly one must be present.
    """
    problems = [
        (F.coalesce(_broken(c, kind, arg), F.lit(False)),
         F.struct(F.lit(kind).alias("error"), F.lit(c).alias("path")))
        for c, kind, arg in rules]
    if one_of:
        present = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in one_of])
        problems.append((present != 1, F.struct(F.lit("one_of").alias("error"),
                                                F.lit(",".join(one_of)).alias("path"))))
    first = first_match(problems)
    return (df.withColumn("__problem", first)
            .withColumn("is_valid", F.col("__problem").isNull())
            .withColumn("error", F.col("__problem.error"))
            .withColumn("error_path", F.col("__problem.path"))
            .drop("__problem"))


INTERACTION_RULES = [
    ("event_id", "required", None), ("timestamp", "required", None),
    ("interaction_type", "required", None), ("actor_id", "required", None),
    ("target_id", "required", None), ("client_type", "required", None),
    ("event_id", "format", "uuid"), ("timestamp", "format", "date-time"),
    ("interaction_type", "enum", fv.SCHEMA_INTERACTION_TYPES),
    ("actor_id", "pattern", fv.SCHEMA_ACTOR_PATTERN),
    ("content", "max_length", 2000), ("comment_text", "max_length", 500),
    ("reaction_type", "enum", fv.SCHEMA_REACTIONS),
    ("media_urls", "max_items", 10), ("media_urls", "items_format", "uri"),
    ("client_type", "enum", fv.SCHEMA_CLIENTS),
]
INTERACTION_PAYLOADS = ["content", "comment_text", "reaction_type"]


def range_check(rate: Column) -> Column:
    """Error text for an engagement rate outside [0, 1], else null."""
    return F.when((rate < 0) | (rate > 1),
                  F.concat(F.lit("Invalid engagement rate: "), rate.cast("string")))


def error_action(error_class: Column, message: Column, attempts: Column) -> Column:
    """What to do with a failed record: skip, retry, dlq or fatal; a subclass is treated as
    the class it belongs to."""
    error_class = F.coalesce(lookup(error_class, fv.ERROR_BASES, None), error_class)
    return first_match([
        (error_class == "JSONDecodeError",
         F.when(any_hit(F.lower(message), fv.RECOVERABLE_JSON_HINTS), "skip").otherwise("dlq")),
        (error_class.isin("KeyError", "ValueError"),
         F.when(F.coalesce(attempts, F.lit(0)) < 3, "retry").otherwise("dlq")),
        (error_class == "ConnectionError", "retry"),
        (error_class == "MemoryError", "fatal"),
    ], "dlq")


def should_skip(action: Column, attempts: Column) -> Column:
    return (action == "skip") | ((action == "retry") & (F.coalesce(attempts, F.lit(0)) > 5))


def failure_kind(error_class: Column, message: Column) -> Column:
    """transient, permanent or unknown: by class first, then by the message."""
    lowered = F.lower(message)
    return first_match([
        (error_class.isin(*fv.TRANSIENT_ERRORS), "transient"),
        (error_class.isin(*fv.PERMANENT_ERRORS), "permanent"),
        (any_hit(lowered, fv.TRANSIENT_HINTS), "transient"),
        (any_hit(lowered, fv.PERMANENT_HINTS), "permanent"),
    ], "unknown")


def retryable(error_class: Column, message: Column) -> Column:
    return any_hit(message, fv.RETRYABLE_ERRORS) | any_hit(error_class, fv.RETRYABLE_ERRORS)


def backoff(attempt: Column, base: float, multiplier: float, limit: float) -> Column:
    """Exponential delay with an upper bound; the random jitter is left out."""
    return F.least(F.lit(float(base)) * F.pow(F.lit(float(multiplier)), attempt),
                   F.lit(float(limit)))


def dead_letters(df: DataFrame, topic: str, error: str = "error") -> DataFrame:
    """The rows with an error, in the layout of the dead-letter table.

    Needs columns partition, offset, key, value, ts, error_type, attempt_count.
    """
    headers = F.create_map(
        F.lit("errors.topic"), F.lit(topic),
        F.lit("errors.offset"), F.col("offset").cast("string"),
        F.lit("errors.class.name"), F.col("error_type"),
        F.lit("errors.attempt"), F.col("attempt_count").cast("string"))
    return df.filter(F.col(error).isNotNull()).select(
        F.lit(topic).alias("original_topic"), "partition", "offset", "key", "value",
        F.col("ts").alias("timestamp"), "error_type", F.col(error).alias("error_message"),
        "attempt_count", headers.alias("headers"))
