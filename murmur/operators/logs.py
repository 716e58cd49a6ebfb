"""Reports on logs, traces, events and authentication.

logs: event_id, ts, logger, level, trace_id, error, latency_ms, message. Structured
fields may be missing and then come from a JSON message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.functions.columns import count_if, percent
from murmur.functions.ranking import index_percentiles, top
from murmur.operators.joins import duration_ms
from murmur.operators.messages import log_field


def is_error() -> Column:
    return F.coalesce(F.upper(log_field("level", "level")) == "ERROR", F.lit(False))


def last_minutes(logs: DataFrame, as_of: Column, minutes: int) -> DataFrame:
    since = as_of - F.make_dt_interval(mins=F.lit(minutes))
    return logs.filter((F.col("ts") >= since) & (F.col("ts") <= as_of))


def error_rate(logs: DataFrame) -> DataFrame:
    n, bad = F.count(F.lit(1)), count_if(is_error())
    return logs.agg(n.alias("total_logs"), bad.alias("errors"),
                    F.bround(percent(bad, n), 2).alias("error_rate"))


def error_series(logs: DataFrame, as_of_s: int, minutes: int, intervals: int) -> DataFrame:
    """Error rate in equal half-open intervals up to ``as_of``, empty ones included."""
    step = minutes * 60 // intervals
    start = as_of_s - step * intervals
    inside = logs.filter((F.col("ts") >= F.timestamp_seconds(F.lit(start)))
                         & (F.col("ts") < F.timestamp_seconds(F.lit(as_of_s))))
    slot = F.floor((F.unix_micros("ts") - F.lit(start * 1_000_000)) / F.lit(step * 1_000_000))
    counts = inside.groupBy(slot.cast("long").alias("slot")).agg(
        F.count(F.lit(1)).alias("n"), count_if(is_error()).alias("bad"))
    slots = logs.sparkSession.range(intervals).withColumnRenamed("id", "slot")
    n, bad = F.coalesce("n", F.lit(0)), F.coalesce("bad", F.lit(0))
    return slots.join(counts, "slot", "left").select(
        (F.lit(start + step) + F.col("slot") * step).alias("interval_end"),
        n.alias("total_logs"), bad.alias("errors"),
        F.bround(percent(bad, n), 2).alias("error_rate"))


def top_errors(logs: DataFrame, n: int = 10) -> DataFrame:
    text = F.coalesce(log_field("error", "error"), log_field("error_type"),
                      F.lit("Unknown error"))
    counts = logs.filter(is_error()).groupBy(text.alias("error")).agg(
        F.count(F.lit(1)).alias("count"))
    return top(counts, [F.desc("count"), F.asc("error")], n)


def latency_stats(logs: DataFrame, keys: list[str]) -> DataFrame:
    """Mean, extremes and index percentiles of the latency per group."""
    latency = F.coalesce(F.col("latency_ms"), log_field("latency_ms").try_cast("double"))
    df = logs.select(*keys, latency.alias("latency")).filter(F.col("latency").isNotNull())
    stats = index_percentiles(df, keys, "latency", {"p50": 0.50, "p95": 0.95, "p99": 0.99})
    return stats.select(*keys, "n", *[
        F.bround(c, 2).alias(c) for c in ("avg", "min", "max", "p50", "p95", "p99")])


def bucket_percentiles(df: DataFrame, value: str, bounds: list[float],
                       points: dict[str, float]) -> DataFrame:
    """Percentiles as the upper bound of the first bucket that reaches n * p.

    Values beyond the last bound are left out, and without any value the result is
    empty. The window runs over the buckets.
    """
    edges = F.array(*[F.lit(float(b)) for b in bounds])
    upper = F.array_min(F.filter(edges, lambda b: F.col(value) <= b))
    counts = df.select(upper.alias("le")).filter(F.col("le").isNotNull()).groupBy("le").agg(
        F.count(F.lit(1)).alias("n"))
    order = Window.orderBy("le")
    cumulative = counts.select(
        "le", F.sum("n").over(order).alias("upto"), F.sum("n").over(Window.partitionBy())
        .alias("total"))
    return cumulative.agg(*[
        F.min(F.when(F.col("upto") >= F.col("total") * F.lit(p), F.col("le"))).alias(name)
        for name, p in points.items()])


def component_volume(logs: DataFrame) -> DataFrame:
    name = F.coalesce(log_field("logger", "logger"), F.lit("unknown"))
    return logs.groupBy(name.alias("component")).agg(F.count(F.lit(1)).alias("n"))


def trace_search(logs: DataFrame, trace_id: str) -> DataFrame:
    """Rows of one trace in time order: by their own field, by the field of a JSON message,
    or, if the message has no such field, by a mention in it."""
    inner = F.get_json_object("message", "$.trace_id")
    mention = inner.isNull() & F.contains("message", F.lit(trace_id))
    found = (F.col("trace_id") == trace_id) | (inner == trace_id) | mention
    return logs.filter(F.coalesce(found, F.lit(False))).orderBy("ts", "event_id")


def component_logs(logs: DataFrame, component: str, n: int = 10) -> DataFrame:
    name = F.lower(log_field("logger", "logger"))
    return top(logs.filter(F.contains(name, F.lit(component.lower()))),
               [F.desc("ts"), F.desc("event_id")], n)


def trace_summary(spans: DataFrame) -> DataFrame:
    """Totals over all spans; needs trace_id, service, start_ts, end_ts."""
    return spans.withColumn("duration_ms", duration_ms()).agg(
        F.count(F.lit(1)).alias("total_spans"),
        F.count_distinct("service").alias("active_services"),
        F.avg("duration_ms").alias("avg_duration_ms"),
        F.count_distinct("trace_id").alias("complete_traces"))


def newest_spans(spans: DataFrame, n: int = 10) -> DataFrame:
    return top(spans, [F.desc("start_ts"), F.desc("span_id")], n)


def event_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def newest_events(events: DataFrame, n: int, event_type: str | None = None) -> DataFrame:
    """The newest n events, of which then only one type is kept."""
    last = top(events, [F.desc("event_id")], n)
    return last.filter(F.col("event_type") == event_type) if event_type else last


def auth_stats(auth: DataFrame) -> DataFrame:
    """Totals over authentication attempts: success, mechanism, latency_ms."""
    n, good = F.count(F.lit(1)), count_if(F.col("success"))
    latency = F.avg(F.when(F.col("latency_ms") > 0, F.col("latency_ms")))
    return auth.agg(
        n.alias("total_attempts"), good.alias("successful_auths"),
        count_if(~F.col("success")).alias("failed_auths"),
        F.bround(percent(good, n), 2).alias("success_rate"),
        count_if(F.col("mechanism") == "SCRAM-SHA-512").alias("scram_auths"),
        count_if(F.col("mechanism") == "PLAIN").alias("plain_auths"),
        F.bround(F.coalesce(latency, F.lit(0.0)), 2).alias("avg_latency_ms"))


def auth_failures(auth: DataFrame, limit: float = 10.0) -> DataFrame:
    """Users whose share of failures exceeds the limit, worst first."""
    n, bad = F.count(F.lit(1)), count_if(~F.col("success"))
    rates = auth.groupBy("username").agg(
        percent(bad, n).alias("rate"), n.alias("total_attempts"), bad.alias("failures"))
    return (rates.filter(F.col("rate") > limit)
            .select("username", F.bround("rate", 2).alias("failure_rate"), "total_attempts",
                    "failures")
            .orderBy(F.desc("failure_rate"), "username"))
