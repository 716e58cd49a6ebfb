"""Rates, roll-ups, alerts, lag and service levels of brokers and consumers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.functions import scans
from murmur.functions.columns import count_if, first_match, percent
from murmur.functions.ranking import newest_per_key, top, top_per_key


def counter_rates(samples: DataFrame, keys: list[str], counters: list[str],
                  chunk: Column | None = None) -> DataFrame:
    """Per-second growth of counters since the sample before; never negative.

    samples: keys, ts, event_id, counters; samples of one time are ordered by event_id.
    First samples and repeated times give no rate.
    """
    prior = scans.scan(
        samples, keys, ["ts", "event_id"], chunk if chunk is not None else scans.by_time("ts"),
        previous={f"p_{c}": c for c in counters} | {"p_ts": "ts"})
    seconds = (F.unix_micros("ts") - F.unix_micros("p_ts")) / F.lit(1e6)
    timed = prior.withColumn("seconds", seconds).filter(F.col("seconds") > 0)
    return timed.select(*keys, "ts", *[
        F.greatest(F.lit(0.0), (F.col(c) - F.col(f"p_{c}")) / F.col("seconds")).alias(f"{c}_rate")
        for c in counters])


def parse_samples(lines: DataFrame, column: str = "value") -> DataFrame:
    """Text samples "name value" as rows; comments and malformed lines are skipped."""
    parts = F.split(F.trim(F.col(column)), r"\s+")
    rows = lines.filter(~F.col(column).startswith("#")).select(
        F.get(parts, 0).alias("metric"), F.get(parts, 1).try_cast("double").alias("value"))
    return rows.filter(F.col("value").isNotNull())


def cluster_health(offline: Column, under: Column, idle_a: Column, idle_b: Column) -> Column:
    low = F.least(idle_a, idle_b)
    return first_match([
        (offline > 0, "CRITICAL"), ((under > 0) | (low < 10), "CRITICAL"), (low < 20, "WARNING"),
    ], "HEALTHY")


def cluster_rollup(samples: DataFrame, by: str = "sample") -> DataFrame:
    """Sums, averages and health per sample time over all brokers."""
    out = samples.groupBy(by).agg(
        F.sum("messages_in").alias("total_messages"), F.sum("bytes_in").alias("total_bytes_in"),
        F.avg("request_idle").alias("avg_request_idle"),
        F.avg("network_idle").alias("avg_network_idle"),
        F.sum("under_replicated").alias("total_under_replicated"),
        F.sum("offline").alias("total_offline"), F.sum("partitions").alias("total_partitions"),
        F.count(F.lit(1)).alias("broker_count"))
    return out.withColumn("health_status", cluster_health(
        F.col("total_offline"), F.col("total_under_replicated"), F.col("avg_request_idle"),
        F.col("avg_network_idle")))


# Alert rules as (metric, column, direction, levels with their limits).
CLUSTER_RULES = [
    ("offline_partitions", "total_offline", "at_least", [("critical", 1)]),
    ("under_replicated_partitions", "total_under_replicated", "at_least",
     [("critical", 5), ("warning", 1)]),
    ("request_handler_idle", "avg_request_idle", "below", [("critical", 10), ("warning", 20)]),
]
BROKER_RULES = [("isr_shrinks", "isr_shrinks", "above", [("critical", 10)])]
CONNECTOR_RULES = [
    ("high_error_rate", "error_rate", "above", [("P0", 0.05)]),
    ("task_failure", "failed_tasks", "above", [("P1", 0)]),
    ("high_lag", "lag_seconds", "above", [("P0", 600)]),
]
REGION_RULES = [
    ("error_rate", "error_rate", "above", [("critical", 0.1)]),
    ("latency_p99", "latency_p99", "above", [("warning", 500)]),
]


def alerts(rows: DataFrame, keys: list[str], rules: list[tuple]) -> DataFrame:
    """One row per broken rule with the first of its levels that applies.

    The rules become an array per row, so no join with a rule table is needed.
    """
    def broken(column: str, limit: float, direction: str) -> Column:
        value = F.col(column)
        return {"at_least": value >= limit, "above": value > limit, "below": value < limit}[direction]

    found = []
    for metric, column, direction, levels in rules:
        level = first_match([(broken(column, limit, direction), name) for name, limit in levels])
        found.append(F.struct(F.lit(metric).alias("metric"), level.alias("level"),
                              F.col(column).cast("double").alias("value")))
    listed = F.filter(F.array(*found), lambda a: a.level.isNotNull())
    return rows.select(*keys, F.explode(listed).alias("a")).select(*keys, "a.*")


def alert_summary(found: DataFrame) -> DataFrame:
    level = F.col("level")
    return found.agg(*[count_if(level == x).alias(x) for x in ("critical", "warning", "info")],
                     F.count(F.lit(1)).alias("total"))


def alert_episodes(found: DataFrame) -> DataFrame:
    """Repeated alerts per source and type with first and last sight."""
    return found.groupBy(F.coalesce("connector", F.lit("system")).alias("connector"), "type").agg(
        F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"),
        F.count(F.lit(1)).alias("count"))


def consumer_lag(latest: DataFrame, committed: DataFrame) -> DataFrame:
    """Lag per partition; a missing or negative commit counts as 0."""
    start = F.greatest(F.coalesce("committed_offset", F.lit(0)), F.lit(0))
    return latest.join(committed, "partition", "left").select(
        "partition", "latest_offset", start.alias("committed_offset"),
        F.greatest(F.lit(0), F.col("latest_offset") - start).alias("lag"))


def total_lag(lags: DataFrame) -> DataFrame:
    return lags.agg(F.sum("lag").alias("total_lag"), F.max("lag").alias("max_lag"))


def sla_health(groups: DataFrame, config: DataFrame) -> DataFrame:
    """Violations, health score and status per consumer group.

    groups: group_id, lag, throughput, latency; config: group_id, max_lag,
    min_throughput, max_latency. Groups without a configuration are unknown.
    """
    lag, rate, latency = F.col("lag"), F.col("throughput"), F.col("latency")
    late, slow, long = (lag > F.col("max_lag"), rate < F.col("min_throughput"),
                        latency > F.col("max_latency"))

    def ratio(value: Column, limit: str, otherwise: float) -> Column:
        return F.when(F.col(limit) > 0, value / F.col(limit)).otherwise(F.lit(otherwise))

    lag_ratio, rate_ratio = ratio(lag, "max_lag", 0.0), ratio(rate, "min_throughput", 1.0)
    latency_ratio = ratio(latency, "max_latency", 0.0)
    lag_cost = F.when(late, F.least(F.lit(40.0), lag_ratio * 40)).otherwise(lag_ratio * 20)
    rate_cost = F.when(slow, F.least(F.lit(30.0), F.greatest(F.lit(0.0), (1 - rate_ratio) * 30))
                       ).otherwise(F.lit(0.0))
    latency_cost = F.when(long, F.least(F.lit(30.0), latency_ratio * 30)).otherwise(
        latency_ratio * 10)
    joined = groups.join(config, "group_id", "left")
    known = F.col("max_lag").isNotNull()
    score = F.greatest(F.lit(0.0), F.lit(100.0) - lag_cost - rate_cost - latency_cost)
    joined = joined.withColumn("raw_score", F.when(known, score).otherwise(F.lit(0.0)))
    status = first_match([(~known, "unknown"), (F.col("raw_score") >= 90, "healthy"),
                          (F.col("raw_score") >= 70, "warning")], "critical")
    return joined.select(
        "group_id", status.alias("status"), F.bround("raw_score", 1).alias("health_score"),
        F.array_compact(F.array(F.when(late, "lag"), F.when(slow, "throughput"),
                                F.when(long, "latency"))).alias("violations"))


def lag_velocity(samples: DataFrame, config: DataFrame, keep: int = 60) -> DataFrame:
    """Lag growth per minute over the last samples and the minutes to the limit.

    samples: group_id, ts, lag.
    """
    recent = top_per_key(samples, ["group_id"], [F.desc("ts")], keep)
    ends = recent.groupBy("group_id").agg(
        F.min_by("lag", "ts").alias("first_lag"), F.max_by("lag", "ts").alias("lag"),
        F.min(F.unix_micros("ts")).alias("t0"), F.max(F.unix_micros("ts")).alias("t1"))
    minutes = (F.col("t1") - F.col("t0")) / F.lit(60e6)
    v = F.when(minutes > 0, (F.col("lag") - F.col("first_lag")) / minutes).otherwise(F.lit(0.0))
    moving = ends.withColumn("v", v).join(config, "group_id", "left")
    to_breach = F.when((F.col("v") > 0) & (F.col("lag") < F.col("max_lag")),
                       (F.col("max_lag") - F.col("lag")) / F.col("v"))
    return moving.select("group_id", "lag", F.bround("v", 0).alias("lag_velocity"),
                         F.bround(to_breach, 1).alias("time_to_breach_min"))


# Scaling advice.
LAG_THRESHOLD = 1000
MIN_CONSUMERS, MAX_CONSUMERS = 3, 12


def scale_advice(lags: DataFrame, group: str, current: Column) -> DataFrame:
    """Two more consumers above the threshold, one less below half of it."""
    worst = lags.groupBy(group).agg(F.max("lag").alias("max_lag"), F.max(current).alias("current"))
    up = (F.col("max_lag") > LAG_THRESHOLD) & (F.col("current") < MAX_CONSUMERS)
    down = (F.col("max_lag") < LAG_THRESHOLD // 2) & (F.col("current") > MIN_CONSUMERS)
    return worst.select(
        group, "max_lag", first_match([(up, "up"), (down, "down")], "hold").alias("advice"),
        first_match([(up, F.least(F.col("current") + 2, F.lit(MAX_CONSUMERS))),
                     (down, F.greatest(F.col("current") - 1, F.lit(MIN_CONSUMERS)))],
                    F.col("current")).cast("long").alias("target"))


def connector_health(rows: DataFrame) -> DataFrame:
    """Score 0-100 and status; needs error_rate, tasks_running, tasks_total, lag_seconds."""
    tasks = F.coalesce(F.try_divide(F.col("tasks_running"), F.col("tasks_total")), F.lit(0.0))
    lag = F.lit(1.0) / (F.lit(1.0) + F.col("lag_seconds") / F.lit(60.0) / F.lit(30.0))
    score = ((F.lit(1.0) - F.col("error_rate")) * 0.4 + tasks * 0.3 + lag * 0.3) * 100
    scored = rows.withColumn("health_score", F.least(F.lit(100.0), F.greatest(F.lit(0.0), score)))
    s = F.col("health_score")
    return scored.withColumn("status", first_match([
        ((s >= 90) & (F.col("error_rate") <= 0.001), "HEALTHY"), (s >= 70, "DEGRADED"),
        (s >= 50, "CRITICAL")], "FAILING"))


def latest_health(rows: DataFrame) -> DataFrame:
    """Newest row per connector; needs connector, ts, seq, health_score, status."""
    return newest_per_key(rows.select("connector", "ts", "seq", "health_score", "status"),
                          ["connector"], ["ts", "seq"])


def overall_score(latest: DataFrame) -> DataFrame:
    return latest.agg(F.count(F.lit(1)).alias("connectors"),
                      F.bround(F.coalesce(F.avg("health_score"), F.lit(0.0)), 1)
                      .alias("overall_score"))


def health_series(rows: DataFrame, as_of: Column, hours: int) -> DataFrame:
    since = as_of - F.make_dt_interval(hours=F.lit(hours))
    return rows.filter(F.col("ts") > since).orderBy("ts", "seq")


def open_alerts(found: DataFrame, n: int = 20) -> DataFrame:
    return top(found.filter(~F.col("resolved")), [F.desc("ts"), F.desc("seq")], n)


def replication_health(partitions: DataFrame) -> DataFrame:
    """Share of healthy partitions; needs replicas, isr, offline_replicas (arrays)."""
    under = F.size("isr") < F.size("replicas")
    off = ~under & (F.size("offline_replicas") > 0)
    n = F.count(F.lit(1))
    out = partitions.agg(n.alias("total_partitions"), count_if(~under & ~off).alias("healthy"),
                         count_if(under).alias("under_replicated"), count_if(off).alias("offline"))
    score = percent(F.col("healthy"), F.col("total_partitions"))
    return out.withColumn("overall_health", score).withColumn("status", first_match([
        (F.col("overall_health") >= 90, "healthy"), (F.col("overall_health") >= 70, "warning")],
        "critical"))


def state_changes(snapshots: DataFrame, keys: list[str], chunk: Column) -> DataFrame:
    """Changes between successive snapshots of a partition.

    snapshots: keys, seq, leader, members array.
    """
    prior = scans.scan(snapshots, keys, ["seq"], chunk,
                       previous={"old_leader": "leader", "old_members": "members"})
    joined = F.array_sort(F.array_except("members", "old_members"))
    left = F.array_sort(F.array_except("old_members", "members"))
    out = prior.filter(F.col("old_members").isNotNull()).select(
        *keys, "seq", joined.alias("joined"), left.alias("left"),
        (F.col("leader") != F.col("old_leader")).alias("leader_changed"), "old_leader", "leader")
    return out.filter((F.size("joined") > 0) | (F.size("left") > 0) | F.col("leader_changed"))
