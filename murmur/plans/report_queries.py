"""Queries of the operations reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur.functions import scans
from murmur.functions.columns import lookup, md5_mod
from murmur.functions.ranking import index_percentiles
from murmur.operators import health, logs, reports, validate
from murmur.plans.join_queries import SPANS_SQL, spans_of
from murmur.plans.registry import query
from murmur.plans.row_queries import (
    AS_OF, AS_OF_S, FAILURES_SQL, failures, joined, json_logs, rounded)

SEC = "epoch_us(ts) // 1000000"


def now():
    return F.to_timestamp(F.lit("2024-01-31 00:00:00"))


# Logs.

@query("agg_error_rate", "logs", f"""
SELECT count(*) AS total_logs, count(*) FILTER (level = 'ERROR') AS errors,
  round_even(count(*) FILTER (level = 'ERROR') * 100.0::DOUBLE / count(*), 2) AS error_rate
FROM logs WHERE ts BETWEEN {AS_OF} - INTERVAL 5 DAY AND {AS_OF}""")
def _(t):
    return logs.error_rate(logs.last_minutes(json_logs(t), now(), 5 * 1440))


@query("agg_error_series", "logs", f"""
SELECT s AS interval_end, count(event_id) AS total_logs, count(CASE WHEN level = 'ERROR' THEN 1 END) AS errors,
  coalesce(round_even(count(CASE WHEN level = 'ERROR' THEN 1 END) * 100.0::DOUBLE
    / nullif(count(event_id), 0), 2), 0.0::DOUBLE) AS error_rate
FROM (SELECT unnest(generate_series({AS_OF_S} - 11 * 7200, {AS_OF_S}, 7200))::BIGINT AS s)
LEFT JOIN logs ON {SEC} >= s - 7200 AND {SEC} < s GROUP BY s""")
def _(t):
    return logs.error_series(json_logs(t), AS_OF_S, 1440, 12)


@query("agg_top_errors", "logs", """
SELECT coalesce(error, 'Unknown error') AS error, count(*) AS count FROM logs WHERE level = 'ERROR'
GROUP BY 1 ORDER BY count DESC, 1 LIMIT 10""")
def _(t):
    return logs.top_errors(json_logs(t))


@query("agg_latency_stats", "logs", """
SELECT logger, n, round_even(avg(latency_ms), 2) AS avg, min(latency_ms) AS min, max(latency_ms) AS max,
  max(CASE WHEN rn = floor(n * 0.5::DOUBLE) + 1 THEN latency_ms END) AS p50,
  max(CASE WHEN rn = floor(n * 0.95::DOUBLE) + 1 THEN latency_ms END) AS p95,
  max(CASE WHEN rn = floor(n * 0.99::DOUBLE) + 1 THEN latency_ms END) AS p99
FROM (SELECT *, row_number() OVER (PARTITION BY logger ORDER BY latency_ms) AS rn,
  count(*) OVER (PARTITION BY logger) AS n FROM logs) GROUP BY logger, n""")
def _(t):
    return logs.latency_stats(json_logs(t), ["logger"])


BOUNDS = [5, 10, 25, 50, 100, 250]


@query("agg_bucket_percentile", "logs", """
WITH b AS (SELECT unnest([5.0, 10, 25, 50, 100, 250])::DOUBLE AS le),
c AS (SELECT le, count(*) AS upto FROM b JOIN logs ON latency_ms <= le GROUP BY le),
n AS (SELECT max(upto) AS total FROM c)
SELECT min(CASE WHEN upto >= total * 0.5::DOUBLE THEN le END) AS p50,
  min(CASE WHEN upto >= total * 0.95::DOUBLE THEN le END) AS p95,
  min(CASE WHEN upto >= total * 0.99::DOUBLE THEN le END) AS p99 FROM c, n""")
def _(t):
    return logs.bucket_percentiles(t.logs, "latency_ms", BOUNDS,
                                   {"p50": 0.5, "p95": 0.95, "p99": 0.99})


@query("agg_component_volume", "logs",
       "SELECT logger AS component, count(*) AS n FROM logs GROUP BY logger")
def _(t):
    return logs.component_volume(json_logs(t))


@query("flt_trace_search", "logs", f"""
SELECT event_id, {SEC} AS ts_s FROM logs
WHERE trace_id = 'trace-42' OR (event_id % 2 = 0 AND event_id % 25 = 0)""")
def _(t):
    """Some rows of other traces mention the wanted one in a plain message."""
    rows = json_logs(t)
    mention = (F.col("event_id") % 2 == 0) & (F.col("event_id") % 25 == 0)
    rows = rows.withColumn("message", F.when(mention, "retry of trace-42").otherwise(
        F.col("message")))
    return logs.trace_search(rows, "trace-42").select(
        "event_id", F.unix_seconds("ts").alias("ts_s"))


@query("flt_component_logs", "logs", f"""
SELECT event_id, logger, {SEC} AS ts_s FROM logs WHERE contains(logger, 'sign')
ORDER BY ts DESC, event_id DESC LIMIT 10""")
def _(t):
    return logs.component_logs(json_logs(t), "SIGN").select(
        "event_id", "logger", F.unix_seconds("ts").alias("ts_s"))


@query("agg_trace_summary", "ev", f"""
SELECT count(*) AS total_spans, count(DISTINCT service) AS active_services,
  round(avg(duration_ms), 6) AS avg_duration_ms, count(DISTINCT trace_id) AS complete_traces
FROM ({SPANS_SQL})""")
def _(t):
    return rounded(logs.trace_summary(spans_of(t)))


@query("agg_trace_newest", "ev", f"""
SELECT trace_id, span_id, service FROM ({SPANS_SQL}) ORDER BY ts DESC, span_id DESC LIMIT 10""")
def _(t):
    return logs.newest_spans(spans_of(t)).select("trace_id", "span_id", "service")


@query("agg_event_counts", "ev", "SELECT event_type, count(*) AS n FROM ev GROUP BY event_type")
def _(t):
    return logs.event_counts(t.ev)


@query("flt_newest_events", "ev", """
SELECT event_id, user_id FROM (SELECT * FROM ev ORDER BY event_id DESC LIMIT 100)
WHERE event_type = 'view'""")
def _(t):
    return logs.newest_events(t.ev, 100, "view").select("event_id", "user_id")


def auth(t):
    return t.ev.select(
        F.concat(F.lit("u"), F.col("user_id")).alias("username"),
        F.when(F.col("k") % 2 == 0, "SCRAM-SHA-512").otherwise("PLAIN").alias("mechanism"),
        (F.col("event_type") != "error").alias("success"),
        F.when(F.col("k") < 5, F.lit(0.0)).otherwise(F.col("value")).alias("latency_ms"))


@query("agg_auth_stats", "ev", """
SELECT count(*) AS total_attempts, count(*) FILTER (event_type <> 'error') AS successful_auths,
  count(*) FILTER (event_type = 'error') AS failed_auths,
  round_even(count(*) FILTER (event_type <> 'error') * 100.0::DOUBLE / count(*), 2) AS success_rate,
  count(*) FILTER (k % 2 = 0) AS scram_auths, count(*) FILTER (k % 2 = 1) AS plain_auths,
  round_even(avg(CASE WHEN k >= 5 AND value > 0 THEN value END), 2) AS avg_latency_ms FROM ev""")
def _(t):
    return logs.auth_stats(auth(t))


@query("agg_auth_failures", "ev", """
SELECT 'u' || user_id AS username,
  round_even(count(*) FILTER (event_type = 'error') * 100.0::DOUBLE / count(*), 2) AS failure_rate,
  count(*) AS total_attempts, count(*) FILTER (event_type = 'error') AS failures
FROM ev GROUP BY user_id
HAVING count(*) FILTER (event_type = 'error') * 100.0::DOUBLE / count(*) > 10""")
def _(t):
    return logs.auth_failures(auth(t))


# Brokers and consumers.

@query("agg_counter_rate", "ev", f"""
SELECT user_id, event_type, epoch_us(ts) AS ts_us, round(greatest(0.0::DOUBLE, (value - p_value) / s), 6) AS value_rate,
  round(greatest(0.0::DOUBLE, (k - p_k) / s), 6) AS k_rate
FROM (SELECT *, (epoch_us(ts) - epoch_us(p_ts)) / 1e6::DOUBLE AS s FROM (
  SELECT *, lag(value) OVER w AS p_value, lag(k) OVER w AS p_k, lag(ts) OVER w AS p_ts FROM ev
  WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id))) WHERE s > 0""")
def _(t):
    rates = health.counter_rates(t.ev, ["user_id", "event_type"], ["value", "k"])
    return rounded(rates.withColumn("ts_us", F.unix_micros("ts")).drop("ts"))


@query("agg_prom_samples", "ev", """
SELECT 'metric_' || event_type AS metric, k * 1.0::DOUBLE AS value FROM ev WHERE k % 10 NOT IN (0, 1)""")
def _(t):
    name = F.concat(F.lit("metric_"), F.col("event_type"))
    line = F.when(F.col("k") % 10 == 0, F.concat(F.lit("# HELP "), name)).when(
        F.col("k") % 10 == 1, F.concat(name, F.lit(" n/a"))).otherwise(
        F.concat(name, F.lit("  "), F.col("k")))
    return health.parse_samples(t.ev.select(line.alias("value")))


def brokers(t):
    """Hourly samples of six brokers, derived from the events they would have served."""
    k = F.col("k")
    return t.ev.groupBy(
        F.floor(F.unix_seconds("ts") / 21600).alias("sample"), (F.col("user_id") % 6)
        .alias("broker_id")).agg(
        F.sum("value").alias("messages_in"), F.sum("k").alias("bytes_in"),
        F.avg("k").alias("request_idle"), (F.avg("k") / 2).alias("network_idle"),
        F.sum(F.when(k == 0, 1).otherwise(0)).alias("under_replicated"),
        F.sum(F.when((k == 1) & (F.col("event_type") == "error"), 1).otherwise(0))
        .alias("offline"), F.count(F.lit(1)).alias("partitions"),
        F.max("k").alias("isr_shrinks"))


BROKERS_SQL = f"""
SELECT {SEC} // 21600 AS sample, user_id % 6 AS broker_id, sum(value) AS messages_in, sum(k) AS bytes_in,
  avg(k) AS request_idle, avg(k) / 2 AS network_idle, count(*) FILTER (k = 0) AS under_replicated,
  count(*) FILTER (k = 1 AND event_type = 'error') AS offline, count(*) AS partitions,
  max(k) AS isr_shrinks FROM ev GROUP BY 1, 2"""
ROLLUP_SQL = f"""
SELECT *, CASE WHEN total_offline > 0 OR total_under_replicated > 0 OR avg_request_idle < 10
    OR avg_network_idle < 10 THEN 'CRITICAL' WHEN avg_request_idle < 20 OR avg_network_idle < 20
    THEN 'WARNING' ELSE 'HEALTHY' END AS health_status
FROM (SELECT sample, round(sum(messages_in), 4) AS total_messages, CAST(sum(bytes_in) AS BIGINT) AS total_bytes_in,
  round(avg(request_idle), 4) AS avg_request_idle, round(avg(network_idle), 4) AS avg_network_idle,
  CAST(sum(under_replicated) AS BIGINT) AS total_under_replicated, CAST(sum(offline) AS BIGINT) AS total_offline,
  CAST(sum(partitions) AS BIGINT) AS total_partitions, count(*) AS broker_count
FROM ({BROKERS_SQL}) GROUP BY sample)"""


def rollup(t):
    return rounded(health.cluster_rollup(brokers(t)), 4)


@query("agg_cluster_rollup", "ev", ROLLUP_SQL)
def _(t):
    return rollup(t)


ALERTS_SQL = f"""
SELECT sample, 'offline_partitions' AS metric, 'critical' AS level, total_offline::DOUBLE AS value
FROM ({ROLLUP_SQL}) WHERE total_offline >= 1
UNION ALL SELECT sample, 'under_replicated_partitions',
  CASE WHEN total_under_replicated >= 5 THEN 'critical' ELSE 'warning' END, total_under_replicated
FROM ({ROLLUP_SQL}) WHERE total_under_replicated >= 1
UNION ALL SELECT sample, 'request_handler_idle',
  CASE WHEN avg_request_idle < 10 THEN 'critical' ELSE 'warning' END, avg_request_idle
FROM ({ROLLUP_SQL}) WHERE avg_request_idle < 20"""


def cluster_alerts(t):
    return health.alerts(rollup(t), ["sample"], health.CLUSTER_RULES)


@query("agg_alerts", "ev", ALERTS_SQL)
def _(t):
    return cluster_alerts(t)


@query("agg_broker_alerts", "ev", f"""
SELECT sample, broker_id, 'isr_shrinks' AS metric, 'critical' AS level, isr_shrinks::DOUBLE AS value
FROM ({BROKERS_SQL}) WHERE isr_shrinks > 10""")
def _(t):
    return health.alerts(brokers(t), ["sample", "broker_id"], health.BROKER_RULES)


@query("agg_connector_alerts", "ev", """
WITH c AS (SELECT event_id AS seq, k / 400.0::DOUBLE AS error_rate, 4 - k % 5 AS failed_tasks,
  value * 20 AS lag_seconds FROM ev)
SELECT seq, 'high_error_rate' AS metric, 'P0' AS level, round(error_rate, 6) AS value FROM c
  WHERE error_rate > 0.05
UNION ALL SELECT seq, 'task_failure', 'P1', failed_tasks FROM c WHERE failed_tasks > 0
UNION ALL SELECT seq, 'high_lag', 'P0', round(lag_seconds, 6) FROM c WHERE lag_seconds > 600""")
def _(t):
    rows = connectors(t).withColumn("failed_tasks", F.col("tasks_total") - F.col("tasks_running"))
    return rounded(health.alerts(rows, ["seq"], health.CONNECTOR_RULES))


@query("agg_region_alerts", "logs", """
WITH r AS (SELECT logger, avg(CASE WHEN level = 'ERROR' THEN 1 ELSE 0 END) AS error_rate,
  max(CASE WHEN rn = floor(n * 0.99::DOUBLE) + 1 THEN latency_ms * 5 END) AS latency_p99
  FROM (SELECT *, row_number() OVER (PARTITION BY logger ORDER BY latency_ms) AS rn,
    count(*) OVER (PARTITION BY logger) AS n FROM logs) GROUP BY logger)
SELECT logger, 'error_rate' AS metric, 'critical' AS level, round(error_rate, 6) AS value FROM r
  WHERE error_rate > 0.1
UNION ALL SELECT logger, 'latency_p99', 'warning', round(latency_p99, 6) FROM r WHERE latency_p99 > 500""")
def _(t):
    rates = t.logs.groupBy("logger").agg(
        F.avg(F.when(F.col("level") == "ERROR", 1).otherwise(0)).alias("error_rate"))
    slow = index_percentiles(t.logs, ["logger"], "latency_ms", {"p99": 0.99}).select(
        "logger", (F.col("p99") * 5).alias("latency_p99"))
    return rounded(health.alerts(rates.join(slow, "logger"), ["logger"], health.REGION_RULES))


@query("agg_alert_summary", "ev", f"""
SELECT count(*) FILTER (level = 'critical') AS critical, count(*) FILTER (level = 'warning') AS warning,
  count(*) FILTER (level = 'info') AS info, count(*) AS total FROM ({ALERTS_SQL})""")
def _(t):
    return health.alert_summary(cluster_alerts(t))


@query("agg_alert_episodes", "ev", f"""
SELECT CASE WHEN k % 4 = 0 THEN 'system' ELSE 'connector' || (k % 4) END AS connector, event_type AS type,
  min({SEC}) AS first_s, max({SEC}) AS last_s, count(*) AS count FROM ev GROUP BY 1, 2""")
def _(t):
    name = F.when(F.col("k") % 4 != 0, F.concat(F.lit("connector"), F.col("k") % 4))
    found = t.ev.select(name.alias("connector"), F.col("event_type").alias("type"), "ts")
    return health.alert_episodes(found).select(
        "connector", "type", F.unix_seconds("first_seen").alias("first_s"),
        F.unix_seconds("last_seen").alias("last_s"), "count")


def partition_lags(t):
    part = F.col("user_id") % 6
    latest = t.ev.groupBy(part.alias("partition")).agg(F.max("event_id").alias("latest_offset"))
    # Clicks know five partitions only, so the sixth has no commit.
    clicks = t.ev.filter(F.col("event_type") == "click")
    done = clicks.groupBy((F.col("k") % 5).alias("partition")).agg(
        (F.max("event_id") - 500).alias("committed_offset"))
    return health.consumer_lag(latest, done)


LAG_SQL = """
SELECT partition, latest_offset, greatest(coalesce(c, 0), 0) AS committed_offset,
  greatest(0, latest_offset - greatest(coalesce(c, 0), 0)) AS lag
FROM (SELECT user_id % 6 AS partition, max(event_id) AS latest_offset FROM ev GROUP BY 1)
LEFT JOIN (SELECT k % 5 AS partition, max(event_id) - 500 AS c FROM ev
  WHERE event_type = 'click' GROUP BY 1) USING (partition)"""


@query("agg_consumer_lag", "ev", LAG_SQL)
def _(t):
    return partition_lags(t)


@query("agg_total_lag", "ev",
       f"SELECT CAST(sum(lag) AS BIGINT) AS total_lag, max(lag) AS max_lag FROM ({LAG_SQL})")
def _(t):
    return health.total_lag(partition_lags(t))


@query("agg_scale_advice", "ev", f"""
SELECT partition, lag AS max_lag, CASE WHEN lag > 1000 THEN 'up' WHEN lag < 500 THEN 'down' ELSE 'hold' END
  AS advice, CASE WHEN lag > 1000 THEN 8 WHEN lag < 500 THEN 5 ELSE 6 END::BIGINT AS target
FROM ({LAG_SQL})""")
def _(t):
    return health.scale_advice(partition_lags(t), "partition", F.lit(6))


# Service levels of the consumer groups (lag, rate, latency).
SLA = [("view", 2500, 6000.0, 60.0), ("click", 1800, 2100.0, 40.0), ("signup", 10000, 1000.0, 90.0)]
SLA_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"('{g}', {a}::BIGINT, {b}::DOUBLE, {c}::DOUBLE)" for g, a, b, c in SLA) + (
    ") AS s(group_id, max_lag, min_throughput, max_latency)")


def sla_config(t):
    """Four fixed rows at most, so Spark broadcasts them by their known size."""
    return t.spark.createDataFrame(
        SLA, "group_id string, max_lag long, min_throughput double, max_latency double")


def consumer_groups(t):
    return t.ev.groupBy(F.col("event_type").alias("group_id")).agg(
        F.count(F.lit(1)).alias("lag"), (F.sum("k") / 40).alias("throughput"),
        F.avg("value").alias("latency"))


GROUPS_SQL = """
SELECT event_type AS group_id, count(*) AS lag, sum(k) / 40::DOUBLE AS throughput, avg(value) AS latency
FROM ev GROUP BY event_type"""
HEALTH_SQL = f"""
SELECT g.group_id, g.lag, g.throughput, g.latency, s.max_lag, CASE WHEN s.max_lag IS NULL THEN 0.0::DOUBLE ELSE
  greatest(0.0::DOUBLE, 100
  - CASE WHEN lag > max_lag THEN least(40.0::DOUBLE, lag / max_lag * 40) ELSE lag / max_lag * 20 END
  - CASE WHEN throughput < min_throughput
      THEN least(30.0::DOUBLE, greatest(0.0::DOUBLE, (1 - throughput / min_throughput) * 30)) ELSE 0 END
  - CASE WHEN latency > max_latency THEN least(30.0::DOUBLE, latency / max_latency * 30)
      ELSE latency / max_latency * 10 END) END AS score,
  concat_ws(',', CASE WHEN lag > max_lag THEN 'lag' END, CASE WHEN throughput < min_throughput
    THEN 'throughput' END, CASE WHEN latency > max_latency THEN 'latency' END) AS violations
FROM ({GROUPS_SQL}) g LEFT JOIN ({SLA_SQL}) s USING (group_id)"""


@query("agg_sla_health", "ev", f"""
SELECT group_id, CASE WHEN max_lag IS NULL THEN 'unknown' WHEN score >= 90 THEN 'healthy'
  WHEN score >= 70 THEN 'warning' ELSE 'critical' END AS status, round_even(score, 1) AS health_score,
  violations FROM ({HEALTH_SQL})""")
def _(t):
    return health.sla_health(consumer_groups(t), sla_config(t)).withColumn(
        "violations", joined("violations"))


@query("join_sla_config", "ev", f"""
SELECT group_id, lag, CASE WHEN max_lag IS NULL THEN 'unknown' ELSE 'known' END AS config, max_lag
FROM ({GROUPS_SQL}) LEFT JOIN ({SLA_SQL}) USING (group_id)""")
def _(t):
    out = consumer_groups(t).join(sla_config(t), "group_id", "left")
    return out.select("group_id", "lag", F.when(F.col("max_lag").isNull(), "unknown")
                      .otherwise("known").alias("config"), "max_lag")


@query("agg_lag_velocity", "ev", f"""
WITH r AS (SELECT event_type AS group_id, ts, k AS lag,
    row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) AS rn FROM ev),
e AS (SELECT group_id, arg_min(lag, ts) AS l0, arg_max(lag, ts) AS lag,
    (max(epoch_us(ts)) - min(epoch_us(ts))) / 60e6::DOUBLE AS m FROM r WHERE rn <= 60 GROUP BY group_id)
SELECT group_id, lag, round_even((lag - l0) / m * 1.0, 0) AS lag_velocity,
  CASE WHEN lag - l0 > 0 AND lag < max_lag THEN round_even((max_lag - lag) / ((lag - l0) / m), 1) END
  AS time_to_breach_min
FROM e LEFT JOIN ({SLA_SQL}) USING (group_id)""")
def _(t):
    samples = t.ev.select(F.col("event_type").alias("group_id"), "ts", F.col("k").alias("lag"))
    return health.lag_velocity(samples, sla_config(t))


def connectors(t):
    return t.ev.select(
        F.concat(F.lit("connector"), F.col("user_id") % 9).alias("connector"), "ts",
        F.col("event_id").alias("seq"), (F.col("k") / 400).alias("error_rate"),
        (F.col("k") % 5).alias("tasks_running"), F.lit(4).alias("tasks_total"),
        (F.col("value") * 20).alias("lag_seconds"))


CONNECTORS_SQL = """
SELECT *, CASE WHEN health_score >= 90 AND error_rate <= 0.001 THEN 'HEALTHY'
  WHEN health_score >= 70 THEN 'DEGRADED' WHEN health_score >= 50 THEN 'CRITICAL' ELSE 'FAILING' END AS status
FROM (SELECT 'connector' || (user_id % 9) AS connector, ts, event_id AS seq, k / 400.0::DOUBLE AS error_rate,
  round(least(100.0::DOUBLE, greatest(0.0::DOUBLE, ((1 - k / 400.0::DOUBLE) * 0.4::DOUBLE
    + (k % 5) / 4.0::DOUBLE * 0.3::DOUBLE + 1 / (1 + value * 20 / 60 / 30) * 0.3::DOUBLE) * 100)), 6)
    AS health_score FROM ev)"""


def connector_scores(t):
    return health.connector_health(connectors(t))


@query("agg_connector_health", "ev",
       f"SELECT seq, connector, health_score, status FROM ({CONNECTORS_SQL})")
def _(t):
    return rounded(connector_scores(t)).select("seq", "connector", "health_score", "status")


@query("agg_latest_per_key", "ev", f"""
SELECT connector, seq, round_even(health_score, 1) AS health_score, status FROM (SELECT *,
  row_number() OVER (PARTITION BY connector ORDER BY ts DESC, seq DESC) AS rn FROM ({CONNECTORS_SQL}))
WHERE rn = 1""")
def _(t):
    return health.latest_health(connector_scores(t)).select(
        "connector", "seq", F.bround("health_score", 1).alias("health_score"), "status")


@query("agg_overall_score", "ev", f"""
SELECT count(*) AS connectors, round_even(avg(health_score), 1) AS overall_score FROM (SELECT *,
  row_number() OVER (PARTITION BY connector ORDER BY ts DESC, seq DESC) AS rn FROM ({CONNECTORS_SQL}))
WHERE rn = 1""")
def _(t):
    return health.overall_score(health.latest_health(connector_scores(t)))


@query("agg_series", "ev", f"""
SELECT connector, {SEC} AS ts_s, seq, health_score FROM ({CONNECTORS_SQL})
WHERE ts > {AS_OF} - INTERVAL 24 HOUR""")
def _(t):
    rows = rounded(connector_scores(t))
    return health.health_series(rows, now(), 24).select(
        "connector", F.unix_seconds("ts").alias("ts_s"), "seq", "health_score")


@query("agg_open_alerts", "ev", f"""
SELECT seq, connector, status FROM ({CONNECTORS_SQL}) WHERE status IN ('CRITICAL', 'FAILING')
ORDER BY ts DESC, seq DESC LIMIT 20""")
def _(t):
    found = connector_scores(t).withColumn(
        "resolved", ~F.col("status").isin("CRITICAL", "FAILING"))
    return health.open_alerts(found).select("seq", "connector", "status")


def replicas(t):
    """Snapshots of partitions with their leader and in-sync members."""
    k = F.col("k")
    members = F.filter(F.array(F.lit(1), F.lit(2), F.lit(3)), lambda m: k % (m + 3) != 0)
    return t.ev.select(
        (F.col("user_id") % 12).alias("partition"), F.col("event_id").alias("seq"),
        (k % 3 + 1).alias("leader"), members.alias("members"))


REPLICAS_SQL = """
SELECT user_id % 12 AS partition, event_id AS seq, k % 3 + 1 AS leader,
  list_filter([1, 2, 3], lambda m: k % (m + 3) <> 0) AS members, k FROM ev"""


@query("agg_state_changes", "ev", f"""
SELECT partition, seq, array_to_string(list_sort(list_filter(members, lambda m: NOT list_contains(o, m))), ',')
    AS joined, array_to_string(list_sort(list_filter(o, lambda m: NOT list_contains(members, m))), ',') AS "left",
  leader <> ol AS leader_changed
FROM (SELECT *, lag(members) OVER w AS o, lag(leader) OVER w AS ol FROM ({REPLICAS_SQL})
  WINDOW w AS (PARTITION BY partition ORDER BY seq))
WHERE o IS NOT NULL AND (list_sort(members) <> list_sort(o) OR leader <> ol)""")
def _(t):
    out = health.state_changes(replicas(t), ["partition"], scans.by_offset("seq"))
    return out.select("partition", "seq", joined(out["joined"].cast("array<string>"))
                      .alias("joined"), joined(out["left"].cast("array<string>")).alias("left"),
                      "leader_changed")


@query("agg_replication_health", "ev", f"""
SELECT *, round(healthy * 100.0::DOUBLE / total_partitions, 6) AS overall_health,
  CASE WHEN healthy * 100.0 / total_partitions >= 90 THEN 'healthy'
    WHEN healthy * 100.0 / total_partitions >= 70 THEN 'warning' ELSE 'critical' END AS status
FROM (SELECT count(*) AS total_partitions, count(*) FILTER (len(members) = 3 AND k % 11 <> 0) AS healthy,
  count(*) FILTER (len(members) < 3) AS under_replicated,
  count(*) FILTER (len(members) = 3 AND k % 11 = 0) AS offline FROM ({REPLICAS_SQL}))""")
def _(t):
    k = F.col("k")
    members = F.filter(F.array(F.lit(1), F.lit(2), F.lit(3)), lambda m: k % (m + 3) != 0)
    off = F.when(k % 11 == 0, F.array(F.lit(9))).otherwise(F.array().cast("array<int>"))
    df = t.ev.select(F.array(F.lit(1), F.lit(2), F.lit(3)).alias("replicas"),
                     members.alias("isr"), off.alias("offline_replicas"))
    return rounded(health.replication_health(df))


# Partitions, order, duplicates, payments.

def keyed(t):
    key = F.concat(F.lit("user:"), F.col("user_id"))
    return t.ev.select(md5_mod(key, 6).alias("partition"), "user_id")


WORKLOAD_SQL = """
SELECT CAST(('0x' || md5('user:' || user_id))::UHUGEINT % 6 AS BIGINT) AS partition,
  count(DISTINCT user_id) AS users, count(*) AS total_posts FROM ev GROUP BY 1"""


@query("agg_partition_workload", "ev", WORKLOAD_SQL)
def _(t):
    return reports.partition_workload(keyed(t))


@query("agg_partition_balance", "ev", f"""
SELECT CAST(sum(total_posts) AS BIGINT) AS total_keys, round(sum(total_posts) / 6::DOUBLE, 6) AS average_per_partition,
  round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1 - var_pop(total_posts) / (avg(total_posts) * avg(total_posts)))), 6)
    AS balance, arg_max(partition, total_posts) AS hottest, arg_min(partition, total_posts) AS coldest
FROM ({WORKLOAD_SQL})""")
def _(t):
    return rounded(reports.partition_balance(reports.partition_workload(keyed(t)), 6))


@query("agg_hotspots", "ev", f"""
SELECT partition, users, total_posts, round(avg(total_posts) OVER (), 6) AS average,
  CASE WHEN total_posts > avg(total_posts) OVER () * 1.5::DOUBLE THEN 'hot'
    WHEN total_posts < avg(total_posts) OVER () * 0.5::DOUBLE THEN 'cold' ELSE 'normal' END AS flag
FROM ({WORKLOAD_SQL})""")
def _(t):
    loads = reports.partition_workload(keyed(t))
    return rounded(reports.hotspots(loads, "total_posts", 1.5, 0.5))


@query("agg_hotspots_throughput", "ev", """
WITH w AS (SELECT CASE WHEN k < 50 THEN 0 WHEN k < 70 THEN 1 WHEN k < 85 THEN 2 WHEN k < 99 THEN 3 ELSE 4 END::BIGINT
    AS partition, count(*) AS n FROM ev GROUP BY 1)
SELECT partition, n, round(avg(n) OVER (), 6) AS average,
  CASE WHEN n > avg(n) OVER () * 2.0::DOUBLE THEN 'hot' WHEN n < avg(n) OVER () * 0.1::DOUBLE THEN 'cold'
    ELSE 'normal' END AS flag FROM w""")
def _(t):
    """Throughput over twice, or under a tenth of, the mean; one partition of each kind."""
    k = F.col("k")
    part = F.when(k < 50, 0).when(k < 70, 1).when(k < 85, 2).when(k < 99, 3).otherwise(4)
    loads = t.ev.groupBy(part.cast("long").alias("partition")).agg(F.count(F.lit(1)).alias("n"))
    return rounded(reports.hotspots(loads, "n", 2.0, 0.1))


@query("agg_distribution_health", "ev", """
WITH w AS (SELECT ('0x' || md5('user:' || user_id))::UHUGEINT % 100 AS p, count(*) AS n FROM ev GROUP BY 1),
f AS (SELECT CASE WHEN n > avg(n) OVER () * 1.5::DOUBLE THEN 'hot' WHEN n < avg(n) OVER () * 0.5::DOUBLE
  THEN 'cold' ELSE 'normal' END AS flag FROM w)
SELECT count(*) AS partitions, count(*) FILTER (flag = 'hot') AS hot, count(*) FILTER (flag = 'cold') AS cold,
  count(*) FILTER (flag = 'hot') = 0 AND count(*) FILTER (flag = 'cold') <= count(*) * 0.1 AS distribution_ok,
  CASE WHEN count(*) FILTER (flag = 'hot') / count(*) > 0.1 THEN 'unhealthy'
    WHEN count(*) FILTER (flag = 'hot') / count(*) > 0.05 THEN 'warning' ELSE 'healthy' END AS health FROM f""")
def _(t):
    part = md5_mod(F.concat(F.lit("user:"), F.col("user_id")), 100)
    loads = t.ev.groupBy(part.alias("partition")).agg(F.count(F.lit(1)).alias("n"))
    return reports.distribution_health(reports.hotspots(loads, "n", 1.5, 0.5))


def timeline(t):
    """Messages that arrive up to two days late."""
    sent = F.unix_seconds("ts") - (F.col("k") % 3) * 86400
    return t.ev.select("user_id", F.col("event_id").alias("seq"), sent.alias("sent_s"))


TIMELINE_SQL = f"SELECT user_id, event_id AS seq, {SEC} - (k % 3) * 86400 AS sent_s FROM ev"


@query("agg_order_violations", "ev", f"""
WITH m AS ({TIMELINE_SQL}),
a AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq) AS p,
    lag(sent_s) OVER (PARTITION BY user_id ORDER BY seq) AS before FROM m),
e AS (SELECT user_id, sent_s AS x, row_number() OVER (PARTITION BY user_id ORDER BY sent_s, seq) AS p FROM m)
SELECT user_id, count(*) AS message_count, count(*) FILTER (sent_s < before) AS late,
  count(*) FILTER (sent_s <> x) AS misplaced FROM a JOIN e USING (user_id, p) GROUP BY user_id""")
def _(t):
    return reports.order_violations(timeline(t))


@query("agg_user_timeline", "ev", f"""
SELECT user_id, count(*) AS n, string_agg(seq, ',' ORDER BY sent_s, seq) AS timeline FROM (SELECT *,
  row_number() OVER (PARTITION BY user_id ORDER BY sent_s DESC, seq DESC) AS rn FROM ({TIMELINE_SQL}))
WHERE rn <= 50 GROUP BY user_id""")
def _(t):
    out = reports.user_timeline(timeline(t))
    return out.select("user_id", F.size("timeline").cast("long").alias("n"), joined(
        F.transform("timeline", lambda m: m.seq.cast("string"))).alias("timeline"))


@query("agg_duplicates", "", """
SELECT count(*) AS total_posts, count(*) FILTER (n > 1) AS duplicates_found,
  round(count(*) FILTER (n > 1) / greatest(count(*), 1), 6) AS duplicate_rate,
  CAST(sum(n) AS BIGINT) AS deliveries
FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey)""")
def _(t):
    return rounded(reports.duplicate_stats(t.lineitem, "l_orderkey"))


def payments(t):
    status = lookup(F.col("o_orderstatus"), {"F": "completed", "P": "failed"}, "initiated")
    return t.orders.select(F.col("o_orderkey").alias("id"), status.alias("status"),
                           F.col("o_totalprice").alias("amount"),
                           F.col("o_orderdate").alias("created_at"))


@query("agg_payment_stats", "", """
SELECT count(*) AS total_payments, count(*) FILTER (o_orderstatus = 'F') AS successful_payments,
  count(*) FILTER (o_orderstatus = 'P') AS failed_payments,
  round_even(count(*) FILTER (o_orderstatus = 'F') * 100.0::DOUBLE / count(*), 2) AS success_rate,
  round(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 1) AS total_amount FROM orders""")
def _(t):
    return reports.payment_stats(payments(t)).withColumn(
        "total_amount", F.round("total_amount", 1))


@query("agg_recent_payments", "", """
SELECT o_orderkey AS id, o_totalprice AS amount FROM orders
ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10""")
def _(t):
    return reports.recent_payments(payments(t)).select("id", "amount")


# Errors, grants, notifications.

ACTION_SQL = f"""
SELECT event_id, CASE WHEN attempts = 0 THEN NULL
    WHEN error_class = 'JSONDecodeError' THEN
      CASE WHEN error_message IN ('bad Emoji', 'tags missing') THEN 'skip' ELSE 'dlq' END
    WHEN error_class IN ('KeyError', 'ValueError', 'UnicodeDecodeError')
      THEN CASE WHEN attempts < 3 THEN 'retry' ELSE 'dlq' END
    WHEN error_class IN ('ConnectionError', 'ConnectionResetError') THEN 'retry' WHEN error_class = 'MemoryError' THEN 'fatal'
    ELSE 'dlq' END AS action FROM ({FAILURES_SQL})"""


@query("agg_error_metrics", "ev", f"""
SELECT count(*) - count(action) AS processed, count(*) FILTER (action = 'skip') AS skip,
  count(*) FILTER (action = 'retry') AS retry, count(*) FILTER (action = 'dlq') AS dlq,
  count(*) FILTER (action = 'fatal') AS fatal,
  round((count(*) - count(action)) / count(*), 6) AS success_rate, round(count(action) / count(*), 6) AS error_rate
FROM ({ACTION_SQL})""")
def _(t):
    action = validate.error_action(F.col("error_class"), F.col("error_message"), F.col("attempts"))
    rows = failures(t).select(F.when(F.col("attempts") > 0, action).alias("action"))
    return rounded(reports.error_metrics(rows))


@query("agg_dlq_lifecycle", "ev", """
SELECT user_id || ':' || (k % 5) AS key, count(*) AS attempts, arg_max(event_type, event_id) AS error_type,
  count(*) >= 10 AS is_permanent,
  CASE WHEN count(*) < 10 THEN least(pow(2.0::DOUBLE, count(*)), 60.0::DOUBLE) END AS next_delay_s
FROM ev GROUP BY 1""")
def _(t):
    rows = t.ev.select(F.concat_ws(":", "user_id", F.col("k") % 5).alias("key"),
                       F.col("event_id").alias("seq"), F.col("event_type").alias("error_type"))
    return reports.dead_letter_lifecycle(rows)


@query("sink_dlq", "ev", f"""
SELECT 'posts' AS original_topic, user_id % 6 AS partition, event_id AS "offset",
  CAST(user_id AS VARCHAR) AS key, error_class AS error_type, error_message, attempts AS attempt_count,
  CAST(event_id AS VARCHAR) AS header_offset
FROM ({FAILURES_SQL}) WHERE attempts > 0""")
def _(t):
    rows = failures(t).select(
        (F.col("user_id") % 6).alias("partition"), F.col("event_id").alias("offset"),
        F.col("user_id").cast("string").alias("key"), F.lit("{}").alias("value"), "ts",
        F.col("error_class").alias("error_type"),
        F.when(F.col("attempts") > 0, F.col("error_message")).alias("error"),
        F.col("attempts").alias("attempt_count"))
    return validate.dead_letters(rows, "posts").select(
        "original_topic", "partition", "offset", "key", "error_type", "error_message",
        "attempt_count", F.element_at("headers", F.lit("errors.offset")).alias("header_offset"))


@query("agg_grant_summary", "", """
WITH g AS (SELECT 'u' || l_suppkey AS p, l_linestatus AS r, l_returnflag AS o FROM lineitem)
SELECT 'principal' AS kind, p AS name, count(*) AS n FROM g GROUP BY p
UNION ALL SELECT 'resource_type', r, count(*) FROM g GROUP BY r
UNION ALL SELECT 'operation', o, count(*) FROM g GROUP BY o
UNION ALL SELECT 'total', 'all', count(*) FROM g""")
def _(t):
    grants = t.lineitem.select(
        F.concat(F.lit("u"), F.col("l_suppkey")).alias("principal"),
        F.col("l_linestatus").alias("resource_type"), F.col("l_returnflag").alias("operation"))
    return reports.grant_summary(grants)


@query("agg_notifications", "ev", """
SELECT 'sent' AS part, event_type AS name, count(*) AS n FROM ev GROUP BY event_type
UNION ALL SELECT 'newest', CAST(user_id AS VARCHAR), event_id FROM (SELECT *,
  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM ev) WHERE rn <= 10""")
def _(t):
    notes = t.ev.select("user_id", "event_type", F.col("ts").alias("created_at"),
                        F.col("event_id").alias("seq"))
    sent = reports.sent_by_type(notes).select(
        F.lit("sent").alias("part"), F.col("event_type").alias("name"), F.col("sent").alias("n"))
    newest = reports.newest_notifications(notes).select(
        F.lit("newest").alias("part"), F.col("user_id").cast("string").alias("name"),
        F.col("seq").alias("n"))
    return sent.unionByName(newest)


@query("agg_split_by_type", "interactions", """
SELECT count(*) FILTER (v) AS processed, count(*) FILTER (NOT v) AS filtered,
  count(*) FILTER (v AND interaction_type = 'LIKE') AS "like",
  count(*) FILTER (v AND interaction_type = 'SHARE') AS share,
  count(*) FILTER (v AND interaction_type = 'COMMENT') AS comment,
  count(*) FILTER (v AND interaction_type = 'VIEW') AS view,
  round_even(avg(duration_s) FILTER (v), 2) AS avg_latency_ms
FROM (SELECT *, interaction_type <> 'UNKNOWN' AS v FROM interactions)""")
def _(t):
    valid = F.col("interaction_type") != "UNKNOWN"
    return reports.split_by_type(t.interactions, valid, ["LIKE", "SHARE", "COMMENT", "VIEW"],
                                 "duration_s")
