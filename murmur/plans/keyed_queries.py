"""Streaming queries whose operators keep their own state per key."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur.plans.registry import query
from murmur.plans.row_queries import joined, rounded
from murmur.plans.stream_queries import LIMIT_SQL, SEC, TAGS_SQL, events, staged, tags_of
from murmur.plans.views import interactions_from, posts_from, reactions_from
from murmur.session import shared_dir
from murmur.streaming import keyed, relay, runner, sinks, state, windows

TYPES = ("user_profile", "content_metadata", "versioned", "comment")


def record_copies(ev):
    """Copies of records of four types; times go back and forth, and some are missing."""
    k = F.col("k")
    shifted = F.timestamp_seconds(F.unix_seconds("ts") - (k % 7) * 86400)
    words = F.array(F.concat(F.lit("t"), k % 3), F.col("event_type"))
    return ev.select(
        F.element_at(F.array(*map(F.lit, TYPES)), (k % 4 + 1).cast("int")).alias("record_type"),
        F.col("user_id").alias("record_id"), F.col("event_id").alias("seq"),
        F.concat(F.lit("name"), k % 9).alias("username"), k.alias("follower_count"),
        (k * 7 % 50).alias("following_count"), (F.col("value") / 1000).alias("engagement_rate"),
        F.when(k % 3 != 0, F.concat("event_type", k % 5)).alias("bio"),
        F.col("event_type").alias("category"), F.col("value").alias("engagement_score"),
        F.col("event_type").alias("source"), k.alias("sequence"),
        F.when(k % 10 != 0, shifted).alias("updated_at"),
        F.when(k % 20 != 0, F.timestamp_seconds(F.unix_seconds("ts") - 86400 * 9)).alias("created_at"),
        F.when(k % 5 != 0, words).alias("interests"))


COPIES_SQL = f"""
SELECT ['user_profile', 'content_metadata', 'versioned', 'comment'][k % 4 + 1] AS record_type,
  user_id AS record_id, event_id AS seq, 'name' || (k % 9) AS username, k,
  CASE WHEN k % 3 <> 0 THEN event_type || (k % 5) END AS bio, event_type AS category, value AS score,
  CASE WHEN k % 10 <> 0 THEN {SEC} - (k % 7) * 86400 END AS updated_s,
  CASE WHEN k % 20 <> 0 THEN {SEC} - 86400 * 9 END AS created_s,
  CASE WHEN k % 5 <> 0 THEN ['t' || (k % 3), event_type] ELSE [] END AS words FROM ev"""

NEWER_SQL = """CASE record_type
  WHEN 'content_metadata' THEN y.updated_s > x.updated_s
  WHEN 'versioned' THEN CASE WHEN x.category = y.category THEN y.k > x.k ELSE y.updated_s > x.updated_s END
  ELSE coalesce(y.updated_s, y.created_s) > coalesce(x.updated_s, x.created_s) END"""


@query("res_stream_rules", "ev", f"""
WITH c AS ({COPIES_SQL}),
folded AS (
  SELECT record_type, record_id, seq AS arrival, list_reduce(copies, lambda x, y: CASE
      WHEN {NEWER_SQL} THEN CASE WHEN record_type = 'content_metadata'
        THEN struct_update(y, score := greatest(x.score, y.score)) ELSE y END ELSE x END) AS w
  FROM (SELECT record_type, record_id, seq, list({{'seq': seq, 'username': username, 'k': k, 'bio': bio,
      'category': category, 'score': score, 'updated_s': updated_s, 'created_s': created_s}})
      OVER (PARTITION BY record_type, record_id ORDER BY seq) AS copies
    FROM c WHERE record_type <> 'user_profile'))
SELECT record_type, record_id, arrival, w.seq AS seq, w.username AS username, w.k AS follower_count,
  w.bio AS bio, w.category AS category, round(w.score, 6) AS engagement_score,
  CAST(NULL AS VARCHAR) AS interests FROM folded
UNION ALL
SELECT record_type, record_id, seq, seq, username, max(k) OVER p, last_value(bio IGNORE NULLS) OVER p,
  category, round(score, 6), array_to_string(list_sort(list_distinct(flatten(list(words) OVER p))), ',')
FROM c WHERE record_type = 'user_profile' WINDOW p AS (PARTITION BY record_id ORDER BY seq)""")
def _(t):
    """Every copy of a record, resolved by the rule of its type on a stream."""
    out = runner.finished(t.spark, keyed.resolved(record_copies(events(t))), "records")
    out = out.withColumn("interests", F.when(F.col("interests").isNotNull(), joined("interests")))
    return rounded(out.select("record_type", "record_id", "arrival", "seq", "username",
                              "follower_count", "bio", "category", "engagement_score", "interests"), 6)


@query("dedup_idempotent_stream", "ev", """
WITH r AS (SELECT user_id || ':' || (k % 5) AS key, event_id AS request_id, ts, value,
    epoch_us(ts) AS us FROM ev WHERE event_type = 'purchase'),
f AS (
  SELECT key, request_id, value, list_reduce(list({'us': us, 'id': request_id, 'value': value})
      OVER (PARTITION BY key ORDER BY ts, request_id),
    lambda x, y: CASE WHEN y.us - x.us < 86400000000 THEN x ELSE y END) AS first FROM r)
SELECT key, request_id, first.value AS first_result, first.id <> request_id AS is_repeat FROM f""")
def _(t):
    """A repeated request within a day gets the result of the first one."""
    ev = events(t).filter(F.col("event_type") == "purchase")
    requests = ev.select(
        F.concat_ws(":", "user_id", F.col("k") % 5).alias("key"),
        F.col("event_id").alias("request_id"), "ts", F.col("value").alias("result"))
    out = runner.finished(t.spark, keyed.first_results(requests), "first-results")
    return out.select("key", "request_id", "first_result", "is_repeat")


@query("agg_dlq_retries", "ev", f"""
WITH r AS (SELECT user_id || ':' || (k % 5) AS key, event_id, epoch_us(ts) // 1000 AS ms, event_type FROM ev),
g AS (SELECT *, coalesce(ms - lag(ms) OVER w >= 86400000, true) AS starts FROM r
  WINDOW w AS (PARTITION BY key ORDER BY ms, event_id)),
s AS (SELECT *, sum(starts::INT) OVER (PARTITION BY key ORDER BY ms, event_id) AS run FROM g),
n AS (SELECT *, row_number() OVER (PARTITION BY key, run ORDER BY ms, event_id) AS attempts,
    lead(ms) OVER (PARTITION BY key ORDER BY ms, event_id) AS next FROM s),
d AS (SELECT *, ms + CAST(1000 * least(pow(2.0::DOUBLE, attempts), 60) AS BIGINT) AS due FROM n)
SELECT key, attempts, due AS at_ms, event_type AS error_type, 'retry' AS action FROM d
WHERE attempts < 10 AND due <= coalesce(next, {LIMIT_SQL} - 600000)
UNION ALL SELECT key, attempts, ms, event_type, 'permanent' FROM d WHERE attempts = 10""")
def _(t):
    """Attempts that fall due on a stream of failures, and records given up."""
    failures = events(t).select(
        F.concat_ws(":", "user_id", F.col("k") % 5).alias("key"), F.col("event_id").alias("seq"),
        "ts", F.col("event_type").alias("error_type"))
    return runner.finished(t.spark, keyed.retries(failures), "retries")



SLOT, SIZE, GRACE = 3600, 6 * 3600, 3600


@query("st_suppress_slots", "posts", f"""
WITH x AS (SELECT tag, {SEC} AS s FROM ({TAGS_SQL})),
c AS (SELECT tag, s // {SIZE} * {SIZE} AS window_start, s // {SLOT} * {SLOT} + {SLOT} AS slot, count(*) AS n
  FROM x GROUP BY ALL),
e AS (SELECT tag, window_start, unnest(generate_series(min(slot), window_start + {SIZE + GRACE} - 1, {SLOT})) AS slot
  FROM c GROUP BY tag, window_start),
r AS (SELECT e.slot, e.tag, e.window_start, CAST(sum(n) AS BIGINT) AS n
  FROM e JOIN c ON e.tag = c.tag AND e.window_start = c.window_start AND c.slot <= e.slot GROUP BY ALL)
SELECT *, row_number() OVER (PARTITION BY slot ORDER BY n DESC, tag, window_start) AS rank FROM r
WHERE slot * 1000 <= {LIMIT_SQL} - 300000 QUALIFY rank <= 10""")
def _(t):
    """The ten largest open windows at the end of every slot, once per slot however many events."""
    parts = keyed.published(tags_of(posts_from(events(t))), SLOT, SIZE, GRACE, 10)
    return keyed.slot_ranking(runner.finished(t.spark, parts, "published"), 10)


@query("join_interval_left_stream", "posts likes comments", f"""
SELECT post_id, any_value(user_id) AS user_id, any_value(content) AS content, window_start,
  count(like_id) AS total_likes, count(comment_id) AS total_comments,
  count(like_id) + count(comment_id) * 3 AS engagement_score
FROM (SELECT p.post_id, p.user_id, p.content, {SEC.replace('ts', 'p.ts')} // 3600 * 3600 AS window_start,
    l.like_id, c.comment_id
  FROM posts p
  LEFT JOIN likes l ON p.post_id = l.post_id
    AND l.ts BETWEEN p.ts - INTERVAL 1 HOUR AND p.ts + INTERVAL 1 HOUR
  LEFT JOIN comments c ON p.post_id = c.post_id
    AND c.ts BETWEEN p.ts - INTERVAL 1 HOUR AND p.ts + INTERVAL 1 HOUR)
WHERE (window_start + 3600) * 1000000 <= (SELECT least((SELECT max(epoch_us(ts)) FROM posts),
  (SELECT max(epoch_us(ts)) FROM likes), (SELECT max(epoch_us(ts)) FROM comments))) - 7800000000
GROUP BY post_id, window_start HAVING count(like_id) + count(comment_id) * 3 > 3""")
def _(t):
    """The batch query's windows as soon as they are closed: ten minutes of delay and two reaches
    behind the slowest of the three streams."""
    out = windows.interval_left_counts(
        posts_from(events(t)), reactions_from(events(t), "click", "like_id", 7),
        reactions_from(events(t), "signup", "comment_id", 5), "1 HOUR", "1 hour", "10 minutes", 3)
    return runner.finished(t.spark, out, "interval-left")


def kept_counts(t):
    """Events by user in the state of a finished stream, and its checkpoint."""
    target = shared_dir(t.spark, "state")
    counts = events(t).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    runner.each_batch(counts, lambda batch, batch_id: batch.write.format("noop").mode(
        "overwrite").save(), f"{target}/checkpoint")
    return state.rows(t.spark, f"{target}/checkpoint"), f"{target}/checkpoint"


def shown(rows, *more):
    return rows.select("key.user_id", F.col("value.count").alias("n"), *more)


@query("st_state_key", "ev", """
SELECT user_id, count(*) AS n FROM ev WHERE user_id = (SELECT min(user_id) FROM ev) GROUP BY user_id""")
def _(t):
    """The state of one key, read from its partition."""
    rows, checkpoint = kept_counts(t)
    user = t.ev.agg(F.min("user_id")).first()[0]
    return shown(state.at_key(rows, checkpoint, user_id=user))


@query("st_state_top", "ev", """
SELECT user_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, user_id) AS rank
FROM ev GROUP BY user_id QUALIFY rank <= 10""")
def _(t):
    """The ten largest counts in the state."""
    rows, _ = kept_counts(t)
    order = [F.desc("value.count"), F.asc("key.user_id")]
    return shown(state.largest(rows, order, 10), "rank")


@query("st_state_range", "ev", """
SELECT user_id, count(*) AS n FROM ev WHERE user_id BETWEEN 10 AND 60 GROUP BY user_id""")
def _(t):
    """The state of a range of keys."""
    rows, _ = kept_counts(t)
    return shown(state.between(rows, "key.user_id", 10, 60))


@query("st_late_dropped", "ev", """
WITH m AS (SELECT max(epoch_us(ts)) // 1000 - 600000 AS w FROM ev WHERE event_type <> 'error'),
k AS (SELECT count(*) AS kept FROM ev, m WHERE event_type <> 'error'
  OR (epoch_us(ts) // 1000000 // 3600 * 3600 + 3600) * 1000 > w)
SELECT count(*) AS received, any_value(kept) AS kept, count(*) - any_value(kept) AS dropped FROM ev, k""")
def _(t):
    """How many rows came too late: those received less those that the windows hold."""
    late = F.col("event_type") == "error"
    target = shared_dir(t.spark, "late")
    tables = []

    def run(folder):
        seen = events(t, folder).observe("arrived", F.count(F.lit(1)).alias("rows"))
        out = windows.tumbling(seen, "event_type", "1 hour", "10 minutes")
        tables.append(sinks.BatchTable(t.spark, f"{target}/rows", out.schema,
                                       sinks.newest_by(["event_type", "window_start"])))
        with counts:
            runner.each_batch(out, tables[-1].write, f"{target}/checkpoint")

    counts = state.BatchCounts(t.spark, "arrived")
    staged(t, t.events.filter(~late), t.events.filter(late), after=run)
    received = F.lit(counts.total("rows")).cast("long")
    kept = F.coalesce(F.sum("n"), F.lit(0))
    return tables[-1].current().agg(received.alias("received"), kept.alias("kept"),
                                    (received - kept).alias("dropped"))


@query("sink_outbox_relay_stream", "ev likes", f"""
SELECT event_id, event_type, {SEC} AS created_s FROM ev WHERE event_id NOT IN (SELECT post_id FROM likes)""")
def _(t):
    """Every row of the outbox that was not published before, relayed by a stream."""
    rows = events(t).select("event_id", "event_type", F.col("ts").alias("created_at"))
    published = t.likes.select(F.col("post_id").alias("event_id")).distinct()
    target = shared_dir(t.spark, "outbox")
    handler = relay.OutboxRelay(t.spark, f"{target}/rows", rows.schema, published)
    runner.each_batch(rows, handler, f"{target}/checkpoint", "append")
    return handler.relayed().select("event_id", "event_type",
                                    F.unix_seconds("created_at").alias("created_s"))


@query("sink_upsert_metrics_stream", "interactions", """
SELECT user_id, lower(interaction_type) AS metric_type, round(sum(duration_s), 4) AS metric_value,
  max(event_id) AS last_offset FROM interactions GROUP BY ALL""")
def _(t):
    rows = interactions_from(events(t)).select(
        "user_id", F.lower("interaction_type").alias("metric_type"),
        F.col("duration_s").alias("value"), F.col("event_id").alias("offset"))
    target = shared_dir(t.spark, "metrics")
    handler = relay.MetricsUpsert(t.spark, f"{target}/rows")
    runner.each_batch(rows, handler, f"{target}/checkpoint", "append")
    return rounded(handler.current(), 4)
