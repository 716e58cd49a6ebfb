"""Streaming queries: each runs a stream over a whole table to its end.

Files of the table are the input; a cluster would subscribe to topics instead. Results
are written below the shared folder and returned as a table.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur.operators import messages as maps
from murmur.operators import moderation, tables, trending
from murmur.operators import windows as batch_windows
from murmur.plans.registry import query
from murmur.plans.row_queries import ACTION_SQL, CLEAN_SPAM_SQL, rounded
from murmur.plans.table_queries import COMPACT_SQL, COPIES_SQL, copies
from murmur.plans.trending_queries import TRENDS_SQL
from murmur.plans.views import (
    Tables, changelog_from, event_rows, interactions_from, posts_from)
from murmur.schemas import TABLE_EVENT
from murmur.session import shared_dir
from murmur.sources.messages import file_stream
from murmur.streaming import hops, runner, sinks, windows
from murmur.streaming.resolve import LastWriteWins

SEC = "epoch_us(ts) // 1000000"

#: Batches after which a kept table is folded into one snapshot.
FOLD_EVERY = 20


def table_path(t: Tables, name: str) -> str:
    """A pattern that matches the table alone, be it a file or a folder of files.

    A stream takes a folder or a pattern, but not the path of a single file.
    """
    return f"{t.folder}/{name}.parque[t]"


def events(t: Tables, folder: str | None = None):
    return event_rows(file_stream(t.spark, folder or table_path(t, "events"), TABLE_EVENT))


def tags_of(posts):
    return maps.hashtag_occurrences(posts, 2)


def staged(t: Tables, *parts, after=lambda folder: None) -> str:
    """Event rows written part by part; ``after`` runs when a part has arrived."""
    folder = shared_dir(t.spark, "staged")
    for part in parts:
        part.write.mode("append").parquet(folder)
        after(folder)
    return folder


LIMIT_SQL = "(SELECT epoch_us(max(ts)) // 1000 FROM ev)"  # last event in ms


@query("st_tumbling", "ev", f"""
SELECT event_type, {SEC} // 3600 * 3600 AS window_start, count(*) AS n FROM ev
WHERE ({SEC} // 3600 * 3600 + 3600) * 1000 <= {LIMIT_SQL} - 600000 GROUP BY 1, 2""")
def _(t):
    out = windows.tumbling(events(t), "event_type", "1 hour", "10 minutes")
    return runner.finished(t.spark, out, "tumbling")


TAGS_SQL = rf"""
SELECT * FROM (SELECT user_id, engagement_score, ts,
  unnest(regexp_extract_all(lower(content), '#([\p{{L}}\p{{N}}_]+)', 1)) AS tag FROM posts)
WHERE length(tag) >= 2"""
HOPS_SQL = f"""
SELECT tag, s AS window_start, count(*) AS mention_count, count(DISTINCT user_id) AS unique_users,
  round(sum(engagement_score), 4) AS total_engagement
FROM (SELECT *, unnest(generate_series({SEC} // 300 * 300 - 1500, {SEC} // 300 * 300, 300)) AS s
  FROM ({TAGS_SQL})) GROUP BY tag, s"""


@query("st_hopping", "posts", HOPS_SQL)
def _(t):
    """All windows, open ones included: panes in update mode into a table, and the windows
    are filled from them when it is read."""
    panes = windows.user_panes(tags_of(posts_from(events(t))), "5 minutes", "5 minutes")
    out = shared_dir(t.spark, "hopping")
    table = sinks.BatchTable(t.spark, f"{out}/rows", panes.schema,
                             sinks.newest_by(["tag", "pane", "user_id"]), FOLD_EVERY)
    runner.each_batch(panes, table.write, f"{out}/checkpoint")
    return rounded(batch_windows.windows_of_panes(table.current()), 4)


@query("st_grace", "posts", f"""
SELECT * FROM ({HOPS_SQL}) WHERE (window_start + 1800) * 1000 <= {LIMIT_SQL} - 300000""")
def _(t):
    """Only windows whose grace period is over; late rows change none of them."""
    closed = hops.closed_hops(tags_of(posts_from(events(t))), shared_dir(t.spark, "grace"),
                              1800, 300, 300, FOLD_EVERY)
    return rounded(closed, 4)


@query("st_retention", "posts", f"""
SELECT tag, {SEC} // 300 * 300 AS window_start, count(*) AS n FROM ({TAGS_SQL})
GROUP BY 1, 2 HAVING ({SEC.replace('ts', 'min(ts)')} // 300 * 300 + 300) * 1000 <= {LIMIT_SQL} - 3600000""")
def _(t):
    """Windows leave the state one hour after their end."""
    out = windows.tumbling(tags_of(posts_from(events(t))), "tag", "5 minutes", "1 hour")
    return runner.finished(t.spark, out, "retention")


@query("st_late", "ev", f"""
WITH m AS (SELECT max(epoch_us(ts)) // 1000 - 600000 AS w FROM ev WHERE event_type <> 'error')
SELECT event_type, {SEC} // 3600 * 3600 AS window_start, count(*) AS n FROM ev, m
WHERE event_type <> 'error' OR ({SEC} // 3600 * 3600 + 3600) * 1000 > w GROUP BY 1, 2""")
def _(t):
    """Errors arrive after all other events: those of closed windows are dropped."""
    late = F.col("event_type") == "error"
    target = shared_dir(t.spark, "late")
    kept = []

    def run(folder):
        out = windows.tumbling(events(t, folder), "event_type", "1 hour",
                               "10 minutes")
        table = sinks.BatchTable(t.spark, f"{target}/rows", out.schema,
                                 sinks.newest_by(["event_type", "window_start"]))
        runner.each_batch(out, table.write, f"{target}/checkpoint")
        kept.append(table)

    staged(t, t.events.filter(~late), t.events.filter(late), after=run)
    return kept[-1].current()


TAG_HOURS_SQL = f"""
SELECT tag, {SEC} // 3600 * 3600 AS window_start, count(*) AS n FROM ({TAGS_SQL}) GROUP BY 1, 2"""
END_S = 1706659200


def tag_hours(t):
    counts = windows.tumbling(tags_of(posts_from(events(t))), "tag", "1 hour", "5 minutes")
    target = shared_dir(t.spark, "tag-hours")
    table = sinks.BatchTable(t.spark, f"{target}/rows", counts.schema,
                             sinks.newest_by(["tag", "window_start"]), FOLD_EVERY)
    runner.each_batch(counts, table.write, f"{target}/checkpoint")
    return table, target


@query("st_emit_open", "posts", f"""
SELECT *, row_number() OVER (ORDER BY n DESC, tag, window_start) AS rank FROM ({TAG_HOURS_SQL})
WHERE window_start + 3600 + 86400 > {END_S} QUALIFY rank <= 100""")
def _(t):
    """An emission ranks all windows that have not expired, closed or not."""
    table, _ = tag_hours(t)
    return windows.open_ranking(table.current(), END_S, 3600, 86400, 100)


@query("st_suppress", "posts", f"""
SELECT *, row_number() OVER (ORDER BY n DESC, tag, window_start) AS rank FROM ({TAG_HOURS_SQL})
WHERE window_start + 3600 + 300 > {END_S} - 600000 QUALIFY rank <= 10""")
def _(t):
    """The ranking is published once per trigger, not per event; the last one counts."""
    counts = windows.tumbling(tags_of(posts_from(events(t))), "tag", "1 hour", "5 minutes")
    target = shared_dir(t.spark, "suppress")
    table = sinks.BatchTable(t.spark, f"{target}/rows", counts.schema,
                             sinks.newest_by(["tag", "window_start"]), FOLD_EVERY)

    def publish(batch, batch_id):
        table.write(batch, batch_id)
        top = windows.open_ranking(table.current(), END_S - 600000, 3600, 300, 10)
        top.write.mode("overwrite").parquet(f"{target}/top")

    runner.each_batch(counts, publish, f"{target}/checkpoint")
    return t.spark.read.parquet(f"{target}/top")


@query("st_sliding_log", "posts", f"""
WITH x AS (SELECT tag, {SEC} AS s FROM ({TAGS_SQL})),
m AS (SELECT tag, max(s) AS newest FROM x GROUP BY tag)
SELECT tag, count(*) AS n FROM x JOIN m USING (tag) WHERE s >= newest - 86400 GROUP BY tag""")
def _(t):
    log = windows.per_second(tags_of(posts_from(events(t))), "1 hour")
    target = shared_dir(t.spark, "sliding")
    table = sinks.BatchTable(t.spark, f"{target}/rows", log.schema,
                             sinks.newest_by(["tag", "second"]), FOLD_EVERY)
    runner.each_batch(log, table.write, f"{target}/checkpoint")
    return windows.log_totals(table.current(), 86400)


@query("agg_sliding_counts", "posts", f"""
WITH x AS (SELECT tag, {SEC} AS s FROM ({TAGS_SQL})),
m AS (SELECT tag, max(s) AS newest FROM x GROUP BY tag)
SELECT tag, count(*) AS n FROM x JOIN m USING (tag) WHERE s >= newest - 86400 GROUP BY tag""")
def _(t):
    return windows.sliding_counts(tags_of(t.posts), 86400)


def like_stream(t):
    ev = events(t).filter(F.col("event_type") == "click")
    return ev.select(F.col("event_id").alias("like_id"),
                     (F.col("event_id") - 1 - F.col("k") % 7).alias("post_id"), "ts")


@query("st_interval_join", "posts likes", """
SELECT p.post_id, l.like_id FROM posts p JOIN likes l ON p.post_id = l.post_id
  AND l.ts BETWEEN p.ts - INTERVAL 1 HOUR AND p.ts + INTERVAL 1 HOUR""")
def _(t):
    posts = posts_from(events(t)).select("post_id", "ts")
    pairs = windows.interval_join(posts, like_stream(t), "1 HOUR", "10 minutes")
    return runner.finished(t.spark, pairs, "interval").select("post_id", "like_id")


@query("st_table_lookup", "interactions profiles", """
SELECT event_id, user_id, interaction_type, age, city, tier FROM interactions JOIN profiles USING (user_id)""")
def _(t):
    """Every micro-batch joins the version of the table that it finds."""
    stream = interactions_from(events(t)).select("event_id", "user_id", "interaction_type")
    target = shared_dir(t.spark, "lookup")

    def join(batch, batch_id):
        found = batch.join(t.profiles.select("user_id", "age", "city", "tier"), "user_id")
        found.write.mode("overwrite").parquet(f"{target}/rows/batch={batch_id:09d}")

    runner.each_batch(stream, join, f"{target}/checkpoint", "append")
    return t.spark.read.parquet(f"{target}/rows").drop("batch")


def hashtag_partials(batch):
    tags = trending.hashtag_rows(batch)
    return tags.groupBy("hashtag").agg(
        F.count(F.lit(1)).alias("count"), F.max(F.unix_seconds("ts")).alias("last_updated"),
        F.min(F.unix_seconds("ts")).alias("window_start"),
        F.max(F.unix_seconds("ts")).alias("window_end"),
        F.count(F.lit(1)).cast("double").alias("trend_score"))


HASHTAG_TABLE = T.StructType([
    T.StructField("hashtag", T.StringType()), T.StructField("count", T.LongType()),
    T.StructField("last_updated", T.LongType()), T.StructField("window_start", T.LongType()),
    T.StructField("window_end", T.LongType()), T.StructField("trend_score", T.DoubleType())])


@query("st_exactly_once", "posts", f"""
SELECT hashtag, count(*) AS count, min({SEC}) AS window_start, max({SEC}) AS last_updated
FROM (SELECT ts, unnest(hashtags) AS hashtag FROM posts) GROUP BY hashtag""")
def _(t):
    """Every batch is delivered twice, as after a failure; counts must not double."""
    target = shared_dir(t.spark, "once")
    table = sinks.BatchTable(t.spark, f"{target}/rows", HASHTAG_TABLE, sinks.added_counts)

    def deliver(batch, batch_id):
        for _ in range(2):
            table.write(hashtag_partials(batch), batch_id)

    runner.each_batch(posts_from(events(t)), deliver, f"{target}/checkpoint", "append")
    return table.current().select("hashtag", "count", "window_start", "last_updated")


@query("st_recover", "ev", "SELECT user_id, count(*) AS n FROM ev GROUP BY user_id")
def _(t):
    """Stop after half of the input and restart from the checkpoint."""
    half = F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00"))
    target = shared_dir(t.spark, "recover")
    schema = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("n", T.LongType())])
    table = sinks.BatchTable(t.spark, f"{target}/rows", schema, sinks.newest_by(["user_id"]),
                             FOLD_EVERY)

    def run(folder):
        counts = events(t, folder).groupBy("user_id").agg(
            F.count(F.lit(1)).alias("n"))
        runner.each_batch(counts, table.write, f"{target}/checkpoint")

    staged(t, t.events.filter(half), t.events.filter(~half), after=run)
    return table.current()


@query("st_changelog", "changelog", COMPACT_SQL)
def _(t):
    """A compacted table kept by a stream that is stopped and restarted."""
    target = shared_dir(t.spark, "changelog")
    half = F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00"))
    kept = []

    def run(folder):
        log = changelog_from(events(t, folder))
        table = sinks.BatchTable(t.spark, f"{target}/rows", log.schema,
                                 lambda parts: tables.compact_versioned(parts.drop("batch")))
        runner.each_batch(log, lambda batch, batch_id: table.write(
            tables.compacted_log(batch), batch_id), f"{target}/checkpoint", "append")
        kept.append(table)

    staged(t, t.events.filter(half), t.events.filter(~half), after=run)
    return kept[-1].current().select("log_key", "log_offset", "version", "payload")


@query("st_hashtag_trends", "posts", TRENDS_SQL)
def _(t):
    """The trends as a table that a stream keeps: users are counted when it is read."""
    by_user = trending.hashtag_user_counts(trending.hashtag_rows(posts_from(events(t))))
    target = shared_dir(t.spark, "trends")
    table = sinks.BatchTable(t.spark, f"{target}/rows", by_user.schema,
                             sinks.newest_by(["hashtag", "user_id"]), FOLD_EVERY)
    runner.each_batch(by_user, table.write, f"{target}/checkpoint")
    return trending.hashtag_totals(table.current()).select(
        "hashtag", "mention_count", "unique_users", F.unix_seconds("latest_ts").alias("latest_s"))


@query("st_state_query", "ev", "SELECT user_id, count(*) AS n FROM ev GROUP BY user_id")
def _(t):
    """Read the state of a finished run by key, without a sink table."""
    target = shared_dir(t.spark, "state")
    counts = events(t).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    runner.each_batch(counts, lambda batch, batch_id: batch.write.format("noop").mode(
        "overwrite").save(), f"{target}/checkpoint")
    state = t.spark.read.format("statestore").load(f"{target}/checkpoint")
    return state.select("key.user_id", F.col("value.count").alias("n"))


@query("st_peek", "text_posts", f"""
SELECT count(*) AS received, count(*) FILTER (spam = 'clean') AS after_spam,
  count(*) FILTER (spam = 'clean' AND action <> 'REMOVE') AS enriched
FROM (SELECT {ACTION_SQL} AS action, {CLEAN_SPAM_SQL} AS spam FROM text_posts)""")
def _(t):
    """Counts taken beside the flow by observed metrics."""
    from murmur.plans.views import TAILS, lookup

    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType())])
    docs = file_stream(t.spark, table_path(t, "documents"), schema)
    posts = docs.select(F.concat("text", lookup(F.col("source"), TAILS, "")).alias("content"))
    judged = moderation.judged(posts)
    clean = F.col("spam_reason") == "clean"
    kept = clean & (F.col("policy.action") != "REMOVE")
    target = shared_dir(t.spark, "peek")
    totals = runner.counted(
        judged, {"received": F.lit(True), "after_spam": clean, "enriched": kept},
        lambda rows: rows.filter(kept).select("content"), target)
    return totals.current()


@query("sink_keyed", "interactions profiles", """
SELECT CAST(event_id AS VARCHAR) AS key, user_id, interaction_type, city
FROM interactions JOIN profiles USING (user_id)""")
def _(t):
    stream = interactions_from(events(t)).join(t.profiles, "user_id")
    rows = stream.select(F.col("event_id").cast("string").alias("key"), "user_id",
                         "interaction_type", "city")
    return runner.finished(t.spark, rows, "keyed")


@query("res_stream", "ev", f"""
WITH c AS (SELECT content_id, seq, updated_s FROM ({COPIES_SQL}) WHERE updated_s IS NOT NULL),
b AS (SELECT *, max(updated_s::HUGEINT * 1000000000 + (999999999 - seq))
    OVER (PARTITION BY content_id ORDER BY seq) AS m FROM c)
SELECT content_id, seq, CAST(999999999 - m % 1000000000 AS BIGINT) AS winner_seq FROM b""")
def _(t):
    from types import SimpleNamespace

    def run(folder):
        source = copies(SimpleNamespace(ev=events(t, folder)))
        rows = source.filter(F.col("updated_at").isNotNull()).select(
            "content_id", "seq", F.unix_micros("updated_at").alias("updated_us"))
        runner.each_batch(rows, handler, f"{target}/checkpoint", "append")

    target = shared_dir(t.spark, "resolve")
    handler = LastWriteWins(t.spark, target)
    half = F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00"))
    staged(t, t.events.filter(half), t.events.filter(~half), after=run)
    return handler.emitted.current().drop("batch")


@query("st_dedup", "ev", "SELECT user_id, count(*) AS n FROM ev GROUP BY user_id")
def _(t):
    """Every event is delivered twice; the second delivery has no effect."""
    folder = staged(t, t.events.unionByName(t.events))
    once = windows.once_per_id(events(t, folder), "event_id", "24 hours")
    rows = runner.finished(t.spark, once.select("user_id", "event_id"), "dedup")
    return rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
