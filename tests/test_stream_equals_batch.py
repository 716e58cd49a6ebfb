"""Operators on a stream of several files give what they give on the whole table."""

import pytest
from pyspark.sql import functions as F

from murmur.operators import (
    engagement, joins, messages, moderation, scoring, tables, trending, validate, windows)
from murmur.plans.row_queries import feature_contents, feature_users
from murmur.plans.views import (
    TABLE_NAMES, Tables, changelog_from, event_rows, interactions_from, posts_from)
from murmur.schemas import TABLE_EVENT
from murmur.session import shared_dir
from murmur.sources.messages import file_stream
from murmur.streaming import runner, sinks


@pytest.fixture(scope="module")
def folder(spark, sf_dir):
    """All tables as folders of three files."""
    path = shared_dir(spark, "folders")
    for name in TABLE_NAMES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(3).write.parquet(
            f"{path}/{name}.parquet")
    return path


def as_rows(frame):
    columns = sorted(frame.columns)
    return sorted(str(tuple(r)) for r in frame.select(*columns).collect())


def moderated(ev, t):
    posts = posts_from(ev).withColumn("has_image", F.col("media_type") == "image")
    return moderation.moderate(posts.drop("hashtags"))


STATELESS = {
    "required": lambda ev, t: validate.with_required(
        interactions_from(ev), ["content_id", "interaction_type", "user_id"]),
    "moderation": moderated,
    "hashtags": lambda ev, t: messages.hashtag_occurrences(posts_from(ev)).drop("hashtags"),
    "mentions": lambda ev, t: messages.mention_and_tag_events(posts_from(ev)),
    "profiles": lambda ev, t: joins.enrich_actions(interactions_from(ev), t.profiles),
    "features": lambda ev, t: scoring.with_feature_lookup(
        interactions_from(ev).withColumnRenamed("duration_s", "duration_seconds"),
        scoring.user_features(feature_users(t.profiles)), scoring.content_features(feature_contents(t))),
    "processed": lambda ev, t: joins.not_processed(
        ev, t.likes.select(F.col("post_id").alias("event_id")).distinct(), "event_id"),
}


@pytest.mark.parametrize("name", sorted(STATELESS))
def test_stateless(name, spark, folder):
    t = Tables(spark, folder)
    stream = event_rows(file_stream(spark, f"{folder}/events.parquet", TABLE_EVENT, "*", 1))
    got = runner.finished(spark, STATELESS[name](stream, t), name)
    assert as_rows(got) == as_rows(STATELESS[name](t.ev, t))


AGGREGATES = {
    "reputation": lambda ev: engagement.reputation(interactions_from(ev)),
    "post_engagement": lambda ev: engagement.post_engagement(interactions_from(ev)),
    "user_activity": lambda ev: windows.user_activity(posts_from(ev)),
    "window_scores": lambda ev: windows.window_scores(
        interactions_from(ev).filter("interaction_type <> 'VIEW'"),
        scoring.window_weight(F.col("interaction_type")), 3600),
    "hashtag_users": lambda ev: trending.hashtag_user_counts(
        trending.hashtag_rows(posts_from(ev))),
    "latest": lambda ev: tables.latest(changelog_from(ev)),
}


@pytest.mark.parametrize("name", sorted(AGGREGATES))
def test_aggregates(name, spark, folder):
    stream = event_rows(file_stream(spark, f"{folder}/events.parquet", TABLE_EVENT, "*", 1))
    path = shared_dir(spark, name)
    # Complete mode hands over the whole result each time; the last one counts.
    runner.each_batch(AGGREGATES[name](stream),
                      lambda df, i: df.write.mode("overwrite").parquet(f"{path}/rows"),
                      f"{path}/checkpoint", "complete")
    assert as_rows(spark.read.parquet(f"{path}/rows")) == as_rows(
        AGGREGATES[name](Tables(spark, folder).ev))


def test_compacted_logs_join_end_to_end(spark, folder):
    log = Tables(spark, folder).changelog
    path = shared_dir(spark, "log")
    table = sinks.BatchTable(spark, path, log.schema,
                             lambda parts: tables.compact_versioned(parts.drop("batch")))
    width = -(-log.count() // 7)
    for i in range(7):
        table.write(tables.compacted_log(log.filter(
            F.floor(F.col("log_offset") / width) == i)), i)
    assert as_rows(table.current()) == as_rows(tables.compact_versioned(log))


@pytest.mark.parametrize("name", ["st_tumbling", "st_peek", "agg_hashtag_trends",
                                  "join_interval_left", "tbl_compact_stats"])
def test_queries_read_folders_too(name, spark, folder, sf_dir):
    from murmur.plans import QUERIES

    assert as_rows(QUERIES[name](spark, folder)) == as_rows(QUERIES[name](spark, sf_dir))
