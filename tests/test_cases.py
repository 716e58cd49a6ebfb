"""Hand-made cases with exact expectations."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from murmur.functions.columns import md5_mod
from murmur.functions.ranking import index_percentiles
from murmur.operators import (
    engagement, health, joins, logs, messages, moderation, reports, resolve, scoring, tables,
    validate, windows)
from murmur.operators.schema_evolution import compatibility

T0 = datetime(2024, 1, 1, 12, 0, 0)


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def test_compaction_log(spark):
    log = spark.createDataFrame(
        [(1, "a", 5, "x"), (2, "a", 3, "y"), (3, "a", 5, "z"), (4, "b", 1, "p"),
         (5, "b", None, None), (6, "b", 0, "q")],
        "log_offset long, log_key string, version long, payload string")
    assert rows(tables.compact_versioned(log), "log_key", "payload") == [("a", "z"), ("b", "q")]
    stats = {r.measure: r.value for r in tables.compaction_stats(log).collect()}
    assert stats["ignored_old_versions"] == 1
    assert (stats["updates"], stats["tombstones"], stats["active_keys"]) == (5, 1, 2)


def test_tombstone_deletes_the_latest_value(spark):
    log = spark.createDataFrame(
        [(1, "a", 1, "x"), (2, "a", 1, None), (3, "b", 1, "y")],
        "log_offset long, log_key string, version long, payload string")
    assert rows(tables.latest(log), "log_key", "payload") == [("b", "y")]


def test_last_write_wins_keeps_the_first_on_a_tie(spark):
    copies = spark.createDataFrame(
        [("k", 1, T0, None, "first"), ("k", 2, T0, None, "second")],
        "id string, seq long, updated_at timestamp, created_at timestamp, v string")
    assert rows(resolve.last_write_wins(copies, "id"), "v") == [("first",)]


def test_merge_content_counts_accepted_scores_only(spark):
    times = [1, 3, 2, 4]
    scores = [9.0, 1.0, 50.0, 2.0]
    copies = spark.createDataFrame(
        [("k", i, T0 + timedelta(hours=h), s) for i, (h, s) in enumerate(zip(times, scores))],
        "content_id string, seq long, updated_at timestamp, engagement_score double")
    assert rows(resolve.merge_contents(copies), "seq", "engagement_score") == [(3, 9.0)]


def interval_fixture(spark):
    posts = spark.createDataFrame([(1, 7, "post", T0)],
                                  "post_id long, user_id long, content string, ts timestamp")
    likes = spark.createDataFrame(
        [(i, 1, i, T0 + timedelta(minutes=m)) for i, m in enumerate((-59, 60, 61))],
        "like_id long, post_id long, user_id long, ts timestamp")
    comments = spark.createDataFrame(
        [(i, 1, i, T0 + timedelta(minutes=m)) for i, m in enumerate((1, 2, 3))],
        "comment_id long, post_id long, user_id long, ts timestamp")
    return posts, likes, comments


def test_interval_join_multiplies_and_is_two_sided(spark):
    out = joins.interval_counts(*interval_fixture(spark), min_score=0)
    assert rows(out, "total_likes", "total_comments", "engagement_score") == [(6, 6, 24)]


def test_true_counts_do_not_multiply(spark):
    posts, likes, comments = interval_fixture(spark)
    out = joins.viral_posts(posts, likes, comments)
    assert rows(out, "likes", "comments", "score") == [(3, 3, 12)]
    unknown = joins.viral_posts(posts.filter("post_id = 0"), likes, comments)
    assert rows(unknown, "user_id", "content") == [(0, "Post content unavailable")]


def test_index_percentiles(spark):
    small = spark.range(1, 5).select(F.lit("a").alias("g"), F.col("id").cast("double").alias("v"))
    large = spark.range(1, 101).select(F.lit("b").alias("g"), F.col("id").cast("double").alias("v"))
    out = index_percentiles(small.union(large), ["g"], "v", {"p50": 0.5, "p99": 0.99})
    assert rows(out, "g", "p50", "p99") == [("a", 3.0, 4.0), ("b", 51.0, 100.0)]


def test_percentiles_do_not_depend_on_the_chunks(spark):
    from murmur.functions.ranking import value_chunks

    values = {"a": [1000.0 ** (i / 500) for i in range(2000)], "b": [-1.5] * 40 + [2.5] * 3,
              None: [float(i % 700) for i in range(1500)]}
    df = spark.createDataFrame([(g, v) for g, vs in values.items() for v in [*vs, None]],
                               "g string, v double")
    points = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}
    expected = sorted(
        [(g, *(sorted(vs)[min(int(len(vs) * p), len(vs) - 1)] for p in points.values()))
         for g, vs in values.items()], key=str)
    for chunk in (1, 5, 1_000_000):
        found = index_percentiles(df, ["g"], "v", points, chunk).select("g", *points)
        assert sorted((tuple(r) for r in found.collect()), key=str) == expected
    counts = df.where("v IS NOT NULL").groupBy("g", "v").count()
    sizes = value_chunks(counts, ["g"], "v", 2).groupBy("g", "__chunk").count()
    most = sizes.agg(F.max("count")).first()[0]
    assert most <= 64  # as many chunks as the values need, however unevenly they lie
    falls = value_chunks(counts, ["g"], "v", 2).groupBy("g", "__chunk").agg(
        F.min("v").alias("low"), F.max("v").alias("high")).orderBy("g", "__chunk").collect()
    assert all(x.high < y.low for x, y in zip(falls, falls[1:]) if x.g == y.g)


def test_bucket_percentiles(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 6, 7, 999)], "v double")
    out = logs.bucket_percentiles(df, "v", [5, 10, 50], {"p50": 0.5, "p99": 0.99})
    assert rows(out, "p50", "p99") == [(5.0, 10.0)]


def test_decay_uses_the_gap_to_the_previous_event(spark):
    df = spark.createDataFrame(
        [(0, 1, "LIKE", T0), (1, 1, "SHARE", T0 + timedelta(hours=24))],
        "event_id long, user_id long, interaction_type string, ts timestamp")
    assert rows(engagement.decayed_engagement(df), "score") == [(1.47,)]


@pytest.mark.parametrize("counts, expected", [
    ([5, 4, 3, 1], (13, -5, "down")), ([7], (7, 0, "down")), ([1, 2, 3], (6, 4, "up"))])
def test_velocity(spark, counts, expected):
    df = spark.createDataFrame([("t", i * 300, n) for i, n in enumerate(counts)],
                               "tag string, window_start long, n long")
    assert rows(windows.velocity(df, "tag"), "total_count", "velocity", "trend") == [expected]


def test_fetch_aligns_down_and_fetch_all_does_not(spark):
    df = spark.createDataFrame([("t", 0, 1), ("t", 300, 2), ("t", 600, 3)],
                               "tag string, window_start long, n long")
    assert rows(windows.fetch(df, "tag", "t", 301, 600, 300), "n") == [(2,), (3,)]
    assert rows(windows.fetch_all(df, 301, 600), "n") == [(3,)]


def test_hashtag_rules(spark):
    df = spark.createDataFrame([("#AI #a #Été",)], "content string")
    assert rows(messages.hashtag_occurrences(df, 2), "tag") == [("ai",), ("été",)]
    assert rows(messages.hashtag_occurrences(df), "tag") == [("a",), ("ai",), ("été",)]


def test_md5_modulo(spark):
    df = spark.createDataFrame([("user_1",)], "s string")
    assert rows(df.select(md5_mod(F.col("s"), 1000).alias("p")), "p") == [(753,)]


def test_window_scores_expire(spark):
    df = spark.createDataFrame(
        [("c", "SHARE", 1000), ("c", "COMMENT", 1020), ("c", "VIEW", 1030), ("c", "like", 1040)],
        "content_id string, interaction_type string, s long").withColumn(
        "ts", F.timestamp_seconds("s"))
    per_window = windows.window_scores(df, scoring.window_weight(F.col("interaction_type")), 60)
    assert rows(windows.score_at(per_window, 1060, 60), "score") == [(16.1,)]
    assert rows(windows.score_at(per_window, 1360, 60), "score") == []


def test_hopping_windows_per_event(spark):
    df = spark.createDataFrame([("t", 1, 5.0, T0)],
                               "tag string, user_id long, engagement_score double, ts timestamp")
    out = windows.hopping_tags(df)
    assert out.count() == 6
    assert {r.mention_count for r in out.collect()} == {1}


@pytest.mark.parametrize("score, name", [
    (50, "bronze"), (250, "silver"), (1000, "gold"), (3000, "platinum")])
def test_tiers(spark, score, name):
    df = spark.createDataFrame([(score,)], "score long")
    assert rows(df.select(engagement.tier(F.col("score")).alias("t")), "t") == [(name,)]


def test_features(spark):
    users = spark.createDataFrame(
        [(1, 5000, 100, 730, 0.2, ["a", "b"]), (2, 0, 9, 10, None, None)],
        "user_id long, follower_count long, following_count long, account_age_days long,"
        "engagement_rate double, interests array<string>")
    got = {r.user_id: r for r in scoring.user_features(users).collect()}
    assert (got[1].follower_count_normalized, got[1].account_maturity) == (0.5, 1.0)
    assert (got[1].interest_count, got[2].interest_count, got[2].following_ratio) == (2, 0, 0.0)
    inter = spark.createDataFrame([(1, "like", 60)],
                                  "id long, interaction_type string, duration_seconds long")
    row = scoring.interaction_features(inter).collect()[0]
    assert (row.interaction_type_encoded, row.duration_normalized) == (2, 0.2)


def test_recency(spark):
    ages = spark.createDataFrame([(-1.0,), (1.0,), (12.5,), (24.0,)], "h double")
    got = [r[0] for r in ages.select(scoring.recency_factor(F.col("h"))).collect()]
    assert got[0] == got[1] == 1.0 and got[3] == 0.3
    assert got[2] == pytest.approx(math.sqrt(0.3))


def test_spam_tiers(spark):
    df = spark.createDataFrame(
        [(1, "Buy Now!", None), (2, "\U0001F600" * 11, None), (3, "hello", 10), (4, "hello", None),
         (5, "x" * 8000, None), (6, "buy nowhere", None), (7, "no coſt", None), (8, None, None)],
        "post_id long, content string, rep int")
    out = moderation.with_spam_reason(df, F.col("rep"))
    assert [r[1] for r in rows(out, "post_id", "spam_reason")] == [
        "keyword_match", "emoji_spam", "behavior_anomaly", "clean", "ml_detected", "clean",
        "keyword_match", "clean"]


def test_policy(spark):
    df = spark.createDataFrame(
        [(1, "so ILLEGAL"), (2, "alcohol, gambling"), (3, "SHOCKING"), (4, "fine")],
        "post_id long, content string")
    got = {r.post_id: (r.action, r.violations)
           for r in moderation.with_policy(df).select("post_id", "policy.*").collect()}
    assert got[1] == ("REMOVE", ["prohibited_content"])
    assert got[2] == ("RESTRICT", ["mature_content", "mature_content"])
    assert got[3] == ("DEPRIORITIZE", ["low_quality"]) and got[4] == ("ALLOW", [])


def test_platforms(spark):
    ios = spark.createDataFrame([("u", "p", "LIKE", 5)],
                                "user string, postId string, action string, ts long")
    android = spark.createDataFrame(
        [("u", "p", "Comment", "1970-01-01T00:00:05Z"), (None, "p", "x", "1970-01-01T00:00:05Z")],
        "userId string, post_id string, event_type string, timestamp string")
    web = spark.createDataFrame([("u", "p", "share", 5000)],
                                "user_id string, target string, reaction_kind string, occurred_at long")
    out = messages.normalize_platforms({"ios": ios, "android": android, "web": web})
    assert rows(out, "source", "action", "timestamp") == [
        ("android", "comment", 5000), ("ios", "like", 5000), ("web", "share", 5000)]


def test_row_validation_names_the_first_error(spark):
    df = spark.createDataFrame(
        [("00000000-0000-0000-0000-000000000000", "2024-01-01T00:00:00Z", "like", "user_1", "p",
          None, None, "love", None, "web"),
         ("x", "2024-01-01T00:00:00Z", "like", "user_1", "p", None, None, "love", None, "web"),
         ("00000000-0000-0000-0000-000000000000", "2024-01-01T00:00:00Z", "like", "user_1", "p",
          "a", "b", None, None, "web")],
        "event_id string, timestamp string, interaction_type string, actor_id string,"
        "target_id string, content string, comment_text string, reaction_type string,"
        "media_urls array<string>, client_type string")
    out = validate.validate_rows(df, validate.INTERACTION_RULES, validate.INTERACTION_PAYLOADS)
    assert sorted((r.is_valid, r.error or "") for r in out.collect()) == [
        (False, "format"), (False, "one_of"), (True, "")]


def test_match_scores_equal_the_plain_comparison(spark):
    as_of = datetime(2024, 1, 10)
    prefs = spark.createDataFrame(
        [("u1", ["en"], ["tech"], ["a", "b"], {}), ("u2", ["fr", "en"], ["news"], ["c"], {}),
         ("u3", ["de"], ["tech"], [], {"category": 2.0}),
         ("u4", ["en"], ["art"], ["a"], {"topics": 0.5})],
        "user_id string, languages array<string>, categories array<string>,"
        "topics array<string>, weights map<string,double>")
    contents = spark.createDataFrame(
        [(f"c{i}", lang, cat, tags, as_of - timedelta(hours=h)) for i, (lang, cat, tags, h) in
         enumerate([("en", "tech", ["a"], 1), ("en", "news", ["c"], 100), ("fr", "art", ["a", "b"], 500),
                    ("de", "tech", [], 30), ("en", "art", ["a"], 2), ("es", "tech", ["b"], 1)])],
        "content_id string, language string, category string, tags array<string>,"
        "created_at timestamp")
    expected = []
    for p in prefs.collect():
        for c in contents.collect():
            w = {k: p.weights.get(k, 1.0) for k in ("language", "category", "topics")}
            score = (0.3 * w["language"] * (c.language in p.languages)
                     + 0.4 * w["category"] * (c.category in p.categories))
            common = set(p.topics) & set(c.tags)
            if common:
                score += 0.2 * len(common) / len(p.topics) * w["topics"]
            age = (as_of - c.created_at).total_seconds() / 3600
            score = round(score + (0.1 if age < 24 else 0.05 if age < 168 else 0.0), 3)
            if score >= 0.5:
                expected.append((p.user_id, c.content_id, score))
    out = joins.match_scores(prefs, contents, F.lit(as_of))
    assert rows(out, "user_id", "content_id", "match_score") == sorted(expected)


def test_compatibility(spark):
    fields = spark.createDataFrame(
        [("s", 1, "id", "long", False), ("s", 1, "name", "string", False),
         ("s", 2, "id", "long", False), ("s", 2, "name", "string", False),
         ("s", 2, "bio", "string", True),
         ("s", 3, "id", "long", False), ("s", 3, "bio", "string", True),
         ("s", 4, "id", "long", False), ("s", 4, "bio", "string", True),
         ("s", 4, "age", "int", False)],
        "subject string, version long, field string, type string, has_default boolean")
    assert rows(compatibility(fields), "version", "backward", "forward", "full") == [
        (1, True, True, True), (2, True, True, True), (3, False, True, False),
        (4, False, False, False)]


def test_sla(spark):
    config = spark.createDataFrame([("g", 1000, 5000.0, 100.0)],
                                   "group_id string, max_lag long, min_throughput double, max_latency double")
    groups = spark.createDataFrame(
        [("g", 500, 6000.0, 50.0)], "group_id string, lag long, throughput double, latency double")
    bad = spark.createDataFrame(
        [("g", 5000, 2000.0, 200.0)], "group_id string, lag long, throughput double, latency double")
    assert rows(health.sla_health(groups, config), "status") == [("warning",)]
    assert rows(health.sla_health(bad, config), "status") == [("critical",)]
    other = groups.withColumn("group_id", F.lit("x"))
    assert rows(health.sla_health(other, config), "status", "health_score") == [("unknown", 0.0)]


def test_counter_rates_cross_chunks(spark):
    df = spark.createDataFrame(
        [(1, 1, T0, 99.0), (1, 2, T0, 10.0), (1, 3, T0 + timedelta(hours=3), 10.0 + 3 * 3600),
         (1, 4, T0 + timedelta(hours=4), 0.0)],
        "broker long, event_id long, ts timestamp, c double")
    assert rows(health.counter_rates(df, ["broker"], ["c"]), "c_rate") == [(0.0,), (1.0,)]


def test_order_violations(spark):
    df = spark.createDataFrame([(1, 1, 100), (1, 2, 90), (1, 3, 110)],
                               "user_id long, seq long, sent_s long")
    assert rows(reports.order_violations(df), "late", "misplaced") == [(1, 2)]


def test_prometheus_lines(spark):
    df = spark.createDataFrame([("# HELP a",), ("a 1.5",), ("b x",), ("c",), ("d 2 170",)],
                               "value string")
    assert rows(health.parse_samples(df), "metric", "value") == [("a", 1.5), ("d", 2.0)]


def test_error_classes(spark):
    df = spark.createDataFrame(
        [(1, "JSONDecodeError", "bad emoji", 0), (2, "ValueError", "x", 2), (3, "ValueError", "x", 3),
         (4, "MemoryError", "x", 0), (5, "Odd", "x", 0)], "id long, c string, m string, n int")
    out = df.select("id", validate.error_action(F.col("c"), F.col("m"), F.col("n")).alias("a"))
    assert [r[1] for r in rows(out, "id", "a")] == ["skip", "retry", "dlq", "fatal", "dlq"]


def test_version_vectors_are_pairwise(spark):
    df = spark.createDataFrame([("a", 5, 1, "a", 4, 9), ("a", 5, 1, "b", 4, 9)],
                               "s string, n long, t long, other_s string, other_n long, other_t long")
    assert rows(df.select(resolve.is_newer("s", "n", "t").alias("x")), "x") == [(False,), (True,)]


def test_cdc(spark):
    schema = ("log_offset long, row_key long, op string, before struct<id:long,name:string>,"
              "after struct<id:long,name:string>")
    log = spark.createDataFrame(
        [(1, 1, "c", None, (1, "a")), (2, 1, "u", (1, "a"), (1, "b")), (3, 2, "r", None, (2, "z")),
         (4, 2, "d", (2, "z"), None), (5, 2, None, None, None), (6, 3, "u", None, (3, "q"))], schema)
    assert rows(tables.cdc_state(log, "id"), "id", "name") == [(1, "b"), (3, "q")]
    diff = tables.cdc_diff(log).collect()
    assert [(d.log_offset, [(c.column, c.old, c.new) for c in d.changes]) for d in diff] == [
        (2, [("name", "a", "b")])]


def test_upsert_adds_counts_and_replaces_the_rest(spark):
    schema = ("hashtag string, seq int, count long, last_updated long, window_start long,"
              "window_end long, trend_score double")
    stored = spark.createDataFrame([("a", -1, 5, 10, 1, 10, 5.0)], schema)
    batch = spark.createDataFrame([("a", 0, 2, 20, 11, 20, 2.0), ("b", 0, 1, 20, 11, 20, 1.0)], schema)
    assert rows(tables.merge_counts(stored, batch), "hashtag", "count", "window_start",
                "last_updated", "trend_score") == [("a", 7, 1, 20, 2.0), ("b", 1, 11, 20, 1.0)]


def test_records_are_resolved_by_their_type(spark):
    df = spark.createDataFrame(
        [(1, T0, T0, 3, ["a"]), (1, T0, T0 + timedelta(hours=1), 1, ["b"])],
        "user_id long, created_at timestamp, updated_at timestamp, seq long, "
        "interests array<string>")
    assert resolve.RESOLVERS.keys() == {"user_profile", "content_metadata"}
    newest = resolve.resolve("interaction", df, "user_id")
    assert [r.interests for r in newest.collect()] == [["b"]]
