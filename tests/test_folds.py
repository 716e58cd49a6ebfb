"""Closed forms against a plain fold over random histories."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from murmur.functions import scans
from murmur.operators import engagement, resolve, tables

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@FEW
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 4), st.booleans()),
                min_size=1, max_size=25))
def test_compaction(spark, history):
    log = [(i, k, None if dead else v, None if dead else f"p{i}")
           for i, (k, v, dead) in enumerate(history)]
    state, ignored = {}, 0
    for offset, key, version, payload in log:
        if payload is None:
            state.pop(key, None)
        elif key not in state or version >= state[key][0]:
            state[key] = (version, payload)
        else:
            ignored += 1
    frame = spark.createDataFrame(
        log, "log_offset long, log_key string, version long, payload string")
    got = {r.log_key: (r.version, r.payload) for r in tables.compact_versioned(frame).collect()}
    assert got == state
    stats = {r.measure: r.value for r in tables.compaction_stats(frame).collect()}
    assert stats["ignored_old_versions"] == ignored
    assert stats["active_keys"] == len(state)
    for size in (1, 3):  # what an epoch brings along from earlier chunks
        cut = tables.compaction_stats(frame, F.floor(F.col("log_offset") / size))
        assert {r.measure: r.value for r in cut.collect()} == stats


COPY = st.tuples(st.sampled_from("ab"), st.one_of(st.none(), st.integers(0, 5)),
                 st.integers(0, 9))


def as_copies(spark, history):
    data = [(k, i, ts, float(score)) for i, (k, ts, score) in enumerate(history)]
    frame = spark.createDataFrame(data, "content_id string, seq long, s long, engagement_score double")
    return data, frame.select("content_id", "seq", F.timestamp_seconds("s").alias("updated_at"),
                              F.lit(None).cast("timestamp").alias("created_at"), "engagement_score")


@FEW
@given(st.lists(COPY, min_size=1, max_size=20))
def test_last_write_wins(spark, history):
    data, frame = as_copies(spark, history)
    state = {}
    for key, seq, ts, _ in data:
        if key not in state or (ts is not None and state[key][1] is not None and ts > state[key][1]):
            state[key] = (seq, ts)
    got = {r.content_id: r.seq for r in resolve.last_write_wins(frame, "content_id").collect()}
    assert got == {k: v[0] for k, v in state.items()}


@FEW
@given(st.lists(COPY, min_size=1, max_size=20))
def test_merge_contents(spark, history):
    data, frame = as_copies(spark, history)
    state = {}
    for key, seq, ts, score in data:
        if key not in state:
            state[key] = (seq, ts, score)
        elif ts is not None and state[key][1] is not None and ts > state[key][1]:
            state[key] = (seq, ts, max(score, state[key][2]))
    for size in (3, 1_000_000):
        out = resolve.merge_contents(frame, chunk=scans.by_offset("seq", size))
        got = {r.content_id: (r.seq, r.engagement_score) for r in out.collect()}
        assert got == {k: (v[0], v[2]) for k, v in state.items()}


@FEW
@given(st.lists(st.tuples(st.integers(0, 1), st.sampled_from(["LIKE", "SHARE", "COMMENT", "VIEW"]),
                          st.integers(0, 50)), min_size=1, max_size=20))
def test_decayed_engagement(spark, history):
    import math

    now, data, state = 1_700_000_000, [], {}
    for i, (user, kind, gap) in enumerate(history):
        now += gap * 3600
        data.append((i, user, kind, now))
        s = state.setdefault(user, {"n": 0.0, "ts": now})
        s["n"] += {"LIKE": 1.0, "COMMENT": 2.0, "SHARE": 3.0}.get(kind, 0.0)
        s["score"] = s["n"] * math.exp(-((now - s["ts"]) / 3600) / 24)
        s["ts"] = now
    frame = spark.createDataFrame(
        data, "event_id long, user_id long, interaction_type string, s long").withColumn(
        "ts", F.timestamp_seconds("s"))
    for r in engagement.decayed_engagement(frame).collect():
        assert abs(r.score - state[r.user_id]["score"]) < 0.006


@FEW
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from("ab")), st.integers(0, 9)),
                min_size=1, max_size=25), st.integers(1, 4))
def test_scans_do_not_depend_on_the_chunks(spark, values, size):
    data = [(k, i, v) for i, (k, v) in enumerate(values)]
    frame = spark.createDataFrame(data, "k string, i long, v long")
    chunk = scans.by_offset("i", size)
    ran = scans.scan(frame, ["k"], ["i"], chunk, sums={"total": F.col("v")},
                     maxima={"top": F.col("v")}, previous={"p": "v"}, totals={"all": "total"})
    got = {r.i: (r.total, r.top) for r in ran.collect()}
    prior = {r.i: r.p for r in ran.collect()}
    for r in ran.collect():
        assert r["all"] == sum(v for k, _, v in data if k == r.k)
    for k, i, _ in data:
        seen = [v for kk, ii, v in data if kk == k and ii <= i]
        assert got[i] == (sum(seen), max(seen))
        assert prior[i] == (seen[-2] if len(seen) > 1 else None)
