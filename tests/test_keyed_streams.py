"""Processors with their own state: batches cut anyhow, failures, and the batch forms."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from murmur import session
from murmur.operators import reports, resolve
from murmur.plans.keyed_queries import record_copies
from murmur.plans.views import Tables
from murmur.streaming import keyed, runner

START = dt.datetime(2024, 1, 1)


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


class Feed:
    """A folder that gets parts, and a stream over it that goes on from its checkpoint."""

    def __init__(self, spark, schema, operator):
        self.spark, self.schema, self.operator = spark, schema, operator
        self.folder = session.shared_dir(spark, "feed")

    def add(self, frame):
        frame.select(*self.schema.names).coalesce(1).write.mode("append").parquet(f"{self.folder}/in")
        return self

    def run(self, handle=None):
        rows = self.spark.readStream.schema(self.schema).parquet(f"{self.folder}/in")
        out = self.operator(rows)
        self.out = out.schema

        def write(batch, batch_id):
            if handle:
                handle(batch_id)
            batch.write.mode("overwrite").parquet(f"{self.folder}/out/batch={batch_id:05d}")

        runner.each_batch(out, write, f"{self.folder}/checkpoint", "append")
        return self

    def rows(self):
        found = self.spark.read.schema(self.out).parquet(f"{self.folder}/out")
        return sorted((tuple(r) for r in found.select(*self.out.names).collect()), key=str)


@pytest.fixture(scope="module")
def copies(spark, sf_dir):
    return record_copies(Tables(spark, sf_dir).ev).where("record_id < 40").cache()


@pytest.fixture(scope="module")
def whole(spark, copies):
    return Feed(spark, copies.schema, keyed.resolved).add(copies).run().rows()


def test_records_do_not_depend_on_the_batches(spark, copies, whole):
    feed = Feed(spark, copies.schema, keyed.resolved)
    for part in ("seq < 300", "seq >= 300 AND seq < 301", "seq >= 301"):
        feed.add(copies.where(part)).run()
    assert feed.rows() == whole and len(whole) == copies.count()


def test_a_failed_batch_is_repeated(spark, copies, whole):
    def fail(batch_id):
        if batch_id == 1:
            raise RuntimeError("lost")

    feed = Feed(spark, copies.schema, keyed.resolved).add(copies.where("seq < 400")).run()
    feed.add(copies.where("seq >= 400"))
    with pytest.raises(Exception, match="lost"):
        feed.run(fail)
    assert feed.run().rows() == whole


def test_records_go_on_from_a_batch_fold(spark, copies, whole):
    """The batch folds of the first half are the state that the stream starts with."""
    past = copies.where("seq < 500")
    profiles = resolve.merge_profiles(past.where("record_type = 'user_profile'").withColumn(
        "interests", F.coalesce("interests", F.array().cast("array<string>"))), "record_id")
    contents = resolve.merge_contents(past.where("record_type = 'content_metadata'"), "record_id")
    names = ["record_type", "record_id", *keyed.RECORD.names, "interests"]
    # The batch fold of profiles has no seq; it plays no part in the rule.
    known = profiles.withColumn("record_type", F.lit("user_profile")).withColumn(
        "seq", F.lit(0).cast("long")).select(*names).unionByName(contents.select(*names))
    later = copies.where("seq >= 500 AND record_type IN ('user_profile', 'content_metadata')")
    feed = Feed(spark, copies.schema, lambda rows: keyed.resolved(rows, known)).add(later).run()
    expected = [r for r in whole if r[2] >= 500 and r[0] in ("user_profile", "content_metadata")]
    # merge_profiles keeps the greatest time, the fold the last one where one is missing.
    drop = [i for i, c in enumerate(feed.out.names) if c == "updated_at"]
    cut = [[tuple(x for i, x in enumerate(r) if i not in drop or r[0] != "user_profile")
            for r in rows] for rows in (feed.rows(), expected)]
    assert cut[0] == cut[1] and cut[0]


def test_last_records_equal_the_batch_folds(copies, whole):
    last = {}
    for r in sorted(whole, key=lambda r: r[2]):
        last[r[0], r[1]] = r
    names = ["record_type", "record_id", "arrival", *keyed.RECORD.names, "interests"]
    contents = resolve.merge_contents(copies.where("record_type = 'content_metadata'"), "record_id")
    for r in contents.collect():
        got = dict(zip(names, last["content_metadata", r.record_id]))
        assert (got["seq"], got["engagement_score"]) == (r.seq, r.engagement_score)
    profiles = resolve.merge_profiles(copies.where("record_type = 'user_profile'"), "record_id")
    for r in profiles.collect():
        got = dict(zip(names, last["user_profile", r.record_id]))
        assert (got["username"], got["follower_count"], got["engagement_rate"], got["bio"]) == (
            r.username, r.follower_count, r.engagement_rate, r.bio)
        assert got["interests"] == r.interests


REQUESTS = [("a", 1, 0, 10.0), ("a", 2, 60, 11.0), ("b", 3, 61, 12.0), ("a", 4, 1439, 13.0),
            ("a", 5, 1440, 14.0), ("a", 6, 1500, 15.0), ("b", 7, 3000, 16.0), ("a", 8, 2880, 17.0)]


@pytest.mark.parametrize("cuts", [(9,), (2, 5, 9), (1, 2, 3, 4, 5, 6, 7, 9)])
def test_first_results_are_forgotten_after_a_day(spark, cuts):
    frame = spark.createDataFrame([(k, i, at(m), v) for k, i, m, v in REQUESTS],
                                  "key string, request_id long, ts timestamp, result double")
    feed = Feed(spark, frame.schema, lambda rows: keyed.first_results(rows, delay="1 day"))
    low = 0
    for high in cuts:
        feed.add(frame.where(f"request_id >= {low} AND request_id < {high}")).run()
        low = high
    got = {r[1]: (r[3], r[4]) for r in feed.rows()}
    assert got == {1: (10.0, False), 2: (10.0, True), 3: (12.0, False), 4: (10.0, True),
                   5: (14.0, False), 6: (14.0, True), 7: (16.0, False), 8: (17.0, False)}


def test_retries_equal_the_batch_report(spark, sf_dir):
    ev = Tables(spark, sf_dir).ev
    failures = ev.select(F.concat_ws(":", "user_id", F.col("k") % 5).alias("key"),
                         F.col("event_id").alias("seq"), "ts", F.col("event_type").alias("error_type"))
    operator = lambda rows: keyed.retries(rows, memory_s=86400 * 1000)
    feed = Feed(spark, failures.schema, operator)
    for part in ("seq < 250", "seq >= 250 AND seq < 700", "seq >= 700"):
        feed.add(failures.where(part)).run()
    assert feed.rows() == Feed(spark, failures.schema, operator).add(failures).run().rows()
    last = {}
    for key, attempts, _, error, action in feed.rows():
        last[key] = max(last.get(key, (0,)), (attempts, error, action == "permanent"))
    limit = failures.agg(F.max("ts") - F.expr("INTERVAL 12 MINUTES")).first()[0]
    done = failures.groupBy("key").agg(F.max("ts").alias("ts"), F.count("*").alias("n")).where(
        (F.col("ts") < F.lit(limit)) & (F.col("n") <= 10))
    report = reports.dead_letter_lifecycle(failures).join(done.select("key"), "key").collect()
    assert report
    assert {r.key: (r.attempts, r.error_type, r.is_permanent) for r in report} == {
        r.key: last[r.key] for r in report}


def test_retries_by_hand(spark):
    s = dt.timedelta(seconds=1)
    times = [0, 1, 10, 10 + 7.999, 3000, 3000 + 86400]  # the second comes before its time is due
    rows = [("x", i, START + t * s, f"e{i}") for i, t in enumerate(times)] + [
        ("y", 99, START + 2 * 86400 * s, "late")]
    frame = spark.createDataFrame(rows, "key string, seq long, ts timestamp, error_type string")
    got = Feed(spark, frame.schema, keyed.retries).add(frame).run().rows()
    ms = int(START.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert [(r[1], r[2] - ms, r[3]) for r in got if r[0] == "x"] == sorted([
        (2, 1000 + 4000, "e1"), (4, 17_999 + 16_000, "e3"), (5, 3_000_000 + 32_000, "e4"),
        (1, 89_400_000 + 2000, "e5")], key=str)


def test_slots_do_not_depend_on_the_batches(spark):
    rows = [(at(i * 0.11), f"t{i * i % 7}") for i in range(900)]
    frame = spark.createDataFrame(rows, "ts timestamp, tag string")

    def operator(rows):
        return keyed.published(rows, 30, 600, 60, 3, shares=4)

    one = Feed(spark, frame.schema, operator).add(frame).run()
    many = Feed(spark, frame.schema, operator)
    for low in (0, 20, 50, 80):
        high = {0: 20, 20: 50, 50: 80, 80: 1000}[low]
        many.add(frame.where((F.col("ts") >= F.lit(at(low))) & (F.col("ts") < F.lit(at(high))))).run()
    assert one.rows() == many.rows() and one.rows()
    parts = spark.createDataFrame(one.rows(), one.out)
    ranking = keyed.slot_ranking(parts, 3).collect()
    s0 = int(START.replace(tzinfo=dt.timezone.utc).timestamp())
    for slot in {r.slot for r in ranking}:
        counts = {}
        for ts, tag in rows:
            s = s0 + int((ts - START).total_seconds())
            if s < slot and s // 600 * 600 + 660 > slot:
                counts[tag, s // 600 * 600] = counts.get((tag, s // 600 * 600), 0) + 1
        best = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:3]
        assert [((r.tag, r.window_start), r.n) for r in sorted(
            (r for r in ranking if r.slot == slot), key=lambda r: r.rank)] == best
    with pytest.raises(ValueError):
        keyed.published(frame, 45, 600, 60, 3)


def fake_session(master, folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder or default),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"))


def test_scratch_folder_with_an_empty_configuration():
    first, second = (session.shared_dir(fake_session("local[2]"), "x") for _ in range(2))
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]
    assert session.shared_dir(fake_session("yarn", "hdfs://n/c/"), "x").startswith("hdfs://n/c/x-")
    for master in ("yarn", "local-cluster[3,2,1000]"):
        with pytest.raises(ValueError):
            session.shared_dir(fake_session(master), "x")
