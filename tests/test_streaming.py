"""Streams against batch results, restarts, repeated batches and late rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from murmur.operators import messages
from murmur.plans.views import Tables, event_rows, posts_from
from murmur.schemas import LIKE, TABLE_EVENT
from murmur.session import shared_dir
from murmur.sources.files import file_metadata
from murmur.sources.messages import decode, file_stream, good_and_bad
from murmur.streaming import runner, sinks, windows

T0 = datetime(2024, 1, 1)


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


@pytest.fixture(scope="module")
def split_events(spark, sf_dir):
    """The events in four files that follow each other in time."""
    folder = shared_dir(spark, "split")
    raw = Tables(spark, sf_dir).events
    for part in range(4):
        raw.filter(F.floor(F.col("event_id") / 250) == part).coalesce(1).write.mode(
            "append").parquet(folder)
    rest = raw.filter(F.col("event_id") >= 1000)
    rest.coalesce(1).write.mode("append").parquet(folder)
    return folder


def stream(spark, folder):
    return event_rows(file_stream(spark, folder, TABLE_EVENT, "*.parquet", 1))


def test_many_batches_equal_one_table(spark, sf_dir, split_events):
    tags = messages.hashtag_occurrences(posts_from(stream(spark, split_events)), 2)
    panes = windows.user_panes(tags, "5 minutes", "5 minutes")
    target = shared_dir(spark, "hops")
    table = sinks.BatchTable(spark, f"{target}/rows", panes.schema,
                             sinks.newest_by(["tag", "pane", "user_id"]))
    runner.each_batch(panes, table.write, f"{target}/checkpoint")
    from murmur.operators.windows import hopping_tags, windows_of_panes

    batch = hopping_tags(messages.hashtag_occurrences(Tables(spark, sf_dir).posts, 2))
    columns = ("tag", "window_start", "mention_count", "unique_users")
    assert rows(windows_of_panes(table.current()), *columns) == rows(batch, *columns)


def test_sliding_log_over_batches(spark, sf_dir, split_events):
    tags = messages.hashtag_occurrences(posts_from(stream(spark, split_events)), 2)
    log = windows.per_second(tags, "1 hour")
    target = shared_dir(spark, "log")
    table = sinks.BatchTable(spark, f"{target}/rows", log.schema,
                             sinks.newest_by(["tag", "second"]), 2)
    runner.each_batch(log, table.write, f"{target}/checkpoint")
    got = windows.log_totals(table.current(), 7200)
    batch = windows.sliding_counts(
        messages.hashtag_occurrences(Tables(spark, sf_dir).posts, 2), 7200)
    assert rows(got, "tag", "n") == rows(batch, "tag", "n")


def test_a_table_of_many_batches_stays_small(spark):
    schema = spark.createDataFrame([], "k string, n long").schema
    path = shared_dir(spark, "fold")
    table = sinks.BatchTable(spark, path, schema, sinks.summed(["k"], ["n"]), fold_every=10)
    assert rows(table.current(), "k", "n") == []
    total = 0
    for batch in range(50):
        again = 2 if batch in (8, 9, 25) else 1  # a repeated batch counts once
        for _ in range(again):
            table.write(spark.createDataFrame([("a", batch), ("b", 1)], schema).coalesce(1), batch)
        total += batch
        assert len(table._numbers("batch")) <= 10 and len(table._numbers("snapshot")) <= 1
        if batch in (3, 9, 10, 27, 49):
            assert rows(table.current(), "k", "n") == [("a", total), ("b", batch + 1)]
    # A batch that a snapshot covers, delivered again after a restart, changes nothing.
    other = sinks.BatchTable(spark, path, schema, sinks.summed(["k"], ["n"]), fold_every=10)
    other.write(spark.createDataFrame([("a", 41)], schema), 41)
    assert rows(other.current(), "k", "n") == [("a", total), ("b", 50)]


def test_a_half_written_snapshot_does_not_count(spark):
    schema = spark.createDataFrame([], "k string, n long").schema
    path = shared_dir(spark, "half")
    table = sinks.BatchTable(spark, path, schema, sinks.summed(["k"], ["n"]))
    for batch in range(3):
        table.write(spark.createDataFrame([("a", 1)], schema), batch)
    spark.createDataFrame([("a", 99)], schema).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{path}/snapshot=000000001")
    assert table.folded() is None
    assert rows(table.current(), "k", "n") == [("a", 3)]


def test_counts_of_more_than_a_hundred_batches(spark):
    folder = shared_dir(spark, "peek")
    n = 110
    spark.range(n * 10).repartition(n).write.parquet(f"{folder}/in")
    rows_in = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(
        f"{folder}/in")
    table = runner.counted(rows_in, {"all": F.lit(True), "even": F.col("id") % 2 == 0},
                           lambda r: r.filter("id % 2 = 0"), folder)
    assert rows(table.current(), "all", "even") == [(n * 10, n * 5)]
    assert spark.read.parquet(f"{folder}/rows").count() == n * 5


def test_left_interval_join_keeps_unmatched_posts(spark):
    folder = shared_dir(spark, "interval")

    def put(name, data, schema):
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}").schema

    # The last rows move the watermark past everything before them.
    far = T0 + timedelta(days=3)
    p = put("posts", [(1, T0), (2, T0), (99, far)], "post_id long, ts timestamp")
    r = put("likes", [(1, 1, T0 + timedelta(minutes=30)), (2, 2, T0 + timedelta(hours=2)), (99, 98, far)],
            "like_id long, post_id long, ts timestamp")
    posts = file_stream(spark, f"{folder}/posts", p)
    likes = file_stream(spark, f"{folder}/likes", r)
    out = windows.interval_join(posts, likes, "1 HOUR", "10 minutes", "leftOuter")
    got = rows(runner.finished(spark, out, "left"), "post_id", "like_id")
    assert [g for g in got if g[0] < 99] == [(1, 1), (2, None)]


def test_decode_keeps_unreadable_rows(spark):
    df = spark.createDataFrame(
        [('{"like_id": 1, "post_id": 2, "user_id": 3, "timestamp": 1000}',), ('{"like_id": ',),
         ("nonsense",), (None,)], "value string")
    good, bad = good_and_bad(decode(df, LIKE))
    assert rows(good, "like_id", "ts") == [(1, datetime(1970, 1, 1, 0, 0, 1))]
    assert {r.error_value for r in bad.collect()} == {"nonsense", '{"like_id": ', None}


def test_file_metadata(spark, tmp_path):
    (tmp_path / "a.JPG").write_bytes(b"abc")
    (tmp_path / "b.bin").write_bytes(b"xyz")
    (tmp_path / "c.txt").write_bytes(b"")
    out = file_metadata(spark, str(tmp_path))
    assert rows(out, "filename", "size_bytes", "mime_type", "file_id") == [
        ("a.JPG", 3, "image/jpeg", "ba7816bf8f01cfea"),
        ("b.bin", 3, "application/octet-stream", "3608bca1e44ea6c4"),
        ("c.txt", 0, "text/plain", "e3b0c44298fc1c14")]
    assert file_metadata(spark, str(tmp_path), after_s=4e9).count() == 0
