"""Closed hopping windows from panes equal Spark's own windows, late rows included."""

from datetime import datetime, timedelta

import pytest

from murmur.session import shared_dir
from murmur.streaming import hops, runner, windows

T0 = datetime(2024, 1, 1)
SCHEMA = "ts timestamp, tag string, user_id long, engagement_score double"
#: Minutes of the rows of each batch; the later batches hold rows late for some or all windows.
BATCHES = [[0, 1, 4, 6, 31, 64], [20, 39, 58, 36, 59, 66, 5], [33, 61, 150, 64], [119, 125, 100, 210]]


def batch_rows(minutes, batch):
    out = [(T0 + timedelta(minutes=m), tag, user, m + batch / 8) for m in minutes
           for tag, user in (("a", m % 3), ("a", None), ("b", 1))]
    return [*out, (T0 + timedelta(minutes=minutes[0]), "a", 1, None), (None, "a", 1, 1.0)]


def in_files(spark):
    folder = shared_dir(spark, "late-rows")
    for i, minutes in enumerate(BATCHES):
        spark.createDataFrame(batch_rows(minutes, i), SCHEMA).coalesce(1).write.mode(
            "append").parquet(folder)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.mark.parametrize("fold", [None, 2])
def test_late_rows_count_in_open_windows_only(spark, fold):
    own = windows.hopping_closed(in_files(spark), "30 minutes", "5 minutes", "5 minutes")
    expected = runner.finished(spark, own, "own")
    got = hops.closed_hops(in_files(spark), shared_dir(spark, "closed"), fold_every=fold)
    assert sorted(map(tuple, got.select(*expected.columns).collect())) == sorted(
        map(tuple, expected.collect()))


def test_the_state_holds_no_copy_per_window(spark):
    folder = shared_dir(spark, "closed")
    hops.closed_hops(in_files(spark), folder)
    panes = spark.read.parquet(f"{folder}/panes")
    on_time = panes.where("batch = 0")
    assert on_time.count() == on_time.select("tag", "user_id", "pane").distinct().count() == 13


def test_no_rows(spark):
    folder = shared_dir(spark, "none")
    spark.createDataFrame([], SCHEMA).write.parquet(folder)
    empty = spark.readStream.schema(SCHEMA).parquet(folder)
    assert hops.closed_hops(empty, shared_dir(spark, "closed")).count() == 0
