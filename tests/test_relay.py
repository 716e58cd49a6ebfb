"""Outbox relay and metrics upsert: repeated batches and rows change nothing."""

from murmur.session import shared_dir
from murmur.streaming.relay import MetricsUpsert, OutboxRelay


def test_outbox_rows_are_relayed_once(spark):
    schema = "event_id long, payload string"
    batches = [spark.createDataFrame(rows, schema) for rows in (
        [(1, "a"), (2, "b"), (2, "b"), (3, "c")], [(2, "b"), (4, "d")], [(9, "x")])]
    done = spark.createDataFrame([(3,), (9,)], "event_id long")
    relay = OutboxRelay(spark, shared_dir(spark, "outbox"), batches[0].schema, done)
    expected = [(1, "a", 0), (2, "b", 0), (4, "d", 1)]
    for number in (0, 1, 1, 2, 2):
        relay(batches[number], number)
    assert sorted(tuple(r) for r in relay.relayed().collect()) == expected


def test_metrics_add_up_once_per_batch(spark):
    schema = "user_id long, metric_type string, value double, offset long"
    batches = [spark.createDataFrame(rows, schema) for rows in (
        [(1, "view", 2.0, 5), (1, "view", 3.0, 4), (2, "like", 1.0, 6)], [(1, "view", 4.0, 9)])]
    for fold_every in (1, 20):
        metrics = MetricsUpsert(spark, shared_dir(spark, "metrics"), fold_every)
        for number in (0, 0, 1, 1):
            metrics(batches[number], number)
        assert sorted(tuple(r) for r in metrics.current().collect()) == [
            (1, "view", 9.0, 9), (2, "like", 1.0, 6)]
