"""State of a checkpoint by key, top, range and change; counts by batch."""

from pyspark.sql import functions as F

from murmur.session import shared_dir
from murmur.streaming import runner, state


def test_state_of_two_batches(spark):
    folder = shared_dir(spark, "reads")
    schema = "user string, v long"
    counts = state.BatchCounts(spark, "arrived")

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in").observe(
            "arrived", F.count(F.lit(1)).alias("rows"), F.sum("v").alias("v"))
        with counts:
            runner.each_batch(stream.groupBy("user").agg(F.sum("v").alias("total")),
                              lambda batch, _: batch.collect(), f"{folder}/checkpoint")

    run([("a", 1), ("b", 2), (None, 9)])
    run([("a", 5), ("c", 4)])
    path = f"{folder}/checkpoint"
    rows = state.rows(spark, path)

    def shown(frame):
        return sorted(((r.key.user, r.value.sum) for r in frame.collect()), key=str)

    assert shown(rows) == [("a", 6), ("b", 2), ("c", 4), (None, 9)]
    assert shown(state.rows(spark, path, batch=0)) == [("a", 1), ("b", 2), (None, 9)]
    for user, total in (("a", 6), ("c", 4), (None, 9)):
        found = state.at_key(rows, path, user=user)
        assert shown(found) == [(user, total)]
    assert shown(state.at_key(rows, path, user="nobody")) == []
    top = state.largest(rows, [F.desc("value.sum")], 2).collect()
    assert [(r.key.user, r["rank"]) for r in top] == [(None, 1), ("a", 2)]
    assert shown(state.between(rows, "value.sum", 2, 4)) == [("b", 2), ("c", 4)]
    assert state.operators(spark, path).count() == 1
    assert counts.batches == {0: {"rows": 3, "v": 12}, 1: {"rows": 2, "v": 9}}
    assert counts.total("v") == 21


def test_changes_by_batch(spark):
    changelog = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    spark.conf.set(changelog, "true")
    try:
        folder = shared_dir(spark, "changes")
        for rows in ([("a", 1), ("b", 2)], [("a", 5)]):
            spark.createDataFrame(rows, "user string, v long").coalesce(1).write.mode(
                "append").parquet(f"{folder}/in")
            stream = spark.readStream.schema("user string, v long").parquet(f"{folder}/in")
            runner.each_batch(stream.groupBy("user").agg(F.sum("v").alias("total")),
                              lambda batch, _: batch.collect(), f"{folder}/checkpoint")
        found = state.changes(spark, f"{folder}/checkpoint", 0).where("change_type = 'update'")
        assert sorted((r.batch_id, r.key.user, r.value.sum) for r in found.collect()) == [
            (0, "a", 1), (0, "b", 2), (1, "a", 6)]
        later = state.changes(spark, f"{folder}/checkpoint", 1).where("change_type = 'update'")
        assert [r.key.user for r in later.collect()] == ["a"]
    finally:
        spark.conf.unset(changelog)
