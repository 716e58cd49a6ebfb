"""Hopping windows on a stream, kept as panes and filled once they are closed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur.functions.columns import window_start
from murmur.streaming import runner, sinks


def closed_hops(tags: DataFrame, folder: str, size_s: int = 1800, hop_s: int = 300,
                grace_s: int = 300, fold_every: int | None = None) -> DataFrame:
    """What ``windows.hopping_closed`` emits, with one row per hashtag, user and pane of one hop.

    The watermark is the latest time less the grace, kept by batch id. As with Spark's own state,
    a batch closes windows by the watermark of the batches before it and takes late rows for those
    that were open until then. So a row counts in its windows that the batch before its own has
    not closed; ``first``, the first of them, is kept with the pane: a late row changes no closed
    window and is not lost to the open ones. Windows that the last watermark has passed are
    filled from the panes. Runs the stream to the end of its input.
    """
    spark = tags.sparkSession
    latest = sinks.BatchTable(
        spark, f"{folder}/latest", T.StructType([
            T.StructField("ms", T.LongType()), T.StructField("ms_before", T.LongType())]),
        sinks.newest_by([]), fold_every)
    keys = ["tag", "user_id", "pane", "first"]
    schema = T.StructType([
        tags.schema["tag"], tags.schema["user_id"], T.StructField("pane", T.LongType()),
        T.StructField("first", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("engagement", T.DoubleType())])
    panes = sinks.BatchTable(spark, f"{folder}/panes", schema,
                             sinks.summed(keys, ["n", "engagement"]), fold_every)

    def handle(batch: DataFrame, batch_id: int) -> None:
        before, seen = latest.merge(latest.partials(batch_id - 1)).first(), batch.agg(
            F.max(F.unix_millis("ts"))).first()[0]
        passed = None if before is None or before.ms_before is None else before.ms_before - grace_s * 1000
        first = F.col("pane") - (size_s - hop_s)
        if passed is not None:
            # Windows start at multiples of a hop; the first one that ends after the watermark.
            first = F.greatest(first, F.lit((passed - size_s * 1000) // (hop_s * 1000) * hop_s + hop_s))
        rows = batch.withColumn(
            "pane", window_start(F.col("ts"), hop_s)).withColumn("first", first).filter(
            F.col("first") <= F.col("pane"))
        panes.write(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(
            "engagement_score").alias("engagement")), batch_id)
        known = [ms for ms in (before and before.ms, seen) if ms is not None]
        row = (max(known, default=None), before and before.ms)
        latest.write(batch.sparkSession.createDataFrame([row], latest.schema), batch_id)

    runner.each_batch(tags, handle, f"{folder}/checkpoint", "append")
    last = latest.current().first()
    closed = None if last is None or last.ms is None else last.ms - grace_s * 1000
    return filled(panes.current(), size_s, hop_s).filter(
        (F.col("window_start") + size_s) * 1000 <= F.lit(closed).cast("long"))


def filled(panes: DataFrame, size_s: int, hop_s: int) -> DataFrame:
    """Hopping windows from panes that count in the windows from ``first`` to their own.

    From a user's last pane back, a pane adds the user to the windows before the least ``first``
    of those after it, so no row is copied per user.
    """
    after = Window.partitionBy("tag", "user_id").orderBy(F.desc("pane"), "first").rowsBetween(
        Window.unboundedPreceding, -1)
    last = F.least(F.col("pane"), F.min("first").over(after) - hop_s)
    sums = panes.withColumn("last", last).groupBy("tag", "pane", "first", "last").agg(
        F.sum("n").alias("n"), F.sum("engagement").alias("engagement"),
        F.count("user_id").alias("users"))
    users = F.when(F.col("window_start") <= F.col("last"), F.col("users")).otherwise(0)
    return sums.withColumn("window_start", F.explode(F.sequence(
        "first", "pane", F.lit(hop_s).cast("long")))).groupBy("tag", "window_start").agg(
        F.sum("n").alias("mention_count"), F.sum(users).alias("unique_users"),
        F.sum("engagement").alias("total_engagement"))
