"""Conflict resolution on a stream of copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur.functions import scans
from murmur.streaming.sinks import BatchTable, newest_by

WINNERS = T.StructType([T.StructField("content_id", T.LongType()),
                        T.StructField("seq", T.LongType()), T.StructField("winner_seq", T.LongType())])
BEST = T.StructType([T.StructField("content_id", T.LongType()),
                     T.StructField("updated_us", T.LongType()), T.StructField("seq", T.LongType())])


class LastWriteWins:
    """foreachBatch handler that emits the winner after every copy of a record.

    copies: content_id, seq, updated_us. The best copy so far of every key is a table;
    it joins the micro-batch as the earliest copy. The running winner comes from a
    chunked scan, so a hot record does not end up in one task.
    """

    def __init__(self, spark, path: str):
        self.emitted = BatchTable(spark, f"{path}/winners", WINNERS, lambda p: p)
        self.best = BatchTable(spark, f"{path}/best", BEST, newest_by(["content_id"]))

    FOLD_EVERY = 20

    def __call__(self, copies: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % self.FOLD_EVERY == 0:
            self.best.fold(batch_id - 1)  # never this batch: it may be a repeated one
        copies = copies.persist()
        try:
            self._resolve(copies, batch_id)
        finally:
            copies.unpersist()

    def _resolve(self, copies: DataFrame, batch_id: int) -> None:
        rows = copies.withColumn("is_old", F.lit(False))
        if batch_id > 0:
            # What earlier batches left behind; a repeated batch must not see itself.
            stored = self.best.merge(self.best.partials().filter(F.col("batch") < batch_id))
            keys = copies.select("content_id").distinct()
            rows = rows.unionByName(
                stored.join(keys, "content_id", "left_semi").withColumn("is_old", F.lit(True)))
        rank = F.struct("updated_us", (-F.col("seq")).alias("first"))
        ran = scans.scan(rows, ["content_id"], ["seq"], scans.by_offset("seq"),
                         maxima={"top": rank})
        out = ran.filter(~F.col("is_old")).select(
            "content_id", "seq", (-F.col("top.first")).alias("winner_seq"))
        self.emitted.write(out, batch_id)
        last = rows.groupBy("content_id").agg(F.max(rank).alias("top")).select(
            "content_id", F.col("top.updated_us").alias("updated_us"),
            (-F.col("top.first")).alias("seq"))
        self.best.write(last, batch_id)
