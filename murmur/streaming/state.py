"""Reading what a stream keeps, while it runs or afterwards: its state and its counts by batch.

The state of a checkpoint is read by Spark's ``statestore`` source, as of any batch that is still
kept, so no sink table is needed to answer a question. A point query names the key and reads only
the partition that holds it.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from murmur.functions.ranking import ranked_top


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """operatorId, operatorName, stateStoreName, numPartitions, minBatchId, maxBatchId."""
    return spark.read.format("state-metadata").load(checkpoint)


def rows(spark: SparkSession, checkpoint: str, operator: int = 0,
         batch: int | None = None) -> DataFrame:
    """key (struct), value (struct) and partition_id of an operator after a batch (the last)."""
    reader = spark.read.format("statestore").option("operatorId", str(operator))
    if batch is not None:
        reader = reader.option("batchId", str(batch))
    return reader.load(checkpoint)


def at_key(state: DataFrame, checkpoint: str, operator: int = 0, **key: Any) -> DataFrame:
    """The state of one key; rows of other partitions are left out before they are compared."""
    spark = state.sparkSession
    n = operators(spark, checkpoint).where(F.col("operatorId") == operator).agg(
        F.max("numPartitions")).first()[0]
    types = {f.name: f.dataType for f in state.schema["key"].dataType}
    values = [F.lit(key[name]).cast(types[name]) for name in types]
    found = state.where(F.col("partition_id") == F.pmod(F.hash(*values), F.lit(n)))
    for name, value in zip(types, values):
        found = found.where(F.col(f"key.{name}").eqNullSafe(value))
    return found


def largest(state: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of the state in an order, with their rank: n rows a task are merged."""
    return ranked_top(state, order, n)


def between(state: DataFrame, column: str, low: Any, high: Any) -> DataFrame:
    """Rows whose column (for example ``key.user_id``) lies from ``low`` to ``high``."""
    return state.where(F.col(column).between(low, high))


def changes(spark: SparkSession, checkpoint: str, first: int, last: int | None = None,
            operator: int = 0) -> DataFrame:
    """batch_id, change_type, key, value of what the batches from ``first`` on have written."""
    reader = (spark.read.format("statestore").option("operatorId", str(operator))
              .option("readChangeFeed", "true").option("changeStartBatchId", str(first)))
    if last is not None:
        reader = reader.option("changeEndBatchId", str(last))
    return reader.load(checkpoint)


class BatchCounts(StreamingQueryListener):
    """Observed counts by batch id; a repeated batch replaces its own.

    Use as a context around the run of a query whose plan has ``observe(name, ...)``.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        super().__init__()
        self.spark, self.name = spark, name
        self.batches: dict[int, dict[str, int]] = {}
        self.ended = threading.Event()

    def __enter__(self) -> BatchCounts:
        self.ended.clear()
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error: object) -> None:
        self.ended.wait(30)  # events come after the query has ended
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = event.progress.observedMetrics.get(self.name)
        if found is not None:
            self.batches[event.progress.batchId] = found.asDict()

    def onQueryTerminated(self, event) -> None:
        self.ended.set()

    def total(self, column: str) -> int:
        return sum(int(counts[column] or 0) for counts in self.batches.values())
