"""Tables kept by foreachBatch handlers.

A handler writes the aggregate of its micro-batch to a folder named after the batch
id. Writing it again replaces it, so a repeated batch changes nothing: with the
checkpoint this gives exactly-once results for additive upserts too. Readers merge the
folders with the same mergeable aggregate.

With ``fold_every`` the table does not grow by a folder per batch for ever: every so many
batches all rows so far are merged into a snapshot, which counts from the moment its
``_SUCCESS`` file is there. Readers take the newest such snapshot and the later batches;
what it covers is deleted afterwards, and a repeated batch that it covers is ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Merge = Callable[[DataFrame], DataFrame]


class BatchTable:
    """Per-batch partial results under one folder.

    To be folded, a table's ``merge`` must give rows of the table's own schema.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, merge: Merge,
                 fold_every: int | None = None):
        self.spark, self.path, self.merge = spark, path, merge
        self.schema, self.fold_every = schema, fold_every

    def _folder(self, name: str, kind: str = "batch") -> tuple:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}={name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _numbers(self, kind: str) -> list[int]:
        files, pattern = self._folder("*", kind)
        found = files.globStatus(pattern) or []
        return sorted(int(f.getPath().getName().split("=")[1]) for f in found)

    def folded(self) -> int | None:
        """The last batch that the newest complete snapshot covers."""
        done = [n for n in self._numbers("snapshot") if self._exists(n)]
        return max(done, default=None)

    def _exists(self, upto: int) -> bool:
        files, path = self._folder(f"{upto:09d}/_SUCCESS", "snapshot")
        return files.exists(path)

    def write(self, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id:09d}")
        if self.fold_every and (batch_id + 1) % self.fold_every == 0:
            self.fold(batch_id)

    def fold(self, upto: int) -> None:
        """Merge all batches up to ``upto`` into a snapshot, then delete what it covers."""
        before = self.folded()
        if before is not None and upto <= before:
            return
        merged = self.merge(self.partials(upto)).select(*self.schema.fieldNames())
        merged.write.mode("overwrite").parquet(f"{self.path}/snapshot={upto:09d}")
        old = [("batch", n) for n in self._numbers("batch") if n <= upto]
        old += [("snapshot", n) for n in self._numbers("snapshot") if n < upto]
        for kind, n in old:
            files, path = self._folder(f"{n:09d}", kind)
            files.delete(path, True)

    def partials(self, upto: int | None = None) -> DataFrame:
        """All partial rows with the id of their batch; those of a snapshot have its last."""
        first = self.folded()
        later = [n for n in self._numbers("batch")
                 if (first is None or n > first) and (upto is None or n <= upto)]
        schema = T.StructType([*self.schema.fields, T.StructField("batch", T.LongType())])
        if later:
            reader = self.spark.read.schema(schema).option("basePath", self.path)
            rows = reader.parquet(*(f"{self.path}/batch={n:09d}" for n in later))
        else:
            rows = self.spark.createDataFrame([], schema)
        if first is None:
            return rows
        base = self.spark.read.schema(self.schema).parquet(f"{self.path}/snapshot={first:09d}")
        return base.withColumn("batch", F.lit(first).cast("long")).unionByName(rows)

    def current(self) -> DataFrame:
        return self.merge(self.partials())


def added_counts(partials: DataFrame) -> DataFrame:
    """Upsert per hashtag over the batches: counts add up, the rest is the newest."""
    return partials.groupBy("hashtag").agg(
        F.sum("count").alias("count"),
        F.min_by("window_start", "batch").alias("window_start"),
        *[F.max_by(c, "batch").alias(c) for c in ("last_updated", "window_end", "trend_score")])


def newest_by(keys: list[str]) -> Merge:
    """The value of the last batch per key."""
    def merge(partials: DataFrame) -> DataFrame:
        rest = [c for c in partials.columns if c not in (*keys, "batch")]
        out = partials.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r"))
        return out.select(*keys, "r.*")
    return merge


def summed(keys: list[str], values: list[str]) -> Merge:
    def merge(partials: DataFrame) -> DataFrame:
        return partials.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])
    return merge
