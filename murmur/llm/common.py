"""What the operators share: folds, row keys, written intermediate tables."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import AnyStr

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.session import configure, shared_dir

#: Rows and bytes of one Arrow batch; a batch of long texts must fit beside the JVM.
ARROW_ROWS, ARROW_BYTES = "2000", "32m"


def prepared(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, mod n; -1 without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % n, F.lit(-1))


def row_key(*columns: Column) -> Column:
    """16 bytes that stand for the values of a row; equal rows have equal keys."""
    parts = [F.coalesce(F.concat(F.lit("+"), c.cast("string")), F.lit("-")) for c in columns]
    return F.unhex(F.md5(F.concat_ws("\x1f", *parts)))


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the folder that all executors share and read again."""
    spark = frame.sparkSession
    path = shared_dir(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def slices(text: AnyStr, stop: re.Pattern[AnyStr], size: int = 1 << 20) -> Iterator[AnyStr]:
    """The text in parts of about ``size``, cut only where ``stop`` matches."""
    lo = 0
    while lo < len(text):
        end = stop.search(text, lo + size)
        hi = end.end() if end else len(text)
        yield text[lo:hi]
        lo = hi
