"""Top-n, newest-per-key and index percentiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.functions import scans


def top(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Global top-n; Spark keeps n rows per task and merges them."""
    return df.orderBy(*order).limit(n)


def ranked_top(df: DataFrame, order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """Top-n with its position. The window sees the n surviving rows only."""
    best = top(df, order, n)
    return best.withColumn(rank, F.row_number().over(Window.orderBy(*order)).cast("long"))


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """At most n rows per key.

    Spark turns the rank filter into a group limit that also runs before the
    exchange, so a hot key ships n rows per map task, not all of its rows.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn(rank, F.row_number().over(w))
            .filter(F.col(rank) <= n)
            .withColumn(rank, F.col(rank).cast("long")))


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest order value per key, by a mergeable aggregate."""
    rest = [c for c in df.columns if c not in keys]
    packed = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col("__row").getField(c).alias(c) for c in rest])


def oldest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    packed = F.min_by(F.struct(*rest), F.struct(*order)).alias("__row")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col("__row").getField(c).alias(c) for c in rest])


#: Split points of a sketch, and distinct values of a key that are ranked in one task.
SPLITS, CHUNK_VALUES = 64, 1_000_000


def value_chunks(counts: DataFrame, keys: Sequence[str], value: str,
                 size: int = CHUNK_VALUES) -> DataFrame:
    """The rows with ``__chunk``, which does not fall along the values of a key.

    A mergeable sketch per key gives ``SPLITS`` points with about as many values between them;
    the room between two points is cut evenly into as many chunks as the number of values needs.
    So chunks follow the rows, whatever the values measure.
    """
    at = F.struct(*keys).alias("__key")  # never null, so null keys join too
    ranks = F.array(*[F.lit(i / SPLITS) for i in range(SPLITS + 1)])
    sketch = counts.groupBy(at).agg(
        F.percentile_approx(value, ranks, 10_000).alias("__points"),
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / (SPLITS * size))).alias("__parts"))
    points, v = F.col("__points"), F.col(value)
    low = F.array_max(F.filter(points, lambda x: x <= v))
    high = F.array_min(F.filter(points, lambda x: x > v))
    part = F.floor(F.coalesce((v - low) / (high - low), F.lit(0.0)) * F.col("__parts"))
    cut = F.size(F.filter(points, lambda x: x <= v)) * F.col("__parts") + F.least(
        F.greatest(part, F.lit(0)), F.col("__parts") - 1)
    return counts.withColumn("__key", at).join(sketch, "__key").withColumn(
        "__chunk", cut.cast("long")).drop("__key", "__points", "__parts")


def index_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    points: dict[str, float],
    chunk: int = CHUNK_VALUES,
) -> DataFrame:
    """Exact percentiles by the rule "element at 0-based index floor(n * p)".

    Equal values are merged first, then cumulative counts are built per chunk of values
    (:func:`value_chunks` and :mod:`murmur.functions.scans`), so no group is sorted in one
    task. The merged values also give the number, mean and extremes as n, avg, min and max.
    """
    base = df.filter(F.col(value).isNotNull())
    counts = base.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    upto = scans.scan(
        value_chunks(counts, keys, value, chunk), keys, [value], F.col("__chunk"),
        sums={"__upto": F.col("__n")}, totals={"__total": "__upto"})
    picks = []
    for name, p in points.items():
        index = F.least(F.floor(F.col("__total") * F.lit(p)), F.col("__total") - 1)
        inside = (F.col("__upto") > index) & (F.col("__upto") - F.col("__n") <= index)
        picks.append(F.max(F.when(inside, F.col(value))).alias(name))
    basics = [F.sum("__n").alias("n"),
              (F.sum(F.col(value) * F.col("__n")) / F.sum("__n")).alias("avg"),
              F.min(value).alias("min"), F.max(value).alias("max")]
    return upto.groupBy(*keys).agg(*basics, *picks)
