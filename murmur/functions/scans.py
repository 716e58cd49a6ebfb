"""Ordered scans per key that never need one key in one task.

``lag`` or a running sum over ``partitionBy(user)`` sorts all rows of a user in a
single task, which fails once one user holds a large share of the log. Here the
order is cut into chunks: a window runs inside each (key, chunk), every chunk is
folded to one summary row, a second window runs over these few rows, and its result
is joined back. ``chunk`` must not decrease along ``order``: an offset divided by a
constant, or the time cut to the hour.

The rows are shuffled once, by (key, chunk); the join back finds them in place. The
summaries come from a mergeable aggregate and are small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Key and chunk as one struct: it is never null, so null keys group and join too.
AT = "__at"
OFFSET_CHUNK = 1_000_000


def by_offset(column: str, size: int = OFFSET_CHUNK) -> Column:
    return F.floor(F.col(column) / F.lit(size))


def by_time(column: str, seconds: int = 600) -> Column:
    return F.floor(F.unix_seconds(F.col(column)) / F.lit(seconds))


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column,
    sums: dict[str, Column] | None = None,
    maxima: dict[str, Column] | None = None,
    previous: dict[str, str] | None = None,
    totals: dict[str, str] | None = None,
    include_current: bool = True,
) -> DataFrame:
    """Add running sums, running maxima and values of the preceding row.

    ``sums`` and ``maxima`` map output names to columns; with ``include_current=False``
    their frame ends at the preceding row. ``previous`` maps output names to source
    columns. ``totals`` maps an output name to the sum whose total over the whole key it
    shall hold.
    """
    sums, maxima = sums or {}, maxima or {}
    previous, totals = previous or {}, totals or {}
    at = F.struct(*[F.col(k) for k in keys], chunk.alias("chunk"))
    df = df.withColumn(AT, at)
    end = Window.currentRow if include_current else -1
    ordered = Window.partitionBy(AT).orderBy(*order)
    frame = ordered.rowsBetween(Window.unboundedPreceding, end)
    packed = F.struct(*[F.col(src).alias(out) for out, src in previous.items()])

    local = {f"__l_{n}": F.sum(c).over(frame) for n, c in sums.items()}
    local |= {f"__l_{n}": F.max(c).over(frame) for n, c in maxima.items()}
    folds = [F.sum(c).alias(f"__s_{n}") for n, c in sums.items()]
    folds += [F.max(c).alias(f"__s_{n}") for n, c in maxima.items()]
    if previous:
        local["__l_row"] = F.lag(packed).over(ordered)
        # Column by column, so that plain numbers are merged by hash without a sort.
        latest = F.col(order[0]) if len(order) == 1 else F.struct(*order)
        folds += [F.max_by(src, latest).alias(f"__s_{out}") for out, src in previous.items()]

    whole = Window.partitionBy(*[f"{AT}.{k}" for k in keys])
    later = whole.orderBy(f"{AT}.chunk")
    earlier_chunks = later.rowsBetween(Window.unboundedPreceding, -1)
    carries = [F.sum(f"__s_{n}").over(earlier_chunks).alias(f"__c_{n}") for n in sums]
    carries += [F.max(f"__s_{n}").over(earlier_chunks).alias(f"__c_{n}") for n in maxima]
    carries += [F.sum(f"__s_{n}").over(whole).alias(out) for out, n in totals.items()]
    if previous:
        last = F.struct(*[F.col(f"__s_{out}").alias(out) for out in previous])
        carries.append(F.lag(last).over(later).alias("__c_row"))
    carry = df.groupBy(AT).agg(*folds).select(AT, *carries)

    joined = df.withColumns(local).join(carry, AT, "left")
    zero = F.lit(0)
    out = {n: F.coalesce(F.col(f"__c_{n}"), zero) + F.coalesce(F.col(f"__l_{n}"), zero)
           for n in sums}
    out |= {n: F.greatest(F.col(f"__c_{n}"), F.col(f"__l_{n}")) for n in maxima}
    out |= {n: F.coalesce(F.col("__l_row"), F.col("__c_row")).getField(n) for n in previous}
    names = [*sums, *maxima, *(["row"] if previous else [])]
    return joined.withColumns(out).drop(AT, *[f"__{p}_{n}" for n in names for p in "lc"])


def row_numbers(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, name: str
) -> DataFrame:
    return scan(df, keys, order, chunk, sums={name: F.lit(1).cast("long")})
