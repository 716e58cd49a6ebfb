"""Line dedup: repeated runs of three lines are kept at their first place only.

A window is three consecutive lines that are not blank, compared after trimming; its 128-bit
hash is counted over all documents. A window that occurs more than once keeps its first
occurrence (by doc_id, null first, then row key and place); the lines of every later one are
covered, and a document loses the union of its covered lines. Windows may overlap within one
document: of four equal lines the first stays.

Blank lines are kept. A null text stays null; texts with fewer than three lines lose nothing.
Equal rows (same id and text) count as one document and get equal results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import row_key

LINES = 3


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.transform(F.array(value), body)[0]


def line_numbers(lines: Column) -> Column:
    """Numbers, from 0, of the lines that are not blank."""
    return F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.trim(lines[i]) != "")


def window_hashes(text: Column) -> Column:
    """(number, h1, h2) of every window of a text; ``number`` counts lines that are not blank."""

    def of(lines: Column, numbers: Column) -> Column:
        def window(t: Column) -> Column:
            own = [F.trim(lines[numbers[t + j]]) for j in range(LINES)]
            return F.struct(t.alias("number"), F.xxhash64(*own).alias("h1"),
                            F.xxhash64(F.lit(LINES), *reversed(own)).alias("h2"))

        return F.when(F.size(numbers) >= LINES, F.transform(
            F.sequence(F.lit(0), F.size(numbers) - LINES), window))

    return let(F.split(text, "\n"), lambda lines: let(
        line_numbers(lines), lambda numbers: of(lines, numbers)))


def later_windows(docs: DataFrame) -> DataFrame:
    """key, numbers: the windows of each row that occurred before."""
    windows = docs.select(
        "doc_id", "key", F.explode(window_hashes(F.col("text"))).alias("w")).select(
        "doc_id", "key", "w.*")
    place = F.struct("doc_id", "key", "number")
    first = windows.groupBy("h1", "h2").agg(
        F.min(place).alias("first"), F.max(place).alias("last")).where(
        ~F.col("first").eqNullSafe(F.col("last"))).select("h1", "h2", "first")
    return windows.join(first, ["h1", "h2"]).where(
        ~place.eqNullSafe(F.col("first"))).groupBy("key").agg(
        F.collect_set("number").alias("numbers"))


def kept_lines(text: Column, numbers: Column) -> Column:
    """kept and n_lines: the lines left when the windows that start at ``numbers`` are covered."""

    def of(lines: Column) -> Column:
        covered = let(line_numbers(lines), lambda own: F.flatten(F.transform(
            numbers, lambda t: F.slice(own, t + 1, LINES))))
        kept = F.when(numbers.isNull(), lines).otherwise(F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered),
            lambda i: lines[i]))
        return F.struct(kept.alias("kept"), F.size(lines).cast("long").alias("n_lines"))

    return let(F.split(text, "\n"), of)


def dedup(docs: DataFrame) -> DataFrame:
    """The rows with the remaining text, then n_lines and n_removed as last columns.

    Columns of these names are replaced.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    keyed = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("key"),
                        F.struct(*names).alias("row"))
    found = later_windows(keyed.select("key", "row.doc_id", "row.text"))
    lines = F.col("lines")
    return keyed.join(found, "key", "left").select(
        "row", kept_lines(F.col("row.text"), F.col("numbers")).alias("lines")).select(
        *[(F.array_join(lines["kept"], "\n") if c == "text" else F.col("row")[c]).alias(c)
          for c in names],
        F.coalesce(lines["n_lines"], F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(lines["n_lines"] - F.size(lines["kept"]), F.lit(0)).cast("long")
        .alias("n_removed"))
