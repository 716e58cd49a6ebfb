"""Column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clamp01(value: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))


def is_blank(value: Column) -> Column:
    """True for null and, for text, the empty string."""
    return value.isNull() | (value.cast("string") == "")


def lookup(key: Column, values: Mapping[str, object], default: object) -> Column:
    """Constant lookup table as one map literal."""
    pairs = [F.lit(x) for item in values.items() for x in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), key), F.lit(default))


def first_match(rules: list[tuple[Column, object]], otherwise: object = None) -> Column:
    """Value of the first rule whose condition holds, tested in order."""
    whens = reduce(
        lambda acc, rule: acc.when(rule[0], rule[1]),
        rules[1:],
        F.when(rules[0][0], rules[0][1]),
    )
    return whens.otherwise(otherwise)


def md5_mod(text: Column, modulus: int) -> Column:
    """The md5 digest of ``text``, read as one big integer, modulo ``modulus``.

    The 128-bit number does not fit a long, so the remainder is folded over four
    32-bit pieces; ``modulus`` must stay below 2**31.
    """
    digest = F.md5(text)
    rest = F.lit(0).cast("long")
    for start in (1, 9, 17, 25):
        piece = F.conv(F.substring(digest, start, 8), 16, 10).cast("long")
        rest = (rest * F.lit(1 << 32) + piece) % F.lit(modulus)
    return rest


def count_text(value: Column, needle: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    gone = F.length(F.replace(value, F.lit(needle), F.lit("")))
    return ((F.length(value) - gone) / F.lit(len(needle))).cast("long")


def count_chars(value: Column, char_class: str) -> Column:
    """Characters of a class, given as the inside of a bracket expression.

    Runs of other characters are removed as a whole, and only from rows with a hit.
    """
    kept = F.regexp_replace(value, f"[^{char_class}]++", "")
    return F.when(value.rlike(f"[{char_class}]"), F.length(kept)).otherwise(0).cast("long")


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later filters and projections will not compute again.

    Spark copies the expression of an ordinary column into every filter above it; a
    generator of one row stops that.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def hits(value: Column, words: list[str]) -> Column:
    """How many of the words occur in ``value`` as substrings; each counts once."""
    return reduce(lambda a, b: a + b, [F.contains(value, F.lit(w)).cast("long") for w in words])


def any_hit(value: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(value, F.lit(w)) for w in words])


def hours_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(3_600_000_000.0)


def window_start(ts: Column, seconds: int) -> Column:
    """Start of the epoch-aligned tumbling window, as epoch seconds."""
    return (F.floor(F.unix_seconds(ts) / F.lit(seconds)) * F.lit(seconds)).cast("long")


def percent(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))
