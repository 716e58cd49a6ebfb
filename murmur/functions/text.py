"""Text patterns. Word characters are Unicode, hence the ``(?U)`` flag."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from murmur.functions.columns import any_hit

HASHTAG = r"(?U)#(\w+)"
MENTION = r"(?U)@(\w+)"
CONTROL = r"[\x00-\x1f\x7f-\x9f]"


def all_matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def hashtags(text: Column) -> Column:
    return all_matches(text, HASHTAG)


def mentions(text: Column) -> Column:
    return all_matches(text, MENTION)


def whole_words(words: list[str]) -> str:
    """One case-insensitive pattern that finds any of the phrases as whole words."""
    return r"(?iU)\b(?:" + "|".join(re.escape(w) for w in words) + r")\b"


def any_of(phrases: list[str]) -> str:
    return "(?iU)(?:" + "|".join(phrases) + ")"


# Letters beyond ASCII that equal an ASCII letter when case is ignored.
ODD_CASE = ["\u017f", "\u0131", "\u0130", "\u212a"]


def may_hold(text: Column, lowered: Column, phrases: list[str]) -> Column:
    """A cheap test that is true whenever a case-insensitive search could succeed.

    Plain substring search is many times faster than the pattern, which then only
    runs on the few rows that pass.
    """
    return any_hit(lowered, phrases) | any_hit(text, ODD_CASE)


def holds_words(text: Column, lowered: Column, words: list[str]) -> Column:
    return may_hold(text, lowered, words) & text.rlike(whole_words(words))


def holds_any(text: Column, lowered: Column, phrases: list[str]) -> Column:
    return may_hold(text, lowered, phrases) & text.rlike(any_of(phrases))


def clean(text: Column) -> Column:
    """Without control characters and outer white space."""
    return F.regexp_replace(F.regexp_replace(text, CONTROL, ""), r"(?U)^\s+|\s+$", "")
