"""Secret scan through a trigram index, with DataFrame functions only.

From each rule's regular expression follow the trigrams that every match must hold, as an OR
of ANDs. The inverted index holds, for each trigram that some rule names, the rows whose
lower-cased text has it. Postings are intersected by OR-ing the bits of each AND per row, and
only rows with a complete AND are verified with the rule's expression. A rule without
mandatory trigrams (``hex``) is matched against every row.

Matches are leftmost and do not overlap within a rule; a match whose checked group is shorter
than the rule's minimum is dropped after it has used up its text. Places are code points. A
null text is empty and has no matches; rows are judged one by one.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import row_key


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The kinds of secrets, in the order of their names in results.
RULES = [
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
                   r"([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}"),
    Rule("hub_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9._~+/-]{20,}"),
    Rule("url_login", r"://[A-Za-z0-9._%+-]+:[^\s:/@]+@"),
]
BASE = [r.kind for r in RULES[:3]]

#: Beyond so many ways to spell a part of a pattern, the part counts as unknown.
MOST_WAYS = 64

#: Matches whose places are summed up in one go.
BLOCK = 128

Way = tuple[str, ...]  # literal runs with something unknown between them


def joined(left: set[Way], right: set[Way]) -> set[Way]:
    out = {shortened(a[:-1] + (a[-1] + b[0],) + b[1:]) for a in left for b in right}
    return out if len(out) <= MOST_WAYS else {shortened(a + ("",)) for a in left}


def shortened(way: Way) -> Way:
    """Without the closed runs that hold no trigram; the first and last may still grow."""
    return way[:1] + tuple(run for run in way[1:-1] if len(run) > 2) + way[1:][-1:]


def ways(nodes) -> set[Way]:
    """The ways to match a parsed pattern, as far as they are literal."""
    out: set[Way] = {("",)}
    for op, value in nodes:
        if op is sre.LITERAL:
            part = {(chr(value),)}
        elif op is sre.IN and all(o is sre.LITERAL for o, _ in value):
            part = {(chr(v),) for _, v in value}
        elif op is sre.SUBPATTERN:
            part = ways(value[-1])
        elif op is sre.BRANCH:
            part = set().union(*(ways(b) for b in value[1]))
        elif op is sre.MAX_REPEAT and value[:2] == (0, 1):
            part = {("",)} | ways(value[2])
        elif op is sre.MAX_REPEAT and value[0] >= 1:
            part = joined(ways(value[2]), {("", "")})
        else:
            part = {("", "")}
        out = joined(out, part)
    return out


def trigram_query(pattern: str) -> list[list[str]]:
    """ORed lists of ANDed trigrams, lower case; empty if some match may have none."""
    clauses = set()
    for way in ways(sre_parser.parse(pattern)):
        found = frozenset(run.lower()[i:i + 3] for run in way for i in range(len(run) - 2))
        if not found:
            return []
        clauses.add(found)
    least = [c for c in clauses if not any(d < c for d in clauses)]
    return sorted(sorted(c) for c in least)


def postings(rows: DataFrame, trigrams: list[str]) -> DataFrame:
    """trigram, key: the inverted index of the named trigrams."""
    named = F.array(*map(F.lit, trigrams))
    held = F.transform(F.array(F.lower("text")), lambda low: F.filter(
        named, lambda t: F.contains(low, t)))[0]
    return rows.select("key", F.explode(held).alias("trigram"))


def candidates(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """key, kinds: the rules of which a row holds all mandatory trigrams."""
    wanted = [(rule.kind, n, t, 1 << i, (1 << len(clause)) - 1) for rule in rules
              for n, clause in enumerate(trigram_query(rule.pattern))
              for i, t in enumerate(clause)]
    # One row per trigram of a rule: bounded by the rules, whatever the data.
    terms = F.broadcast(rows.sparkSession.createDataFrame(
        wanted, "kind string, clause int, trigram string, bit long, full long"))
    index = postings(rows, sorted({w[2] for w in wanted}))
    return index.join(terms, "trigram").groupBy("key", "kind", "clause", "full").agg(
        F.bit_or("bit").alias("bits")).where("bits = full").groupBy("key").agg(
        F.collect_set("kind").alias("kinds"))


def matches(text: Column, rule: Rule) -> Column:
    """start, kind number, end, kind of the rule's matches in a text."""
    pattern = F.lit(rule.pattern)
    number = RULES.index(rule)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    checked = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    before = F.split(text, rule.pattern, -1)
    sizes = F.zip_with(F.slice(before, 1, F.size(whole)), F.arrays_zip(
        whole.alias("whole"), checked.alias("checked")), lambda b, m: F.struct(
        F.length(b).alias("before"), F.length(m["whole"]).alias("whole"),
        F.length(m["checked"]).alias("checked")))

    def spans(sizes: Column) -> Column:
        return F.zip_with(ends_of(sizes), sizes, lambda end, m: F.struct(
            (end - m["whole"]).alias("start"), F.lit(number).alias("number"), end.alias("end"),
            F.lit(rule.kind).alias("kind"), m["checked"].alias("checked")))

    return F.transform(F.filter(once(sizes, spans), lambda s: s["checked"] >= rule.least),
                       lambda s: s.dropFields("checked"))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of the value, which is computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def ends_of(sizes: Column) -> Column:
    """Running sums of before + whole. A growing array is copied at every step, so the sums
    run within blocks of ``BLOCK`` matches, and once over the sums of the blocks."""
    none = F.array().cast("array<int>")

    def running(steps: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), none.alias("sums"))
        return F.aggregate(steps, start, lambda acc, n: F.struct(
            (acc["at"] + n).alias("at"), F.array_append(acc["sums"], acc["at"] + n).alias("sums")),
            lambda acc: acc["sums"])

    def shifted(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.coalesce(F.try_element_at(b, F.lit(-1)), F.lit(0)))
        return once(totals, lambda t: F.flatten(F.zip_with(
            blocks, F.zip_with(running(t), t, lambda s, own: s - own),
            lambda b, base: F.transform(b, lambda x: x + base))))

    first = F.sequence(F.lit(1), F.greatest(F.size(sizes), F.lit(1)), F.lit(BLOCK))
    return once(F.transform(first, lambda i: running(F.transform(
        F.slice(sizes, i, BLOCK), lambda m: m["before"] + m["whole"]))), shifted)


def scan(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """doc_id and found: all spans (start, number, end, kind) of every row, by place and rule."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       row_key(F.col("doc_id"), F.col("text")).alias("key"))
    indexed = [r for r in rules if trigram_query(r.pattern)]
    none = F.array().cast("array<struct<start:int,number:int,end:int,kind:string>>")
    found = [F.when(F.array_contains("kinds", r.kind), matches(F.col("text"), r)).otherwise(none)
             if r in indexed else matches(F.col("text"), r) for r in rules]
    return rows.join(candidates(rows, indexed), "key", "left").select(
        "doc_id", F.array_sort(F.concat(*found)).alias("found"))


def shown(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
