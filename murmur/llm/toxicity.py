"""Toxicity of restored text: a noisy channel undoes leetspeak, spacing and repetition.

A character trigram model is counted over all learning texts. Pieces of a text that look
disguised (marks or digits between letters; three equal letters in a row, or two pairs of equal
ones in a word; letters with blanks, line ends or marks between them) become lattices of what
each character may stand for; the best path under the model and the channel's costs is read in
place of the piece, beside the words as written. Three and more groups of one or two letters are
read as one word where the model finds that the likeliest division.

What is toxic is learned from a bounded sample of about ``SAMPLE_ROWS`` labelled rows: for each
word and each word beginning of 3 to 6 characters the smoothed share of toxic texts among those
that hold it. A text's score is a logistic function of its strongest feature and of how many
strong words it has, fitted on a part of the sample kept for that.

Rows are scored one by one; null and empty texts have no words and get the score of a text
without any feature. Of labels with equal ids the highest counts. Without labels of both kinds,
every score is the share of toxic rows in the sample (0 without any).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur.llm.tokens import LOWER

# What marks and digits may stand for.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
SEPARATORS = " \t\n\r.-*_,~/"
COST_LEET, COST_DROP, COST_BREAK = 1.0, 0.5, 0.5
COST_PAIR = 2.0  # of reading two equal letters as one
MOST_GROUPS = 10  # of one or two letters in a word
COST_UNREAD = 7.0  # of a mark that stands for no letter

SAMPLE_ROWS = 20_000
HASH_RANGE = 1 << 30
#: Word beginnings that are features, and distinct words that must share one.
BEGINNINGS, LEAST_WORDS = range(3, 7), 3
#: Toxic texts that must hold a feature, smoothing, least share kept.
LEAST_TEXTS, PRIOR_TEXTS, LEAST_SHARE = 3, 5.0, 0.3

#: Characters of the model: a to z, any other letter, the end of a word.
OTHER, EDGE, SYMBOLS = 26, 27, 28

WORD = re.compile(r"[^\W\d_]+")
LEET_MARKS = "".join(map(re.escape, LEET))
UNIT = rf"(?:[^\W_]|[{LEET_MARKS}])"
BETWEEN = r"[\s.\-*_,~/]{1,3}"
SPACED = re.compile(rf"(?<![^\W_]){UNIT}{BETWEEN}(?:{UNIT}{BETWEEN})+{UNIT}(?![^\W_])")
GROUPS = re.compile(rf"\b\w\w?{BETWEEN}\w\w?{BETWEEN}\w\w?\b(?:{BETWEEN}\w\w?\b)*")
REPEATED = re.compile(r"([^\W\d_])\1(?:\1|[^\W\d_]*([^\W\d_])\2)")
INNER = re.compile(rf"[^\W\d_][\d\W_]+[^\W\d_]|[^\W\d_][{LEET_MARKS}]|[{LEET_MARKS}][^\W\d_]")


def symbol(c: str) -> int:
    return ord(c) - 97 if "a" <= c <= "z" else OTHER if c.isalpha() else EDGE


def character_counts(texts: DataFrame) -> np.ndarray:
    """Counts of all runs of three symbols: one row per symbol run and task, then summed."""
    table = np.full(256, EDGE)
    table[97:123] = np.arange(26)
    table[0xC0:] = OTHER  # the first byte of another letter; those that follow are skipped
    follows = (np.arange(256) >= 0x80) & (np.arange(256) < 0xC0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS ** 3, np.int64)
        for batch in batches:
            for text in batch.column(0):
                raw = LOWER[np.frombuffer((text.as_py() or "").encode(), np.uint8)]
                s = np.concatenate([[EDGE, EDGE], table[raw[~follows[raw]]], [EDGE]])
                total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:],
                                     minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["run", "n"])

    rows = texts.select("text").mapInArrow(run, "run long, n long").groupBy("run").agg(
        F.sum("n").alias("n")).collect()  # at most SYMBOLS**3 rows
    out = np.zeros(SYMBOLS ** 3)
    for r in rows:
        out[r["run"]] = r["n"]
    return out.reshape(SYMBOLS, SYMBOLS, SYMBOLS)


def character_model(counts: np.ndarray) -> list:
    """log p(c | a, b): trigrams, smoothed with bigrams and these with single symbols."""
    one = counts.sum(axis=(0, 1)) + 1
    two = counts.sum(axis=0) + 10 * one / one.sum()
    two /= two.sum(axis=1, keepdims=True)
    three = counts + 10 * two
    return np.log(three / three.sum(axis=2, keepdims=True)).tolist()


class Channel:
    """Restores disguised pieces of text; remembers what it has restored."""

    MOST = 100_000

    def __init__(self, model: list) -> None:
        self.model = model
        self.seen: dict[str, str] = {}

    def options(self, piece: str) -> list[list[tuple[str, float]]]:
        """What each character, or run of equal letters, may stand for, and at what cost."""
        out, i = [], 0
        while i < len(piece):
            c = piece[i]
            j = i + 1
            while j < len(piece) and piece[j] == c:
                j += 1
            if c.isalpha():
                if j - i > 2:
                    out.append([(c, COST_DROP), (c * 2, COST_DROP)])
                elif j - i == 2:
                    out.append([(c * 2, 0.0), (c, COST_PAIR)])
                else:
                    out.append([(c, 0.0)])
            elif c in LEET:
                out += [[(x, COST_LEET) for x in LEET[c]] + [("", COST_UNREAD), (" ", COST_UNREAD)]] * (j - i)
            elif c in SEPARATORS:
                out.append([("", COST_DROP), (" ", COST_BREAK)])
            else:
                out.append([(" ", 0.0)])
            i = j
        return out

    def restored(self, piece: str) -> str:
        """Viterbi over the lattice; states are the last two symbols."""
        if piece in self.seen:
            return self.seen[piece]
        best: dict[tuple[int, int], tuple[float, tuple]] = {(EDGE, EDGE): (0.0, ())}
        for choices in [*self.options(piece), [(" ", 0.0)]]:
            then: dict[tuple[int, int], tuple[float, tuple]] = {}
            for (a, b), (score, path) in best.items():
                for text, cost in choices:
                    x, y, value = a, b, score - cost
                    for c in text:
                        s = symbol(c)
                        if s != EDGE or y != EDGE:
                            value += self.model[x][y][s]
                            x, y = y, s
                    if (x, y) not in then or then[x, y][0] < value:
                        then[x, y] = value, (path, text)
            best = then
        path = max(best.values(), key=lambda v: v[0])[1]
        parts = []
        while path:
            path, text = path
            parts.append(text)
        out = "".join(reversed(parts))
        if len(self.seen) < self.MOST:
            self.seen[piece] = out
        return out

    def words(self, text: str | None) -> list[str]:
        """All words as written, then the words of the restored pieces."""
        text = (text or "").lower()
        out = WORD.findall(text)
        pieces = {m[0] for m in SPACED.finditer(text)}
        for token in set(text.split()):
            core = token.strip(".,;:?\"'()[]{}<>#%&*~^=`")
            if not core.isalpha() and disguised(core):
                pieces.add(core)
        hi = 0
        for m in REPEATED.finditer(text):
            if m.start() < hi:
                continue  # in the same token as the match before
            lo, hi = m.span()
            while lo and not text[lo - 1].isspace():
                lo -= 1
            while hi < len(text) and not text[hi].isspace():
                hi += 1
            pieces.add(text[lo:hi])
        for m in GROUPS.finditer(text):
            out += self.regrouped(WORD.findall(m[0]))
        for piece in sorted(pieces):
            out += WORD.findall(self.restored(piece))
        return out

    def regrouped(self, groups: list[str]) -> list[str]:
        """The words of three and more groups in the likeliest division into words."""
        best, first = [0.0], [0]
        for i in range(1, len(groups) + 1):
            choices = [(best[j] + self.likely("".join(groups[j:i])), j)
                       for j in range(max(0, i - MOST_GROUPS), i)]
            value, j = max(choices)
            best.append(value)
            first.append(j)
        out, i = [], len(groups)
        while i:
            if i - first[i] > 2:
                out.append("".join(groups[first[i]:i]))
            i = first[i]
        return out

    def likely(self, word: str) -> float:
        """Log-probability of a word and its end."""
        a = b = EDGE
        total = 0.0
        for c in word + " ":
            s = symbol(c)
            total += self.model[a][b][s]
            a, b = b, s
        return total


def disguised(token: str) -> bool:
    """Whether a token has marks or digits beside its letters."""
    return INNER.search(token) is not None


def features(word: str) -> list[str]:
    """The word itself and its beginnings."""
    return ["=" + word, *(word[:n] for n in BEGINNINGS if len(word) >= n)]


NAMES = ("some", "top", "total", "size")


@dataclass
class Model:
    characters: list
    odds: dict[str, float]  # log of the factor by which a feature raises the odds
    weights: list[float]  # of 1 and the evidence; the score's log-odds


def heads_of(odds: dict[str, float]) -> set[str]:
    """The first letters, as many as the shortest beginning has, of all words with a feature."""
    return {f.lstrip("=")[:BEGINNINGS[0]] for f in odds}


def evidence(words: list[str], odds: dict[str, float], heads: set[str]) -> tuple[float, ...]:
    """1, strongest feature, log(1 + sum of all), log(1 + words); all 0 without any feature."""
    top = total = 0.0
    distinct = set(words)
    for word in distinct:
        if word[:BEGINNINGS[0]] in heads:
            most = max(odds.get(f, 0.0) for f in features(word))
            top = max(top, most)
            total += most
    if not top:
        return (0.0,) * len(NAMES)
    return 1.0, top, math.log1p(total), math.log1p(len(distinct))


def fitted(rows: list[tuple[float, ...]]) -> list[float]:
    """Logistic regression by Newton steps, with a small penalty."""
    y = np.array([r[-1] for r in rows], float)
    if not len(y) or y.min() == y.max():
        share = min(max(float(y.mean()) if len(y) else 0.0, 1e-9), 1 - 1e-9)
        return [math.log(share / (1 - share))] + [0.0] * len(NAMES)
    x = np.array([(1.0, *r[:-1]) for r in rows])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = x.T * (p * (1 - p)) @ x + 0.1 * np.eye(len(w))
        w -= np.linalg.solve(step, x.T @ (p - y) + 0.1 * w)
    return w.tolist()


def learn(docs: DataFrame, labels: DataFrame, usable: Column, calibrate: Column) -> Model:
    """A model from the rows that are ``usable``; those to ``calibrate`` fit the weights only."""
    characters = character_model(character_counts(docs.where(usable)))
    known = labels.where(usable & F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"))
    rate = SAMPLE_ROWS / max(1, labels.count())
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(HASH_RANGE))
                         < min(HASH_RANGE, int(rate * HASH_RANGE)))
    # About SAMPLE_ROWS pairs of numbers, whatever the size of the tables.
    sample = docs.select("doc_id", "text", calibrate.alias("late")).join(
        F.broadcast(chosen), "doc_id")
    shared = docs.sparkSession.sparkContext.broadcast(characters)

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        channel = Channel(shared.value)
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1)):
                own = [(f, w) for w in set(channel.words(text.as_py())) for f in features(w)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f for f, _ in own], pa.string()),
                     pa.array([w for _, w in own], pa.string()),
                     pa.array([toxic.as_py()] * len(own), pa.int32())],
                    ["feature", "word", "toxic"])

    early, late = sample.where(~F.col("late")), sample.where("late")
    a, n = F.sum("toxic"), F.count("*")
    base = early.agg(F.avg("toxic")).first()[0] or 0.0
    share = (a + PRIOR_TEXTS * base) / (F.sum("n") + PRIOR_TEXTS)
    shares = early.select("text", "toxic").mapInArrow(
        held, "feature string, word string, toxic int").groupBy("feature", "word").agg(
        a.alias("toxic"), n.alias("n")).groupBy("feature").agg(
        a.alias("a"), share.alias("share"), n.alias("words")).where(
        (F.col("feature").startswith("=") | (F.col("words") >= LEAST_WORDS))
        & (F.col("a") >= LEAST_TEXTS) & (F.col("share") >= LEAST_SHARE) & (F.col("share") < 1))
    odds = {r["feature"]: math.log(r["share"] / (1 - r["share"])) - math.log(base / (1 - base))
            for r in shares.select("feature", "share").collect()} if 0 < base < 1 else {}
    model = Model(characters, {f: o for f, o in odds.items() if o > 0}, [])
    rows = evidence_of(late.select("text", "toxic"), model).select(*NAMES, "toxic")
    model.weights = fitted([tuple(r) for r in rows.collect()])
    return model


def evidence_of(rows: DataFrame, model: Model) -> DataFrame:
    """The rows' columns after the text, then the evidence."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        channel, odds = Channel(shared.value.characters), shared.value.odds
        heads = heads_of(odds)
        for batch in batches:
            found = [evidence(channel.words(t.as_py()), odds, heads) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *(pa.array([f[i] for f in found], pa.float64())
                                       for i in range(len(NAMES)))], [*rest, *NAMES])

    rest = rows.columns[1:]
    return rows.mapInArrow(run, T.StructType([
        *rows.schema.fields[1:], *(T.StructField(c, T.DoubleType()) for c in NAMES)]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""
    odds = F.lit(float(model.weights[0]))
    for name, weight in zip(NAMES, model.weights[1:]):
        odds = odds + F.lit(float(weight)) * F.col(name)
    return evidence_of(docs.select("text", "doc_id"), model).select(
        "doc_id", (1 / (1 + F.exp(-odds))).alias("score"))
