"""Spelling variants: words one edit apart, found by products of letter-count blocks.

A word's vector counts its letters. An inserted or deleted letter changes the squared distance of
two vectors to 1, a replaced one to 2; lengths differ by at most one. So pairs at most two apart
in blocks of equal or adjacent length hold every pair that is one edit apart, and an exact
comparison of the letters decides.

A block is not only a length: the letters are dealt into ``CLASSES`` classes by code point, and a
block holds the words with equal counts of every class (which fix the length). One edit adds a
letter to one class, or moves one between two, so every word meets its own block and
1 + CLASSES + CLASSES * (CLASSES - 1) / 2 others or fewer; each pair of blocks meets once. A
block's own words and its visitors are cut by hash into ``OWN`` and ``VISITING`` at most, so one
frequent pattern is many groups, and a group compares its parts by NumPy products of ``CHUNK``
columns. A group returns a count and the best near word per word, never pairs.

Words are counted per task before the exchange. A null text has no words; a row without an id
takes the empty text for it; repeated rows count each time. Equal counts go to the smaller word
in code-point order.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import slices, written
from murmur.llm.tokens import mixed, pieces

#: Of the words: fewest code points, fewest occurrences, and how much commoner a form is.
LENGTH, OCCURRENCES, RATIO = 6, 5, 5
#: One of so many (document, word) pairs loses a letter.
EVERY = 199
#: Words that a task counts before it hands the counts on.
HELD = 500_000

CLASSES = 5
OWN, VISITING, CHUNK = 8192, 65_536, 1024
#: What a letter of each class adds to the number of a block. No two moves between blocks, nor a
#: move and the way back, are equal (tested), so a pair of words meets in one block only.
STEPS = mixed(~mixed(np.arange(1, CLASSES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))

RUN = re.compile("[a-zÀ-ÿ]+")
NOT_RUN = re.compile("[^a-zÀ-ÿ]")


def without_letter(word: str, seed: int) -> str:
    """The word, or for one of ``EVERY`` seeds the word without a letter."""
    number = zlib.crc32(word.encode(), seed)
    if number % EVERY:
        return word
    at = number % len(word)
    return word[:at] + word[at + 1:]


def document_words(doc_id: object, text: str) -> Counter[str]:
    """The words of a lower-cased text with their occurrences."""
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    runs: Counter[str] = Counter()
    for part in slices(text, NOT_RUN):
        runs.update(RUN.findall(part))
    out: Counter[str] = Counter()
    for run, n in runs.items():
        out[without_letter(run, seed)] += n
    return out


def counted(docs: DataFrame, length: int = LENGTH, occurrences: int = OCCURRENCES) -> DataFrame:
    """word, n of the words that are long and frequent enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for lo, hi, data, bounds in pieces(batch.column(1)):
                for d in range(hi - lo):
                    text = data[bounds[d]:bounds[d + 1]].tobytes().lower().decode("utf-8", "replace")
                    for word, n in document_words(ids[lo + d], text).items():
                        if len(word) >= length:
                            held[word] += n
                    if len(held) > HELD:
                        yield of_counts(held)
                        held.clear()
        yield of_counts(held)

    return docs.select("doc_id", "text").mapInArrow(run, "word string, n long").groupBy(
        "word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


def of_counts(counts: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
        ["word", "n"])


def letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Letters (code points below 256) of all words in a row, and the word of each."""
    text = [w.encode("latin-1") for w in column.to_pylist()]
    sizes = np.fromiter(map(len, text), np.int64, len(text))
    return np.frombuffer(b"".join(text), np.uint8), np.repeat(np.arange(len(text)), sizes)


def moves() -> np.ndarray:
    """What the blocks that a word visits add to its own; the own block is the first."""
    lower, upper = np.triu_indices(CLASSES, 1)
    return np.concatenate([np.zeros(1, np.uint64), STEPS, STEPS[upper] - STEPS[lower]])


def visits(words: DataFrame) -> DataFrame:
    """word, n, block, own: every word in its own block and in those it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = moves()
        for batch in batches:
            letter, word = letters(batch.column(0))
            block = np.zeros(batch.num_rows, np.uint64)
            np.add.at(block, word, STEPS[letter % CLASSES])
            for k, move in enumerate(to):
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array((block + move).view(np.int64)),
                     pa.array(np.full(batch.num_rows, k == 0))], ["word", "n", "block", "own"])

    return words.select("word", "n").mapInArrow(
        run, "word string, n long, block long, own boolean")


def dealt(rows: DataFrame, own: int = OWN, visiting: int = VISITING) -> DataFrame:
    """word, n, own, block, a, b, owner: the rows of each pair of a block's parts."""
    sizes = rows.groupBy("block").agg(F.count_if("own").alias("o"), F.count("*").alias("v"))
    sizes = sizes.where("o > 0 AND v > 1").select(
        F.col("block").alias("at"), F.ceil(F.col("o") / own).cast("int").alias("parts_a"),
        F.ceil(F.col("v") / visiting).cast("int").alias("parts_b"))
    mine = F.xxhash64("word")
    a, b = F.pmod(mine, F.col("parts_a")).cast("int"), F.pmod(mine, F.col("parts_b")).cast("int")
    visitor = F.transform(F.sequence(F.lit(0), F.col("parts_a") - 1), lambda x: F.struct(
        x.alias("a"), b.alias("b"), F.lit(False).alias("owner")))
    owner = F.transform(F.sequence(F.lit(0), F.col("parts_b") - 1), lambda x: F.struct(
        a.alias("a"), x.alias("b"), F.lit(True).alias("owner")))
    to = F.when(F.col("own"), F.concat(visitor, owner)).otherwise(visitor)
    return rows.join(sizes, F.col("block") == F.col("at")).select(
        "word", "n", "own", "block", F.inline(to)).repartition("block", "a", "b")


def one_edit(x: str, y: str) -> bool:
    """Whether one inserted, deleted or replaced letter makes y of x."""
    if x == y or abs(len(x) - len(y)) > 1:
        return False
    i, least = 0, min(len(x), len(y))
    while i < least and x[i] == y[i]:
        i += 1
    j = 0
    while j < least - i and x[-1 - j] == y[-1 - j]:
        j += 1
    return i + j >= max(len(x), len(y)) - 1


def gram_pairs(x: np.ndarray, y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of x and y whose squared distance is 1 or 2 (0 has no single edit)."""
    xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
    for lo in range(0, len(y), CHUNK):
        part = slice(lo, lo + CHUNK)
        square = xx[:, None] + yy[part] - 2 * (x @ y[part].T)
        i, j = np.nonzero((square > 0.5) & (square < 2.5))
        yield i, j + lo


def vectors(column: pa.Array, alphabet: np.ndarray) -> np.ndarray:
    letter, word = letters(column)
    size = len(alphabet)
    place = np.searchsorted(alphabet, letter)
    counts = np.bincount(word * size + place, minlength=len(column) * size).reshape(-1, size)
    # Sums of squares below 2**24 are exact in single precision.
    small = not len(letter) or np.bincount(word).max() < 2000
    return counts.astype(np.float32 if small else np.float64)


def near_words(table: pa.Table) -> pa.Table:
    """word, n_near, best (less: -n, word) of the words of one pair of parts."""
    rows = [table.filter(pa.compute.field("owner") == flag) for flag in (True, False)]
    (xs, xn), (ys, yn) = ((t.column("word").to_pylist(), t.column("n").to_pylist()) for t in rows)
    own = rows[1].column("own").to_pylist()
    found: dict[str, tuple[int, tuple[int, str]]] = {}

    def note(word: str, near: tuple[int, str]) -> None:
        count, best = found.get(word, (0, near))
        found[word] = count + 1, min(best, near)

    if xs and ys:
        words = [t.column("word").combine_chunks() for t in rows]
        alphabet = np.unique(np.concatenate([letters(w)[0] for w in words]))
        for i, j in gram_pairs(*(vectors(w, alphabet) for w in words)):
            for p, q in zip(i.tolist(), j.tolist()):
                if one_edit(xs[p], ys[q]):
                    note(xs[p], (-yn[q], ys[q]))
                    if not own[q]:  # words of one block meet in both orders
                        note(ys[q], (-xn[p], xs[p]))
    return pa.table({
        "word": pa.array(list(found), pa.string()),
        "n_near": pa.array([c for c, _ in found.values()], pa.int64()),
        "less": pa.array([b[0] for _, b in found.values()], pa.int64()),
        "near": pa.array([b[1] for _, b in found.values()], pa.string())})


def forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n of every word."""
    near = dealt(visits(words)).groupBy("block", "a", "b").applyInArrow(
        near_words, "word string, n_near long, less long, near string")
    alone = words.select("word", "n", F.lit(0).cast("long").alias("n_near"),
                         F.lit(None).cast("long").alias("less"), F.lit(None).cast("string").alias("near"))
    every = alone.unionByName(near.withColumn("n", F.lit(None).cast("long"))).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"),
        F.min(F.when(F.col("near").isNotNull(), F.struct("less", "near"))).alias("best"))
    is_form = -F.col("best.less") >= ratio * F.col("n")
    return every.select("word", "n", "n_near", F.when(is_form, F.col("best.near")).alias("form"),
                        F.when(is_form, -F.col("best.less")).alias("form_n"))


def with_roots(found: DataFrame) -> DataFrame:
    """The rows with root, the last form of the chain. Each step of a chain multiplies n, so
    chains are short, and each round doubles the steps that are followed."""
    ups = written(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        above = ups.select(F.col("word").alias("root"), F.col("root").alias("above"))
        further = written(ups.join(above, "root", "left"), "roots")
        if not further.where("above IS NOT NULL").take(1):
            break
        ups = further.select("word", F.coalesce("above", "root").alias("root"))
    return found.join(ups, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the texts."""
    words = written(counted(docs), "words")
    return with_roots(written(forms(words), "forms")).select(
        "word", "form", "root", "n", "n_near", "form_n")
