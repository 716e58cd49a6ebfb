"""Benchmark decontamination: runs of N words that a benchmark item shares with a document.

Items are cut into windows of ``WINDOW`` words (a shorter item is one window). A window is
looked up by the 64-bit hash of its words and a hit is verified word by word. The windows go to
every task as a broadcast set. Pairs of a window and an item that has it are counted first: more
than ``MAX_PAIRS`` are dealt by hash into blocks, the whole documents are scanned once a block,
and the hits of a row are merged. The result is the same, spans included.

A null or empty text has no words and no hits; rows are judged one by one, so repeated rows get
equal results. An item without id marks words but is not listed. Empty tables give no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur.llm.common import row_key, written
from murmur.llm.tokens import NOT_ALNUM, Words, pieces, rolled, words

WINDOW = 10
MAX_PAIRS = 1_000_000

FOUND = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
         T.StructField("items", T.ArrayType(T.StringType())),
         T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType())))]


def texts_of(column: pa.Array) -> Iterator[tuple[int, Words]]:
    for lo, _, data, bounds in pieces(column):
        yield lo, words(data, bounds, NOT_ALNUM)


def item_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """Distinct pairs of a window and an item: length, hash, words, item_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            ids = batch.column(0).to_pylist()
            for lo, w in texts_of(batch.column(1)):
                for d in range(len(w.offsets) - 1):
                    start, end = int(w.offsets[d]), int(w.offsets[d + 1])
                    n = min(size, end - start)
                    for i in range(start, end - n + 1 if n else start):
                        rows.append((ids[lo + d], n, w.text(i, i + n), w.hashes[i:i + n]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()),
                 pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([int(window_hash(r[3])) for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.binary())],
                ["item_id", "length", "hash", "words"])

    rows = benchmark.select(F.col("item_id").cast("string"), "text").mapInArrow(
        run, "item_id string, length int, hash long, words binary")
    return rows.distinct()


def window_hash(hashes: np.ndarray) -> np.int64:
    return rolled(hashes, len(hashes)).view(np.int64)[0]


class WindowSet:
    """Windows by length and hash, made once per task from the broadcast rows."""

    def __init__(self, rows: list[tuple]) -> None:
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.known: dict[tuple[int, int], dict[bytes, list[str]]] = {}
        for length, h, text, item in rows:
            items = self.known.setdefault((length, h), {}).setdefault(bytes(text), [])
            if item is not None:
                items.append(item)
        for length in sorted({k[0] for k in self.known}):
            own = np.sort(np.array([h for n, h in self.known if n == length], np.int64))
            marks = np.zeros(1 << max(16, (8 * len(own)).bit_length()), bool)
            marks[own & (len(marks) - 1)] = True
            self.by_length[length] = own, marks

    def hits(self, w: Words) -> Iterator[tuple[int, int, list[str]]]:
        """First word, length and items of every window that occurs."""
        for length, (own, marks) in self.by_length.items():
            at, found = w.windows(length)
            found = found.view(np.int64)
            maybe = np.flatnonzero(marks[found & (len(marks) - 1)])
            near = np.minimum(np.searchsorted(own, found[maybe]), len(own) - 1)
            maybe = maybe[own[near] == found[maybe]]
            for i, h in zip(at[maybe].tolist(), found[maybe].tolist()):
                text = w.text(i, i + length)
                if text in self.known[length, h]:
                    yield i, length, self.known[length, h][text]


def judged(w: Words, windows: WindowSet) -> list[tuple[int, list[str], list[list[int]]]]:
    """n_words, items and ranges of hit words of each document."""
    n = len(w.offsets) - 1
    covered = np.zeros(len(w.starts) + 1, np.int32)
    items: dict[int, set[str]] = {}
    for i, length, ids in windows.hits(w):
        covered[i] += 1
        covered[i + length] -= 1
        items.setdefault(int(np.searchsorted(w.offsets, i, side="right")) - 1, set()).update(ids)
    sizes = np.diff(w.offsets).tolist()
    out: list[tuple[int, list[str], list[list[int]]]] = [(size, [], []) for size in sizes]
    hit = np.cumsum(covered[:-1]) > 0
    for d, ids in items.items():
        lo, hi = int(w.offsets[d]), int(w.offsets[d + 1])
        out[d] = sizes[d], sorted(ids), ranges(w, hit[lo:hi], lo, d)
    return out


def ranges(w: Words, hit: np.ndarray, lo: int, d: int) -> list[list[int]]:
    """First word, end word, first code point, end code point of runs of hit words."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    out, seen, at = [], int(w.bounds[d]), 0
    for i, j in zip(edge[::2].tolist(), edge[1::2].tolist()):
        places = []
        for byte in (int(w.starts[lo + i]), int(w.ends[lo + j - 1])):
            at += len(w.data[seen:byte].tobytes().decode("utf-8", "ignore"))
            seen = byte
            places.append(at)
        out.append([i, j, *places])
    return out


def joined(parts: list[list[list[int]]]) -> list[list[int]]:
    """The ranges of several blocks as ranges of all hit words."""
    out: list[list[int]] = []
    for first, end, start, stop in sorted(r for part in parts for r in part):
        if out and first <= out[-1][1]:
            if end > out[-1][1]:
                out[-1][1], out[-1][3] = end, stop
        else:
            out.append([first, end, start, stop])
    return out


def window_set(benchmark: DataFrame, size: int = WINDOW, most: int = MAX_PAIRS) -> DataFrame:
    """The windows of the items, and the block of each; a block has about ``most`` pairs at most."""
    pairs = written(item_windows(benchmark, size), "windows")
    n = max(1, -(-pairs.count() // most))
    mine = F.xxhash64("length", "hash", "words", "item_id")
    return pairs.withColumn("block", F.pmod(mine, F.lit(n)).cast("int"))


def blocks_of(windows: DataFrame) -> list[int]:
    return sorted(r[0] for r in windows.select("block").distinct().collect())


def shared(windows: DataFrame, block: int) -> Broadcast:
    rows = windows.where(F.col("block") == block).select("length", "hash", "words", "item_id")
    return windows.sparkSession.sparkContext.broadcast([tuple(r) for r in rows.collect()])


RANGES = T.StructField("ranges", T.ArrayType(T.ArrayType(T.LongType())))
ARROW = {"n_words": pa.int64(), "n_hit": pa.int64(), "items": pa.list_(pa.string()),
         "ranges": pa.list_(pa.list_(pa.int64())), "spans": pa.list_(pa.list_(pa.int64()))}


def block_hits(rows: DataFrame, windows: Broadcast, all_rows: bool) -> DataFrame:
    """The columns after the text, n_words, items and ranges; of every row, or those with a hit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WindowSet(windows.value)
        for batch in batches:
            found = [r for _, w in texts_of(batch.column(0)) for r in judged(w, known)]
            out = pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *(pa.array([r[i] for r in found], ARROW[c])
                                       for i, c in enumerate(("n_words", "items", "ranges")))],
                [*rest, "n_words", "items", "ranges"])
            yield out if all_rows else out.filter(pa.array([len(r[2]) > 0 for r in found], pa.bool_()))

    rest = rows.columns[1:]
    return rows.mapInArrow(run, T.StructType(
        [*rows.schema.fields[1:], FOUND[0], FOUND[2], RANGES]))


def later_hits(docs: DataFrame, windows: DataFrame, blocks: list[int]) -> DataFrame:
    """key and parts (block, items, ranges) of the rows that have hits in some of the blocks."""
    keyed = docs.select("text", row_key(F.col("doc_id"), F.col("text")).alias("key"))
    found = None
    for block in blocks:
        sent = shared(windows, block)
        part = written(block_hits(keyed, sent, False).select(
            "key", F.struct(F.lit(block).alias("block"), "items", "ranges").alias("part")), "hits")
        sent.unpersist()
        found = part if found is None else found.unionByName(part)
    # Equal rows have equal parts, so a key gathers one part per block, however many rows it has.
    return found.groupBy("key").agg(F.collect_set("part").alias("parts"))


def scan(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted ids) and hit spans (code points) of every row."""
    first, *later = blocks_of(windows) or [0]
    rows = docs.select("text", "doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"))
    found = block_hits(rows, shared(windows, first), True)
    none = F.array().cast("array<struct<block:int,items:array<string>,ranges:array<array<bigint>>>>")
    if later:
        found = found.join(later_hits(docs, windows, later), "key", "left")
    else:
        found = found.withColumn("parts", none)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, hit = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for i, parts in enumerate(batch.column(4).to_pylist()):
                if parts:
                    items[i] = sorted({x for own in [items[i], *(p["items"] for p in parts)]
                                       for x in own})
                    hit[i] = joined([hit[i], *(p["ranges"] for p in parts)])
            columns = {"n_hit": [sum(r[1] - r[0] for r in own) for own in hit], "items": items,
                       "spans": [[r[2:] for r in own] for own in hit]}
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(v, ARROW[c]) for c, v in columns.items())],
                ["doc_id", *(f.name for f in FOUND)])

    return found.select("doc_id", "n_words", "items", "ranges", "parts").mapInArrow(
        run, T.StructType([docs.schema["doc_id"], *FOUND]))


def clean(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """The rows without any hit, with all their columns."""
    first, *later = blocks_of(windows) or [0]
    sent, at = shared(windows, first), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WindowSet(sent.value)
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for lo, w in texts_of(batch.column(at)):
                for i, _, _ in known.hits(w):
                    keep[lo + int(np.searchsorted(w.offsets, i, side="right")) - 1] = False
            yield batch.filter(pa.array(keep))

    out = docs.mapInArrow(run, docs.schema)
    if not later:
        return out
    bad = later_hits(docs, windows, later).select(F.col("key").alias("__bad"))
    return out.join(bad, row_key(F.col("doc_id"), F.col("text")) == F.col("__bad"), "left_anti")
