"""Ranked lexical search the other way round: documents stream through the items' index.

The items' terms, with their repeats, form an inverted index (term: items). It is built in blocks
of whole items, about ``POSTINGS`` postings and ``ITEMS`` items each; the blocks are counted
before one is collected and broadcast, so a broadcast is bounded whatever the number of items
(only a single item with more terms makes a larger one). Per block, one pass over the whole texts
keeps each document's length and its counts of indexed terms; their sums give the statistics of
the collection; then each task streams these counts through the index, adds up whole numbers, and
updates one heap of at most k documents per item. The heaps are merged in two steps.

Words are looked up by a 64-bit hash and compared with the term themselves.

Null texts, and texts without a term, have no part in any statistic and are never found. Items
without an id or a term find nothing; items that share an id are one item with the terms of both.
Every row of the documents is a candidate, so equal rows take a rank each; equal scores go by
ascending doc_id, rows without id last.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur.llm.common import written
from murmur.llm.tokens import NOT_ALNUM, Words, pieces, words

TOP = 20
POSTINGS, ITEMS = 1_000_000, 4096
#: Cells (documents times items, or postings) of one step of the scoring.
STEP = 2_000_000
#: Lists of tasks that are merged first, before an item's last merge.
SALTS = 64

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term, repeats."""
    terms = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), 0)
    return items.where("item_id IS NOT NULL").select(
        "item_id", F.explode(terms).alias("term")).groupBy("item_id", "term").agg(
        F.count("*").alias("repeats"))


def blocks_of(terms: DataFrame, postings: int = POSTINGS, items: int = ITEMS) -> DataFrame:
    """The terms with the number of a block, in which items are whole."""
    total, distinct = terms.agg(F.count("*"), F.count_distinct("item_id")).first()
    n = max(1, -(-total // postings), -(-distinct // items))
    while True:
        dealt = terms.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(n)).cast("int"))
        most = dealt.groupBy("block").agg(
            F.count("*").alias("p"), F.count_distinct("item_id").alias("i")).where(
            F.col("i") > 1).agg(F.max("p"), F.max("i")).first()
        if (most[0] or 0) <= 2 * postings and (most[1] or 0) <= 2 * items:
            return dealt
        n *= 2


class Index:
    """Terms by hash, and for each the items that hold it with their repeats."""

    def __init__(self, table: pa.Table) -> None:
        terms = table.column("term").combine_chunks().dictionary_encode()
        self.items = table.column("item_id").combine_chunks().unique()
        item = np.searchsorted(np.sort(self.items.to_numpy()), table.column("item_id").to_numpy())
        self.items = self.items.take(pa.compute.sort_indices(self.items))
        names = [t.encode() for t in terms.dictionary.to_pylist()]
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in names], dtype=np.int64)])
        hashes = words(np.frombuffer(b"".join(names), np.uint8), bounds, NOT_ALNUM).hashes
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.terms = hashes[order], [names[i] for i in order]
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        of = place[terms.indices.to_numpy()]
        by_term = np.argsort(of, kind="stable")
        self.starts = np.searchsorted(of[by_term], np.arange(len(names) + 1))
        self.item = item[by_term]
        self.repeats = table.column("repeats").to_numpy()[by_term]

    def tally(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bounds by document, indexed terms and their counts."""
        n, size = len(w.offsets) - 1, len(self.hashes)
        at = np.minimum(np.searchsorted(self.hashes, w.hashes), size - 1)
        hit = np.flatnonzero(self.hashes[at] == w.hashes)
        term, first = np.unique(at[hit], return_index=True)
        same = np.array([w.text(i, i + 1) == self.terms[t]
                         for t, i in zip(term.tolist(), hit[first].tolist())], bool)
        if not same.all():
            hit = hit[np.isin(at[hit], term[same])]
        key, counts = np.unique(w.document_of()[hit] * size + at[hit], return_counts=True)
        return np.searchsorted(key, np.arange(n + 1) * size), key % size, counts


def tallies(docs: DataFrame, index) -> DataFrame:
    """doc_id, n (terms with repeats), terms and counts (of the index) of rows with a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value
        for batch in batches:
            for lo, hi, data, bounds in pieces(batch.column(1)):
                w = words(data, bounds, NOT_ALNUM)
                cut, term, counts = known.tally(w)
                cut = pa.array(cut.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(w.offsets)),
                     pa.ListArray.from_arrays(cut, pa.array(term.astype(np.int32))),
                     pa.ListArray.from_arrays(cut, pa.array(counts))],
                    ["doc_id", "n", "terms", "counts"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n long, terms array<int>, counts array<long>").where("n > 0")


def weights(counted: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """N, L and the weight of each term of the index."""
    n, length = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = counted.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    out = np.zeros(size, np.int64)
    for term, df in zip(held.column("term").to_pylist(), held.column("count").to_pylist()):
        out[term] = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
    return n, length, out


class Heaps:
    """The k best documents of each item; the worst one is on top."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.best = k, [[] for _ in range(items)]
        self.least = np.ones(items, np.int64)  # scores below cannot enter

    def add(self, scores: np.ndarray, ids: list[int | None]) -> None:
        """Scores of documents (rows) for the items (columns)."""
        least = self.least
        if len(scores) > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=0)[-self.k])
        for d, i in np.argwhere(scores >= least).tolist():
            heap, doc = self.best[i], ids[d]
            entry = (int(scores[d, i]), doc is not None, -(doc or 0))
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.k:
                self.least[i] = heap[0][0]


def steps(postings: np.ndarray, width: int) -> Iterator[tuple[int, int]]:
    """Runs of documents whose postings and cells stay about ``STEP``; one document at least."""
    ends = np.cumsum(postings + width)
    lo = 0
    while lo < len(ends):
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + STEP, side="right")))
        yield lo, hi
        lo = hi


def best_of(counted: DataFrame, index, stats, k: int) -> DataFrame:
    """item_id, doc_id, score: the k best of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, (n_docs, length, weight) = index.value, stats.value
        width, sizes = len(known.items), np.diff(known.starts)
        heaps = Heaps(width, k)
        for batch in batches:
            ids, n, terms, counts = batch.columns
            cut = terms.offsets.to_numpy().astype(np.int64)
            cut -= cut[0]
            term, tf = terms.flatten().to_numpy(), counts.flatten().to_numpy()
            ids = ids.to_pylist()
            # Python numbers: 25 * n * N may pass 64 bits on the way.
            m = np.array([75 + 25 * x * n_docs // length for x in n.to_pylist()], np.int64)
            doc = np.repeat(np.arange(len(ids)), np.diff(cut))
            value = weight[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[doc]))
            ends = np.concatenate([[0], np.cumsum(sizes[term])])
            for lo, hi in steps(np.diff(ends[cut]), width):
                part = slice(cut[lo], cut[hi])
                each = sizes[term[part]]
                row = np.repeat(np.arange(len(each)), each)
                at = np.arange(len(row)) + np.repeat(
                    known.starts[term[part]] - (np.cumsum(each) - each), each)
                scores = np.zeros((hi - lo) * width, np.int64)
                np.add.at(scores, (doc[part][row] - lo) * width + known.item[at],
                          value[part][row] * known.repeats[at])
                heaps.add(scores.reshape(-1, width), ids[lo:hi])
        rows = [(i, x if there else None, score) for i, heap in enumerate(heaps.best)
                for score, there, x in heap]
        yield pa.RecordBatch.from_arrays(
            [known.items.take(pa.array([r[0] for r in rows], pa.int64())),
             pa.array([None if r[1] is None else -r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.int64())], ["item_id", "doc_id", "score"])

    return counted.mapInArrow(run, "item_id long, doc_id long, score long")


def merged(lists: DataFrame, k: int) -> DataFrame:
    """item_id, rank, doc_id, score from the tasks' lists."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    first = F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*order))
    last = F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    some = lists.withColumn("salt", F.spark_partition_id() % SALTS).withColumn(
        "rank", first).where(F.col("rank") <= k)
    return some.withColumn("rank", last).where(F.col("rank") <= k).select(
        "item_id", "rank", "doc_id", "score")


def search(items: DataFrame, docs: DataFrame, k: int = TOP, postings: int = POSTINGS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k best documents of every item."""
    spark = docs.sparkSession
    terms = written(blocks_of(written(item_terms(items.select(
        F.col("item_id").cast("long"), "text")), "terms"), postings), "blocks")
    found = None
    for block in [r[0] for r in terms.select("block").distinct().collect()]:
        index = Index(terms.where(F.col("block") == block).drop("block").toArrow())
        shared = spark.sparkContext.broadcast(index)
        counted = written(tallies(docs, shared), "tallies")
        stats = spark.sparkContext.broadcast(weights(counted, len(index.hashes)))
        lists = best_of(counted, shared, stats, k)
        found = lists if found is None else found.union(lists)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return merged(found, k)
