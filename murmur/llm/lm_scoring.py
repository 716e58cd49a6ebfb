"""Deleted interpolation: a bigram model whose weights depend on how frequent the context is.

p(w | v) = l0 / (V + 1) + l1 * c(w) / N + l2 * c(v w) / c(v), where the l belong to the bucket
(binary logarithm) of c(v). Counts are taken over all learning texts. The weights come from
expectation-maximisation on the held-out part of the learning texts: there the counts of the
others only are used, and what EM needs is a histogram of the three probabilities.

Texts are dealt by hash into blocks of about ``BLOCK`` bytes. A block sends its distinct
n-grams (sorted hashes and counts) once, cut into ranges of hashes that other tasks add up, and
gets the sums back in the same order; so an n-gram as common as any costs one entry a block,
and no table of counts is ever in one place. Words are told apart by 64-bit hashes, pairs of
words by 56 bits.

Tokens are the words of a lower-cased text (A-Z) and one end, which also is the context of the
first word. A null text is empty: one end. Rows are scored one by one; equal rows get equal
scores. Rows without id are not learned from. With nothing to learn from, N and V are 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur.llm.common import written
from murmur.llm.tokens import SPACE, mixed, pieces, words

BLOCK = 4 << 20
END = np.uint64(0xA0761D6478BD642F)
PAIR = np.uint64(0xE7037ED1A0B428DB)
PAIR_DROPS = np.uint64(8)  # bits of a pair's hash that are not kept
BUCKETS = 40
#: Steps of an octave in the histogram, and the mark of a zero probability.
STEPS, ZERO = 8, -(1 << 14)
ROUNDS = 30


def packed(values: np.ndarray) -> bytes:
    """Bytes of integers, the highest of all first; small values leave runs of zeros."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def unpacked(raw: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(raw, np.uint8).reshape(width, -1).T.copy().view(kind).reshape(-1)


@dataclass
class Block:
    """The tokens of a block's texts in order, and its distinct words and pairs."""

    doc: np.ndarray  # of each token
    grams: tuple[np.ndarray, np.ndarray]  # sorted distinct hashes of words, of pairs
    where: tuple[np.ndarray, np.ndarray]  # each token's place in these


def read_block(column: pa.ChunkedArray) -> Block:
    tokens, docs = [], []
    for lo, hi, data, bounds in pieces(column):
        w = words(data, bounds, SPACE)
        own = np.full(len(w.hashes) + hi - lo, END)
        own[np.arange(len(w.hashes)) + w.document_of()] = w.hashes
        tokens.append(own)
        docs.append(np.repeat(np.arange(lo, hi), np.diff(w.offsets) + 1))
    token, doc = np.concatenate(tokens), np.concatenate(docs)
    before = np.concatenate([[END], token[:-1]])  # what precedes a text is an end anyway
    pair = mixed(mixed(before * PAIR) + token) >> PAIR_DROPS
    w, at_w = np.unique(token, return_inverse=True)
    p, at_p = np.unique(pair, return_inverse=True)
    return Block(doc, (w, p), (at_w, at_p))


def cuts(grams: np.ndarray, order: int, bits: int) -> np.ndarray:
    """Bounds of the 2**bits ranges of sorted hashes."""
    width = 64 - (0, int(PAIR_DROPS))[order]
    starts = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(width - bits)
    return np.concatenate([[0], np.searchsorted(grams, starts), [len(grams)]])


def block_counts(table: pa.Table, bits: int) -> pa.Table:
    """Per order and range: the distinct n-grams of a block and their counts in learned texts."""
    block = read_block(table.column("text"))
    learned = table.column("learned").to_numpy()[block.doc]
    rows = []
    for order, (grams, where) in enumerate(zip(block.grams, block.where)):
        counts = np.bincount(where, learned, len(grams)).astype(np.uint32)
        cut = cuts(grams, order, bits)
        for part in np.flatnonzero(np.diff(cut)).tolist():
            own = grams[cut[part]:cut[part + 1]]
            steps = np.diff(own, prepend=np.uint64(0))
            rows.append((order, part, packed(steps), packed(counts[cut[part]:cut[part + 1]])))
    n = len(rows)
    return pa.table({
        "block": pa.array([table.column("block")[0].as_py()] * n, pa.int32()),
        "order": pa.array([r[0] for r in rows], pa.int32()),
        "part": pa.array([r[1] for r in rows], pa.int32()),
        "grams": pa.array([r[2] for r in rows], pa.binary()),
        "counts": pa.array([r[3] for r in rows], pa.binary())})


def part_totals(table: pa.Table) -> pa.Table:
    """For each block its n-grams' counts over all blocks, and over the held-out ones.

    Held-out blocks have negative numbers. One more row, without block, has the sums.
    """
    blocks = table.column("block").to_pylist()
    grams = [np.cumsum(unpacked(g.as_py(), np.uint64), dtype=np.uint64)
             for g in table.column("grams")]
    counts = np.concatenate([unpacked(c.as_py(), np.uint32) for c in table.column("counts")])
    held = np.repeat(np.array(blocks) < 0, [len(g) for g in grams])
    distinct, where = np.unique(np.concatenate(grams), return_inverse=True)
    total = np.bincount(where, counts, len(distinct)).astype(np.int64)
    apart = np.bincount(where, counts * held, len(distinct)).astype(np.int64)
    ends = np.cumsum([len(g) for g in grams])
    rows = [(b, packed(total[where[i:j]]), packed(apart[where[i:j]]) if b < 0 else None, None,
             None, None) for b, i, j in zip(blocks, ends - [len(g) for g in grams], ends)]
    rows.append((None, None, None, int(total.sum()), int((total > 0).sum()), int(apart.sum())))
    order, part = table.column("order")[0].as_py(), table.column("part")[0].as_py()
    columns = list(zip(*rows))
    return pa.table({
        "block": pa.array(columns[0], pa.int32()), "order": pa.array([order] * len(rows), pa.int32()),
        "part": pa.array([part] * len(rows), pa.int32()),
        "total": pa.array(columns[1], pa.binary()), "held": pa.array(columns[2], pa.binary()),
        "n": pa.array(columns[3], pa.int64()), "distinct": pa.array(columns[4], pa.int64()),
        "n_held": pa.array(columns[5], pa.int64())})


TOTALS = ("block int, order int, part int, total binary, held binary, n long, distinct long, "
          "n_held long")


@dataclass
class Corpus:
    """Learning tokens, distinct ones, and held-out tokens among the learning ones."""

    tokens: int
    distinct: int
    held: int


def token_counts(block: Block, totals: pa.Table, name: str) -> tuple[np.ndarray, ...]:
    """Counts of each token's word, pair and context."""
    by_order: list[list[tuple[int, bytes]]] = [[], []]
    for order, part, raw in zip(*(totals.column(c).to_pylist() for c in ("order", "part", name))):
        by_order[order].append((part, raw))
    word, pair = (np.concatenate([unpacked(raw, np.int64) for _, raw in sorted(own)])[where]
                  for own, where in zip(by_order, block.where))
    # Every text ends with an end, so the token before a text is one, cyclically.
    return word, pair, np.concatenate([word[-1:], word[:-1]])


def bucket(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2)."""
    return np.minimum(np.frexp(context.astype(np.float64))[1], BUCKETS - 1)


def parts_of(word: np.ndarray, pair: np.ndarray, context: np.ndarray, n: int,
             distinct: int) -> np.ndarray:
    """The three probabilities of every token."""
    out = np.zeros((3, len(word)))
    out[0] = 1 / (distinct + 1)
    if n:
        out[1] = word / n
    np.divide(pair, context, out=out[2], where=context > 0)
    return out


def held_histogram(docs: pa.Table, totals: pa.Table, corpus: Corpus) -> pa.Table:
    """bucket, level1, level2, n: held-out tokens under the counts of the other texts."""
    block = read_block(docs.column("text"))
    word, pair, context = (a - b for a, b in zip(
        token_counts(block, totals, "total"), token_counts(block, totals, "held")))
    probs = parts_of(word, pair, context, corpus.tokens - corpus.held, corpus.distinct)
    with np.errstate(divide="ignore"):
        levels = np.where(probs[1:] > 0, np.rint(np.log2(probs[1:] / probs[0]) * STEPS), ZERO)
    cells, n = np.unique(np.stack([bucket(context), *levels.astype(np.int64)]), axis=1,
                         return_counts=True)
    return pa.table({"bucket": cells[0], "level1": cells[1], "level2": cells[2], "n": n})


def learned_weights(cells: list[tuple[int, int, int, int]]) -> np.ndarray:
    """EM: weights by bucket; buckets without tokens take those of the next lower one."""
    out = np.full((BUCKETS, 3), 1 / 3)
    cells = np.array(cells, np.float64).reshape(-1, 4)
    for b in range(BUCKETS):
        own = cells[cells[:, 0] == b]
        if not len(own):
            out[b] = out[max(0, b - 1)]
            continue
        ratio = np.ones((3, len(own)))
        ratio[1:] = np.where(own[:, 1:3].T == ZERO, 0, 2.0 ** (own[:, 1:3].T / STEPS))
        weight = out[b]
        for _ in range(ROUNDS):
            share = weight[:, None] * ratio
            weight = (share / share.sum(axis=0) * own[:, 3]).sum(axis=1) / own[:, 3].sum()
        out[b] = np.maximum(weight, 1e-9)  # no token may become impossible
        out[b] /= out[b].sum()
    return out


def block_scores(docs: pa.Table, totals: pa.Table, corpus: Corpus, weights: np.ndarray) -> pa.Table:
    block = read_block(docs.column("text"))
    word, pair, context = token_counts(block, totals, "total")
    probs = parts_of(word, pair, context, corpus.tokens, corpus.distinct)
    model = np.log10((weights[bucket(context)].T * probs).sum(axis=0))
    base = np.log10((word + 0.1) / (corpus.tokens + 0.1 * (corpus.distinct + 1)))
    n = docs.num_rows
    return pa.table({
        "doc_id": docs.column("doc_id"), "n_tokens": np.bincount(block.doc, minlength=n),
        "n_known": np.bincount(block.doc, word > 0, n).astype(np.int64),
        "train_tokens": np.full(n, corpus.tokens),
        "base_score": np.bincount(block.doc, base, n), "score": np.bincount(block.doc, model, n)})


def score(docs: DataFrame, learned: Column, held: Column) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row.

    ``learned`` marks the rows whose counts make the model, ``held`` those of them that are
    held out to learn the weights.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK))
    bits = (blocks - 1).bit_length()
    own = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))
    apart = F.coalesce(learned & held, F.lit(False))
    dealt = docs.select("doc_id", "text", F.coalesce(learned, F.lit(False)).alias("learned"),
                        F.when(apart, -1 - own).otherwise(own).cast("int").alias("block"))

    counts = dealt.select("text", "learned", "block").groupBy("block").applyInArrow(
        lambda t: block_counts(t, bits),
        "block int, order int, part int, grams binary, counts binary")
    totals = written(counts.groupBy("order", "part").applyInArrow(part_totals, TOTALS), "counts")

    sums = totals.where("block IS NULL AND order = 0").agg(
        F.sum("n"), F.sum("distinct"), F.sum("n_held")).first()
    corpus = Corpus(*(int(x or 0) for x in sums))
    by_block = totals.where("block IS NOT NULL").select("block", "order", "part", "total", "held")
    # A histogram: its size is bounded by the buckets and levels.
    cells = dealt.where("block < 0").select("text", "block").groupBy("block").cogroup(
        by_block.where("block < 0").groupBy("block")).applyInArrow(
        lambda a, b: held_histogram(a, b, corpus),
        "bucket long, level1 long, level2 long, n long").groupBy(
        "bucket", "level1", "level2").agg(F.sum("n"))
    weights = learned_weights([tuple(r) for r in cells.collect()])

    kept = T.StructType([docs.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in (
        "n_tokens", "n_known", "train_tokens")), *(T.StructField(c, T.DoubleType()) for c in (
            "base_score", "score"))])
    return dealt.select("doc_id", "text", "block").groupBy("block").cogroup(
        by_block.drop("held").groupBy("block")).applyInArrow(
        lambda a, b: block_scores(a, b, corpus, weights), kept)
