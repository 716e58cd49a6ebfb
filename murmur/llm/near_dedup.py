"""Near duplicates: fast similarity sketches, banding, exact overlaps in tiles.

A document's set holds its distinct runs of five words (a shorter text is one run), as 64-bit
hashes; documents with equal sets form one class. A class has a sketch of ``COORDINATES``
values, filled in rounds: in round i every element goes to one hashed bin and a bin keeps the
least (round, value); the element-to-bin choice is free in the first t rounds and fixed to bin
i - t in the next t, so that no bin stays empty. Equal bands of ``ROWS`` coordinates make
candidates: a link of similarity 0.75 is missed with probability (1 - 0.75**4)**32 = 5e-6.

Every class of a bucket is tied to the bucket's first one, and the components of these ties
are the candidate clusters. A cluster is cut into tiles of about ``TILE`` classes, and each
pair of tiles counts all overlaps of its full sets in one matrix product, so every candidate
pair is decided exactly and only links that join two parts are emitted, never all pairs.

Class ids are 64-bit hashes of the whole set: n different documents meet by chance with
probability n*n / 2**65. A null or blank text has the empty set and is linked with nothing.
The component of a document is its smallest doc_id (nulls last); the query calls every row kept
whose id is that of its component. The column ``kept`` of ``groups`` holds for exactly one row of
each component, the one with the least (doc_id, key): of rows that repeat each other any one, of
a group without ids the one with the least key. Rows with the empty set are all kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur.llm.common import row_key, written
from murmur.llm.components import components
from murmur.llm.tokens import SPACE, Words, mixed, pieces, rolled, words

SHINGLE = 5
COORDINATES, ROWS = 128, 4
PERCENT = 75
TILE = 256
#: Columns of one matrix product.
COLUMNS = 8192

SEED_NUMBER = 0x9FB21C651E98DF25
SEED = np.uint64(SEED_NUMBER)
UNSET = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingles(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Documents and hashes of the distinct shingles, in this order, and bounds by document."""
    at, hashes = w.windows(SHINGLE)
    doc = w.document_of()[at] if len(at) else at
    sizes = np.diff(w.offsets)
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    if len(short):
        own = [rolled(w.hashes[w.offsets[d]:w.offsets[d + 1]], int(sizes[d]))[0] for d in short]
        doc = np.concatenate([doc, short])
        hashes = np.concatenate([hashes, np.array(own, np.uint64)])
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    hashes = hashes[new]
    return hashes, np.searchsorted(doc[new], np.arange(len(sizes) + 1))


def sketches(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of COORDINATES values per set; rows of empty sets stay unset."""
    sizes = np.diff(bounds)
    t = COORDINATES
    out = np.full((len(sizes), t), UNSET)
    flat = out.reshape(-1)
    live = np.repeat(np.arange(len(sizes)), sizes)
    for i in range(2 * t):
        h = mixed(hashes + np.uint64((i + 1) * SEED_NUMBER & (1 << 64) - 1))
        to = (h & np.uint64(t - 1)).astype(np.int64) if i < t else i - t
        np.minimum.at(flat, live * t + to, np.uint64(i << 56) | (h >> np.uint64(8)))
        open_sets = (out == UNSET).any(axis=1)
        more = open_sets[live]
        if not more.any():
            break
        live, hashes = live[more], hashes[more]
    return out


def bands(sketch: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bands of each sketch; the band's number is part of it."""
    parts = sketch.reshape(len(sketch), -1, ROWS)
    out = np.broadcast_to(np.arange(1, parts.shape[1] + 1, dtype=np.uint64), parts.shape[:2])
    for r in range(ROWS):
        out = mixed(out * SEED + parts[:, :, r])
    return out


def profiles(docs: DataFrame) -> DataFrame:
    """doc_id, key, set_id, n_shingles, bands of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in pieces(batch.column(2)):
                hashes, cut = shingles(words(data, bounds, SPACE))
                n = np.diff(cut)
                sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes * SEED))])
                ids = mixed(sums[cut[1:]] - sums[cut[:-1]] + n.astype(np.uint64))
                band = bands(sketches(hashes, cut)).view(np.int64)
                ends = np.arange(0, band.size + 1, band.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                     pa.array(ids.view(np.int64)), pa.array(n),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(band.reshape(-1)))],
                    ["doc_id", "key", "set_id", "n_shingles", "bands"])

    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("key", T.BinaryType()),
        T.StructField("set_id", T.LongType()), T.StructField("n_shingles", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType()))])
    keyed = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    return keyed.mapInArrow(run, schema)


def ties(classes: DataFrame) -> DataFrame:
    """a, b: each class of a bucket and the first class of the bucket."""
    rows = classes.select("set_id", F.explode("bands").alias("band"))
    first = rows.groupBy("band").agg(
        F.min("set_id").alias("b"), F.max("set_id").alias("last")).where("b <> last")
    return rows.join(first.select("band", "b"), "band").select(
        F.col("set_id").alias("a"), "b").where("a <> b").distinct()


def full_sets(rows: DataFrame) -> DataFrame:
    """The rows' own columns, with the text replaced by its set (64-bit hashes, sorted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in pieces(batch.column(0)):
                hashes, cut = shingles(words(data, bounds, SPACE))
                sets = [hashes[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:])]
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sets, pa.binary()), *part.columns[1:]], ["shingles", *rest])

    rest = rows.columns[1:]
    return rows.mapInArrow(run, T.StructType(
        [T.StructField("shingles", T.BinaryType()), *rows.schema.fields[1:]]))


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of left and right sets."""
    out = np.zeros((len(left), len(right)), np.float32)
    sides = [(np.concatenate(s), np.repeat(np.arange(len(s)), [len(x) for x in s]))
             for s in (left, right)]
    shared = np.intersect1d(sides[0][0], sides[1][0])
    if left is right:  # only what at least two sets hold can join two of them
        values, n = np.unique(sides[0][0], return_counts=True)
        shared = values[n > 1]
    for k in range(0, len(shared), COLUMNS):
        columns = shared[k:k + COLUMNS]
        tiles = []
        for values, row in sides:
            at = np.minimum(np.searchsorted(columns, values), len(columns) - 1)
            held = columns[at] == values
            tile = np.zeros((row[-1] + 1, len(columns)), np.float32)
            tile[row[held], at[held]] = 1
            tiles.append(tile)
        out += tiles[0] @ tiles[1].T  # counts below 2**24 are exact
    return out


def tile_links(table: pa.Table) -> pa.Table:
    """a, b: links that join the parts of one pair of tiles."""
    ids = table.column("set_id").to_numpy()
    tile = table.column("tile").to_numpy()
    sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
    low, high = (np.flatnonzero(tile == t) for t in (tile.min(), tile.max()))
    left = [sets[i] for i in low]
    right = left if low is high or tile.min() == tile.max() else [sets[i] for i in high]
    common = overlaps(left, right)
    n, m = (np.array([len(s) for s in side], np.int64) for side in (left, right))
    common = common.astype(np.int64)
    linked = 100 * common >= PERCENT * (n[:, None] + m[None, :] - common)
    root = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for i, j in np.argwhere(linked):
        a, b = int(ids[low[i]]), int(ids[high[j]])
        ra, rb = find(a), find(b)
        if ra != rb:
            root[ra] = rb
            out.append((a, b))
    return pa.table({"a": pa.array([x[0] for x in out], pa.int64()),
                     "b": pa.array([x[1] for x in out], pa.int64())})


def links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """a, b: links between classes, enough to join every component."""
    clusters = components(ties(classes))
    sizes = clusters.groupBy("root").agg(F.count("*").alias("size"))
    placed = clusters.join(sizes, "root").withColumn(
        "tiles", F.ceil(F.col("size") / TILE)).withColumn(
        "tile", F.pmod(F.xxhash64("id"), F.col("tiles")))
    members = classes.select("set_id", "key").join(
        placed, placed["id"] == classes["set_id"]).select("key", "set_id", "root", "tiles", "tile")
    # One row of each key: repeats are merged before the exchange.
    texts = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    texts = texts.dropDuplicates(["key"]).join(members, "key").select("text", "set_id", "root", "tiles", "tile")
    pairs = full_sets(texts).withColumn("other", F.explode(F.sequence(
        F.lit(0), F.col("tiles") - 1))).withColumns(
        {"low": F.least("tile", "other"), "high": F.greatest("tile", "other")})
    return pairs.groupBy("root", "low", "high").applyInArrow(tile_links, "a long, b long")


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, key, n_shingles, component_id, kept of every row."""
    # Numbers of the rows; they stay as written, so repeats of a row can be told apart.
    rows = written(profiles(docs).withColumn("at", F.monotonically_increasing_id()), "profiles")
    first = F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "key", "at")
    classes = rows.where("n_shingles > 0").groupBy("set_id").agg(
        F.min(first).alias("first"), F.first("bands").alias("bands")).withColumn(
        "key", F.col("first.key"))
    classes = written(classes, "classes")
    roots = components(links(docs, classes))
    firsts = classes.select("set_id", "first")
    joined = roots.join(firsts, roots["id"] == firsts["set_id"])
    least = joined.groupBy("root").agg(F.min("first").alias("least"))
    moved = joined.join(least, "root").select("set_id", "least")
    of_class = firsts.join(moved, "set_id", "left").select(
        "set_id", F.coalesce("least", "first").alias("least"))
    found = rows.drop("bands").join(of_class, "set_id", "left")
    full = F.col("n_shingles") > 0
    return found.select(
        "doc_id", "key", "n_shingles",
        F.when(full, F.col("least.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(full, F.col("at") == F.col("least.at")).otherwise(True).alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The kept rows, with all their columns."""
    names = docs.columns
    keyed = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("key"),
                        F.struct(*names).alias("row"))
    blank = F.coalesce(F.col("row.text").rlike(r"^[\x20\x09-\x0D]*\z"), F.lit(True))
    kept = groups(docs).where("kept AND n_shingles > 0").select("key")
    # One row of each key: repeats are merged before the exchange.
    full = keyed.where(~blank).dropDuplicates(["key"]).join(kept, "key", "left_semi")
    return full.select("row").union(keyed.where(blank).select("row")).select(
        *[F.col("row")[c].alias(c) for c in names])
