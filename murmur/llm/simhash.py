"""Near duplicates by SimHash fingerprints and multi-index hashing.

A text's shingles are its runs of three words, repeats included (a text of one or two words is
one shingle), each hashed by XXH64. A bit of the fingerprint is set if it is set in over half of
the hashes. Texts with equal fingerprints form one class, so copies meet no search.

Two fingerprints that differ in at most ``DISTANCE`` = 2 bits differ in at most one bit within
one of the ``SEGMENTS`` = 2 halves. The table holds every fingerprint under each of its halves;
a fingerprint looks up each half itself and the half with one more bit set (of two halves that
differ in one bit, one has the bit, so the other finds it), and the whole distance is verified.
A half that more than ``CROWD`` fingerprints share leaves the table: each of its fingerprints
looks up all 2080 fingerprints of its own ball instead. Either way gives every link, no key
gathers more than ``CROWD`` rows of the table, and links run between classes only.

A null text, or one without words, has the fingerprint zero, which is linked like any other. The
component of a row is the smallest doc_id of its component; null if none of its rows has an id.
Equal rows are equal results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur.llm.common import slices, written
from murmur.llm.components import components
from murmur.llm.tokens import pieces

SHINGLE = 3
SEED = 42
DISTANCE = 2
SEGMENTS, BITS = 2, 32
CROWD = 256

BLANK = re.compile(rb"[\x20\x09-\x0D]")


def fingerprint(text: bytes) -> int:
    """The fingerprint of a UTF-8 text."""
    ones, total, tail = np.zeros(64, np.int64), 0, []
    for part in slices(text.lower(), BLANK):
        words = tail + part.split()
        if len(words) >= SHINGLE:
            hashes = hashed(words)
            ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1,
                                  bitorder="little").sum(axis=0, dtype=np.int64)
            total += len(hashes)
        tail = words[1 - SHINGLE:]
    if not total and tail:
        return xxhash.xxh64_intdigest(b" ".join(tail), SEED)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def hashed(words: list[bytes]) -> np.ndarray:
    """XXH64 of every run of ``SHINGLE`` words."""
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - SHINGLE + 1
    digest = xxhash.xxh64_intdigest
    places = zip(starts[:n].tolist(), ends[SHINGLE - 1:].tolist())
    return np.fromiter((digest(text[s:e], SEED) for s, e in places), np.uint64, n)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (64 bits as a long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in pieces(batch.column(1)):
                prints = [fingerprint(data[i:j].tobytes()) for i, j in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo),
                     pa.array(np.array(prints, np.uint64).view(np.int64))],
                    ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(
        run, T.StructType([docs.schema["doc_id"], T.StructField("fingerprint", T.LongType())]))


def links(prints: DataFrame, crowd: int = CROWD) -> DataFrame:
    """a, b: all pairs of the distinct fingerprints ``fingerprint`` that differ in one or two bits."""
    segment = (1 << BITS) - 1
    keys = F.array(*[F.shiftrightunsigned("fingerprint", i * BITS).bitwiseAND(F.lit(segment))
                     .bitwiseOR(F.lit(i << BITS)) for i in range(SEGMENTS)])
    table = prints.select(F.col("fingerprint").alias("b"), F.explode(keys).alias("key"))
    crowded = table.groupBy("key").count().where(F.col("count") > crowd).select("key")
    ball = F.expr(f"""explode(concat(array(key), transform(
        filter(sequence(0, {BITS - 1}), i -> shiftright(key, i) & 1 = 0),
        i -> key | shiftleft(1L, i))))""")
    probes = table.select(F.col("b").alias("a"), ball.alias("key"), F.col("key").alias("own"))
    sparse = table.join(crowded, "key", "left_anti").withColumnRenamed("key", "at")
    # Within one half both would find each other; keep the pair once.
    near = (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE) & (
        (F.col("a") < F.col("b")) | (F.col("key") != F.col("own")))
    found = probes.join(sparse, (F.col("key") == F.col("at")) & near).select("a", "b")

    masks = F.expr("shiftleft(1L, i) | shiftleft(1L, j)")  # one bit where i = j
    around = table.join(crowded, "key", "left_semi").select(F.col("b").alias("a")).distinct()
    around = around.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(63)))).withColumn(
        "j", F.explode(F.sequence("i", F.lit(63))))
    around = around.select("a", F.col("a").bitwiseXOR(masks).alias("b"))
    return found.unionByName(around.join(
        prints.select(F.col("fingerprint").alias("b")), "b").select("a", "b"))


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id of every row."""
    rows = written(fingerprints(docs), "fingerprints")
    prints = written(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "prints")
    # Components want ids in random order; the hash of a long is one to one.
    pairs = links(prints).select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b"))
    joined = prints.join(components(pairs), F.xxhash64("fingerprint") == F.col("id"), "left")
    least = joined.where("root IS NOT NULL").groupBy("root").agg(F.min("first").alias("least"))
    of_class = joined.join(least, "root", "left").select(
        "fingerprint", F.when(F.col("root").isNull(), F.col("first")).otherwise(
            F.col("least")).alias("component_id"))
    return rows.join(of_class, "fingerprint").select("doc_id", "fingerprint", "component_id")
