"""Language by compression: the language whose dictionary makes a text smallest.

Every language has ``PARTS`` raw-content zstandard dictionaries of up to ``DICT_BYTES``. They are
filled with pieces of ``PIECE`` characters of a bounded sample of labelled rows, in the order of
a hash of row and place, so they come from all over the whole texts. A whole text, reduced to lower-case letters and blanks, is compressed with the
first dictionary of each language; if the two smallest sizes differ by fewer than ``CLOSE``
bytes, the other dictionaries are used too and the sums decide. A text is rejected if the
margin is still under ``min_margin`` bytes, or if it is null or has no letter (``und``).
Ties go to the first language by name. Without any labelled row all texts are ``und``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"
LEVEL = 5
PARTS = 3
DICT_BYTES = 64 << 10
#: Bounds of the sample: rows per language (expected), and languages.
SAMPLE_ROWS, LANGUAGES = 200, 1000
#: Characters of a piece, and pieces of a language: half of them fill its dictionaries, unless
#: a piece has few letters.
PIECE = 400
PIECES = 2 * PARTS * DICT_BYTES // PIECE
CLOSE = 8
HASH_RANGE = 1 << 30

NOT_LETTERS = re.compile(r"[\W\d_]+")

Model = dict[str, list[bytes]]


def letters(text: str | None) -> str:
    """Lower-case words of letters, one blank between; empty if there is no letter."""
    out = NOT_LETTERS.sub(" ", text or "").lower()
    return out if any(map(str.isalpha, out)) else ""


def learn(docs: DataFrame, usable: Column | None = None) -> Model:
    """Dictionaries per language from rows with text and lang for which ``usable`` holds.

    Of about ``SAMPLE_ROWS`` rows of each language, chosen by hash, at most ``PIECES`` pieces
    are brought to the driver. There may be at most ``LANGUAGES`` different values of lang.
    """
    rows = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    if usable is not None:
        rows = rows.where(usable)
    rows = rows.select("lang", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(HASH_RANGE))
                       .alias("h"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(
        LANGUAGES + 1).collect()}
    if len(counts) > LANGUAGES:
        raise ValueError(f"lang has more than {LANGUAGES} values")
    if not counts:
        return {}
    limit = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in
                           (lang, min(HASH_RANGE, math.ceil(SAMPLE_ROWS / n * HASH_RANGE)))])
    places = F.sequence(F.lit(0), F.ceil(F.length("text") / PIECE).cast("int"))
    pieces = rows.where(F.col("h") < limit[F.col("lang")]).select(
        "lang", "h", "text", F.explode(places).alias("place")).select(
        "lang", F.xxhash64("h", "place").alias("h"),
        F.expr(f"substring(text, place * {PIECE} + 1, {PIECE})").alias("text"))
    order = Window.partitionBy("lang").orderBy("h", "text")
    sample = pieces.withColumn("number", F.row_number().over(order)).where(
        F.col("number") <= PIECES)
    texts: dict[str, list[str]] = {lang: [] for lang in counts}
    for row in sorted(sample.collect(), key=lambda r: (r["lang"], r["number"])):
        if clean := letters(row["text"]):
            texts[row["lang"]].append(clean)
    return {lang: [" ".join(own[i::PARTS]).encode()[:DICT_BYTES] for i in range(PARTS)]
            for lang, own in texts.items() if own}


class Classifier:
    """Compressors of a model, made once per task."""

    def __init__(self, model: Model) -> None:
        self.langs = sorted(model)
        self.parts = [[self.compressor(model[lang][i]) for lang in self.langs]
                      for i in range(PARTS)]

    @staticmethod
    def compressor(content: bytes) -> zstandard.ZstdCompressor:
        data = zstandard.ZstdCompressionDict(content or b" " * 8,
                                             dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False,
                                        write_checksum=False, write_dict_id=False)

    def sizes(self, text: str) -> tuple[list[int], int]:
        """Compressed sizes by language and over how many dictionaries they are summed."""
        raw = text.encode()
        total = [c.compress(raw) for c in self.parts[0]]
        total = [len(x) for x in total]
        low = sorted(total)[:2]
        if len(low) < 2 or low[1] - low[0] >= CLOSE:
            return total, 1
        for part in self.parts[1:]:
            total = [n + len(c.compress(raw)) for n, c in zip(total, part)]
        return total, PARTS

    def predict(self, text: str | None) -> tuple[str, float, float | None]:
        """Language, score from 0 to 1, margin in bytes per dictionary."""
        clean = letters(text)
        if not clean or not self.langs:
            return UNKNOWN, 0.0, None
        total, used = self.sizes(clean)
        best = min(range(len(total)), key=lambda i: (total[i], i))
        gaps = [(n - total[best]) / used for n in total]
        margin = min((g for i, g in enumerate(gaps) if i != best), default=float(CLOSE))
        return self.langs[best], 1 / sum(2.0 ** -min(g, 1000) for g in gaps), margin


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, margin of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(shared.value)
        for batch in batches:
            found = [classifier.predict(t.as_py()) for t in batch.column(1)]
            lang, score, margin = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(margin, pa.float64())], ["doc_id", "lang_pred", "score", "margin"])

    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()), T.StructField("margin", T.DoubleType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def accepted(docs: DataFrame, model: Model, min_margin: float) -> DataFrame:
    """The rows whose language is clear, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(shared.value)
        for batch in batches:
            margins = [classifier.predict(t.as_py())[2] for t in batch.column(at)]
            yield batch.filter(pa.array([m is not None and m >= min_margin for m in margins],
                                        pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
