"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.llm import (
    decontaminate, language_id, lexical, licenses, line_dedup, lm_scoring, mixing, near_dedup,
    nearest, secrets, simhash, spelling, toxicity)
from murmur.llm.common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines of windows that occurred before."""
    return line_dedup.dedup(table(spark, folder, "documents")).select(
        "doc_id", "n_lines", "n_removed", "text")


@query
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = table(spark, folder, "documents")
    part = fold(F.col("doc_id"), 5)
    found = language_id.identify(docs, language_id.learn(docs, part > 0))
    return found.select("doc_id", (part == 0).alias("held_out"), "lang_pred", "score", "margin")


@query
def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages in every document."""
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    found = decontaminate.scan(docs, decontaminate.window_set(items))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


@query
def op4_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of near-duplicate documents."""
    return near_dedup.groups(table(spark, folder, "documents")).select(
        "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled rows that are not held out."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    part = fold(F.col("doc_id"), 5)
    model = toxicity.learn(docs, labels, part > 0, part == 1)
    return toxicity.score(docs, model).select(
        "doc_id", (part == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Rates and copies of the documents for the target mix of domains."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    found = mixing.mix(docs, mixing.domains_of(labels), mixing.TARGETS)
    shares = [F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(sorted(mixing.TARGETS))]
    return found.select("row.doc_id", "n_tokens", *shares, "rate", "copies", "residual")


@query
def op7_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest vectors of every hundredth vector."""
    rows = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return nearest.nearest(rows.where("id % 100 = 0"), rows)


@query
def op8_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Log10 probability of every document under a deleted-interpolation bigram model."""
    part = fold(F.col("doc_id"), 10)
    found = lm_scoring.score(table(spark, folder, "documents"), part > 0, part == 1)
    return found.select("doc_id", (part == 0).alias("held_out"), "n_tokens", "n_known",
                        "train_tokens", "base_score", "score")


@query
def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Licences in every document."""
    found = licenses.scan(table(spark, folder, "documents"))
    places = F.transform("found", lambda x: F.concat_ws(":", x["number"].cast("string"), x["family"]))
    return found.select(
        "doc_id", "n_paragraphs", F.size("found").cast("long").alias("n_found"),
        F.concat_ws(",", F.array_sort(F.array_distinct("found.family"))).alias("families"),
        F.concat_ws(",", places).alias("places"))


@query
def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document."""
    found = secrets.scan(table(spark, folder, "documents"))
    spans = F.col("found")

    def of(*kinds: str) -> Column:
        return F.filter(spans, lambda s: s["kind"].isin(*kinds))

    base = of(*secrets.BASE)
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in secrets.BASE]
    return found.select("doc_id", *counts, F.sha2(secrets.shown(base), 256).alias("base_sha256"),
                        secrets.shown(spans).alias("spans"))


@query
def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """The words of all documents with the commoner words they are variants of."""
    return spelling.variants(table(spark, folder, "documents"))


@query
def op12_lexical(spark: SparkSession, folder: str) -> DataFrame:
    """The twenty best documents for every benchmark item."""
    return lexical.search(table(spark, folder, "benchmark"), table(spark, folder, "documents"))


@query
def op13_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose fingerprints differ in two bits at most."""
    return simhash.groups(table(spark, folder, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id")
