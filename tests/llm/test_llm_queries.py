"""The registered queries and the pipeline on the small tables."""

import plain
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from murmur.llm import language_id, mixing
from murmur.llm.oracles import ORACLES
from murmur.llm.queries import QUERIES

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, duck):
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    rows = sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)
    if name == "op11_spelling":  # one row a word; compared with a plain version elsewhere
        assert len({r[columns.index("word")] for r in rows}) == len(rows) > 0
        return
    if name not in ORACLES:
        assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
        return
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    assert {c: TYPES[t] for c, t in frame.dtypes} == {
        d[0]: str(d[1]) for d in cursor.description}
    at = [names.index(c) for c in columns]
    assert rows == sorted((tuple(r[i] for i in at) for r in cursor.fetchall()), key=str)


def test_pipeline_equals_the_plain_stages(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "lines", "near_duplicates", "decontaminate", "mixing"]

    docs = stages["language"](spark, documents, sf_dir).cache()
    classifier = language_id.Classifier(language_id.learn(documents))
    margins = {r.doc_id: classifier.predict(r.text)[2] for r in documents.collect()}
    rows = docs.collect()
    assert {r.doc_id for r in rows} == {
        d for d, m in margins.items() if m is not None and m >= corpus_pipeline.MIN_MARGIN}

    docs = stages["lines"](spark, docs, sf_dir).cache()
    before = {r.doc_id: r.text for r in rows}
    texts = {d: t for d, t in plain.without_repeated_lines(list(before.items())).items()
             if t == before[d] or t.strip(" ")}
    assert {r.doc_id: r.text for r in docs.collect()} == texts
    assert docs.where(F.col("n_chars") != F.length("text")).count() == 0

    docs = stages["near_duplicates"](spark, docs, sf_dir).cache()
    groups = plain.near_groups(list(texts.items()))
    assert {r.doc_id for r in docs.collect()} == {d for d, (_, c) in groups.items() if c == d}

    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select(
        "item_id", "text").collect()]
    kept = {r.doc_id for r in docs.collect() if not plain.benchmark_hits(r.text, items)[1]}
    docs = stages["decontaminate"](spark, docs, sf_dir).cache()
    assert {r.doc_id for r in docs.collect()} == kept
    assert docs.columns == documents.columns

    out = stages["mixing"](spark, docs, sf_dir)
    labels = mixing.domains_of(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rates = {r["row"].doc_id: (r.rate, r.copies) for r in mixing.mix(
        docs, labels, mixing.TARGETS, keep=tuple(docs.columns)).collect()}
    assert {r.doc_id: (r.rate, r.copies) for r in out.collect()} == {
        d: x for d, x in rates.items() if x[1] > 0}
    assert out.columns == [*documents.columns, "rate", "copies"]


def test_pipeline_on_edge_rows(spark, edge_docs, sf_dir):
    docs = edge_docs
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns[:len(edge_docs.columns)] == edge_docs.columns, name
    assert docs.count() <= edge_docs.count()
    none = edge_docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, sf_dir)
    assert none.count() == 0
