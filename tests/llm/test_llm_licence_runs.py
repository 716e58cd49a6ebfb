"""The licence classifier and its threshold come from all runs of words of all texts."""

from collections import Counter

from pyspark.sql import functions as F

from murmur.llm import licenses


def test_every_run_of_every_text_is_counted(spark):
    texts = [None, "", "!!"] + [
        " ".join(f"stone{i} of the License".split() * (1 + i % 9)) for i in range(1500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    expected = Counter()
    for text in texts:
        own = licenses.words_of(text or "")
        for i in range(0, len(own), licenses.RUN):
            run = own[i:i + licenses.RUN]
            known = [w if w in licenses.VOCABULARY else licenses.OTHER for w in run]
            pairs = [p for p in licenses.pairs_of(run) if p in licenses.VOCABULARY]
            expected[tuple(sorted(known + pairs))] += 1
    got = Counter()
    for r in licenses.run_counts(docs).collect():
        got[tuple(sorted(r.features))] += r.n
    assert got == expected and sum(got.values()) > 2000


def test_the_threshold_counts_every_run(spark):
    passed = spark.createDataFrame([(0.9, 2), (0.71234, 5), (0.71236, 4), (0.6, 1000)],
                                   "probability double, n long")
    assert licenses.least_limit(passed, 20_000) == 0.6001
    assert licenses.least_limit(passed, 5_000) == 0.7124
    assert licenses.least_limit(passed, 2_000_000) == licenses.LEAST_PROBABILITY
    assert licenses.least_limit(passed.limit(0), 0) == licenses.LEAST_PROBABILITY


def test_the_words_of_a_text_are_taken_once(spark):
    docs = spark.range(3).select(F.col("id").cast("string").alias("text"))
    plan = licenses.run_counts(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1


def test_only_counted_runs_are_compared_with_templates(spark):
    docs = spark.range(3).select(F.concat(F.lit("word"), F.col("id").cast("string")).alias("text"))
    runs = licenses.unknown_runs(docs)
    plan = runs._jdf.queryExecution().withCachedData().toString()
    runs.unpersist()
    counts = plan.index("HashAggregate")
    assert "array_intersect" in plan[:counts]
    assert "array_intersect" not in plan[counts:plan.index("Generate", counts)]
