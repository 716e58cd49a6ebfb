"""Language, decontamination, near duplicates, toxicity, mixing, language model."""

import hashlib
import math
import zlib

import plain
import pytest
from pyspark.sql import functions as F

from murmur.llm import (
    components, decontaminate, language_id, lm_scoring, mixing, near_dedup, toxicity)
from murmur.llm.common import fold


def by_text(rows):
    return sorted((tuple(r) for r in rows), key=str)


# language

def test_language_of_held_out_documents(spark, sf_dir):
    from murmur.llm.queries import op2_language_id

    truth = {r.doc_id: r.lang for r in spark.read.parquet(
        "/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in op2_language_id(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) > 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in held)


def test_language_of_edge_rows(edge_docs, no_docs):
    model = language_id.learn(edge_docs)
    found = language_id.identify(edge_docs, model).collect()
    undecided = {r.doc_id for r in found if r.lang_pred == "und"}
    assert undecided == {3, 4, 5, 7, None} and len(found) == edge_docs.count()
    assert language_id.learn(no_docs) == {}
    assert {r.lang_pred for r in language_id.identify(edge_docs, {}).collect()} == {"und"}
    assert language_id.identify(no_docs, model).count() == 0


def test_acceptance_keeps_columns_and_drops_the_undecided(edge_docs):
    out = language_id.accepted(edge_docs, language_id.learn(edge_docs), 1 / 3)
    assert out.columns == edge_docs.columns
    assert not {r.doc_id for r in out.collect()} & {3, 4, 5, 7}


# benchmark

ITEMS = [(1, "The quick brown fox jumps over the lazy dog and runs away again."),
         (2, "Short item!"), (3, None), (4, "..."), (20, "short, ITEM"), (None, "a lonely phrase"),
         (5, "alpha beta gamma delta epsilon zeta eta theta iota kappa")]
TEXTS = [(1, "Yes: the quick brown fox jumps over the lazy dog and runs; short item."),
         (2, "the quick brown fox"), (3, None), (4, ""), (5, "short\nitem short item"),
         (6, "x alpha beta gamma delta epsilon zeta eta theta iota kappa lambda ünd"),
         (7, "ALPHA-beta gamma.delta epsilon_zeta eta theta iota kappa a lonely phrase"),
         (7, "ALPHA-beta gamma.delta epsilon_zeta eta theta iota kappa a lonely phrase")]


@pytest.fixture(scope="module")
def bench(spark):
    return (spark.createDataFrame(TEXTS, "doc_id long, text string"),
            spark.createDataFrame(ITEMS, "item_id long, text string"))


@pytest.mark.parametrize("most", [10, 10_000])
def test_hits_equal_the_plain_version(bench, most):
    docs, items = bench
    windows = decontaminate.window_set(items, most=most)
    found = decontaminate.scan(docs, windows).collect()
    named = [(i, t) for i, t in ITEMS if i is not None]
    for r in found:
        text = dict(TEXTS)[r.doc_id]
        n, _, ids = plain.benchmark_hits(text, named)
        _, hit, _ = plain.benchmark_hits(text, ITEMS)
        assert (r.n_words, r.n_hit, r["items"]) == (n, hit, ids)
    left = {r.doc_id for r in decontaminate.clean(docs, windows).collect()}
    assert left == {2, 3, 4}


@pytest.mark.parametrize("most", [1, 7, 10_000])
def test_spans_show_the_hit_text(bench, most):
    docs, items = bench
    found = {r.doc_id: r.spans for r in decontaminate.scan(
        docs, decontaminate.window_set(items, most=most)).collect()}
    assert [TEXTS[0][1][i:j] for i, j in found[1]] == [
        "the quick brown fox jumps over the lazy dog and runs; short item"]
    assert [TEXTS[5][1][i:j] for i, j in found[6]] == [
        "alpha beta gamma delta epsilon zeta eta theta iota kappa"]


@pytest.mark.parametrize("most", [9, 10_000])
def test_decontamination_of_edge_rows(edge_docs, no_docs, bench, most):
    windows = decontaminate.window_set(bench[1], most=most)
    assert decontaminate.scan(edge_docs, windows).count() == edge_docs.count()
    assert by_text(decontaminate.clean(edge_docs, windows).collect()) == by_text(
        edge_docs.collect())
    assert decontaminate.scan(no_docs, windows).count() == 0
    none = decontaminate.window_set(bench[1].where("false"))
    assert {r.n_hit for r in decontaminate.scan(bench[0], none).collect()} == {0}


# near duplicates

def test_near_duplicates_equal_the_plain_version(spark):
    import random

    random.seed(7)
    texts, base = [], [f"w{random.randrange(500)}" for _ in range(150)]
    for i in range(60):
        own = list(base) if i % 3 else [f"v{random.randrange(500)}" for _ in range(40)]
        for _ in range(i % 12):
            own[random.randrange(len(own))] = f"e{random.randrange(900)}"
        texts.append((i, " ".join(own)))
    texts += [(100, None), (101, " "), (102, "a b"), (103, "A  b"), (104, "b a"), (105, "a b c d e")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    found = near_dedup.groups(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == plain.near_groups(texts)
    assert {r.doc_id for r in found if r.kept} == {r.component_id for r in found}
    kept = near_dedup.one_of_each(docs)
    assert {r.doc_id for r in kept.collect()} == {r.component_id for r in found}


def test_near_duplicates_of_edge_rows(edge_docs, no_docs):
    rows = near_dedup.groups(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    component = {r.doc_id: r.component_id for r in rows if r.n_shingles}
    assert component[11] == component[None] == 11 and component[10] == component[9] == 9
    assert all(r.component_id == r.doc_id and r.kept for r in rows if not r.n_shingles)
    assert near_dedup.one_of_each(edge_docs).columns == edge_docs.columns
    assert near_dedup.groups(no_docs).count() == 0


def test_one_row_of_each_group_stays(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "TILE", 1)
    base = [f"w{i}" for i in range(40)]
    near = [" ".join([*base[:-1], f"x{i}"]) for i in range(3)]
    rows = [(1, near[0])] * 20 + [(1, near[1])] * 5 + [(2, near[2])] + [
        (None, near[0])] * 3 + [(None, "a group of copies that all lack an id")] * 4 + [
        (None, " ")] * 2 + [(7, "")] * 2 + [(8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = near_dedup.groups(docs).collect()
    assert len(found) == len(rows)
    assert sorted((r.component_id for r in found if r.kept and r.n_shingles), key=str) == [1, None]
    kept = [tuple(r) for r in near_dedup.one_of_each(docs).collect()]
    first = min(near[:2], key=lambda t: hashlib.md5(f"+1\x1f+{t}".encode()).digest())
    assert by_text(kept) == by_text([(1, first), rows[-6], *rows[-5:]])


def test_repeats_of_a_row_reach_the_tiles_once(spark, monkeypatch):
    base = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(base))] * 50 + [(2, " ".join([*base[:-1], "x"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    seen = []
    plain_sets = near_dedup.full_sets
    monkeypatch.setattr(near_dedup, "full_sets", lambda t: seen.append(t.count()) or plain_sets(t))
    assert sum(r.kept for r in near_dedup.groups(docs).collect()) == 1
    assert seen == [2]


def test_clusters_of_many_tiles_keep_every_link(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "TILE", 4)
    base = [f"w{i}" for i in range(60)]
    texts = [(i, " ".join(base[:i % 30] + [f"x{i}"] + base[i % 30:])) for i in range(30)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.groups(docs).collect()}
    assert found == plain.near_groups(texts)


def test_components_of_paths_and_loops(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(50, 60), (60, 50), (70, 70)]
    rows = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    roots = {r.id: r.root for r in rows}
    assert {roots[i] for i in range(1, 41)} == {1} and roots[60] == roots[50]


def test_sketches_fill_every_coordinate():
    import numpy as np

    sets = [np.arange(n, dtype=np.uint64) * np.uint64(7919) for n in (1, 3, 400)]
    bounds = np.cumsum([0, *map(len, sets)])
    out = near_dedup.sketches(np.concatenate(sets), bounds)
    assert (out != near_dedup.UNSET).all()
    half = near_dedup.sketches(np.concatenate([sets[2], sets[2][:300]]), np.array([0, 400, 700]))
    assert abs((half[0] == half[1]).mean() - 0.75) < 0.15


# toxicity

def test_disguised_words_are_restored(spark):
    texts = ["that stupid idiot said loser and moron"] * 50 + ["the quick fox is in the house"] * 50
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    channel = toxicity.Channel(toxicity.character_model(toxicity.character_counts(docs)))
    for piece, word in [("1d10t", "idiot"), ("s t u p i d", "stupid"), ("l0s3r", "loser"),
                        ("m.o.r.o.n", "moron"), ("stuuuupid", "stupid"), ("$tup1d", "stupid"),
                        ("iidiioott", "idiot"), ("ssttupiidd", "stupid"), ("i  d  i  o  t", "idiot"),
                        ("i\td\ti\to\tt", "idiot"), ("i\nd\ni\no\nt", "idiot"),
                        ("i - d - i - o - t", "idiot"),
                        ("i d i o +", "idiot"), ("l 0 s e r", "loser"), ("idi!!!!!!!!ot", "idi")]:
        assert word in channel.words(f"so {piece} it is"), piece
    assert channel.words(None) == [] == channel.words("")
    assert "stupid" in channel.words("said st up id loser")
    assert channel.words("so it is in the") == ["so", "it", "is", "in", "the"]
    assert len(channel.words("aabb" * 20_000)) <= 2


def test_toxicity_of_held_out_documents(spark):
    from murmur.llm.queries import op5_toxicity

    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [r for r in op5_toxicity(spark, folder).collect() if r.held_out and r.doc_id in labels]
    clean = [r.score for r in held if not labels[r.doc_id]]
    toxic = [r.score for r in held if labels[r.doc_id]]
    assert sum(s >= 0.5 for s in toxic) > 0.85 * len(toxic)
    assert sum(s >= 0.5 for s in clean) < 0.02 * len(clean)


def test_toxicity_of_edge_rows(edge_docs, no_docs, spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, None), (99, 1), (None, 1)],
                                   "doc_id long, toxic int")
    part = fold(F.col("doc_id"), 5)
    for own in (labels, labels.where("false")):
        model = toxicity.learn(edge_docs, own, part > 0, part == 1)
        rows = toxicity.score(edge_docs, model).collect()
        assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(no_docs, toxicity.learn(no_docs, labels, part > 0, part == 1)).count() == 0


# language model

def test_base_scores_equal_the_plain_version(edge_docs):
    part = fold(F.col("doc_id"), 10)
    rows = lm_scoring.score(edge_docs, part > 0, part == 1).collect()
    texts = [(r.doc_id, r.text) for r in edge_docs.collect()]
    counts = plain.unigrams(texts, lambda d: d is not None and zlib.crc32(str(d).encode()) % 10)
    n, v = sum(counts.values()), len(counts)
    expected = []
    for d, t in texts:
        own = [*plain.space_words(t), None]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        expected.append((d, len(own), sum(counts[w] > 0 for w in own), n, round(base, 3)))
    found = [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3)) for r in rows]
    assert by_text(found) == by_text(expected)
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)


def test_the_model_predicts_unseen_texts_better_than_the_base(spark):
    part = fold(F.col("doc_id"), 10)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = lm_scoring.score(docs, part > 0, part == 1).where(part == 0).agg(
        F.sum("base_score"), F.sum("score")).first()
    assert held[1] > 0.8 * held[0]


def test_probabilities_sum_to_one():
    import numpy as np

    words = np.array([3, 1, 2, 0])  # counts of three known words and any other
    pairs = np.array([2, 0, 1, 0])
    probs = lm_scoring.parts_of(words, pairs, np.full(4, 3), 6, 3)
    assert np.allclose(probs.sum(axis=1), 1)


def test_blocks_do_not_matter(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    part = fold(F.col("doc_id"), 10)
    whole = by_text((r.doc_id, r.n_known, round(r.base_score, 6), round(r.score, 6))
                    for r in lm_scoring.score(docs, part > 0, part == 1).collect())
    monkeypatch.setattr(lm_scoring, "BLOCK", 50_000)
    cut = by_text((r.doc_id, r.n_known, round(r.base_score, 6), round(r.score, 6))
                  for r in lm_scoring.score(docs, part > 0, part == 1).collect())
    assert cut == whole


def test_scores_without_learned_texts(edge_docs, no_docs):
    rows = lm_scoring.score(edge_docs, F.lit(False), F.lit(False)).collect()
    assert {r.n_known for r in rows} == {0} and {r.train_tokens for r in rows} == {0}
    assert lm_scoring.score(no_docs, F.lit(True), F.lit(False)).count() == 0


# mixing

def test_rates_reach_the_targets(spark):
    import random

    random.seed(3)
    rows = []
    for i in range(400):
        p = [random.random() ** 3 for _ in range(3)]
        rows.append((random.randrange(1, 400), [x / sum(p) for x in p]))
    frame = spark.createDataFrame(rows, "n_tokens long, p array<double>").cache()
    total = sum(n for n, _ in rows)
    targets = [0.6 * total, 0.3 * total, 0.1 * total]
    steps, residual = mixing.fit_rates(frame, targets)
    assert residual <= mixing.CLOSE and len(steps) < 20
    got = frame.withColumn("rate", mixing.rate(steps)).collect()
    assert min(r.rate for r in got) >= 0
    for k, wanted in enumerate(targets):
        assert abs(sum(r.rate * r.n_tokens * r.p[k] for r in got) - wanted) < 0.01 * total


def test_mixing_of_edge_rows(edge_docs, no_docs, spark):
    labels = spark.createDataFrame(
        [(i, i % 2, int(i == 8)) for i in range(1, 16)] + [(1, None, None), (None, 1, 0)],
        "doc_id long, quality int, toxic int")
    own = mixing.domains_of(labels)
    out = mixing.mix(edge_docs, own, mixing.TARGETS)
    rows = out.collect()
    assert len(rows) == edge_docs.count()
    assert all(r.rate >= 0 and abs(sum(r.p) - 1) < 1e-9 for r in rows)
    assert all(r.copies in (math.floor(r.rate), math.floor(r.rate) + 1) for r in rows)
    taken = mixing.mixed_rows(edge_docs, own, mixing.TARGETS)
    assert taken.columns == [*edge_docs.columns, "rate", "copies"]
    bare = mixing.mix(edge_docs, own.where("false"), mixing.TARGETS).collect()
    assert all(abs(x - 1 / 3) < 1e-9 for r in bare for x in r.p)
    assert mixing.mix(no_docs, own, mixing.TARGETS).count() == 0
