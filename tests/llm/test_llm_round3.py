"""Fingerprints, ranked search and spelling variants against plain versions."""

import math
import random
import zlib
from collections import Counter
from itertools import combinations

import plain
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from murmur.llm import lexical, simhash, spelling


def fingerprint(text):
    words = plain.space_words(text)
    if not words:
        return 0
    runs = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def fingerprint_groups(rows):
    """[(doc_id, fingerprint, component_id)] of (doc_id, text) pairs."""
    prints = [(d, fingerprint(t)) for d, t in rows]
    root = {p: p for _, p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(root), 2):
        if (a ^ b).bit_count() <= 2:
            root[find(a)] = find(b)
    least = {}
    for d, p in prints:
        if d is not None:
            least[find(p)] = min(d, least.get(find(p), d))
    return [(d, p, least.get(find(p))) for d, p in prints]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def ordered(rows):
    return sorted(rows, key=str)


def test_groups_equal_the_plain_ones(spark, sf_dir, edge_docs):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    for docs in (given, edge_docs):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        got = [tuple(r) for r in simhash.groups(docs).collect()]
        assert ordered(got) == ordered([(d, signed(p), c) for d, p, c in fingerprint_groups(rows)])


def test_no_documents(spark, no_docs):
    assert simhash.groups(no_docs).collect() == []
    assert spelling.variants(no_docs).collect() == []
    items = spark.createDataFrame([(1, "word")], "item_id long, text string")
    assert lexical.search(items, no_docs).collect() == []
    assert lexical.search(items.where("false"), no_docs).collect() == []


def test_copies_and_words_across_pieces_make_one_fingerprint():
    text = " ".join(f"W{i % 1009}\t" for i in range(200_000))
    assert simhash.fingerprint(text.encode()) == fingerprint(text)
    assert simhash.fingerprint("é Ü x b c".encode()) == fingerprint("é Ü x b c")


@pytest.mark.parametrize("crowd", [0, 2, 256])
def test_links_lose_nothing_at_any_crowd(spark, crowd):
    rng = random.Random(7)
    centres = [rng.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1, 1 << 63]
    prints = set(centres)
    for c in centres:
        for _ in range(40):
            x = c
            for b in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << b
            prints.add(x)
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fingerprint long")
    got = {frozenset(r) for r in simhash.links(frame, crowd).collect()}
    assert got == {frozenset((signed(a), signed(b))) for a, b in combinations(prints, 2)
                   if (a ^ b).bit_count() <= 2}


def ranking(items, docs, k=20):
    """[(item_id, rank, doc_id, score)]"""
    def terms(text):
        return regex.findall(lexical.TERM, plain.lowered(text))

    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n = len(counts)
    length = sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    queries = {}
    for i, t in items:
        if i is not None:
            queries.setdefault(i, Counter()).update(terms(t))
    out = []
    for i, query in queries.items():
        found = []
        for d, c in counts:
            m = 75 + 25 * c.total() * n // length
            score = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
                        for t, q in query.items() if t in c)
            if score > 0:
                found.append((-score, d is None, d))
        for rank, (score, _, d) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1):
            out.append((i, rank, d, -score))
    return out


ITEMS = [(1, "same text of some Words"), (2, "Line here, line there"), (3, None), (4, ""), (5, "!!"),
         (None, "same text"), (6, "ünï 😀 aaa 8"), (7, "nowhere"), (1, "words again word1 word1")]


@pytest.mark.parametrize("postings", [1, 5, lexical.POSTINGS])
def test_search_equals_the_plain_one(spark, edge_docs, postings):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("term", F.lit("x"))
    rows = [(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]
    got = [tuple(r) for r in lexical.search(items, edge_docs, postings=postings).collect()]
    assert ordered(got) == ordered(ranking(ITEMS, rows))
    few = [tuple(r) for r in lexical.search(items, edge_docs, k=2, postings=postings).collect()]
    assert ordered(few) == ordered(ranking(ITEMS, rows, 2))


def test_steps_hold_whole_documents():
    import numpy as np

    assert list(lexical.steps(np.array([5, lexical.STEP * 2, 1, 1]), 3)) == [(0, 1), (1, 2), (2, 4)]
    assert list(lexical.steps(np.array([], np.int64), 3)) == []


def spellings(rows):
    """[(word, form, root, n, n_near, form_n)]"""
    counts = Counter()
    for d, t in rows:
        for run in regex.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = plain.lowered(run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: set() for w in words}
    masked = {}
    for w in words:  # words that agree but for one place, or of which one lacks it
        for i in range(len(w)):
            masked.setdefault((len(w), i, w[:i] + w[i + 1:]), set()).add(w)
            if (shorter := w[:i] + w[i + 1:]) in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in masked.values():
        for a, b in combinations(group, 2):
            near[a].add(b)
            near[b].add(a)
    form = {}
    for w, n in words.items():
        best = min(((-words[x], x) for x in near[w]), default=None)
        form[w] = best[1] if best and -best[0] >= 5 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


def test_variants_equal_the_plain_ones(spark, sf_dir, edge_docs):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    for docs in (given, edge_docs):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        got = [tuple(r) for r in spelling.variants(docs).collect()]
        assert ordered(got) == ordered(spellings(rows))


WORDS = ([("common", 1000), ("comon", 9), ("commons", 150), ("commonß", 20), ("commpns", 5), ("nommoc", 7)]
         + [("a" * 3000, 5), ("a" * 2999 + "b", 30), ("a" * 3001, 200)]
         + [(f"variant{x}{y}", 5 + i) for i, x in enumerate("abcdé") for y in "xyzü"])


@pytest.mark.parametrize("own, visiting", [(1, 1), (3, 4), (spelling.OWN, spelling.VISITING)])
def test_forms_do_not_depend_on_the_parts(spark, monkeypatch, own, visiting):
    from murmur.llm.spelling import dealt

    monkeypatch.setattr(spelling, "dealt", lambda rows: dealt(rows, own, visiting))
    frame = spark.createDataFrame(WORDS, "word string, n long")
    got = {r.word: (r.form, r.root, r.n_near) for r in spelling.with_roots(spelling.forms(frame)).collect()}
    near = {w: [(-m, x) for x, m in WORDS if spelling.one_edit(w, x)] for w, _ in WORDS}
    form = {w: min(near[w])[1] if near[w] and -min(near[w])[0] >= 5 * n else None for w, n in WORDS}

    def last(w):
        return last(form[w]) if form[w] else w

    assert got == {w: (form[w], last(w), len(near[w])) for w, _ in WORDS}
    assert got["commpns"] == ("commons", "common", 1)
    assert got["nommoc"][0] is None


def test_every_pair_of_blocks_meets_once():
    there = spelling.moves()
    both = set(there.tolist()) | set((~there + there.dtype.type(1)).tolist())
    assert len(both) == 2 * len(there) - 1  # only the own block is its own way back


def test_one_edit():
    pairs = {("abc", "abc"): False, ("abc", "abd"): True, ("abc", "ab"): True, ("abc", "xabc"): True,
             ("abc", "acb"): False, ("aab", "ab"): True, ("abcd", "ab"): False, ("", "a"): True}
    for (x, y), near in pairs.items():
        assert spelling.one_edit(x, y) == spelling.one_edit(y, x) == near
