"""Line dedup, secrets, licences."""

import hashlib

import plain
import pytest
from pyspark.sql import functions as F

from murmur.llm import licenses, line_dedup, secrets


def test_line_dedup_equals_the_plain_version(edge_docs):
    docs = edge_docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = line_dedup.dedup(docs).collect()
    expected = plain.without_repeated_lines([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id: r.text for r in rows} == expected
    assert expected[2] == "New start.\nNew end." and expected[12] == "a\nb\nc"
    for r in rows:
        before = next(x.text for x in docs.collect() if x.doc_id == r.doc_id)
        n = 0 if before is None else len(before.split("\n"))
        assert r.n_lines == n and r.n_removed == n - (
            0 if r.text is None else len(r.text.split("\n")) if r.text or n == 1 else 0)


def test_line_dedup_keeps_rows_and_columns(edge_docs, no_docs):
    out = line_dedup.dedup(edge_docs)
    assert out.columns == [*edge_docs.columns, "n_lines", "n_removed"]
    assert out.count() == edge_docs.count()
    assert line_dedup.dedup(out).columns == out.columns
    assert line_dedup.dedup(no_docs).count() == 0


def test_a_line_common_to_many_is_kept_once(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("a\nb\nc\n"), "id").alias("text"))
    out = {r.doc_id: r.text for r in line_dedup.dedup(docs).collect()}
    assert out == {i: f"a\nb\nc\n{i}" if i == 0 else str(i) for i in range(3000)}


def test_secrets_equal_the_plain_version(edge_docs, no_docs):
    found = secrets.scan(edge_docs)
    shown = found.select("doc_id", secrets.shown(F.filter("found", lambda s: s["kind"].isin(
        *secrets.BASE))).alias("base")).collect()
    texts = [(r.doc_id, r.text) for r in edge_docs.collect()]
    expected = [(d, ",".join(s for _, _, s in sorted(plain.base_spans(t)))) for d, t in texts]
    order = lambda rows: sorted(rows, key=str)
    assert order((r.doc_id, r.base) for r in shown) == order(expected)
    assert secrets.scan(no_docs).count() == 0


@pytest.mark.parametrize("text,kinds", [
    ("x ghp_" + "a1B2" * 10, ["hub_token"]), ("-----BEGIN RSA PRIVATE KEY-----", ["private_key"]),
    ("ftp://me:pw@host", ["url_login"]), ("Bearer " + "Ab1." * 6, ["bearer"]),
    ("xoxb-" + "A1" * 8, ["chat_token"]), ("AIza" + "Z" * 35, ["map_key"]),
    ("api_key: " + "Z" * 12, ["assign"]), ("API_KEY=" + "Z" * 11, []),
    ("password=secret=abcdefghijk", ["assign"]), ("AKIA" + "A" * 13, [])])
def test_secret_kinds(spark, text, kinds):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [s.kind for s in secrets.scan(docs).first().found] == kinds


def test_every_match_holds_the_trigrams_of_a_clause():
    assert secrets.trigram_query(r"[0-9a-f]{16,}") == []
    assert secrets.trigram_query("ab(cd|xy)?e") == [
        ["abc", "bcd", "cde"], ["abe"], ["abx", "bxy", "xye"]]
    assert ["aki", "kia"] in secrets.trigram_query(r"AKIA[A-Z0-9]+")


def test_licences(spark, no_docs):
    texts = ["Some words.\nLicensed under the Apache License, Version 2.0.\nMore words.",
             "RELEASED!! UNDER!! THE!! MIT!! LICENSE.", None, "", "the license of the driver",
             "This work is licensed under the GNU General Public License, version 3.",
             "Licensed under CC BY-NC 4.0.\n\nReleased under the MIT License."]
    filler = [f"of the word{i} and word{i + 1} in that place\nwith version {i}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts + filler)), "doc_id long, text string")
    out = {r.doc_id: r for r in licenses.scan(docs).collect()}
    families = {d: [x.family for x in r.found] for d, r in out.items() if r.found}
    assert families == {0: ["apache-2.0"], 1: ["mit"], 5: ["gpl-3.0"], 6: ["cc-by-nc", "mit"]}
    assert [x.number for x in out[6].found] == [1, 3] and out[6].n_paragraphs == 2
    assert out[2].n_paragraphs == 0 and out[3].n_paragraphs == 0
    assert licenses.scan(no_docs).count() == 0


def test_wrapped_and_embedded_notices(spark):
    notices = [(t, name) for name, own in licenses.TEMPLATES.items() for t in own]
    rows = []
    for t, name in notices:
        w = t.split()
        for size in (3, 7):
            rows.append(("\n".join("# " + " ".join(w[i:i + size]) for i in range(0, len(w), size)),
                         name, 1, -(-len(w) // size)))
        for n in (25, 250):
            side = " ".join(f"stone{i} of river{i}" for i in range(n // 3))
            rows.append((f"first line\n{side} {t} {side}", name, 2, 2))
    filler = [f"of the word{i} and word{i + 1} in that place\nwith version {i}" for i in range(60)]
    docs = spark.createDataFrame(
        list(enumerate([r[0] for r in rows] + filler)), "doc_id long, text string")
    out = {r.doc_id: [(x.family, x.number, x.last) for x in r.found]
           for r in licenses.scan(docs).collect()}
    assert [(rows[d][0][:200], out[d]) for d in range(len(rows)) if out[d] != [rows[d][1:]]] == []
    assert not any(out[len(rows) + i] for i in range(len(filler)))


def test_no_paragraph_without_a_cue_can_be_confirmed():
    cues = licenses.cues()
    for own in licenses.TEMPLATE_WORDS:
        pairs = set(licenses.pairs_of(own))
        bare = {p for p in pairs if not any(c in p for c in cues)}
        assert len(bare) < licenses.CONFIRM * len(pairs)


def test_licences_on_edge_rows(edge_docs):
    rows = licenses.scan(edge_docs).collect()
    assert len(rows) == edge_docs.count() and not any(r.found for r in rows)


def test_query_digests_are_of_the_shown_spans(spark, sf_dir):
    from murmur.llm.queries import op10_secrets

    for r in op10_secrets(spark, sf_dir).collect():
        base = [s for s in r.spans.split(",") if s.split(":")[0] in secrets.BASE]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert r.n_assign + r.n_access + r.n_hex == len(base)
