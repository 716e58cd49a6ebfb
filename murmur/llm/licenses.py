"""Licence scan with DataFrame and spark.ml operations only.

A document is read as one run of words, whatever its line breaks. Where a word pair with a cue
stands that a template holds, a window of the template's size (and ``SLACK`` of it on both sides)
is laid over the words so that the pair is in its place. A window that holds at least ``CONFIRM``
of the template's word pairs is cut to the words from the first to the last of them (and ``NEAR``
more on both sides), and described by its words and pairs, as far as templates hold them, and by
how many other words it has. A multinomial logistic regression, trained on the templates with
variations and on the runs of words of the whole corpus as class ``unknown``, must give the window
the template's family. The probability that a family needs is set on a fifth of the runs, which
the training leaves out. Equal runs are counted, not copied. Of hits that overlap the one most like its template stays, of equal ones the
longest; it is placed at the lines of its first and last pair.

The ``cues`` are words chosen so that in every template the pairs without a cue are too few for
``CONFIRM``; so no hit lacks a window. A null text has no paragraphs (lines that are not blank);
rows are judged one by one, and equal rows get equal results. Over an empty table nothing is
trained and nothing found.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.llm.common import row_key

# Sentences by which licences are known.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\");",
        "you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "either version 3 of the License, or (at your option) any later version.",
        "Released under the GNU GPL v3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "gpl-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "either version 2 of the License, or (at your option) any later version.",
        "Released under the GNU GPL v2.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License.",
        "under the terms of the GNU Lesser General Public License as published by the Free "
        "Software Foundation",
        "Released under the GNU LGPL.",
    ],
    "bsd": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
        "Released under the BSD license.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "Released under CC0 1.0 Universal into the public domain.",
    ],
}
UNKNOWN = "unknown"
FAMILIES = [UNKNOWN, *TEMPLATES]

WORD = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
OTHER = "<other>"
CONFIRM = 0.7
#: Words on both sides of a window, as a share of the template's and at least; words kept
#: beside a hit.
SLACK, LEAST_SLACK, NEAR = 0.5, 3, 1
#: Words of a run of the class ``unknown``.
RUN = 16
#: The probability that a family needs is at least this, and a multiple of 1 / STEPS.
LEAST_PROBABILITY, STEPS = 0.5, 10_000
#: Share of the runs left out of the training that may pass it.
FALSE_SHARE = 0.001


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def pairs_of(words: list[str]) -> list[str]:
    return [f"{a} {b}" for a, b in zip(words, words[1:])]


TEMPLATE_WORDS = [words_of(t) for own in TEMPLATES.values() for t in own]
VOCABULARY = [OTHER, *sorted({f for w in TEMPLATE_WORDS for f in (*w, *pairs_of(w))})]


def cues() -> list[str]:
    """Words without which no template can be held to ``CONFIRM``; long and common ones first."""
    pairs_left = [set(pairs_of(w)) for w in TEMPLATE_WORDS]
    bounds = [CONFIRM * len(p) for p in pairs_left]
    chosen: list[str] = []
    while True:
        left = [p for p, bound in zip(pairs_left, bounds) if len(p) >= bound]
        if not left:
            return chosen
        seen = Counter(w for p in left for pair in p for w in pair.split())
        chosen.append(max(seen, key=lambda w: (len(w) > 5, seen[w], w)))
        for p in pairs_left:
            p -= {pair for pair in p if chosen[-1] in pair}


def words(paragraph: Column) -> Column:
    return F.regexp_extract_all(F.lower(paragraph), F.lit(WORD), F.lit(0))


def pairs(own: Column) -> Column:
    return F.when(F.size(own) > 1, F.zip_with(
        F.slice(own, 1, F.size(own) - 1), F.slice(own, 2, F.size(own) - 1),
        lambda a, b: F.concat_ws(" ", a, b))).otherwise(F.array().cast("array<string>"))


def described(rows: DataFrame) -> DataFrame:
    """rows (with words), and their pairs and features."""
    rows = rows.withColumn("pairs", pairs(F.col("words")))
    return rows.withColumn("features", F.concat(
        F.transform("words", lambda w: F.when(w.isin(VOCABULARY[1:]), w).otherwise(OTHER)),
        F.filter("pairs", lambda p: p.isin(VOCABULARY[1:]))))


def likeness(own: Column, templates: list[str]) -> Column:
    """The largest share of a template's word pairs that ``own`` holds."""
    shares = []
    for template in templates:
        wanted = sorted(set(pairs_of(words_of(template))))
        shares.append(F.size(F.array_intersect(own, F.array(*map(F.lit, wanted)))) / len(wanted))
    return F.greatest(*shares) if len(shares) > 1 else shares[0]


def template_rows(spark: SparkSession) -> DataFrame:
    """The templates as they stand, shortened, and in front of or behind other words."""
    rows = []
    for name, templates in TEMPLATES.items():
        for template in templates:
            own = template.split()
            cut = max(1, len(own) // 6)
            for text in (own, own[cut:], own[:-cut], ["Copyright", "holder", "name"] + own,
                         own + ["All", "rights", "reserved"], ["#"] + own * 2,
                         ["foreign"] * NEAR + own + ["foreign"] * NEAR):
                rows.append((words_of(" ".join(text)), float(FAMILIES.index(name))))
    return spark.createDataFrame(rows, "words array<string>, label double")


def anchors() -> dict[str, list[tuple[int, int]]]:
    """For each word pair with a cue: the templates that hold it, and where."""
    wanted, out = cues(), {}
    for t, own in enumerate(TEMPLATE_WORDS):
        for offset, pair in enumerate(pairs_of(own)):
            if any(cue in pair for cue in wanted):
                out.setdefault(pair, []).append((t, offset))
    return out


def windows(rows: DataFrame) -> DataFrame:
    """key, template, number, last (lines), start, end (words), likeness, words of each window
    that is like a template."""
    places = anchors()
    table = F.create_map(*(x for pair, own in places.items() for x in (F.lit(pair), F.array(*(
        F.struct(F.lit(t).alias("template"), F.lit(o).alias("offset")) for t, o in own)))))
    slack = [max(LEAST_SLACK, int(SLACK * len(w))) for w in TEMPLATE_WORDS]
    left = F.array(*map(F.lit, slack))
    right = F.array(*(F.lit(len(w) + n) for w, n in zip(TEMPLATE_WORDS, slack)))
    wanted = F.array(*(F.array(*map(F.lit, sorted(set(pairs_of(w))))) for w in TEMPLATE_WORDS))

    tokens = F.flatten(F.transform(F.split("text", "\n"), lambda line, n: F.transform(
        words(line), lambda w: F.struct(w.alias("word"), (n + 1).alias("line")))))
    laid = F.array_distinct(F.flatten(F.filter(F.transform("pairs", lambda p, i: F.when(
        p.isin(list(places)), F.transform(F.element_at(table, p), lambda a: F.struct(
            a["template"].alias("template"), (i - a["offset"]).alias("start"))))),
        lambda x: x.isNotNull())))
    found = rows.select("key", tokens.alias("tokens")).withColumn(
        "pairs", pairs(F.col("tokens.word"))).select("key", "tokens", laid.alias("laid"))
    low = lambda x: F.greatest(F.lit(0), x["start"] - F.get(left, x["template"]))
    cut = F.transform("laid", lambda x: F.struct(
        x["template"].alias("template"), low(x).alias("low"), F.slice(
            "tokens", low(x) + 1, x["start"] + F.get(right, x["template"]) - low(x)).alias("own")))
    found = found.select("key", F.explode(cut).alias("w")).select("key", "w.*")
    found = found.withColumn("pairs", pairs(F.col("own.word"))).withColumn(
        "wanted", F.get(wanted, F.col("template"))).withColumn(
        "likeness", F.size(F.array_intersect("pairs", "wanted")) / F.size("wanted")).where(
        F.col("likeness") >= CONFIRM)
    held = F.filter(F.transform("pairs", lambda p, i: F.when(
        F.array_contains(F.col("wanted"), p), i)), lambda i: i.isNotNull())
    found = found.withColumn("held", held).withColumn("first", F.array_min("held")).withColumn(
        "final", F.array_max("held") + 1)
    near = F.greatest(F.lit(0), F.col("first") - NEAR)
    return found.select(
        "key", "template", F.get("own.line", F.col("first")).alias("number"),
        F.get("own.line", F.col("final")).alias("last"),
        (F.col("low") + F.col("first")).alias("start"),
        (F.col("low") + F.col("final")).alias("end"), "likeness",
        F.slice("own.word", near + 1, F.col("final") + 1 + NEAR - near).alias("words"))


def has_cue(text: Column) -> Column:
    wanted = F.array(*map(F.lit, cues()))
    return F.exists(F.array(F.lower(text)), lambda low: F.exists(
        wanted, lambda cue: F.contains(low, cue)))


def run_counts(docs: DataFrame) -> DataFrame:
    """features, late and n: how many runs of words of all texts have these features.

    A run whose hash is a multiple of five is ``late``. Runs are counted twice, by their words
    as far as templates hold them and then by their features, so pairs are formed and sorted for
    different runs only.
    """
    # No filter on the words: Spark would push it below them and take them from every text twice.
    own = docs.select(words(F.col("text")).alias("words"))
    cut = F.transform(F.sequence(F.lit(0), F.size("words") - 1, F.lit(RUN)),
                      lambda i: F.slice("words", i + 1, RUN))
    # A run's words end in the lambda that hashes them, so only its key leaves the array.
    runs = own.select(F.inline(F.when(F.size("words") > 0, F.transform(cut, lambda run: F.struct(
        F.array_join(F.transform(run, lambda w: F.when(w.isin(VOCABULARY[1:]), w).otherwise("")),
                     " ").alias("kept"),
        (F.pmod(F.xxhash64(run), F.lit(5)) == 0).alias("late"))))))
    counted = runs.groupBy("kept", "late").agg(F.count(F.lit(1)).alias("n"))
    shown = described(counted.withColumn("words", F.split("kept", " ")))
    return shown.groupBy(F.array_join(F.array_sort("features"), ",").alias("f"), "late").agg(
        F.sum("n").alias("n")).select(F.split("f", ",").alias("features"), "late", "n")


def unknown_runs(docs: DataFrame) -> DataFrame:
    """The counted runs that are examples of the class unknown, kept.

    The counts are kept before the comparison with the templates: the features are what is grouped
    by, so Spark would push it below both counts and describe and compare every run of every text.
    """
    like = F.greatest(*(likeness(F.col("features"), t) for t in TEMPLATES.values()))
    # Runs near a template are licences themselves; they are no examples of unknown.
    counted = run_counts(docs).cache()
    runs = counted.where(like < CONFIRM / 2).cache()
    runs.count()
    counted.unpersist()
    return runs


def least_limit(passed: DataFrame, total: int) -> float:
    """The least probability that at most ``FALSE_SHARE`` of all runs reach.

    passed: probability and n, of the runs that reach ``LEAST_PROBABILITY`` at least.
    """
    found = passed.groupBy(F.floor(F.col("probability") * STEPS).alias("step")).agg(
        F.sum("n").alias("n")).orderBy(F.desc("step")).collect()
    above = 0
    for row in found:
        above += row.n
        if above > FALSE_SHARE * total:
            return max(LEAST_PROBABILITY, (row.step + 1) / STEPS)
    return LEAST_PROBABILITY


def learn(docs: DataFrame) -> tuple[PipelineModel, float]:
    """The classifier, and the probability that a family needs."""
    runs = unknown_runs(docs)
    sizes = {r.late: r.n for r in runs.groupBy("late").agg(F.sum("n").alias("n")).collect()}
    known = described(template_rows(docs.sparkSession))
    # The families together weigh as much as the class unknown, however many runs there are.
    weight = max(1.0, sizes.get(False, 0) / known.count())
    rows = known.select("features", "label", F.lit(weight).alias("weight")).union(
        runs.where(~F.col("late")).select("features", F.lit(0.0), F.col("n").cast("double")))
    model = Pipeline(stages=[
        CountVectorizerModel.from_vocabulary(VOCABULARY, "features", "counts"),
        Normalizer(inputCol="counts", outputCol="unit"),
        LogisticRegression(featuresCol="unit", labelCol="label", weightCol="weight",
                           family="multinomial", maxIter=30, regParam=1e-3)]).fit(rows)
    best = F.array_max(F.slice(vector_to_array("probability"), 2, len(FAMILIES) - 1))
    passed = model.transform(runs.where("late")).select(best.alias("probability"), "n").where(
        F.col("probability") >= LEAST_PROBABILITY)
    limit = least_limit(passed, sizes.get(True, 0))
    runs.unpersist()
    return model, limit


def classified(found: DataFrame, model: PipelineModel, limit: float) -> DataFrame:
    """The windows that the classifier gives their template's family, and its probability."""
    names = [c for c in found.columns if c not in ("template", "words")]
    own = F.array(*(F.lit(name) for name, own in TEMPLATES.items() for _ in own))
    shown = model.transform(described(found)).withColumn(
        "p", vector_to_array("probability")).withColumn(
        "probability", F.array_max(F.slice("p", 2, len(FAMILIES) - 1))).withColumn(
        "family", F.element_at(F.array(*map(F.lit, FAMILIES)), F.array_position(
            "p", F.col("probability")).cast("int")))
    return shown.where((F.col("probability") >= limit) & (F.col("probability") > F.col("p")[0])
                       & (F.col("family") == F.get(own, F.col("template")))).select(
        *names, "family", "probability")


def apart(hits: Column) -> Column:
    """Of hits (best first), those that overlap no better one, and one per line and family."""
    return F.aggregate(hits, F.slice(hits, 1, 0), lambda kept, x: F.when(
        F.exists(kept, lambda k: ((k["start"] <= x["end"]) & (x["start"] <= k["end"]))
                 | ((k["number"] == x["number"]) & (k["family"] == x["family"]))),
        kept).otherwise(F.concat(kept, F.array(x))))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_paragraphs and found (number, family, probability, likeness, last) of every row."""
    kind = "array<struct<number:int,family:string,probability:double,likeness:double,last:int>>"
    none = F.array().cast(kind)
    rows = docs.select("doc_id", "text", row_key(F.col("doc_id"), F.col("text")).alias("key"))
    n = F.size(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")).cast("long")
    sized = rows.select("doc_id", "key", F.when(F.col("text").isNull(), 0).otherwise(n).alias(
        "n_paragraphs"))
    if docs.isEmpty():
        return sized.select("doc_id", "n_paragraphs", none.alias("found"))
    model, limit = learn(docs)
    own = windows(rows.where(has_cue(F.col("text"))))
    best = F.struct((-F.col("likeness")).alias("unlike"), (F.col("start") - F.col("end")).alias(
        "shorter"), (-F.col("probability")).alias("rank"), "start", "end", "number", "last", "family")
    found = classified(own, model, limit).groupBy("key").agg(
        F.sort_array(F.collect_set(best)).alias("hits")).select("key", apart(F.col("hits")).alias(
            "hits")).select("key", F.sort_array(F.transform("hits", lambda x: F.struct(
                x["number"].alias("number"), x["family"].alias("family"),
                (-x["rank"]).alias("probability"), (-x["unlike"]).alias("likeness"),
                x["last"].alias("last")))).cast(kind).alias("found"))
    return sized.join(found, "key", "left").select(
        "doc_id", "n_paragraphs", F.coalesce("found", none).alias("found"))
