import math

import pytest
from pyspark.sql import functions as F

from murmur.llm import nearest


def plain(rows, queries, k=10):
    good = {}
    for i, v in sorted((r for r in rows if r[0] is not None), key=str):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good.setdefault(i, v)
    out = []
    for q in sorted(good):
        if queries(q):
            near = sorted((math.dist(good[q], v), i) for i, v in good.items()
                          if i != q and len(v) == len(good[q]))[:k]
            out += [(q, n, i, round(d, 9)) for n, (d, i) in enumerate(near, 1)]
    return out


@pytest.mark.parametrize("tile,block", [(4096, 1024), (7, 3)])
def test_equals_brute_force(spark, monkeypatch, tile, block):
    import random

    monkeypatch.setattr(nearest, "TILE", tile)
    monkeypatch.setattr(nearest, "BLOCK", block)
    random.seed(5)
    rows = [(i, [random.gauss(0, 1) * 10 ** (i % 3) for _ in range(6)]) for i in range(80)]
    rows += [(100 + i, rows[0][1]) for i in range(20)]  # ties
    rows += [(200, None), (201, []), (202, [0.0] * 6), (203, [1.0, None] + [1.0] * 4),
             (204, [math.nan] * 6), (205, [math.inf] * 6), (206, [1.0, 2.0]), (210, [2.0, 1.0]),
             (0, rows[0][1]), (None, rows[1][1])]
    frame = spark.createDataFrame(rows, "id long, vector array<double>").withColumn(
        "tile", F.lit("clash")).repartition(5)
    found = nearest.nearest(frame.where("id % 10 = 0"), frame)
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in found.collect())
    assert got == plain(rows, lambda q: q % 10 == 0)


def test_empty_tables(spark):
    frame = spark.createDataFrame([(1, [1.0])], "id long, vector array<float>")
    none = frame.where("false")
    assert nearest.nearest(none, frame).count() == 0
    assert nearest.nearest(frame, none).count() == 0
    assert nearest.nearest(frame, frame).count() == 0
