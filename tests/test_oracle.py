"""Every query with oracle SQL gives the same rows in Spark and DuckDB."""

import pytest

from murmur.plans import ORACLES, QUERIES

TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, duck):
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    rows = ordered(tuple(r) for r in frame.select(*columns).collect())
    if name not in ORACLES:
        assert rows
        return
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    assert sorted(names) == columns
    assert {c: TYPES.get(t, t) for c, t in frame.dtypes} == kinds
    at = [names.index(c) for c in columns]
    assert rows == ordered(tuple(r[i] for i in at) for r in cursor.fetchall())
