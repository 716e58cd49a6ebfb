"""Records resolved by shares: what a share keeps, how often it is written, and odd values."""

import datetime as dt
import json
import math

import pandas as pd
import pytest
from pyspark.sql import types as T

from murmur.streaming import keyed
from tests.test_keyed_streams import Feed

FIELDS = keyed.RECORD.names
SCHEMA = T.StructType([T.StructField("record_type", T.StringType()),
                       T.StructField("record_id", T.LongType()), *keyed.RECORD.fields, keyed.INTERESTS])


class ListState:
    def __init__(self):
        self.held, self.reads, self.writes = [], 0, 0

    def get(self):
        self.reads += 1
        return iter(self.held)

    def put(self, values):
        self.writes += 1
        self.held = list(values)

    def appendValue(self, value):
        self.writes += 1
        self.held.append(value)


class Handle:
    def __init__(self):
        self.lists = {}

    def getListState(self, name, schema):
        return self.lists.setdefault(name, ListState())


def test_a_share_is_read_and_written_once_a_batch():
    names = ["name", "arrival", "copy", "interests"]
    out = T.StructType([T.StructField(c, T.StringType()) for c in names])
    handle, resolver = Handle(), keyed.Resolver(out, keyed.RECORD)
    resolver.init(handle)
    rows = 0
    for batch in range(10):
        frame = pd.DataFrame([
            (json.dumps({"record_type": "user_profile", "record_id": i}), str(batch * 3 + turn),
             json.dumps(dict.fromkeys(FIELDS) | {"seq": batch * 3 + turn, "follower_count": batch}),
             json.dumps([f"w{batch}"]))
            for turn in (2, 0, 1) for i in range(5)], columns=["name", "seq", "copy", "interests"])
        found = pd.concat(resolver.handleInputRows((0,), iter([frame[:7], frame[7:]]), None))
        rows += len(found)
        last = found[found.arrival == str(batch * 3 + 2)]
        assert [json.loads(c)["follower_count"] for c in last["copy"]] == [batch] * 5
        assert {tuple(json.loads(w)) for w in last.interests} == {tuple(f"w{b}" for b in range(batch + 1))}
        kept = handle.lists["changes"]
        assert (kept.reads, kept.writes) == (batch + 1, batch + 1)
        assert sum(len(json.loads(text)) for text, in kept.held) <= 10
    assert rows == 150


def odd_copies():
    at = dt.datetime(2024, 1, 1, 0, 0, 0, 123457)
    late = at + dt.timedelta(microseconds=1)
    score = [float("nan"), None, float("inf"), 1e300, -0.0, 0.1 + 0.2]
    rows = []
    for seq in range(24):
        rows.append({
            "record_type": [None, "user_profile", "content_metadata", "versioned"][seq % 4],
            "record_id": [None, 2 ** 62 + 1][seq // 4 % 2], "seq": 2 ** 60 + seq,
            "username": ['q"\\\n', None, "é\U0001f600"][seq % 3],
            "follower_count": [None, 2 ** 61 + seq][seq % 2], "following_count": None,
            "engagement_rate": score[seq // 4], "bio": [None, "", "NaN"][seq % 3],
            "category": "Infinity", "engagement_score": score[seq // 8], "source": ["a", None][seq // 8 % 2],
            "sequence": seq, "updated_at": [at, late, None][seq // 4 % 3], "created_at": at,
            "interests": [None, [], ["b", 'a"'], ["c"]][seq // 4 % 4]})
    return rows


def folded(copies):
    """Every resolved record by the rules on plain values."""
    state, words, out = {}, {}, []
    for copy in sorted(copies, key=lambda c: c["seq"]):
        key = copy["record_type"], copy["record_id"]
        plain = {c: copy[c] for c in FIELDS}
        rule = keyed.RULES.get(key[0], keyed.last_write)
        state[key] = rule(state[key], plain) if key in state else plain
        words.setdefault(key, set()).update(copy["interests"] or [])
        listed = sorted(words[key]) if key[0] == "user_profile" else None
        out.append((*key, copy["seq"], *(state[key][c] for c in FIELDS), listed))
    return out


def shown(rows):
    """Rows with what is no number as text, and counts and rates of equal type."""
    return sorted((tuple(str(float(x)) if isinstance(x, float) or x == 0 else x for x in r)
                   for r in rows), key=str)


@pytest.mark.parametrize("cuts", [(24,), (7, 8, 24)])
def test_odd_values_are_those_of_the_rules(spark, cuts):
    copies = odd_copies()
    frame = spark.createDataFrame([tuple(c[n] for n in SCHEMA.names) for c in copies], SCHEMA)
    feed, first = Feed(spark, SCHEMA, lambda rows: keyed.resolved(rows, shares=2)), 0
    for cut in cuts:
        feed.add(frame.where(f"seq >= {2 ** 60 + first} AND seq < {2 ** 60 + cut}")).run()
        first = cut
    got = feed.rows()
    assert shown(got) == shown(folded(copies))
    assert any(isinstance(x, float) and math.isnan(x) for r in got for x in r)


def test_copies_hold_only_what_their_text_gives_back(spark):
    record = T.StructType([T.StructField("seq", T.LongType()), T.StructField("x", T.DecimalType(30, 2))])
    frame = spark.createDataFrame([], "record_type string, record_id long, seq long, x decimal(30, 2), "
                                      "interests array<string>")
    with pytest.raises(ValueError, match="x$"):
        keyed.resolved(frame, record=record)
