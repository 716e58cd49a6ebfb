"""Operators with their own state per key: ``transformWithState`` processors.

A processor sees all rows of a key and micro-batch at once, reads its state once and writes it
once. Rows of a key are taken in the order of a column, so the result does not depend on how the
input is cut into batches, as long as the batches follow that order. Timers run on event time and
fire when the watermark has passed them.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from murmur.functions.ranking import top_per_key

Record = dict[str, Any]
Rule = Callable[[Record, Record], Record]


class Keyed(StatefulProcessor):
    """What the processors share: rows in order, and a closed processor with nothing to free."""

    order: tuple[str, ...] = ()

    def __init__(self, out: T.StructType) -> None:
        self.row = Row(*out.names)

    def in_order(self, rows: Iterator[Row]) -> list[Row]:
        return sorted(rows, key=lambda r: tuple(r[c] for c in self.order))

    def close(self) -> None:
        pass


# Conflict resolution

def later(old: Any, new: Any) -> bool:
    return old is not None and new is not None and new > old


def last_write(old: Record, new: Record) -> Record:
    """The newer copy by update, else creation; the older one where a time is missing."""
    return new if later(*(r["created_at"] if r["updated_at"] is None else r["updated_at"]
                          for r in (old, new))) else old


def merged_content(old: Record, new: Record) -> Record:
    """The newer copy by update, with the higher score."""
    if not later(old["updated_at"], new["updated_at"]):
        return old
    return new | {"engagement_score": max(old["engagement_score"] or 0.0,
                                          new["engagement_score"] or 0.0)}


def merged_profile(old: Record, new: Record) -> Record:
    """Counts and rate never fall, times neither; the rest keeps its last known value."""
    out = old | {c: v for c, v in new.items() if v is not None} | {"username": new["username"]}
    for c in ("follower_count", "following_count", "engagement_rate"):
        out[c] = max(old[c] or 0, new[c] or 0)
    out["updated_at"] = (old if later(new["updated_at"], old["updated_at"]) else new)["updated_at"]
    return out


def newer_version(old: Record, new: Record) -> Record:
    """By sequence within a source, by time across sources."""
    by = "sequence" if old["source"] == new["source"] else "updated_at"
    return new if later(old[by], new[by]) else old


RULES: dict[str, Rule] = {"user_profile": merged_profile, "content_metadata": merged_content,
                          "versioned": newer_version}

#: What the rules look at; a copy may have more columns.
RECORD = T.StructType([
    T.StructField("seq", T.LongType()), T.StructField("username", T.StringType()),
    T.StructField("follower_count", T.LongType()), T.StructField("following_count", T.LongType()),
    T.StructField("engagement_rate", T.DoubleType()), T.StructField("bio", T.StringType()),
    T.StructField("category", T.StringType()), T.StructField("engagement_score", T.DoubleType()),
    T.StructField("source", T.StringType()), T.StructField("sequence", T.LongType()),
    T.StructField("updated_at", T.TimestampType()), T.StructField("created_at", T.TimestampType())])
INTERESTS = T.StructField("interests", T.ArrayType(T.StringType()))


#: Types that a copy may hold: their JSON text gives back exactly the same value.
PLAIN = (T.StringType, T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DoubleType, T.FloatType,
         T.BooleanType, T.DateType, T.BinaryType)


class Resolver(StatefulProcessor):
    """Emits the resolved record after every copy, by the rule of its type.

    A call sees the copies of one share of the records as text: a call and a batch of columns for
    every record, and every cell by itself, would cost more than the rules. State of a share: a
    list of what the batches changed, each a text of the records' resolved copies and interests by
    name, of which the last one holds. A batch reads the list of a share that it touches and adds
    to it once; the list is folded when half of it is out of date.
    """

    ROWS = 10_000  # of a frame that is passed on

    def __init__(self, out: T.StructType, record: T.StructType) -> None:
        self.out = out.names
        self.doubles = [f.name for f in record.fields
                        if isinstance(f.dataType, (T.DoubleType, T.FloatType))]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.changes = handle.getListState("changes", "records string")

    def parsed(self, texts: list[str]) -> list[Record]:
        records = json.loads(f"[{','.join(texts)}]")
        for c in self.doubles:  # Spark writes what is no number as a string
            for record in records:
                if isinstance(record[c], str):
                    record[c] = float(record[c])
        return records

    def stored(self) -> tuple[dict[str, list], int]:
        """The records of the share by name, and how many the list holds for them."""
        records, n = {}, 0
        for (text,) in self.changes.get():
            changed = json.loads(text)
            records |= changed
            n += len(changed)
        return records, n

    def store(self, known: dict[str, list], n: int, changed: dict[str, list]) -> None:
        merged = known | changed
        if n + len(changed) > 2 * len(merged):
            self.changes.put([(json.dumps(merged),)])
        else:
            self.changes.appendValue((json.dumps(changed),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        records: dict[str, list[tuple]] = {}
        for frame in rows:
            for name, *copy in zip(*(frame[c] for c in ("name", "seq", "copy", "interests"))):
                records.setdefault(name, []).append(copy)
        known, n = self.stored()
        changed: dict[str, list] = {}
        found: list[tuple] = []
        for name, copies in records.items():
            copies.sort(key=lambda c: (c[0] is not None, int(c[0] or 0)))
            for row in self.folded(name, copies, known.get(name)):
                found.append(row)
                if len(found) == self.ROWS:
                    yield pd.DataFrame(found, columns=self.out)
                    found = []
            changed[name] = list(row[2:])
        if found:
            yield pd.DataFrame(found, columns=self.out)
        self.store(known, n, changed)

    def folded(self, name: str, copies: list[tuple], state: list | None) -> Iterator[tuple]:
        rule = RULES.get(json.loads(name)["record_type"], last_write)
        profile = rule is merged_profile
        text, listed = state or (None, None)
        record = self.parsed([text])[0] if text is not None else None
        words = set(json.loads(listed or "[]")) if profile else set()
        listed = json.dumps(sorted(words)) if profile else None
        for (seq, given, interests), copy in zip(copies, self.parsed([c[1] for c in copies])):
            last, record = record, rule(record, copy) if record else copy
            if record is copy:
                text = given
            elif record is not last:
                text = json.dumps(record)
            new = set(json.loads(interests)) - words if profile and interests else None
            if new:
                words |= new
                listed = json.dumps(sorted(words))
            yield name, seq, text, listed

    def handleInitialState(self, key, initialState, timerValues) -> None:
        known, n = self.stored()
        changed: dict[str, list] = {}
        for name, copy, interests in zip(*(initialState[c] for c in ("name", "copy", "interests"))):
            words = set(json.loads(interests or "[]"))
            before = changed.get(name) or known.get(name)
            if before:
                words |= set(json.loads(before[1]))
            changed[name] = [copy, json.dumps(list(words))]
        self.store(known, n, changed)

    def close(self) -> None:
        pass


def resolved(copies: DataFrame, known: DataFrame | None = None, record: T.StructType = RECORD,
             shares: int = 1024) -> DataFrame:
    """record_type, record_id, arrival and the resolved record after every copy of it.

    copies: record_type, record_id, the columns of ``record`` (seq is the order of arrival) and
    interests. ``known`` is a table of records in the same layout, for example the batch fold of
    the past; the stream goes on from it. Records are dealt into ``shares``, whose number must
    stay while a checkpoint is in use; a task holds the copies of one share and micro-batch.
    """
    times = [f.name for f in record.fields if isinstance(f.dataType, T.TimestampType)]
    # Times are kept as microseconds, which their text gives back exactly.
    kept = T.StructType([T.StructField(f.name, T.LongType()) if f.name in times else f
                         for f in record.fields])
    odd = [f.name for f in kept.fields if not isinstance(f.dataType, PLAIN)]
    if odd:
        raise ValueError(f"a copy cannot hold columns of these types: {', '.join(odd)}")
    keys = T.StructType([T.StructField("record_type", T.StringType()), copies.schema["record_id"]])

    def text(*columns: Column) -> Column:
        return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})

    def packed(rows: DataFrame) -> DataFrame:
        of_time = [F.unix_micros(c).alias(c) if c in times else F.col(c) for c in record.names]
        rows = rows.select(text(*map(F.col, keys.names)).alias("name"),
                           F.col("seq").cast("string").alias("seq"), text(*of_time).alias("copy"),
                           F.to_json(INTERESTS.name).alias("interests"))
        return rows.withColumn("share", F.pmod(F.xxhash64("name"), F.lit(shares)))

    out = T.StructType([T.StructField(c, T.StringType())
                        for c in ("name", "arrival", "copy", "interests")])
    start = None if known is None else packed(known).groupBy("share")
    found = packed(copies).groupBy("share").transformWithStateInPandas(
        Resolver(out, kept), out, "Append", "None", start)
    found = found.select(
        F.from_json("name", keys).alias("key"), F.col("arrival").cast("long").alias("arrival"),
        F.from_json("copy", kept).alias("record"),
        F.from_json("interests", INTERESTS.dataType).alias(INTERESTS.name))
    return found.select("key.*", "arrival", "record.*", INTERESTS.name).withColumns(
        {c: F.timestamp_micros(c) for c in times})


# First results of repeated requests

class FirstResult(Keyed):
    """A repeat within ``memory`` of the first request gets its result again; later ones are new.

    The state of a request holds the time and result of the first one, and goes by a timer.
    """

    order = ("ts", "request_id")

    def __init__(self, out: T.StructType, memory_s: int, result: T.DataType) -> None:
        super().__init__(out)
        self.memory_s = memory_s
        self.schema = T.StructType([T.StructField("first_us", T.LongType()),
                                    T.StructField("result", result)])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first = self.first.get() if self.first.exists() else None
        start = first
        for row in self.in_order(rows):
            repeat = first is not None and row["us"] - first[0] < self.memory_s * 1_000_000
            if not repeat:
                first = (row["us"], row["result"])
            yield self.row(*key, row["request_id"], row["ts"], first[1], repeat)
        if first != start:
            if start is not None:
                self.handle.deleteTimer(self.expiry(start))
            self.first.update(tuple(first))
            self.handle.registerTimer(self.expiry(first))

    def expiry(self, first: tuple) -> int:
        return first[0] // 1000 + self.memory_s * 1000

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        first = self.first.get() if self.first.exists() else None
        if first is not None and self.expiry(first) <= expiredTimerInfo.getExpiryTimeInMs():
            self.first.clear()
        return iter(())


def first_results(requests: DataFrame, memory_s: int = 86400, delay: str = "10 minutes") -> DataFrame:
    """key, request_id, ts, first_result, is_repeat of every request (key, request_id, ts,
    result). Requests behind the watermark are dropped."""
    result = requests.schema["result"].dataType
    out = T.StructType([
        requests.schema["key"], requests.schema["request_id"], requests.schema["ts"],
        T.StructField("first_result", result), T.StructField("is_repeat", T.BooleanType())])
    rows = requests.withWatermark("ts", delay).select(
        "key", "request_id", "ts", "result", F.unix_micros("ts").alias("us"))
    return rows.groupBy("key").transformWithState(
        FirstResult(out, memory_s, result), out, "Append", "EventTime", eventTimeColumnName="ts")


# Retries of dead letters

class Retries(Keyed):
    """Failures of a record become due attempts after their backoff.

    The state holds the failures so far, the last one's time and error; the timer of the next
    attempt sets the one that forgets the record. A failure before the attempt is due replaces
    it.
    """

    order = ("ts", "seq")

    def __init__(self, out: T.StructType, most: int, base_s: float, factor: float, limit_s: float,
                 memory_s: int) -> None:
        super().__init__(out)
        self.most, self.base_s, self.factor, self.limit_s = most, base_s, factor, limit_s
        self.memory_s = memory_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState(
            "failures", "attempts long, last_ms long, due_ms long, error_type string")

    def delay_ms(self, attempts: int) -> int:
        return int(1000 * min(self.base_s * self.factor ** attempts, self.limit_s))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state = self.state.get() if self.state.exists() else None
        attempts, last, due, error = state or (0, None, None, None)
        before = due
        for row in self.in_order(rows):
            if last is not None and row["ms"] - last >= self.memory_s * 1000:
                if due is not None:  # it was due long before this failure
                    yield self.attempt(key, attempts, due, error)
                attempts, due = 0, None
            elif due is not None and due <= row["ms"]:
                yield self.attempt(key, attempts, due, error)
            attempts, last, error = attempts + 1, row["ms"], row["error_type"]
            due = last + self.delay_ms(attempts) if attempts < self.most else None
            if attempts == self.most:
                yield self.row(*key, attempts, last, error, "permanent")
        if before is not None and before != due:
            self.handle.deleteTimer(before)
        if due is not None:
            self.handle.registerTimer(due)
        self.state.update((attempts, last, due, error))
        self.handle.registerTimer(last + self.memory_s * 1000)

    def attempt(self, key, attempts: int, due: int, error: str) -> Row:
        return self.row(*key, attempts, due, error, "retry")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.state.exists():
            return
        now = expiredTimerInfo.getExpiryTimeInMs()
        attempts, last, due, error = self.state.get()
        if due is not None and due <= now:
            yield self.attempt(key, attempts, due, error)
            due = None
            self.state.update((attempts, last, due, error))
        if last + self.memory_s * 1000 <= now:
            self.state.clear()


def retries(failures: DataFrame, most: int = 10, base_s: float = 1.0, factor: float = 2.0,
            limit_s: float = 60.0, memory_s: int = 86400, delay: str = "10 minutes") -> DataFrame:
    """key, attempts, at_ms, error_type, action of the failures (key, seq, ts, error_type).

    ``retry`` is emitted when the backoff after the last of ``attempts`` failures is over,
    ``permanent`` once at the failure number ``most``. A record without a failure for
    ``memory_s`` starts anew.
    """
    out = T.StructType([
        failures.schema["key"], T.StructField("attempts", T.LongType()),
        T.StructField("at_ms", T.LongType()), failures.schema["error_type"],
        T.StructField("action", T.StringType())])
    rows = failures.withWatermark("ts", delay).select(
        "key", "seq", "ts", "error_type", F.unix_millis("ts").alias("ms"))
    return rows.groupBy("key").transformWithState(
        Retries(out, most, base_s, factor, limit_s, memory_s), out, "Append", "EventTime")


# Rankings at an interval

class Publisher(Keyed):
    """The local top of the open windows of one share of the keys, at the end of every slot.

    Counts of a slot wait in a map until the slot's timer adds them to the totals of the open
    windows, emits the ``top`` largest and drops the windows that have expired. So however many
    events arrive, a share publishes once a slot.
    """

    def __init__(self, out: T.StructType, slot_s: int, size_s: int, grace_s: int, top: int) -> None:
        super().__init__(out)
        self.slot_s, self.size_s, self.grace_s, self.top = slot_s, size_s, grace_s, top

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        counts = "counts array<struct<tag:string,window:long,n:long>>"
        self.waiting = handle.getMapState("waiting", "slot long", counts)
        self.open = handle.getValueState("open", counts)

    def slots(self, second: int, window: int) -> range:
        """Ends of the slots from the one that holds ``second`` to the window's last one."""
        first = second // self.slot_s * self.slot_s + self.slot_s
        return range(first, window + self.size_s + self.grace_s, self.slot_s)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new: dict[int, dict[tuple[str, int], int]] = {}
        due: set[int] = set()
        for row in rows:
            window = row["s"] // self.size_s * self.size_s
            slots = self.slots(row["s"], window)
            if slots:
                counts = new.setdefault(slots[0], {})
                counts[row["tag"], window] = counts.get((row["tag"], window), 0) + row["n"]
                due.update(slots)
        for slot, counts in new.items():
            if self.waiting.containsKey((slot,)):
                for tag, window, n in self.waiting.getValue((slot,))[0]:
                    counts[tag, window] = counts.get((tag, window), 0) + n
            self.waiting.updateValue((slot,), (listed(counts),))
        for slot in due:
            self.handle.registerTimer(slot * 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        slot = expiredTimerInfo.getExpiryTimeInMs() // 1000
        counts = {(tag, window): n for tag, window, n in (
            self.open.get()[0] if self.open.exists() else [])}
        if self.waiting.containsKey((slot,)):
            for tag, window, n in self.waiting.getValue((slot,))[0]:
                counts[tag, window] = counts.get((tag, window), 0) + n
            self.waiting.removeKey((slot,))
        counts = {x: n for x, n in counts.items() if x[1] + self.size_s + self.grace_s > slot}
        self.open.update((listed(counts),))
        best = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:self.top]
        for (tag, window), n in best:
            yield self.row(*key, slot, tag, window, n)


def listed(counts: dict[tuple[str, int], int]) -> list[tuple]:
    return [(tag, window, n) for (tag, window), n in counts.items()]


def published(tags: DataFrame, slot_s: int = 30, size_s: int = 1800, grace_s: int = 300,
              top: int = 10, shares: int = 8, delay: str = "5 minutes") -> DataFrame:
    """share, slot, tag, window_start, n: each share's ``top`` open windows at each slot's end.

    tags: ts, tag. Slots must divide windows. The events of a slot are counted by Spark first,
    so a share gets one row per tag and slot; ``slot_ranking`` merges the shares, and no task
    ever sees all tags.
    """
    if size_s % slot_s:
        raise ValueError("a window must hold whole slots")
    counts = tags.withWatermark("ts", delay).groupBy(F.window("ts", f"{slot_s} seconds"), "tag").agg(
        F.count(F.lit(1)).alias("n"))
    rows = counts.select(
        F.window_time("window").alias("ts"), "tag", F.unix_seconds("window.start").alias("s"), "n",
        F.pmod(F.xxhash64("tag"), F.lit(shares)).alias("share"))
    out = T.StructType([T.StructField(c, T.StringType() if c == "tag" else T.LongType())
                        for c in ("share", "slot", "tag", "window_start", "n")])
    return rows.groupBy("share").transformWithState(
        Publisher(out, slot_s, size_s, grace_s, top), out, "Append", "EventTime")


def slot_ranking(parts: DataFrame, top: int = 10) -> DataFrame:
    """slot, rank, tag, window_start, n: the shares' lists of a slot merged."""
    order = [F.desc("n"), F.asc("tag"), F.asc("window_start")]
    return top_per_key(parts, ["slot"], order, top).select(
        "slot", "rank", "tag", "window_start", "n")
