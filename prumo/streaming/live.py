"""Live control state: budgets, breakers, quotas and dispatch decided event by event on a stream.

Each is a stateful operator whose state lives in Spark's state store, keyed and checkpointed, so a restart goes on where the last
batch ended. Events are decided in the order of their time, not of their arrival: they wait in state until the watermark
passes them. What a decision no longer needs is dropped by event-time timers.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import deque
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

STORE = "spark.sql.streaming.stateStore.providerClass"


#: Rows that are packed together before they come to an operator, and rows that one element of a list state holds at most, as one array for
#: each column. What an operator and the state store take goes by keys and blocks, not by single rows.
GATHERED, BLOCK = 1 << 18, 10_000


def _arrays(fields: str) -> str:
    """DDL of an array for each of `fields`."""
    return ", ".join(f"{name} array<{kind}>" for name, kind in map(str.split, fields.split(", ")))


def _place(row: tuple) -> tuple:
    """Order of rows: time, then id, null last; other columns, which may be null, don't count."""
    return row[0], row[1] is None, row[1] or 0


class Settled(StatefulProcessor):
    """Hands on the rows of a key in the order (at, id), once the watermark has passed them.

    at: microseconds. fields: DDL of the columns that rows have beside at and id; gives: of what comes out. Both go in arrays, see
    _decided. One timer a key is enough: it stands at the earliest row that waits. Subclasses say in `take` what rows lead to and
    keep what the state still needs at the watermark; `forget` drops what it doesn't need once the watermark has gone on without rows.
    """

    fields = gives = ""

    def init(self, handle) -> None:
        self.handle = handle
        own = ", ".join(filter(None, ("at long, id long", self.fields)))
        self.width = len(own.split(", "))
        self.held = handle.getListState("held", _arrays(own))
        self.open(handle)

    def open(self, handle) -> None:
        pass

    def take(self, key: tuple, rows: list, now: int) -> Iterator[tuple]:
        """now: the watermark in microseconds."""
        raise NotImplementedError

    def forget(self, key: tuple, now: int) -> None:
        pass

    def wake(self, at: int) -> None:
        """Have `forget` called once the watermark has reached a time in microseconds."""
        self.handle.registerTimer(-(-at // 1000))

    def handleInputRows(self, key, rows, timerValues):
        passed, firsts = 1000 * timerValues.getCurrentWatermarkInMs(), []
        for r in rows:  # rows of the key as arrays, the last columns, see _packed
            pack = r[-self.width :]
            if min(pack[0]) <= passed:  # some come too late; Spark drops packs that all do
                pack = tuple(zip(*(own for own in zip(*pack, strict=True) if own[0] > passed), strict=True))
            for i in range(0, len(pack[0]) if pack else 0, BLOCK):
                self.held.appendValue(tuple(list(c[i : i + BLOCK]) for c in pack))
            firsts += map(min, pack[:1])
        if firsts:
            self.handle.registerTimer(min(firsts) // 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        mark = timerValues.getCurrentWatermarkInMs()
        rows = sorted((r for block in self.held.get() for r in zip(*block, strict=True)), key=_place)
        n = bisect_right(rows, mark, key=lambda r: r[0] // 1000)
        if not n:
            self.forget(key, 1000 * mark)
            return
        if n < len(rows):
            self.held.put([tuple(map(list, zip(*rows[i : i + BLOCK], strict=True))) for i in range(n, len(rows), BLOCK)])
            self.handle.registerTimer(rows[n][0] // 1000)
        else:
            self.held.clear()
        decided, out = self.take(key, rows[:n], 1000 * mark), Row(*(f.split()[0] for f in self.gives.split(", ")))
        while block := list(islice(decided, BLOCK)):
            yield out(*map(list, zip(*block, strict=True)))

    def close(self) -> None:
        pass


#: Values as whole numbers of the smallest double, so that sums are exact and what leaves a window can be taken off.
_UNIT = 1074


def _units(value: float) -> int:
    n, d = value.as_integer_ratio()
    return n << (_UNIT + 1 - d.bit_length())


class Budget(Settled):
    """What a key has spent within `micros` up to each event, events of the same time included. Sums are exact before they are
    rounded to a double, and each row comes into the window and leaves it once."""

    fields, gives = "value double", "id long, spent double"

    def __init__(self, micros: int):
        self.micros = micros

    def open(self, handle) -> None:
        self.recent = handle.getValueState("recent", "at array<long>, value array<double>")

    def take(self, key, rows, now):
        before = self.recent.get()
        recent = deque(zip(*before, strict=True)) if before else deque()
        sure = [v for _, v in recent if v is not None]
        total, odd = sum(_units(v) for v in sure if math.isfinite(v)), deque(v for v in sure if not math.isfinite(v))
        for at, same in groupby(rows, key=lambda r: r[0]):
            same = list(same)
            while recent and recent[0][0] < at - self.micros:
                if (gone := recent.popleft()[1]) is not None:
                    if math.isfinite(gone):
                        total -= _units(gone)
                    else:
                        odd.popleft()
            for _, _, v in same:
                recent.append((at, v))
                if v is not None:
                    if math.isfinite(v):
                        total += _units(v)
                    else:
                        odd.append(v)
            spent = sum(odd) if odd else total / (1 << _UNIT)
            for r in same:
                yield r[1], spent
        self.keep(recent, bool(before), now)

    def keep(self, recent, stored: bool, now: int) -> None:
        """Store the rows that events after the watermark may still need, and wake when they don't."""
        left = [r for r in recent if r[0] >= now - self.micros]
        if left:
            self.recent.update(tuple(map(list, zip(*left, strict=True))))
            self.wake(left[-1][0] + self.micros + 1)
        elif stored:
            self.recent.clear()

    def forget(self, key, now):
        if before := self.recent.get():
            self.keep(list(zip(*before, strict=True)), True, now)


class Breaker(Settled):
    """Failures in a row up to each event, and whether it comes while its key is out: for `micros` after each failure that is
    the least-th in a row or a later one. The end of that time clears the state by itself."""

    fields, gives = "failed boolean", "id long, failures int, out boolean"

    def __init__(self, least: int, micros: int):
        self.least, self.micros = least, micros

    def open(self, handle) -> None:
        self.failures = handle.getValueState("failures", "n int")
        self.until = handle.getValueState("until", "at long")

    def take(self, key, rows, now):
        failures, out_until = self.failures.get(), self.until.get()
        n, until = failures[0] if failures else 0, out_until[0] if out_until else None
        for at, number, failed in rows:
            out = until is not None and at < until
            n = n + 1 if failed else 0
            if n >= self.least:
                until = at + self.micros
            yield number, n, out
        if n:
            self.failures.update((n,))
        elif failures:
            self.failures.clear()
        if until is not None and until > now:
            self.until.update((until,))
            self.wake(until)
        elif out_until:
            self.until.clear()

    def forget(self, key, now):
        until = self.until.get()
        if until and until[0] <= now:
            self.until.clear()


class Quota(Settled):
    """Running number of each event of a key's period, and whether it is within the cap; forgotten when the period is over."""

    fields, gives = "ends long", "id long, used long, within_cap boolean"

    def __init__(self, cap: int):
        self.cap = cap

    def open(self, handle) -> None:
        self.used = handle.getValueState("used", "n long, ends long")

    def take(self, key, rows, now):
        used = self.used.get()
        n = used[0] if used else 0
        for _, number, _ in rows:
            n += 1
            yield number, n, n <= self.cap
        if rows[-1][2] > now:
            self.used.update((n, rows[-1][2]))
            self.wake(rows[-1][2])
        elif used:
            self.used.clear()

    def forget(self, key, now):
        used = self.used.get()
        if used and used[1] <= now:
            self.used.clear()


class Dispatch(Settled):
    """For each event of a period the kind least used in it so far, of those under their caps, the first of equal ones; null if
    none is left. Forgotten when the period is over."""

    fields, gives = "ends long", "id long, kind string"

    def __init__(self, caps: dict[str, int]):
        self.caps = caps

    def open(self, handle) -> None:
        self.used = handle.getMapState("used", "kind string", "n long")
        self.ends = handle.getValueState("ends", "at long")

    def take(self, key, rows, now):
        before = self.ends.get()
        used = dict.fromkeys(self.caps, 0)
        if before:
            used |= {kind: self.used.getValue((kind,))[0] for kind in self.caps if self.used.containsKey((kind,))}
        for _, number, _ in rows:
            kind = min((k for k in used if used[k] < self.caps[k]), key=used.__getitem__, default=None)
            if kind is not None:
                used[kind] += 1
            yield number, kind
        if rows[-1][2] > now:
            for kind, n in used.items():
                self.used.updateValue((kind,), (n,))
            self.ends.update((rows[-1][2],))
            self.wake(rows[-1][2])
        elif before:
            self.ends.clear()
            self.used.clear()

    def forget(self, key, now):
        ends = self.ends.get()
        if ends and ends[0] <= now:
            self.ends.clear()
            self.used.clear()


def _packed(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """rows dealt out by keys, those of a key packed into few rows: _ts, the last time of a pack, and an array for each of `columns`. Spark
    hands rows to an operator in Python value by value, which for single rows takes longer than what is decided."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        while True:
            held, n = [], 0
            for batch in batches:
                held.append(batch)
                n += batch.num_rows
                if n >= GATHERED:
                    break
            if not held:
                return
            packs = pa.Table.from_batches(held).group_by(keys, use_threads=False).aggregate([("_ts", "max"), *((c, "list") for c in columns)])
            packs = packs.select([*keys, "_ts_max", *(f"{c}_list" for c in columns)]).rename_columns([*keys, "_ts", *columns])
            yield from packs.to_batches(max_chunksize=BLOCK)

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "_ts timestamp", *(f"`{c}` array<{kinds[c]}>" for c in columns)])
    return rows.repartition(*keys).mapInArrow(pack, schema)


def _decided(stream: DataFrame, keys: list[str], ts: str, id: str, delay: str, columns: dict[str, Column], processor: Settled) -> DataFrame:
    """What the processor decides, by keys of plain types. Rows that the watermark had passed before their batch are too late and dropped."""
    at = F.col(ts).cast("timestamp")
    rows = stream.select(*keys, at.alias("_ts"), F.unix_micros(at).alias("at"), F.col(id).cast("long").alias("id"), *(c.alias(n) for n, c in columns.items())).filter("at is not null")
    packs = _packed(rows, keys, ["at", "id", *columns]).withWatermark("_ts", delay)
    out = packs.groupBy(*keys).transformWithState(processor, _arrays(processor.gives), "Append", "EventTime")
    return out.select(F.inline(F.arrays_zip(*out.columns)))


def budget(stream: DataFrame, key: str, ts: str, id: str, value: str, seconds: int, delay: str) -> DataFrame:
    """id, spent: see Budget."""
    return _decided(stream, [key], ts, id, delay, {"value": F.col(value).cast("double")}, Budget(seconds * 1_000_000))


def breaker(stream: DataFrame, key: str, ts: str, id: str, failed: Column, least: int, seconds: int, delay: str) -> DataFrame:
    """id, failures, out: see Breaker. A null `failed` is no failure."""
    return _decided(stream, [key], ts, id, delay, {"failed": F.coalesce(failed, F.lit(False))}, Breaker(least, seconds * 1_000_000))


def _days(stream: DataFrame, ts: str, zone: str) -> tuple[DataFrame, Column]:
    """stream with each event's local day as _day, and that day's end in microseconds."""
    day = F.to_date(F.from_utc_timestamp(F.col(ts).cast("timestamp"), zone))
    end = F.unix_micros(F.to_utc_timestamp(F.date_add(day, 1).cast("timestamp"), zone))
    return stream.withColumn("_day", day), end


def day_quota(stream: DataFrame, key: str, ts: str, id: str, cap: int, zone: str, delay: str) -> DataFrame:
    """id, used, within_cap for each key and local day: see Quota."""
    days, end = _days(stream, ts, zone)
    return _decided(days, [key, "_day"], ts, id, delay, {"ends": end}, Quota(cap))


def dispatch(stream: DataFrame, ts: str, id: str, caps: dict[str, int], zone: str, delay: str) -> DataFrame:
    """id, kind for each event of a local day: see Dispatch. One decision rests on the one before it, so a day is one key; caps bound how
    many there can be."""
    days, end = _days(stream, ts, zone)
    return _decided(days, ["_day"], ts, id, delay, {"ends": end}, Dispatch(caps))


@contextmanager
def state_store(spark: SparkSession):
    """The state store that these operators need, for queries started inside."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(STORE) if before is None else spark.conf.set(STORE, before)


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Decide all that has come, append it to the Parquet table at path once, and stop; a later run with the same checkpoint goes on."""
    with state_store(stream.sparkSession):
        query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
