"""Live decisions against plain ones made over all events in order, with events out of order and runs that stop and go on."""

import datetime as dt
import random
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from prumo.streaming import live

SCHEMA = "event_id long, ts timestamp, user string, kind string, value double"
START = dt.datetime(2024, 3, 1)
HOUR = 3600


def some_events(rng, n):
    """In order of time; the last one a day later, so that the watermark passes all others."""
    at, out = 0.0, []
    for i in range(n):
        at += rng.choice([0, 0, 5, 60, 600, 4000])
        out.append((i, START + dt.timedelta(seconds=at, microseconds=rng.choice([0, 0, 7])), rng.choice("abc"), rng.choice(["ok", "error", "error"]), rng.choice([None, 1.0, 2.5])))
    out.sort(key=lambda e: (e[1], e[0]))
    return [*out, (n, out[-1][1] + dt.timedelta(days=1), "z", "ok", 0.0)]


def plain_budget(events, seconds):
    return {(e[0], sum(o[4] or 0 for o in events if o[2] == e[2] and e[1] - dt.timedelta(seconds=seconds) <= o[1] <= e[1])) for e in events}


def plain_breaker(events, least, seconds):
    out, state = set(), {}
    for i, ts, user, kind, _ in events:
        n, until = state.get(user, (0, dt.datetime.min))
        n = n + 1 if kind == "error" else 0
        out.add((i, n, ts < until))
        state[user] = (n, ts + dt.timedelta(seconds=seconds) if n >= least else until)
    return out


def local_day(ts):
    return ts.replace(tzinfo=dt.UTC).astimezone(ZoneInfo("America/Sao_Paulo")).date()


def plain_quota(events, cap):
    out, used = set(), {}
    for i, ts, _, kind, _ in events:
        key = kind, local_day(ts)
        used[key] = used.get(key, 0) + 1
        out.add((i, used[key], used[key] <= cap))
    return out


def plain_dispatch(events, caps):
    out, days = set(), {}
    for i, ts, *_ in events:
        used = days.setdefault(local_day(ts), dict.fromkeys(caps, 0))
        kind = min((k for k in caps if used[k] < caps[k]), key=lambda k: used[k], default=None)
        if kind:
            used[kind] += 1
        out.add((i, kind))
    return out


CASES = {
    "budget": (lambda s: live.budget(s, "user", "ts", "event_id", "value", HOUR, "2 hours"), lambda e: plain_budget(e, HOUR)),
    "breaker": (lambda s: live.breaker(s, "user", "ts", "event_id", F.col("kind") == "error", 3, 2 * HOUR, "2 hours"), lambda e: plain_breaker(e, 3, 2 * HOUR)),
    "quota": (lambda s: live.day_quota(s, "kind", "ts", "event_id", 4, "America/Sao_Paulo", "2 hours"), lambda e: plain_quota(e, 4)),
    "dispatch": (lambda s: live.dispatch(s, "ts", "event_id", {"x": 2, "y": 9, "w": 3}, "America/Sao_Paulo", "2 hours"), lambda e: plain_dispatch(e, {"x": 2, "y": 9, "w": 3})),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_runs_that_stop_and_go_on(spark, tmp_path, name):
    rng = random.Random(name)
    events = some_events(rng, 150)
    arrival = sorted(events, key=lambda e: e[1] + dt.timedelta(seconds=rng.randint(0, 2 * HOUR - 1)) if e[2] != "z" else e[1])
    build, plain = CASES[name]
    src, out, mark = (str(tmp_path / x) for x in ("src", "out", "mark"))
    sizes = []
    for part in (arrival[:60], arrival[60:61], arrival[61:110], arrival[110:]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        live.run_to_parquet(build(spark.readStream.schema(SCHEMA).parquet(src)), out, mark)
        sizes.append(spark.read.parquet(out).count())
    assert 0 < sizes[0] < sizes[-1]
    got = [tuple(r) for r in spark.read.parquet(out).collect()]
    last = events[-1][0]
    assert len(got) == len(set(got)) == 150  # all but the last event, which nothing has settled
    assert set(got) == {x for x in plain(events) if x[0] != last}
    if name in ("breaker", "quota"):
        live_state = spark.read.format("statestore").option("path", mark).option("stateVarName", {"breaker": "until", "quota": "used"}[name]).load()
        assert live_state.count() == 0  # what was out or counted has ended by itself


def test_late_and_odd_rows(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("src", "out", "mark"))
    run = lambda: live.run_to_parquet(live.budget(spark.readStream.schema(SCHEMA).parquet(src), "user", "ts", "event_id", "value", HOUR, "10 seconds"), out, mark)
    at = lambda s: START + dt.timedelta(seconds=s)
    put = lambda rows: spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    put([(1, at(0), "a", None, 1.0), (1, at(0), "a", None, 1.0), (2, None, "a", None, 5.0), (3, at(100), None, None, 2.0)])
    run()
    put([(4, at(1), "a", None, 9.0), (5, at(200), "a", None, 1.0)])  # the first one comes too late
    run()
    run()
    put([(6, at(9000), "a", None, 4.0)])
    run()
    assert sorted((r.id, r.spent) for r in spark.read.parquet(out).collect()) == [(1, 2.0), (1, 2.0), (3, 2.0), (5, 3.0)]


class Counting:
    """A list state of one key that counts its calls."""

    def __init__(self):
        self.elements, self.calls = [], 0

    def appendValue(self, element):
        self.calls += 1
        self.elements.append(element)


def test_rows_reach_operators_and_state_in_packs(spark, tmp_path):
    """Each row by itself was one element of the state, and one value of the operator's input."""
    src, out, mark = (str(tmp_path / x) for x in ("src", "out", "mark"))
    rows = spark.range(30_000).selectExpr("id AS event_id", "timestamp'2024-03-01' + make_interval(0, 0, 0, 0, 0, 0, id % 900) AS ts", "CAST(id % 3 AS string) AS user", "'ok' AS kind", "CAST(1 AS double) AS value")
    rows.coalesce(1).write.parquet(src)
    query = live.budget(spark.readStream.schema(SCHEMA).parquet(src), "user", "ts", "event_id", "value", HOUR, "2 hours")
    live.run_to_parquet(query, out, mark)  # nothing is settled, all rows wait
    held = spark.read.format("statestore").option("path", mark).option("stateVarName", "held").load().selectExpr("size(list_element.at) AS n").collect()
    assert len(held) <= 12 and sum(r.n for r in held) == 30_000
    spark.createDataFrame([(30_000, START + dt.timedelta(days=1), "z", "ok", 0.0)], SCHEMA).write.mode("append").parquet(src)
    live.run_to_parquet(query, out, mark)
    got = {r.event_id: r.spent for r in spark.read.parquet(out).withColumnRenamed("id", "event_id").collect()}
    # 3 users by turns, 900 seconds: each user has 300 seconds of its own, and at most 34 events in each
    seconds = {}
    for i in range(30_000):
        seconds.setdefault(i % 3, {}).setdefault(i % 900, []).append(i)
    for own in seconds.values():
        spent = 0.0
        for s in sorted(own):
            spent += len(own[s])
            assert all(got[i] == spent for i in own[s])


def test_packs_that_come_partly_late():
    operator, timers = live.Budget(1_000_000), []
    operator.width, operator.held = 3, Counting()
    operator.handle = type("Handle", (), {"registerTimer": staticmethod(timers.append)})
    values = type("Timers", (), {"getCurrentWatermarkInMs": staticmethod(lambda: 5)})
    packs = [("k", None, [5000, 7000, 5001], [1, 2, 3], [1.0, None, 2.0]), ("k", None, [9000], [4], [1.0]), ("k", None, [4000], [5], [1.0])]
    list(operator.handleInputRows(("k",), iter(packs), values))
    assert operator.held.elements == [([7000, 5001], [2, 3], [None, 2.0]), ([9000], [4], [1.0])]
    assert timers == [5]


def test_sums_of_full_windows_and_odd_values(spark, tmp_path):
    """Rows of the same time and id, one without a value; values that are no numbers while they are in the window; sums that are exact."""
    src, out, mark = (str(tmp_path / x) for x in ("src", "out", "mark"))
    at = lambda s: START + dt.timedelta(seconds=s)
    rows = [(1, at(0), "a", None, 1e16), (1, at(0), "a", None, None), (None, at(0), "a", None, 1.0), (2, at(10), "a", None, float("inf")), (3, at(20), "a", None, 1.0), (4, at(3601), "a", None, -1e-3), (5, at(3611), "a", None, 0.1), (6, at(9000), "z", None, 0.0)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(src)
    live.run_to_parquet(live.budget(spark.readStream.schema(SCHEMA).parquet(src), "user", "ts", "event_id", "value", HOUR, "0 seconds"), out, mark)
    got = sorted(((r.id or 0, r.spent) for r in spark.read.parquet(out).collect()))
    first = 1e16 + 1
    assert got == [(0, first), (1, first), (1, first), (2, float("inf")), (3, float("inf")), (4, float("inf")), (5, 1.0 - 1e-3 + 0.1), (6, 0.0)]
