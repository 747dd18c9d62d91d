"""Endpoint health against a loop over the log."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from postlake.functions import classify_failure
from postlake.operators import health
from postlake.operators.state_changes import state_changes, states_at

pytestmark = pytest.mark.usefixtures("many_partitions")
START = datetime(2024, 1, 1)
LOG = "endpoint string, ts timestamp, event_id bigint, ok boolean, status int"


def request_log(seed, n=3000):
    """One endpoint owns half of the requests, and many share a time stamp."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        endpoint = "hot" if rng.random() < 0.5 else f"h{rng.randint(0, 40)}"
        ok = rng.random() < (0.3 if endpoint in ("hot", "h1") else 0.7) and endpoint != "h2"
        status = 200 if ok else rng.choice([500, 500, 503, 429, 429, 404 if endpoint in ("h3", "h4") else 500, None])
        rows.append((endpoint, START + timedelta(seconds=rng.randint(0, n // 4)), i, ok, status))
    rng.shuffle(rows)
    return rows


# What a failure of each status used here counts as.
KINDS = {
    None: "temporary", 400: "dead", 401: "dead", 402: "dead", 403: "dead", 404: "dead", 405: "dead", 407: "dead",
    408: "temporary", 410: "dead", 418: "dead", 429: "temporary", 500: "temporary", 501: "temporary", 502: "temporary",
    503: "temporary", 504: "temporary", 520: "temporary", 522: "temporary", 524: "temporary", 599: "temporary",
}


def expected(rows, as_of=None):
    out = {}
    for endpoint, ts, _, ok, status in sorted(rows, key=lambda r: (r[1], r[2])):
        if as_of is not None and ts > as_of:
            continue
        s = out.setdefault(
            endpoint, {"first": ts, "last_ok": None, "oks": 0, "cur": 0, "max": 0, "dead_kind": False, "last": None}
        )
        s["last"] = ts
        if ok:
            s["last_ok"], s["oks"], s["cur"] = ts, s["oks"] + 1, 0
        else:
            s["cur"] += 1
            s["max"] = max(s["max"], s["cur"])
            s["dead_kind"] |= KINDS[status] == "dead"
    return out


def expected_states(rows, as_of, base, dead_after):
    states = {}
    for endpoint, s in expected(rows, as_of).items():
        ready = s["last"] + timedelta(seconds=base * min(s["cur"], 6))
        if s["dead_kind"] or s["max"] >= dead_after:
            states[endpoint] = ("dead", s["cur"], None)
        elif s["cur"] and ready > as_of:
            states[endpoint] = ("cooldown", s["cur"], ready)
        else:
            states[endpoint] = ("good", s["cur"], None)
    return states


@pytest.fixture(scope="module", params=[1, 2])
def logged(spark, many_partitions, request):
    rows = request_log(request.param)
    return rows, spark.createDataFrame(rows, LOG).repartition(3).cache()


def test_hot_endpoint_is_split(logged):
    segments = health.endpoint_segments(logged[1], timedelta(minutes=1))
    assert segments.filter("endpoint = 'hot'").count() > 1


def test_streaks(logged):
    rows, log = logged
    got = {r["endpoint"]: (r["max_streak"], r["cur_streak"]) for r in health.failure_streaks(log).collect()}
    assert got == {e: (s["max"], s["cur"]) for e, s in expected(rows).items()}


@pytest.mark.parametrize("seconds", [None, 300])
def test_ledger(logged, seconds):
    rows, log = logged
    as_of = None if seconds is None else START + timedelta(seconds=seconds)
    ledger = health.health_ledger(log, None if as_of is None else F.lit(as_of))
    got = {r["endpoint"]: (r["last_ok"], r["ok_streak"], r["fail_streak"]) for r in ledger.collect()}
    assert got == {e: (s["last_ok"] or s["first"], s["oks"], s["cur"]) for e, s in expected(rows, as_of).items()}


@pytest.mark.parametrize("base, dead_after", [(300, 7), (60, 3), (60, 1000)])
def test_states(logged, base, dead_after):
    rows, log = logged
    as_of = START + timedelta(seconds=700)
    states = health.pool_state(log, F.lit(as_of), base, dead_after=dead_after)
    got = {r["endpoint"]: (r["state"], r["failures"], r["ready_at"]) for r in states.collect()}
    want = expected_states(rows, as_of, base, dead_after)
    assert got == want
    counts = health.pool_stats(states).first()
    for state in ("good", "cooldown", "dead"):
        assert counts[state] == sum(s[0] == state for s in want.values())


def loop_changes(rows, base, dead_after):
    """Endpoint by endpoint and instant by instant, with the end of a cool-down where nothing came before it."""
    out, logs = [], {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        logs.setdefault(r[0], []).append(r)
    for endpoint, log in logs.items():
        streak, dead, seen = 0, False, False
        moments = sorted({r[1] for r in log})
        for here, after in zip(moments, [*moments[1:], None]):
            told = not seen
            for _, _, _, ok, status in (r for r in log if r[1] == here):
                told |= streak > 0 or not ok
                streak = 0 if ok else streak + 1
                dead |= streak >= dead_after or (not ok and KINDS[status] == "dead")
            seen, ready = True, here + timedelta(seconds=base * min(streak, 6))
            cooling = not dead and ready > here
            state = "dead" if dead else "cooldown" if cooling else "good"
            if told:
                out.append((endpoint, here, state, streak, ready if cooling else None))
            if cooling and (after is None or after > ready):
                out.append((endpoint, ready, "good", streak, None))
    return out


@pytest.mark.parametrize("base, dead_after", [(3, 7), (0, 5), (40, 1000)])
def test_state_changes(spark, logged, base, dead_after):
    rows = logged[0]
    rows = [*rows, (None, START, -1, False, 500), ("hot", None, -2, False, 404)]
    log = spark.createDataFrame(rows, LOG)
    changes = state_changes(log, base, dead_after=dead_after, time_slice=timedelta(seconds=50)).cache()
    order = lambda found: sorted(found, key=lambda r: (r[0], r[1]))
    want = loop_changes([r for r in rows if r[0] and r[1]], base, dead_after)
    assert order(map(tuple, changes.collect())) == order(want)
    for seconds in (0, 1, 99, 100, 431, 745, 900, 5000):
        as_of = F.lit(START + timedelta(seconds=seconds))
        states = health.pool_state(log.filter("endpoint IS NOT NULL"), as_of, base, dead_after=dead_after)
        assert sorted(map(tuple, states_at(changes, as_of).collect())) == sorted(map(tuple, states.collect()))


def test_combining_is_associative(logged):
    _, log = logged
    segments = health.endpoint_segments(log).cache()
    left = health.combine_segments(segments.filter("seq < 2"), seq=-1)
    again = health.combine_segments(left.unionByName(segments.filter("seq >= 2")))
    once = health.combine_segments(segments)
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, once.collect()), key=repr)


def test_unused_endpoints_are_good(spark, logged):
    _, log = logged
    listed = spark.createDataFrame([("hot",), ("never used",)], "endpoint string")
    states = health.pool_state(log, endpoints=listed)
    assert states.filter("endpoint = 'never used' AND state = 'good' AND failures = 0").count() == 1


@pytest.mark.parametrize("n", [1, 5, 100000])
def test_first_n_passing(logged, n):
    rows, log = logged
    want, passed = [], 0
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        if passed >= n:
            break
        want.append(r[2])
        passed += r[3]
    assert sorted(r["event_id"] for r in health.first_n_passing(log, n).collect()) == sorted(want)


def test_all_statuses(spark):
    df = spark.createDataFrame([(s,) for s in [None, *range(100, 700)]], "status int")
    got = {r[0]: r[1] for r in df.select("status", classify_failure(F.col("status"))).collect()}
    assert {s: got[s] for s in KINDS} == KINDS
    # What the table does not name is final below 500 and passing from there on.
    assert {got[s] for s in range(100, 500) if s not in KINDS} == {"dead"}
    assert {got[s] for s in range(500, 700)} == {"temporary"}
