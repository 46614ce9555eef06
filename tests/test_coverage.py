"""Coverage gaps, period totals against daily ones, robust spikes: against plain loops."""

import datetime as dt
import random
import statistics

from adtally.operators.diagnostics import coverage_gaps, period_reconcile, robust_spikes

FIRST = dt.date(2021, 1, 1)


def day(n):
    return (FIRST + dt.timedelta(days=n)).isoformat()


def test_gaps_of_overlapping_and_repeated_periods(spark):
    rng = random.Random(3)
    rows = [(k, rng.randrange(120)) for k in ("a", "b") for _ in range(14)]
    rows += rows[:5] + [("c", 7)]
    df = spark.createDataFrame([(k, day(n)) for k, n in rows] + [("a", None)], "k string, date string")
    for days in (1, 3, 7):
        want = set()
        for key in {k for k, _ in rows}:
            ends = {n for k, n in rows if k == key}
            covered = {n - i for n in ends for i in range(days)}
            free = [n for n in range(min(covered), max(covered)) if n not in covered]
            for n in free:
                if n - 1 not in free:
                    m = n
                    while m + 1 in free:
                        m += 1
                    want.add((key, day(n), day(m), m - n + 1))
        assert {tuple(r) for r in coverage_gaps(df, days, ("k",)).collect()} == want
    assert coverage_gaps(df.limit(0), 7, ("k",)).count() == 0


def test_periods_against_days(spark):
    daily = [("x", day(n), 10 + n) for n in range(30) if n != 12] + [("y", day(n), 5) for n in range(10)]
    sums = lambda k, n: sum(s for key, d, s in daily if key == k and day(n - 6) <= d <= day(n))
    period = [("x", day(n), sums("x", n) + (3 if n == 25 else 0)) for n in (3, 8, 14, 25, 29)] + [("z", day(9), 7)]
    cols = "k string, date string, total_spent long"
    got = {(r.k, r.date): r for r in period_reconcile(spark.createDataFrame(period, cols), spark.createDataFrame(daily, cols), 7, ("k",)).collect()}
    assert len(got) == len(period)
    flags = {(k, d): r.flag for (k, d), r in got.items()}
    assert flags == {
        ("x", day(3)): "incomplete", ("x", day(8)): "ok", ("x", day(14)): "incomplete",
        ("x", day(25)): "differs", ("x", day(29)): "ok", ("z", day(9)): "incomplete",
    }
    assert got["x", day(25)].difference == 3 and got["z", day(9)].days_present == 0
    near = period_reconcile(spark.createDataFrame(period, cols), spark.createDataFrame(daily, cols), 7, ("k",), tolerance=0.1)
    assert {r.flag for r in near.collect()} == {"ok", "incomplete"}


def test_spikes_against_a_plain_loop(spark):
    rng = random.Random(4)
    rows = [("r", n, 1000 + 300 * (n % 7) + rng.randrange(40)) for n in range(100) if n not in (30, 31)]
    rows = [(k, n, 9000 if n == 60 else 100 if n == 75 else s) for k, n, s in rows] + [("flat", n, 50 if n != 42 else 51) for n in range(50)]
    df = spark.createDataFrame([(k, day(n), s) for k, n, s in rows], "k string, date string, total_spent long")
    got = {(r.k, r.date): r for r in robust_spikes(df, ("k",), history_days=56, min_history=3).collect()}
    for k, n, s in rows:
        past = [v for key, m, v in rows if key == k and m % 7 == n % 7 and n - 56 <= m < n]
        r = got[k, day(n)]
        assert r.n_history == len(past)
        flag = "ok"
        if past:
            median = statistics.median(past)
            deviation = statistics.median(abs(v - median) for v in past)
            assert (r["median"], r.deviation) == (median, deviation)
            far = abs(s - median) / (1.4826 * deviation) > 3.5 if deviation else s != median
            if len(past) >= 3 and far:
                flag = "drop" if s < median else "spike"
        assert r.flag == flag
    assert (got["r", day(60)].flag, got["r", day(75)].flag, got["flat", day(42)].flag) == ("spike", "drop", "spike")
