"""Projections beside numpy, over gaps, short series and every grain."""

import math
import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.periods import MONTHS, period_number, periods_on
from tidemark.operators import projection

from helpers import day


def month(number):
    return date(number // 12, number % 12 + 1, 1)


def series(seed, n=60, gaps=0.2, first=24_000):
    rng = random.Random(seed)
    return {
        first + i: round(100 + i * 1.7 + 20 * math.sin(i * math.pi / 6) + rng.gauss(0, 5), 2)
        for i in range(n)
        if rng.random() > gaps
    }


@pytest.fixture
def frame(panel):
    def make(named):
        rows = [(month(p).isoformat(), name, v) for name, s in named.items() for p, v in s.items()]
        return panel(rows)

    return make


@pytest.mark.parametrize("grain", ["day", "week", "month", "quarter", "year"])
def test_periods_are_neighbours(spark, grain):
    starts = spark.range(1500).select(
        F.date_add(F.lit("1968-12-25").cast("date"), F.col("id").cast("int")).alias("d")
    )
    starts = starts.select((F.col("d") if grain == "day" else F.trunc("d", grain)).alias("d")).distinct()
    found = starts.select(
        "d", period_number(F.col("d"), grain).alias("p"), periods_on(F.col("d"), F.lit(3), grain).alias("later")
    ).orderBy("d").collect()
    numbers = [r.p for r in found]
    assert numbers == list(range(numbers[0], numbers[0] + len(numbers)))
    assert [r.later for r in found[:-3]] == [r.d for r in found[3:]]
    with pytest.raises(ValueError, match="fortnight"):
        period_number(F.col("d"), "fortnight")


def test_trend_equals_a_fit(frame):
    named = {f"s{i}": series(i, n) for i, n in enumerate((60, 30, 8))}
    found = projection.trend(frame(named), horizon=4).collect()
    assert len(found) == 12
    for r in found:
        at, y = (np.array(x, float) for x in zip(*sorted(named[r.entity].items())))
        slope, start = np.polyfit(at - at.mean(), y, 1)
        sd = math.sqrt(((y - start - slope * (at - at.mean())) ** 2).sum() / (len(y) - 2))
        ahead = at.max() + r.step
        value = start + slope * (ahead - at.mean())
        margin = 1.96 * sd * math.sqrt(1 + 1 / len(y) + (ahead - at.mean()) ** 2 / ((at - at.mean()) ** 2).sum())
        assert r.date == month(int(ahead)) and r.n == len(y)
        assert (r.slope, r.residual_sd, r.projected) == pytest.approx((slope, sd, value), rel=1e-9)
        assert (r.low, r.high) == pytest.approx((value - margin, value + margin), rel=1e-9)


def test_series_too_short_have_no_line(frame):
    named = {"one": {24_000: 5.0}, "two": {24_000: 5.0, 24_003: 8.0}, "flat": {24_000 + i: 3.0 for i in range(5)}}
    found = {(r.entity, r.step): r for r in projection.trend(frame(named), horizon=2).collect()}
    assert found["one", 1].projected is None and found["one", 1].date == month(24_001)
    assert (found["two", 2].projected, found["two", 2].residual_sd) == (pytest.approx(10.0), None)
    assert (found["flat", 1].projected, found["flat", 1].low) == (3.0, 3.0)


def test_large_values_keep_their_digits(frame):
    moved = {p: v + 1e9 for p, v in series(4).items()}
    (a,) = projection.trend(frame({"a": series(4)}), horizon=1).collect()
    (b,) = projection.trend(frame({"a": moved}), horizon=1).collect()
    assert b.slope == pytest.approx(a.slope, rel=1e-6) and b.residual_sd == pytest.approx(a.residual_sd, rel=1e-6)


def test_season_is_aligned_by_period(frame):
    values = series(7)
    for r in projection.seasonal_change(frame({"a": values})).collect():
        before = values.get(r.date.year * 12 + r.date.month - 1 - 12)
        assert r.season_value == before
        wanted = None if before is None else (r.value - before) / before * 100
        assert r.season_change_pct == (wanted if wanted is None else pytest.approx(wanted))


@pytest.mark.parametrize("horizon", [5, 12, 30])
def test_last_season_is_repeated(frame, horizon):
    named = {"a": series(1), "b": series(2, gaps=0.5), "c": {24_000: 1.0, 24_001: 2.0}}
    found = projection.seasonal(frame(named), horizon=horizon).collect()
    wanted = []
    for name, values in named.items():
        last = max(values)
        steps = [v - values[p - 12] for p, v in values.items() if p - 12 in values]
        drift = sum(steps) / len(steps) if steps else 0.0
        for step in range(1, horizon + 1):
            seasons = -(-step // 12)
            base = last + step - 12 * seasons
            if base in values:
                wanted.append((name, step, month(last + step), month(base), values[base], values[base] + seasons * drift))
    found = sorted(tuple(r) for r in found)
    assert [f[:5] for f in found] == [w[:5] for w in sorted(wanted)]
    assert [f[5] for f in found] == pytest.approx([w[5] for w in sorted(wanted)])


def test_backtest_uses_only_what_was_known(frame):
    named = {"a": series(3, 50), "b": series(5, 40, gaps=0.4)}
    least, horizon = 12, 14
    tried = projection.rolling_origins(frame(named), least=least, horizon=horizon).collect()
    wanted = {}
    for name, values in named.items():
        for origin in sorted(values):
            known = sorted((p, v) for p, v in values.items() if p <= origin)
            if len(known) < least:
                continue
            at, y = (np.array(x, float) for x in zip(*known))
            slope, start = np.polyfit(at - at.mean(), y, 1)
            for step in range(1, horizon + 1):
                if origin + step in values:
                    actual = values[origin + step]
                    line = start + slope * (origin + step - at.mean())
                    wanted[name, month(origin), "trend", step] = (line, actual)
                    base = origin + step - 12 * -(-step // 12)
                    if base in values:
                        wanted[name, month(origin), "seasonal", step] = (values[base], actual)
    assert {tuple(r[:4]) for r in tried} == set(wanted)
    for r in tried:
        assert (r.projected, r.actual) == pytest.approx(wanted[tuple(r[:4])], rel=1e-9)
    for r in projection.backtest(frame(named), least=least, horizon=horizon).collect():
        errors = np.array([p - a for (n, _, m, s), (p, a) in wanted.items() if (n, m, s) == (r.entity, r.method, r.step)])
        assert r.n == len(errors)
        assert (r.mae, r.bias) == pytest.approx((np.abs(errors).mean(), errors.mean()))
        assert r.rmse == pytest.approx(math.sqrt((errors**2).mean()))


def test_empty_panel_and_timestamps(panel, spark):
    empty = panel([])
    assert projection.trend(empty).count() == projection.seasonal(empty).count() == projection.backtest(empty).count() == 0
    timed = panel([("2020-01-01", "a", 1.0)]).withColumn("date", F.col("date").cast("timestamp"))
    with pytest.raises(TypeError, match="DATE"):
        projection.trend(timed)


def test_one_shuffle_after_the_panel(frame):
    from test_plans import executed, lines

    data = frame({"a": series(1), "b": series(2)})
    for build in (projection.trend, projection.seasonal, projection.seasonal_change, projection.rolling_origins):
        plan = executed(build(data))
        assert len(lines(plan, r"- Exchange")) == 1, build.__name__
        assert not lines(plan, "Join")
    assert lines(executed(projection.trend(data)), "partial_regr_sxx|partial_regr_replacement|partial_count")


def test_grains_step_by_their_own_period(panel):
    for grain, second, third in (("week", "2020-01-13", "2020-01-20"), ("quarter", "2020-04-01", "2020-07-01")):
        first = "2020-01-06" if grain == "week" else "2020-01-01"
        (row,) = projection.trend(panel([(first, "a", 1.0), (second, "a", 3.0)]), horizon=1, grain=grain).collect()
        assert (row.date, row.projected) == (day(third), pytest.approx(5.0))
    assert set(MONTHS) == {"month", "quarter", "year"}
