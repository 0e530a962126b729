"""Days of events: equal to a batch over all of them, however they arrive."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.streaming.events import EventWindows

from helpers import rows

SCHEMA = "event_id long, ts timestamp_ntz, event_type string, value double"
START = datetime(2024, 1, 1)


def events(seed, n=400, days=10):
    rng = random.Random(seed)
    kinds = ["view", "view", "view", "buy", None]
    return [
        (i, START + timedelta(seconds=rng.randrange(days * 86_400)) if rng.random() > 0.02 else None,
         rng.choice(kinds), rng.choice([None, float("nan"), round(rng.uniform(0, 9), 2)]))
        for i in range(n)
    ]


def batch(data, order, delay=timedelta(days=1)):
    """Numbers, sums and late events when the arrivals in ``order`` come one by one."""
    found, latest = {}, datetime.min + delay
    for part in order:
        mark = latest - delay
        for i, ts, kind, value in (data[k] for k in part):
            if ts is None or kind is None:
                continue
            day = ts.date()
            n, units, late = found.get((day, kind), (0, 0, 0))
            end = datetime.combine(day, datetime.min.time()) + timedelta(days=1)
            number = 0 if value is None or value != value else round(value * 100)
            found[day, kind] = (n + 1, units + number, late + (end <= mark))
        latest = max([latest, *(data[k][1] for k in part if data[k][1] and data[k][2])])
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_arrivals_out_of_order_add_up_to_a_batch(spark, tmp_path, seed):
    data = events(seed)
    rng = random.Random(seed)
    order = [[] for _ in range(4)]
    for k, (_, ts, *_) in enumerate(data):
        order[rng.choice([0, 3]) if ts is None else min(3, (ts.day * 7) % 4)].append(k)
    windows = EventWindows(str(tmp_path / "kept"), salts=3)
    for part in order:  # each call starts the stream anew from its checkpoint
        frame = spark.createDataFrame([data[k] for k in part], SCHEMA)
        frame.repartition(2).write.mode("append").parquet(str(tmp_path / "arriving"))
        windows.stream(spark, str(tmp_path / "arriving"), frame.schema).awaitTermination()
    wanted = batch(data, order)
    got = {(r.day, r.kind): (r.n, round(r.total * 100), r.n_late) for r in windows.read(spark).collect()}
    assert got == wanted
    assert sum(late for *_, late in wanted.values()) > 0


def test_a_repeated_batch_and_an_idle_call_change_nothing(spark, tmp_path):
    data = [e for e in events(5, 60) if e[1] and e[2]]
    frame = spark.createDataFrame(data, SCHEMA)
    frame.write.parquet(str(tmp_path / "arriving"))
    windows = EventWindows(str(tmp_path / "kept"))
    windows.stream(spark, str(tmp_path / "arriving"), frame.schema).awaitTermination()
    before = rows(windows.read(spark))
    folder = str(tmp_path / "kept" / "windows" / "batch=0")
    again = spark.createDataFrame(spark.read.parquet(folder).toPandas(), spark.read.parquet(folder).schema)
    again.write.mode("overwrite").parquet(folder)
    windows.stream(spark, str(tmp_path / "arriving"), frame.schema).awaitTermination()
    assert rows(windows.read(spark)) == before


def test_days_close_behind_the_watermark(spark, tmp_path):
    def arrive(number, *times):
        frame = spark.createDataFrame([(number * 10 + i, t, "x", 1.0) for i, t in enumerate(times)], SCHEMA)
        frame.write.mode("append").parquet(str(tmp_path / "arriving"))
        windows.stream(spark, str(tmp_path / "arriving"), frame.schema).awaitTermination()
        return {r.day.day: (r.n, r.n_late, r.is_closed) for r in windows.read(spark).collect()}

    windows = EventWindows(str(tmp_path / "kept"), delay="6 hours")
    assert arrive(0, START, START + timedelta(days=1, hours=5)) == {1: (1, 0, False), 2: (1, 0, False)}
    found = arrive(1, START + timedelta(days=1, hours=7), START + timedelta(hours=1))
    assert found[1][:2] == (2, 0)  # the watermark was at 23:00 of the first day
    found = arrive(2, START + timedelta(hours=2), START + timedelta(days=3))
    assert found[1] == (3, 1, True) and found[2][1] == 0 and found[4][2] is False


def test_a_hot_kind_is_dealt_over_salts(spark, tmp_path):
    frame = spark.range(2000).select(
        F.col("id").alias("event_id"), F.lit(START).cast("timestamp_ntz").alias("ts"), F.lit("hot").alias("event_type"), F.lit(0.5).alias("value")
    )
    frame.write.parquet(str(tmp_path / "arriving"))
    windows = EventWindows(str(tmp_path / "kept"), salts=8)
    windows.stream(spark, str(tmp_path / "arriving"), frame.schema).awaitTermination()
    kept = spark.read.parquet(str(tmp_path / "kept" / "windows"))
    assert kept.count() == 8 and kept.agg(F.max("n")).first()[0] < 500
    (row,) = windows.read(spark).collect()
    assert (row.n, row.total) == (2000, 1000.0)
