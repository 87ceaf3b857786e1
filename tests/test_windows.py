"""Window statistics on hand-placed events."""

import datetime as dt

from pyspark.sql import functions as F

from quarry.operators import windows as win

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _events(spark, rows):
    return spark.createDataFrame([(u, T0 + dt.timedelta(seconds=s), v) for u, s, v in rows],
                                 "user string, ts timestamp_ntz, value double")


def test_tumbling_5s(spark):
    df = _events(spark, [("a", 1, 2.0), ("a", 4, 3.0), ("a", 6, 5.0), ("b", 1, 1.0)])
    got = {(r.user, r.window_start.second): (r.sum, r.cnt, r.avg) for r in win.tumbling(df, "ts", "5 seconds", ["user"], "value").collect()}
    assert got == {("a", 0): (5.0, 2, 2.5), ("a", 5): (5.0, 1, 5.0), ("b", 0): (1.0, 1, 1.0)}


def test_sliding_30_every_5_counts_each_event_six_times(spark):
    df = _events(spark, [("a", 12, 1.0)])
    rows = win.sliding(df, "ts", "30 seconds", "5 seconds", ["user"], "value").collect()
    starts = sorted((r.window_start - T0).total_seconds() for r in rows)
    assert starts == [-15.0, -10.0, -5.0, 0.0, 5.0, 10.0]
    assert all(r.window_end - r.window_start == dt.timedelta(seconds=30) for r in rows)


def test_composed_is_s30_plus_s30_five_seconds_earlier(spark):
    df = _events(spark, [("a", 1, 1.0), ("a", 7, 2.0), ("a", 33, 4.0), ("a", 40, 8.0)])
    s30 = win.sliding(df, "ts", "30 seconds", "5 seconds", ["user"], "value")
    composed = {r.window_end: (r.sum, r.cnt) for r in win.composed(s30, "10 seconds", "5 seconds", ["user"]).collect()}
    inner = {r.window_end: (r.sum, r.cnt) for r in s30.collect()}
    step = dt.timedelta(seconds=5)
    for end, (s, n) in composed.items():
        # the outer window ending at `end` holds the inner windows ending at end and end - 5 s
        a = inner.get(end, (0.0, 0))
        b = inner.get(end - step, (0.0, 0))
        assert (s, n) == (a[0] + b[0], a[1] + b[1])
    assert len(composed) == len(set(inner) | {e + step for e in inner})


def test_windows_are_the_same_on_a_stream_shaped_input(spark):
    df = _events(spark, [("a", i, float(i)) for i in range(40)])
    batch = win.sliding(df, "ts", "60 seconds", "5 seconds", ["user"], "value")
    assert batch.count() == 19  # 8 slides of data + 11 leading partial windows
    assert batch.agg(F.max("cnt")).first()[0] == 40


def test_stream_time_conversion_ignores_session_zone(spark):
    from quarry.streaming.runner import from_instant, to_instant
    df = _events(spark, [("a", 1, 1.0), ("a", 7200, 2.0)])
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        out = {}
        for tz in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            w = win.tumbling(df.withColumn("et", to_instant("ts")), "et", "1 hour", ["user"], "value")
            out[tz] = sorted((r.s, r.sum) for r in w.select(from_instant("window_start").alias("s"), "sum").collect())
        assert out["UTC"] == out["America/Los_Angeles"] == out["Asia/Kolkata"]
        assert out["UTC"][0][0] == T0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_panes_make_the_windows_of_every_row_expansion(spark):
    import random
    rng = random.Random(3)
    rows = [(rng.choice("aaaab"), rng.choice([0, 40, 41, 200]) + rng.randint(0, 300), rng.choice([None, 0.1, 2.0])) for _ in range(400)]
    df = _events(spark, rows)
    want = {}
    for u, s, v in rows:
        for k in range(6):
            w = (s // 5 - k) * 5
            t, n = want.get((u, w), (None, 0))
            want[u, w] = (t if v is None else round((t or 0) + v, 6), n + 1)
    got = win.from_panes(win.panes(df, "ts", "5 seconds", ["user"], "value"), "30 seconds", "5 seconds", ["user"])
    assert {(r.user, int((r.window_start - T0).total_seconds())): (r.sum if r.sum is None else round(r.sum, 6), r.cnt)
            for r in got.collect()} == want
    assert got.count() == len(want)


def test_rows_are_aggregated_once_before_windows_are_made(spark):
    df = _events(spark, [("a", i, 1.0) for i in range(10)])
    plan = win.sliding(df, "ts", "60 seconds", "5 seconds", ["user"], "value")._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.rindex("Aggregate"):]
    assert "Expand" not in plan and "Generate" not in below
