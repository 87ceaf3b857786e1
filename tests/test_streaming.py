"""Streaming operators: state with seeds, restart from a checkpoint, windows, logs, records."""

from fractions import Fraction

import pandas as pd
from pyspark.sql import functions as F

from quarry.operators import windows as win
from quarry.session import scratch_path
from quarry.sources import logtable as lg
from quarry.streaming import state as st
from quarry.streaming.late import open_panes
from quarry.streaming.runner import (batch_dirs_sink, checkpoint_dir, newest_per_key, noop_sink, read_batches,
                                     run_available, to_instant)


def _text_stream(spark, path):
    return spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).parquet(path)


def _add_file(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").parquet(path)


def test_seeded_word_state_and_restart(spark):
    src, path, ck = scratch_path(spark, "t-seed-src"), scratch_path(spark, "t-seed"), checkpoint_dir(spark, "t-seed")
    out = scratch_path(spark, "t-seed-out")
    _add_file(spark, src, ["hello hello"])
    seed = spark.createDataFrame([("hello", 1), ("world", 1)], "word string, count long")

    def run():
        totals = st.seeded_word_totals(_text_stream(spark, src), seed, path)
        got = st.run_counts(spark, totals, ck, batch_dirs_sink(out))
        return {r.word: r["count"] for r in got.collect()}
    assert run() == {"hello": 3, "world": 1}
    # the first batch emits the seeds, input or not
    first = read_batches(spark, out, "word string, count long").where("batch = 0")
    assert {tuple(r) for r in first.collect()} == {("hello", 3, 0), ("world", 1, 0)}
    _add_file(spark, src, ["world new"])
    assert run() == {"hello": 3, "world": 2, "new": 1}          # a restart does not count the seeds again


def test_restart_resumes_from_checkpoint(spark):
    files = [["a b", "b c"], ["c c"], ["a"], ["d d d"]]
    src, ck = scratch_path(spark, "t-restart-src"), checkpoint_dir(spark, "t-restart")
    for f in files[:2]:
        _add_file(spark, src, f)
    st.run_counts(spark, st.running_word_totals(_text_stream(spark, src)), ck)
    for f in files[2:]:
        _add_file(spark, src, f)
    got = st.run_counts(spark, st.running_word_totals(_text_stream(spark, src)), ck)
    assert {r.word: r["count"] for r in got.collect()} == {"a": 2, "b": 2, "c": 3, "d": 3}


def test_current_table_does_not_grow_with_batches(spark):
    rows = {}
    for n in (4, 40):
        src, ck = scratch_path(spark, f"t-batches-{n}"), checkpoint_dir(spark, f"t-batches-{n}")
        for i in range(n):
            _add_file(spark, src, [f"k{i % 3} k3"])
        got = st.run_counts(spark, st.running_word_totals(_text_stream(spark, src)), ck)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "BatchScan" in plan and "Aggregate" not in plan and "parquet" not in plan.lower()
        rows[n] = spark.read.format("statestore").load(ck).count()
        assert {r.word: r["count"] for r in got.collect()}["k3"] == n
    assert rows == {4: 4, 40: 4}


def test_top_k_by_batch_when_scores_fall(spark):
    import random
    from quarry.streaming.topk import top_k_sink
    rng, totals = random.Random(6), {}
    src, path, ck = scratch_path(spark, "t-topk-src"), scratch_path(spark, "t-topk"), checkpoint_dir(spark, "t-topk")
    sink = top_k_sink(path, "page", "pop", 3, lambda batch: st.current_sums(spark, ["page", "pop"], ck, 10, batch), buckets=4)
    want = {}
    for b in range(6):
        batch = [(f"p{rng.randint(0, 79)}", float(rng.randint(-60, 40)) + (100 if b == 0 else 0)) for _ in range(120)]
        if b == 2:                                     # every leader falls far
            batch = [(p, -500.0) for p, _ in sorted(totals.items(), key=lambda x: -x[1])[:30]]
        for p, v in batch:
            totals[p] = totals.get(p, 0.0) + v
        want[b] = [p for p, _ in sorted(totals.items(), key=lambda x: (-x[1], x[0]))[:3]]
        spark.createDataFrame(batch, "page string, v double").write.mode("append").parquet(src)
        stream = spark.readStream.schema("page string, v double").parquet(src)
        run_available(st.running_sums(stream, ["page"], "v", "pop"), sink, ck, mode="update")
    got = read_batches(spark, f"{path}/top", "page string, pop double").collect()
    for b, pages in want.items():
        top = sorted((r for r in got if r.batch == b), key=lambda r: (-r.pop, r.page))
        assert [r.page for r in top] == pages, b


def test_late_rows_are_counted_and_state_is_bounded(spark):
    import random
    from quarry.streaming import late
    rng = random.Random(1)
    rows = [(i, i % 2, 1.0, f"2024-01-01 {i // 60:02d}:{i % 60:02d}:00") for i in range(600)]
    swap = list(range(600))
    for i in range(0, 600, 50):                        # shuffled inside of files; three rows come hours late
        part = swap[i:i + 50]
        rng.shuffle(part)
        swap[i:i + 50] = part
    moved = [3, 70, 111]
    order = [i for i in swap if i not in moved] + moved
    path, src, out = scratch_path(spark, "t-late"), scratch_path(spark, "t-late-src"), scratch_path(spark, "t-late-out")
    ck, ck2 = checkpoint_dir(spark, "t-late"), checkpoint_dir(spark, "t-late2")
    schema = "id long, user_id long, value double, et timestamp"
    most = 0
    for i in range(0, 600, 50):
        part = spark.createDataFrame([rows[j] for j in order[i:i + 50]], "id long, user_id long, value double, ts string")
        part.select("id", "user_id", "value", F.col("ts").cast("timestamp").alias("et")).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        run_available(stream, late.split_sink(path, "et", "1 hour"), ck)
        late.run_panes(spark, path, f"{schema}, batch long", "et", "5 minutes", ["user_id"], "value", "1 hour", out, ck2)
        most = max(most, late.open_panes(spark, ck2).count())
    side = late.late_rows(spark, path, schema)
    assert sorted(r.id for r in side.collect()) == moved
    panes = late.all_panes(spark, "user_id long", out, ck2)
    assert panes.agg(F.sum("cnt")).first()[0] + side.count() == 600
    assert panes.count() == panes.select("user_id", "pane").distinct().count()
    assert most < panes.count() / 2                    # two hours of panes of ten


def test_stream_join_of_aggregates_with_a_hot_key(spark):
    rows = [(7 if i % 3 else i % 50, float(i % 7), f"2024-01-01 00:{i // 60 % 60:02d}:{i % 60:02d}") for i in range(1200)]
    df = spark.createDataFrame(rows, "user_id long, value double, ts string").withColumn("et", F.col("ts").cast("timestamp")).drop("ts")
    end = spark.createDataFrame([(-1, 0.0, "2999-01-01 00:00:00")], "user_id long, value double, ts string") \
        .withColumn("et", F.col("ts").cast("timestamp")).drop("ts")
    src, out, ck = scratch_path(spark, "t-j1"), scratch_path(spark, "t-j1-out"), checkpoint_dir(spark, "t-j1")
    for part in (df, end):
        part.write.mode("append").parquet(src)
        s = spark.readStream.schema(df.schema).parquet(src).withWatermark("et", "1 minute")
        run_available(win.stream_sum_join_count(s, s, "et", "1 minute", ["user_id"], "value"), batch_dirs_sink(out), ck)
    want = win.tumbling(df, "et", "1 minute", ["user_id"], "value")
    got = spark.read.parquet(out).drop("batch")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))


def test_float_parse_score(spark):
    df = spark.createDataFrame([("page37|5|1.5119122|-1",)], "value string")
    p = F.split("value", "\\|")
    a, b, c = (F.get(p, i).cast("float").cast("double") for i in (1, 2, 3))
    got = df.select((a * F.lit(0.8) + b * F.lit(0.8) + c * F.lit(1.0)).alias("s")).first().s
    assert got == 4.209529781341553


def test_sliding_windows_stream_equals_batch(spark):
    rows = [(i, i % 3, float(i % 7) + 0.25, f"2024-01-01 00:00:{i:02d}") for i in range(60)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, value double, ts string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    src = scratch_path(spark, "t-win-src")
    for k in range(3):
        df.where((F.col("event_id") >= k * 20) & (F.col("event_id") < (k + 1) * 20)).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    totals = win.pane_totals(stream.withColumn("et", to_instant("ts")), "et", "5 seconds", ["user_id"], "value")
    ck = checkpoint_dir(spark, "t-win")
    run_available(totals, noop_sink, ck, mode="update")
    panes = open_panes(spark, ck).withColumn("pane", F.col("window.start"))
    got = win.from_panes(panes, "30 seconds", "5 seconds", ["user_id"])
    want = win.sliding(df, "ts", "30 seconds", "5 seconds", ["user_id"], "value")
    g = {(r.user_id, r.window_start.replace(tzinfo=None) if r.window_start.tzinfo else r.window_start): (r.sum, r.cnt)
         for r in got.select("user_id", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "sum", "cnt").collect()}
    w = {(r.user_id, r.window_start): (r.sum, r.cnt) for r in want.collect()}
    assert g == w


def test_offset_clamp_fixture(spark):
    cases = [(50, 10, 90), (10, 10, 90), (90, 10, 90), (5, 10, 90), (95, 10, 90), (None, 10, 90)]
    bounds = spark.createDataFrame([("t", i, lo, hi) for i, (_, lo, hi) in enumerate(cases)],
                                   "topic string, partition int, earliest long, latest long")
    committed = spark.createDataFrame([("t", i, c) for i, (c, _, _) in enumerate(cases) if c is not None],
                                      "topic string, partition int, committed long")
    got = {r.partition: r.start for r in lg.clamp(committed, bounds).collect()}
    assert [got[i] for i in range(6)] == [50, 10, 90, 10, 10, 10]


def test_log_append_keeps_offsets_dense(spark):
    path = scratch_path(spark, "t-log")
    def recs(ids):
        return spark.createDataFrame([("t", i % 2, str(i), f"v{i}", i) for i in ids],
                                     "topic string, partition int, key string, value string, id long") \
            .withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    lg.append_records(spark, path, recs(range(0, 10)), "id", "w", 0)
    lg.append_records(spark, path, recs(range(10, 15)), "id", "w", 1)
    lg.append_records(spark, path, recs(range(10, 15)), "id", "w", 1)  # a replayed batch replaces itself
    log = lg.read_log(spark, path)
    assert log.count() == 15
    for p in (0, 1):
        offs = sorted(r.offset for r in log.where(F.col("partition") == p).collect())
        assert offs == list(range(len(offs)))
    assert lg.commits(log).where("partition = 0").first().next_offset == 8
    lg.append_records(spark, path, recs(range(15, 20)), "id")       # no writer named: only ever adds
    lg.append_records(spark, path, recs(range(15, 20)), "id", "other", 0)
    assert lg.read_log(spark, path).count() == 25


def test_record_decode_drops_bad(spark):
    people = spark.createDataFrame([("beta", 23), ("spark", 34), ("kafka", 23), ("alpha", 23)], "name string, age int")
    good = people.select(lg.encode(people, ["name", "age"]).alias("value"))
    bad = spark.createDataFrame([(bytearray(b"\x00\x01garbage"),)], "value binary")
    dec = good.union(bad).select(lg.decode(F.col("value"), "name string, age int").alias("r"))
    kept = dec.where(F.col("r.name").isNotNull()).select("r.*")
    assert sorted(tuple(r) for r in kept.collect()) == sorted([("beta", 23), ("spark", 34), ("kafka", 23), ("alpha", 23)])


def test_keyed_state_hook(spark):
    src = scratch_path(spark, "t-keyed-src")
    for part in ([(1, 1.252), (2, 2.5), (2, None)], [(1, 0.752)]):
        spark.createDataFrame(part, "user_id long, value double").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema("user_id long, value double").option("maxFilesPerTrigger", 1).parquet(src)
    out = st.keyed_state(stream, "user_id", st.amount_total, "user_id long, total double", "total string",
                         partial=st.AMOUNT_PARTIAL)
    path = scratch_path(spark, "t-keyed")
    run_available(out, batch_dirs_sink(path), checkpoint_dir(spark, "t-keyed"), mode="update")
    got = {r.user_id: r.total for r in newest_per_key(read_batches(spark, path, "user_id long, total double"),
                                                      ["user_id"]).collect()}
    assert got == {1: 2.004, 2: 2.5}


def test_keyed_state_hot_key_is_combined_per_partition(spark):
    # user 7 holds most rows of one batch, spread over several files (input partitions)
    rows = [(7, (i % 97) / 4) for i in range(3000)] + [(u, u / 8) for u in range(1, 40)]
    src = scratch_path(spark, "t-keyed-hot-src")
    spark.createDataFrame(rows, "user_id long, value double").repartition(6).write.parquet(src)
    stream = spark.readStream.schema("user_id long, value double").parquet(src)
    out = st.keyed_state(stream, "user_id", st.amount_total, "user_id long, total double", "total string",
                         partial=st.AMOUNT_PARTIAL)
    assert "MapInPandas" in out._jdf.queryExecution().analyzed().toString()
    path = scratch_path(spark, "t-keyed-hot")
    run_available(out, batch_dirs_sink(path), checkpoint_dir(spark, "t-keyed-hot"), mode="update")
    got = {r.user_id: r.total for r in newest_per_key(read_batches(spark, path, "user_id long, total double"),
                                                      ["user_id"]).collect()}
    want = {}
    for u, v in rows:
        want[u] = want.get(u, 0) + Fraction(str(v))
    assert got == {u: float(t) for u, t in want.items()}


def test_state_folds_arrow_chunks(spark):
    # rows of one key reach the hook in chunks of 100 and are folded, never gathered
    rows = [(1, i / 1000) for i in range(1050)]
    src, path = scratch_path(spark, "t-chunk-src"), scratch_path(spark, "t-chunk")
    spark.createDataFrame(rows, "user_id long, value double").coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("user_id long, value double").parquet(src)

    def fold(key, part, old):
        calls, total = old or (0, "0")
        amounts = [total, *st.amount_partial(part)["amount"]]
        state = (calls + 1, str(st.exact_total(amounts)))
        return state, pd.DataFrame({"user_id": [key], "calls": [state[0]], "total": [float(state[1])]})

    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, 100)
    try:
        out = st.keyed_state(stream, "user_id", fold, "user_id long, calls long, total double", "calls long, total string")
        run_available(out, batch_dirs_sink(path), checkpoint_dir(spark, "t-chunk"), mode="update")
    finally:
        spark.conf.set(size, before)
    got = read_batches(spark, path, "user_id long, calls long, total double").collect()
    assert [(r.user_id, r.total) for r in got] == [(1, float(sum(Fraction(str(v)) for _, v in rows)))]
    assert got[0].calls > 1


def test_interval_trigger(spark):
    import time
    from quarry.streaming.runner import start_stream
    out, src = scratch_path(spark, "t-interval"), scratch_path(spark, "t-interval-in")
    spark.range(20).write.parquet(src)
    q = start_stream(spark.readStream.schema("id long").parquet(src), batch_dirs_sink(out),
                     checkpoint_dir(spark, "t-interval"), every="0.5 seconds")
    try:
        deadline = time.time() + 60
        while time.time() < deadline and not any(p["numInputRows"] > 0 for p in q.recentProgress):
            time.sleep(0.5)
    finally:
        q.stop()
    assert read_batches(spark, out, "id long").count() == 20


def test_clamp_latest_start_for_new_partitions(spark):
    bounds = spark.createDataFrame([("t", 0, 10, 90), ("t", 1, 0, 40)],
                                   "topic string, partition int, earliest long, latest long")
    committed = spark.createDataFrame([("t", 0, 50)], "topic string, partition int, committed long")
    got = {r.partition: r.start for r in lg.clamp(committed, bounds, start="latest").collect()}
    assert got == {0: 50, 1: 40}


def test_commits_follow_the_log_across_restarts(spark):
    path = scratch_path(spark, "t-commit-log")
    def recs(ids):
        return spark.createDataFrame([("t", i % 3, str(i), f"v{i}", i) for i in ids],
                                     "topic string, partition int, key string, value string, id long") \
            .withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    out, ck = scratch_path(spark, "t-commits"), checkpoint_dir(spark, "t-commits")
    lg.append_records(spark, path, recs(range(0, 20)), "id", "w", 0)
    run_available(lg.stream_log(spark, path), batch_dirs_sink(out, lg.commits), ck)
    lg.append_records(spark, path, recs(range(20, 31)), "id", "w", 1)
    run_available(lg.stream_log(spark, path), batch_dirs_sink(out, lg.commits), ck)
    got = {r.partition: r.next_offset for r in
           lg.current_commits(read_batches(spark, out, "topic string, partition int, next_offset long")).collect()}
    assert got == {0: 11, 1: 10, 2: 10}


def _events(spark, ids, topic="t", parts=2):
    return spark.createDataFrame([(topic, i % parts, None if i % 5 == 0 else str(i), f"v{i}", i) for i in ids],
                                 "topic string, partition int, key string, value string, id long") \
        .withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))


def _seen(spark, out):
    return sorted((r.partition, r.offset) for r in read_batches(
        spark, out, "topic string, partition int, offset long, key string, value binary, timestamp timestamp_ntz").collect())


def test_direct_stream_starts_and_carries_on(spark):
    from quarry.sources.logstream import log_stream
    path = scratch_path(spark, "t-direct")
    lg.append_records(spark, path, _events(spark, range(0, 20)), "id", "w", 0)
    runs = {"latest": "latest", "earliest": "earliest", "given": {"t/0": 7, "t/1": 10}}
    at = {k: (scratch_path(spark, f"t-direct-{k}"), checkpoint_dir(spark, f"t-direct-{k}")) for k in runs}
    for k, start in runs.items():
        run_available(log_stream(spark, path, start), batch_dirs_sink(at[k][0]), at[k][1])
    lg.append_records(spark, path, _events(spark, range(20, 31), parts=3), "id", "w", 1)       # with a new partition
    for k, start in runs.items():                      # the start no longer matters, the checkpoint does
        run_available(log_stream(spark, path, start), batch_dirs_sink(at[k][0]), at[k][1])
    log = lg.read_log(spark, path)
    every = sorted((r.partition, r.offset) for r in log.collect())
    younger = sorted((r.partition, r.offset) for r in log.where("batch = 1").collect())
    assert _seen(spark, at["latest"][0]) == younger and _seen(spark, at["earliest"][0]) == every
    assert _seen(spark, at["given"][0]) == sorted([*younger, (0, 7), (0, 8), (0, 9)])
    nulls = spark.read.parquet(f"{at['earliest'][0]}/batch=0").where("key IS NULL").count()
    assert nulls == 4


def test_appends_read_one_offsets_table(spark):
    path = scratch_path(spark, "t-offsets")
    for b in range(6):
        lg.append_records(spark, path, _events(spark, range(b * 10, b * 10 + 10)), "id", "w", b)
    lg.append_records(spark, path, _events(spark, range(50, 60)), "id", "w", 5)                # a replayed batch
    assert len(lg._appends(spark, path)) == 6
    bounds = lg.log_bounds(spark, path)
    assert {(r.partition, r.earliest, r.latest) for r in bounds.collect()} == {(0, 0, 30), (1, 0, 30)}
    assert len(bounds.inputFiles()) == 1
    log = lg.read_log(spark, path)
    assert log.count() == 60 and log.select("partition", "offset").distinct().count() == 60


def test_undecodable_records_and_empty_batches_are_counted(spark):
    out = scratch_path(spark, "t-decode")
    sink = lg.decode_sink(out, "name string, age int", "name")
    good = spark.createDataFrame([("beta", 23), ("spark", 34)], "name string, age int")
    rows = good.select(lg.encode(good, ["name", "age"]).alias("value"))
    bad = spark.createDataFrame([(bytearray(b"\x00\x01garbage"),), (None,)], "value binary")
    sink(rows.union(bad), 0)
    sink(rows.limit(0), 1)
    counts = read_batches(spark, f"{out}/counts", "n long, bad long").collect()
    assert {r.batch: (r.n, r.bad) for r in counts} == {0: (4, 2), 1: (0, 0)}
    assert spark.read.parquet(f"{out}/records").count() == 2


def test_console_sink_and_snapshot_interval(spark, capsys):
    from quarry.streaming.runner import console_sink, set_state_snapshot_every
    src, ck = scratch_path(spark, "t-console-src"), checkpoint_dir(spark, "t-console")
    _add_file(spark, src, ["a b a"])
    conf = "spark.sql.streaming.stateStore.minDeltasForSnapshot"
    before = spark.conf.get(conf)
    try:
        set_state_snapshot_every(spark, 8)
        assert spark.conf.get(conf) == "8"
        st.run_counts(spark, st.running_word_totals(_text_stream(spark, src)), ck, console_sink(1))
    finally:
        spark.conf.set(conf, before)
    shown = capsys.readouterr().out
    assert "-- batch 0" in shown and "only showing top 1 row" in shown


def _counted_batches(monkeypatch, sink="noop_sink"):
    """Ids of the micro-batches that reach ``sink`` of the stream queries."""
    from quarry.plans import stream_queries as sq
    seen, plain = set(), getattr(sq, sink)

    def counted(df, batch):
        seen.add(batch)
        plain(df, batch)
    monkeypatch.setattr(sq, sink, counted)
    return sq, seen


def test_top_pages_take_four_micro_batches_however_many_files(spark, monkeypatch):
    from conftest import SF_SMALL
    sq, seen = _counted_batches(monkeypatch)
    want = sq.stream_top_pages(spark, SF_SMALL).collect()
    assert seen == set(range(4))
    lines = sq._page_lines
    monkeypatch.setattr(sq, "_page_lines", lambda s, d: lines(s, d).repartition(5))      # 20 files
    seen.clear()
    assert sq.stream_top_pages(spark, SF_SMALL).collect() == want
    assert seen == set(range(4))


def test_window_join_opens_its_state_once_a_slice(spark, monkeypatch):
    import os
    from conftest import SF_SMALL
    from quarry.plans import stream_queries as sq
    from quarry.plans import window_graph_queries as wq
    conf = "spark.sql.streaming.noDataMicroBatches.enabled"
    before, checkpoint = spark.conf.get(conf), checkpoint_dir(spark, "t-join")
    monkeypatch.setattr(sq, "checkpoint_dir", lambda s, name: checkpoint)
    got = sq.stream_join_sum_count(spark, SF_SMALL)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wq.win_tumbling(spark, SF_SMALL).select(got.columns).collect()))
    # four slices, the end-of-stream row, and one batch without rows that closes the last windows
    assert len([f for f in os.listdir(f"{checkpoint}/commits") if f.isdigit()]) == 6
    assert not [d for _, dirs, _ in os.walk(f"{checkpoint}/state") for d in dirs if d.endswith("keyToNumValues")]
    assert spark.conf.get(conf) == before


def test_partials_are_merged_in_proportion_to_the_rows(spark):
    # 64 Arrow batches of 50 new keys each: merging every batch into all held ones would take 104,000 rows
    seen = spark.sparkContext.accumulator(0)

    def merge(partials):
        seen.add(len(partials))
        return st.amount_merge(partials)
    rows = spark.range(3200, numPartitions=1).select(F.expr("nullif(id, 7)").alias("user_id"), F.lit(0.1).alias("value"))
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, 50)
    try:
        got = st.combine_in_partitions(rows.unionAll(rows).coalesce(1), st.amount_partial, merge, st.AMOUNT_PARTIAL[2]).collect()
    finally:
        spark.conf.set(size, before)
    assert len(got) == 3200 and {r.amount for r in got} == {"0.2"} and sum(r.user_id is None for r in got) == 1
    assert seen.value < 32_000


def test_purchases_take_four_micro_batches_however_many_files(spark):
    from conftest import SF_SMALL
    from quarry.plans import stream_queries as sq
    src, seen = scratch_path(spark, "t-many"), set()
    sq._event_slices(spark, SF_SMALL).repartition(9).write.parquet(src)
    run_available(sq._purchase_stream(spark, src), lambda df, b: seen.add(b), checkpoint_dir(spark, "t-many"))
    assert len(seen) <= 4


def test_slices_are_ranges_a_scan_can_skip(spark, capsys):
    from quarry.streaming.runner import key_slices
    src = scratch_path(spark, "t-slices")
    spark.range(1, 11).select(F.expr("nullif(id, 4)").alias("k")).write.parquet(src)
    slices = key_slices(spark.read.parquet(src), 4, "k")
    assert [sorted(r.k or 0 for r in s.collect()) for s in slices] == [[0, 1, 2, 3], [5], [6, 7], [8, 9, 10]]
    for s in slices:
        s.explain()
        pushed = capsys.readouterr().out.split("PushedFilters: [")[1].split("]")[0]
        assert "LessThanOrEqual(k" in pushed or "GreaterThan(k" in pushed
    last = 2**63 - 1
    for typ, keys in (("long", [last, last, None]), ("double", [0.5, float("nan"), None]), ("long", [-last - 1, 0, last])):
        df = spark.createDataFrame([(x,) for x in keys], f"k {typ}")
        assert sum(s.count() for s in key_slices(df, 4, "k")) == 3


def test_staged_lines_are_bounded_files_and_split_once(spark, monkeypatch):
    import os
    from conftest import SF_SMALL
    from quarry.plans import stream_queries as sq
    from quarry.sources.tables import read_table
    split, parts, path = sq.tx.document_lines, [], scratch_path(spark, "t-lines")
    monkeypatch.setattr(sq, "FILE_LINES", 50)
    monkeypatch.setattr(sq, "scratch_path", lambda s, name: path)
    monkeypatch.setattr(sq.tx, "document_lines", lambda docs: parts.append(docs.count()) or split(docs))
    docs = read_table(spark, SF_SMALL, "documents")
    assert sq._staged_lines(spark, SF_SMALL) == path
    assert len(parts) == 4 and sum(parts) == docs.count()        # each slice of documents is split into lines, and only once
    per_file = spark.read.text(path).groupBy(F.input_file_name().alias("f")).count().collect()
    assert max(r["count"] for r in per_file) <= 50
    want = split(docs).groupBy(F.col("line").alias("value")).count()
    got = spark.read.text(path).groupBy("value").count()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert not any(f.endswith(".gz") for f in os.listdir(path))


def test_state_is_written_without_a_count_of_its_keys(spark):
    src, ck = scratch_path(spark, "t-nocount-src"), checkpoint_dir(spark, "t-nocount")
    _add_file(spark, src, ["a b a"])
    q = run_available(st.running_word_totals(_text_stream(spark, src)), noop_sink, ck, mode="update")
    op = q.lastProgress["stateOperators"][0]
    assert op["numRowsUpdated"] == 2 and op["numRowsTotal"] == 0
