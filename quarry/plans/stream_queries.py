"""Streaming queries. Inputs are staged from the shared tables into file-stream folders
(several files, read in a fixed number of micro-batches); each query runs to the end of its input and returns
what its sink holds."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import relational as rel
from quarry.operators import text as tx
from quarry.operators import windows as win
from quarry.plans.registry import register
from quarry.plans.relational_queries import POPULARITY_WEIGHTS
from quarry.plans.window_graph_queries import SLIDE, TUMBLE, WIN_30, WIN_60, WIN_OUTER
from quarry.session import scratch_path
from quarry.sinks.files import pair_lines
from quarry.sources import logstream as ls
from quarry.sources import logtable as lg
from quarry.sources.tables import read_table
from quarry.streaming import late
from quarry.streaming import state as st
from quarry.streaming.runner import (batch_dirs_sink, checkpoint_dir, from_instant, newest_per_key, noop_sink, read_batches,
                                     run_available, run_slices, stage_files, stream_in_batches, to_instant)
from quarry.streaming.topk import top_k_sink

N_FILES = 4
FILE_LINES = 100_000
# The reference's initial word state and its popularity seed page.
WORD_SEEDS = (("hello", 1), ("world", 1))
PAGE_SEED = ("page1", 0.0)


def _staged_lines(spark, sf_dir):
    """Document lines as compressed text files in one folder: ``N_FILES`` document-id slices."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return stage_files(docs, scratch_path(spark, "lines-src"), N_FILES, ["doc_id"], fmt="text", compression="lz4",
                       rows=lambda part: tx.document_lines(part).select(F.col("line").alias("value")), file_rows=FILE_LINES)


def _line_stream(spark, path):
    """Directory text stream: each new file is read once."""
    return stream_in_batches(spark, path, "value string", N_FILES, fmt="text")


@register("stream_batch_word_count")
def stream_batch_word_count(spark, sf_dir):
    src = _staged_lines(spark, sf_dir)
    out = scratch_path(spark, "batch-wc")
    # each batch's counts go to their own folder as "(word,count)" text lines
    run_available(_line_stream(spark, src),
                  batch_dirs_sink(out, lambda b: pair_lines(tx.word_count(b, "value"), "word", "count"), fmt="text"),
                  checkpoint_dir(spark, "batch-wc"))
    per_batch = read_batches(spark, out, "value string", fmt="text")
    pair = r"(?s)\A\((.*),(-?[0-9]+)\)\z"
    parsed = per_batch.select(F.regexp_extract("value", pair, 1).alias("word"),
                              F.regexp_extract("value", pair, 2).cast("long").alias("count"))
    return parsed.groupBy("word").agg(F.sum("count").cast("long").alias("count"))


@register("stream_word_totals")
def stream_word_totals(spark, sf_dir):
    src = _staged_lines(spark, sf_dir)
    return st.run_counts(spark, st.running_word_totals(_line_stream(spark, src)), checkpoint_dir(spark, "wc-tot"))


@register("stream_seeded_totals")
def stream_seeded_totals(spark, sf_dir):
    src = _staged_lines(spark, sf_dir)
    seed = spark.createDataFrame(list(WORD_SEEDS), "word string, count long")
    totals = st.seeded_word_totals(_line_stream(spark, src), seed, scratch_path(spark, "wc-seed"))
    return st.run_counts(spark, totals, checkpoint_dir(spark, "wc-seed"))


def _staged_purchases(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").where(F.col("event_type") == "purchase") \
        .select("event_id", "user_id", "value", "ts")
    return stage_files(e, scratch_path(spark, "pay-src"), N_FILES, ["event_id"])


def _purchase_stream(spark, path):
    return stream_in_batches(spark, path, "event_id long, user_id long, value double, ts timestamp_ntz", N_FILES)


@register("stream_payment_totals")
def stream_payment_totals(spark, sf_dir):
    """Two stages: per-batch sums per user go to a sink, whose batches a second stream folds to running totals."""
    src = _staged_purchases(spark, sf_dir)
    sums_path = scratch_path(spark, "pay-batch")
    run_available(_purchase_stream(spark, src),
                  batch_dirs_sink(sums_path, lambda b: st.running_sums(b, ["user_id"], "value", "batch_sum")),
                  checkpoint_dir(spark, "pay-batch"))
    # the first stage has ended, so none of its batches is written again under the second
    sums = spark.readStream.schema("user_id long, batch_sum double, batch long").parquet(sums_path)
    return st.run_sums(spark, st.running_sums(sums, ["user_id"], "batch_sum"), checkpoint_dir(spark, "pay-tot"))


@register("keyed_state")
def keyed_state_q(spark, sf_dir):
    src = _staged_purchases(spark, sf_dir)
    out = st.keyed_state(_purchase_stream(spark, src), "user_id", st.amount_total,
                         "user_id long, total double", "total string", partial=st.AMOUNT_PARTIAL)
    path = scratch_path(spark, "keyed")
    run_available(out, batch_dirs_sink(path), checkpoint_dir(spark, "keyed"), mode="update")
    return newest_per_key(read_batches(spark, path, "user_id long, total double"), ["user_id"])


def _page_lines(spark, sf_dir):
    """lineitem as ``page|a|b|c`` lines."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", F.concat_ws("|", F.col("l_partkey").cast("string"), *[
        F.col(c).cast("string") for c in ("l_quantity", "l_discount", "l_tax")]).alias("value"))


# a score has at most this many decimals when its double is of 0.01 or more; whatever lies beyond
# them is summed as a double
SCORE_DECIMALS = 20


def _scored(stream):
    """``page, score`` of lines parsed with 32-bit float fields (as the reference parses them)."""
    p = F.split("value", "\\|")
    a, b, c = (F.get(p, i).cast("float").cast("double") for i in (1, 2, 3))
    wa, wb, wc = POPULARITY_WEIGHTS
    return stream.select(F.get(p, 0).alias("page"), (a * F.lit(wa) + b * F.lit(wb) + c * F.lit(wc)).alias("score"))


def _page_totals(spark, stream, seed_path):
    """Popularity per page, starting from the seed page. The sum does not depend on micro-batches."""
    seed = spark.createDataFrame([PAGE_SEED], "page string, score double")
    scored = st.with_seeds(_scored(stream), seed, seed_path)
    return st.running_sums(scored, ["page"], "score", "pop", SCORE_DECIMALS)


def _current_pages(spark, checkpoint, batch=None):
    return st.current_sums(spark, ["page", "pop"], checkpoint, SCORE_DECIMALS, batch)


@register("stream_top_pages")
def stream_top_pages(spark, sf_dir):
    """Scores summed per page in state, seeded with page1 = 0.0; top 10 of the final state."""
    src = stage_files(_page_lines(spark, sf_dir), scratch_path(spark, "pop-src"), N_FILES, ["l_orderkey"])
    stream = stream_in_batches(spark, src, "l_orderkey long, value string", N_FILES)
    checkpoint = checkpoint_dir(spark, "pop")
    run_available(_page_totals(spark, stream, scratch_path(spark, "pop-seed")), noop_sink, checkpoint, mode="update")
    return rel.top_k(_current_pages(spark, checkpoint), 10, [F.desc("pop"), F.asc("page")])


@register("stream_top_pages_by_batch")
def stream_top_pages_by_batch(spark, sf_dir):
    """The top 10 after each of four micro-batches of order-key slices, from the pages each batch changed."""
    path, checkpoint, seed = scratch_path(spark, "pop-each"), checkpoint_dir(spark, "pop-each"), scratch_path(spark, "pop-each-seed")
    sink = top_k_sink(path, "page", "pop", 10, lambda batch: _current_pages(spark, checkpoint, batch))
    run_slices(_page_lines(spark, sf_dir), scratch_path(spark, "pop-each-src"), N_FILES, "l_orderkey",
               lambda stream: _page_totals(spark, stream, seed), sink, checkpoint, mode="update")
    return read_batches(spark, f"{path}/top", "page string, pop double")


# --- log tables ----------------------------------------------------------------------------
N_LOG_PARTITIONS = 3


def event_log(spark, sf_dir):
    """events as a log: topic = event type, partition = user % 3, offsets by event id."""
    e = read_table(spark, sf_dir, "events")
    value = lg.encode(e, ["event_id", "user_id", "value"])
    return lg.to_log(e, F.col("event_type"), F.col("user_id") % N_LOG_PARTITIONS, F.col("user_id"), value,
                     "event_id", F.col("ts"))


def _log_path(spark, sf_dir):
    return lg.write_log(event_log(spark, sf_dir), scratch_path(spark, "log"))


@register("log_stream_values")
def log_stream_values(spark, sf_dir):
    path = _log_path(spark, sf_dir)
    out = scratch_path(spark, "log-vals")
    run_available(lg.stream_log(spark, path, max_files=4),
                  batch_dirs_sink(out, lambda b: b.select("topic", "partition", "offset",
                                                          F.col("value").cast("string").alias("value"))),
                  checkpoint_dir(spark, "log-vals"))
    return read_batches(spark, out, "topic string, partition int, offset long, value string").drop("batch")


def _halves(spark, sf_dir):
    """Events, and whether an event is of the older half by id."""
    e = read_table(spark, sf_dir, "events")
    lo, hi = e.agg(F.min("event_id"), F.max("event_id")).first()
    return e.withColumn("old", F.col("event_id") <= (lo + hi) / 2)


def _append_events(spark, path, events):
    recs = events.select(F.col("event_type").alias("topic"), (F.col("user_id") % N_LOG_PARTITIONS).alias("partition"),
                         F.col("user_id").cast("string").alias("key"), lg.encode(events, ["event_id", "user_id", "value"]).alias("value"),
                         F.col("ts").alias("timestamp"), "event_id")
    lg.append_records(spark, path, recs, "event_id")


@register("log_stream_kv")
def log_stream_kv(spark, sf_dir):
    """A direct stream that starts at the latest offsets: records appended before its first start are not read."""
    e = _halves(spark, sf_dir)
    path, out, checkpoint = scratch_path(spark, "log-kv"), scratch_path(spark, "log-kv-out"), checkpoint_dir(spark, "log-kv")
    sink = batch_dirs_sink(out, lambda b: b.select("key", F.col("value").cast("string").alias("value")))
    for half in (e.where("old"), e.where("NOT old")):
        _append_events(spark, path, half)
        run_available(ls.log_stream(spark, path, "latest"), sink, checkpoint)
    return read_batches(spark, out, "key string, value string").drop("batch")


def _resume_state(spark, sf_dir):
    """Commits that a stream stored, and the log as it is when it comes back.

    The stream read the older half of partitions 0 and 1. Since then partition 0 has grown, partition 1
    was made anew with the younger half only (its commit may lie beyond its end), and partition 2 is new.
    """
    e = _halves(spark, sf_dir)
    part = F.col("user_id") % N_LOG_PARTITIONS
    before, path, out = scratch_path(spark, "log-then"), scratch_path(spark, "log-now"), scratch_path(spark, "log-commits")
    _append_events(spark, before, e.where(F.col("old") & (part < 2)))
    run_available(ls.log_stream(spark, before), batch_dirs_sink(out, lg.commits), checkpoint_dir(spark, "log-then"))
    _append_events(spark, path, e.where(F.col("old") & (part != 1)))
    _append_events(spark, path, e.where(~F.col("old")))
    committed = lg.current_commits(read_batches(spark, out, "topic string, partition int, next_offset long"))
    return committed.withColumnRenamed("next_offset", "committed"), path


@register("offset_clamp")
def offset_clamp(spark, sf_dir):
    committed, path = _resume_state(spark, sf_dir)
    return lg.clamp(committed, lg.log_bounds(spark, path))


@register("log_resume")
def log_resume(spark, sf_dir):
    """The stream comes back at the clamped commits."""
    committed, path = _resume_state(spark, sf_dir)
    starts = ls.starting_offsets(lg.clamp(committed, lg.log_bounds(spark, path)))
    out = scratch_path(spark, "log-resumed")
    run_available(ls.log_stream(spark, path, starts), batch_dirs_sink(out, lambda b: b.select(
        "topic", "partition", "offset", "key", F.col("value").cast("string").alias("value"))), checkpoint_dir(spark, "log-resumed"))
    return read_batches(spark, out, "topic string, partition int, offset long, key string, value string").drop("batch")


@register("offset_commit")
def offset_commit(spark, sf_dir):
    path = _log_path(spark, sf_dir)
    out = scratch_path(spark, "commits")
    run_available(lg.stream_log(spark, path), batch_dirs_sink(out, lg.commits), checkpoint_dir(spark, "commits"))
    return lg.current_commits(read_batches(spark, out, "topic string, partition int, next_offset long"))


@register("log_sink")
def log_sink(spark, sf_dir):
    """Purchases streamed into topic ``purchase_out`` by key, and without keys into ``output``, batch by batch."""
    path = scratch_path(spark, "log-out")

    def sink(b, batch_id):
        value = lg.encode(b, ["event_id", "user_id", "value"]).alias("value")
        keyed = b.select(F.lit("purchase_out").alias("topic"), (F.col("user_id") % N_LOG_PARTITIONS).alias("partition"),
                         F.col("user_id").cast("string").alias("key"), value, F.col("ts").alias("timestamp"), "event_id")
        # a record without a key goes to any partition; the event's number deals them evenly
        bare = b.select(F.lit("output").alias("topic"), (F.col("event_id") % N_LOG_PARTITIONS).alias("partition"),
                        F.lit(None).cast("string").alias("key"), value, F.col("ts").alias("timestamp"), "event_id")
        lg.append_records(spark, path, keyed.union(bare), "event_id", "purchases", batch_id)

    run_slices(_event_slices(spark, sf_dir), scratch_path(spark, "log-out-src"), N_FILES, "event_id", lambda s: s, sink,
               checkpoint_dir(spark, "log-out"), mode="append")
    return lg.read_log(spark, path).select("topic", "partition", "offset", "key", F.col("value").cast("string").alias("value"))


@register("record_roundtrip")
def record_roundtrip(spark, sf_dir):
    """Records through a log whose every tenth customer also left a broken one; counted, not decoded."""
    c = read_table(spark, sf_dir, "customer")
    recs = c.select(F.lit("people").alias("topic"), F.lit(0).alias("partition"),
                    F.col("c_custkey").cast("string").alias("key"),
                    lg.encode(c, ["c_custkey", "c_name", "c_nationkey"]).alias("value"),
                    F.lit(None).cast("timestamp_ntz").alias("timestamp"), (F.col("c_custkey") * 2).alias("at"))
    torn = recs.where(F.col("at") % 20 == 0).withColumn("value", F.expr("substring(value, 1, 9)")).withColumn("at", F.col("at") + 1)
    path, out = scratch_path(spark, "records"), scratch_path(spark, "records-out")
    lg.append_records(spark, path, recs.union(torn), "at")
    run_available(ls.log_stream(spark, path), lg.decode_sink(out, "c_custkey long, c_name string, c_nationkey int", "c_custkey"),
                  checkpoint_dir(spark, "records"))
    good = read_batches(spark, f"{out}/records", "c_custkey long, c_name string, c_nationkey int").drop("batch")
    n, bad = read_batches(spark, f"{out}/counts", "n long, bad long").agg(F.sum("n"), F.sum("bad")).first()
    return good.withColumns({"n_read": F.lit(n).cast("long"), "n_bad": F.lit(bad).cast("long")})


@register("dir_stream_filtered")
def dir_stream_filtered(spark, sf_dir):
    """Only ``*.csv`` files of a folder that also holds decoys; comma-token count."""
    c = read_table(spark, sf_dir, "customer")
    root = scratch_path(spark, "dir-src")
    lines = c.select(F.concat_ws(",", "c_name", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("value"))
    csv_tmp, decoy_tmp = scratch_path(spark, "csv-parts"), scratch_path(spark, "decoy-parts")
    lines.write.mode("overwrite").text(csv_tmp)
    decoy = c.select(F.concat_ws(",", "c_name", F.lit("DECOY")).alias("value"))
    decoy.write.mode("overwrite").text(decoy_tmp)
    _move_with_suffix(spark, csv_tmp, root, ".csv")
    _move_with_suffix(spark, decoy_tmp, root, ".txt")
    stream = (spark.readStream.option("pathGlobFilter", "*.csv").option("maxFileAge", "30d")
                   .option("maxFilesPerTrigger", 2).text(root))
    out = scratch_path(spark, "dir-out")
    run_available(stream, batch_dirs_sink(out, lambda b: tx.csv_token_count(b, "value")),
                  checkpoint_dir(spark, "dir-out"))
    return read_batches(spark, out, "token string, count long").groupBy("token") \
        .agg(F.sum("count").cast("long").alias("count"))


def _move_with_suffix(spark, src: str, dst_dir: str, suffix: str) -> None:
    """Move written part files into ``dst_dir`` with a file suffix (file-system metadata only)."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    src_p = jvm.org.apache.hadoop.fs.Path(src)
    fs = src_p.getFileSystem(conf)
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(dst_dir))
    for st_ in fs.listStatus(src_p):
        name = st_.getPath().getName()
        if name.startswith("part-"):
            fs.rename(st_.getPath(), jvm.org.apache.hadoop.fs.Path(f"{dst_dir}/{name}{suffix}"))


# --- windows over the purchase stream --------------------------------------------------------
# Rows are kept as panes of one slide in the state; no row is too late unless a lateness is given.
PURCHASE = "event_id long, user_id long, value double, ts timestamp_ntz"


def _timed(df):
    return df.withColumn("et", to_instant("ts"))


def _wall_clock(windows):
    """Window bounds back as wall-clock times."""
    return windows.withColumns({c: from_instant(c) for c in ("window_start", "window_end")})


def _state_panes(spark, sf_dir, name):
    """Panes of all purchases, from the state of a stream that read them."""
    totals = win.pane_totals(_timed(_purchase_stream(spark, _staged_purchases(spark, sf_dir))), "et", SLIDE, ["user_id"], "value")
    checkpoint = checkpoint_dir(spark, name)
    run_available(totals, noop_sink, checkpoint, mode="update")
    return late.open_panes(spark, checkpoint).select("user_id", F.col("window.start").alias("pane"), "exact", "rest", "cnt")


@register("stream_win_tumbling")
def stream_win_tumbling(spark, sf_dir):
    return _wall_clock(win.from_panes(_state_panes(spark, sf_dir, "swin-5"), TUMBLE, SLIDE, ["user_id"]))


@register("stream_win_sliding_30")
def stream_win_sliding_30(spark, sf_dir):
    return _wall_clock(win.from_panes(_state_panes(spark, sf_dir, "swin-30"), WIN_30, SLIDE, ["user_id"]))


@register("stream_win_sliding_60")
def stream_win_sliding_60(spark, sf_dir):
    return _wall_clock(win.from_panes(_state_panes(spark, sf_dir, "swin-60"), WIN_60, SLIDE, ["user_id"]))


LATENESS = "10 days"
# Far after any purchase; its own windows stay open. The key must not be null: a join drops null keys
# before the watermark sees their times.
END_OF_STREAM = "(-1L, -1L, 0D, timestamp_ntz'2999-01-01 00:00:00')"


def _event_slices(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return e.select("event_id", "user_id", "value", "ts")


def _dealt_events(spark, sf_dir):
    """Purchases with a key that deals them out of time order."""
    return _event_slices(spark, sf_dir).withColumn("deal", F.pmod("event_id", F.lit(97)))


def _late_split(spark, sf_dir, name):
    """Purchases in four micro-batches out of time order, cut at ``LATENESS`` behind the batches before."""
    path = scratch_path(spark, name)
    run_slices(_dealt_events(spark, sf_dir), scratch_path(spark, f"{name}-src"), N_FILES, "deal", _timed,
               late.split_sink(path, "et", LATENESS), checkpoint_dir(spark, name), mode="append")
    return path


@register("stream_late_rows")
def stream_late_rows(spark, sf_dir):
    """The counted side output: every purchase more than ``LATENESS`` behind the batches before its own."""
    rows = late.late_rows(spark, _late_split(spark, sf_dir, "late-rows"), PURCHASE)
    return rows.select("event_id", F.col("batch").cast("int").alias("batch"))


@register("stream_win_bounded")
def stream_win_bounded(spark, sf_dir):
    """Sliding windows over the purchases that came in time, with panes leaving the state behind the watermark."""
    split, out, checkpoint = _late_split(spark, sf_dir, "late-win"), scratch_path(spark, "late-panes"), checkpoint_dir(spark, "late-panes")
    late.run_panes(spark, split, f"{PURCHASE}, deal long, et timestamp, batch long", "et", SLIDE, ["user_id"], "value", LATENESS, out, checkpoint)
    return _wall_clock(win.from_panes(late.all_panes(spark, "user_id long", out, checkpoint), WIN_30, SLIDE, ["user_id"]))


def _closed_windows(spark, sf_dir, name, transform, schema):
    """Run an append-mode query over purchases in four time slices and an end-of-stream row."""
    e = _event_slices(spark, sf_dir).withColumn("at", F.unix_micros(to_instant("ts")))
    end = spark.sql(f"SELECT *, unix_micros(cast(ts AS timestamp)) AS at FROM VALUES {END_OF_STREAM} AS t(event_id, user_id, value, ts)")
    path = scratch_path(spark, name)
    run_slices(e, scratch_path(spark, f"{name}-src"), N_FILES, "at",
               lambda s: transform(_timed(s).withWatermark("et", "1 minute")), batch_dirs_sink(path), checkpoint_dir(spark, name),
               mode="append", marker=end)
    return _wall_clock(read_batches(spark, path, schema).drop("batch"))


_WINDOW_ROW = "user_id long, window_start timestamp, window_end timestamp, sum double, cnt long, avg double"


@register("stream_win_composed")
def stream_win_composed(spark, sf_dir):
    """Window over windowed results as one streaming query of three chained aggregates."""
    return _closed_windows(spark, sf_dir, "swin-composed", lambda s: win.stream_composed(
        s, "et", WIN_30, WIN_OUTER, SLIDE, ["user_id"], "value"), _WINDOW_ROW)


@register("stream_join_sum_count")
def stream_join_sum_count(spark, sf_dir):
    """Windowed sums joined with windowed counts of the same stream."""
    return _closed_windows(spark, sf_dir, "swin-join", lambda s: win.stream_sum_join_count(
        s, s, "et", TUMBLE, ["user_id"], "value"), _WINDOW_ROW)
