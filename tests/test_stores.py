"""Cells, documents, graph, id sets, files and catalog with the reference's literal inputs."""

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import cells as cl
from quarry.operators import docs as dc
from quarry.operators import graph as gr
from quarry.operators import idset as ids
from quarry.operators.common import dense_positions
from quarry.session import scratch_path
from quarry.sinks.fanout import fanout_by_word, read_fanout
from quarry.sources import files as fs


def _accounts(spark, version=1):
    df = spark.createDataFrame([(1, "jack", 15), (2, "Lily", 16), (3, "mike", 16)], "id int, name string, age int")
    return cl.to_cells(df, F.col("id"), "cf", {"name": F.col("name"), "age": F.col("age")}, version)


def test_cells_put_scan_and_pivot(spark):
    path = cl.put(_accounts(spark), scratch_path(spark, "t-cells"))
    cells = cl.scan(spark, path)
    assert cells.count() == 6
    rows = cl.to_rows(cells, "cf", {"name": "string", "age": "int"}).orderBy("row_key").collect()
    assert [(r.row_key, r.name, r.age) for r in rows] == [("1", "jack", 15), ("2", "Lily", 16), ("3", "mike", 16)]


def test_cells_second_put_replaces(spark):
    path = cl.put(_accounts(spark), scratch_path(spark, "t-cells2"))
    upd = spark.createDataFrame([(2, "Lily", 17)], "id int, name string, age int")
    cl.put(cl.to_cells(upd, F.col("id"), "cf", {"age": F.col("age")}, 2), path)
    cells = cl.scan(spark, path)
    assert cells.count() == 6
    assert cells.where("row_key = '2' AND qualifier = 'age'").first().value == "17"


def test_later_put_wins_at_equal_version(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit("old").alias("a"), F.lit("old").alias("b"))
    cells = lambda d: cl.to_cells(d, F.col("k"), "cf", {"a": F.col("a"), "b": F.col("b")})
    path = cl.put(cells(df), scratch_path(spark, "t-cells4"), buckets=4)
    cl.put(cells(df.withColumn("a", F.lit("new")).withColumn("b", F.lit("new"))), path, buckets=4)
    got = cl.scan(spark, path, buckets=4)
    assert got.count() == 2000 and got.where("value = 'new'").count() == 2000
    rows = cl.to_rows(cl.stored(spark, path, 4), "cf", {"a": "string", "b": "string"})
    assert rows.where("a = 'new' AND b = 'new'").count() == 1000
    # neither the newest cells nor the rows move anything
    for plan in (got, rows):
        assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_range_scan_exact_row_and_pushdown(spark):
    path = cl.put(_accounts(spark), scratch_path(spark, "t-cells3"))
    raw = cl.stored(spark, path)
    one = cl.range_scan(raw, "2", "2")
    assert sorted(r.qualifier for r in one.collect()) == ["age", "name"]
    rng = cl.range_scan(raw, "1", "3", "cf", ["name"])
    assert sorted(r.value for r in rng.collect()) == ["Lily", "jack"]
    plan = rng._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(row_key,1)" in plan


def test_filter_scan(spark):
    df = spark.createDataFrame([("u798387701", "w1", "x"), ("u798387702", "q", "y"), ("u1", "w2", "z")],
                               "row_key string, qualifier string, value string")
    cells = df.select("row_key", F.lit("U").alias("family"), "qualifier", "value")
    got = cl.filter_scan(cells, "U", "79838770", "w").collect()
    assert [(r.row_key, r.qualifier) for r in got] == [("u798387701", "w1")]


def test_documents_maps_json_routes_and_ids(spark):
    m = spark.createDataFrame([(1,)], "x int")
    d1 = dc.map_docs(m, {"one": F.lit(1), "two": F.lit(2), "three": F.lit(3)}).first().doc
    assert d1 == '{"one":"1","two":"2","three":"3"}'
    js = spark.createDataFrame([('{"id":1,"blog":"a","weixin":"b"}',), ("{broken",)], "doc string")
    parsed = dc.parse_docs(js, "doc", "id INT, blog STRING, weixin STRING").collect()
    assert parsed[0].id == 1 and parsed[0].bad_doc is None
    assert parsed[1].id is None and parsed[1].bad_doc == "{broken"
    media = spark.createDataFrame([("game", "Final Fantasy", 2015), ("book", "Harry Potter", 2005), ("cd", "Kind", None)],
                                  "media_type string, title string, year int")
    path = dc.write_docs(media, scratch_path(spark, "t-routes"), route="media_type", mode="overwrite")
    back = spark.read.schema("title string, year int, media_type string").json(path)
    assert {r.media_type: r.title for r in back.collect()} == {"game": "Final Fantasy", "book": "Harry Potter", "cd": "Kind"}
    air = spark.createDataFrame([(1, "OTP", 1), (2, "MUC", 1), (3, "SFO", 1)], "id int, iata string, version int")
    again = air.withColumn("version", F.lit(2))
    assert dc.upsert(air, again, "id").count() == 3
    same = air.withColumn("iata", F.lit("NEW"))                     # of equal versions the new one wins
    assert {r.iata for r in dc.upsert(air, same, "id").collect()} == {"NEW"}
    twice = air.union(air.withColumn("iata", F.lit("ZZZ")))
    assert dc.newest(twice, "id").collect() == dc.newest(twice.repartition(7), "id").orderBy("id").collect() or \
        sorted(dc.newest(twice, "id").collect()) == sorted(dc.newest(twice.repartition(7), "id").collect())


def test_json_documents_are_written_and_bad_ones_kept_apart(spark):
    js = spark.createDataFrame([(1, '{"id":1,"blog":"a"}'), (2, "{broken"), (3, '{"id":"x"}'), (4, None)], "n int, doc string")
    path = dc.write_parsed(dc.parse_docs(js, "doc", "id INT, blog STRING", keep=["n"]), scratch_path(spark, "t-json"))
    good = spark.read.schema("n int, id int, blog string").json(f"{path}/docs")
    bad = spark.read.schema("n int, bad_doc string").json(f"{path}/bad")
    assert {(r.n, r.id, r.blog) for r in good.collect()} == {(1, 1, "a"), (4, None, None)}
    assert {r.n: r.bad_doc for r in bad.collect()} == {2: "{broken", 3: '{"id":"x"}'}


def test_graph_out_degree_fixture(spark):
    lines = spark.createDataFrame([("# comment",), ("1 2",), ("1\t3",), ("",), ("2 3",)], "value string")
    edges = gr.edges_from_text(lines)
    assert edges.count() == 3
    got = {r.id: r.degree for r in gr.out_degree_vertices(edges).collect()}
    assert got == {1: 2, 2: 1, 3: 0}
    # same as reset-to-0 then left-join the out-degrees
    joined = gr.join_vertices(gr.vertices_of(edges, 0), gr.out_degrees(edges), "degree")
    assert {r.id: r.attr for r in joined.collect()} == got


def test_bitmap_fixture(spark):
    a = spark.createDataFrame([(v,) for v in (1, 2, 3, 1000)], "v long")
    b = spark.range(4000, 4256).withColumnRenamed("id", "v")
    assert ids.select_at(a, "v", 3).first().id == 1000
    assert ids.ranks(a, "v", spark.createDataFrame([(999,)], "x long"), "x").first()["rank"] == 3
    cont = {r.id: r.contained for r in ids.contains(a, "v", spark.createDataFrame([(1000,), (7,)], "x long"), "x").collect()}
    assert cont == {1000: True, 7: False}
    ab, bb = ids.to_bitmaps(a, "v"), ids.to_bitmaps(b, "v")
    assert ids.cardinality(ids.bitmap_or(ab, bb)).first().cardinality == 260
    assert ids.cardinality(ids.add_range(ab, spark, 4000, 4255)).first().cardinality == 260
    assert ids.sets_equal(ids.bitmap_or(ab, bb), ids.add_range(ab, spark, 4000, 4255)).first().equal
    assert not ids.sets_equal(ab, bb).first().equal
    assert ids.cardinality(ids.bitmap_and(ab, bb)).first().cardinality == 0
    members = [r.id for r in ids.positions(a, "v").orderBy("j").collect()]
    assert members == [1, 2, 3, 1000]


def test_containers_round_trip(spark):
    dense = spark.range(0, 70000).withColumnRenamed("id", "v")
    sparse = spark.createDataFrame([(v,) for v in (0, 1, 64, 65, 32768, 32769, 10**12, 2**50, None)], "v long")
    for df, n in ((dense, 70000), (sparse, 8), (sparse.limit(0), 0)):
        words = ids.to_bitmaps(df, "v")
        packed = ids.pack(words)
        back = ids.unpack(packed)
        assert ids.cardinality(back).first().cardinality == n and ids.sets_equal(words, back).first().equal
    kinds = ids.pack(ids.to_bitmaps(dense, "v")).selectExpr("bucket", "positions IS NOT NULL AS few").collect()
    assert {r.bucket: r.few for r in kinds} == {0: True, 1: False, 2: False, 3: False}
    assert not ids.sets_equal(ids.to_bitmaps(sparse, "v"), ids.to_bitmaps(sparse.where("v <> 64"), "v")).first().equal


def test_sparse_sets_stay_small(spark):
    path = scratch_path(spark, "t-sparse")
    v = spark.range(1_000_000).select((F.col("id") * ((1 << 50) // 1_000_000)).alias("v"))
    ids.pack(ids.to_bitmaps(v, "v")).write.parquet(path)
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    size = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    assert size < 12 * 1_000_000                                   # a 4 KiB bitmap each would be 4 GB
    assert ids.cardinality(ids.unpack(spark.read.parquet(path))).first().cardinality == 1_000_000


def test_dense_positions_equal_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 100003).alias("k"))
    got = dense_positions(df, ["g"], "k", bucket_width=64)
    ref = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("k")) - 1)
    assert got.exceptAll(ref.select(*got.columns)).count() == 0 and got.count() == 5000


def test_ranks_against_brute_force(spark):
    m = spark.range(0, 3000).select((F.col("id") * 37 % 10007).alias("v"))
    p = spark.range(0, 500).select((F.col("id") * 53 % 11000).alias("x"))
    got = {r.x: r["rank"] for r in ids.ranks(m, "v", p, "x", bucket_width=128).collect()}
    mem = sorted({(i * 37) % 10007 for i in range(3000)})
    import bisect
    want = {x: bisect.bisect_right(mem, x) for x in {(i * 53) % 11000 for i in range(500)}}
    assert got == want


def test_schema_merge_fixture(spark):
    root = scratch_path(spark, "t-merge")
    spark.range(1, 6).select(F.col("id").cast("int").alias("single"), (F.col("id") * 2).cast("int").alias("double")) \
        .write.parquet(f"{root}/key=1")
    spark.range(6, 11).select(F.col("id").cast("int").alias("single"), (F.col("id") * 3).cast("int").alias("triple")) \
        .write.parquet(f"{root}/key=2")
    df = fs.read_merged(spark, root)
    assert df.columns == ["single", "double", "triple", "key"]
    assert df.count() == 10 and df.where("triple IS NULL").count() == 5


def test_save_as_table_listed(spark):
    a = spark.createDataFrame([("id1", "info1"), ("id2", "info2")], "id string, info string")
    b = spark.createDataFrame([("id3", "info3"), ("id4", "info4"), ("id5", "info5")], "id string, info string")
    name = f"tb_logs_{uuid.uuid4().hex[:6]}"
    t = fs.save_as_table(a.union(b), name, scratch_path(spark, name))
    assert name in fs.table_names(spark) and t.count() == 5
    cols = fs.catalog_columns(spark).where(F.col("table_name") == name).collect()
    assert [(r.col_name, r.data_type) for r in cols] == [("id", "string"), ("info", "string")]


def test_jdbc_options_all_or_none(spark):
    import pytest
    with pytest.raises(ValueError):
        fs.jdbc_scan(spark, "jdbc:none", "t", column="id", lower=1)


def test_fanout_case_insensitive_folders(spark):
    words = spark.createDataFrame([(w,) for w in ["The", "the", "a/b", "", "x", "The"]], "word string")
    path = fanout_by_word(words, scratch_path(spark, "t-fan"))
    got = {r.word: r.n for r in read_fanout(spark, path).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {"The": 3, "the": 3, "a/b": 1, "x": 1}


def test_case_folding_like_java(spark):
    from quarry.sinks.fanout import fold_case
    got = {r.w: r.f for r in spark.createDataFrame([("ΟΔΟΣ",), ("οδος",), ("οδοσ",), ("Straße",), ("STRASSE",)], "w string")
           .select("w", fold_case(F.col("w")).alias("f")).collect()}
    assert got["ΟΔΟΣ"] == got["οδος"] == got["οδοσ"] and got["Straße"] != got["STRASSE"]


def test_dense_positions_sparse_64bit_keys(spark):
    from quarry.operators.common import levels_for
    # keys spread over most of the signed 64-bit range: many levels of prefix sums
    df = spark.range(0, 3000).select((F.col("id") % 2).alias("g"),
                                     (F.xxhash64("id")).alias("k"))
    assert levels_for(df, "k", 1 << 16) >= 3
    got = dense_positions(df, ["g"], "k")
    ref = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("k")) - 1)
    assert got.exceptAll(ref.select(*got.columns)).count() == 0 and got.count() == 3000


def test_bucket_bases_levels_agree(spark):
    from quarry.operators.common import bucket_bases
    counts = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 977 - 2_000_000).alias("b"),
                                         (F.col("id") % 7 + 1).alias("n"))
    flat = bucket_bases(counts, ["g"], "b", "n", 0)
    deep = bucket_bases(counts, ["g"], "b", "n", 2)
    assert flat.exceptAll(deep.select(*flat.columns)).count() == 0
