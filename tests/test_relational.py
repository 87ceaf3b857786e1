from pyspark.sql import functions as F

from quarry.operators import relational as rel


def _col(spark, values, name="v", typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {typ}")


def test_subtract_keeps_left_duplicates_and_matches_null(spark):
    got = rel.subtract(_col(spark, ["a", "a", "b", None]), _col(spark, ["b", None]))
    assert sorted(r.v for r in got.collect()) == ["a", "a"]
    got = rel.subtract(_col(spark, ["aa", "bb", "cc", "dd"]), _col(spark, ["aa", "dd", "ff"]))
    assert sorted(r.v for r in got.collect()) == ["bb", "cc"]


def test_intersection_is_distinct(spark):
    got = rel.intersection(_col(spark, [1, 1, 2, 3], typ="int"), _col(spark, [1, 1, 3, 9], typ="int"))
    assert sorted(r.v for r in got.collect()) == [1, 3]


def test_cartesian(spark):
    got = rel.cartesian(_col(spark, ["1", "2", "3"], "a"), _col(spark, ["a", "b", "c"], "b"))
    assert got.count() == 9


def test_union_all_keeps_duplicates(spark):
    a = spark.createDataFrame([("id1", "info1"), ("id2", "info2")], "id string, info string")
    b = spark.createDataFrame([("id3", "info3"), ("id4", "info4"), ("id5", "info5")], "id string, info string")
    assert rel.union_all(a, b).count() == 5
    assert rel.union_all(a, a).count() == 4


def test_observed_sum_and_counter(spark):
    out, obs = rel.observed_sum(spark.range(0, 11, 1, 2), "id", 2)
    row = out.first()
    assert (row.total, row.n) == (110, 11)
    assert obs.get["rows"] == 11


def test_average_from_sum_and_count(spark):
    # the reference's printed window example: sums and counts give these averages
    rows = [("zhangsan", 146.0, 32), ("lisi", 79.0, 18), ("wangwu", 99.0, 30), ("zhaoliu", 115.0, 24)]
    pays = []
    for user, total, n in rows:
        pays += [(user, total / n)] * n
    df = spark.createDataFrame(pays, "user string, value double")
    got = {r.user: r for r in rel.sum_count_avg(df, ["user"], "value").collect()}
    assert got["zhangsan"]["cnt"] == 32 and got["zhangsan"]["avg"] == 4.5625
    assert abs(got["lisi"]["avg"] - 4.388888888888889) < 1e-9
    assert abs(got["wangwu"]["avg"] - 3.3) < 1e-9
    assert abs(got["zhaoliu"]["avg"] - 4.791666666666667) < 1e-9


def test_top_k_plan_is_take_ordered(spark):
    df = spark.range(100).select((F.col("id") % 17).alias("page"), F.col("id").cast("double").alias("pop"))
    top = rel.top_k(df, 10, [F.desc("pop"), F.asc("page")])
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    assert [r.pop for r in top.collect()] == [float(x) for x in range(99, 89, -1)]


def test_inner_join_of_aggregates_with_a_hot_key(spark):
    t = spark.range(3000).selectExpr("if(id % 3 = 0, 0, id) k", "cast(id as double) v")
    sums, counts = t.groupBy("k").agg(F.sum("v").alias("s")), t.groupBy("k").count()
    both = rel.inner_join(sums, counts, ["k"])
    assert both.where("k = 0").first()["count"] == 1000 and both.count() == 2001
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate") and plan.count("Aggregate") == 2


def test_sums_and_weights_take_any_double(spark):
    import math

    import pytest
    from quarry.functions.text import exact_sum, weighted_score, weighted_total
    total = lambda values: spark.createDataFrame([(v,) for v in values], "v double").repartition(3).agg(
        exact_sum("v").alias("s")).first().s
    assert total([3e-11, 4e-11, None]) == pytest.approx(7e-11)
    assert total([1e30, 1.0]) == 1e30
    assert total([9e27] * 20) == pytest.approx(1.8e29)             # no overflow
    assert total([9e17] * 20) == 1.8e19 and total([0.1] * 10) == 1.0
    assert math.isnan(total([1.0, float("nan")])) and total([float("inf"), 1.0]) == float("inf")
    assert total([None, None]) is None
    ordinary = [0.1 + 0.2, 1 / 3, 1e15, -2.5, 1e-12, 123456.78]
    d = spark.createDataFrame([(v, 1.0) for v in ordinary], "a double, b double")
    got = [r.w for r in d.select(weighted_score(["a", "b"], (0.8, 1.0)).alias("w")).collect()]
    assert got == pytest.approx([v * 0.8 + 1 for v in ordinary], rel=1e-15)
    assert d.agg(weighted_total(["a", "b"], (0.8, 1.0)).alias("w")).first().w == pytest.approx(math.fsum(v * 0.8 + 1 for v in ordinary), rel=1e-15)
    odd = spark.createDataFrame([(float("nan"), 1.0)], "a double, b double").select(weighted_score(["a", "b"], (0.8, 1.0)).alias("w"))
    assert math.isnan(odd.first().w)
    one = spark.createDataFrame([(1.0, 1.0)], "a double, b double")
    assert one.select(weighted_score(["a", "b"], (0.33333, 0.0004)).alias("w")).first().w == 0.33373
    gone = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "a double, b double")
    assert gone.agg(weighted_total(["a", "b"], (1.0, 1.0)).alias("w")).first().w == 5.0


def test_positions_keep_null_groups_and_null_order_keys(spark):
    from quarry.operators.common import dense_positions
    d = spark.createDataFrame([(None, 1), ("a", None), ("a", 5), (None, 9)], "g string, k long")
    assert dense_positions(d, ["g"], "k").count() == 4


