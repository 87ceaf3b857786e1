from pyspark.sql import functions as F

from quarry.functions.text import lines, tokens
from quarry.operators import text as tx


def test_tokens_follow_java_split(spark):
    df = spark.createDataFrame([("a  b  ",), ("",), ("   ",), (" a",)], "s string")
    got = [r.t for r in df.select(tokens("s").alias("t")).collect()]
    assert got == [["a", "", "b"], [""], [], ["", "a"]]


def test_tokens_other_separators(spark):
    df = spark.createDataFrame([("page37|5|1.5|-1",), ("a,b,,",)], "s string")
    assert df.select(tokens("s", "|").alias("t")).first().t == ["page37", "5", "1.5", "-1"]
    assert df.select(tokens("s", ",").alias("t")).collect()[1].t == ["a", "b"]


def test_lines_like_a_text_file(spark):
    df = spark.createDataFrame([("a\n\nb\n",), ("",), ("x",), ("\n",), ("a\r\nb\rc\r\n",)], "s string")
    assert [r.l for r in df.select(lines("s").alias("l")).collect()] == [["a", "", "b"], [], ["x"], [""], ["a", "b", "c"]]


def test_word_count_counts_empty_tokens(spark):
    df = spark.createDataFrame([("to be  or",), ("be",)], "line string")
    got = {r.word: r["count"] for r in tx.word_count(df).collect()}
    assert got == {"to": 1, "be": 2, "": 1, "or": 1}


def test_distinct_words_drop_empty(spark):
    df = spark.createDataFrame([("to be  or",), ("be",)], "line string")
    assert sorted(r.word for r in tx.distinct_words(df).collect()) == ["be", "or", "to"]


def test_typed_and_dynamic_records(spark):
    df = spark.createDataFrame([("Michael, 29",), ("Andy, 30",), ("Justin, 19",)], "value string")
    typed = tx.typed_records(df, [("name", "string"), ("age", "int")])
    assert typed.dtypes == [("name", "string"), ("age", "int")]
    assert [tuple(r) for r in typed.where("age >= 13").collect()] == [("Michael", 29), ("Andy", 30), ("Justin", 19)]
    dyn = tx.dynamic_schema_records(df, "name age")
    assert dyn.dtypes == [("name", "string"), ("age", "string")]


def test_string_numeric_filter_skips_non_numbers(spark):
    df = spark.createDataFrame([("a", "abc"), ("b", "13.5"), ("c", "12"), ("d", None)], "name string, age string")
    assert [r.name for r in df.where(tx.numeric_at_least("age", 13)).collect()] == ["b"]


def test_malformed_int_fails_like_toInt(spark):
    import pytest
    df = spark.createDataFrame([("x, notanumber",)], "value string")
    with pytest.raises(Exception):
        tx.typed_records(df, [("name", "string"), ("age", "int")]).collect()
