"""tokens() and lines() against small Python models of Java split and a text-file reader."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.functions.text import lines, tokens


def java_split(s: str, sep: str) -> list[str]:
    if s == "":
        return [""]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def file_lines(text: str) -> list[str]:
    """A Hadoop line reader: \\r\\n, \\r and \\n end lines; a final terminator adds no line."""
    if text == "":
        return []
    body = re.sub(r"(\r\n|\r|\n)\Z", "", text)
    return re.split(r"\r\n|\r|\n", body)


TEXTS = st.lists(st.text(alphabet="ab |,\n\r\t.", max_size=12), min_size=1, max_size=60)


@settings(max_examples=5, deadline=None)
@given(TEXTS)
def test_tokens_match_java_split(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = df.select(tokens("s", " ").alias("sp"), tokens("s", "|").alias("bar"), tokens("s", ",").alias("comma")).collect()
    for t, r in zip(texts, got):
        assert r.sp == java_split(t, " "), t
        assert r.bar == java_split(t, "|"), t
        assert r.comma == java_split(t, ","), t


@settings(max_examples=5, deadline=None)
@given(TEXTS)
def test_lines_match_a_text_reader(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for t, r in zip(texts, df.select(lines("s").alias("l")).collect()):
        assert r.l == file_lines(t), repr(t)
