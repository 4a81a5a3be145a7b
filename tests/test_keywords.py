"""Keyword tables against texts: the join gives what a test per keyword and text gives."""

import random

import pytest
from pyspark.sql import functions as F

from presswork.operators import keywords


def brute(texts, words):
    return sorted((k, w) for k, t in texts if t is not None for w in set(words) if w and w in t)


def found(spark, texts, words, **options):
    left = spark.createDataFrame(texts, "id long, title string")
    right = spark.createDataFrame([(w,) for w in words], "keyword string")
    return sorted(tuple(row) for row in keywords.table_matches(left, right, **options).collect())


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    texts = [(i, "".join(rng.choice("ab가😀 ") for _ in range(rng.randint(0, 40)))) for i in range(150)]
    words = ["".join(rng.choice("ab가😀 ") for _ in range(rng.randint(1, 7))) for _ in range(120)]
    return texts + [(900, None), (901, "")], words + [None, "", "a", "a"]


@pytest.mark.parametrize("options", [{}, {"gram": 2}, {"broadcast_rows": 0}, {"broadcast_rows": 0, "hot_rows": 5}])
def test_equals_a_test_per_keyword(spark, corpus, options):
    texts, words = corpus
    result = found(spark, texts, words, **options)
    assert result == brute(texts, words) and len(result) > 500


def test_no_keywords_or_no_texts(spark):
    assert found(spark, [(1, "abc")], []) == []
    assert found(spark, [(1, "abc")], ["", None]) == []
    assert found(spark, [], ["abc"]) == []


def test_long_text_and_repeated_rows(spark):
    long = "가나다 " * 50_000 + "끝말잇기"
    assert found(spark, [(1, long), (2, long)], ["말잇", "말잇", "없는말"]) == [(1, "말잇"), (2, "말잇")]


def test_keyword_of_unknown_grams_waits_nowhere(spark):
    assert found(spark, [(1, "aaaa bbbb")], ["aaaaz", "a bb", "aaaa bbbb c"]) == [(1, "a bb")]


def test_grams_are_code_points(evaluate):
    assert evaluate(["a😀가b", "ab", "", None], keywords.grams(F.col("v"), F.lit(3)), "string") == [
        ["a😀가", "😀가b"], [], [], [],
    ]


def test_grams_are_cut_without_a_lambda(spark):
    """A lambda per place of a text is not compiled: it took most of the time of the join."""
    cut = spark.createDataFrame([("abcde",)], "v string").select(keywords.grams(F.col("v"), F.lit(4)).alias("g"))
    assert "lambda" not in cut._jdf.queryExecution().toString()
    assert cut.first().g == ["abcd", "bcde"]
