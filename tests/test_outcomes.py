"""What becomes of score updates, counted while they are written; the page of a URL fetched last."""

import datetime

import pytest
from pyspark.sql import functions as F

from presswork import schemas
from presswork.operators import feed, scoring
from presswork.plans import jobs
from presswork.sources import tables

ASOF = "2024-06-01 00:00:00"
KIND = "article_id string, score int, explanation string"


@pytest.fixture
def articles(spark, tmp_path):
    kind = "id string, title string, published_at timestamp, naver_url string, clickbait_score int"
    days = [datetime.datetime(2024, 1, day, 3) for day in (10, 11, 12)]
    rows = [(f"a{i}", f"t{i}", days[i % 3], f"u{i}", 50 if i % 2 else None) for i in range(9)]
    path = str(tmp_path / "articles")
    tables.append_articles(tables.conform(spark.createDataFrame(rows, kind), schemas.ARTICLE), path)
    return path


def run(spark, path, rows):
    return jobs.save_scores(path, spark.createDataFrame(rows, KIND), F.to_timestamp(F.lit(ASOF)))


UPDATES = [("a0", 10, "x"), ("a2", 20, "x"), ("a1", 30, "x"), ("zz", 40, "x"), (None, 50, "x")]


def test_totals_of_a_run_and_of_its_rerun(spark, articles):
    assert run(spark, articles, UPDATES) == jobs.UpdateTotals(2, 1, 1, 1)
    assert run(spark, articles, UPDATES) == jobs.UpdateTotals(0, 3, 1, 1)
    scores = {row.id: row.clickbait_score for row in tables.read_table(spark, articles).collect()}
    assert (scores["a0"], scores["a2"], scores["a1"], scores["a4"]) == (10, 20, 50, None)


def test_totals_without_a_match_or_an_update(spark, articles):
    assert run(spark, articles, [("zz", 1, "x"), (None, 2, "x")]) == jobs.UpdateTotals(0, 0, 1, 1)
    assert run(spark, articles, []) == jobs.UpdateTotals(0, 0, 0, 0)


def test_outcomes_agree_with_totals(spark, articles):
    table = tables.read_table(spark, articles)
    labelled = scoring.update_outcomes(spark.createDataFrame([*UPDATES, ("", 1, "x")], KIND), table)
    outcomes = sorted((row.article_id or "", row.outcome) for row in labelled.collect())
    assert outcomes == [
        ("", "no_id"), ("", "no_id"), ("a0", "updated"), ("a1", "already_processed"), ("a2", "updated"), ("zz", "not_found"),
    ]


def test_empty_id_counts_as_none_in_totals(spark, articles):
    assert run(spark, articles, [("", 1, "x"), ("a0", 2, "x")]) == jobs.UpdateTotals(1, 0, 0, 1)


def test_page_fetched_last_wins(spark):
    at = [datetime.datetime(2024, 1, day) for day in (1, 2)]
    rows = [("u", "Aa old", at[0]), ("u", "Zz new", at[1]), ("v", "b", None), ("v", "c", at[0]), ("w", "e", at[0]), ("w", "d", at[0]), ("x", "n", None)]
    pages = spark.createDataFrame(rows, "naver_url string, page_title string, fetched_at timestamp")
    result = feed.one_per_url(pages)
    assert result.columns == ["naver_url", "page_title"]
    assert sorted(map(tuple, result.collect())) == [("u", "Zz new"), ("v", "c"), ("w", "d"), ("x", "n")]
    assert sorted(map(tuple, feed.one_per_url(pages.drop("fetched_at")).collect())) == [("u", "Aa old"), ("v", "b"), ("w", "d"), ("x", "n")]
