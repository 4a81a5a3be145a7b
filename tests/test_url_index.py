"""The side table of stored URLs, and ingests that stop between its steps."""

import datetime

import pytest
from pyspark.sql import functions as F

from presswork import schemas
from presswork.operators import dedup
from presswork.plans import jobs
from presswork.sources import folders, tables, url_index

BUCKETS = 16
URL = "https://n.news.naver.com/article/1/"


def urls(spark, numbers):
    return spark.createDataFrame([(None if n is None else f"{URL}{n}",) for n in numbers], "naver_url string")


def held(frame):
    return sorted(int(row.naver_url.rsplit("/", 1)[1]) for row in frame.collect())


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "urls")


def test_reads_the_buckets_asked_for(spark, path):
    url_index.append(urls(spark, range(400)), path, BUCKETS)
    asked = urls(spark, [3, 3, 7, None, 1000])
    near = url_index.among(asked, path, BUCKETS)
    wanted = {row[0] for row in asked.dropna().select(url_index.bucket_of(F.col("naver_url"), BUCKETS)).collect()}
    read = near.select(url_index.bucket_of(F.col("naver_url"), BUCKETS).alias("bucket")).distinct()
    assert {row.bucket for row in read.collect()} == wanted and len(wanted) < BUCKETS
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert held(dedup.existing_urls(asked, near)) == [3, 7]


def test_equals_the_article_table(spark, path):
    url_index.append(urls(spark, [*range(0, 300, 3), 0, None]), path, BUCKETS)
    stored, asked = urls(spark, range(0, 300, 3)), urls(spark, range(300))
    assert held(dedup.existing_urls(asked, url_index.among(asked, path, BUCKETS))) == held(stored)


def test_nothing_stored_or_nothing_asked(spark, path):
    assert url_index.among(urls(spark, [1]), path).count() == 0
    url_index.append(urls(spark, [1, 2]), path, BUCKETS)
    assert url_index.among(urls(spark, []), path, BUCKETS).count() == 0
    assert url_index.among(urls(spark, [None]), path, BUCKETS).count() == 0


def result(spark, numbers):
    when = datetime.datetime(2024, 1, 5)
    kind = "id string, title string, content string, journalist_id string, journalist_name string, publisher string, published_at timestamp, naver_url string"
    rows = [(f"a{n}", f"title {n}", "content", "j", "n", "p", when, f"{URL}{n}") for n in numbers]
    people = spark.createDataFrame([], "id string, name string, publisher string")
    none = spark.createDataFrame([], "outcome string, n long")
    return jobs.IngestResult(spark.createDataFrame(rows, kind), people, none, none)


def stored_urls(spark, path):
    return sorted(set(held(tables.read_table(spark, path, schemas.STORED_URL))))


@pytest.mark.parametrize("stop", ["append_articles", "settle", "after_append"])
def test_an_ingest_that_stops_is_completed(spark, path, tmp_path, monkeypatch, stop):
    articles, people = str(tmp_path / "articles"), str(tmp_path / "people")
    jobs.save_ingest(result(spark, [1, 2]), articles, people, urls_path=path)
    assert stored_urls(spark, path) == [1, 2]
    real_append = url_index.append

    def fail(*args, **options):
        raise OSError("lost")

    def append_then_fail(*args, **options):
        real_append(*args, **options)
        fail()

    with monkeypatch.context() as patch:
        if stop == "append_articles":
            patch.setattr(tables, "append_articles", fail)
        elif stop == "settle":
            patch.setattr(url_index, "settle", fail)
        else:
            patch.setattr(url_index, "append", append_then_fail)
        with pytest.raises(OSError):
            jobs.save_ingest(result(spark, [3, 4]), articles, people, urls_path=path)
    items = urls(spark, [1, 2, 3, 4]).select(F.col("naver_url").alias("link"))
    known = jobs.stored_among(items, path, articles)
    # Either the articles are there and their URLs known, or neither is.
    assert sorted(set(held(known))) == held(tables.read_table(spark, articles)) == ([1, 2] if stop == "append_articles" else [1, 2, 3, 4])
    assert folders.children(spark, f"{path}_announced") == []
    jobs.save_ingest(result(spark, [5]), articles, people, urls_path=path)
    assert 5 in stored_urls(spark, path)


def test_recover_before_any_article(spark, path, tmp_path):
    url_index.announce(urls(spark, [1]), path)
    assert url_index.recover(spark, path, str(tmp_path / "none")) == 1
    assert url_index.recover(spark, path, str(tmp_path / "none")) == 0
    assert url_index.among(urls(spark, [1]), path).count() == 0
