import datetime

import pytest
from pyspark.sql import functions as F

from presswork import schemas
from presswork.functions.records import journalist_key
from presswork.operators import feed, journalists
from presswork.plans import jobs
from presswork.session import new_path
from presswork.sources import tables
from presswork.streaming import jobs as streams

BASE = "https://n.news.naver.com"
LONG = "본문 문장입니다. " * 15


def page(title, body, reporter="", publisher="연합뉴스"):
    return (
        f'<h2 id="title_area">{title}</h2><span class="media_end_head_top_logo_text">{publisher}</span>'
        f'<span class="byline_s">{reporter}</span><div id="dic_area">{body}</div>'
    )


def feed_items(spark, rows):
    data = [
        (i, "k", title, description, "https://example.com", link, stamp)
        for i, (title, description, link, stamp) in enumerate(rows)
    ]
    return spark.createDataFrame(
        data,
        "position long, keyword string, title string, description string, originallink string, link string, pubDate string",
    )


@pytest.fixture(scope="module")
def ingested(spark):
    day = "Mon, 15 Jan 2024 {}:00:00 +0900"
    items = feed_items(
        spark,
        [
            ("api", "d", f"{BASE}/mnews/article/1/1?x=1", day.format("11")),
            ("정확히아홉자제목임", "설" * 81, f"{BASE}/article/1/2", day.format("10")),
            ("other", "d", "https://example.com/1", day.format("10")),
            ("api", "d", f"{BASE}/article/1/1#c", day.format("09")),
            ("너무 짧은 설명의 기사 제목", "짧음", f"{BASE}/article/1/3", day.format("08")),
            ("같은 내용의 다른 주소 기사", "d", f"{BASE}/article/1/4", day.format("08")),
            ("날짜를 알 수 없는 기사 제목", "설" * 120, f"{BASE}/article/1/5", "yesterday"),
            ("이미 저장된 기사의 제목", "설" * 122, f"{BASE}/article/1/8", day.format("12")),
            ("오래된 기사의 제목입니다", "설" * 120, f"{BASE}/article/1/6", "Sun, 14 Jan 2024 23:59:59 +0900"),
            ("그 뒤에 나온 기사 제목", "설" * 121, f"{BASE}/article/1/7", day.format("07")),
        ],
    )
    first = page("첫 번째 기사 제목입니다", LONG, "김기자 a@b.co")
    pages = spark.createDataFrame(
        [
            (f"{BASE}/article/1/1", first), (f"{BASE}/article/1/1", first), (f"{BASE}/article/1/4", first),
            (f"{BASE}/article/1/2", page("페이지 제목은 있습니다", "짧은 본문")),
            (f"{BASE}/article/1/8", page("이미 저장된 기사의 제목", LONG + "끝", "박기자")),
        ],
        "naver_url string, html string",
    )
    stored = spark.createDataFrame([(f"{BASE}/article/1/8",)], "naver_url string")
    people = spark.createDataFrame([("known", "김기자", "연합뉴스")], "id string, name string, publisher string")
    return jobs.ingest(items, pages, stored, people, day=datetime.date(2024, 1, 15))


def test_ingest(spark, ingested):
    new = {r.naver_url[-1]: r for r in ingested.new_articles.collect()}
    assert set(new) == {"1", "2"}
    assert new["1"].title == "첫 번째 기사 제목입니다" and new["1"].journalist_id == "known"
    # A page with a short body does not count as fetched: feed values are used and padded.
    assert new["2"].title == "정확히아홉자제목임"
    assert new["2"].content == "설" * 81 + " " + "설" * 81
    assert (new["2"].journalist_name, new["2"].publisher) == ("익명기자_네이버뉴스", "네이버뉴스")
    created = ingested.new_journalists.collect()
    assert [(r.name, r.article_count, r.avg_clickbait_score) for r in created] == [("익명기자_네이버뉴스", 0, 0.0)]
    assert new["2"].journalist_id == created[0].id
    assert {r.position: r.reject_reason for r in ingested.rejected.collect()} == {4: "content", 6: "published_at"}
    assert {r.outcome: r.n for r in ingested.outcomes.collect()} == {"inserted": 2, "stored": 1}


def test_saved_articles_are_laid_out_by_local_day(spark, ingested, tmp_path):
    articles, people = str(tmp_path / "articles"), str(tmp_path / "people")
    jobs.save_ingest(ingested, articles, people)
    table = tables.read_table(spark, articles)
    assert {str(r.local_date) for r in table.select("local_date").distinct().collect()} == {"2024-01-15"}
    assert tables.read_table(spark, people).count() == 1


def test_ingested_articles_feed_the_other_jobs(spark, ingested, tmp_path):
    articles, people = str(tmp_path / "articles"), str(tmp_path / "people")
    jobs.save_ingest(ingested, articles, people, asof=F.to_timestamp(F.lit("2024-01-16 00:00:00")))
    table = tables.read_table(spark, articles, schemas.ARTICLE)
    assert table.columns == [*schemas.ARTICLE.names, "local_date"] and {str(r.created_at) for r in table.collect()} == {"2024-01-16 00:00:00"}
    assert tables.read_table(spark, people, schemas.JOURNALIST).where("created_at is null").count() == 0
    stored = tables.read_table(spark, articles)
    assert jobs.build_requests(stored, str(tmp_path / "requests")).count() == 2
    assert jobs.merge_duplicates(stored).survivors.count() == 2
    jobs.save_scores(
        articles,
        stored.limit(1).select(F.col("id").alias("article_id"), F.lit(40).alias("score"), F.lit("why").alias("explanation")),
        F.to_timestamp(F.lit("2024-01-17 00:00:00")),
    )
    scored = tables.read_table(spark, articles)
    assert scored.where("clickbait_score = 40").count() == 1 and scored.count() == 2
    synced = jobs.sync_statistics(tables.read_table(spark, people, schemas.JOURNALIST), scored)
    assert synced.journalists.count() == 1
    version = jobs.write_new_version(jobs.merge_duplicates(scored).survivors, "articles", str(tmp_path / "versions"))
    assert version.startswith(str(tmp_path / "versions")) and tables.read_table(spark, version).count() == 2


def test_scores_of_articles_without_a_day_are_saved(spark, tmp_path):
    path = str(tmp_path / "articles")
    rows = [("a", None), ("b", datetime.datetime(2024, 1, 15, 1))]
    df = spark.createDataFrame(rows, "id string, published_at timestamp")
    tables.append_articles(tables.conform(df, schemas.ARTICLE), path)
    updates = spark.createDataFrame([("a", 7, "e"), ("b", 8, "e")], "article_id string, score int, explanation string")
    jobs.save_scores(path, updates, F.current_timestamp())
    assert {r.id: r.clickbait_score for r in tables.read_table(spark, path).collect()} == {"a": 7, "b": 8}


def test_day_slices(spark):
    rows = [("2024-01-14 14:59:59",), ("2024-01-14 15:00:00",), ("2024-01-15 14:59:59",), ("2024-01-15 15:00:00",)]
    df = spark.createDataFrame(rows, "t string").select(F.to_timestamp("t").alias("published_at"))
    assert feed.on_day(df, datetime.date(2024, 1, 15)).count() == 2


def test_until_older_keeps_rows_before_the_first_older_one(spark):
    days = [16, 15, 15, 14, 15, 16]
    rows = [(k, i, datetime.datetime(2024, 1, d, 1)) for k in ("a", "b") for i, d in enumerate(days if k == "a" else [15, 15])]
    df = spark.createDataFrame(rows, "keyword string, position int, published_at timestamp")
    kept = feed.until_older(df, datetime.date(2024, 1, 15), ["keyword"], hot_rows=2).collect()
    assert sorted((r.keyword, r.position) for r in kept) == [("a", 1), ("a", 2), ("b", 0), ("b", 1)]


def test_find_or_create_journalists(spark):
    specs = [(i, f"기자이름{i}", f"언론{i % 10}") for i in range(150)] + [(150, " 기자이름0 ", "언론0"), (151, "a_b", "cc"), (152, "aa", "b_cc")]
    articles = spark.createDataFrame(specs, "id int, journalist_name string, publisher string")
    stored = spark.createDataFrame([("x", "기자이름0", "언론0"), ("y", "기자이름1", "언론1")], "id string, name string, publisher string")
    resolved = {(r.name, r.publisher): r for r in journalists.resolve(articles, stored).collect()}
    assert len(resolved) == 152 and sum(r.is_new for r in resolved.values()) == 150
    assert resolved[("기자이름0", "언론0")].id == "x"
    assert journalists.new_journalists(articles, stored).count() == 150
    for hot_rows in (1, 1_000_000):
        attached = journalists.attach_ids(articles, journalists.resolve(articles, stored), hot_rows)
        assert attached.count() == 153 and attached.where("journalist_id is null").count() == 0
    assert journalists.attach_ids(articles, stored).where("journalist_id is null").count() == 150


def test_natural_keys_do_not_collide(spark):
    pairs = spark.createDataFrame([("a_b", "c"), ("a", "b_c"), ("a", None), (None, "a")], "n string, p string")
    assert pairs.select(journalist_key(F.col("n"), F.col("p"))).distinct().count() == 4


@pytest.fixture
def article_table(spark, tmp_path):
    path = str(tmp_path / "articles")
    rows = [
        (str(i), f"title {i}", datetime.datetime(2024, 1, 10 + i % 3, 3), f"u{i}", 5 if i == 4 else None)
        for i in range(9)
    ]
    df = spark.createDataFrame(rows, "id string, title string, published_at timestamp, naver_url string, clickbait_score int")
    tables.append_articles(
        df.withColumn("clickbait_explanation", F.lit(None).cast("string")).withColumn(
            "updated_at", F.lit(None).cast("timestamp_ntz")
        ),
        path,
    )
    return path


def result_line(i, score=60):
    answer = f'{{\\"clickbait_score\\": {score}, \\"clickbait_explanation\\": \\"why\\"}}'
    return f'{{"custom_id": "article_{i}", "response": {{"body": {{"choices": [{{"message": {{"content": "{answer}"}}}}]}}}}}}'


def asof():
    return F.expr("timestamp_ntz'2024-06-01 00:00:00'")


def scores_of(spark, path):
    return {r.id: r.clickbait_score for r in tables.read_table(spark, path).collect()}


def test_scores_rewrite_only_the_touched_days(spark, article_table, tmp_path):
    files = lambda day: sorted(p.name for p in (tmp_path / "articles" / f"local_date=2024-01-{day}").glob("*.parquet"))
    untouched, touched = files(12), files(10)
    updates = spark.createDataFrame([("0", 60, "w"), ("4", 70, "w"), ("77", 1, "w")], "article_id string, score int, explanation string")
    jobs.save_scores(article_table, updates, asof())
    assert scores_of(spark, article_table) == {**{str(i): None for i in range(9)}, "0": 60, "4": 5}
    assert files(12) == untouched and files(10) != touched
    jobs.save_scores(article_table, updates.limit(0), asof())
    assert scores_of(spark, article_table)["0"] == 60


def test_score_stream_replay(spark, article_table):
    source = new_path(spark, "lines")
    schema = "batch_id string, pos int, value string"
    batches = spark.createDataFrame([("b9", "completed")], "batch_id string, status string")

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def run(checkpoint):
        lines = streams.read_files(spark, source, spark.createDataFrame([], schema).schema)
        streams.score_stream(lines, article_table, batches, checkpoint, asof()).awaitTermination()

    state = new_path(spark, "state")
    arrive([("b1", 0, result_line(0)), ("b1", 1, result_line(4, 99)), ("b2", 2, result_line(1, 500)), ("b9", 3, result_line(2))])
    run(state)
    expected = {**{str(i): None for i in range(9)}, "0": 60, "4": 5}
    assert scores_of(spark, article_table) == expected
    arrive([("b3", 0, result_line(0, 10)), ("b3", 1, result_line(3, 33))])
    run(state)
    assert scores_of(spark, article_table) == {**expected, "3": 33}
    run(new_path(spark, "fresh-state"))
    assert scores_of(spark, article_table) == {**expected, "3": 33}


@pytest.mark.parametrize("lateness", [None, "10 days"])
def test_ingest_stream_replay(spark, tmp_path, lateness):
    source, target = new_path(spark, "articles-in"), str(tmp_path / "table")
    schema = "position long, naver_url string, title string, content string, publisher string, journalist_name string, published_at timestamp"
    when = datetime.datetime(2024, 1, 15, 3)

    def row(position, number, title="아홉 글자가 넘는 제목입니다"):
        return (position, f"{BASE}/article/1/{number}", title, LONG, "p", "n", when)

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def run(checkpoint):
        rows = streams.read_files(spark, source, spark.createDataFrame([], schema).schema)
        streams.ingest_stream(rows, target, checkpoint, lateness).awaitTermination()

    tables.append_articles(spark.createDataFrame([row(0, 0)], schema).drop("position"), target)
    state = new_path(spark, "state")
    arrive([row(1, 0), row(2, 1), row(3, 1), row(4, 2, "짧음")])
    run(state)
    arrive([row(5, 1), row(6, 3)])
    run(state)
    run(new_path(spark, "fresh-state"))
    stored = sorted(r.naver_url[-1] for r in tables.read_table(spark, target).collect())
    assert stored == ["0", "1", "3"]


def test_trend_stream_drops_late_rows_and_equals_batch(spark, tmp_path):
    source, out, state = new_path(spark, "events"), new_path(spark, "trend"), new_path(spark, "state")
    schema = "ts timestamp, score int"

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        rows = streams.read_files(spark, source, spark.createDataFrame([], schema).schema)
        streams.trend_stream(rows, out, state, "1 day").awaitTermination()

    moment = lambda day, hour: datetime.datetime(2024, 1, day, hour)
    first = [(moment(1, 14), 10), (moment(1, 15), 20), (moment(2, 3), None), (moment(9, 1), 40)]
    arrive(first)
    run()
    arrive([(moment(9, 2), 60), (moment(1, 14), 99)])
    run()
    read = {r.day: tuple(r)[1:] for r in streams.trend_columns(streams.latest_trend(spark, out)).collect()}
    on_time = spark.createDataFrame(first + [(moment(9, 2), 60)], schema)
    batch = {r.day: tuple(r)[1:] for r in streams.trend_columns(streams.daily_trend(on_time)).collect()}
    assert read == batch
    assert set(read) == {"2024-01-01", "2024-01-02", "2024-01-09"}


def test_statistics_sync(spark):
    people = spark.createDataFrame(
        [("a", 1, 1.0, 1), ("b", 2, 2.0, 2)], "id string, article_count long, avg_clickbait_score double, max_score int"
    ).withColumn("name", F.lit("n")).withColumn("publisher", F.lit("p"))
    scores = spark.createDataFrame([("a", 40), ("a", 60)], "journalist_id string, clickbait_score int")
    result = jobs.sync_statistics(people, scores, fix=True, full_update=True)
    assert tuple(result.fixes.first()) == (1, 2, 2)
    assert tuple(result.updates.first()) == (1, 1, 2)
    assert {r.id: r.avg_clickbait_score for r in result.journalists.collect()} == {"a": 50.0, "b": 2.0}
    assert jobs.sync_statistics(people, scores, fix=False).updates is None


def test_keyword_union_and_matches(spark):
    trends = spark.createDataFrame([("충격",), ("새말",)], "keyword string")
    assert feed.combined_keywords(spark, trends).count() == 11
    articles = spark.createDataFrame([(1, "충격 논란"), (2, "보통")], "id int, title string")
    found = feed.keyword_matches(articles).collect()
    assert sorted((r.id, r.keyword) for r in found) == [(1, "논란"), (1, "충격")]
