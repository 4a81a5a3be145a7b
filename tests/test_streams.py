"""Streams that remember: the feed piece by piece, and batches that arrive piece by piece."""

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from presswork import schemas
from presswork.operators import dedup
from presswork.session import new_path
from presswork.sources import folders, tables
from presswork.streaming import held as held_rows
from presswork.streaming import jobs as streams

BASE = "https://n.news.naver.com/article/1"
FEED = "position long, keyword string, naver_url string, title string, content string, publisher string, journalist_name string, published_at timestamp"
DAY = datetime.datetime(2024, 1, 15, 3)


def feed_rows(n, seed, urls=12, texts=8):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        text = rng.randrange(texts)
        title = "짧음" if rng.random() < 0.1 else f"아홉 글자가 넘는 제목 {text}"
        rows.append((k, rng.choice(["가", "나", None]), f"{BASE}/{rng.randrange(urls)}", title, f"본문 {text} " * 40, "p", f"기자{text % 3}", DAY))
    return rows


def greedy(rows, stored):
    """The sequential rule per keyword, then first of each URL that is not stored: positions."""
    urls, texts, out, taken = set(), set(), [], set(stored)
    for position, keyword, url, title, content, publisher, name, _ in rows:
        if title == "짧음":
            continue
        text = (keyword, title, content, publisher, name)
        if (keyword, url) in urls or text in texts:
            continue
        urls.add((keyword, url)), texts.add(text)
        if url not in taken:
            taken.add(url)
            out.append(position)
    return out


class Feed:
    def __init__(self, spark, tmp_path, stored=()):
        self.spark, self.source = spark, new_path(spark, "feed-in")
        self.articles, self.people = (str(tmp_path / name) for name in ("articles", "people"))
        rows = [(f"s{k}", url, DAY) for k, url in enumerate(stored)] or [("s", "none", DAY)]
        start = spark.createDataFrame(rows, "id string, naver_url string, published_at timestamp")
        tables.append_articles(tables.conform(start, schemas.ARTICLE), self.articles)
        tables.append_journalists(spark.createDataFrame([], schemas.JOURNALIST), self.people)
        self.known, self.pieces = {r[1] for r in rows}, 0

    def arrive(self, rows):
        self.spark.createDataFrame(rows, FEED).coalesce(1).write.parquet(f"{self.source}/piece={self.pieces}")
        self.pieces += 1

    def run(self, checkpoint, **options):
        items = streams.read_files(self.spark, f"{self.source}/*", self.spark.createDataFrame([], FEED).schema, maxFilesPerTrigger=1)
        streams.feed_stream(items, self.articles, self.people, checkpoint, **options).awaitTermination()

    def stored(self):
        table = tables.read_table(self.spark, self.articles).collect()
        return sorted((r.naver_url, r.title) for r in table if r.naver_url not in self.known)


def test_a_feed_in_pieces_gives_what_the_whole_feed_gives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(held_rows.HeldRows.__init__, "__defaults__", (1,))
    rows, state = feed_rows(60, 1), new_path(spark, "state")
    stream = Feed(spark, tmp_path, stored=[f"{BASE}/0", f"{BASE}/5"])
    for at in range(0, 60, 20):
        stream.arrive(rows[at : at + 20])
    stream.run(state)
    expected = greedy(rows, stream.known)
    assert len(expected) > 3 and stream.stored() == sorted((rows[k][2], rows[k][3]) for k in expected)
    people = tables.read_journalists(spark, stream.people).collect()
    table = [r for r in tables.read_table(spark, stream.articles).collect() if r.naver_url not in stream.known]
    assert {r.journalist_id for r in table} == {p.id for p in people} and len(people) == len({(p.name, p.publisher) for p in people})
    assert folders.children(spark, f"{state}/held") == ["full-1", "part-2"]
    # A new checkpoint reads everything again; stored URLs keep it from adding anything.
    stream.run(new_path(spark, "fresh-state"))
    assert stream.stored() == sorted((rows[k][2], rows[k][3]) for k in expected)


def test_a_micro_batch_that_fails_half_way_is_replayed(spark, tmp_path, monkeypatch):
    rows = feed_rows(40, 3)
    stream, state = Feed(spark, tmp_path), new_path(spark, "state")
    stream.arrive(rows[:20])
    stream.run(state)
    stream.arrive(rows[20:])
    write = held_rows.HeldRows.write
    monkeypatch.setattr(held_rows.HeldRows, "write", lambda *_: 1 / 0)
    with pytest.raises(Exception):
        stream.run(state)
    monkeypatch.setattr(held_rows.HeldRows, "write", write)
    stream.run(state)
    expected = greedy(rows, stream.known)
    assert stream.stored() == sorted((rows[k][2], rows[k][3]) for k in expected)


def test_keys_older_than_the_lateness_are_let_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(held_rows.HeldRows.__init__, "__defaults__", (1,))
    title, content = "아홉 글자가 넘는 제목", "본문 " * 60

    def row(position, number, day):
        return (position, "가", f"{BASE}/{number}", title, content, "p", "기자", datetime.datetime(2024, 1, day))

    stream, state = Feed(spark, tmp_path), new_path(spark, "state")
    for rows in ([row(0, 1, 1)], [row(1, 2, 5)], [(2, "가", f"{BASE}/3", title + " 둘", content, "p", "기자", datetime.datetime(2024, 1, 20))], [row(3, 4, 21)]):
        stream.arrive(rows)
        stream.run(state, lateness="10 days")
    # The copy within ten days is dropped, the one after them is not known any more.
    assert [url[-1] for url, _ in stream.stored()] == ["1", "3", "4"]


def test_dedup_after_earlier_rows_equals_the_whole(spark):
    rows = feed_rows(80, 7)
    df = spark.createDataFrame(rows, FEED)
    whole = {r.position for r in dedup.feed_dedup(df, scope=["keyword"]).collect()}
    first = dedup.feed_dedup(df.where("position < 30"), scope=["keyword"])
    second = dedup.feed_dedup(df.where("position >= 30"), scope=["keyword"], earlier=dedup.feed_keys(first, scope=["keyword"]))
    assert {r.position for r in first.collect()} | {r.position for r in second.collect()} == whole


# --- batches that arrive piece by piece ------------------------------------------------------------


def line(number, score=50):
    payload = json.dumps({"clickbait_score": score, "clickbait_explanation": "why"})
    return json.dumps({"custom_id": f"article_{number}", "response": {"body": {"choices": [{"message": {"content": payload}}]}}})


LINES = "batch_id string, pos long, value string"
BATCHES = [("b1", "in_progress", 4), ("b2", "in_progress", 2), ("b3", "in_progress", 3), ("b4", "completed", 1)]


class Results:
    def __init__(self, spark, tmp_path):
        self.spark, self.source = spark, new_path(spark, "lines-in")
        self.table, self.state = str(tmp_path / "articles"), new_path(spark, "state")
        start = spark.range(12).select(F.col("id").cast("string").alias("id"), F.lit(DAY).alias("published_at"))
        tables.append_articles(tables.conform(start, schemas.ARTICLE), self.table)
        self.batches = spark.createDataFrame(BATCHES, "batch_id string, status string, article_count long")
        self.pieces = 0

    def arrive(self, rows, hour=0, state=None):
        self.spark.createDataFrame(rows, LINES).coalesce(1).write.parquet(f"{self.source}/piece={self.pieces}")
        self.pieces += 1
        self.run(hour, state)

    def run(self, hour=0, state=None):
        lines = streams.read_files(self.spark, f"{self.source}/*", self.spark.createDataFrame([], LINES).schema, maxFilesPerTrigger=1)
        now = F.to_timestamp(F.lit(f"2024-02-0{1 + hour // 24} {hour % 24:02d}:00:00"))
        streams.complete_score_stream(
            lines, self.table, self.batches, state or self.state, now, patience="6 hours"
        ).awaitTermination()

    def scores(self):
        return {r.id: r.clickbait_score for r in tables.read_table(self.spark, self.table).where("clickbait_score is not null").collect()}

    def short(self):
        found = self.spark.read.parquet(f"{self.state}/held/short").collect()
        return sorted((r.batch_id, r.expected, r.n_lines) for r in found)

    def waiting(self):
        found = streams.waiting_batches(self.spark, self.state, self.batches).collect()
        return sorted((r.batch_id, r.expected, r.n_lines) for r in found)


def test_a_batch_applies_when_its_last_line_is_there(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(held_rows.HeldRows.__init__, "__defaults__", (2,))
    results = Results(spark, tmp_path)
    results.arrive([("b1", 0, line(0)), ("b1", 1, line(1)), ("b2", 0, line(4, 7)), ("b1", 9, "  "), ("b4", 0, line(11))])
    assert results.scores() == {} and results.waiting() == [("b1", 4, 2), ("b2", 2, 1)]
    results.arrive([("b2", 1, line(5, 8)), ("b1", 1, line(1)), ("b3", 0, line(6))], hour=1)
    assert results.scores() == {"4": 7, "5": 8}
    results.arrive([("b1", 2, line(2))], hour=2)
    results.arrive([("b1", 3, line(3)), ("b2", 1, line(5, 99))], hour=3)
    assert results.scores() == {"4": 7, "5": 8, "0": 50, "1": 50, "2": 50, "3": 50}
    assert results.waiting() == [("b3", 3, 1)]
    results.arrive([("unknown", 0, line(9))], hour=30)
    assert results.short() == [("b3", 3, 1)] and results.waiting() == [("b3", 3, 1), ("unknown", None, 1)]
    # All lines read again under a new checkpoint change nothing.
    results.run(hour=31, state=new_path(spark, "fresh-state"))
    assert results.scores() == {"4": 7, "5": 8, "0": 50, "1": 50, "2": 50, "3": 50}


def test_an_error_in_the_second_half_keeps_the_whole_batch_back(spark, tmp_path):
    results = Results(spark, tmp_path)
    results.arrive([("b1", 0, line(0)), ("b1", 1, line(1)), ("b2", 0, line(4))])
    results.arrive([("b1", 2, line(2, 500)), ("b1", 3, line(3)), ("b2", 1, line(5))], hour=1)
    assert results.scores() == {"4": 50, "5": 50} and results.waiting() == []
    results.arrive([("b1", 2, line(2))], hour=2)
    assert results.scores() == {"4": 50, "5": 50}


def test_held_rows_do_not_see_their_own_part(spark, tmp_path):
    rows = held_rows.HeldRows(spark, str(tmp_path / "held"), spark.createDataFrame([], "k long").schema, parts=3)
    for batch in range(30):
        rows.compact(batch)
        assert {r.k for r in rows.read(batch).collect()} == set(range(batch)) if batch % 10 == 5 else True
        rows.write(spark.range(batch, batch + 1).withColumnRenamed("id", "k").coalesce(1), batch)
        if batch % 10 == 5:
            rows.write(spark.range(batch, batch + 1).withColumnRenamed("id", "k").coalesce(1), batch)
            assert len(folders.children(spark, str(tmp_path / "held"))) <= 5
    assert rows.read(1000).count() == 30
