"""Replacing partitions of a table, and the jobs that write through it."""

import datetime

import pytest
from pyspark.sql import functions as F

from presswork import schemas
from presswork.plans import jobs
from presswork.session import discard, materialise
from presswork.sources import folders, partitions, tables

LONG = "본문 " * 60


def article(number, day, score=None, title="아홉 글자가 넘는 제목입니다", created=1):
    when = datetime.datetime(2024, 1, day, 3) if day else None
    return (f"a{number}", title, LONG, "n", "p", when, f"https://n.news.naver.com/article/1/{number}", score, datetime.datetime(2024, 2, created))


@pytest.fixture
def articles(spark, tmp_path):
    """Four copies over three days and on no day; one day that holds nothing else."""
    rows = [
        article(1, 10, 5), article(2, 11, 90), article(3, 12), article(4, None, 90, created=2),
        article(5, 10, title="another title of its own"), article(6, 11, title="a third title of its own"),
        article(7, 20, title="left alone, far from the others"),
    ]
    kind = "id string, title string, content string, journalist_name string, publisher string, published_at timestamp, naver_url string, clickbait_score int, created_at timestamp"
    path = str(tmp_path / "articles")
    tables.append_articles(tables.conform(spark.createDataFrame(rows, kind), schemas.ARTICLE), path)
    return path


def ids(spark, path):
    return sorted(r.id for r in tables.read_table(spark, path).collect())


KEPT = ["a2", "a5", "a6", "a7"]


def test_losers_are_deleted_from_their_days_only(spark, articles):
    before = folders.children(spark, f"{articles}/local_date=2024-01-20")
    assert jobs.delete_duplicates(spark, articles) == 3
    assert ids(spark, articles) == KEPT
    assert folders.children(spark, f"{articles}/local_date=2024-01-20") == before
    # Days without a row left have no folder; nothing staged stays behind.
    assert folders.children(spark, articles) == ["local_date=2024-01-10", "local_date=2024-01-11", "local_date=2024-01-20"]
    assert folders.children(spark, f"{articles}_changes") == []
    assert jobs.delete_duplicates(spark, articles) == 0 and ids(spark, articles) == KEPT


def _stage(spark, path):
    lost = spark.createDataFrame([("a1",), ("a3",), ("a4",)], "id string")
    days = [datetime.date(2024, 1, 10), datetime.date(2024, 1, 12), None]
    partitions.stage(spark, path, "local_date", days, lambda part: part.join(lost, "id", "left_anti"))


def test_a_run_that_stops_between_the_steps_is_completed(spark, articles):
    _stage(spark, articles)
    assert len(ids(spark, articles)) == 7
    assert jobs.delete_duplicates(spark, articles) == 0
    assert ids(spark, articles) == KEPT


@pytest.mark.parametrize("stop", range(1, 5))
def test_a_run_that_stops_between_two_moves_is_completed(spark, articles, monkeypatch, stop):
    _stage(spark, articles)
    moves, move = [], folders.move

    def stopping(spark, source, target):
        if len(moves) == stop:
            raise KeyboardInterrupt
        moves.append(target)
        move(spark, source, target)

    monkeypatch.setattr(folders, "move", stopping)
    if stop < 4:
        with pytest.raises(KeyboardInterrupt):
            partitions.finish(spark, articles)
    monkeypatch.setattr(folders, "move", move)
    assert partitions.finish(spark, articles) == []
    assert ids(spark, articles) == KEPT


def test_a_stage_without_its_plan_changes_nothing(spark, articles, monkeypatch):
    def stopping(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(folders, "write_text", stopping)
    with pytest.raises(KeyboardInterrupt):
        _stage(spark, articles)
    monkeypatch.undo()
    assert partitions.finish(spark, articles) == [] and len(ids(spark, articles)) == 7
    assert folders.children(spark, f"{articles}_changes") == []


def test_rows_appended_in_between_are_kept(spark, articles):
    _stage(spark, articles)
    extra = spark.createDataFrame([article(8, 10, title="came while others were staged")], "id string, title string, content string, journalist_name string, publisher string, published_at timestamp, naver_url string, clickbait_score int, created_at timestamp")
    tables.append_articles(tables.conform(extra, schemas.ARTICLE), articles)
    assert partitions.finish(spark, articles) == ["local_date=2024-01-10"]
    assert ids(spark, articles) == ["a1", "a2", "a5", "a6", "a7", "a8"]
    assert jobs.delete_duplicates(spark, articles) == 1 and ids(spark, articles) == sorted([*KEPT, "a8"])


def test_an_empty_table_stays_empty(spark, tmp_path):
    path = str(tmp_path / "articles")
    tables.append_articles(tables.conform(spark.createDataFrame([article(1, 10)], "id string, title string, content string, journalist_name string, publisher string, published_at timestamp, naver_url string, clickbait_score int, created_at timestamp"), schemas.ARTICLE), path)
    assert jobs.delete_duplicates(spark, path) == 0 and ids(spark, path) == ["a1"]


def test_statistics_rewrite_only_buckets_that_change(spark, tmp_path):
    path = str(tmp_path / "journalists")
    people = spark.range(40).select(
        F.concat(F.lit("j"), "id").alias("id"), F.lit("n").alias("name"), F.lit("p").alias("publisher"),
        F.when(F.col("id") != 3, F.lit(2)).alias("article_count"), F.lit(50.0).alias("avg_clickbait_score"), F.lit(60).alias("max_score"),
    )
    tables.append_journalists(tables.conform(people, schemas.JOURNALIST), path)
    stored = {name: folders.children(spark, f"{path}/{name}") for name in folders.children(spark, path)}
    scores = [(f"j{k}", s) for k in range(40) for s in (40, 60)] + [("j7", 80), ("nobody", 1)]
    articles = spark.createDataFrame(scores, "journalist_id string, clickbait_score int")
    at = F.to_timestamp(F.lit("2024-06-01 00:00:00"))
    for _ in range(2):
        synced = jobs.sync_statistics(tables.read_journalists(spark, path), articles)
        jobs.save_statistics(path, synced.journalists, at)
        rows = {r.id: r for r in tables.read_journalists(spark, path).collect()}
        assert len(rows) == 40 and set(tables.read_journalists(spark, path).columns) == set(schemas.JOURNALIST.names)
        assert (rows["j7"].article_count, rows["j7"].avg_clickbait_score, rows["j7"].max_score) == (3, 60.0, 80)
        assert rows["j3"].article_count == 2 and rows["j4"].article_count == 2
        assert {i for i, r in rows.items() if r.updated_at is not None} == {"j3", "j7"}
        after = {name: folders.children(spark, f"{path}/{name}") for name in folders.children(spark, path)}
        buckets = {r.bucket for r in tables.with_bucket(spark.createDataFrame([("j3",), ("j7",)], "id string")).collect()}
        assert {name for name in stored if stored[name] != after[name]} == {f"bucket={b}" for b in buckets}


def test_discard_deletes_only_written_tables(spark, tmp_path):
    one, two = materialise(spark.range(5), "one"), materialise(spark.range(3), "two")
    elsewhere = str(tmp_path / "kept" / "table")
    spark.range(4).write.parquet(elsewhere)
    discard(one, spark.read.parquet(elsewhere), materialise(spark.range(0), "none"))
    assert two.count() == 3 and spark.read.parquet(elsewhere).count() == 4
    with pytest.raises(Exception):
        one.collect()


def test_many_days_take_few_listings(spark, tmp_path, monkeypatch):
    """One look at each day before it is moved; what is staged is listed at once."""
    path, days = str(tmp_path / "many"), folders.FEW + 8
    rows = spark.range(days * 2).selectExpr("id", "date'2024-01-01' + cast(id div 2 as int) as local_date")
    rows.hint("rebalance", "local_date").write.partitionBy("local_date").parquet(path)
    looked, children = [], folders.children
    monkeypatch.setattr(folders, "children", lambda spark, path: looked.append(path) or children(spark, path))
    values = [datetime.date(2024, 1, 1) + datetime.timedelta(k) for k in range(days)]
    partitions.replace(spark, path, "local_date", values, lambda part: part.where("id % 2 = 0"))
    left = tables.read_table(spark, path)
    assert sorted(r.id for r in left.collect()) == list(range(0, days * 2, 2)) and len(looked) <= days + 5
    assert left.where(partitions.among("local_date", [*values[:2], None])).count() == 2
    assert left.where(partitions.among("local_date", [])).count() == 0


def test_many_folders_are_listed_with_few_tasks(spark, tmp_path):
    """A task per folder took most of the time of opening a table of many days."""
    path, days = f"{tmp_path}/articles", tables.LISTING_TASKS + 20
    rows = spark.range(days).selectExpr("id", "date'2024-01-01' + cast(id as int) as local_date")
    rows.repartition(1).write.partitionBy("local_date").parquet(path)
    before, tracker = spark.conf.get(tables.LISTING), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "opens a table")
    table = tables.read_table(spark, path)
    spark.sparkContext.setJobGroup("other", "anything else")
    stages = [s for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
    assert 1 < max(tracker.getStageInfo(s).numTasks for s in stages) <= tables.LISTING_TASKS
    assert spark.conf.get(tables.LISTING) == before and table.count() == days
