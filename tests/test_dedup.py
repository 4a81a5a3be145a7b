import random

import pytest
from pyspark.sql import functions as F

from presswork.operators import dedup
from presswork.operators.components import components

COLUMNS = "position long, naver_url string, title string, content string, journalist_name string, publisher string"


def feed_rows(spark, pairs):
    return spark.createDataFrame([(i, u, c, c, "j", "p") for i, (u, c) in enumerate(pairs)], COLUMNS)


def sequential(pairs):
    """The rule as stated: walk the feed and keep a row unless a kept row blocks it."""
    urls, texts, kept = set(), set(), []
    for i, (url, body) in enumerate(pairs):
        if url not in urls and body not in texts:
            kept.append(i)
            urls.add(url)
            texts.add(body)
    return kept


def kept_positions(df):
    return sorted(r.position for r in df.select("position").collect())


@pytest.mark.parametrize("seed, hot_rows", [(1, 1_000_000), (2, 2), (3, 5)])
def test_feed_dedup_equals_the_sequential_rule(spark, seed, hot_rows):
    rng = random.Random(seed)
    pairs = []
    for _ in range(400):
        url = "u-hot" if rng.random() < 0.33 else f"u{rng.randrange(120)}"
        body = "c-hot" if rng.random() < 0.2 else f"c{rng.randrange(150)}"
        pairs.append((url, body))
    kept = dedup.feed_dedup(feed_rows(spark, pairs), hot_rows=hot_rows)
    assert kept_positions(kept) == sequential(pairs)


def test_feed_dedup_on_a_chain(spark):
    pairs = [(f"u{i // 2}", f"c{(i + 1) // 2}") for i in range(12)]
    assert kept_positions(dedup.feed_dedup(feed_rows(spark, pairs))) == sequential(pairs)


def chain(rows):
    """Neighbours share a URL or a content in turn; the order of the feed is shuffled."""
    pairs = [(f"u{i // 2}", f"c{(i + 1) // 2}") for i in range(rows)]
    random.Random(7).shuffle(pairs)
    return pairs


@pytest.mark.parametrize("shuffled", [False, True])
def test_feed_dedup_on_a_long_chain_takes_few_jobs(spark, shuffled):
    pairs = chain(10_000) if shuffled else [(f"u{i // 2}", f"c{(i + 1) // 2}") for i in range(10_000)]
    group = f"chain-{shuffled}"
    spark.sparkContext.setJobGroup(group, group)
    kept = kept_positions(dedup.feed_dedup(feed_rows(spark, pairs)))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert kept == sequential(pairs)
    assert jobs < 400


@pytest.mark.parametrize("solve_rows", [1, 7, 1_000])
def test_feed_dedup_with_components_of_every_size(spark, solve_rows):
    rng = random.Random(9)
    pairs = [(f"u{rng.randrange(90)}", f"c{rng.randrange(110)}") for _ in range(160)] + chain(40)
    kept = dedup.feed_dedup(feed_rows(spark, pairs), plain_rounds=1, solve_rows=solve_rows)
    assert kept_positions(kept) == sequential(pairs)


def test_components_of_shared_keys(spark):
    rng = random.Random(3)
    rows = [(i, f"a{rng.randrange(150)}", f"b{rng.randrange(150)}" if i % 5 else None) for i in range(160)]
    part = {i: i for i, _, _ in rows}
    for _ in rows:
        for key in (1, 2):
            least = {}
            for r in rows:
                least[r[key]] = min(least.get(r[key], part[r[0]]), part[r[0]])
            part = {r[0]: part[r[0]] if r[key] is None else least[r[key]] for r in rows}
    df = spark.createDataFrame(rows, "id long, a string, b string")
    assert {r.id: r.part for r in components(df, "id", ["a", "b"]).collect()} == part
    assert components(df.limit(0), "id", ["a", "b"]).count() == 0


def test_feed_dedup_small_cases(spark):
    assert kept_positions(dedup.feed_dedup(feed_rows(spark, [("A", "1"), ("A", "2"), ("B", "3")]))) == [0, 2]
    assert kept_positions(dedup.feed_dedup(feed_rows(spark, []).limit(0))) == []


def test_feed_dedup_per_scope(spark):
    pairs = [("A", "1"), ("A", "2"), ("A", "1"), ("A", "3")]
    df = feed_rows(spark, pairs).withColumn("keyword", F.when(F.col("position") < 2, "x").otherwise("y"))
    assert kept_positions(dedup.feed_dedup(df, scope=["keyword"])) == [0, 2]


@pytest.fixture(scope="module")
def stored(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        body = "hot" if i % 3 == 0 else f"c{rng.randrange(80)}"
        name = None if body == "c1" else "j"
        score = rng.choice([None, 0, 10, 10, 90])
        rows.append((i, f"u{rng.randrange(200)}", "t", body, name, "p", score, rng.randrange(5)))
    return spark.createDataFrame(
        rows, COLUMNS.replace("position", "id") + ", clickbait_score int, created_at int"
    ).cache()


def best_first(stored):
    groups = {}
    for r in stored.collect():
        groups.setdefault((r.title, r.content, r.journalist_name, r.publisher), []).append(r)
    for members in groups.values():
        members.sort(key=lambda r: (-(r.clickbait_score or 0), r.created_at, r.id))
    return list(groups.values())


def test_merge_keeps_the_best_row_of_each_group(spark, stored):
    groups = best_first(stored)
    kept = sorted(r.id for r in dedup.survivors(stored).select("id").collect())
    gone = sorted(r.id for r in dedup.losers(stored).select("id").collect())
    assert kept == sorted(g[0].id for g in groups)
    assert sorted(kept + gone) == list(range(300))
    totals = dedup.merge_totals(stored).first()
    assert totals.groups == sum(len(g) > 1 for g in groups)
    assert totals.deleted == len(gone)


def test_group_rows_and_members(spark, stored):
    groups = [g for g in best_first(stored) if len(g) > 1]
    found = {r.kept_id: (r.duplicate_count, r.kept_score) for r in dedup.duplicate_groups(stored).collect()}
    assert found == {g[0].id: (len(g), g[0].clickbait_score or 0) for g in groups}
    members = dedup.group_members(stored, hot_rows=10, partitions=5).collect()
    assert {r.id: r["rank"] for r in members} == {r.id: i + 1 for g in groups for i, r in enumerate(g)}


def test_null_score_counts_as_zero_and_age_decides(spark):
    rows = [(1, "a", "t", "c", "j", "p", 0, 2), (2, "b", "t", "c", "j", "p", None, 1)]
    df = spark.createDataFrame(
        rows, COLUMNS.replace("position", "id") + ", clickbait_score int, created_at int"
    )
    assert [r.id for r in dedup.survivors(df).collect()] == [2]


@pytest.mark.parametrize("hot_rows", [3, 1_000_000])
def test_links_form_stars(spark, stored, hot_rows):
    rows = stored.collect()
    expected = {}
    for r in rows:
        first_url = min(x.id for x in rows if x.naver_url == r.naver_url)
        key = lambda x: (x.title, x.content, x.journalist_name, x.publisher)
        first_text = min(x.id for x in rows if key(x) == key(r))
        if first_url != r.id:
            expected.setdefault((r.id, first_url), [False, False])[0] = True
        if first_text != r.id:
            expected.setdefault((r.id, first_text), [False, False])[1] = True
    links = dedup.duplicate_links(stored, hot_rows).collect()
    assert {(r.id, r.first_id): [r.same_url, r.same_content] for r in links} == expected


def test_pair_predicate(spark):
    df = feed_rows(spark, [("A", "1"), ("A", "2"), ("B", "2"), ("C", "3")])
    pairs = df.alias("a").join(df.alias("b"), dedup.is_duplicate("a", "b") & F.expr("a.position < b.position"))
    found = pairs.select("a.position", "b.position").collect()
    assert sorted(tuple(r) for r in found) == [(0, 1), (1, 2)]


def test_url_flags(spark):
    urls = ["https://n.news.naver.com/mnews/article/1/1?x=1", "https://n.news.naver.com/article/1/2", "http://a/3"]
    asked = spark.createDataFrame([(u,) for u in urls], "url string")
    known = spark.createDataFrame(
        [("https://n.news.naver.com/article/1/1",), ("https://n.news.naver.com/article/1/2",)], "naver_url string"
    )
    flags = {r.url: r.exists for r in dedup.url_flags(asked, known, hot_rows=1).collect()}
    assert flags == {urls[0]: True, urls[1]: True, urls[2]: False}
    assert dedup.url_flags(asked.limit(0), known).count() == 0


def test_insert_outcomes(spark):
    df = feed_rows(spark, [("A", "1"), ("B", "2"), ("A", "3"), ("S", "4"), ("S", "5")])
    known = spark.createDataFrame([("S",)], "naver_url string")
    outcome = {r.position: r.outcome for r in dedup.insert_outcomes(df, known).collect()}
    assert outcome == {0: "inserted", 1: "inserted", 2: "repeat", 3: "stored", 4: "repeat"}
