import random

import pytest

from presswork.operators import stats


def articles(spark, scores):
    return spark.createDataFrame(scores, "journalist_id string, clickbait_score int")


def people(spark, rows):
    schema = "id string, name string, publisher string, article_count long, avg_clickbait_score double, max_score int"
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize(
    "scores, expected",
    [
        ([90, 80, 70, 60, 50], (5, 70.0, 90)),
        (list(range(95, 20, -5)), (15, 72.5, 95)),
        (list(range(95, 50, -5)) + [None] * 3, (12, 75.0, 95)),
        ([None, None], (2, 0.0, 0)),
        ([50] * 9 + [49] * 9, (18, 49.9, 50)),
        ([73, 72, 72, 72, 72, 72, 72, 72], (8, 72.12, 73)),
        ([0, 0], (2, 0.0, 0)),
    ],
)
def test_top_ten_mean(spark, scores, expected):
    row = stats.journalist_statistics(articles(spark, [("a", s) for s in scores])).first()
    assert tuple(row)[1:] == expected


def test_statistics_against_plain_python(spark):
    rng = random.Random(3)
    rows = [(("hot" if i % 3 == 0 else f"j{rng.randrange(20)}"), rng.choice([None, *range(101)])) for i in range(900)]
    groups = {}
    for key, score in rows:
        groups.setdefault(key, []).append(score)
    for row in stats.score_statistics(articles(spark, rows)).collect():
        scored = sorted((s for s in groups[row.journalist_id] if s is not None), reverse=True)
        top = scored[:10]
        assert row.article_count == len(groups[row.journalist_id])
        assert row.avg_clickbait_score == round(sum(top) / len(top), 2)
        assert row.mean_score == pytest.approx(sum(scored) / len(scored))
        assert row.max_score == scored[0]


def test_audit_and_repair(spark):
    journalists = people(
        spark,
        [("ok", "a", "p", 2, 50.0, 75), ("low", "b", "p", 1, 30.0, 50), ("gone", "c", "p", 3, 1.0, 1), ("new", "d", "p", 0, 0.0, 0)],
    )
    scores = articles(spark, [("ok", 25), ("ok", 75), ("low", 25), ("low", 75)])
    audited = stats.audit(journalists, scores)
    assert {r.id for r in audited.where("inconsistent").collect()} == {"low", "gone"}
    repaired = stats.repair(audited)
    assert tuple(stats.repair_totals(repaired).first()) == (1, 2, 4)
    fixed = {r.id: (r.article_count, r.avg_clickbait_score, r.max_score) for r in repaired.collect()}
    assert fixed["low"] == (2, 50.0, 75) and fixed["gone"] == (3, 1.0, 1)
    assert [f.dataType for f in repaired.select(journalists.columns).schema] == [f.dataType for f in journalists.schema]


def test_two_audit_modes_differ_beyond_ten_scores(spark):
    scores = articles(spark, [("a", s) for s in range(95, 20, -5)])
    stored = people(spark, [("a", "n", "p", 15, 72.5, 95)])
    assert stats.audit(stored, scores, "full_mean").where("inconsistent").count() == 1
    assert stats.audit(stored, scores, "top10").where("inconsistent").count() == 0


def test_full_update_and_summary(spark):
    journalists = people(spark, [("a", "n", "p", 0, 0.0, 0), ("b", "m", "p", 7, 3.0, 9)])
    scores = articles(spark, [("a", 40), ("a", None)])
    refreshed = stats.all_journalist_statistics(journalists, scores)
    assert tuple(stats.update_totals(refreshed).first()) == (1, 1, 2)
    before, after = stats.summary(journalists, scores), stats.summary(refreshed, scores)
    assert tuple(before.first()) == (2, 1, 1, 2, 1, 1)
    assert tuple(after.first()) == (2, 2, 2, 2, 1, 1)
    changes = {r.counter: r.change for r in stats.deltas(before, after).collect()}
    assert changes["active_journalists"] == 1 and changes["total_articles"] == 0


def test_empty_tables(spark):
    none, nobody = articles(spark, []), people(spark, [])
    assert stats.journalist_statistics(none).count() == 0
    assert tuple(stats.repair_totals(stats.repair(stats.audit(nobody, none))).first()) == (0, 0, 0)
    assert tuple(stats.summary(nobody, none).first()) == (0,) * 6


def test_publisher_statistics(spark):
    df = spark.createDataFrame([("p", 10), ("p", 15), ("p", None), ("q", None)], "publisher string, clickbait_score int")
    rows = {r.publisher: tuple(r)[1:] for r in stats.publisher_statistics(df).collect()}
    assert rows == {"p": (3, 2, 12.5, 15), "q": (1, 0, None, None)}
