import json

import pytest
from pyspark.sql import functions as F

from presswork.operators import scoring
from presswork.sources import jsonl, responses


def line(article, score=50, text="why", **changes):
    answer = json.dumps({"clickbait_score": score, "clickbait_explanation": text})
    result = {
        "custom_id": f"article_{article}",
        "response": {"body": {"choices": [{"message": {"content": answer}}]}},
    }
    return json.dumps({**result, **changes})


def lines(spark, rows):
    data = [(batch, i, value) for i, (batch, value) in enumerate(rows)]
    return jsonl.parse_result_lines(spark.createDataFrame(data, "batch_id string, pos int, value string"))


def test_errors_of_each_kind(spark):
    body = lambda choices: {"response": {"body": {"choices": choices}}}
    rows = [
        line("1"), "oops", line("2") + " x", "", "  ", line("3", custom_id="art_3"), line("4", **body([])),
        line("5", response={}), line("6", **body([{"message": {"content": ""}}])), line("7", score=101), "123",
        line("8", **body([{"message": {}}])), line("article_9"),
    ]
    parsed = scoring.parse_results(lines(spark, [("b", r) for r in rows])).orderBy("pos").collect()
    assert [r.error for r in parsed] == [
        None, "malformed", "malformed", "custom_id", "no_choices", "no_choices", "empty_content", "payload",
        "custom_id", "empty_content", None,
    ]
    assert parsed[0].article_id == "1" and parsed[-1].article_id == "9"


def test_one_bad_line_fails_its_batch_only(spark):
    rows = [("good", line("1")), ("good", "oops"), ("bad", line("2")), ("bad", line("3", score=200)), ("empty", "oops")]
    parsed = scoring.parse_results(lines(spark, rows))
    verdicts = {r.batch_id: r for r in scoring.batch_verdicts(parsed).collect()}
    assert {k: v.applicable for k, v in verdicts.items()} == {"good": True, "bad": False, "empty": False}
    assert verdicts["bad"].first_error == "payload" and verdicts["good"].n_malformed == 1
    for hot_rows in (1, 1_000_000):
        kept = scoring.strict_updates(parsed, hot_rows=hot_rows)
        assert [r.article_id for r in kept.collect()] == ["1"]


def test_last_line_wins_within_a_batch_and_first_batch_across(spark):
    rows = [("b1", line("1", 10)), ("b1", line("1", 20)), ("b2", line("1", 30)), ("b2", line("2", 40))]
    updates = scoring.one_update_per_article(scoring.strict_updates(scoring.parse_results(lines(spark, rows))))
    assert {r.article_id: r.score for r in updates.collect()} == {"1": 20, "2": 40}
    batches = spark.createDataFrame([("b1", 5), ("b2", 4)], "batch_id string, created_at int")
    strict = scoring.strict_updates(scoring.parse_results(lines(spark, rows)))
    for hot_rows in (1, 1_000_000):
        aged = scoring.one_update_per_article(strict, batches, hot_rows)
        assert {r.article_id: r.score for r in aged.collect()} == {"1": 30, "2": 40}


ARTICLE = "id string, title string, clickbait_score int, clickbait_explanation string, updated_at timestamp_ntz"


def test_applying_twice_changes_nothing(spark):
    articles = spark.createDataFrame(
        [("1", "a", None, None, None), ("2", "b", 5, "old", None), ("3", "c", None, None, None)], ARTICLE
    )
    updates = spark.createDataFrame(
        [("1", 70, "x"), ("2", 80, "y"), ("9", 90, "z")], "article_id string, score int, explanation string"
    )
    asof = F.expr("timestamp_ntz'2024-06-01 00:00:00'")
    once = scoring.apply_scores(articles, updates, asof)
    assert once.schema == articles.schema or [f.dataType for f in once.schema] == [f.dataType for f in articles.schema]
    assert {r.id: (r.clickbait_score, r.clickbait_explanation) for r in once.collect()} == {
        "1": (70, "x"), "2": (5, "old"), "3": (None, None),
    }
    again = scoring.apply_scores(once, updates, F.expr("timestamp_ntz'2025-01-01 00:00:00'"))
    assert sorted(map(str, again.collect())) == sorted(map(str, once.collect()))
    assert {r.article_id for r in scoring.not_yet_scored(updates, articles).collect()} == {"1", "9"}
    assert {r.article_id for r in scoring.not_yet_scored(updates, once).collect()} == {"9"}
    assert [r.article_id for r in scoring.unmatched(updates, articles).collect()] == ["9"]


def test_completed_batches_are_skipped(spark):
    rows = lines(spark, [("b1", line("1")), ("b2", line("2")), ("b3", line("3"))])
    batches = spark.createDataFrame([("b1", "completed"), ("b2", "failed")], "batch_id string, status string")
    for hot_rows in (1, 1_000_000):
        kept = scoring.skip_completed(rows, batches, hot_rows=hot_rows)
        assert sorted(r.batch_id for r in kept.collect()) == ["b2", "b3"]


def test_batch_size_limits(spark):
    articles = spark.createDataFrame([(i, i % 4, None) for i in range(25)], "id int, created_at int, clickbait_score int")
    numbered = {r.id: r.batch_no for r in scoring.number_batches(articles, 10, partitions=3).collect()}
    ordered = sorted(range(25), key=lambda i: (i % 4, i))
    assert numbered == {i: n // 10 for n, i in enumerate(ordered)}
    assert [r.id for r in scoring.oldest_pending(articles, 3).collect()] == ordered[:3]
    for size in (0, 801):
        with pytest.raises(ValueError):
            scoring.number_batches(articles, size)


def test_request_files(spark, tmp_path):
    articles = spark.createDataFrame([(1, "제목", "본문 \"q\"", 0), (2, "t", "c", 1)], "id int, title string, content string, batch_no long")
    path = str(tmp_path / "requests")
    jsonl.write_requests(scoring.build_requests(articles), path)
    read = {r.batch_no: json.loads(r.value) for r in spark.read.text(path).collect()}
    request = read[0]
    assert request["custom_id"] == "article_1" and request["method"] == "POST"
    assert [m["role"] for m in request["body"]["messages"]] == ["system", "user"]
    assert '본문 "q"' in request["body"]["messages"][1]["content"]
    schema = request["body"]["response_format"]["json_schema"]
    assert schema["strict"] is True and schema["schema"]["required"] == ["clickbait_score", "clickbait_explanation"]
    assert schema["schema"]["properties"]["clickbait_score"]["maximum"] == 100
    assert schema["schema"]["additionalProperties"] is False


def test_result_files_keep_line_order(spark, tmp_path):
    folder = tmp_path / "results" / "batch_id=b1"
    folder.mkdir(parents=True)
    (folder / "out.jsonl").write_text("\n".join([line("1", 10), "", "oops", line("1", 20)]) + "\n")
    read = jsonl.parse_result_lines(jsonl.read_result_lines(spark, str(tmp_path / "results")))
    updates = scoring.one_update_per_article(scoring.strict_updates(scoring.parse_results(read)))
    assert [tuple(r) for r in updates.collect()] == [("1", 20, "why")]


def test_response_files(spark, tmp_path):
    search = tmp_path / "search.json"
    search.write_text(json.dumps({"items": [{"title": "a", "link": "l"}, {"title": "b"}]}) + "\n" + json.dumps({"total": 0}))
    items = responses.explode_items(responses.read_search_responses(spark, str(search)))
    assert [(r.item_pos, r.title, r.link) for r in items.orderBy("item_pos").collect()] == [(0, "a", "l"), (1, "b", None)]
    trend = tmp_path / "trend.json"
    queries = [{"query": "하나"}, {"other": 1}, {"query": "日本"}] + [{"query": f"q{i}"} for i in range(6)]
    trend.write_text(json.dumps({"trending_searches": queries}))
    ranked = responses.trend_keywords(responses.read_trend_responses(spark, str(trend)))
    assert [r.keyword for r in ranked.orderBy("rank").collect()] == ["하나", "q0", "q1", "q2", "q3"]


def test_status_changes(spark):
    steps = ["in_progress", "in_progress", "failed", "in_progress", "completed", "failed", "cancelled", "cancelled"]
    log = spark.createDataFrame([(i, "b", i, s) for i, s in enumerate(steps)], "event_id int, batch_id string, ts int, status string")
    audited = scoring.audit_status_changes(log, partitions=3).orderBy("event_id").collect()
    assert [r.verdict for r in audited] == [
        "first", "unchanged", "valid", "valid", "valid", "invalid", "invalid", "unchanged",
    ]


def test_batches(spark):
    rows = [("a", "in_progress", 2), ("b", "completed", 1), ("c", "in_progress", 1), ("d", "cancelled", 0), ("e", "failed", 0)]
    batches = spark.createDataFrame(rows, "batch_id string, status string, created_at int")
    assert [r.batch_id for r in scoring.active_batches(batches).collect()] == ["c", "a"]
    assert scoring.oldest_active(batches).first().batch_id == "c"
    assert scoring.any_active(batches).first().any_active is True
    assert scoring.any_active(batches.limit(0)).first().any_active is False
    assert tuple(scoring.batch_rollup(batches).first()) == (5, 1, 2, 2)
    remote = spark.createDataFrame([("a", "completed", 1), ("x", "completed", 2)], "batch_id string, status string, article_count int")
    orphan = scoring.orphan_batches(remote, batches).collect()
    assert [(r.batch_id, r.status, r.recovered) for r in orphan] == [("x", "completed", True)]

