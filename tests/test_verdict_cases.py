import datetime
import json

from pyspark.sql import functions as F

from presswork.functions import html, records, text, validation
from presswork.operators import dedup, skew, stats
from presswork.sources import jsonl

GOOD = '{"clickbait_score": 5, "clickbait_explanation": "e"}'


def test_nothing_may_follow_a_json_text(evaluate):
    tails = ["", " ", "] x", "],[1", ", 1", "],[1]", "]", " 7", "}"]
    found = evaluate([GOOD + tail for tail in tails] + ["", None], validation.validate_payload(F.col("v")))
    assert [row is not None for row in found] == [True, True] + [False] * 9


def test_blank_lines_of_any_white_space_are_skipped(spark):
    lines = spark.createDataFrame([(GOOD,), ("\t",), (" \u00a0\r",), ("{}] x",)], "value string")
    assert sorted(r.malformed for r in jsonl.parse_result_lines(lines).collect()) == [False, True]


def test_copy_without_time_does_not_survive(spark):
    rows = [(1, None), (2, datetime.datetime(2024, 1, 2)), (3, datetime.datetime(2024, 1, 3)), (9, None)]
    df = spark.createDataFrame(
        [(i, t, "t", "c", "j" if i < 9 else "k", "p", "u", 5) for i, t in rows],
        "id int, created_at timestamp, title string, content string, journalist_name string, publisher string, "
        "naver_url string, clickbait_score int",
    )
    assert sorted(r.id for r in dedup.survivors(df).collect()) == [2, 9]
    assert sorted(r.id for r in dedup.losers(df).collect()) == [1, 3]
    assert {r.id: r["rank"] for r in dedup.group_members(df).collect()} == {2: 1, 3: 2, 1: 3}


def test_null_keys_keep_their_rows(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), ("x", 3, "c")], "k string, o int, s string")
    lagged = {r.o: r.before for r in skew.lag_in_group(df, ["k"], ["o"], "s", "before").collect()}
    assert lagged == {1: None, 2: "a", 3: None}
    assert {r.o: r["rank"] for r in skew.rank_in_group(df, ["k"], ["o"]).collect()} == {1: 1, 2: 2, 3: 1}


def test_null_scope_is_deduplicated(spark):
    rows = [(0, None, "u", "a"), (1, None, "u", "b"), (2, "k", "u", "c"), (3, None, None, "d"), (4, None, None, "e"), (5, None, "w", "a")]
    df = spark.createDataFrame(
        [(i, k, u, t, "c", "j", "p") for i, k, u, t in rows],
        "position int, keyword string, naver_url string, title string, content string, journalist_name string, publisher string",
    )
    assert sorted(r.position for r in dedup.feed_dedup(df, scope=["keyword"]).collect()) == [0, 2, 3, 4]


def test_statistics_never_stored_count_as_zero(spark):
    people = spark.createDataFrame([("a", None, None, None), ("b", None, 0.0, 0)], "id string, article_count long, avg_clickbait_score double, max_score int")
    articles = spark.createDataFrame([("a", 50)], "journalist_id string, clickbait_score int")
    audited = {r.id: r.inconsistent for r in stats.audit(people, articles).collect()}
    assert audited == {"a": True, "b": False}
    assert stats.repair(stats.audit(people, articles)).where("id = 'a'").first().article_count == 1


def test_record_has_local_time_and_null_ids(spark):
    df = spark.sql(
        "select 't' title, 'c' content, cast(null as string) journalist_id, 'n' journalist_name, 'p' publisher, "
        "timestamp'2024-01-15 01:30:00.25' published_at, 'u' naver_url, s clickbait_score, cast(null as string) clickbait_explanation "
        "from values (5), (null) as t(s)"
    )
    found = [json.loads(r[0]) for r in df.select(records.article_record()).collect()]
    assert {r["published_at"] for r in found} == {"2024-01-15T10:30:00.250000+09:00"} and all(r["journalist_id"] is None for r in found)
    assert sorted(len(r) for r in found) == [7, 8]


def test_cuts_can_be_turned_off(evaluate):
    long = "x" * 3000
    assert evaluate([long], text.clean_content(F.col("v"), None)) == [long]
    assert evaluate([long], text.render_prompt(F.lit("t"), F.col("v"), "{content}", None)) == [long]
    assert evaluate([f'<div id="dic_area">{long}</div>'], html.extract_content(F.col("v"), limit=None)) == [long]
    assert evaluate([long], validation.cleansed_update(F.lit(5), F.col("v"), None)["explanation"]) == [long]


def test_padded_references(evaluate):
    texts = ["&#x00000041;", "&#0000000065;", "&#x110000;", "&#0;", "&#99999999999;"]
    assert evaluate(texts, html.decode_entities(F.col("v"))) == ["A", "A", *texts[2:]]
