import datetime

from pyspark.sql import functions as F

from presswork.functions import validation

TITLE, BODY = "이것은 유효한 제목입니다", "가" * 100
URL = "https://n.news.naver.com/article/023/0003123456"


def reasons(spark, rows):
    df = spark.createDataFrame(list(rows), "t string, c string, u string, s int")
    check = validation.article_reject_reason(F.col("t"), F.col("c"), F.col("u"), F.col("s"))
    return [r[0] for r in df.select(check).collect()]


def test_article_checks_in_order(spark):
    rows = [
        (TITLE, BODY, URL, 75), (TITLE, BODY, URL, None), (TITLE, BODY, "https://m.entertain.naver.com/1", 0),
        ("짧은제목", BODY, URL, None), ("짧은제목", "짧은내용", "x", 101), (TITLE, "짧은내용", URL, None),
        (TITLE, BODY, "https://invalid-url.com", None), (TITLE, BODY, URL, 101), (TITLE, BODY, URL, -1),
        ("  정확히아홉자제목임  ", " " + BODY + " ", URL, 100), (None, BODY, URL, 1), (TITLE, BODY, None, 1),
    ]
    expected = [None, None, None, "title", "title", "content", "url", "score", "score", None, "title", "url"]
    assert reasons(spark, rows) == expected


def test_journalist_checks(spark):
    df = spark.createDataFrame([("홍길동", "조선일보"), ("홍", "조선일보"), ("홍길동", "조")], "n string, p string")
    check = validation.journalist_reject_reason(F.col("n"), F.col("p"))
    assert [r[0] for r in df.select(check).collect()] == [None, "name", "publisher"]


def test_padding(spark):
    rows = [("a" * 100, "d"), ("a" * 60, "d" * 39), ("a" * 60, "d" * 38)]
    df = spark.createDataFrame(rows, "c string, d string")
    padded = [r[0] for r in df.select(validation.padded_content(F.col("c"), F.col("d"))).collect()]
    assert padded == ["a" * 100, "a" * 60 + " " + "d" * 39, None]


def payload(score, text='"why"'):
    return '{"clickbait_score": %s, "clickbait_explanation": %s}' % (score, text)


def test_payloads(evaluate):
    good = [payload(75), payload(0), payload(100), payload(75, '" why "'), payload(75)[:-1] + ', "x": 1}']
    bad = [
        "not json", "", None, '{"clickbait_score": 75}', '{"clickbait_explanation": "x"}', payload(150), payload(-1),
        payload("true"), payload("75.0"), payload('"75"'), payload("null"), payload(75, '"  "'), payload(75, "5"),
        payload(75, "null"), payload(75) + " tail", payload(75) + payload(75), "[" + payload(75) + "]", "75",
        payload(75) + "," + payload(75), payload("99999999999999999999"),
    ]
    read = evaluate(good + bad, validation.validate_payload(F.col("v")))
    assert [tuple(r) for r in read[:5]] == [(75, "why"), (0, "why"), (100, "why"), (75, "why"), (75, "why")]
    assert read[5:] == [None] * len(bad)


def test_update_cleansing(spark):
    rows = [(72.5, " e "), (73.5, None), (100.4, "e"), (-0.1, "e"), (None, "e"), (50.0, "x" * 600), (99.6, "  ")]
    df = spark.createDataFrame(rows, "s double, e string")
    clean = [r[0] for r in df.select(validation.cleansed_update(F.col("s"), F.col("e"))).collect()]
    default = "자동 생성된 점수"
    assert [c and tuple(c) for c in clean] == [
        (72, "e"), (74, default), None, None, None, (50, "x" * 500), (100, default),
    ]


def test_record_leaves_out_missing_scores(spark):
    import json

    from presswork.functions.records import article_record

    when = datetime.datetime(2024, 1, 15, 1, 30)
    rows = [("t", "c", None, "n", "p", when, URL, 75, None)]
    schema = (
        "title string, content string, journalist_id string, journalist_name string, publisher string, "
        "published_at timestamp_ntz, naver_url string, clickbait_score int, clickbait_explanation string"
    )
    record = json.loads(spark.createDataFrame(rows, schema).select(article_record()).first()[0])
    assert record["clickbait_score"] == 75 and "clickbait_explanation" not in record
    assert record["published_at"] == "2024-01-15T10:30:00+09:00"
