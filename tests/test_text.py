import html as html_lib
import re
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from presswork.functions import dates, html, text

URLS = [
    "https://n.news.naver.com/mnews/article/001/0014793298?sid=101",
    "https://n.news.naver.com/article/001/0014793298/",
    "https://n.news.naver.com/article/001/0014793298#comment",
    "  HTTPS://N.news.naver.com/article/1 ",
    "http://a.com", "http://a.com/", "http://a.com//", "a.com/x/", "//a.com/x", "/x/y", "x;y?z",
    "http://a.com/x;p=1/y;q=2", "http://a.com/x;p", "mailto:me@a.com", "ht tp://a/b", "1http://a/b",
    "http://a.com?x=/y/", "http://a.com#/y/", "http://a.com/mnews/article/1/mnews/article/2",
    "http://a.com/가/나?다", "foo+bar.baz-1:rest/", ":x", "", "   ", "　http://a.com/x ",
    "custom://h/x;p", "http:/a/b/", "http:a/b", "\thttp://a.com/x\n",
]


def expected_url(url):
    url = url.strip()
    if not url:
        return ""
    parts = urlparse(url)
    path = parts.path.replace("/mnews/article/", "/article/")
    if len(path) > 1 and path[-1] == "/":
        path = path[:-1]
    return (parts.scheme or "https") + "://" + parts.netloc + path


def test_url_rule_matches_urlparse(evaluate):
    once = evaluate(URLS, text.normalize_url(F.col("v")))
    assert once == [expected_url(u) for u in URLS]


def test_url_rule_is_idempotent_on_article_links(evaluate):
    once = evaluate(URLS[:4], text.normalize_url(F.col("v")))
    assert evaluate(once, text.normalize_url(F.col("v"))) == once


def test_null_url_is_empty(evaluate):
    assert evaluate([None], text.normalize_url(F.col("v"))) == [""]


def test_strip_covers_every_space(evaluate):
    values = [chr(i) + " a b " + chr(i) for i in range(1, 0x3002) if chr(i).isspace()]
    assert set(evaluate(values, text.strip(F.col("v")))) == {"a b"}
    assert evaluate(["​a", "﻿a"], text.strip(F.col("v"))) == ["​a", "﻿a"]


@pytest.mark.parametrize(
    "name, publisher, expected",
    [
        ("", "조선일보", ("익명기자_조선일보", "조선일보")),
        ("   ", "조선일보", ("익명기자_조선일보", "조선일보")),
        ("기자", "조선일보", ("익명기자_조선일보", "조선일보")),
        (None, None, ("익명기자_네이버뉴스", "네이버뉴스")),
        ("  홍길동  ", " 조선일보 ", ("홍길동", "조선일보")),
        ("홍", "조", ("익명기자_네이버뉴스", "네이버뉴스")),
    ],
)
def test_journalist_names(spark, name, publisher, expected):
    df = spark.createDataFrame([(name, publisher)], "n string, p string")
    normal = text.normalize_publisher(F.col("p"))
    row = df.select(text.normalize_name(F.col("n"), normal), normal).first()
    assert tuple(row) == expected


def test_content_cleaning(evaluate):
    values = ["\n\n a\n\n\nb \n", "x" * 800, "a\nb", "가" * 701]
    assert evaluate(values, text.clean_content(F.col("v"))) == ["a\nb", "x" * 700, "a\nb", "가" * 700]


def test_entities_are_deleted(evaluate):
    values = ["&lt;b&gt;충격&lt;/b&gt; 제목", "a<b>c</b> &amp d; e", "1 < 2 & 3"]
    assert evaluate(values, text.strip_entities(F.col("v"))) == ["b충격/b 제목", "ac  e", "1 < 2 & 3"]


def test_byline(evaluate):
    values = ["김기자 reporter@example.com", "김철수(a@b.co.kr) 기자", "이영희 인턴기자", "박 PD", "기자", " 최 리포터 "]
    expected = ["김기자", "김철수", "이영희", "박", "기자", "최 리포터"]
    assert evaluate(values, text.clean_byline(F.col("v"))) == expected


def test_keyword_characters(evaluate):
    values = ["충격 SNS!", "日本", "café", "a\\b", "", "ㄱㄴ", "x_y~`[1]{2}", "12% & @#*^$=", "a|b", "<x>"]
    pattern = re.compile(r"[가-힣a-zA-Z0-9\s.,'\"\-+?!/()\[\]{}:;&%@#*^$_=~`\\]+")
    expected = [pattern.fullmatch(v) is not None for v in values]
    assert evaluate(values, text.allowed_keyword(F.col("v"))) == expected


def test_prompt_marks_a_cut_body(spark):
    df = spark.createDataFrame([(" t ", "x" * 701), (None, None)], "t string, c string")
    prompts = [r[0] for r in df.select(text.render_prompt(F.col("t"), F.col("c"), "{title}|{content}")).collect()]
    assert prompts == ["t|" + "x" * 700 + "...", "|"]


def test_cue_words(evaluate):
    values = ["충격! 이것이 충격", "온라인 커뮤니티 화제", "평범한 제목"]
    from presswork import settings

    count = lambda words: evaluate(values, text.cue_count(F.col("v"), words))
    assert count(settings.DEFAULT_KEYWORDS) == [2, 2, 0]
    assert count(settings.SENSATIONAL_WORDS) == [2, 0, 0]
    assert count(settings.VAGUE_PRONOUNS) == [1, 0, 0]


def test_score_bands(evaluate):
    values = [0, 20, 21, 60, 81, 100, None]
    bands = evaluate(values, text.score_band(F.col("v")), "int")
    assert bands == ["0-20", "0-20", "21-40", "41-60", "81-100", "81-100", None]


def test_publication_times(evaluate):
    values = [
        "Mon, 15 Jan 2024 10:30:00 +0900", "15 Jan 2024 23:30:00 +0000", "Mon, 15 Jan 24 10:30:00 +0900",
        "Mon, 15 Jan 2024 10:30:00", "soon", None,
    ]
    local = F.date_format(dates.local_time(dates.parse_rfc822(F.col("v"))), "yyyy-MM-dd HH:mm")
    assert evaluate(values, local) == ["2024-01-15 10:30", "2024-01-16 08:30", None, None, None, None]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Seoul", "America/New_York"])
def test_local_dates_do_not_depend_on_the_session(spark, evaluate, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        instant = F.col("v").cast("timestamp")
        values = ["2024-01-14T14:59:59Z", "2024-01-14T15:00:00Z", "2024-07-15T14:59:59Z"]
        days = evaluate(values, dates.local_date(instant).cast("string"))
        back = evaluate(values, dates.instant_of(dates.local_time(instant)) == instant)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert days == ["2024-01-14", "2024-01-15", "2024-07-15"]
    assert back == [True] * 3


def test_day_window(evaluate):
    values = ["2024-02-29", "2024-05-31", "2024-06-01", "2024-02-28", "2024-13-01", "20240531", None]
    asof = F.lit("2024-05-31").cast("date")
    inside = evaluate(values, dates.in_window(dates.parse_day(F.col("v")), asof))
    assert inside == [True, True, False, False, False, False, False]


PAGE = """<html><body>
<script>var a = '<h2 id="title_area">wrong</h2>';</script><!-- <span class="byline_s">wrong</span> -->
<h2 id="title_area">테스트 뉴스 제목입니다</h2>
<span class="media_end_head_top_logo_text">연합뉴스</span>
<span class="byline_s">김기자 reporter@example.com</span>
<div id="dic_area">
  첫 문장입니다. <div>안쪽 <b>굵은</b></div><style>p{}</style>
  <div><div>둘</div></div> 끝 &amp;lt; &#44032;&#x41;&nbsp;
</div><div>밖</div></body></html>"""


def test_article_page(evaluate):
    page = html.visible_markup(F.col("v"))
    assert evaluate([PAGE], html.extract_title(page)) == ["테스트 뉴스 제목입니다"]
    assert evaluate([PAGE], html.extract_publisher(page)) == ["연합뉴스"]
    assert evaluate([PAGE], html.extract_reporter(page)) == ["김기자"]
    assert evaluate([PAGE], html.extract_content(page)) == ["첫 문장입니다.안쪽굵은둘끝 &lt; 가A"]


def test_rule_order_and_fallbacks(evaluate):
    pages = [
        '<em class="a media_end_linked_more_point b">둘째</em>',
        '<em class="media_end_linked_more_point2">x</em>',
        '<p>none</p>',
        '<em class="media_end_linked_more_point">later</em><span class="media_end_head_top_logo_text"></span>',
    ]
    assert evaluate(pages, html.extract_publisher(F.col("v"))) == ["둘째", "", "", ""]
    bodies = [
        '<div id="dic_area">late</div><article class="x _article_content y">first <b>a</b> b</article>',
        '<div id="newsct_article">one <div>two</div> three</div>four',
        "<section class='se-main-container'> a <p> b </p></section>",
        '<DIV id="newsEndContents">up</DIV>down',
        '<div id="dic_area">open <div>never closed',
    ]
    expected = ["first a b", "one two three", "ab", "up", "opennever closed"]
    assert evaluate(bodies, html.extract_content(F.col("v"))) == expected


def test_reporter_cards(evaluate):
    card = '<div class="media_journalistcard_item_inner"><div>{}</div></div>'
    name = '<em class="media_journalistcard_summary_name_text">{}</em>'
    pages = [
        card.format(name.format("김하나 기자")) + card.format("no name") + card.format(name.format("이둘기자")),
        card.format("no name") + '<span class="byline_s">박셋 기자</span>',
        "<p></p>",
    ]
    assert evaluate(pages, html.reporter_cards(F.col("v"))) == ["김하나,이둘", None, None]
    assert evaluate(pages, html.extract_reporter(F.col("v"))) == ["김하나,이둘", "박셋", ""]


def test_entities_decode_like_the_standard_library(evaluate):
    values = [
        "a &amp; b &lt;p&gt; &quot;q&quot; &#39;s&#39; &#x1F600; &hellip; &copy 24 &zz; AT&T & ; &amp;lt;",
        "plain", "", "&&amp;&", "&Eacute;&eacute;&#0;&#xD800;", "&amp;amp;amp;",
    ]
    expected = [html_lib.unescape(v) for v in values[:4]] + ["Éé&#0;&#xD800;", "&amp;amp;"]
    assert evaluate(values, html.decode_entities(F.col("v"))) == expected


def test_only_old_names_decode_without_semicolon(evaluate):
    values = ["R&And the", "&Re &Im &le &amp_x &ampx", "&copy 24 &amp &lté", "&And; &Re;"]
    expected = [*values[:2], "© 24 & <é", "⩓ ℜ"]
    assert evaluate(values, html.decode_entities(F.col("v"))) == expected
