"""The query catalogue: one Spark query per operator, next to the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import astuple
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork import schemas
from presswork import settings as S
from presswork.functions import dates, html, records, text, validation
from presswork.operators import dedup, feed, journalists, keywords, scoring, stats
from presswork.plans import bindings as B
from presswork.plans import jobs
from presswork.plans.bindings import sql_clean, sql_strip
from presswork.session import materialise, new_path
from presswork.sources import jsonl, responses, tables, url_index
from presswork.streaming import jobs as streams

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

FEED_DAY = date(2024, 2, 29)
ASOF = date(2024, 2, 29)
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its oracle SQL if there is one."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


# --- statistics ---------------------------------------------------------------------------------


@query(f"WITH {B.STATS} SELECT journalist_id, article_count, avg_clickbait_score, max_score FROM stats")
def journalist_stats(spark, sf):
    return stats.journalist_statistics(B.scores(spark, sf))


@query(
    f"""WITH {B.STORED} SELECT count(*) FILTER (WHERE actual_count > 0) AS success,
    count(*) FILTER (WHERE actual_count = 0) AS failed, count(*) AS total FROM audited"""
)
def journalist_stats_all(spark, sf):
    people, articles = B.stored_journalists(spark, sf), B.scores(spark, sf)
    return stats.update_totals(stats.all_journalist_statistics(people, articles))


@query(
    f"""WITH {B.STORED} SELECT
    (SELECT count(*) FROM stored) AS total_journalists,
    (SELECT count(*) FROM stored WHERE article_count > 0) AS active_journalists,
    (SELECT count(*) FROM stored WHERE avg_clickbait_score > 0) AS scored_journalists,
    (SELECT count(*) FROM ev) AS total_articles,
    (SELECT count(clickbait_score) FROM ev) AS scored_articles,
    (SELECT count(*) FROM ev WHERE clickbait_score IS NULL) AS pending_articles"""
)
def stats_summary(spark, sf):
    return stats.summary(B.stored_journalists(spark, sf), B.scores(spark, sf))


_AUDIT_COLUMNS = [
    "id", "name", "publisher", "article_count", "avg_clickbait_score", "max_score",
    "actual_count", "actual_avg", "actual_max",
]


def _audit_sql(actual: str) -> str:
    return f"""WITH {B.STORED} SELECT id, name, publisher, article_count, avg_clickbait_score,
    max_score, actual_count, {actual} AS actual_avg, actual_max FROM audited
    WHERE other_mismatch OR abs(avg_clickbait_score - {actual}) > 0.01"""


def _inconsistent(spark, sf, mode):
    audited = stats.audit(B.stored_journalists(spark, sf), B.scores(spark, sf), mode)
    return audited.where("inconsistent").select(*_AUDIT_COLUMNS)


@query(_audit_sql("actual_avg"))
def stats_inconsistent(spark, sf):
    return _inconsistent(spark, sf, "full_mean")


@query(_audit_sql("top_avg"))
def stats_inconsistent_top10(spark, sf):
    return _inconsistent(spark, sf, "top10")


@query(
    f"""WITH {B.STORED}, flags AS (SELECT *,
      other_mismatch OR abs(avg_clickbait_score - actual_avg) > 0.01 AS flagged FROM audited)
    SELECT count(*) FILTER (WHERE flagged AND actual_count > 0) AS fixed,
      count(*) FILTER (WHERE flagged) AS total_inconsistent, count(*) AS total_checked FROM flags"""
)
def stats_fix(spark, sf):
    audited = stats.audit(B.stored_journalists(spark, sf), B.scores(spark, sf))
    return stats.repair_totals(stats.repair(audited))


@query(
    f"""WITH {B.STORED}, flags AS (SELECT *,
      other_mismatch OR abs(avg_clickbait_score - actual_avg) > 0.01 AS flagged FROM audited)
    SELECT id, flagged AND actual_count > 0 AS updated,
      CASE WHEN flagged AND actual_count > 0 THEN actual_count ELSE article_count END AS article_count,
      CASE WHEN flagged AND actual_count > 0 THEN top_avg ELSE avg_clickbait_score END
        AS avg_clickbait_score,
      CASE WHEN flagged AND actual_count > 0 THEN actual_max ELSE max_score END AS max_score
    FROM flags"""
)
def stats_repaired(spark, sf):
    audited = stats.audit(B.stored_journalists(spark, sf), B.scores(spark, sf))
    return stats.repair(audited).select(
        "id", "updated", "article_count", "avg_clickbait_score", "max_score"
    )


_SIX = """SELECT count(*) AS total_journalists, count(*) FILTER (WHERE article_count > 0)
    AS active_journalists, count(*) FILTER (WHERE avg_clickbait_score > 0) AS scored_journalists,
    (SELECT count(*) FROM ev) AS total_articles, (SELECT count(clickbait_score) FROM ev)
    AS scored_articles, (SELECT count(*) FROM ev WHERE clickbait_score IS NULL) AS pending_articles"""

_DELTA_SQL = f"""WITH {B.STORED}, repaired AS (SELECT id,
      CASE WHEN f AND actual_count > 0 THEN actual_count ELSE article_count END AS article_count,
      CASE WHEN f AND actual_count > 0 THEN top_avg ELSE avg_clickbait_score END AS avg_clickbait_score
    FROM (SELECT *, other_mismatch OR abs(avg_clickbait_score - actual_avg) > 0.01 AS f FROM audited)),
  b AS (UNPIVOT ({_SIX} FROM stored) ON COLUMNS(*) INTO NAME counter VALUE v),
  a AS (UNPIVOT ({_SIX} FROM repaired) ON COLUMNS(*) INTO NAME counter VALUE v)
  SELECT b.counter, b.v AS before, a.v AS after, a.v - b.v AS change FROM b JOIN a USING (counter)"""


@query(_DELTA_SQL)
def stats_delta(spark, sf):
    people, articles = B.stored_journalists(spark, sf), B.scores(spark, sf)
    repaired = stats.repair(stats.audit(people, articles))
    return stats.deltas(stats.summary(people, articles), stats.summary(repaired, articles))


@query(_DELTA_SQL)
def job_stats_sync(spark, sf):
    people, articles = B.stored_journalists(spark, sf), B.scores(spark, sf)
    return jobs.sync_statistics(people, articles, fix=True, full_update=True).changes


@query(
    f"""WITH {B.STORED}, flags AS (SELECT *, actual_count > 0 AND
      (other_mismatch OR abs(avg_clickbait_score - actual_avg) > 0.01) AS due FROM audited)
    SELECT CAST(id AS VARCHAR) AS id, CASE WHEN due THEN actual_count ELSE article_count END AS article_count,
      CASE WHEN due THEN top_avg ELSE avg_clickbait_score END AS avg_clickbait_score,
      CASE WHEN due THEN actual_max ELSE max_score END AS max_score,
      CASE WHEN due AND (actual_count <> article_count OR top_avg <> avg_clickbait_score OR actual_max <> max_score)
        THEN '2024-06-01 00:00:00' END AS updated_at FROM flags"""
)
def job_stats_saved(spark, sf):
    path = new_path(spark, "journalists")
    tables.append_journalists(tables.conform(B.stored_journalists(spark, sf), schemas.JOURNALIST), path)
    stored = tables.read_journalists(spark, path)
    articles = B.scores(spark, sf).withColumn("journalist_id", F.col("journalist_id").cast("string"))
    synced = jobs.sync_statistics(stored, articles)
    jobs.save_statistics(path, synced.journalists, F.to_timestamp(F.lit("2024-06-01 00:00:00")))
    changed = F.date_format("updated_at", TS_FORMAT).alias("updated_at")
    return tables.read_journalists(spark, path).select("id", *stats.STORED, changed)


@query(
    f"""WITH {B.ART} SELECT publisher, count(*) AS article_count,
    count(clickbait_score) AS scored_count, round_even(avg(clickbait_score), 2) AS mean_score,
    max(clickbait_score) AS max_score FROM art GROUP BY publisher"""
)
def publisher_stats(spark, sf):
    return stats.publisher_statistics(B.articles(spark, sf).select("publisher", "clickbait_score"))


@query(
    f"""WITH {B.ART} SELECT CASE WHEN clickbait_score <= 20 THEN '0-20'
      WHEN clickbait_score <= 40 THEN '21-40' WHEN clickbait_score <= 60 THEN '41-60'
      WHEN clickbait_score <= 80 THEN '61-80' WHEN clickbait_score <= 100 THEN '81-100' END AS band,
    count(*) AS n FROM art GROUP BY 1"""
)
def score_band_hist(spark, sf):
    banded = B.articles(spark, sf).select(text.score_band(F.col("clickbait_score")).alias("band"))
    return banded.groupBy("band").agg(F.count(F.lit(1)).alias("n"))


_TREND_SQL = f"""WITH {B.EV} SELECT strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d') AS day,
    count(*) AS n_rows, count(clickbait_score) AS n_scored, avg(clickbait_score) AS mean_score,
    max(clickbait_score) AS max_score FROM ev GROUP BY 1"""


@query(_TREND_SQL)
def daily_trend(spark, sf):
    rows = B.scores(spark, sf).withColumnRenamed("clickbait_score", "score")
    return streams.trend_columns(streams.daily_trend(rows))


@query(_TREND_SQL)
def stream_daily_trend(spark, sf):
    events = streams.read_files(
        spark,
        sf,
        B.table(spark, sf, "events").schema,
        pathGlobFilter="events.parquet",
    )
    score = F.expr("case when event_type <> 'error' then cast(floor(value) as bigint) % 101 end")
    rows = events.select(F.col("ts").cast("timestamp").alias("ts"), score.alias("score"))
    out = new_path(spark, "trend")
    streams.trend_stream(rows, out, new_path(spark, "trend-state")).awaitTermination()
    return streams.trend_columns(streams.latest_trend(spark, out))


# --- duplicate merge ------------------------------------------------------------------------------


_KEY_SQL = "sha256(" + " || ".join(
    f"coalesce(length({c}) || ':' || {c}, '-')" for c in records.CONTENT_FIELDS
) + ")"

_MERGE = (
    B.FEED
    + f""",
keyed AS (SELECT *, {_KEY_SQL} AS content_key, coalesce(clickbait_score, 0) AS score FROM feed),
ordered AS (SELECT *, count(*) OVER (PARTITION BY content_key) AS n, row_number() OVER (
    PARTITION BY content_key ORDER BY score DESC, created_at, id) AS rank FROM keyed)"""
)


@query(
    f"""WITH {_MERGE} SELECT id AS kept_id, content_key, n AS duplicate_count, score AS kept_score,
    strftime(created_at, '%Y-%m-%d %H:%M:%S') AS kept_created_at, title, journalist_name, publisher,
    naver_url FROM ordered WHERE n > 1 AND rank = 1"""
)
def dedup_groups(spark, sf):
    groups = dedup.duplicate_groups(B.feed(spark, sf))
    return groups.withColumn("kept_created_at", F.date_format("kept_created_at", TS_FORMAT))


@query(
    f"""WITH {_MERGE} SELECT content_key, id, score, rank, naver_url,
    strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at FROM ordered WHERE n > 1"""
)
def dedup_group_members(spark, sf):
    members = dedup.group_members(B.feed(spark, sf))
    return members.withColumn("created_at", F.date_format("created_at", TS_FORMAT))


@query(f"WITH {_MERGE} SELECT id, content_key FROM ordered WHERE rank > 1")
def dedup_losers(spark, sf):
    return dedup.losers(B.feed(spark, sf))


_SURVIVORS_SQL = f"""WITH {_MERGE} SELECT id, title, journalist_name, publisher, clickbait_score
    FROM ordered WHERE rank = 1"""


@query(_SURVIVORS_SQL)
def dedup_survivors(spark, sf):
    return dedup.survivors(B.feed(spark, sf)).select(
        "id", "title", "journalist_name", "publisher", "clickbait_score"
    )


@query(
    f"""WITH {_MERGE} SELECT count(*) FILTER (WHERE n > 1 AND rank = 1) AS groups,
    count(*) FILTER (WHERE n > 1) AS duplicate_articles, count(*) FILTER (WHERE rank > 1) AS deleted
    FROM ordered"""
)
def dedup_totals(spark, sf):
    return dedup.merge_totals(B.articles(spark, sf))


@query(_SURVIVORS_SQL)
def job_merge_duplicates(spark, sf):
    path = _article_table(spark, sf)
    jobs.delete_duplicates(spark, path)
    return tables.read_table(spark, path).select(
        "id", "title", "journalist_name", "publisher", "clickbait_score"
    )


@query(
    f"""WITH {_MERGE},
    u AS (SELECT id, min(id) OVER (PARTITION BY naver_url) AS first_id FROM keyed),
    c AS (SELECT id, min(id) OVER (PARTITION BY content_key) AS first_id FROM keyed),
    l AS (SELECT id, first_id, true AS same_url, false AS same_content FROM u WHERE id <> first_id
      UNION ALL SELECT id, first_id, false, true FROM c WHERE id <> first_id)
    SELECT id, first_id, bool_or(same_url) AS same_url, bool_or(same_content) AS same_content
    FROM l GROUP BY id, first_id"""
)
def duplicate_pairs(spark, sf):
    return dedup.duplicate_links(B.feed(spark, sf))


@query(
    f"""WITH {B.FEED} SELECT id, {_KEY_SQL} AS content_key,
    sha256(coalesce(length(naver_url) || ':' || naver_url, '-') || {_KEY_SQL[7:-1]}) AS duplicate_key
    FROM feed"""
)
def content_key(spark, sf):
    return B.feed(spark, sf).select(
        "id",
        records.content_key().alias("content_key"),
        records.duplicate_key().alias("duplicate_key"),
    )


# --- text and URL expressions ------------------------------------------------------------------------

_VARIANTS = """case page_id % 8 when 0 then concat('  ', url, chr(9)) when 1 then upper(url)
    when 2 then concat(url, ';v=1') when 3 then substr(url, strpos(url, ':') + 1)
    when 4 then '   ' when 5 then replace(url, '/en/', '/mnews/article/')
    when 6 then concat(substr(url, 1, strpos(url, '.com')), 'com/') else url end"""


@query(
    f"""WITH v AS (SELECT page_id, {_VARIANTS} AS raw FROM pages),
    a AS (SELECT page_id, raw, regexp_extract({sql_strip('raw')}, '^[^?#]*') AS addr FROM v),
    s AS (SELECT *, lower(regexp_extract(addr, '^([a-zA-Z][a-zA-Z0-9+.-]*):', 1)) AS scheme,
      regexp_replace(addr, '^[a-zA-Z][a-zA-Z0-9+.-]*:', '') AS rest FROM a),
    p AS (SELECT *, regexp_extract(rest, '^//([^/]*)', 1) AS host,
      replace(regexp_replace(regexp_replace(rest, '^//[^/]*', ''), ';[^/]*$', ''),
        '/mnews/article/', '/article/') AS path FROM s)
    SELECT page_id, CASE WHEN {sql_strip('raw')} = '' THEN '' ELSE
      (CASE scheme WHEN '' THEN 'https' ELSE scheme END) || '://' || host ||
      CASE WHEN length(path) > 1 AND path LIKE '%/' THEN left(path, -1) ELSE path END END AS url
    FROM p"""
)
def url_normalize(spark, sf):
    pages = B.table(spark, sf, "pages").withColumn(
        "raw", F.expr(_VARIANTS.replace("strpos(url, ", "instr(url, "))
    )
    return pages.select("page_id", text.normalize_url(F.col("raw")).alias("url"))


_PEOPLE = (
    B.ART
    + """,
raw AS (SELECT id, CASE id % 5 WHEN 0 THEN '  ' || journalist_name || ' ' WHEN 1 THEN '-'
    WHEN 2 THEN '기자' ELSE journalist_name END AS journalist_name,
    CASE id % 7 WHEN 0 THEN ' p ' ELSE publisher || ' ' END AS publisher FROM art),
pub AS (SELECT id, trim(journalist_name) AS name,
    CASE WHEN length(trim(publisher)) < 2 THEN '네이버뉴스' ELSE trim(publisher) END AS publisher
    FROM raw),
people AS (SELECT id, publisher, CASE WHEN length(name) < 2 OR name IN ('익명', '기자', '사용자')
    THEN '익명기자_' || publisher ELSE name END AS name FROM pub)"""
)


def _people(spark, sf):
    """Articles with untidy reporter and publisher names."""
    return B.articles(spark, sf).select(
        "id",
        F.expr(
            "case id % 5 when 0 then concat('  ', journalist_name, ' ') when 1 then '-' "
            "when 2 then '기자' else journalist_name end"
        ).alias("journalist_name"),
        F.expr("case id % 7 when 0 then ' p ' else concat(publisher, ' ') end").alias("publisher"),
    )


@query(f"WITH {_PEOPLE} SELECT id, name, publisher FROM people")
def journalist_normalize(spark, sf):
    return journalists.normalized(_people(spark, sf)).select(
        "id", F.col("journalist_name").alias("name"), "publisher"
    )


@query(
    f"""WITH {B.ART}, c AS (SELECT id, replace(content, '.' || chr(10), '.' || chr(10) || chr(10)) || chr(10)
      AS t FROM art) SELECT id, {sql_clean('t')} AS content FROM c"""
)
def content_clean(spark, sf):
    spaced = F.expr("concat(replace(content, '.\n', '.\n\n'), '\n')")
    return B.articles(spark, sf).select("id", text.clean_content(spaced).alias("content"))


@query(
    f"""WITH {B.ART}, c AS (SELECT id, replace(content, '.' || chr(10), '.' || chr(10) || chr(10)) || chr(10)
      AS t FROM art) SELECT id, {sql_clean('t', None)} AS content FROM c"""
)
def content_clean_full(spark, sf):
    spaced = F.expr("concat(replace(content, '.\n', '.\n\n'), '\n')")
    return B.unscored_articles(spark, sf).select("id", text.clean_content(spaced, None).alias("content"))


def _sql_entities(column: str) -> str:
    bare = f"regexp_replace({column}, '&[^;]+;', '', 'g')"
    return f"regexp_replace({bare}, '(?s)<!--.*?-->|</?[a-zA-Z][^>]*>|<[!?][^>]*>', '', 'g')"


@query(
    f"""SELECT page_id, {_sql_entities('html')} AS plain, {_sql_entities("'&lt;b&gt;' || url || '<i>x</i>'")}
    AS title FROM pages"""
)
def entity_strip(spark, sf):
    title = F.concat(F.lit("&lt;b&gt;"), "url", F.lit("<i>x</i>"))
    return B.table(spark, sf, "pages").select(
        "page_id",
        text.strip_entities(F.col("html")).alias("plain"),
        text.strip_entities(title).alias("title"),
    )


_BYLINE = """case id % 6 when 0 then concat(journalist_name, ' 기자 r', id, '@press.com')
    when 1 then concat(journalist_name, '(a@b.c) 인턴기자') when 2 then concat(journalist_name, ' PD')
    when 3 then concat(' ', journalist_name, ' (x@y.z) 편집장') when 4 then concat('기자 ', title)
    else journalist_name end"""


@query(
    f"""WITH {B.ART}, b AS (SELECT id, {_BYLINE} AS line FROM art),
    c AS (SELECT id, regexp_replace(regexp_replace(regexp_replace(line, '\\s+\\S+@\\S+\\.\\S+$', ''),
      '\\s*\\(\\S+@\\S+\\.\\S+\\)', '', 'g'),
      '\\s+(기자|인턴기자|인턴|캐스터|기상캐스터|PD|리포터|편집장|외신캐스터)$', '') AS name FROM b)
    SELECT id, {sql_strip('name')} AS name FROM c"""
)
def byline_clean(spark, sf):
    return B.articles(spark, sf).select(
        "id", text.clean_byline(F.expr(_BYLINE)).alias("name")
    )


@query(
    f"""WITH {B.ART}, t AS (SELECT id, {sql_strip('title')} AS title, {sql_strip('content')} AS content
      FROM art)
    SELECT id, '제목: ' || title || chr(10) || '본문: ' || substr(content, 1, 700)
      || CASE WHEN length(content) > 700 THEN '...' ELSE '' END AS prompt FROM t"""
)
def prompt_render(spark, sf):
    template = "제목: {title}\n본문: {content}"
    return B.articles(spark, sf).select(
        "id", text.render_prompt(F.col("title"), F.col("content"), template).alias("prompt")
    )


@query(
    f"""WITH {B.ART} SELECT id, '제목: ' || {sql_strip('title')} || chr(10) || '본문: ' || {sql_strip('content')}
    AS prompt FROM art"""
)
def prompt_render_full(spark, sf):
    prompt = text.render_prompt(F.col("title"), F.col("content"), "제목: {title}\n본문: {content}", None)
    return B.unscored_articles(spark, sf).select("id", prompt.alias("prompt"))


@query(
    f"""WITH {B.ART} SELECT id, len(regexp_extract_all(content, 'the|and|der|que|les|SNS')) AS body_cues,
    len(regexp_extract_all(title, '온라인 커뮤니티|네티즌들은|화들짝|SNS|논란|충격|경악|발칵|깜짝|화제')) AS title_cues,
    len(regexp_extract_all(title, '충격|경악|발칵')) AS sensational_cues,
    len(regexp_extract_all(title, '이것|저것|그것')) AS pronoun_cues
    FROM art"""
)
def lexical_cues(spark, sf):
    return B.articles(spark, sf).select(
        "id",
        text.cue_count(F.col("content"), B.CUE_WORDS).alias("body_cues"),
        text.cue_count(F.col("title"), S.DEFAULT_KEYWORDS).alias("title_cues"),
        text.cue_count(F.col("title"), S.SENSATIONAL_WORDS).alias("sensational_cues"),
        text.cue_count(F.col("title"), S.VAGUE_PRONOUNS).alias("pronoun_cues"),
    )


@query(
    f"""WITH {B.ART} SELECT id, keyword FROM art, unnest(['the','and','der','que','les','SNS']) u(keyword)
    WHERE contains(content, keyword)"""
)
def keyword_match(spark, sf):
    return feed.keyword_matches(B.articles(spark, sf), B.CUE_WORDS, "content")


@query(
    f"""WITH {B.ART}, w AS (SELECT string_split(text, ' ') AS w FROM benchmark),
    pairs AS (SELECT DISTINCT w[i] || ' ' || w[i + 1] AS keyword FROM w, unnest(range(1, len(w))) r(i))
    SELECT id, keyword FROM art JOIN pairs ON contains(title, keyword)"""
)
def keyword_match_table(spark, sf):
    """Every two neighbouring words of the benchmark texts are a keyword."""
    words = B.table(spark, sf, "benchmark").select(F.split("text", " ").alias("w"))
    places = F.expr("transform(slice(w, 1, size(w) - 1), (word, i) -> concat(word, ' ', w[i + 1]))")
    pairs = words.where("size(w) > 1").select(F.explode(places).alias("keyword"))
    return keywords.table_matches(B.unscored_articles(spark, sf), pairs)


_WHITELIST = "[가-힣a-zA-Z0-9\\s.,''\"\\-+?!/()\\[\\]{}:;&%@#*^$_=~`\\\\]+"


@query(
    f"""WITH {B.ART} SELECT id, regexp_full_match(title, '{_WHITELIST}') AS allowed,
    regexp_full_match(content, '{_WHITELIST}') AS body_allowed FROM art"""
)
def keyword_whitelist(spark, sf):
    return B.articles(spark, sf).select(
        "id",
        text.allowed_keyword(F.col("title")).alias("allowed"),
        text.allowed_keyword(F.col("content")).alias("body_allowed"),
    )


# --- HTML --------------------------------------------------------------------------------------------


def _decoded(column: str) -> str:
    for name, sign in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        column = f"regexp_replace({column}, '&{name}\\b;?', '{sign}', 'g')"
    return column


_MARKUP = (
    "regexp_replace(html, '(?is)<!--.*?-->|<script\\b[^>]*>.*?</script\\s*>"
    "|<style\\b[^>]*>.*?</style\\s*>', '', 'g')"
)
_TAGS = "'(?s)</?[a-zA-Z][^>]*>|<[!?][^>]*>'"


def _field(tag: str) -> str:
    inner = f"regexp_extract(m, '(?s)<{tag}>(.*?)</{tag}>', 1)"
    return _decoded(f"regexp_replace({inner}, {_TAGS}, '', 'g')")


@query(
    f"""WITH p AS (SELECT page_id, {_MARKUP} AS m FROM pages)
    SELECT page_id, {sql_strip(_field('h1'))} AS title, {sql_strip(_field('footer'))} AS publisher,
      {sql_clean(_field('article'))} AS content FROM p"""
)
def html_extract(spark, sf):
    pages = B.table(spark, sf, "pages")
    extracted = feed.extract_pages(
        pages, [html.Rule("h1")], [html.Rule("footer")], [html.Rule("article")]
    )
    return extracted.select(
        "page_id",
        F.col("page_title").alias("title"),
        F.col("page_publisher").alias("publisher"),
        F.col("page_content").alias("content"),
    )


@query(
    f"""WITH p AS (SELECT page_id, {_MARKUP} AS m FROM pages)
    SELECT page_id, {sql_strip(_field('h1'))} AS title, {sql_strip(_field('footer'))} AS publisher,
      {sql_clean(_field('article'), None)} AS content FROM p"""
)
def html_extract_full(spark, sf):
    pages = B.table(spark, sf, "pages")
    extracted = feed.extract_pages(
        pages, [html.Rule("h1")], [html.Rule("footer")], [html.Rule("article")], limit=None
    )
    return extracted.select(
        "page_id",
        F.col("page_title").alias("title"),
        F.col("page_publisher").alias("publisher"),
        F.col("page_content").alias("content"),
    )


@query(
    f"""WITH {B.NEWS_PAGES} SELECT naver_url, page_title, page_publisher, page_reporter, page_content
    FROM news_pages"""
)
def article_page_extract(spark, sf):
    return feed.extract_pages(B.news_pages(spark, sf)).drop("id")


@query(
    f"""WITH {B.NEWS_PAGES} SELECT id, CASE WHEN id % 3 = 1 THEN page_reporter END AS reporters
    FROM news_pages"""
)
def reporter_cards(spark, sf):
    page = html.visible_markup(F.col("html"))
    return B.news_pages(spark, sf).select("id", html.reporter_cards(page).alias("reporters"))


@query(
    f"""WITH {B.EVERY_PAGE} SELECT naver_url, page_title, page_publisher, page_reporter, page_content
    FROM every_page"""
)
def article_page_extract_all(spark, sf):
    return feed.extract_pages(B.every_page(spark, sf)).drop("id")


@query(
    f"""WITH {B.EVERY_PAGE} SELECT id, CASE WHEN id % 3 = 1 THEN page_reporter END AS reporters
    FROM every_page"""
)
def reporter_cards_all(spark, sf):
    page = html.visible_markup(F.col("html"))
    return B.every_page(spark, sf).select("id", html.reporter_cards(page).alias("reporters"))


# --- sources -------------------------------------------------------------------------------------------


def _search_responses(spark, sf):
    """One response per document with two items, or without ``items``."""
    fields = ["title", "description", "originallink", "link", "pubDate"]
    first = F.struct(*fields)
    second = F.struct(*fields[:3], F.col("originallink").alias("link"), "pubDate")
    response = F.when(F.col("id") % 17 == 0, F.lit('{"total": 0}')).otherwise(
        F.to_json(F.struct(F.array(first, second).alias("items")))
    )
    return B.items(spark, sf).select("id", response.alias("response"))


@query(
    f"""WITH {B.ITEMS} SELECT id, CAST(0 AS INTEGER) AS item_pos, title, description, originallink,
      link, pubDate FROM items WHERE id % 17 <> 0
    UNION ALL SELECT id, 1, title, description, originallink, originallink, pubDate FROM items
    WHERE id % 17 <> 0"""
)
def src_search_items(spark, sf):
    return responses.explode_items(responses.parse_search_responses(_search_responses(spark, sf)))


@query(f"WITH {B.RES} SELECT pos, batch_id, coalesce(error = 'malformed', false) AS malformed FROM res")
def src_result_lines(spark, sf):
    lines = jsonl.parse_result_lines(B.result_lines(spark, sf).drop("payload"))
    return lines.select("pos", "batch_id", "malformed")


_TRENDS = f"""lines AS (SELECT doc_id, string_split(text, chr(10)) AS q FROM documents),
    usable AS (SELECT doc_id, list_slice(list_filter(q, lambda x: x[1:1] <> 'E'
      AND regexp_full_match(x, '{_WHITELIST}')), 1, 5) AS ok FROM lines),
    trends AS (SELECT doc_id, CAST(i - 1 AS INTEGER) AS rank, ok[i] AS keyword
      FROM usable, unnest(range(1, len(ok) + 1)) t(i))"""


def _trend_responses(spark, sf):
    """Each document as a trend response: its lines are the queries, some entries have none."""
    entries = F.transform(
        F.split("text", "\n"), lambda q: F.struct(F.when(~q.startswith("E"), q).alias("query"))
    )
    response = F.to_json(F.struct(entries.alias("trending_searches")))
    return B.table(spark, sf, "documents").select("doc_id", response.alias("response"))


def _trends(spark, sf):
    return responses.trend_keywords(responses.parse_trend_responses(_trend_responses(spark, sf)))


@query(f"WITH {_TRENDS} SELECT doc_id, rank, keyword FROM trends")
def trend_keywords(spark, sf):
    return _trends(spark, sf)


@query(
    f"""WITH {_TRENDS} SELECT keyword FROM trends UNION
    SELECT unnest([{', '.join(f"'{w}'" for w in S.DEFAULT_KEYWORDS)}])"""
)
def keyword_union(spark, sf):
    return feed.combined_keywords(spark, _trends(spark, sf))


# --- feed ------------------------------------------------------------------------------------------------


@query(
    f"""WITH {B.ITEMS} SELECT position, regexp_replace(replace(regexp_replace(link, '[?#].*$', ''),
    '/mnews/article/', '/article/'), '/$', '') AS naver_url FROM items
    WHERE contains(link, 'news.naver.com')"""
)
def link_filter(spark, sf):
    return feed.news_links(B.items(spark, sf)).select("position", "naver_url")


_COMBINED = (
    B.NEWS_PAGES
    + f""",
linked AS (SELECT i.*, f.naver_url FROM items i JOIN feed f USING (id) WHERE i.id % 13 <> 0),
fetched AS (SELECT * FROM news_pages WHERE length(page_title) >= 9
    AND length({sql_strip('page_content')}) >= 100),
plain AS (SELECT l.id, l.position, l.keyword, l.naver_url, l.local_at,
    coalesce(nullif(page_title, ''), {_sql_entities('l.title')}) AS title,
    {_sql_entities('l.description')} AS description,
    coalesce(nullif(page_content, ''), {_sql_entities('l.description')}) AS raw_content,
    coalesce(nullif(page_publisher, ''), '네이버뉴스') AS publisher,
    coalesce(nullif(page_reporter, ''), '익명') AS reporter
  FROM linked l LEFT JOIN fetched p USING (naver_url)),
combined AS (SELECT *, CASE WHEN length(raw_content) >= 100 THEN raw_content
    WHEN length(raw_content || ' ' || description) >= 100 THEN raw_content || ' ' || description END
      AS content,
    CASE WHEN length({sql_strip('reporter')}) < 2 OR reporter IN ('익명', '기자', '사용자')
      THEN '익명기자_' || publisher ELSE {sql_strip('reporter')} END AS journalist_name FROM plain),
checked AS (SELECT *, CASE WHEN length({sql_strip('title')}) < 9 THEN 'title'
    WHEN coalesce(length({sql_strip('content')}), 0) < 100 THEN 'content' END AS reject_reason
  FROM combined)"""
)


def _combined(spark, sf):
    pages = feed.usable_pages(feed.extract_pages(B.news_pages(spark, sf).drop("id")))
    return feed.combine(feed.news_links(B.items(spark, sf)), pages)


@query(
    f"""WITH {_COMBINED} SELECT position, naver_url, title, content, publisher, journalist_name,
    reject_reason FROM checked"""
)
def field_precedence(spark, sf):
    return feed.with_reject_reason(_combined(spark, sf)).select(
        "position", "naver_url", "title", "content", "publisher", "journalist_name", "reject_reason"
    )


@query(
    f"""WITH {B.ITEMS} SELECT i.id, CASE WHEN length(f.title) >= 100 THEN f.title
      WHEN length(f.title || ' ' || i.description) >= 100 THEN f.title || ' ' || i.description END AS body
    FROM items i JOIN feed f USING (id)"""
)
def body_padding(spark, sf):
    description = F.split_part("content", F.lit("\n"), F.lit(2))
    return B.articles(spark, sf).select(
        "id", validation.padded_content(F.col("title"), description).alias("body")
    )


_DATE_TEXTS = """case id % 6 when 0 then substr(pubDate, 6) when 1 then replace(pubDate, '+0900', '+0000')
    when 2 then regexp_replace(pubDate, ' [0-9]{2}([0-9]{2}) ', ' $1 ') when 3 then replace(pubDate, ' +0900', '')
    else pubDate end"""


@query(
    f"""WITH {B.ITEMS}, t AS (SELECT id, CASE WHEN id % 6 IN (2, 3) THEN NULL
      WHEN id % 6 = 1 THEN local_at + INTERVAL 9 HOUR ELSE local_at END AS t FROM items)
    SELECT id, strftime(t, '%Y-%m-%d %H:%M:%S') AS published_kst, strftime(t, '%Y-%m-%d') AS local_day
    FROM t"""
)
def pubdate_kst(spark, sf):
    instant = dates.parse_rfc822(F.expr(_DATE_TEXTS))
    return B.items(spark, sf).select(
        "id",
        F.date_format(dates.local_time(instant), TS_FORMAT).alias("published_kst"),
        dates.local_date(instant).cast("string").alias("local_day"),
    )


@query(
    f"WITH {B.FEED} SELECT position, naver_url FROM feed WHERE CAST(local_at AS DATE) = DATE '{FEED_DAY}'"
)
def date_slice(spark, sf):
    return feed.on_day(B.feed(spark, sf), FEED_DAY).select("position", "naver_url")


@query(
    f"""WITH {B.FEED}, r AS (SELECT *, coalesce(bool_or(CAST(local_at AS DATE) < DATE '{FEED_DAY}') OVER (
      PARTITION BY keyword ORDER BY position ROWS UNBOUNDED PRECEDING), false) AS past FROM feed)
    SELECT keyword, position FROM r WHERE NOT past AND CAST(local_at AS DATE) = DATE '{FEED_DAY}'"""
)
def date_take_while(spark, sf):
    return feed.until_older(B.feed(spark, sf), FEED_DAY, ["keyword"]).select("keyword", "position")


_DAY_TEXTS = """case id % 5 when 0 then concat('2023-', 11 + id % 2, '-', 10 + id % 20)
    when 1 then '2024-13-01' when 2 then concat('2024-02-', 10 + id % 20) when 3 then title
    else concat('2024-03-0', 1 + id % 9) end"""


@query(
    f"""WITH {B.ART}, d AS (SELECT id, {_DAY_TEXTS} AS t FROM art)
    SELECT id, coalesce(TRY_CAST(CASE WHEN regexp_full_match(t, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN t END AS DATE)
      BETWEEN DATE '{ASOF}' - INTERVAL 3 MONTH AND DATE '{ASOF}', false) AS allowed FROM d"""
)
def date_range_guard(spark, sf):
    return B.articles(spark, sf).select("id", feed.allowed_day(F.expr(_DAY_TEXTS), ASOF).alias("allowed"))


@query(
    f"""WITH {B.FEED}, r AS (SELECT keyword, position, row_number() OVER (PARTITION BY keyword
      ORDER BY local_at DESC, position) AS rn FROM feed) SELECT keyword, position FROM r WHERE rn <= 50"""
)
def keyword_cap(spark, sf):
    rows = B.feed(spark, sf).select("keyword", "position", "published_at")
    return feed.newest_per_keyword(rows, limit=50).select("keyword", "position")


@query(
    f"""WITH {B.FEED} SELECT keyword, position, naver_url FROM feed
    UNION ALL SELECT 'pages', page_id, url FROM pages"""
)
def feed_union(spark, sf):
    pages = B.table(spark, sf, "pages").select(
        F.lit("pages").alias("keyword"), F.col("page_id").alias("position"), F.col("url").alias("naver_url")
    )
    return B.feed(spark, sf).select("keyword", "position", "naver_url").unionByName(pages)


def _rounds(source: str, n: int = 4) -> str:
    """SQL of ``n`` rounds of the greedy dedup over ``source`` (position, naver_url, content_key)."""
    steps = [f"r0 AS MATERIALIZED (SELECT position, naver_url, content_key FROM {source})"]
    for i in range(n):
        steps.append(
            f"""k{i} AS MATERIALIZED (SELECT position, naver_url, content_key FROM (SELECT *,
      min(position) OVER (PARTITION BY naver_url) AS mu, min(position) OVER (PARTITION BY content_key)
      AS mc FROM r{i}) WHERE position = mu AND position = mc)"""
        )
        steps.append(
            f"""r{i + 1} AS MATERIALIZED (SELECT * FROM r{i}
      WHERE naver_url NOT IN (SELECT naver_url FROM k{i})
      AND content_key NOT IN (SELECT content_key FROM k{i}))"""
        )
    kept = " UNION ALL ".join(f"SELECT position, naver_url FROM k{i}" for i in range(n))
    return ",\n".join(steps) + f",\ngreedy AS (SELECT * FROM ({kept}))"


@query(f"WITH {_MERGE}, {_rounds('keyed')} SELECT position, naver_url FROM greedy")
def feed_dedup(spark, sf):
    return dedup.feed_dedup(B.feed(spark, sf)).select("position", "naver_url")


_SCOPED = (
    _MERGE
    + """,
scoped AS (SELECT position, keyword || '|' || naver_url AS naver_url,
    keyword || '|' || content_key AS content_key FROM keyed)"""
)


@query(f"WITH {_SCOPED}, {_rounds('scoped')} SELECT position FROM greedy")
def feed_dedup_by_keyword(spark, sf):
    return dedup.feed_dedup(B.feed(spark, sf), scope=["keyword"]).select("position")


# --- ingest ------------------------------------------------------------------------------------------------


def _stored(spark, sf):
    return B.feed(spark, sf).where("id % 3 = 0").select("naver_url")


_STORED_SQL = "known AS (SELECT DISTINCT naver_url FROM feed WHERE id % 3 = 0)"


@query(
    f"""WITH {B.FEED}, {_STORED_SQL} SELECT DISTINCT link AS url, f.naver_url,
    k.naver_url IS NOT NULL AS "exists" FROM feed f LEFT JOIN known k ON f.naver_url = k.naver_url"""
)
def url_exists_flag(spark, sf):
    links = B.feed(spark, sf).select(F.col("link").alias("url"))
    return dedup.url_flags(links, _stored(spark, sf))


_ASKED_SQL = f"""WITH {B.FEED}, {_STORED_SQL}, days AS (SELECT max(CAST(local_at AS DATE)) AS day FROM feed)
    SELECT DISTINCT link AS url, f.naver_url, k.naver_url IS NOT NULL AS "exists"
    FROM feed f JOIN days ON CAST(local_at AS DATE) = day LEFT JOIN known k ON f.naver_url = k.naver_url"""


@query(_ASKED_SQL)
def url_exists_indexed(spark, sf):
    """The links of the newest day against the side table of all stored URLs."""
    path = new_path(spark, "stored-urls")
    url_index.append(B.feed(spark, sf, scored=False).where("id % 3 = 0").select("naver_url").distinct(), path, 64)
    rows = B.feed(spark, sf, scored=False).withColumn("day", F.to_date("local_at"))
    newest = rows.join(F.broadcast(rows.agg(F.max("day").alias("day"))), "day")
    links = materialise(newest.select(F.col("link").alias("url"), "naver_url"), "asked-urls")
    return dedup.url_flags(links, url_index.among(links, path, 64))


@query(
    f"""WITH {B.FEED}, {_STORED_SQL} SELECT position, naver_url, title FROM feed
    WHERE naver_url NOT IN (SELECT naver_url FROM known)"""
)
def ingest_new_only(spark, sf):
    new = dedup.drop_stored(B.feed(spark, sf), _stored(spark, sf))
    return new.select("position", "naver_url", "title")


_OUTCOMES = (
    B.FEED
    + f""",
{_STORED_SQL},
outcomes AS (SELECT position, naver_url, CASE WHEN position <> min(position) OVER (
    PARTITION BY naver_url) THEN 'repeat' WHEN naver_url IN (SELECT naver_url FROM known) THEN 'stored'
    ELSE 'inserted' END AS outcome FROM feed)"""
)


@query(f"WITH {_OUTCOMES} SELECT position, naver_url, outcome FROM outcomes")
def ingest_insert(spark, sf):
    labelled = dedup.insert_outcomes(B.feed(spark, sf), _stored(spark, sf))
    return labelled.select("position", "naver_url", "outcome")


@query(f"WITH {_OUTCOMES} SELECT outcome, count(*) AS n FROM outcomes GROUP BY outcome")
def ingest_outcomes(spark, sf):
    rows = B.feed(spark, sf).select("position", "naver_url")
    labelled = dedup.insert_outcomes(rows, _stored(spark, sf))
    return labelled.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {B.FEED} SELECT id, CASE WHEN length({sql_strip('title')}) < 9 THEN 'title'
      WHEN length({sql_strip('content')}) < 100 THEN 'content' WHEN id % 19 = 0 THEN 'url'
      WHEN clickbait_score + 10 > 100 THEN 'score' END AS reject_reason FROM feed"""
)
def article_validate(spark, sf):
    url = F.when(F.col("id") % 19 == 0, F.lit("https://invalid-url.com")).otherwise(F.col("naver_url"))
    reason = validation.article_reject_reason(
        F.col("title"), F.col("content"), url, F.col("clickbait_score") + 10
    )
    return B.feed(spark, sf).select("id", reason.alias("reject_reason"))


@query(
    f"""WITH {_PEOPLE} SELECT id, CASE WHEN length(trim(journalist_name)) < 2 THEN 'name'
    WHEN length(trim(publisher)) < 2 THEN 'publisher' END AS reject_reason FROM raw"""
)
def journalist_validate(spark, sf):
    reason = validation.journalist_reject_reason(F.col("journalist_name"), F.col("publisher"))
    return _people(spark, sf).select("id", reason.alias("reject_reason"))


_DIMENSION = (
    _PEOPLE
    + """,
dim AS (SELECT DISTINCT name, publisher, 'J:' || name || '|' || publisher AS id FROM people
    WHERE id % 3 = 0),
resolved AS (SELECT DISTINCT p.name, p.publisher, coalesce(d.id, sha256(length(p.name) || ':' || p.name
    || length(p.publisher) || ':' || p.publisher)) AS id, d.id IS NULL AS is_new
  FROM people p LEFT JOIN dim d ON p.name = d.name AND p.publisher = d.publisher)"""
)


def _dimension(spark, sf):
    """Stored journalists: those of every third article."""
    known = journalists.distinct_journalists(_people(spark, sf).where("id % 3 = 0"))
    return known.withColumn("id", F.concat(F.lit("J:"), "name", F.lit("|"), "publisher"))


@query(f"WITH {_PEOPLE} SELECT DISTINCT name, publisher FROM people")
def distinct_journalists(spark, sf):
    return journalists.distinct_journalists(_people(spark, sf))


@query(
    f"""WITH {_DIMENSION} SELECT id, name, publisher, CAST(0 AS BIGINT) AS article_count,
    CAST(0.0 AS DOUBLE) AS avg_clickbait_score, 0 AS max_score FROM resolved WHERE is_new"""
)
def journalist_new(spark, sf):
    return journalists.new_journalists(_people(spark, sf), _dimension(spark, sf))


@query(f"WITH {_DIMENSION} SELECT name, publisher, id, is_new FROM resolved")
def journalist_resolve(spark, sf):
    return journalists.resolve(_people(spark, sf), _dimension(spark, sf))


@query(
    f"""WITH {_DIMENSION} SELECT p.id, p.name AS journalist_name, p.publisher, d.id AS journalist_id
    FROM people p LEFT JOIN dim d ON p.name = d.name AND p.publisher = d.publisher"""
)
def article_with_journalist(spark, sf):
    return journalists.attach_ids(_people(spark, sf), _dimension(spark, sf)).select(
        "id", "journalist_name", "publisher", "journalist_id"
    )


_INGEST = (
    _COMBINED
    + f""",
keyed AS (SELECT *, {_KEY_SQL} AS content_key FROM checked WHERE reject_reason IS NULL),
scoped AS (SELECT position, keyword || '|' || naver_url AS naver_url,
    keyword || '|' || content_key AS content_key FROM keyed),
{_rounds('scoped')},
{_STORED_SQL},
firsts AS (SELECT k.*, min(position) OVER (PARTITION BY naver_url) AS first_position FROM keyed k
  WHERE position IN (SELECT position FROM greedy))"""
)


_INGESTED_SQL = f"""WITH {_INGEST} SELECT naver_url, title, content, publisher, journalist_name,
    sha256(length(journalist_name) || ':' || journalist_name || length(publisher) || ':' || publisher)
      AS journalist_id,
    strftime(local_at, '%Y-%m-%d %H:%M:%S') AS published_kst FROM firsts
    WHERE position = first_position AND naver_url NOT IN (SELECT naver_url FROM known)"""


def _ingested_columns(articles):
    return articles.select(
        "naver_url",
        "title",
        "content",
        "publisher",
        "journalist_name",
        "journalist_id",
        F.date_format(dates.local_time(F.col("published_at")), TS_FORMAT).alias("published_kst"),
    )


@query(_INGESTED_SQL)
def job_ingest(spark, sf):
    people = spark.createDataFrame([], "id string, name string, publisher string")
    result = jobs.ingest(
        B.items(spark, sf), B.news_pages(spark, sf).drop("id"), _stored(spark, sf), people
    )
    return _ingested_columns(result.new_articles)


def _pieces(rows: DataFrame, order: str, n: int) -> list[DataFrame]:
    """``n`` runs of ``rows`` by ``order``, none of them the whole table."""
    last = rows.agg(F.max(order)).first()[0]
    cuts = [last * k // n for k in range(1, n)]
    number = sum(((F.col(order) > cut).cast("int") for cut in cuts), F.lit(0))
    return [rows.where(number == k) for k in range(n)]


@query(_INGESTED_SQL)
def stream_ingest(spark, sf):
    """The feed comes in three pieces; what is new is the same as in the job over all of it."""
    source, target, people = (new_path(spark, f"stream-{name}") for name in ("source", "articles", "journalists"))
    state = new_path(spark, "stream-state")
    columns = [
        "position", "keyword", "naver_url", "title", "content", "publisher", "journalist_name", "published_at",
    ]
    rows = materialise(_combined(spark, sf).select(*columns), "stream-feed")
    stored = B.feed(spark, sf).where("id % 3 = 0").withColumn("id", F.sha2("naver_url", 256))
    tables.append_articles(tables.conform(stored, schemas.ARTICLE), target)
    tables.append_journalists(spark.createDataFrame([], schemas.JOURNALIST), people)
    for k, piece in enumerate(_pieces(rows, "position", 3)):
        piece.write.parquet(f"{source}/piece={k}")
        feed_items = streams.read_files(spark, f"{source}/*", rows.schema)
        streams.feed_stream(feed_items, target, people, state).awaitTermination()
    table = tables.read_table(spark, target)
    return _ingested_columns(table.join(stored.select("naver_url").distinct(), "naver_url", "left_anti"))


# --- scoring -------------------------------------------------------------------------------------------------


@query(
    f"""WITH {B.ART} SELECT id, title, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at FROM art
    WHERE clickbait_score IS NULL ORDER BY created_at, id LIMIT 800"""
)
def pending_topn(spark, sf):
    chosen = scoring.oldest_pending(B.articles(spark, sf))
    return chosen.select("id", "title", F.date_format("created_at", TS_FORMAT).alias("created_at"))


_BATCHES_SQL = f"""WITH {B.ART}, r AS (SELECT id, row_number() OVER (ORDER BY created_at, id) AS rank
    FROM art WHERE clickbait_score IS NULL) SELECT id, rank, (rank - 1) // 100 AS batch_no FROM r"""


@query(_BATCHES_SQL)
def request_batches(spark, sf):
    return scoring.number_batches(B.articles(spark, sf), size=100)


_REQUEST_SQL = f"""t AS (SELECT id, {sql_strip('title')} AS t, {sql_strip('content')} AS c FROM art),
    q AS (SELECT id, 'article_' || id AS custom_id, 'POST' AS method, '/v1/chat/completions' AS url,
      'gpt-4o-mini' AS model, '{S.PROMPT_TEMPLATE.split('{title}')[0]}' || t || chr(10) || chr(10) ||
      '본문: ' || substr(c, 1, 700) || CASE WHEN length(c) > 700 THEN '...' ELSE '' END AS prompt FROM t)"""


def _request_fields(line: str, *keep):
    def get(path: str):
        return F.get_json_object(line, path)

    return [
        *keep,
        get("$.custom_id").alias("custom_id"),
        get("$.method").alias("method"),
        get("$.url").alias("url"),
        get("$.body.model").alias("model"),
        get("$.body.messages[1].content").alias("prompt"),
    ]


@query(f"WITH {B.ART}, {_REQUEST_SQL} SELECT id, custom_id, method, url, model, prompt FROM q")
def request_build(spark, sf):
    built = scoring.build_requests(B.articles(spark, sf)).withColumn("line", F.to_json("request"))
    return built.select(*_request_fields("line", "id"))


@query(
    f"""WITH {B.ART}, {_REQUEST_SQL}, r AS (SELECT id, row_number() OVER (ORDER BY created_at, id) AS rank
      FROM art WHERE clickbait_score IS NULL)
    SELECT CAST((rank - 1) // 100 AS INTEGER) AS batch_no, custom_id, method, url, model, prompt
    FROM q JOIN r USING (id)"""
)
def job_build_requests(spark, sf):
    path = new_path(spark, "requests")
    jobs.build_requests(B.articles(spark, sf), path, size=100, all_batches=True)
    lines = spark.read.text(path)
    return lines.select(*_request_fields("value", "batch_no"))


@query(
    f"""WITH {B.RES} SELECT id AS pos, valid, CASE WHEN valid THEN raw_score END AS score,
    CASE WHEN valid THEN raw_text END AS explanation FROM res4"""
)
def payload_validate(spark, sf):
    payload = validation.validate_payload(F.col("payload"))
    return B.result_lines(spark, sf).select("pos", payload.alias("p")).select(
        "pos", F.col("p").isNotNull().alias("valid"), "p.score", "p.explanation"
    )


def _parsed(spark, sf):
    return scoring.parse_results(jsonl.parse_result_lines(B.result_lines(spark, sf).drop("payload")))


@query(
    f"""WITH {B.RES} SELECT pos, batch_id, error,
    CASE WHEN error IN ('malformed', 'custom_id') THEN NULL ELSE article_id END AS article_id,
    CASE WHEN error IS NULL OR error = 'custom_id' THEN score END AS score,
    CASE WHEN error IS NULL OR error = 'custom_id' THEN explanation END AS explanation FROM res"""
)
def result_parse(spark, sf):
    return _parsed(spark, sf)


@query(f"WITH {B.RES} SELECT * FROM verdicts")
def result_strict_batches(spark, sf):
    return scoring.batch_verdicts(_parsed(spark, sf))


@query(
    f"""WITH {B.RES}, {B.BATCHES} SELECT pos, batch_id FROM res
    WHERE batch_id NOT IN (SELECT batch_id FROM batches WHERE status = 'completed')"""
)
def result_skip_completed(spark, sf):
    lines = jsonl.parse_result_lines(B.result_lines(spark, sf).drop("payload"))
    return scoring.skip_completed(lines.select("pos", "batch_id"), B.batches(spark, sf))


_UPDATES = (
    B.RES
    + """,
updates AS (SELECT r.article_id, r.score, r.explanation, r.pos FROM res r JOIN verdicts v USING (batch_id)
  WHERE v.applicable AND r.error IS NULL)"""
)


def _updates(spark, sf):
    parsed = materialise(_parsed(spark, sf), "parsed")
    return scoring.one_update_per_article(scoring.strict_updates(parsed))


@query(
    f"""WITH {B.ART}, {_UPDATES} SELECT u.article_id, u.score, u.explanation FROM updates u
    JOIN art a ON CAST(a.id AS VARCHAR) = u.article_id WHERE a.clickbait_score IS NULL"""
)
def score_idempotent(spark, sf):
    return scoring.not_yet_scored(_updates(spark, sf), B.articles(spark, sf))


_APPLIED_SQL = f"""WITH {B.ART}, {_UPDATES} SELECT a.id, a.title,
    coalesce(a.clickbait_score, u.score) AS clickbait_score,
    coalesce(a.clickbait_explanation, u.explanation) AS clickbait_explanation,
    CASE WHEN a.clickbait_score IS NULL AND u.score IS NOT NULL THEN '2024-06-01 00:00:00' END
      AS updated_at
    FROM art a LEFT JOIN updates u ON CAST(a.id AS VARCHAR) = u.article_id"""

_APPLIED_AT = "timestamp_ntz'2024-06-01 00:00:00'"
_APPLIED = ["id", "title", "clickbait_score", "clickbait_explanation"]


def _applied_columns(articles):
    return articles.select(*_APPLIED, F.date_format("updated_at", TS_FORMAT).alias("updated_at"))


@query(_APPLIED_SQL)
def score_apply(spark, sf):
    applied = scoring.apply_scores(B.articles(spark, sf), _updates(spark, sf), F.expr(_APPLIED_AT))
    return _applied_columns(applied)


@query(
    f"""WITH {B.ART}, {_UPDATES}, shifted AS (SELECT CASE WHEN CAST(article_id AS BIGINT) % 4 = 0
      THEN 'x' || article_id ELSE article_id END AS article_id, score FROM updates)
    SELECT article_id, score FROM shifted WHERE article_id NOT IN (SELECT CAST(id AS VARCHAR) FROM art)"""
)
def score_unmatched(spark, sf):
    moved = F.when(
        F.col("article_id").cast("long") % 4 == 0, F.concat(F.lit("x"), "article_id")
    ).otherwise(F.col("article_id"))
    updates = _updates(spark, sf).withColumn("article_id", moved)
    return scoring.unmatched(updates, B.articles(spark, sf)).select("article_id", "score")


_OUTCOME_ID = "case when cast(article_id as bigint) % 7 = 0 then null " + (
    "when cast(article_id as bigint) % 4 = 0 then concat('x', article_id) else article_id end"
)
_UPDATE_OUTCOMES_SQL = f"""{B.ART}, {_UPDATES}, shifted AS (SELECT pos, {_OUTCOME_ID} AS article_id, score FROM updates),
    labelled AS (SELECT s.article_id, s.score, CASE WHEN s.article_id IS NULL THEN 'no_id'
      WHEN a.id IS NULL THEN 'not_found' WHEN a.clickbait_score IS NOT NULL THEN 'already_processed'
      ELSE 'updated' END AS outcome
      FROM shifted s LEFT JOIN art a ON CAST(a.id AS VARCHAR) = s.article_id)"""


def _shifted_updates(spark, sf):
    return _updates(spark, sf).withColumn("article_id", F.expr(_OUTCOME_ID))


@query(f"WITH {_UPDATE_OUTCOMES_SQL} SELECT article_id, score, outcome FROM labelled")
def update_outcomes(spark, sf):
    labelled = scoring.update_outcomes(_shifted_updates(spark, sf), B.articles(spark, sf))
    return labelled.select("article_id", "score", "outcome")


_LIVE_SQL = f"""WITH {B.ART}, {_UPDATES}, {B.BATCHES}, live AS (SELECT u.* FROM updates u
      JOIN res r USING (pos) WHERE r.batch_id NOT IN (SELECT batch_id FROM batches
      WHERE status = 'completed'))
    SELECT a.id, a.title, coalesce(a.clickbait_score, u.score) AS clickbait_score,
    coalesce(a.clickbait_explanation, u.explanation) AS clickbait_explanation,
    CASE WHEN a.clickbait_score IS NULL AND u.score IS NOT NULL THEN '2024-06-01 00:00:00' END
      AS updated_at
    FROM art a LEFT JOIN live u ON CAST(a.id AS VARCHAR) = u.article_id"""


def _article_table(spark, sf):
    """The articles written as a table laid out by local date."""
    path = new_path(spark, "articles")
    rows = B.feed(spark, sf).select(*B.articles(spark, sf).columns, "naver_url", "published_at")
    tables.append_articles(rows, path)
    return path


@query(_LIVE_SQL)
def job_apply_results(spark, sf):
    path = _article_table(spark, sf)
    result = jobs.read_results(
        B.result_lines(spark, sf).drop("payload"),
        tables.read_table(spark, path),
        B.batches(spark, sf),
    )
    jobs.save_scores(path, result.updates, F.expr(_APPLIED_AT))
    return _applied_columns(tables.read_table(spark, path))


@query(
    f"""WITH {_UPDATE_OUTCOMES_SQL} SELECT count(*) FILTER (WHERE outcome = 'updated') AS updated,
    count(*) FILTER (WHERE outcome = 'already_processed') AS already_processed,
    count(*) FILTER (WHERE outcome = 'not_found') AS not_found,
    count(*) FILTER (WHERE outcome = 'no_id') AS no_id FROM labelled"""
)
def job_update_totals(spark, sf):
    """The totals that a run of score updates gathers while it writes."""
    totals = jobs.save_scores(_article_table(spark, sf), _shifted_updates(spark, sf), F.expr(_APPLIED_AT))
    kind = "updated long, already_processed long, not_found long, no_id long"
    return spark.createDataFrame([astuple(totals)], kind)


@query(_LIVE_SQL)
def stream_score_apply(spark, sf):
    """The lines come in two pieces that part a batch."""
    path, source, state = _article_table(spark, sf), new_path(spark, "stream-lines"), new_path(spark, "stream-state")
    lines = B.result_lines(spark, sf).drop("payload")
    counts = lines.where(text.strip(F.col("value")) != "").groupBy("batch_id").agg(F.count(F.lit(1)).alias("article_count"))
    batches = B.batches(spark, sf).join(counts, "batch_id")
    for k, piece in enumerate(_pieces(lines, "pos", 2)):
        piece.write.parquet(f"{source}/piece={k}")
        rows = streams.read_files(spark, f"{source}/*", lines.schema)
        streams.complete_score_stream(rows, path, batches, state, F.expr(_APPLIED_AT)).awaitTermination()
    return _applied_columns(tables.read_table(spark, path))


_CLEANSE = [
    "case when event_id % 11 = 0 then null else event_id end as article_id",
    "value as score",
    "case event_id % 4 when 0 then '  ' when 1 then null when 2 then repeat(props, 60) "
    "else concat(' ', props, ' ') end as explanation",
]


@query(
    f"""WITH u AS (SELECT {', '.join(_CLEANSE)} FROM events)
    SELECT article_id, CAST(round_even(score, 0) AS INTEGER) AS score,
      substr(coalesce(nullif(trim(explanation), ''), '자동 생성된 점수'), 1, 500) AS explanation
    FROM u WHERE article_id IS NOT NULL AND score BETWEEN 0 AND 100"""
)
def update_cleanse(spark, sf):
    return scoring.cleanse_updates(B.table(spark, sf, "events").selectExpr(*_CLEANSE))


@query(
    f"""WITH u AS (SELECT {', '.join(_CLEANSE)} FROM events)
    SELECT article_id, CAST(round_even(score, 0) AS INTEGER) AS score,
      coalesce(nullif(trim(explanation), ''), '자동 생성된 점수') AS explanation
    FROM u WHERE article_id IS NOT NULL AND score BETWEEN 0 AND 100"""
)
def update_cleanse_full(spark, sf):
    return scoring.cleanse_updates(B.table(spark, sf, "events").selectExpr(*_CLEANSE), None)


@query(
    f"""WITH {B.FEED} SELECT id, 7 + (CASE WHEN clickbait_score IS NULL THEN 0 ELSE 2 END) AS n_fields,
    title, content, CAST(clickbait_score AS VARCHAR) AS score,
    strftime(local_at, '%Y-%m-%dT%H:%M:%S') || '+09:00' AS published_at FROM feed"""
)
def record_json(spark, sf):
    rows = B.feed(spark, sf).withColumn("journalist_id", F.lit(None).cast("string"))
    made = rows.select("id", records.article_record().alias("r"))
    return made.select(
        "id",
        F.size(F.json_object_keys("r")).alias("n_fields"),
        F.get_json_object("r", "$.title").alias("title"),
        F.get_json_object("r", "$.content").alias("content"),
        F.get_json_object("r", "$.clickbait_score").alias("score"),
        F.get_json_object("r", "$.published_at").alias("published_at"),
    )


# --- batches -----------------------------------------------------------------------------------------------


@query(
    f"""WITH {B.LOG}, l AS (SELECT *, lag(status) OVER (PARTITION BY batch_id ORDER BY ts, event_id)
      AS previous FROM blog)
    SELECT event_id, batch_id, status, previous, CASE WHEN previous IS NULL THEN 'first'
      WHEN previous = status THEN 'unchanged'
      WHEN previous = 'in_progress' OR (previous = 'failed' AND status = 'in_progress') THEN 'valid'
      ELSE 'invalid' END AS verdict FROM l"""
)
def status_transition_audit(spark, sf):
    audited = scoring.audit_status_changes(B.status_log(spark, sf))
    return audited.select("event_id", "batch_id", "status", "previous", "verdict")


@query(
    f"""WITH {B.BATCH_TABLE} SELECT batch_id, article_count,
    strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at FROM batch WHERE status = 'in_progress'"""
)
def active_batches(spark, sf):
    active = scoring.active_batches(B.batch_table(spark, sf))
    return active.select(
        "batch_id", "article_count", F.date_format("created_at", TS_FORMAT).alias("created_at")
    )


@query(
    f"""WITH {B.BATCH_TABLE} SELECT batch_id FROM batch WHERE status = 'in_progress'
    ORDER BY created_at, batch_id LIMIT 1"""
)
def oldest_active_batch(spark, sf):
    return scoring.oldest_active(B.batch_table(spark, sf)).select("batch_id")


@query(
    f"WITH {B.BATCH_TABLE} SELECT count(*) FILTER (WHERE status = 'in_progress') > 0 AS any_active FROM batch"
)
def any_active_batch(spark, sf):
    return scoring.any_active(B.batch_table(spark, sf))


@query(
    f"""WITH {B.BATCH_TABLE} SELECT count(*) AS total, count(*) FILTER (WHERE status = 'completed')
    AS completed, count(*) FILTER (WHERE status = 'in_progress') AS in_progress,
    count(*) FILTER (WHERE status IN ('failed', 'cancelled')) AS failed FROM batch"""
)
def batch_rollup(spark, sf):
    return scoring.batch_rollup(B.batch_table(spark, sf))


@query(
    f"""WITH {B.BATCH_TABLE} SELECT batch_id, status, article_count, true AS recovered FROM batch
    WHERE batch_id % 5 = 0"""
)
def orphan_batches(spark, sf):
    remote = B.batch_table(spark, sf)
    found = scoring.orphan_batches(remote, remote.where("batch_id % 5 <> 0"))
    return found.select("batch_id", "status", "article_count", "recovered")
