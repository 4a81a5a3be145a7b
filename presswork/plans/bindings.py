"""Article-shaped views over the driver's tables.

Each view comes twice: as a DataFrame and as the SQL of the same rows for the oracle. Both
read the whole source table, but for ``news_pages``, in which the pages of some URLs are missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork import settings as S
from presswork.functions.dates import instant_of
from presswork.functions.text import WHITESPACE, normalize_url
from presswork.operators import stats

CUE_WORDS = ["the", "and", "der", "que", "les", "SNS"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- articles ------------------------------------------------------------------------------------


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One article per document; labelled documents are scored, the others pending."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    score = F.expr("cast((n_chars * 31 + quality * 7 + toxic * 13 + doc_id) % 101 as int)")
    joined = docs.join(labels.withColumn("labelled", F.lit(True)), "doc_id", "left")
    return _as_articles(joined, F.when(F.col("labelled"), score), F.when(F.col("labelled"), F.lit("stored")))


def unscored_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same articles with neither score nor the join that it takes."""
    return _as_articles(table(spark, sf_dir, "documents"), F.lit(None).cast("int"), F.lit(None).cast("string"))


def _as_articles(docs: DataFrame, score: Column, explanation: Column) -> DataFrame:
    return docs.select(
        F.col("doc_id").alias("id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("content"),
        F.expr(
            "case n_chars % 11 when 0 then '' when 1 then '익명' else concat('j', n_chars % 11) end"
        ).alias("journalist_name"),
        F.expr("concat('press', n_chars % 7)").alias("publisher"),
        score.alias("clickbait_score"),
        explanation.alias("clickbait_explanation"),
        F.expr(
            "timestamp_ntz'2024-01-01 00:00:00' + "
            "make_dt_interval(0, 0, 0, cast(doc_id * 60 as decimal(18, 6)))"
        ).alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )


ART = """art AS (
  SELECT d.doc_id AS id, split_part(d.text, chr(10), 1) AS title, d.text AS content,
    CASE d.n_chars % 11 WHEN 0 THEN '' WHEN 1 THEN '익명' ELSE 'j' || (d.n_chars % 11) END
      AS journalist_name,
    'press' || (d.n_chars % 7) AS publisher,
    CASE WHEN l.doc_id IS NOT NULL THEN
      CAST((d.n_chars * 31 + l.quality * 7 + l.toxic * 13 + d.doc_id) % 101 AS INTEGER) END
      AS clickbait_score,
    CASE WHEN l.doc_id IS NOT NULL THEN 'stored' END AS clickbait_explanation,
    TIMESTAMP '2024-01-01 00:00:00' + to_minutes(d.doc_id) AS created_at
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

# --- feed: articles with link, publication time and keyword ------------------------------------------

_LINK = (
    "concat('https://n.news.naver.com/mnews/article/001/', "
    "case when id % 10 = 9 then id - 1 else id end, "
    "case id % 4 when 0 then '?sid=1' when 1 then '/' when 2 then '#c' else '' end)"
)
_LINK_SQL = (
    "'https://n.news.naver.com/mnews/article/001/' || "
    "(CASE WHEN id % 10 = 9 THEN id - 1 ELSE id END) || "
    "(CASE id % 4 WHEN 0 THEN '?sid=1' WHEN 1 THEN '/' WHEN 2 THEN '#c' ELSE '' END)"
)


def feed(spark: SparkSession, sf_dir: str, scored: bool = True) -> DataFrame:
    """Articles in feed order, newest first, with one row in 97 three days late."""
    rows = articles(spark, sf_dir) if scored else unscored_articles(spark, sf_dir)
    late = "case when id % 97 = 50 then 3 * 86400 else 0 end"
    words = ", ".join(f"'{w}'" for w in S.DEFAULT_KEYWORDS)
    return (
        rows.withColumn("position", F.col("id"))
        .withColumn("link", F.expr(_LINK))
        .withColumn("naver_url", normalize_url(F.col("link")))
        .withColumn(
            "local_at",
            F.expr(
                "timestamp_ntz'2024-03-01 00:00:00' - "
                f"make_dt_interval(0, 0, 0, cast(id * 1020 + {late} as decimal(18, 6)))"
            ),
        )
        .withColumn("published_at", instant_of(F.col("local_at")))
        .withColumn("keyword", F.expr(f"element_at(array({words}), cast(id % 10 as int) + 1)"))
    )


FEED = (
    ART
    + f""",
feed0 AS (SELECT *, id AS position, {_LINK_SQL} AS link,
    TIMESTAMP '2024-03-01 00:00:00' - to_minutes(id * 17)
      - to_days(CASE WHEN id % 97 = 50 THEN 3 ELSE 0 END) AS local_at,
    list_extract([{', '.join(f"'{w}'" for w in S.DEFAULT_KEYWORDS)}], CAST(id % 10 AS INTEGER) + 1)
      AS keyword
  FROM art),
feed AS (SELECT *, regexp_replace(replace(regexp_replace(link, '[?#].*$', ''),
    '/mnews/article/', '/article/'), '/$', '') AS naver_url FROM feed0)"""
)


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search items: marked-up titles, some foreign links, publication time as text."""
    stamp = F.date_format("local_at", "EEE, dd MMM yyyy HH:mm:ss")
    return feed(spark, sf_dir, scored=False).select(
        "id",
        "position",
        "keyword",
        F.concat(F.lit("&lt;b&gt;"), "title", F.lit("&lt;/b&gt;")).alias("title"),
        F.split_part("content", F.lit("\n"), F.lit(2)).alias("description"),
        F.concat(F.lit("https://example.com/news/"), "id").alias("originallink"),
        F.when(F.col("id") % 13 == 0, F.concat(F.lit("https://example.com/news/"), "id"))
        .otherwise(F.col("link"))
        .alias("link"),
        F.concat(stamp, F.lit(" +0900")).alias("pubDate"),
    )


ITEMS = (
    FEED
    + """,
items AS (SELECT id, position, keyword, '&lt;b&gt;' || title || '&lt;/b&gt;' AS title,
    split_part(content, chr(10), 2) AS description,
    'https://example.com/news/' || id AS originallink,
    CASE WHEN id % 13 = 0 THEN 'https://example.com/news/' || id ELSE link END AS link,
    strftime(local_at, '%a, %d %b %Y %H:%M:%S') || ' +0900' AS pubDate, local_at
  FROM feed)"""
)


def every_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article pages in the news site's markup, one per document."""

    def escaped(name: str) -> str:
        return f"replace(replace(replace({name}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"

    card = (
        "concat('<div class=\"media_journalistcard_item_inner\"><div><em class="
        "\"media_journalistcard_summary_name_text\">', journalist_name, '{}기자</em></div></div>')"
    )
    reporter = (
        "case id % 3 when 0 then concat('<span class=\"byline_s\">', journalist_name, "
        "' 기자 r', id, '@example.com</span><span class=\"byline_s\">other</span>') "
        f"when 1 then concat({card.format('')}, {card.format('2 ')}) else '' end"
    )
    html = (
        "concat('<html><body><script>var s=\"<h2 id=\\'title_area\\'>no</h2>\";</script>"
        "<!-- <h2 id=\"title_area\">no</h2> --><h2 id=\"title_area\" class=\"x\">', "
        + escaped("title")
        + ", '</h2><span class=\"media_end_head_top_logo_text\"> ', publisher, ' </span>', "
        + reporter
        + ", '<div class=\"y\" id=\"dic_area\"><div>', "
        + escaped("content")
        + ", '</div><style>p{}</style><div></div></div><div>tail</div></body></html>')"
    )
    return feed(spark, sf_dir, scored=False).select("id", "naver_url", F.expr(html).alias("html"))


def news_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article pages as fetched; some URLs have none."""
    return every_page(spark, sf_dir).where("id % 10 <> 9 and id % 5 <> 0")


_SPACES = "'" + WHITESPACE + "'"


def sql_strip(column: str) -> str:
    return f"trim({column}, {_SPACES})"


def sql_clean(column: str, limit: int | None = S.MAX_CONTENT_LENGTH) -> str:
    whole = sql_strip(f"regexp_replace({column}, '\\n{{2,}}', chr(10), 'g')")
    return whole if limit is None else f"substr({whole}, 1, {limit})"


NEWS_PAGES = (
    ITEMS
    + f""",
news_pages AS (SELECT id, naver_url, {sql_strip('title')} AS page_title,
    publisher AS page_publisher,
    CASE id % 3 WHEN 0 THEN journalist_name
      WHEN 1 THEN journalist_name || ',' || journalist_name || '2' ELSE '' END AS page_reporter,
    {sql_clean('content')} AS page_content
  FROM feed WHERE id % 10 <> 9 AND id % 5 <> 0)"""
)

EVERY_PAGE = (
    ITEMS
    + f""",
every_page AS (SELECT id, naver_url, {sql_strip('title')} AS page_title,
    publisher AS page_publisher,
    CASE id % 3 WHEN 0 THEN journalist_name
      WHEN 1 THEN journalist_name || ',' || journalist_name || '2' ELSE '' END AS page_reporter,
    {sql_clean('content')} AS page_content
  FROM feed)"""
)

# --- scores per journalist -----------------------------------------------------------------------------


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scored or pending article per event; the user is the journalist."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("journalist_id"),
        F.expr("case when event_type <> 'error' then cast(floor(value) as bigint) % 101 end").alias(
            "clickbait_score"
        ),
        "ts",
    )


EV = """ev AS (SELECT event_id AS id, user_id AS journalist_id,
    CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS BIGINT) % 101 END AS clickbait_score,
    ts FROM events)"""

STATS = (
    EV
    + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY journalist_id
    ORDER BY clickbait_score DESC NULLS LAST) AS rn FROM ev),
stats AS (SELECT journalist_id, count(*) AS article_count, count(clickbait_score) AS scored_count,
    coalesce(round_even(avg(clickbait_score) FILTER (WHERE rn <= 10), 2), 0.0)
      AS avg_clickbait_score,
    coalesce(avg(clickbait_score), 0.0) AS mean_score,
    coalesce(max(clickbait_score), 0) AS max_score
  FROM ranked GROUP BY journalist_id)"""
)


def stored_journalists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored statistics with planted errors, and a few journalists without any article."""
    actual = stats.journalist_statistics(scores(spark, sf_dir))
    key = F.col("journalist_id")
    planted = actual.select(
        key.alias("id"),
        F.concat(F.lit("j"), key).alias("name"),
        F.concat(F.lit("press"), key % 7).alias("publisher"),
        (F.col("article_count") + F.when(key % 7 == 0, 1).otherwise(0)).alias("article_count"),
        (F.col("avg_clickbait_score") + F.when(key % 7 == 1, 0.02).otherwise(0.0)).alias(
            "avg_clickbait_score"
        ),
        (F.col("max_score") - F.when(key % 7 == 2, 2).otherwise(0)).alias("max_score"),
    )
    ghosts = planted.where("id % 10 = 3").select(
        (F.col("id") + 1_000_000_000).alias("id"),
        "name",
        F.lit("closed").alias("publisher"),
        F.lit(2).cast("long").alias("article_count"),
        F.lit(1.0).alias("avg_clickbait_score"),
        F.lit(1).cast("long").alias("max_score"),
    )
    return planted.unionByName(ghosts)


STORED = (
    STATS
    + """,
planted AS (SELECT journalist_id AS id, 'j' || journalist_id AS name,
    'press' || (journalist_id % 7) AS publisher,
    article_count + CASE WHEN journalist_id % 7 = 0 THEN 1 ELSE 0 END AS article_count,
    avg_clickbait_score + CASE WHEN journalist_id % 7 = 1 THEN 0.02 ELSE 0.0 END
      AS avg_clickbait_score,
    max_score - CASE WHEN journalist_id % 7 = 2 THEN 2 ELSE 0 END AS max_score FROM stats),
stored AS (SELECT * FROM planted UNION ALL
  SELECT id + 1000000000, name, 'closed', 2, CAST(1.0 AS DOUBLE), 1 FROM planted WHERE id % 10 = 3),
audited AS (SELECT s.*, coalesce(a.article_count, 0) AS actual_count,
    coalesce(a.mean_score, 0.0) AS actual_avg, coalesce(a.avg_clickbait_score, 0.0) AS top_avg,
    coalesce(a.max_score, 0) AS actual_max,
    s.article_count <> coalesce(a.article_count, 0) OR s.max_score <> coalesce(a.max_score, 0)
      AS other_mismatch
  FROM stored s LEFT JOIN stats a ON s.id = a.journalist_id)"""
)

# --- result lines ---------------------------------------------------------------------------------------


def result_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result lines of every article: clean batches (one in three) and faulty ones."""
    payload = """case
      when batch_no % 3 = 0 or id % 8 = 0 then
        concat('{"clickbait_score": ', id % 101, ', "clickbait_explanation": " why ', id, ' ", "x": 1}')
      when id % 8 = 1 then 'not json'
      when id % 8 = 2 then '{"clickbait_score": true, "clickbait_explanation": "t"}'
      when id % 8 = 3 then '{"clickbait_score": 75.0, "clickbait_explanation": "t"}'
      when id % 8 = 4 then '{"clickbait_score": "75", "clickbait_explanation": "t"}'
      when id % 8 = 5 then '{"clickbait_score": 150, "clickbait_explanation": "t"}'
      when id % 8 = 6 then '{"clickbait_score": 75}'
      else '{"clickbait_score": 75, "clickbait_explanation": "  "}' end"""
    faulty = (F.col("batch_no") % 3) != 0
    custom_id = F.concat(
        F.when(faulty & (F.col("id") % 40 == 9), "art_").otherwise("article_"), F.col("id")
    )
    choice = F.struct(F.struct(F.col("payload").alias("content")).alias("message"))
    choices = F.when(faulty & (F.col("id") % 40 == 19), F.slice(F.array(choice), 1, 0)).otherwise(
        F.array(choice)
    )
    line = F.to_json(
        F.struct(
            custom_id.alias("custom_id"),
            F.struct(F.struct(choices.alias("choices")).alias("body")).alias("response"),
        )
    )
    value = (
        F.when(F.col("id") % 50 == 7, F.concat(line, F.lit(" trailing")))
        .when(F.col("id") % 50 == 8, F.lit("   "))
        .otherwise(line)
    )
    return (
        table(spark, sf_dir, "documents")
        .select(F.col("doc_id").alias("id"), F.expr("doc_id div 100").alias("batch_no"))
        .withColumn("payload", F.expr(payload))
        .select(
            F.concat(F.lit("b"), "batch_no").alias("batch_id"),
            F.col("id").alias("pos"),
            "payload",
            value.alias("value"),
        )
    )


RES = """res0 AS (SELECT doc_id AS id, doc_id // 100 AS batch_no FROM documents),
res1 AS (SELECT *, CASE
    WHEN batch_no % 3 = 0 OR id % 8 = 0 THEN '{"clickbait_score": ' || (id % 101)
      || ', "clickbait_explanation": " why ' || id || ' ", "x": 1}'
    WHEN id % 8 = 1 THEN 'not json'
    WHEN id % 8 = 2 THEN '{"clickbait_score": true, "clickbait_explanation": "t"}'
    WHEN id % 8 = 3 THEN '{"clickbait_score": 75.0, "clickbait_explanation": "t"}'
    WHEN id % 8 = 4 THEN '{"clickbait_score": "75", "clickbait_explanation": "t"}'
    WHEN id % 8 = 5 THEN '{"clickbait_score": 150, "clickbait_explanation": "t"}'
    WHEN id % 8 = 6 THEN '{"clickbait_score": 75}'
    ELSE '{"clickbait_score": 75, "clickbait_explanation": "  "}' END AS payload FROM res0),
res2 AS (SELECT *, CASE WHEN json_valid(payload) THEN payload END AS good_json FROM res1),
res3 AS (SELECT *, json_type(good_json, '$.clickbait_score') AS score_type,
    json_type(good_json, '$.clickbait_explanation') AS text_type,
    TRY_CAST(json_extract_string(good_json, '$.clickbait_score') AS INTEGER) AS raw_score,
    trim(json_extract_string(good_json, '$.clickbait_explanation')) AS raw_text FROM res2),
res4 AS (SELECT *, coalesce(score_type IN ('UBIGINT', 'BIGINT') AND raw_score BETWEEN 0 AND 100
    AND text_type = 'VARCHAR' AND raw_text <> '', false) AS valid FROM res3),
res AS (SELECT id AS pos, 'b' || batch_no AS batch_id, CAST(id AS VARCHAR) AS article_id, payload,
    valid, CASE WHEN valid THEN raw_score END AS score, CASE WHEN valid THEN raw_text END AS explanation,
    CASE WHEN id % 50 = 7 THEN 'malformed'
      WHEN batch_no % 3 <> 0 AND id % 40 = 9 THEN 'custom_id'
      WHEN batch_no % 3 <> 0 AND id % 40 = 19 THEN 'no_choices'
      WHEN NOT valid THEN 'payload' END AS error
  FROM res4 WHERE id % 50 <> 8),
verdicts AS (SELECT batch_id, count(*) AS n_lines,
    count(*) FILTER (WHERE error = 'malformed') AS n_malformed,
    count(*) FILTER (WHERE error <> 'malformed') AS n_errors,
    arg_min(error, pos) FILTER (WHERE error <> 'malformed') AS first_error,
    count(*) FILTER (WHERE error <> 'malformed') = 0 AND count(*) FILTER (WHERE error IS NULL) > 0
      AS applicable
  FROM res GROUP BY batch_id)"""


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored state of the result batches; one in four is completed."""
    return (
        table(spark, sf_dir, "documents")
        .select(F.expr("doc_id div 100").alias("no"))
        .distinct()
        .select(
            F.concat(F.lit("b"), "no").alias("batch_id"),
            F.expr("case when no % 4 = 0 then 'completed' else 'in_progress' end").alias("status"),
        )
    )


BATCHES = """batches AS (SELECT DISTINCT 'b' || (doc_id // 100) AS batch_id,
    CASE WHEN (doc_id // 100) % 4 = 0 THEN 'completed' ELSE 'in_progress' END AS status
  FROM documents)"""

# --- status log -------------------------------------------------------------------------------------------

_STATUS = (
    "case event_type when 'view' then 'in_progress' when 'signup' then 'in_progress' "
    "when 'purchase' then 'completed' when 'error' then 'failed' else 'cancelled' end"
)


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status changes of one batch per user."""
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", F.col("user_id").alias("batch_id"), F.expr(_STATUS).alias("status")
    )


LOG = f"blog AS (SELECT event_id, ts, user_id AS batch_id, {_STATUS} AS status FROM events)"


def batch_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current state of each batch of the log."""
    return (
        status_log(spark, sf_dir)
        .groupBy("batch_id")
        .agg(
            F.max_by("status", F.struct("ts", "event_id")).alias("status"),
            F.min("ts").alias("created_at"),
            F.count(F.lit(1)).alias("article_count"),
        )
    )


BATCH_TABLE = (
    LOG
    + """,
batch AS (SELECT batch_id, arg_max(status, ts) AS status, min(ts) AS created_at,
    count(*) AS article_count FROM blog GROUP BY batch_id)"""
)
