"""From search items and fetched pages to validated articles."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork import settings as S
from presswork.functions import dates, html, text, validation
from presswork.functions.once import computed_once
from presswork.operators import skew


def news_links(items: DataFrame, fragment: str = S.LINK_FRAGMENT) -> DataFrame:
    """Items whose link is on the news site, with the normalised URL."""
    return items.where(F.contains("link", F.lit(fragment))).withColumn(
        "naver_url", text.normalize_url(F.col("link"))
    )


def extract_pages(
    pages: DataFrame,
    title_rules: Sequence[html.Rule] = html.TITLE_RULES,
    publisher_rules: Sequence[html.Rule] = html.PUBLISHER_RULES,
    content_rules: Sequence[html.Rule] = html.CONTENT_RULES,
    limit: int | None = S.MAX_CONTENT_LENGTH,
) -> DataFrame:
    """Title, publisher, reporter and body of each page (columns ``url``, ``html``).

    The page is searched once for the start tags of all fields. No shuffle, one pass. The body
    is cut at ``limit`` characters; None keeps all of it.
    """
    rest = [c for c in pages.columns if c != "html"]
    rules = [*title_rules, *publisher_rules, *content_rules, html.BYLINE_RULE, html.CARD_RULE]
    page, tags = F.col("_page"), F.col("_tags")
    markup = pages.select(*rest, computed_once(html.visible_markup(F.col("html")).alias("_page")))
    tagged = markup.select(*rest, page, computed_once(html.start_tags(page, rules).alias("_tags")))
    return tagged.select(
        *rest,
        computed_once(
            html.extract_title(page, title_rules, tags).alias("page_title"),
            html.extract_publisher(page, publisher_rules, tags).alias("page_publisher"),
            html.extract_reporter(page, tags).alias("page_reporter"),
            html.extract_content(page, content_rules, tags, limit).alias("page_content"),
        ),
    )


def usable_pages(extracted: DataFrame) -> DataFrame:
    """Pages that count as fetched: title and body are there and pass the length checks."""
    reason = validation.article_reject_reason(
        F.col("page_title"),
        F.col("page_content"),
        F.lit(S.URL_PREFIXES[0]),
        F.lit(None).cast("int"),
    )
    return extracted.where(reason.isNull())


def one_per_url(pages: DataFrame, fetched: str = "fetched_at") -> DataFrame:
    """One page per ``naver_url``, the same one on every run, so that a join adds no rows.

    The page fetched last wins, if there is a column ``fetched`` (a page without a time loses to
    any with one); it is not kept. Ties, and pages without that column, go to the smallest fields.
    """
    page = F.struct(*[c for c in pages.columns if c not in ("naver_url", fetched)]).alias("page")
    order = []
    if fetched in pages.columns:
        order = [F.col(fetched).isNull().alias("unknown"), (-F.unix_micros(F.col(fetched).cast("timestamp"))).alias("age")]
    best = F.min(F.struct(*order, page)).alias("_best")
    return pages.groupBy("naver_url").agg(best).select("naver_url", "_best.page.*")


def combine(items: DataFrame, pages: DataFrame, hot_rows: int = skew.HOT_ROWS) -> DataFrame:
    """Join items to their pages; page fields win, empty ones fall back to the item.

    ``items`` needs ``position`` (unique) and ``naver_url``; ``pages`` is keyed by ``naver_url``.
    """
    joined = skew.salted_join(
        items, pages, ["naver_url"], "left", spread=["position"], hot_rows=hot_rows
    )

    def prefer(page: str, fallback: Column) -> Column:
        return F.coalesce(text.blank_to_null(F.col(page)), fallback)

    publisher = text.normalize_publisher(prefer("page_publisher", F.lit(S.DEFAULT_PUBLISHER)))
    reporter = prefer("page_reporter", F.lit(S.DEFAULT_REPORTER))
    description = text.strip_entities(F.col("description"))
    return (
        joined.withColumn("title", prefer("page_title", text.strip_entities(F.col("title"))))
        .withColumn("raw_content", prefer("page_content", description))
        .withColumn("content", validation.padded_content(F.col("raw_content"), description))
        .withColumn("publisher", publisher)
        .withColumn("journalist_name", text.normalize_name(reporter, F.col("publisher")))
        .withColumn("published_at", dates.parse_rfc822(F.col("pubDate")))
        .drop("page_title", "page_content", "page_publisher", "page_reporter", "raw_content")
    )


def with_reject_reason(articles: DataFrame, prefixes: list[str] | None = None) -> DataFrame:
    """Add ``reject_reason``: the model's checks, then an unreadable publication time."""
    checked = validation.article_reject_reason(
        F.col("title"),
        F.col("content"),
        F.col("naver_url"),
        F.lit(None).cast("int"),
        prefixes,
    )
    late = F.when(F.col("published_at").isNull(), "published_at")
    return articles.withColumn("reject_reason", F.coalesce(checked, late))


def on_day(articles: DataFrame, day: date, zone: str = S.LOCAL_ZONE) -> DataFrame:
    """Rows of one local calendar day.

    Prunes partitions where the table is laid out by ``local_date``; otherwise a range on the
    instant lets the scan skip row groups.
    """
    if "local_date" in articles.columns:
        return articles.where(F.col("local_date") == F.lit(day))
    start = dates.instant_of(F.lit(day), zone)
    end = dates.instant_of(F.lit(day + timedelta(days=1)), zone)
    return articles.where((F.col("published_at") >= start) & (F.col("published_at") < end))


def until_older(
    articles: DataFrame,
    day: date,
    scope: Sequence[str],
    position: str = "position",
    zone: str = S.LOCAL_ZONE,
    hot_rows: int = skew.HOT_ROWS,
) -> DataFrame:
    """Per feed, the rows of ``day`` that come before the first older row.

    Needs one minimum per feed instead of a running window over it.
    """
    dated = articles.withColumn("_day", dates.local_date(F.col("published_at"), zone))
    stops = (
        dated.where(F.col("_day") < F.lit(day))
        .groupBy(*scope)
        .agg(F.min(position).alias("_stop"))
    )
    wanted = dated.where(F.col("_day") == F.lit(day)).drop("_day")
    bounded = skew.salted_join(
        wanted, stops, list(scope), "left", spread=[position], hot_rows=hot_rows
    )
    return bounded.where(F.col("_stop").isNull() | (F.col(position) < F.col("_stop"))).drop("_stop")


def newest_per_keyword(
    items: DataFrame,
    limit: int = S.ITEMS_PER_KEYWORD,
    order: Sequence[Column] | None = None,
    position: str = "position",
    salts: int = 32,
) -> DataFrame:
    """The ``limit`` newest items of each keyword, the service's own result cap."""
    newest = order or [F.desc("published_at"), F.asc(position)]
    return skew.top_k(items, ["keyword"], newest, limit, [position], salts)


def keyword_matches(
    articles: DataFrame, keywords: list[str] | None = None, column: str = "title"
) -> DataFrame:
    """One row per article and keyword found in ``column``; the keyword list is a parameter."""
    words = S.DEFAULT_KEYWORDS if keywords is None else keywords
    return articles.select(
        "id", F.explode(text.matching_keywords(F.col(column), words)).alias("keyword")
    )


def combined_keywords(
    spark: SparkSession, trends: DataFrame, defaults: list[str] | None = None
) -> DataFrame:
    """Distinct union of trend keywords and the default list."""
    words = S.DEFAULT_KEYWORDS if defaults is None else defaults
    fixed = spark.createDataFrame([(w,) for w in words], "keyword string")
    return trends.select("keyword").union(fixed).distinct()


def allowed_day(column: Column, asof: date, months: int = 3) -> Column:
    """True for a readable day within the accepted range before ``asof``."""
    return dates.in_window(dates.parse_day(column), F.lit(asof), months)
