"""End-to-end jobs: ingest, request build, result apply, statistics sync, duplicate merge."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from presswork import schemas
from presswork import settings as S
from presswork.operators import dedup, feed, journalists, scoring, skew, stats
from presswork.session import materialise, new_path
from presswork.sources import jsonl, partitions, tables, url_index


@dataclass
class IngestResult:
    """Frames of one ingest; nothing is written until the caller does so."""

    new_articles: DataFrame
    new_journalists: DataFrame
    rejected: DataFrame
    outcomes: DataFrame


def ingest(
    items: DataFrame,
    pages: DataFrame,
    stored_articles: DataFrame,
    stored_journalists: DataFrame,
    day: date | None = None,
    scope: tuple[str, ...] = ("keyword",),
    extracted: bool = False,
    limit: int | None = S.MAX_CONTENT_LENGTH,
) -> IngestResult:
    """Search items and fetched pages to new articles and journalists.

    ``items`` has the search-item columns, ``keyword`` and a ``position`` that is unique and
    follows feed order. ``pages`` has ``naver_url`` and ``html``, or the extracted fields. Bodies
    are cut at ``limit`` characters; None keeps all of them.
    """
    linked = feed.news_links(items)
    fields = pages if extracted else feed.extract_pages(pages, limit=limit)
    usable = feed.one_per_url(feed.usable_pages(fields))
    combined = feed.with_reject_reason(feed.combine(linked, usable))
    # Read several times below, and the page join is the most expensive step.
    checked = materialise(combined, "ingest-checked")
    valid = checked.where(F.col("reject_reason").isNull()).drop("reject_reason")
    dated = valid if day is None else feed.until_older(valid, day, scope)
    unique = dedup.feed_dedup(dated, scope=scope)
    return admit(dated, unique, stored_articles, stored_journalists, checked.where(F.col("reject_reason").isNotNull()))


def admit(
    valid: DataFrame,
    unique: DataFrame,
    stored_articles: DataFrame,
    stored_journalists: DataFrame,
    rejected: DataFrame,
) -> IngestResult:
    """New articles and journalists of ``unique``, those rows of ``valid`` that repeat no other."""
    narrow = unique.select("position", "naver_url")
    labelled = materialise(
        dedup.insert_outcomes(narrow, stored_articles).select("position", "outcome"),
        "ingest-outcomes",
    )
    chosen = labelled.where(F.col("outcome") == "inserted").select("position")
    inserted = valid.join(chosen, "position", "left_semi")
    known = journalists.resolve(inserted, stored_journalists)
    with_ids = journalists.attach_ids(
        inserted.withColumn("id", F.sha2("naver_url", 256)), known
    )
    columns = [
        "id", "title", "content", "journalist_id", "journalist_name", "publisher",
        "published_at", "naver_url",
    ]
    return IngestResult(
        new_articles=with_ids.select(*columns),
        new_journalists=journalists.new_journalists(inserted, stored_journalists),
        rejected=rejected,
        outcomes=labelled.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")),
    )


def stored_among(items: DataFrame, urls_path: str, articles_path: str) -> DataFrame:
    """Stored URLs to ingest ``items`` against, from the side table of URLs.

    What an ingest that stopped left open is completed first.
    """
    url_index.recover(items.sparkSession, urls_path, articles_path)
    return url_index.among(feed.news_links(items).select("naver_url"), urls_path)


def save_ingest(
    result: IngestResult,
    articles_path: str,
    journalists_path: str,
    asof: Column | None = None,
    urls_path: str | None = None,
) -> None:
    """Append journalists, then articles, with every column of their tables.

    ``asof`` (now, if not given) is their ``created_at`` and ``updated_at``; scores are null.
    ``urls_path`` is the side table of stored URLs, if there is one (see ``stored_among``).

    After a failure run the ingest again on the tables as they are: what was already written
    is found stored and not added twice.
    """
    times = {name: F.current_timestamp() if asof is None else asof for name in ("created_at", "updated_at")}
    people = tables.conform(result.new_journalists.withColumns(times), schemas.JOURNALIST)
    texts = tables.conform(result.new_articles.withColumns(times), schemas.ARTICLE)
    people, texts = materialise(people, "new-journalists"), materialise(texts, "new-articles")
    tables.append_journalists(people, journalists_path)
    noted = None if urls_path is None else url_index.announce(texts, urls_path)
    tables.append_articles(texts, articles_path)
    if urls_path is not None:
        url_index.settle(texts.sparkSession, noted, urls_path)


def build_requests(
    articles: DataFrame,
    path: str,
    size: int = S.MAX_BATCH_SIZE,
    all_batches: bool = False,
    limit: int | None = S.MAX_CONTENT_LENGTH,
) -> DataFrame:
    """Write request files for the oldest pending articles, or for all of them in batches.

    Returns id and batch number of the written requests. Prompts cut bodies at ``limit``
    characters; None keeps them whole.
    """
    if all_batches:
        numbers = materialise(scoring.number_batches(articles, size), "batch-numbers")
        chosen = articles.join(numbers, "id")
    else:
        numbers = materialise(
            scoring.oldest_pending(articles.select("id", "created_at", "clickbait_score"), size)
            .select("id", F.lit(0).cast("long").alias("batch_no")),
            "batch-numbers",
        )
        # At most one batch of ids.
        chosen = articles.join(F.broadcast(numbers), "id")
    jsonl.write_requests(scoring.build_requests(chosen, limit=limit), path)
    return numbers.select("id", "batch_no")


@dataclass
class ApplyResult:
    updates: DataFrame
    verdicts: DataFrame
    unmatched: DataFrame


def read_results(lines: DataFrame, articles: DataFrame, batches: DataFrame) -> ApplyResult:
    """Result lines to one update per unscored article, batch verdicts and unmatched ids."""
    fresh = scoring.skip_completed(lines, batches)
    parsed = materialise(scoring.parse_results(jsonl.parse_result_lines(fresh)), "results")
    updates = scoring.one_update_per_article(scoring.strict_updates(parsed), batches)
    narrow = articles.select("id", "clickbait_score")
    return ApplyResult(
        updates=scoring.not_yet_scored(updates, narrow),
        verdicts=scoring.batch_verdicts(parsed),
        unmatched=scoring.unmatched(updates, narrow),
    )


@dataclass
class UpdateTotals:
    """What became of the updates of one run, one per article."""

    updated: int
    already_processed: int
    not_found: int
    no_id: int


def save_scores(articles_path: str, updates: DataFrame, asof: Column) -> UpdateTotals:
    """Rewrite the days that hold an updated article; other days are not touched.

    The new days are staged first, so the table is never overwritten while it is read, and a
    rerun finds the articles scored. The totals are gathered while the rows are written.
    """
    spark = updates.sparkSession
    given, matched = Observation(), Observation()
    counted = updates.observe(
        given,
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.coalesce("article_id", F.lit("")) == "").alias("no_id"),
    )
    fresh = materialise(counted, "score-updates")
    n, no_id = given.get["n"], given.get["no_id"]
    articles = tables.read_table(spark, articles_path)
    ids = skew.broadcast_if_small(fresh.select(F.col("article_id").alias("id")))
    days = articles.select(F.col("id").cast("string"), "local_date").join(ids, "id", "left_semi")
    # One value per calendar day.
    touched = [row.local_date for row in days.select("local_date").distinct().collect()]
    if not touched:
        return UpdateTotals(0, 0, n - no_id, no_id)
    part = articles.where(partitions.among("local_date", touched))
    staged = materialise(
        scoring.apply_scores(part, skew.broadcast_if_small(fresh), asof, matched), "scored-days"
    )
    tables.replace_days(staged, articles_path)
    updated, already = matched.get["updated"], matched.get["already_processed"]
    return UpdateTotals(updated, already, n - no_id - updated - already, no_id)


@dataclass
class SyncResult:
    journalists: DataFrame
    fixes: DataFrame
    updates: DataFrame | None
    changes: DataFrame


def sync_statistics(
    journalist_table: DataFrame,
    articles: DataFrame,
    fix: bool = True,
    full_update: bool = False,
    mode: str = "full_mean",
) -> SyncResult:
    """Audit and repair the statistics, recompute all if asked, and report the changes."""
    columns = journalist_table.columns
    narrow = articles.select("journalist_id", "clickbait_score")
    before = stats.summary(journalist_table, narrow)
    current, fixes, updates = journalist_table, None, None
    if fix:
        repaired = materialise(stats.repair(stats.audit(current, narrow, mode)), "repaired")
        fixes = stats.repair_totals(repaired)
        current = repaired.select(*columns)
    if full_update:
        refreshed = materialise(stats.all_journalist_statistics(current, narrow), "refreshed")
        updates = stats.update_totals(refreshed)
        current = refreshed.select(*columns)
    changes = stats.deltas(before, stats.summary(current, narrow))
    return SyncResult(current, fixes, updates, changes)


def save_statistics(journalists_path: str, fresh: DataFrame, asof: Column) -> None:
    """Store the statistics of ``fresh`` (a ``SyncResult``'s journalists) in the journalist table.

    Only buckets that hold a journalist whose values differ are rewritten, and only its row gets
    ``asof`` as ``updated_at``. Journalists the table does not have are not added. A run that
    stopped in between is completed first; a rerun finds nothing to change.
    """
    spark = fresh.sparkSession
    partitions.finish(spark, journalists_path)
    names = stats.STORED
    values = [F.col(name).cast(schemas.JOURNALIST[name].dataType).alias(f"_{name}") for name in names]
    new = fresh.select(F.col("id").cast("string"), *values)
    differs = F.lit(False)
    for name in names:
        differs = differs | ~F.col(name).eqNullSafe(F.col(f"_{name}"))
    stored = tables.read_table(spark, journalists_path, schemas.JOURNALIST_TABLE)
    changed = stored.join(new, "id").where(differs).select("id", "bucket", *[f"_{name}" for name in names])
    changed = materialise(changed, "changed-statistics")
    touched = [row.bucket for row in changed.select("bucket").distinct().collect()]
    updates = changed.drop("bucket").withColumn("_new", F.lit(True))

    def updated(part: DataFrame) -> DataFrame:
        joined = part.join(skew.broadcast_if_small(updates), "id", "left")
        take = {**{name: F.col(f"_{name}") for name in names}, "updated_at": asof.cast("timestamp")}
        return joined.select(
            *[F.when(F.col("_new"), take[c]).otherwise(F.col(c)).alias(c) if c in take else F.col(c) for c in part.columns]
        )

    partitions.replace(spark, journalists_path, "bucket", touched, updated, schemas.JOURNALIST_TABLE)


@dataclass
class MergeResult:
    totals: DataFrame
    survivors: DataFrame | None


def merge_duplicates(articles: DataFrame, dry_run: bool = False) -> MergeResult:
    """Totals of the duplicate merge and, unless it is a dry run, the remaining articles."""
    return MergeResult(
        totals=dedup.merge_totals(articles),
        survivors=None if dry_run else dedup.survivors(articles),
    )


def delete_duplicates(spark: SparkSession, articles_path: str) -> int:
    """Delete the losers of every duplicate group from the article table; how many there were.

    Only days that hold a loser are rewritten: first staged, then put in place day by day. A run
    that stopped anywhere is completed by the next one, which then looks for what is left.
    """
    partitions.finish(spark, articles_path)
    articles = tables.read_table(spark, articles_path)
    lost = materialise(dedup.losers(articles).select("id"), "losers")
    ids = skew.broadcast_if_small(lost)
    days = articles.select("id", "local_date").join(ids, "id", "left_semi").select("local_date").distinct()
    # One value per calendar day.
    touched = [row.local_date for row in days.collect()]
    partitions.replace(spark, articles_path, "local_date", touched, lambda part: part.join(ids, "id", "left_anti"))
    return lost.count()


def write_new_version(df: DataFrame, name: str, folder: str | None = None) -> str:
    """Write a table version to a fresh path and return the path for the reader to switch to.

    ``folder`` is where the table's versions live. Without it the version goes to the working
    folder, whose contents may expire: enough for a test, not for a table that is to stay.
    """
    path = new_path(df.sparkSession, name) if folder is None else f"{folder}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path
