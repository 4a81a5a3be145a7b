"""Scoring batches: building requests, reading results, applying scores, batch states."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from presswork import settings as S
from presswork.functions.once import computed_once
from presswork.functions.records import scoring_request
from presswork.functions.validation import cleansed_update, validate_payload
from presswork.operators import skew

# --- requests -----------------------------------------------------------------------------------


def pending(articles: DataFrame) -> DataFrame:
    return articles.where(F.col("clickbait_score").isNull())


def oldest_pending(articles: DataFrame, limit: int = S.MAX_BATCH_SIZE) -> DataFrame:
    """The ``limit`` oldest unscored articles; the size of one batch bounds the sort."""
    return pending(articles).orderBy("created_at", "id").limit(limit)


def number_batches(
    articles: DataFrame, size: int = S.MAX_BATCH_SIZE, partitions: int | None = None
) -> DataFrame:
    """Add ``rank`` and ``batch_no``: all pending articles, oldest first, ``size`` per batch.

    Only id and time are ranked; the texts join the result by id.
    """
    if not 1 <= size <= S.MAX_BATCH_SIZE:
        raise ValueError(f"batch size must be between 1 and {S.MAX_BATCH_SIZE}")
    ranked = skew.global_rank(
        pending(articles).select("created_at", "id"), ["created_at", "id"], partitions
    )
    batch_no = F.floor((F.col("rank") - 1) / F.lit(size)).cast("long")
    return ranked.select("id", "rank", batch_no.alias("batch_no"))


def build_requests(articles: DataFrame, **options: str | int | None) -> DataFrame:
    """Add the nested ``request`` of each article; ``to_json`` gives its line."""
    request = scoring_request(F.col("id"), F.col("title"), F.col("content"), **options)
    return articles.withColumn("request", request)


# --- results ------------------------------------------------------------------------------------


def parse_results(lines: DataFrame) -> DataFrame:
    """Article id, score and explanation of each parsed line, or the reason there is none.

    Takes the output of ``parse_result_lines``. Reasons, first match wins: ``malformed``,
    ``custom_id``, ``no_choices``, ``empty_content``, ``payload``.
    """
    custom_id = F.col("result.custom_id")
    choices = F.col("result.response.body.choices")
    answer = F.get(choices, F.lit(0))["message"]["content"]
    named = F.coalesce(custom_id.startswith(S.CUSTOM_ID_PREFIX), F.lit(False))
    payload = F.col("_payload")
    reason = (
        F.when(F.col("malformed"), "malformed")
        .when(~named, "custom_id")
        .when(choices.isNull() | (F.size(choices) == 0), "no_choices")
        .when(F.coalesce(answer, F.lit("")) == "", "empty_content")
        .when(payload.isNull(), "payload")
    )
    rest = [c for c in lines.columns if c not in ("result", "malformed")]
    read = lines.select(*lines.columns, computed_once(validate_payload(answer).alias("_payload")))
    return read.select(
        *rest,
        F.when(named, F.replace(custom_id, F.lit(S.CUSTOM_ID_PREFIX), F.lit(""))).alias("article_id"),
        F.col("_payload.score").alias("score"),
        F.col("_payload.explanation").alias("explanation"),
        reason.alias("error"),
    )


def batch_verdicts(parsed: DataFrame) -> DataFrame:
    """Per batch: lines, malformed lines, errors, first error and whether it may be applied.

    Malformed lines are left out before the strict check, so they do not fail a batch; any
    other error does, and so does a batch without a single good line.
    """
    failed = F.col("error").isNotNull() & (F.col("error") != "malformed")
    checked = parsed.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col("error") == "malformed").alias("n_malformed"),
        F.count_if(failed).alias("n_errors"),
        F.min_by("error", F.when(failed, F.col("pos"))).alias("first_error"),
    )
    good = F.col("n_lines") - F.col("n_malformed") - F.col("n_errors")
    return checked.withColumn("applicable", (F.col("n_errors") == 0) & (good > 0))


def _keep_batches(
    rows: DataFrame, batches: DataFrame, how: str, spread: Sequence[str], hot_rows: int
) -> DataFrame:
    """Semi- or anti-join on the batch; one batch may hold much of the table."""
    return skew.salted_join(
        rows, batches.select("batch_id").distinct(), ["batch_id"], how, spread, hot_rows=hot_rows
    )


def skip_completed(
    rows: DataFrame,
    batches: DataFrame,
    spread: Sequence[str] = ("pos",),
    hot_rows: int = skew.HOT_ROWS,
) -> DataFrame:
    """Drop the lines of batches that are already completed."""
    done = batches.where(F.col("status") == "completed")
    return _keep_batches(rows, done, "left_anti", spread, hot_rows)


def strict_updates(
    parsed: DataFrame, spread: Sequence[str] = ("pos",), hot_rows: int = skew.HOT_ROWS
) -> DataFrame:
    """Good lines of the batches without an error."""
    applicable = batch_verdicts(parsed).where("applicable")
    good = parsed.where(F.col("error").isNull())
    return _keep_batches(good, applicable, "left_semi", spread, hot_rows).drop("error")


def one_update_per_article(
    updates: DataFrame, batches: DataFrame | None = None, hot_rows: int = skew.HOT_ROWS
) -> DataFrame:
    """Within a batch the last line of an article wins; across batches the oldest batch does.

    A later batch finds the article scored and leaves it alone. Age is ``created_at`` of
    ``batches``, or the order of the batch ids without it.
    """
    last = updates.groupBy("article_id", "batch_id").agg(
        F.max_by(F.struct("score", "explanation"), "pos").alias("update")
    )
    age = ["batch_id"]
    if batches is not None and "created_at" in batches.columns:
        times = batches.groupBy("batch_id").agg(F.min("created_at").alias("created_at"))
        last = skew.salted_join(last, times, ["batch_id"], "left", ["article_id"], hot_rows=hot_rows)
        age = ["created_at", "batch_id"]
    first = last.groupBy("article_id").agg(F.min_by("update", F.struct(*age)).alias("update"))
    return first.select("article_id", "update.score", "update.explanation")


def cleanse_updates(updates: DataFrame, limit: int | None = S.EXPLANATION_LIMIT) -> DataFrame:
    """Drop updates without id or with an unusable score; clean the others."""
    clean = updates.withColumn(
        "_clean", cleansed_update(F.col("score"), F.col("explanation"), limit)
    ).where(F.col("_clean").isNotNull())
    has_id = F.coalesce(F.col("article_id").cast("string"), F.lit("")) != ""
    return clean.where(has_id).select(
        "article_id", F.col("_clean.score").alias("score"), F.col("_clean.explanation").alias("explanation")
    )


def not_yet_scored(updates: DataFrame, articles: DataFrame) -> DataFrame:
    """Updates whose article has no score; ids are unique or few per article on both sides."""
    scored = articles.where(F.col("clickbait_score").isNotNull()).select(
        F.col("id").cast("string").alias("article_id")
    )
    return updates.where(F.col("article_id").isNotNull()).join(scored, "article_id", "left_anti")


def unmatched(updates: DataFrame, articles: DataFrame) -> DataFrame:
    """Updates whose article does not exist; they are reported, never inserted."""
    known = articles.select(F.col("id").cast("string").alias("article_id"))
    return updates.join(known, "article_id", "left_anti")


def update_outcomes(updates: DataFrame, articles: DataFrame) -> DataFrame:
    """Each update (one per article) with what becomes of it.

    ``no_id``, ``not_found`` (no such article), ``already_processed`` (it has a score) or
    ``updated``. An id in ``articles`` is unique; an empty id counts as none.
    """
    stored = articles.select(
        F.col("id").cast("string").alias("article_id"), F.col("clickbait_score").isNotNull().alias("_scored")
    )
    outcome = (
        F.when(F.coalesce("article_id", F.lit("")) == "", "no_id")
        .when(F.col("_scored").isNull(), "not_found")
        .when(F.col("_scored"), "already_processed")
        .otherwise("updated")
    )
    return updates.join(stored, "article_id", "left").withColumn("outcome", outcome).drop("_scored")


def apply_scores(
    articles: DataFrame, updates: DataFrame, asof: Column, totals: Observation | None = None
) -> DataFrame:
    """Articles with the scores of ``updates`` (one per article) where none was stored.

    One join does both the idempotency check and the update. Other columns stay as they are.
    ``totals`` observes ``updated`` and ``already_processed`` when the result is computed.
    """
    fresh = updates.select(
        F.col("article_id").alias("_article_id"),
        F.col("score").alias("_score"),
        F.col("explanation").alias("_explanation"),
    )
    joined = articles.join(fresh, F.col("id").cast("string") == F.col("_article_id"), "left")
    take = F.col("clickbait_score").isNull() & F.col("_score").isNotNull()
    if totals is not None:
        joined = joined.observe(
            totals,
            F.count_if(take).alias("updated"),
            F.count_if(F.col("_article_id").isNotNull() & ~take).alias("already_processed"),
        )
    stored = {field.name: field.dataType for field in articles.schema}
    new = {
        "clickbait_score": F.col("_score").cast(stored["clickbait_score"]),
        "clickbait_explanation": F.col("_explanation"),
        "updated_at": asof.cast(stored["updated_at"]),
    }
    return joined.select(
        *[
            F.when(take, new[name]).otherwise(F.col(name)).alias(name) if name in new else F.col(name)
            for name in articles.columns
        ]
    )


# --- batches ------------------------------------------------------------------------------------


def active_batches(batches: DataFrame) -> DataFrame:
    """Batches in progress, oldest first."""
    return batches.where(F.col("status") == "in_progress").orderBy("created_at", "batch_id")


def oldest_active(batches: DataFrame) -> DataFrame:
    return active_batches(batches).limit(1)


def any_active(batches: DataFrame) -> DataFrame:
    """One row: is any batch in progress?"""
    return batches.agg((F.count_if(F.col("status") == "in_progress") > 0).alias("any_active"))


def batch_rollup(batches: DataFrame) -> DataFrame:
    """Total, completed, in progress, and failed with cancelled counted together."""
    return batches.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "completed").alias("completed"),
        F.count_if(F.col("status") == "in_progress").alias("in_progress"),
        F.count_if(F.col("status").isin("failed", "cancelled")).alias("failed"),
    )


def orphan_batches(remote: DataFrame, batches: DataFrame) -> DataFrame:
    """Batches the scoring service knows and the table does not, ready to append."""
    missing = remote.join(batches.select("batch_id"), "batch_id", "left_anti")
    return missing.withColumn("recovered", F.lit(True))


def audit_status_changes(
    log: DataFrame,
    order: Sequence[str] = ("ts", "event_id"),
    moves: dict[str, list[str]] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``previous`` and ``verdict`` to a log of status changes.

    ``first`` starts a batch, ``unchanged`` repeats the state, ``valid`` and ``invalid`` are
    decided by the fixed table of moves, small enough to be a literal map.
    """
    changes = skew.lag_in_group(log, ["batch_id"], order, "status", "previous", partitions)
    table = moves or S.STATUS_MOVES
    allowed = F.create_map(
        *[x for a, targets in table.items() for x in (F.lit(a), F.array(*[F.lit(b) for b in targets]))]
    )
    may_move = F.coalesce(
        F.array_contains(F.try_element_at(allowed, F.col("previous")), F.col("status")), F.lit(False)
    )
    verdict = (
        F.when(F.col("previous").isNull(), "first")
        .when(F.col("previous") == F.col("status"), "unchanged")
        .when(may_move, "valid")
        .otherwise("invalid")
    )
    return changes.withColumn("verdict", verdict)
