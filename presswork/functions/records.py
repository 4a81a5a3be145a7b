"""Keys and JSON records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presswork import settings as S
from presswork.functions.dates import local_time
from presswork.functions.text import render_prompt

CONTENT_FIELDS = ["title", "content", "journalist_name", "publisher"]


def digest(*fields: Column) -> Column:
    """SHA-256 over length-prefixed fields: equal exactly when all fields are, nulls included."""
    parts = [
        F.coalesce(F.concat(F.length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in fields
    ]
    return F.sha2(F.concat(*parts), 256)


def content_key() -> Column:
    """Narrow stand-in for (title, content, journalist_name, publisher)."""
    return digest(*[F.col(name) for name in CONTENT_FIELDS])


def duplicate_key() -> Column:
    """The content key together with the URL."""
    return digest(F.col("naver_url"), *[F.col(name) for name in CONTENT_FIELDS])


def journalist_key(name: Column, publisher: Column) -> Column:
    """Surrogate id of a new journalist: depends on nothing but the natural key."""
    return digest(name, publisher)


def article_record() -> Column:
    """JSON record of an article; only score and explanation are left out where they are null.

    The publication time is the local wall clock with its offset; a fraction of a second is
    shown in microseconds, and only if there is one.
    """
    local = local_time(F.col("published_at"))
    second = F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(local, ".SSSSSS")
    offset = f"+{S.LOCAL_OFFSET_HOURS:02d}:00"
    stamp = F.concat(second, F.when(fraction == ".000000", "").otherwise(fraction), F.lit(offset))
    fixed = F.to_json(
        F.struct(
            "title",
            "content",
            "journalist_id",
            "journalist_name",
            "publisher",
            stamp.alias("published_at"),
            "naver_url",
        ),
        {"ignoreNullFields": "false"},
    )
    sparse = F.to_json(F.struct("clickbait_score", "clickbait_explanation"))
    both = F.concat(F.substring(fixed, 1, F.length(fixed) - 1), F.lit(","), F.substring(sparse, 2, F.length(sparse)))
    return F.when(sparse == "{}", fixed).otherwise(both)


def scoring_request(
    article_id: Column,
    title: Column,
    content: Column,
    template: str = S.PROMPT_TEMPLATE,
    system_message: str = S.SYSTEM_MESSAGE,
    model: str = S.REQUEST_MODEL,
    limit: int | None = S.MAX_CONTENT_LENGTH,
) -> Column:
    """Nested scoring request of one article, ready for ``to_json``."""

    def message(role: str, text: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), text.alias("content"))

    answer_fields = F.struct(
        F.struct(
            F.lit("integer").alias("type"),
            F.lit(S.MIN_SCORE).alias("minimum"),
            F.lit(S.MAX_SCORE).alias("maximum"),
        ).alias(S.SCORE_FIELD),
        F.struct(F.lit("string").alias("type")).alias(S.EXPLANATION_FIELD),
    )
    answer_schema = F.struct(
        F.lit("object").alias("type"),
        answer_fields.alias("properties"),
        F.array(F.lit(S.SCORE_FIELD), F.lit(S.EXPLANATION_FIELD)).alias("required"),
        F.lit(False).alias("additionalProperties"),
    )
    response_format = F.struct(
        F.lit("json_schema").alias("type"),
        F.struct(
            F.lit(S.SCHEMA_NAME).alias("name"),
            F.lit(True).alias("strict"),
            answer_schema.alias("schema"),
        ).alias("json_schema"),
    )
    body = F.struct(
        F.lit(model).alias("model"),
        F.array(
            message("system", F.lit(system_message)),
            message("user", render_prompt(title, content, template, limit)),
        ).alias("messages"),
        response_format.alias("response_format"),
    )
    return F.struct(
        F.concat(F.lit(S.CUSTOM_ID_PREFIX), article_id.cast("string")).alias("custom_id"),
        F.lit(S.REQUEST_METHOD).alias("method"),
        F.lit(S.REQUEST_URL).alias("url"),
        body.alias("body"),
    )
