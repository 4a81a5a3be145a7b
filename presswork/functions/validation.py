"""Row checks. Each returns a reason column, null for a valid row, so callers can split frames."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presswork import settings as S
from presswork.functions.once import let
from presswork.functions.text import strip


def _length(text: Column) -> Column:
    return F.coalesce(F.length(strip(text)), F.lit(0))


def url_allowed(url: Column, prefixes: list[str] | None = None) -> Column:
    allowed = F.lit(False)
    for prefix in S.URL_PREFIXES if prefixes is None else prefixes:
        allowed = allowed | url.startswith(prefix)
    return F.coalesce(allowed, F.lit(False))


def article_reject_reason(
    title: Column,
    content: Column,
    url: Column,
    score: Column,
    prefixes: list[str] | None = None,
) -> Column:
    """First failing check of an article: ``title``, ``content``, ``url`` or ``score``."""
    return (
        F.when(_length(title) < S.MIN_TITLE_LENGTH, "title")
        .when(_length(content) < S.MIN_CONTENT_LENGTH, "content")
        .when(~url_allowed(url, prefixes), "url")
        .when(score.isNotNull() & ~score.between(S.MIN_SCORE, S.MAX_SCORE), "score")
    )


def journalist_reject_reason(name: Column, publisher: Column) -> Column:
    return F.when(_length(name) < S.MIN_NAME_LENGTH, "name").when(
        _length(publisher) < S.MIN_PUBLISHER_LENGTH, "publisher"
    )


def padded_content(content: Column, description: Column, minimum: int = S.MIN_CONTENT_LENGTH) -> Column:
    """A short body is extended by the description; null when that is still too short."""
    longer = F.concat(content, F.lit(" "), description)
    return F.when(F.length(content) >= minimum, content).when(F.length(longer) >= minimum, longer)


def parse_json_strict(text: Column) -> Column:
    """VARIANT of a complete JSON text; null for anything else, trailing text included.

    The parser ignores what follows a value, so the text is put into an array and followed by a
    number made from it: only if exactly that number comes second did the text end as it should.
    Repeated keys are refused.
    """
    mark = F.pmod(F.xxhash64(text), F.lit(1 << 40))

    def only_element(wrapped: Column) -> Column:
        ended = F.try_variant_get(wrapped, "$[1]", "bigint") == mark
        more = F.try_variant_get(wrapped, "$[2]", "variant")
        return F.when(ended & more.isNull(), F.try_variant_get(wrapped, "$[0]", "variant"))

    closed = F.concat(F.lit("["), text, F.lit(","), mark.cast("string"), F.lit("]"))
    return let(F.try_parse_json(closed), only_element)


def validate_payload(text: Column) -> Column:
    """Struct(score, explanation) of a scoring answer, or null.

    Both fields must be there, the score a JSON integer in range (``true``, ``75.0`` and
    ``"75"`` are refused) and the explanation a non-blank string; other keys are tolerated.
    """

    def checked(body: Column) -> Column:
        def kind(field: str) -> Column:
            return F.schema_of_variant(F.try_variant_get(body, f"$.{field}", "variant"))

        typed = (kind(S.SCORE_FIELD) == "BIGINT") & (kind(S.EXPLANATION_FIELD) == "STRING")
        score = F.try_variant_get(body, f"$.{S.SCORE_FIELD}", "int")
        explanation = strip(F.try_variant_get(body, f"$.{S.EXPLANATION_FIELD}", "string"))
        return F.when(typed, F.struct(score.alias("score"), explanation.alias("explanation")))

    def in_range(answer: Column) -> Column:
        good = answer.score.between(S.MIN_SCORE, S.MAX_SCORE) & (answer.explanation != "")
        return F.when(good, answer)

    return let(let(parse_json_strict(text), checked), in_range)


def cleansed_update(
    score: Column, explanation: Column, limit: int | None = S.EXPLANATION_LIMIT
) -> Column:
    """Struct(score, explanation) with a half-even integer score; null when the score is unusable.

    The explanation is cut at ``limit`` characters; None keeps all.
    """
    text = strip(F.coalesce(explanation, F.lit("")))
    text = F.when(text == "", F.lit(S.DEFAULT_EXPLANATION)).otherwise(text)
    return F.when(
        score.between(S.MIN_SCORE, S.MAX_SCORE),
        F.struct(
            F.bround(score, 0).cast("int").alias("score"),
            (text if limit is None else F.substring(text, 1, limit)).alias("explanation"),
        ),
    )
