"""Many keywords against many texts: a join on character grams instead of a test per keyword."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.operators import skew
from presswork.session import discard, materialise

GRAM = 4


def grams(text: Column, size: Column) -> Column:
    """Distinct runs of ``size`` code points, in time linear in the text; none if it is shorter.

    A pattern that matches nothing but looks ahead finds the run at every place; none begins at the
    second half of a code point that Java holds as two.
    """
    run = F.concat(F.lit("(?s)(?=([^\\uDC00-\\uDFFF].{"), (size - 1).cast("string"), F.lit("}))"))
    runs = F.array_distinct(F.regexp_extract_all(text, run, F.lit(1)))
    return F.when(F.length(text) >= size, runs).otherwise(F.array().cast("array<string>"))


def _all_grams(text: Column, sizes: list[int]) -> Column:
    return F.flatten(F.array(*[grams(text, F.lit(size)) for size in sizes]))


def table_matches(
    texts: DataFrame,
    keywords: DataFrame,
    text: str = "title",
    key: str = "id",
    gram: int = GRAM,
    hot_rows: int = skew.HOT_ROWS,
    broadcast_rows: int = skew.BROADCAST_ROWS,
) -> DataFrame:
    """``key, keyword`` for every keyword of a table (column ``keyword``) that a text contains.

    Each keyword waits at that one of its grams of ``gram`` code points (of its own length, if it
    is shorter) that the fewest texts have; only texts with this gram are searched for it. A
    small keyword table goes to every task. A larger one is joined gram by gram, hot grams
    spread over several tasks, and the texts are fetched for what that leaves.

    ``key`` is unique. Case counts. A null text or keyword and the empty keyword match nothing;
    repeated keywords count once.
    """
    words = materialise(keywords.select("keyword").where(F.length("keyword") > 0).distinct(), "keywords")
    size = F.least(F.length("keyword"), F.lit(gram))
    sizes = sorted(row.size for row in words.select(size.alias("size")).distinct().collect())
    rows = texts.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where(F.col("_text").isNotNull())
    if not sizes:
        return rows.limit(0).select(F.col("_key").alias(key), F.lit("").alias("keyword"))
    places = words.select("keyword", F.explode(grams(F.col("keyword"), size)).alias("gram"))
    wanted = skew.broadcast_if_small(places.select("gram").distinct(), broadcast_rows, probe=places.select("gram"))
    text_grams = F.explode(_all_grams(F.col("_text"), sizes)).alias("gram")
    frequency = (
        rows.select(text_grams).join(wanted, "gram", "left_semi").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    )
    # A gram that no text has is the best place to wait at: its keyword cannot occur.
    known = skew.salted_join(places, frequency, ["gram"], "left", ["keyword"], hot_rows=hot_rows)
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("at")
    anchors = materialise(
        known.groupBy("keyword").agg(rarest).where("at.n > 0").select("keyword", "at.gram"), "keyword-anchors"
    )
    discard(words)
    small = skew.broadcast_if_small(anchors, broadcast_rows)
    if small is not anchors:
        found = rows.select("_key", "_text", text_grams).join(small, "gram")
    else:
        narrow = rows.select("_key", text_grams)
        counts = skew.key_counts(narrow, ["gram"])
        pairs = skew.salted_join(narrow, anchors, ["gram"], "inner", ["_key"], counts=counts, hot_rows=hot_rows)
        # A text with many waiting keywords is a hot key of this join.
        found = skew.salted_join(pairs.drop("gram"), rows, ["_key"], "inner", ["keyword"], hot_rows=hot_rows)
    held = found.where(F.contains("_text", F.col("keyword")))
    return held.select(F.col("_key").alias(key), "keyword")
