"""Duplicate removal: within a feed, against stored rows, and within content groups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions.records import content_key, digest
from presswork.functions.text import normalize_url
from presswork.operators import skew
from presswork.operators.components import components
from presswork.session import materialise

#: Rounds of feed dedup before what is left is split into components.
PLAIN_ROUNDS = 3
#: Largest component that one task walks through: about 20 MB of keys.
SOLVE_ROWS = 100_000

RANK_COLUMNS = ["id", "clickbait_score", "created_at", "naver_url"]


def is_duplicate(left: str, right: str) -> Column:
    """Pair predicate on two aliased frames: same URL, or same four content fields."""
    fields = ["title", "content", "journalist_name", "publisher"]
    same = F.lit(True)
    for name in fields:
        same = same & (F.col(f"{left}.{name}") == F.col(f"{right}.{name}"))
    return (F.col(f"{left}.naver_url") == F.col(f"{right}.naver_url")) | same


# --- best-of-group merge ---------------------------------------------------------------------


def _ranked(articles: DataFrame) -> DataFrame:
    """Narrow frame for grouping: a digest instead of the four text columns."""
    return articles.select(
        content_key().alias("content_key"),
        "id",
        F.coalesce("clickbait_score", F.lit(0)).alias("score"),
        "created_at",
        "naver_url",
    )


def _group_summary(ranked: DataFrame) -> DataFrame:
    """Size and survivor per group: highest score, then oldest (no time is last), then lowest id.

    A minimum over a struct is combined on the map side, so a group that holds a third of
    the table still sends one row per task.
    """
    undated = F.col("created_at").isNull().alias("undated")
    best = F.min(F.struct((-F.col("score")).alias("order"), undated, "created_at", "id"))
    return (
        ranked.groupBy("content_key")
        .agg(F.count(F.lit(1)).alias("duplicate_count"), best.alias("best"))
        .select(
            "content_key",
            "duplicate_count",
            F.col("best.id").alias("kept_id"),
            (-F.col("best.order")).alias("kept_score"),
            F.col("best.created_at").alias("kept_created_at"),
        )
    )


def duplicate_groups(articles: DataFrame) -> DataFrame:
    """One row per content group of more than one article, largest first.

    Texts are fetched for the survivors only; the members are in ``group_members``.
    """
    groups = _group_summary(_ranked(articles)).where("duplicate_count > 1")
    texts = articles.select(
        F.col("id").alias("kept_id"), "title", "journalist_name", "publisher", "naver_url"
    )
    return groups.join(texts, "kept_id").orderBy(F.desc("duplicate_count"), "content_key")


def group_members(
    articles: DataFrame, hot_rows: int = skew.HOT_ROWS, partitions: int | None = None
) -> DataFrame:
    """Every member of every duplicate group with its rank, in place of an array per group."""
    ranked = materialise(_ranked(articles), "ranked")
    groups = _group_summary(ranked).where("duplicate_count > 1").select(
        "content_key", F.col("duplicate_count").alias("n_rows")
    )
    members = skew.salted_join(
        ranked,
        groups.select("content_key"),
        ["content_key"],
        "left_semi",
        spread=["id"],
        counts=groups,
        hot_rows=hot_rows,
    )
    ordered = members.withColumn("_order", -F.col("score")).withColumn(
        "_undated", F.col("created_at").isNull()
    )
    return skew.rank_in_group(
        ordered, ["content_key"], ["_order", "_undated", "created_at", "id"], partitions
    ).drop("_order", "_undated")


def losers(articles: DataFrame) -> DataFrame:
    """Ids to delete: every article that is not the survivor of its group.

    The texts are read and digested once; the rest works on the narrow copy.
    """
    ranked = materialise(_ranked(articles), "ranked")
    groups = materialise(_group_summary(ranked).where("duplicate_count > 1"), "groups")
    members = skew.salted_join(
        ranked.select("id", "content_key"),
        groups.select("content_key", "kept_id"),
        ["content_key"],
        "inner",
        spread=["id"],
        counts=groups.select("content_key", F.col("duplicate_count").alias("n_rows")),
    )
    return members.where("id <> kept_id").select("id", "content_key")


def survivors(articles: DataFrame) -> DataFrame:
    """The article table without the losers; the wide rows stay put while these are few."""
    lost = materialise(losers(articles).select("id"), "losers")
    return articles.join(skew.broadcast_if_small(lost), "id", "left_anti")


def merge_totals(articles: DataFrame) -> DataFrame:
    """Number of groups, articles in them and articles that a merge deletes."""
    sizes = (
        articles.select(content_key().alias("content_key"))
        .groupBy("content_key")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    return sizes.agg(
        F.count(F.lit(1)).alias("groups"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_articles"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("deleted"),
    )


# --- first of each key ---------------------------------------------------------------------------


def first_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Keep the row with the lowest ``order`` (unique in the table) of each key.

    The minimum is found on two narrow columns and the wide rows are picked by ``order``, so
    no key decides how the wide rows are spread.
    """
    firsts = df.groupBy(*keys).agg(F.min(order).alias(order)).select(order)
    return df.join(firsts, order, "left_semi")


# --- greedy dedup of a feed ------------------------------------------------------------------------


def feed_keys(
    feed: DataFrame, position: str = "position", url: str = "naver_url", scope: Sequence[str] = ()
) -> DataFrame:
    """``pos, url, digest`` of each row: two rows of a scope clash if either key is equal.

    Scope and key are in one digest, so that a null scope is a scope like others; a row without
    URL shares it with nobody.
    """
    where = [F.col(name).cast("string") for name in scope]
    own = F.concat(F.lit("pos"), F.col(position).cast("string"))
    return feed.select(
        F.col(position).alias("pos"),
        F.when(F.col(url).isNull(), own).otherwise(digest(*where, F.col(url))).alias("url"),
        digest(*where, content_key()).alias("digest"),
    )


def feed_dedup(
    feed: DataFrame,
    position: str = "position",
    url: str = "naver_url",
    scope: Sequence[str] = (),
    hot_rows: int = skew.HOT_ROWS,
    earlier: DataFrame | None = None,
    plain_rounds: int = PLAIN_ROUNDS,
    solve_rows: int = SOLVE_ROWS,
) -> DataFrame:
    """Keep a row iff no kept earlier row of its scope has its URL or its content.

    ``position`` is unique in the table and gives the feed order. The sequential rule equals
    a series of rounds: keep the rows that come first in both their URL group and their
    content group, remove whatever shares either with them, repeat on the rest. A long chain of
    rows would take as many rounds as rows, so what ``plain_rounds`` rounds leave undecided is
    split into connected components over both keys; the rule walks through each of at most
    ``solve_rows`` rows in one task, and only larger ones go on in rounds. ``earlier`` has the
    ``url`` and ``digest`` of rows kept before this feed, each once.
    """
    keys = feed_keys(feed, position, url, scope)
    if earlier is not None:
        keys = materialise(keys, "feed-keys")
    # A later copy of both URL and content never survives and never blocks another row.
    every = keys.select("pos")
    if earlier is not None:
        for column in ("url", "digest"):
            known = earlier.select(column).where(F.col(column).isNotNull())
            keys = skew.salted_join(keys, known, [column], "left_anti", spread=["pos"], hot_rows=hot_rows)
    rest = keys.groupBy("url", "digest").agg(F.min("pos").alias("pos"))
    kept, rest = _rounds(rest, hot_rows, plain_rounds)
    if rest is not None:
        parts = materialise(rest.join(components(rest, "pos", ["url", "digest"]), "pos"), "feed-parts")
        sizes = parts.groupBy("part").count().where(F.col("count") > solve_rows).select("part")
        large = materialise(sizes, "feed-large")
        wide = skew.broadcast_if_small(large)
        solved = parts.join(wide, "part", "left_anti").groupBy("part").applyInPandas(_walk, "pos long")
        kept.append(materialise(solved, "feed-kept"))
        if not large.isEmpty():
            rest = parts.join(wide, "part", "left_semi").select("pos", "url", "digest")
            kept += _rounds(rest, hot_rows)[0]
    if not kept:
        return feed.limit(0)
    kept = reduce(DataFrame.unionByName, kept)
    dropped = materialise(every.join(kept, "pos", "left_anti"), "feed-dropped")
    return feed.join(
        skew.broadcast_if_small(dropped.withColumnRenamed("pos", position)), position, "left_anti"
    )


def _rounds(rest: DataFrame, hot_rows: int, most: int | None = None) -> tuple[list[DataFrame], DataFrame | None]:
    """Rows kept by the rounds, and what is left undecided after ``most`` of them, if anything."""
    kept: list[DataFrame] = []
    while True:
        rest = materialise(rest, "feed-rest")
        if rest.isEmpty():
            return kept, None
        if len(kept) == most:
            return kept, rest
        by_url = _first_in_group(rest, ["url"], "n_url")
        by_digest = _first_in_group(rest, ["digest"], "n_digest")
        firsts = materialise(
            by_url.join(by_digest, "pos").select("pos", "url", "digest", "n_url", "n_digest"),
            "feed-kept",
        )
        kept.append(firsts.select("pos"))
        rest = rest.join(firsts.select("pos"), "pos", "left_anti")
        for column, size in (("url", "n_url"), ("digest", "n_digest")):
            taken = firsts.where(F.col(size) > 1)
            rest = skew.salted_join(
                rest,
                taken.select(column),
                [column],
                "left_anti",
                spread=["pos"],
                counts=taken.select(column, F.col(size).alias("n_rows")),
                hot_rows=hot_rows,
            )


def _walk(part: pd.DataFrame) -> pd.DataFrame:
    """The sequential rule over the rows of one component."""
    part = part.sort_values("pos")
    urls, digests, kept = set(), set(), []
    for pos, url, body in zip(part["pos"], part["url"], part["digest"]):
        if url not in urls and body not in digests:
            urls.add(url)
            digests.add(body)
            kept.append(pos)
    return pd.DataFrame({"pos": kept})


def _first_in_group(rows: DataFrame, keys: Sequence[str], size: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.min("pos").alias("pos"), F.count(F.lit(1)).alias(size))


# --- against stored rows -----------------------------------------------------------------------------


def existing_urls(urls: DataFrame, stored: DataFrame, probe: DataFrame | None = None) -> DataFrame:
    """Distinct stored URLs that occur in ``urls`` (one column ``naver_url``).

    A small request is broadcast against the scan of the stored URLs; a large one is
    shuffled on the URL. ``probe`` may be a cheaper frame with at least as many rows.
    """
    wanted = skew.broadcast_if_small(urls.distinct(), probe=urls if probe is None else probe)
    return stored.select("naver_url").join(wanted, "naver_url", "left_semi").distinct()


def url_flags(
    urls: DataFrame, stored: DataFrame, column: str = "url", hot_rows: int = skew.HOT_ROWS
) -> DataFrame:
    """{url, exists} per distinct raw URL, looked up in normalised form."""
    raw = materialise(
        urls.select(column).distinct().withColumn("naver_url", normalize_url(F.col(column))), "raw-urls"
    )
    found = existing_urls(raw.select("naver_url"), stored).withColumn("found", F.lit(True))
    return skew.salted_join(
        raw, found, ["naver_url"], "left", spread=[column], hot_rows=hot_rows
    ).select(column, "naver_url", F.coalesce("found", F.lit(False)).alias("exists"))


def drop_stored(articles: DataFrame, stored: DataFrame) -> DataFrame:
    """Articles whose URL is not stored yet."""
    found = existing_urls(articles.select("naver_url"), stored)
    return articles.join(found, "naver_url", "left_anti")


def insert_outcomes(
    articles: DataFrame, stored: DataFrame, order: str = "position"
) -> DataFrame:
    """Label each row ``inserted``, ``repeat`` (a later row of its URL) or ``stored``.

    The URL decides once per group; rows are then labelled by ``order``, which is unique.
    """
    firsts = articles.groupBy("naver_url").agg(F.min(order).alias(order))
    found = existing_urls(
        firsts.select("naver_url"), stored, probe=articles.select("naver_url")
    ).withColumn("found", F.lit(True))
    verdict = firsts.join(found, "naver_url", "left").select(
        order, F.when(F.col("found"), "stored").otherwise("inserted").alias("verdict")
    )
    return articles.join(verdict, order, "left").withColumn(
        "outcome", F.coalesce("verdict", F.lit("repeat"))
    ).drop("verdict")


# --- reporting pairs --------------------------------------------------------------------------------


def duplicate_links(articles: DataFrame, hot_rows: int = skew.HOT_ROWS) -> DataFrame:
    """Each later article linked to the first one with its URL and the first with its content.

    The links of a group form a star, so their number grows with the table, not with the
    square of a group; every duplicate pair of a group shares its centre.
    """
    keyed = materialise(
        articles.select("id", F.col("naver_url").alias("url"), content_key().alias("digest")),
        "link-keys",
    )

    def links(column: str, via: str) -> DataFrame:
        groups = (
            keyed.groupBy(column)
            .agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n_rows"))
            .where("n_rows > 1")
        )
        matched = skew.salted_join(
            keyed.select("id", column),
            groups.drop("n_rows"),
            [column],
            "inner",
            spread=["id"],
            counts=groups.select(column, "n_rows"),
            hot_rows=hot_rows,
        )
        return matched.where("id <> first_id").select("id", "first_id", F.lit(via).alias("via"))

    pairs = links("url", "url").unionByName(links("digest", "content"))
    return pairs.groupBy("id", "first_id").agg(
        F.max(F.col("via") == "url").alias("same_url"),
        F.max(F.col("via") == "content").alias("same_content"),
    )
