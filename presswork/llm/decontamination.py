"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

A window of an item occurs in a document only if all its shingles do. So it is enough to look
up each window's rarest shingle in the documents; the length of the document and the place of
the shingle then bound where the window could stand, and the words there are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.llm.common import ascii_lower, small
from presswork.session import materialise

WINDOW = 13
SHINGLE = 4
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a whole text: letters, digits and everything beyond ASCII, A-Z in lower case."""
    return F.filter(F.split(ascii_lower(text), _GAP), lambda w: w != "")


def _shingles(words: Column, width: int) -> Column:
    """Hash of each run of ``width`` words; empty where there are fewer."""
    last = F.size(words) - width
    places = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))


def _windows(items: DataFrame, window: int) -> DataFrame:
    """Distinct windows with the items they occur in: ``window, n, item_ids``.

    An item of fewer words than a window is one window; an item without words is none.
    """
    words = F.col("words")
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (window - 1), F.lit(1)))
    each = items.where(F.size("words") > 0).select(
        "item_id", F.explode(F.transform(starts, lambda i: F.slice(words, i, window))).alias("window")
    )
    found = each.groupBy("window").agg(F.collect_set("item_id").alias("item_ids"))
    return found.withColumn("n", F.size("window"))


def _by_width(widths: list[int], build) -> DataFrame:
    out = build(widths[0])
    for width in widths[1:]:
        out = out.unionByName(build(width))
    return out


def find_windows(texts: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame | None:
    """Windows that occur in each distinct text: ``key, found`` with an array of (start, n, item_ids).

    ``texts`` has the columns ``key, text`` with equal keys for equal texts, ``items`` the
    columns ``item_id, text``; ``start`` counts words from 0. None if no item has a word.

    Tables made from the benchmark, and the keys of the texts to look at again, are broadcast
    only if their checked size is small; else they are shuffled. Copies of a text meet in one
    row before anything is grouped by text, so that what is grouped is bounded by one text.
    """
    items = items.select(F.col("item_id").cast("string"), words_of(F.coalesce("text", F.lit(""))).alias("words"))
    windows = materialise(_windows(items, window), "windows")
    width_of = F.least("n", F.lit(SHINGLE))
    widths = sorted(row.w for row in windows.select(width_of.alias("w")).distinct().collect())
    if not widths:
        return None

    def of_windows(width: int) -> DataFrame:
        shingle = F.posexplode(_shingles(F.col("window"), width)).alias("offset", "shingle")
        return windows.where(width_of == width).select("window", "n", "item_ids", shingle)

    tokens = materialise(_by_width(widths, of_windows), "tokens")
    wanted = small(materialise(tokens.select("shingle").distinct(), "shingles"))
    in_words = texts.where("text IS NOT NULL").select("key", words_of(F.col("text")).alias("words"))

    def of_texts(width: int) -> DataFrame:
        shingle = F.posexplode(_shingles(F.col("words"), width)).alias("place", "shingle")
        return in_words.select("key", shingle).join(wanted, "shingle", "left_semi")

    hits = materialise(_by_width(widths, of_texts), "hits")

    # Shingles in order of their rarity over all texts: the rarest is the necessary prefix of a
    # window that must be contained whole.
    rarity = hits.groupBy("shingle").agg(F.count(F.lit(1)).alias("df"))
    ranked = tokens.join(rarity, "shingle", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    prefix = ranked.groupBy("window", "n", "item_ids").agg(F.min(F.struct("df", "shingle", "offset")).alias("p"))
    prefix = materialise(
        prefix.where("p.df > 0").select("p.shingle", "p.offset", "window", "n", "item_ids"), "prefix"
    )

    # The window has to start inside the text, and (below) to end inside it.
    met = hits.join(small(prefix), "shingle").withColumn("start", F.col("place") - F.col("offset"))
    met = met.where("start >= 0").select("key", "start", "n", "window", "item_ids").distinct()
    met = materialise(met, "met")
    keys = small(materialise(met.select("key").distinct(), "keys"))
    again = in_words.join(keys, "key", "left_semi").dropDuplicates(["key"])
    tries = met.groupBy("key").agg(F.collect_list(F.struct("start", "n", "window", "item_ids")).alias("tries"))
    words = F.col("words")
    fits = F.filter(
        "tries",
        lambda t: (F.size(words) >= t["start"] + t["n"]) & (F.slice(words, t["start"] + 1, t["n"]) == t["window"]),
    )
    slim = F.transform(
        fits, lambda t: F.struct(t["start"].alias("start"), t["n"].alias("n"), t["item_ids"].alias("item_ids"))
    )
    return tries.join(again, "key").select("key", slim.alias("found")).where(F.size("found") > 0)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    percent: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every row of ``docs``.

    A word inside any occurrence of an item's window is hit; an item shorter than a window is one
    window. ``contaminated``: some word is hit, and at least ``percent`` in a hundred are. Null
    and empty texts have no words; null and empty items have no window; an item without an id
    hits words but is not listed. Equal texts are searched once and each row gets the result.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.regexp_count(text_col, F.lit(_WORD)), F.lit(0)).cast("long").alias("n_words"),
        F.unhex(F.md5(text_col)).alias("key"),
    )
    texts = docs.select(F.unhex(F.md5(text_col)).alias("key"), F.col(text_col).alias("text"))
    benchmark = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    found = find_windows(texts, benchmark, window)
    if found is None:
        rows = rows.withColumn("n_hit", F.lit(0)).withColumn("item_ids", F.array().cast("array<string>"))
    else:
        covered = F.flatten(F.transform("found", lambda t: F.sequence(t["start"], t["start"] + t["n"] - 1)))
        ids = F.array_sort(F.array_distinct(F.flatten(F.transform("found", lambda t: t["item_ids"]))))
        hit = found.select("key", F.size(F.array_distinct(covered)).alias("n_hit"), ids.alias("item_ids"))
        rows = rows.join(small(materialise(hit, "hit")), "key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return rows.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (100 * n_hit >= percent * F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, percent: int = 5) -> DataFrame:
    """Rows of ``docs`` that are not contaminated, with all their columns, whatever their names.

    Null and empty texts have no words and stay; repeated rows stay or go together.
    """
    key = F.unhex(F.md5(docs["text"]))
    texts = docs.select(key.alias("doc_id"), "text")
    found = contamination(texts, items, window, percent).where("contaminated").select("doc_id").distinct()
    lost = small(materialise(found.withColumnRenamed("doc_id", "_lost"), "lost"))
    return docs.join(lost, key == lost["_lost"], "left_anti")
