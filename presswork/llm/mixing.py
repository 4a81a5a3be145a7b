"""Mixing sources to target weights, in DataFrame operations only.

The texts of a source form one stream of words, packed into blocks of fixed length. The mix is a
list of slots per source; each slot draws its output shard, so that the counts of a source over
the shards are multinomial, and is mapped to a block by a pseudorandom permutation of the
source's block numbers. Slots beyond one round of the blocks start another round. The mix itself
is the packed text of every slot's block.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presswork.functions.once import computed_once
from presswork.llm.common import SPACE_WORD, count_words, small
from presswork.session import materialise

WEIGHTS = (5, 2, 1)
BLOCK_WORDS = 64
SHARDS = 24
CAP = 3
#: Rows of a bucket that is ranked or summed in one task, whatever the size of its source.
BUCKET_ROWS = 1024
#: Shares of documents are summed in whole steps of one by this, so that sums are exact.
STEPS = 1 << 30


class Mix(NamedTuple):
    """``documents``: one row per input row; ``slots``: shard, source number, slot and block;
    ``draws``: slots per shard and source; ``blocks``: the mix, one row per slot, as ``shard,
    sidx, source, slot, block, n_words, text`` with the block's words parted by single spaces.
    ``blocks`` is only built when it is read."""

    documents: DataFrame
    slots: DataFrame
    draws: DataFrame
    blocks: DataFrame


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: int) -> DataFrame:
    """``source, sidx, source_size, target`` from ``source, source_size``; one row per source.

    Sources take the weights in turn by code point, null last. Targets are shares of all words by
    weight; one above ``cap`` times its source is cut there and the rest shared anew. In order of
    cap / weight the cut sources come first, which gives the level of the others in one pass.
    The only frame without partitions is this one, a row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sizes.withColumn("sidx", F.row_number().over(by_name))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("sidx") - 1) % len(weights) + 1).cast("int"))
    sources = sources.withColumn("w", weight).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    order = Window.orderBy(F.col("most") / F.col("w"), "sidx")
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    cut, used = F.coalesce(F.sum("most").over(before), F.lit(0.0)), F.coalesce(F.sum("w").over(before), F.lit(0.0))
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    level = (total - cut) / (F.sum("w").over(everything) - used)
    levels = sources.withColumn("level", level).withColumn("place", F.row_number().over(order))
    fits = F.when(F.col("level") <= F.col("most") / F.col("w"), F.col("place"))
    found = F.min_by("level", fits).over(everything)
    levels = levels.withColumn("found", found)
    target = F.when(F.col("found").isNull(), F.col("most")).otherwise(F.least("most", F.col("found") * F.col("w")))
    return levels.select("source", "sidx", "source_size", target.alias("target"))


def _starts(df: DataFrame, buckets: Column, value: Column) -> DataFrame:
    """``sidx, _bucket, _start``: sum of ``value`` over the buckets of a source before this one.

    A bucket is a few rows, so that the totals of a source are few against its rows.
    """
    totals = df.withColumn("_bucket", buckets).groupBy("sidx", "_bucket").agg(F.sum(value).alias("_sum"))
    over = Window.partitionBy("sidx").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("sidx", "_bucket", F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_start"))
    return materialise(starts, "starts")


def _ranked(
    df: DataFrame, buckets: Column, order: list[str], value: Column, alias: str, starts: DataFrame | None = None
) -> DataFrame:
    """Running sum of ``value`` before each row, per ``sidx`` and in ``order`` inside ``buckets``.

    Rows are dealt to buckets first: sums run inside a bucket, and a source's bucket totals
    (``_starts``) are summed apart.
    """
    starts = small(_starts(df, buckets, value) if starts is None else starts)
    df = df.withColumn("_bucket", buckets).withColumn("_value", value)
    inside = Window.partitionBy("sidx", "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    run = df.withColumn("_run", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    run = run.join(starts, ["sidx", "_bucket"])
    return run.withColumn(alias, F.col("_start") + F.col("_run")).drop("_bucket", "_value", "_run", "_start")


def _counted(sources: DataFrame, n: str, alias: str) -> DataFrame:
    """Numbers 0 to ``n`` - 1 of each source. Runs of numbers are spread before they are expanded,
    so that a large source is not one task's work."""
    runs = F.sequence(F.lit(0).cast("long"), F.col(n) - 1, F.lit(BUCKET_ROWS).cast("long"))
    spread = sources.where(F.col(n) > 0).withColumn("_run", F.explode(runs)).repartition("sidx", "_run")
    last = F.least(F.col("_run") + (BUCKET_ROWS - 1), F.col(n) - 1)
    return spread.withColumn(alias, F.explode(F.sequence("_run", last))).drop("_run")


def _packed_blocks(placed: DataFrame, block_words: int, drawn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``sidx, block, n_words, text`` from ``sidx, start, size, text``, of the blocks that ``drawn`` keeps.

    Documents are cut at block borders first, so that only pieces of one block, at most
    ``block_words`` of them, are brought together.
    """
    words = F.regexp_extract_all("text", F.lit(SPACE_WORD), F.lit(0))
    once = placed.select(computed_once(F.col("sidx"), F.col("start"), F.col("size"), words.alias("words")))
    start, size = F.col("start"), F.col("size")

    def piece(block: Column) -> Column:
        at, skip = F.greatest(start - block * block_words, F.lit(0)), F.greatest(block * block_words - start, F.lit(0))
        n = F.least(size - skip, block_words - at)
        text = F.array_join(F.slice(F.col("words"), (skip + 1).cast("int"), n.cast("int")), " ")
        return F.struct(block.alias("block"), at.cast("int").alias("at"), n.cast("int").alias("n"), text.alias("text"))

    numbers = F.sequence(F.floor(start / block_words), F.floor((start + size - 1) / block_words))
    pieces = drawn(once.select("sidx", F.inline(F.transform(numbers, piece))))
    blocks = pieces.groupBy("sidx", "block").agg(
        F.sum("n").cast("int").alias("n_words"), F.array_sort(F.collect_list(F.struct("at", "text"))).alias("_pieces")
    )
    return blocks.select("sidx", "block", "n_words", F.array_join(F.col("_pieces")["text"], " ").alias("text"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.0,
    cap: int = CAP,
    block_words: int = BLOCK_WORDS,
    shards: int = SHARDS,
    seed: int = 23,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> Mix:
    """Plan of the mix; ``documents`` has ``doc_id, source, size, source_size, target, taken``.

    A null source is a source of its own, the last. Texts without words, null ones among them,
    have size 0 and give nothing. No block, and so no document, is taken more than ``cap`` times.
    Equal rows are treated as several documents. An empty table gives an empty plan. All draws
    hash the seed with numbers, so a rerun gives the same plan.
    """
    mixed = _mix(docs, weights, share, cap, block_words, shards, seed, id_col, text_col, source_col)
    return mixed._replace(documents=mixed.documents.drop("sidx"))


def _mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.0,
    cap: int = CAP,
    block_words: int = BLOCK_WORDS,
    shards: int = SHARDS,
    seed: int = 23,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> Mix:
    """``mix`` with the source number ``sidx`` among the columns of ``documents``."""
    texts = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        count_words(F.col(text_col)).alias("size"),
        F.xxhash64(F.col(text_col)).alias("digest"),
        F.col(text_col).alias("text"),
    )
    rows = materialise(texts.drop("text"), "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = targets(sizes, weights, share, cap).withColumn("n_blocks", F.ceil(F.col("source_size") / block_words))
    slots = F.round(F.col("target") * F.col("n_blocks") / F.col("source_size")).cast("long")
    slots = F.when(F.col("source_size") > 0, F.least(slots, F.col("n_blocks") * cap)).otherwise(0)
    sources = materialise(sources.withColumn("n_slots", slots.cast("long")), "sources")
    few = small(sources)

    same_source = rows["source"].eqNullSafe(few["source"])
    named = rows.join(few, same_source).select(
        "doc_id", rows["source"], "size", "digest", "sidx", "source_size", "target"
    )
    n_buckets = max(1, rows.count() // BUCKET_ROWS)
    dealt = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size"), F.lit(n_buckets))
    # The digest orders rows alike in id and size, so that texts are placed as their sizes are.
    order, with_words = ["doc_id", "size", "digest"], named.where("size > 0")
    starts = _starts(with_words, dealt, F.col("size"))
    packed = _ranked(with_words, dealt, order, F.col("size"), "start", starts)
    named_texts = texts.where("size > 0").join(few, texts["source"].eqNullSafe(few["source"]))
    named_texts = named_texts.select("doc_id", "size", "digest", "sidx", "text")
    placed = _ranked(named_texts, dealt, order, F.col("size"), "start", starts)

    numbered = sources.select("sidx", "n_blocks", "n_slots")
    blocks = _counted(numbered, "n_blocks", "block").withColumn("hash", F.xxhash64(F.lit(seed), "sidx", "block"))
    dealt = F.pmod("hash", F.greatest(F.lit(1), F.floor(F.col("n_blocks") / BUCKET_ROWS)))
    place = F.struct(dealt.alias("bucket"), F.col("hash"), F.col("block"))
    ranked = _ranked(blocks, dealt, ["hash", "block"], F.lit(1), "index").withColumn("place", place)
    permuted = ranked.select("sidx", "index", "block")
    # A block comes in the order of its place; the last that a slot draws tells whether a piece is
    # of use at all. Sources without slots are not in the table: a row per source.
    final = ranked.where(F.col("index") == F.least("n_slots", "n_blocks") - 1).select("sidx", "n_blocks", F.col("place").alias("_last"))
    final = small(materialise(final, "last_drawn"))

    def drawn_pieces(pieces: DataFrame) -> DataFrame:
        hashed = pieces.withColumn("hash", F.xxhash64(F.lit(seed), "sidx", "block")).join(final, "sidx")
        return hashed.where(place <= F.col("_last")).select(*pieces.columns)

    drawn = _counted(numbered, "n_slots", "slot").select(
        "sidx",
        "slot",
        (F.col("slot") % F.col("n_blocks")).alias("index"),
        F.pmod(F.xxhash64(F.lit(seed + 1), "sidx", "slot"), F.lit(shards)).cast("int").alias("shard"),
    )
    # The planner sees the few sources that the numbers grow from and would broadcast all blocks.
    slots = materialise(drawn.join(permuted.hint("merge"), ["sidx", "index"]).select("shard", "sidx", "slot", "block"), "slots")
    times = slots.groupBy("sidx", "block").agg(F.count(F.lit(1)).alias("times"))

    first, last = F.col("start") / block_words, (F.col("start") + F.col("size") - 1) / block_words
    parts = packed.withColumn("block", F.explode(F.sequence(F.floor(first), F.floor(last))))
    overlap = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words) - F.greatest(
        "start", F.col("block") * block_words
    )
    columns = ["doc_id", "source", "sidx", "size", "source_size", "target"]
    taken = (
        parts.join(times, ["sidx", "block"], "left")
        .groupBy(*columns, "start")
        .agg(F.sum(overlap * F.coalesce("times", F.lit(0))).alias("taken"))
    )
    wordless = named.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    documents = taken.select(*columns, "taken").unionByName(wordless.select(*columns, "taken"))
    blocks = slots.join(_packed_blocks(placed, block_words, drawn_pieces).hint("merge"), ["sidx", "block"])
    blocks = blocks.join(small(sources.select("sidx", "source")), "sidx")
    blocks = blocks.select("shard", "sidx", "source", "slot", "block", "n_words", "text")
    return Mix(documents, slots, slots.groupBy("shard", "sidx").agg(F.count(F.lit(1)).alias("n_slots")), blocks)


def mixed_documents(docs: DataFrame, seed: int = 23, **options) -> DataFrame:
    """Rows of ``docs`` repeated as the mix takes them, with all their columns.

    A document of which the mix takes x times its words comes floor(x) times, and once more or
    not: along each source, in order of size and of a hash of the id among equals, the shares
    that are left are added up, and a document comes once more where the sum passes a half. The
    words of a source so stay within half of its largest document of what the mix takes, however
    few and long its documents are. Documents without words, of which nothing can be taken, and
    rows without an id come once. Rows that share an id come as often as the one that comes most.
    """
    taken = _mix(docs, seed=seed, **options).documents.where("doc_id IS NOT NULL AND size > 0")
    whole = F.floor(F.col("taken") / F.col("size"))
    left = F.round((F.col("taken") % F.col("size")) / F.col("size") * STEPS).cast("long")
    taken = taken.select("doc_id", "sidx", "size", whole.alias("whole"), left.alias("left"))
    taken = materialise(taken.withColumn("hash", F.xxhash64(F.lit(seed + 2), "doc_id")), "taken")
    parted = taken.where("left > 0")
    sizes = parted.groupBy("sidx", "size").agg((F.floor(F.count(F.lit(1)) / BUCKET_ROWS) + 1).alias("n_buckets"))
    parted = parted.join(small(materialise(sizes, "same_size")), ["sidx", "size"])
    dealt = F.struct(F.col("size"), F.pmod("hash", "n_buckets").alias("deal"))
    summed = _ranked(parted, dealt, ["hash", "doc_id"], F.col("left"), "before")
    step = F.floor((F.col("before") + F.col("left") + STEPS // 2) / STEPS) - F.floor((F.col("before") + STEPS // 2) / STEPS)
    copies = summed.select("doc_id", (F.col("whole") + step).cast("int").alias("_copies")).unionByName(
        taken.where("left = 0").select("doc_id", F.col("whole").cast("int").alias("_copies"))
    )
    copies = copies.groupBy("doc_id").agg(F.max("_copies").alias("_copies"))
    copies = materialise(copies.where("_copies <> 1"), "copies")
    # One struct, so that no column of the documents can clash with ours.
    held = docs.select(F.col("doc_id").alias("_id"), F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_doc"))
    out = held.join(small(copies.withColumnRenamed("doc_id", "_id")), "_id", "left")
    times = F.explode(F.array_repeat(F.lit(0), F.coalesce("_copies", F.lit(1))))
    return out.select("_doc", times.alias("_copy")).select(*[F.col("_doc").getField(name).alias(name) for name in docs.columns])
