"""Two-pass external shuffle into shards, in DataFrame operations only.

Pass one scatters records into memory-sized buckets by a seeded hash. Pass two shuffles each
bucket by Fisher and Yates' swaps, drawn from a hash as well, and writes it. The buckets one
after the other are a random order of all records, which is cut into shards of equal counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presswork.llm.common import small
from presswork.session import materialise, new_path

SHARDS = 24
#: A bucket has about so many rows, or so many bytes of text if that is fewer.
BUCKET_ROWS = 1024
BUCKET_BYTES = 16 * 1024 * 1024
GROUP = 1024
LAW = "rows"


def fisher_yates(n: Column, *keys: Column) -> Column:
    """Pseudorandom permutation of 0 to ``n`` - 1 as an array, built from the inside out.

    Element i goes to place j, drawn from 0 to i by a hash of the keys and i; what stood there
    moves to the end.
    """

    def step(done: Column, i: Column) -> Column:
        j = F.pmod(F.xxhash64(*keys, i), i + 1).cast("int")
        swapped = F.concat(
            F.slice(done, 1, j), F.array(i), F.slice(done, j + 2, F.greatest(i - j - 1, F.lit(0))),
            F.array(F.get(done, j)),
        )
        return F.when(j == i, F.concat(done, F.array(i))).otherwise(swapped)

    return F.aggregate(F.sequence(F.lit(0), n.cast("int") - 1), F.array().cast("array<int>"), step)


def _starts(counts: DataFrame) -> DataFrame:
    """``bucket, n, before``: rows in all earlier buckets, summed by groups of buckets first."""
    counts = counts.withColumn("_group", F.floor(F.col("bucket") / GROUP))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sums = counts.groupBy("_group").agg(F.sum("n").alias("n"))
    groups = sums.select("_group", F.sum("n").over(earlier(Window.orderBy("_group"))).alias("_first"))
    inside = F.sum("n").over(earlier(Window.partitionBy("_group").orderBy("bucket")))
    found = counts.withColumn("_inside", inside).join(groups, "_group")
    before = F.coalesce("_first", F.lit(0)) + F.coalesce("_inside", F.lit(0))
    return found.select("bucket", "n", before.alias("before"))


def shuffled(
    docs: DataFrame, shards: int = SHARDS, seed: int = 31, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``shard, slot`` and the struct ``doc`` of all columns of every row.

    Shard counts are at most one apart and slots run from 0 without gaps. The order depends on
    ids, texts and the seed only, so reruns agree, except for rows equal in id and text: they may
    change places, and where there are more of them than a bucket holds they are told apart by a
    written number. Null ids and texts are hashed like others. An empty table gives no shards.
    """
    docs = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("doc"))
    id_, text = F.col(f"doc.`{id_col}`"), F.col(f"doc.`{text_col}`")
    hashed = docs.withColumn("hash", F.xxhash64(F.lit(seed), id_, text))
    totals = hashed.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("bytes")
    ).first()
    n_buckets = max(1, -(-totals.n // BUCKET_ROWS), -(-totals.bytes // BUCKET_BYTES))
    crowded = materialise(
        hashed.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BUCKET_ROWS).select("hash"), "crowded"
    )
    if not crowded.isEmpty():
        marked = hashed.join(crowded.withColumn("_many", F.lit(True)), "hash", "left")
        number = F.when(F.col("_many"), F.monotonically_increasing_id())
        hashed = materialise(marked.withColumn("hash", F.xxhash64("hash", number)).drop("_many"), "told_apart")
    dealt = hashed.withColumn("bucket", F.pmod(F.xxhash64("hash"), F.lit(n_buckets)))
    counts = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    starts = materialise(_starts(counts), "starts")

    rows = F.sort_array(F.collect_list(F.struct("hash", "doc")))
    if any(kind.startswith("map") or "map<" in kind for _, kind in docs.select("doc.*").dtypes):
        by_hash = lambda a, b: F.when(a["hash"] < b["hash"], -1).when(a["hash"] > b["hash"], 1).otherwise(0)
        rows = F.array_sort(F.collect_list(F.struct("hash", "doc")), by_hash)
    buckets = dealt.groupBy("bucket").agg(rows.alias("rows")).join(small(starts), "bucket")
    order = fisher_yates(F.col("n"), F.lit(seed), F.col("bucket"))
    placed = buckets.select("before", "rows", F.posexplode(order).alias("place", "at"))
    position = F.col("before") + F.col("place")
    least, longer = totals.n // shards, totals.n % shards
    head = longer * (least + 1)
    shard = F.when(position < head, F.floor(position / (least + 1))).otherwise(
        F.floor((position - head) / max(1, least)) + longer
    )
    slot = F.when(position < head, position % (least + 1)).otherwise((position - head) % max(1, least))
    return placed.select(
        shard.cast("int").alias("shard"), slot.cast("long").alias("slot"), F.get("rows", F.col("at"))["doc"].alias("doc")
    )


def write_shards(docs: DataFrame, path: str | None = None, shards: int = SHARDS, **options) -> DataFrame:
    """Write the shuffled records to one folder per shard under ``path`` and read them back.

    ``path`` must not exist; without one a new path in the working folder is taken. The written
    rows have the columns of ``docs`` inside ``doc``, beside ``slot`` and ``shard``, so that no
    name can clash.
    """
    spark = docs.sparkSession
    path = new_path(spark, "shards") if path is None else path
    out = shuffled(docs, shards, **options)
    out.write.partitionBy("shard").parquet(path)
    return spark.read.schema(out.select("slot", "doc", "shard").schema).parquet(path)


def shard_rows(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``, read from the written shards.

    ``size`` is the UTF-8 bytes of the text plus 8; a null text counts as no bytes. The law is
    ``rows``, for which ``grown_shard`` is null.
    """
    written = write_shards(docs, shards=shards, id_col=id_col, text_col=text_col, **options)
    text = F.coalesce(F.col(f"doc.`{text_col}`"), F.lit(""))
    return written.select(
        F.col(f"doc.`{id_col}`").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def shuffled_documents(docs: DataFrame, shards: int = SHARDS, **options) -> DataFrame:
    """All columns of ``docs`` with ``shard`` and ``slot``, which replace columns of these names."""
    written = write_shards(docs, shards=shards, **options)
    kept = [F.col(f"doc.`{name}`") for name in docs.columns if name not in ("shard", "slot")]
    return written.select(*kept, "shard", "slot")
