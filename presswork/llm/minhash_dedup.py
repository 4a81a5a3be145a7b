"""MinHash near-dedup with sequential Bayesian verification.

Documents whose banded MinHash signatures meet in a bucket are candidates. Their signatures are
compared batch by batch, and a pair is given up as soon as the posterior probability that its
similarity reaches the threshold falls below the chosen miss probability. What survives is
verified on the full shingle sets. Only links that can still join two components are tried:
first each document with the head of its buckets, then what those links left apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.common import WordHashes, bounded_batches, components, mix64, small
from presswork.operators.skew import global_rank
from presswork.session import discard, materialise

BANDS = 40
BAND_ROWS = 5
BATCH = 40
MISS = 1e-6
#: Buckets of up to so many members give their pairs as rows; larger ones are compared in blocks.
FEW = 8
BLOCK_ROWS = 1024
BLOCK_BYTES = 32 * 1024 * 1024
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, words: int, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a whole text.

    Words are runs of anything but ASCII white space, A-Z in lower case. A text with fewer
    words than ``words`` is one shingle; no words give an empty set.
    """
    found = text.encode().lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    width = min(words, len(codes))
    total = np.zeros(len(codes) - width + 1, np.uint64)
    for k in range(width):
        total = mix64(total * _STEP + codes[k : len(codes) - width + 1 + k])
    return np.unique(total)


def _permutations(seed: int) -> tuple[np.ndarray, np.ndarray]:
    drawn = np.random.default_rng(seed).integers(0, 2**64, (2, BANDS * BAND_ROWS), np.uint64)
    return drawn[0] | np.uint64(1), drawn[1]


def signature(codes: np.ndarray, factors: np.ndarray, shifts: np.ndarray, piece: int = 512) -> np.ndarray:
    """Minimum of each permutation; long sets go through in pieces."""
    lowest = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(codes), piece):
        values = factors[:, None] * codes[None, at : at + piece]
        values += shifts[:, None]
        np.minimum(lowest, values.min(axis=1), out=lowest)
    return lowest


def buckets(lowest: np.ndarray) -> np.ndarray:
    """One 64-bit bucket per band, different between bands."""
    total = np.arange(BANDS, dtype=np.uint64)
    for column in lowest.reshape(BANDS, BAND_ROWS).T:
        total = mix64(total * _STEP + column)
    return total.view(np.int64)


def least_matches(threshold: float, miss: float) -> list[tuple[int, int]]:
    """(hashes compared, matches below which a pair is given up) after each batch.

    With a uniform prior, P(similarity >= t | m of n match) is P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(BATCH, BANDS * BAND_ROWS + 1, BATCH):
        total, m = 0.0, 0
        while True:
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def _survives(threshold: float, miss: float):
    steps = least_matches(threshold, miss)

    @F.pandas_udf("boolean")
    def survives(left: pd.Series, right: pd.Series) -> pd.Series:
        a = np.frombuffer(b"".join(left), np.uint16).reshape(len(left), -1)
        b = np.frombuffer(b"".join(right), np.uint16).reshape(len(right), -1)
        alive, matches = np.arange(len(a)), np.zeros(len(a), int)
        for n, least in steps:
            matches[alive] += (a[alive, n - BATCH : n] == b[alive, n - BATCH : n]).sum(axis=1)
            alive = alive[matches[alive] >= least]
        out = np.zeros(len(a), bool)
        out[alive] = True
        return pd.Series(out)

    return survives


def _similar(percent: int):
    @F.pandas_udf("boolean")
    def similar(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(left, right):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            out.append(100 * both >= percent * (len(a) + len(b) - both))
        return pd.Series(out, dtype=bool)

    return similar


def _sign(docs: DataFrame, words: int, seed: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, (factors, shifts) = WordHashes(), _permutations(seed)
        for batch in batches:
            size, key, bands, short = [], [], [], []
            for text in batch.column(1):
                codes = shingles(text.as_py(), words, hashes)
                size.append(len(codes))
                if not len(codes):
                    key.append(None), bands.append(None), short.append(None)
                    continue
                lowest = signature(codes, factors, shifts)
                key.append(xxhash.xxh3_128_digest(codes.tobytes()))
                bands.append(buckets(lowest))
                short.append(lowest.astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(size, pa.int64()),
                    pa.array(key, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(short, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "key", "buckets", "sig"],
            )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, key binary, buckets array<long>, sig binary")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(text.as_py(), words, hashes).tobytes() for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["id", "codes"])

    return docs.mapInArrow(run, "id long, codes binary")


def _both(pairs: DataFrame, table: DataFrame, value: str, test) -> DataFrame:
    """Pairs ``a, b`` for which ``test`` holds on the values looked up for both."""
    left = table.select(F.col("id").alias("a"), F.col(value).alias("left"))
    right = table.select(F.col("id").alias("b"), F.col(value).alias("right"))
    return pairs.join(left, "a").join(right, "b").where(test("left", "right")).select("a", "b")


def _block_links(members: DataFrame, heads: DataFrame, sets: DataFrame, percent: int, miss: float) -> DataFrame:
    """Links between components inside large buckets, enough of them to join what they join.

    Buckets that share documents form a crowd, so that a document is dealt out once however many
    of its buckets are large. A crowd is cut into blocks of bounded rows and bytes, and each pair
    of blocks is one task's group. Pairs of different components that meet in some bucket go
    through the same sequence of signature batches and exact verification as elsewhere; one whose
    components this task has joined already is left out.
    """
    stars = members.where("id <> head").select(F.col("id").alias("a"), F.col("head").alias("b"))
    crowds = materialise(components(stars), "crowds")
    crowds = crowds.select(F.col("node").alias("id"), F.col("component").alias("crowd"))
    rows = members.select("id", "component").distinct().join(crowds, "id", "left")
    rows = rows.withColumn("crowd", F.coalesce("crowd", "id"))
    rows = rows.join(heads, "id").join(sets, "id")
    sizes = rows.groupBy("crowd").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("codes")).alias("bytes"))
    n_blocks = F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("bytes") / BLOCK_BYTES), F.lit(1)).cast("int")
    sizes = materialise(sizes.select("crowd", n_blocks.alias("n_blocks")), "sizes")
    cut = rows.join(sizes, "crowd").withColumn("block", F.pmod(F.xxhash64("id"), F.col("n_blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    cut = cut.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
    steps = least_matches(percent / 100, miss)

    def compare(key, part: pd.DataFrame) -> pd.DataFrame:
        _, lo, hi = key
        ids, comps, block = part["id"].to_numpy(), part["component"].to_numpy(), part["block"].to_numpy()
        bands = np.stack(part["buckets"].to_numpy())
        sigs = np.frombuffer(b"".join(part["sig"]), np.uint16).reshape(len(part), -1)
        codes = [np.frombuffer(c, np.uint64) for c in part["codes"]]
        here = np.nonzero(block == hi)[0]
        joined: dict[int, int] = {}

        def root(c: int) -> int:
            while c in joined:
                c = joined[c]
            return c

        found = []
        for i in np.nonzero(block == lo)[0]:
            others = here[here > i] if lo == hi else here
            others = others[comps[others] != comps[i]]
            others = others[(bands[others] == bands[i]).any(axis=1)]
            matches = np.zeros(len(others), int)
            for n, least in steps:
                matches += (sigs[others, n - BATCH : n] == sigs[i, n - BATCH : n]).sum(axis=1)
                others, matches = others[matches >= least], matches[matches >= least]
            for j in others[np.argsort(-matches, kind="stable")]:
                a, b = root(comps[i]), root(comps[j])
                if a == b:
                    continue
                both = len(np.intersect1d(codes[i], codes[j], assume_unique=True))
                if 100 * both >= percent * (len(codes[i]) + len(codes[j]) - both):
                    joined[max(a, b)] = min(a, b)
                    found.append((ids[i], ids[j]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    columns = ["crowd", "lo", "hi", "block", "id", "component", "buckets", "sig", "codes"]
    return cut.select(*columns).groupBy("crowd", "lo", "hi").applyInPandas(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    miss: float = MISS,
    seed: int = 5,
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Two documents link when 100 * common shingles >= ``percent`` * shingles of either. Equal
    sets are one class and are never expanded into pairs. Documents without words, null texts
    among them, link with nothing. Rows without an id stay alone, with a null component; rows
    that share an id are one node. An empty table gives an empty result.

    ``miss`` is the posterior probability at which a pair is given up; with 40 bands of 5 a
    pair right at 0.8 meets in no bucket with probability 1e-7.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch: list[DataFrame] = []

    def written(df: DataFrame, name: str) -> DataFrame:
        scratch.append(materialise(df, name))
        return scratch[-1]

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = written(_sign(texts, words, seed), "signatures")
    named = signed.where("key IS NOT NULL AND doc_id IS NOT NULL")
    classes = written(named.groupBy("key").agg(F.min("doc_id").alias("id")), "classes")
    heads = named.select(F.col("doc_id").alias("id"), "key", "buckets", "sig").join(classes, ["id", "key"])
    heads = written(heads.dropDuplicates(["id", "key"]).select("id", "buckets", "sig"), "heads")
    placed = heads.select("id", F.explode("buckets").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.min("id").alias("head"), F.max("id").alias("last"))
    shared = written(shared.where("head < last").select("bucket", "head"), "buckets")
    met = written(placed.join(shared, "bucket"), "met")

    survives, similar = _survives(percent / 100, miss), _similar(percent)
    sigs = heads.select("id", "sig")

    def verified(pairs: DataFrame) -> DataFrame:
        alive = written(_both(pairs, sigs, "sig", survives), "alive")
        ids = alive.select(F.col("a").alias("doc_id")).union(alive.select("b")).distinct()
        ids = written(ids, "ids")
        needed = texts.join(small(ids), "doc_id", "left_semi")
        sets = written(_sets(needed, words), "sets")
        return _both(alive, sets, "codes", similar)

    first = met.where("id <> head").select(F.col("id").alias("a"), F.col("head").alias("b")).distinct()
    first = written(first, "pairs")
    links = written(verified(first), "linked")
    found = written(components(links), "components")

    # Buckets that still hold several components. In a small one the pairs left are few; in a
    # large one they are compared in blocks inside tasks, and only links leave the task.
    side = found.select(F.col("node").alias("id"), "component")
    placed = met.join(side, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = placed.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("members")
    )
    mixed = written(mixed.where("low < high").select("bucket", "members"), "mixed")
    placed = written(placed.select("bucket", "head", "id", "component").join(mixed, "bucket"), "apart")

    few = placed.where(F.col("members") <= FEW)
    left = few.select("bucket", F.col("id").alias("a"), F.col("component").alias("ca"))
    right = few.select("bucket", F.col("id").alias("b"), F.col("component").alias("cb"))
    across = left.join(right, "bucket").where("a < b AND ca <> cb").select("a", "b").distinct()
    tried = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    across = written(across.join(tried, ["a", "b"], "left_anti"), "pairs")
    late = [written(verified(across), "linked")]

    many = placed.where(F.col("members") > FEW)
    ids = written(many.select(F.col("id").alias("doc_id")).distinct(), "ids")
    if not ids.isEmpty():
        sets = written(_sets(texts.join(small(ids), "doc_id", "left_semi"), words), "sets")
        late.append(written(_block_links(many, heads, sets, percent, miss), "linked"))
    for more in late:
        if not more.isEmpty():
            links = links.unionByName(more)
            found = None
    found = written(components(links), "components") if found is None else found

    side = found.select(F.col("node").alias("id"), "component")
    grouped = classes.join(side, "id", "left").select("key", F.coalesce("component", "id").alias("component"))
    grouped = materialise(grouped, "groups")
    rows = materialise(signed.select("doc_id", "n_shingles", "key"), "rows")
    discard(*scratch)
    out = rows.join(grouped, "key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def keep_one(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents of ``docs`` that lead their group, with all columns.

    Rows that repeat the id of a kept document go too, except where the id is null.
    """
    lost = groups.where(~F.col("kept")).select(F.col("doc_id").alias(id_col)).distinct()
    stay = docs.join(small(materialise(lost, "lost")), id_col, "left_anti")
    counts = docs.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").select(id_col)
    repeated = materialise(counts, "repeated")
    if repeated.isEmpty():
        return stay
    repeated = small(repeated)
    once = stay.join(repeated, id_col, "left_semi").dropDuplicates([id_col])
    return stay.join(repeated, id_col, "left_anti").unionByName(once)


def drop_copies(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group of near copies, with all columns.

    Rows without words, null texts among them, and rows without an id stay. Where rows share an
    id, each counts for itself: they are numbered in order of id and text, and the group's first
    stays, so that no text goes that is not a copy.
    """
    counts = docs.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1")
    if counts.isEmpty():
        return keep_one(docs, near_duplicates(docs, words, percent, id_col, text_col), id_col)
    held = docs.select(
        F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_hash"), F.col(text_col).alias("_text"),
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_doc"),
    )
    named = global_rank(held.where("_id IS NOT NULL"), ["_id", "_hash"])
    kept = keep_one(named, near_duplicates(named, words, percent, "rank", "_text"), "rank").select("_doc")
    every = kept.unionByName(held.where("_id IS NULL").select("_doc"))
    return every.select(*[F.col("_doc").getField(name).alias(name) for name in docs.columns])
