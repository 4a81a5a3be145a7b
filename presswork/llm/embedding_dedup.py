"""Embedding near-dedup by sorted projection passes.

Each pass gives every vector a code of concatenated random hashes, one bit a hyperplane. The
first bits split at the medians of a sample that reached the same prefix, the later ones at the
medians of the last such prefix, so that the codes of a dense cone differ as those of the rest
do. Vectors are ordered by code and compared exactly with their neighbours in the order, in
windows that go on over the borders of partitions; a run of equal prefixes too long for a window
is compared whole, in blocks. Passes follow from how often probe pairs right at the threshold
share a prefix. Verified pairs of all passes are united to components, and inside each component
every vector is compared with every other, block by block, so that link counts are whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.common import bounded_batches, components, small
from presswork.session import materialise

#: A vector is compared with at least so many neighbours on either side.
WINDOW = 1024
#: Mean share of ``WINDOW`` that runs of equal prefixes may fill, so that few of them are larger.
ROOM = 0.75
#: Bits beyond the prefix, which order the vectors of a run.
ORDER_BITS = 4
#: Windows a partition of the sorted order holds, and partitions at most.
PARTITION_WINDOWS, PARTITIONS = 16, 20_000
MISS = 1e-3
BLOCK = 512
#: Rows and values of the sample that hashes are fitted to, and sample rows a prefix at least.
SAMPLE_ROWS = (4096, 20_000)
SAMPLE_VALUES = 4_000_000
PREFIX_SAMPLE = 8
#: Trial passes and probes that the passes are measured with; the worst ``1 / SLICE`` of them counts.
TRIALS = 32
#: Beyond so many passes it is tried whether comparing everything costs less.
MOST_PASSES = 64
PROBES = 1024
SLICE = 32


def prefix_bits(n_vectors: int) -> int:
    """Bits after which a run of equal prefixes holds at most ``ROOM`` of a window, if runs are even."""
    return max(0, math.ceil(math.log2(max(1, n_vectors) / (ROOM * WINDOW))))


def passes_needed(n_vectors: int, threshold: float, miss: float = MISS) -> int:
    """Passes after which a pair right at ``threshold`` has shared no prefix with probability ``miss``,
    for codes that are spread evenly: the least number, whatever the probes say.

    Each bit agrees with probability 1 - angle / pi, so passes grow with a small power of the table.
    """
    return _passes((1 - math.acos(threshold) / math.pi) ** prefix_bits(n_vectors), miss)


def _passes(together: float, miss: float) -> int:
    """Passes for a pair that one pass brings together with probability ``together``."""
    return max(2, math.ceil(math.log(miss) / math.log1p(-max(1e-9, together)))) if together < 1 else 2


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _matrix(column: pd.Series) -> np.ndarray:
    return unit(np.stack(column.to_numpy()).astype(np.float64))


def _min_labels(linked: np.ndarray) -> np.ndarray:
    """Smallest index reachable by a symmetric boolean matrix."""
    labels = np.arange(len(linked))
    while True:
        new = np.where(linked, labels, len(labels)).min(axis=1)
        new = np.minimum(labels, new[new])
        if (new == labels).all():
            return labels
        labels = new


def _planes(seed: int, k: int, dim: int, bits: int) -> np.ndarray:
    """Normals of the hashes of pass ``k``, one column a bit."""
    return np.random.default_rng([seed, k, dim]).standard_normal((bits, dim)).T


def _medians(values: np.ndarray, group: np.ndarray, n_groups: int) -> np.ndarray:
    """Median of the values of each group, of all values for a group without any."""
    order = np.lexsort((values, group))
    bounds = np.searchsorted(group[order], np.arange(n_groups + 1))
    start, end = bounds[:-1], bounds[1:]
    ranked = values[order]
    lower = ranked[np.clip((start + end - 1) // 2, 0, len(values) - 1)]
    upper = ranked[np.clip((start + end) // 2, 0, len(values) - 1)]
    return np.where(end > start, (lower + upper) / 2, np.median(values))


def _cuts(values: np.ndarray, fitted: int) -> list[np.ndarray]:
    """Split values of every bit from the sample's projections (rows x bits): one for each prefix of
    the bits before it, but of the first ``fitted`` bits at most."""
    prefix, cuts = np.zeros(len(values), dtype=np.int64), []
    for bit in range(values.shape[1]):
        column = values[:, bit]
        cuts.append(_medians(column, prefix, 2 ** min(bit, fitted)).astype(np.float32))
        if bit < fitted:
            prefix = 2 * prefix + (column > cuts[bit][prefix])
    return cuts


def _codes(values: np.ndarray, cuts: list[np.ndarray], fitted: int) -> np.ndarray:
    """Code of each row after every bit, the empty code first (rows x bits + 1)."""
    codes = np.zeros((len(values), len(cuts) + 1), dtype=np.int64)
    for bit, cut in enumerate(cuts):
        column = values[:, bit]
        codes[:, bit + 1] = 2 * codes[:, bit] + (column > cut[codes[:, min(bit, fitted)]])
    return codes


def _probe_pairs(units: np.ndarray, threshold: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Sampled vectors with partners right at ``threshold``: one in a random direction, one
    towards the nearest other vector of the sample."""
    probes = units[rng.permutation(len(units))[:PROBES]]
    alike = probes @ units.T
    alike[alike > 1 - 1e-9] = -2
    pairs = []
    for ahead in (rng.standard_normal(probes.shape), units[alike.argmax(axis=1)]):
        aside = ahead - (ahead * probes).sum(axis=1, keepdims=True) * probes
        length = np.linalg.norm(aside, axis=1, keepdims=True)
        some = length[:, 0] > 1e-6
        partner = threshold * probes[some] + math.sqrt(1 - threshold**2) * (aside[some] / length[some])
        pairs.append((probes[some], partner))
    return np.concatenate([p for p, _ in pairs]), np.concatenate([q for _, q in pairs])


def fit(units: np.ndarray, n_vectors: int, threshold: float, miss: float, seed: int) -> tuple[int, list]:
    """Fitted bits, and the split values of every pass, for ``n_vectors`` vectors like ``units``.

    Of the probe pairs the slice that half of the trial passes part most often is judged by the
    other half. A prefix has as many bits as the table needs, whether or not the sample reaches so far.
    """
    dim, bits = units.shape[1], prefix_bits(n_vectors)
    fitted = min(bits + ORDER_BITS, max(0, int(math.log2(max(1, len(units) / PREFIX_SAMPLE)))))
    passes = passes_needed(n_vectors, threshold, miss)
    if bits:
        left, right = _probe_pairs(units, threshold, np.random.default_rng([seed, dim]))
        hits = np.zeros((2, len(left)))
        for k in range(TRIALS):
            planes = _planes(seed, k, dim, bits)
            cuts = _cuts(units @ planes, min(fitted, bits))
            same = [_codes(side @ planes, cuts, min(fitted, bits))[:, -1] for side in (left, right)]
            hits[k % 2] += same[0] == same[1]
        worst = np.argsort(hits[0], kind="stable")[: max(1, len(left) // SLICE)]
        passes = max(passes, _passes(hits[1, worst].mean() / (TRIALS // 2), miss))
    if passes > MOST_PASSES and 2 * passes * WINDOW >= n_vectors:
        # The codes tell these vectors apart too badly: one run of all of them costs less.
        return 0, [[]]
    return fitted, [_cuts(units @ _planes(seed, k, dim, bits + ORDER_BITS), fitted) for k in range(passes)]


def _spanning(vectors: np.ndarray, ids: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is linked among some vectors: each id with the first of its group."""
    linked = vectors @ vectors.T >= threshold
    np.fill_diagonal(linked, True)
    some = np.nonzero(linked.sum(axis=1) > 1)[0]
    labels = some[_min_labels(linked[np.ix_(some, some)])] if len(some) else some
    moved = labels != some
    return ids[some[moved]], ids[labels[moved]]


def _window_links(coded: DataFrame, kind: str, n_rows: int, threshold: float) -> DataFrame:
    """Spanning links among neighbours of the sorted order of every pass.

    A partition of the order is read in pieces of ``WINDOW`` rows, each compared with the one before
    it. The first and last ``WINDOW`` rows of a partition are kept as well, and those on the two sides
    of a border are compared like pieces. A partition too short for that is dealt out again.
    """
    order = ["dim", "pass", "code", "rep"]
    parts = max(1, min(PARTITIONS, n_rows // (PARTITION_WINDOWS * WINDOW)))
    window = WINDOW

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting, n = [], 0
        for batch in batches:
            waiting.append(batch)
            n += len(batch)
            while n >= window:
                whole = pd.concat(waiting, ignore_index=True)
                yield whole.iloc[:window]
                waiting, n = [whole.iloc[window:]], n - window
        if n:
            yield pd.concat(waiting, ignore_index=True)

    def links_of(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for _, part in rows.groupby(["dim", "pass"]):
            a, b = _spanning(_matrix(part["v"]), part["rep"].to_numpy(), threshold)
            yield pd.DataFrame({"a": a, "b": b})

    def filled(found: pd.DataFrame) -> pd.DataFrame:
        columns = ["a", "b", "border", "n", "rep", "dim", "pass", "v"]
        return found.assign(**{name: None for name in columns if name not in found})[columns]

    def slide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before, total, part = None, 0, 0
        for piece in pieces(batches):
            part = int(piece["part"].iloc[0])
            if before is None:
                yield filled(piece.assign(border=part - 1))
            both = piece if before is None else pd.concat([before, piece], ignore_index=True)
            for found in links_of(both):
                yield filled(found)
            before, total = both.iloc[-window:], total + len(piece)
        if before is not None:
            yield filled(before.assign(border=part))
            yield filled(pd.DataFrame({"n": [total]}))

    schema = f"a long, b long, border int, n long, rep long, dim int, pass int, v {kind}"
    while True:
        ordered = coded.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        out = ordered.withColumn("part", F.spark_partition_id()).mapInPandas(slide, schema)
        out = materialise(out, "windows")
        counts = out.where("n IS NOT NULL").agg(F.count("n"), F.min("n")).first()
        if parts == 1 or (counts[0] == parts and counts[1] >= window):
            break
        parts //= 2

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([pd.DataFrame({"a": [], "b": []}, dtype="int64"), *links_of(rows)])

    sides = out.where("border IS NOT NULL").select("border", "rep", "dim", "pass", "v")
    across = sides.groupBy("border").applyInPandas(compare, "a long, b long")
    return out.where("a IS NOT NULL").select("a", "b").unionByName(across)


def _run_links(coded: DataFrame, threshold: float, seed: int) -> DataFrame:
    """Spanning links inside the runs of equal prefixes that are longer than a window."""
    run = ["dim", "pass", "prefix"]
    coded = coded.withColumn("prefix", F.shiftright("code", ORDER_BITS))
    sizes = coded.groupBy(*run).count().where(F.col("count") > WINDOW)
    pieces = F.ceil(2 * F.col("count") / WINDOW).cast("int")
    sizes = materialise(sizes.select(*run, pieces.alias("pieces")), "run_sizes")
    # Two pieces at a time: every pair of rows of the run meets, those of one piece several times.
    others = F.array_remove(F.sequence(F.lit(0), F.col("pieces") - 1), F.col("piece"))
    in_pieces = (
        coded.join(small(sizes), run)
        .withColumn("piece", F.pmod(F.xxhash64("rep", F.lit(seed)), F.col("pieces")).cast("int"))
        .withColumn("other", F.explode(others))
        .select(*run, F.least("piece", "other").alias("lo"), F.greatest("piece", "other").alias("hi"), "rep", "v")
    )

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("rep")
        a, b = _spanning(_matrix(part["v"]), part["rep"].to_numpy(), threshold)
        return pd.DataFrame({"a": a, "b": b})

    return in_pieces.groupBy(*run, "lo", "hi").applyInPandas(compare, "a long, b long")


def near_duplicates(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.95,
    miss: float = MISS,
    seed: int = 11,
) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    Rows whose vector is null, empty, zero or holds null or non-finite parts, or whose id is
    null, link with nothing and stay their own component (null for a null id). Equal vectors
    are compared once and counted as often as they occur; rows that share an id are one node.
    Vectors of different lengths never link. An empty table gives an empty result.

    A pass moves every vector once, those at partition borders twice, and those of a run above
    ``WINDOW`` more often. Passes grow with a small power of the table and with how closely its
    vectors lie (``fit``). Equal codes are ordered by id. Counting links inside a component costs
    its size squared, in blocks of ``BLOCK`` vectors of which a task holds two.
    """
    spark = df.sparkSession
    bounded_batches(spark, 4096)
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    broken = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("v", lambda x: x != 0)
    usable = F.coalesce(F.col("vec_id").isNotNull() & (F.size("v") > 0) & ~broken & some, F.lit(False))
    rows = rows.withColumn("v", F.when(usable, F.transform("v", lambda x: x + F.lit(0).cast("float"))))
    distinct = rows.where("v IS NOT NULL").groupBy("v").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")
    )
    distinct = materialise(distinct.withColumn("dim", F.size("v")), "vectors")

    hashes, n_rows = {}, 0
    for dim, count in [tuple(r) for r in distinct.groupBy("dim").count().collect()]:
        hashes[dim] = 0, [[]]
        if count > WINDOW:
            wanted = min(max(SAMPLE_ROWS[0], count * 2 * PREFIX_SAMPLE // WINDOW), SAMPLE_ROWS[1], SAMPLE_VALUES // dim + 64)
            chance = int((1 << 30) * min(1.0, wanted / count))
            drawn = F.pmod(F.xxhash64(F.lit(seed), "rep", "v"), F.lit(1 << 30)) < chance
            sample = distinct.where(F.col("dim") == dim).where(drawn).select("rep", "v").toPandas().sort_values("rep")
            if len(sample):
                hashes[dim] = fit(_matrix(sample["v"]), count, threshold, miss, seed)
        n_rows += count * len(hashes[dim][1])

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                fitted, passes = hashes[int(dim)]
                units = _matrix(part["v"])
                codes = [
                    _codes(units @ _planes(seed, k, int(dim), len(cuts)), cuts, fitted)[:, -1]
                    for k, cuts in enumerate(passes)
                ]
                yield pd.DataFrame(
                    {"rep": part["rep"], "dim": part["dim"], "codes": list(np.stack(codes, axis=1)), "v": part["v"]}
                )

    kind = rows.schema["v"].dataType.simpleString()
    signed = distinct.select("rep", "dim", "v").mapInPandas(sign, f"rep long, dim int, codes array<long>, v {kind}")
    signed = materialise(signed, "codes")
    coded = signed.select("rep", "dim", "v", F.posexplode("codes").alias("pass", "code"))
    links = _window_links(coded, kind, n_rows, threshold).unionByName(_run_links(coded, threshold, seed))
    found = materialise(components(links), "components")

    heads = found.select(F.col("component").alias("node"), "component").distinct()
    members = materialise(found.unionByName(heads), "members")
    sizes = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("n_blocks"))
    in_blocks = (
        members.join(materialise(sizes, "sizes"), "component")
        .join(distinct.withColumnRenamed("rep", "node"), "node")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .select(
            "component", "dim", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
            "block", "node", "n", "v",
        )
    )

    def count_links(key, part: pd.DataFrame) -> pd.DataFrame:
        units, n = _matrix(part["v"]), part["n"].to_numpy()
        left = (part["block"] == key[2]).to_numpy()
        ids = part["node"].to_numpy()
        if key[2] == key[3]:
            total = (units @ units.T >= threshold) @ n
            return pd.DataFrame({"node": ids, "linked": total})
        linked = units[left] @ units[~left].T >= threshold
        return pd.DataFrame(
            {
                "node": np.concatenate([ids[left], ids[~left]]),
                "linked": np.concatenate([linked @ n[~left], linked.T @ n[left]]),
            }
        )

    counted = in_blocks.groupBy("component", "dim", "lo", "hi").applyInPandas(count_links, "node long, linked long")
    linked = counted.groupBy("node").agg(F.sum("linked").alias("linked"))
    known = members.join(linked, "node")
    classes = distinct.join(known, distinct["rep"] == known["node"], "left").select(
        "v",
        F.greatest(F.coalesce("linked", "n"), "n").alias("linked"),
        F.coalesce("component", "rep").alias("component"),
    )
    classes = materialise(classes, "classes")
    out = rows.join(classes, "v", "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.greatest(F.coalesce("linked", F.lit(1)) - 1, F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
