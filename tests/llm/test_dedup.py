import math
import random

import numpy as np
import pytest

from presswork.llm import embedding_dedup, minhash_dedup
from presswork.llm.common import WordHashes, components


def reachable(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 440)] + [(7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = reachable({n for link in links for n in link}, links)
    assert found == {n: c for n, c in expected.items() if n != c}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- embeddings ------------------------------------------------------------------------------------


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(y * y for y in b))


def vectors():
    rng = np.random.default_rng(4)
    rows = []
    for group in range(12):
        centre = rng.standard_normal(16)
        for _ in range(1 if group % 3 else 20):
            rows.append([float(np.float32(x)) for x in centre + 0.12 * rng.standard_normal(16)])
    rows += [rows[0], [2 * x for x in rows[0]], rows[5]]
    return list(enumerate(rows))


@pytest.mark.parametrize("block", [512, 4])
def test_embedding_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rows = vectors()
    out = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), miss=1e-9)
    links = [(i, j) for i, a in rows for j, b in rows if i != j and cosine(a, b) >= 0.95]
    component = reachable([i for i, _ in rows], links)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out.collect()}
    assert got == {i: (sum(a == i for a, _ in links), component[i], component[i] == i) for i, _ in rows}


def test_vectors_that_link_with_nothing(spark):
    nan = float("nan")
    rows = [
        (1, None, "x"), (2, [], "x"), (3, [0.0, 0.0], "x"), (4, [nan, 1.0], "x"), (5, [1.0, None], "x"),
        (6, [1.0, 0.0], "x"), (6, [1.0, 0.0], "y"), (7, [1.0, 0.0, 0.0], "x"), (None, [1.0, 0.0], "x"),
        (8, [float("inf"), 1.0], "x"), (9, [-1.0, 0.0], "x"),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, component_id string")
    out = embedding_dedup.near_duplicates(df).collect()
    assert len(out) == len(rows)
    assert sorted((r.vec_id, r.n_links) for r in out if r.vec_id == 6) == [(6, 1), (6, 1)]
    assert all(r.n_links == 0 and r.component_id == r.vec_id and r.kept for r in out if r.vec_id != 6)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_passes_grow_with_a_small_power_of_the_table():
    few, many = (embedding_dedup.passes_needed(n, 0.95) for n in (1_000_000, 100_000_000))
    assert few < many < 2.4 * few


def test_embedding_recall_in_a_dense_cone(spark, monkeypatch):
    """2,000 of 4,399 vectors at a pairwise cosine near 0.9, with pairs right above the threshold."""
    monkeypatch.setattr(embedding_dedup, "WINDOW", 128)
    rng = np.random.default_rng(5)
    units = embedding_dedup.unit(rng.standard_normal((4000, 64)))
    centre = units[0]
    aside = embedding_dedup.unit(units - (units @ centre)[:, None] * centre + 1e-9)
    cone = np.sqrt(0.9) * centre + np.sqrt(0.1) * aside[1:1601]
    step = rng.standard_normal((400, 64))
    step = embedding_dedup.unit(step - (step * cone[:400]).sum(axis=1, keepdims=True) * cone[:400])
    table = np.concatenate([cone, 0.951 * cone[:400] + np.sqrt(1 - 0.951**2) * step, units[1601:]]).astype(np.float32)
    full = embedding_dedup.unit(table.astype(np.float64))
    a, b = np.nonzero(np.triu(full @ full.T >= 0.95, 1))
    component = reachable(range(len(table)), zip(a.tolist(), b.tolist()))
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(table)], "vec_id long, embedding array<float>")
    out = embedding_dedup.near_duplicates(df).collect()
    got = {r.vec_id: r.component_id for r in out}
    links = np.bincount(np.concatenate([a, b]), minlength=len(table))
    assert sum(r.n_links == links[r.vec_id] for r in out) >= 0.995 * len(table)
    assert len(a) >= 400
    assert sum(got[i] == got[j] for i, j in zip(a.tolist(), b.tolist())) >= 0.995 * len(a)
    assert sum(got[i] == c for i, c in component.items()) >= 0.995 * len(table)


def test_codes_split_where_vectors_are_spread(monkeypatch):
    """Runs stay even beyond the bits that the sample reaches."""
    monkeypatch.setattr(embedding_dedup, "ORDER_BITS", 0)
    units = embedding_dedup.unit(np.random.default_rng(6).standard_normal((4096, 64)) + 3)
    fitted, passes = embedding_dedup.fit(units[:512], 4096 * 16 * 12, 0.95, 1e-3, 11)
    assert fitted == 6 and len(passes[0]) == 10
    codes = embedding_dedup._codes(units @ embedding_dedup._planes(11, 0, 64, 10), passes[0], fitted)
    sizes = np.bincount(codes[:, 8], minlength=256)
    assert sizes.max() <= 6 * sizes.mean() and (sizes > 0).mean() > 0.9


@pytest.mark.parametrize("batch", [7, 64])
def test_windows_go_on_over_borders(spark, monkeypatch, batch):
    """Every pair at most a window apart in the order is found, wherever partitions end."""
    monkeypatch.setattr(embedding_dedup, "WINDOW", 16)
    monkeypatch.setattr(embedding_dedup, "PARTITION_WINDOWS", 2)
    monkeypatch.setattr(embedding_dedup, "bounded_batches", lambda spark, rows: None)
    # Every row has one partner, sixteen places on; all other vectors are at right angles.
    rows = []
    for i in range(320):
        vector = [0.0] * 160
        vector[i % 16 + 16 * (i // 32)] = 1.0
        rows.append((i, 160, vector, 0, i))
    coded = spark.createDataFrame(rows, "rep long, dim int, v array<float>, pass int, code long").repartition(3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    links = embedding_dedup._window_links(coded, "array<float>", len(rows), 0.95).distinct().collect()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {(r.a, r.b) for r in links} == {(i + 16, i) for i in range(320) if i // 16 % 2 == 0}


# --- MinHash ---------------------------------------------------------------------------------------


def shingle_set(text, words):
    found = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        found = found.replace(c, " ")
    found = [w for w in found.split(" ") if w]
    width = min(words, len(found))
    return {tuple(found[k : k + width]) for k in range(len(found) - width + 1)} if found else set()


def documents():
    rng = random.Random(6)
    words = [f"w{k}" for k in range(400)] + ["Été", "É", "Ab", "aB"]
    base = [[rng.choice(words) for _ in range(rng.randrange(1, 90))] for _ in range(30)]
    rows = []
    for k, text in enumerate(base):
        for _ in range(25 if k % 10 == 0 else 3):
            copy = list(text)
            for _ in range(rng.randrange(0, 1 + len(copy) // 12)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(rng.choice([" ", "\n", "\t "]).join(copy))
    rows += [None, "", " \n", "one", "ONE", "one two", "a b", "A b", "É x", "é x", "w1 " * 3000]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(i, rows[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize("words", [2, 5])
@pytest.mark.parametrize("few", [8, 1])
def test_minhash_links_equal_brute_force(spark, monkeypatch, words, few):
    monkeypatch.setattr(minhash_dedup, "FEW", few)
    monkeypatch.setattr(minhash_dedup, "BLOCK_ROWS", 3)
    rows = documents()
    out = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=words)
    sets = {i: shingle_set(text, words) for i, text in rows}
    links = [
        (i, j) for i, a in sets.items() for j, b in sets.items() if i < j and a and b and 100 * len(a & b) >= 80 * len(a | b)
    ]
    component = reachable(sets, links)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out.collect()}
    assert got == {i: (len(s), component[i], component[i] == i) for i, s in sets.items()}


def test_minhash_odd_rows(spark):
    rows = [(None, "a b c"), (3, "a b c"), (3, "a b c"), (4, None), (None, None), (2, "a b c"), (5, "x")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_shingles int")
    out = minhash_dedup.near_duplicates(df, words=2).collect()
    key = lambda r: tuple((v is None, v or 0) for v in r)
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in out), key=key) == sorted(
        [(None, None, True), (None, None, True), (2, 2, True), (3, 2, False), (3, 2, False), (4, 4, True), (5, 5, True)], key=key
    )
    kept = minhash_dedup.keep_one(df, minhash_dedup.near_duplicates(df, words=2))
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2", "4", "5", "None", "None"]
    again = df.unionByName(spark.createDataFrame([(5, "x", 2)], df.schema))
    assert minhash_dedup.keep_one(again, minhash_dedup.near_duplicates(again)).where("doc_id = 5").count() == 1
    assert minhash_dedup.near_duplicates(df.limit(0)).count() == 0


def test_posterior_bounds():
    steps = minhash_dedup.least_matches(0.8, 1e-6)
    assert [n for n, _ in steps] == [40, 80, 120, 160, 200]
    shares = [m / n for n, m in steps]
    assert shares == sorted(shares) and 0.2 < shares[0] < shares[-1] < 0.8


def test_signatures_go_through_in_pieces():
    codes = minhash_dedup.shingles(" ".join(f"w{k}" for k in range(3000)), 2, WordHashes())
    drawn = minhash_dedup._permutations(5)
    assert (minhash_dedup.signature(codes, *drawn, piece=7) == minhash_dedup.signature(codes, *drawn)).all()
