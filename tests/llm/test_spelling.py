import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from presswork.llm import spelling


def near(a, b):
    """One inserted, deleted or replaced code point, by trying all of them."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def brute(rows):
    words, out = brute_words(rows), {}
    for w, n in words.items():
        others = [o for o in words if near(w, o)]
        best = min(others, key=lambda o: (-words[o], o), default=None)
        out[w] = (best if best is not None and words[best] >= 2 * n else None, n, len(others))
    table = {}
    for w, (form, n, n_near) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        table[w] = (form, root, n, n_near, None if form is None else words[form])
    return table


def corpus():
    rng = random.Random(3)
    base = ["".join(rng.choice("abcé") for _ in range(rng.randrange(4, 11))) for _ in range(60)] + ["ÿÿÿÿÿÿ", "aaaaa", "aaaaaa", "a" * 200]
    base += [w[:k] + rng.choice("abcé") + w[k + rng.randrange(2) :] for w in base for k in [rng.randrange(len(w) + 1)]]
    rows = []
    for k in range(400):
        words = [rng.choice(base[: 1 + rng.randrange(len(base))]) for _ in range(rng.randrange(1, 40))]
        rows.append((k, rng.choice([" ", "-", "3"]).join(rng.choice([w, w.upper(), w.title()]) for w in words)))
    return rows + [(None, "Abcab abcab"), (None, None), (7, ""), (8, "..."), (1, rows[1][1]), (1, rows[1][1])]


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, word int")
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(df, **options).collect()}


@pytest.mark.parametrize("frequency", [0, 3, 1000])
def test_variants_equal_brute_force(spark, monkeypatch, frequency):
    monkeypatch.setattr(spelling.near_words, "__defaults__", (3, 7 if frequency == 3 else 5, 500_000, frequency))
    expected = brute(corpus())
    assert any(r[1] != r[0] is not None for r in expected.values()) and len(expected) > 80
    assert found(spark, corpus()) == expected


def test_every_slip_is_made(spark):
    rows = [(k, "wonderful mountains señorita") for k in range(600)]
    assert found(spark, rows) == brute(rows)
    assert any(r[0] == "wonderful" for r in found(spark, rows).values())


def test_no_words(spark):
    assert found(spark, [(1, None), (2, ""), (None, "a b"), (3, "once twice")]) == {}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(empty).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(empty, min_length=3)


def test_words_counted_in_pieces(spark, monkeypatch):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(spelling, "TASK_WORDS", 3)
    assert {r.word: r.n for r in spelling.vocabulary(df).collect()} == brute_words(rows)


def test_near_words_share_a_key_unless_both_are_open():
    """For random dictionaries, all words of a small alphabet that one edit parts."""
    rng = random.Random(9)
    for above in (0, 2, 8, 40):
        words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(5, 16))) for _ in range(300)})
        data, bounds = spelling.flat(words)
        room = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(data))
        grams = [np.unique(spelling.packed(data, q)[room >= q], return_counts=True) for q in range(3, 7)]
        codes, counts = np.concatenate([g for g, _ in grams]), np.concatenate([n for _, n in grams])
        known = spelling.GramDictionary(codes[counts > above], counts[counts > above], 3, 6)
        number, key, is_open = spelling.index_keys(words, known, 0)
        keys = [set(key[number == k].tolist()) for k in range(len(words))]
        pairs = [(i, j) for i in range(len(words)) for j in range(i) if near(words[i], words[j])]
        assert pairs and all(keys[i] & keys[j] or (is_open[i] and is_open[j]) for i, j in pairs)
        fixed = spelling.GramDictionary(known.grams, known.counts, 3, 3)
        number, key, is_open = spelling.index_keys(words, fixed, 1)
        keys = [set(key[number == k].tolist()) for k in range(len(words))]
        assert not is_open.any() and all(keys[i] & keys[j] for i, j in pairs)
