import hashlib
import random

import numpy as np
import pytest
import xxhash

from presswork.llm import fingerprints as lz


def phrases(text):
    """The plain parse: a phrase ends where it is new."""
    seen, now = set(), ""
    for c in text:
        now += c
        if now not in seen:
            seen.add(now)
            now = ""
    return seen


def print_of(text, hashes):
    return sorted({xxhash.xxh32_intdigest(p) for p in phrases(text)})[:hashes]


def like(a, b, hashes):
    if not a and not b:
        return 1.0
    lowest = sorted(set(a) | set(b))[:hashes]
    return len(set(a) & set(b) & set(lowest)) / len(lowest)


def brute(rows, hashes):
    signed = lambda v: v - (1 << 64) if v >= 1 << 63 else v
    tie = lambda t: signed(xxhash.xxh64_intdigest(t.encode(), 42))
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), tie(r[1])))
    out = []
    for k, (doc_id, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        own, changed, other = (print_of(t, hashes) for t in (text, edited, following))
        out.append((
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(f"{h:08x}" for h in own),
            "".join(f"{h:08x}" for h in changed), like(own, changed, hashes), like(own, other, hashes),
        ))
    return out


def documents():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeé😀 ") for _ in range(rng.randrange(1, 9))) for _ in range(200)]
    rows = [(3 * k, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 150)))) for k in range(60)]
    rows += [(200, None), (201, ""), (202, "a"), (203, "ab"), (204, "abc"), (205, "z" * 5000), (206, rows[4][1]), (None, "no id"), (None, None)]
    rows += [(12, "twice"), (12, "twice"), (207, " ".join(rng.choice(words) for _ in range(20_000)))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("run_rows, hashes", [(1024, 128), (4, 16), (1, 128)])
def test_fingerprints_equal_brute_force(spark, run_rows, hashes):
    rows = documents()
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, run string").repartition(3)
    out = lz.fingerprints(df, run_rows=run_rows, hashes=hashes)
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted((tuple(r) for r in out.collect()), key=lambda r: str(key(r))) == sorted(
        brute(rows, hashes), key=lambda r: str(key(r))
    )


def test_one_document_and_none(spark):
    one = lz.fingerprints(spark.createDataFrame([(5, "abcabc")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.n_chars, r.near_next) for r in one] == [(5, 6, 1.0)]
    assert one[0].edited_sha256 == hashlib.sha256(b"abcaab").hexdigest()
    assert lz.fingerprints(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_parse_continues_where_a_shared_beginning_ends():
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("ab") for _ in range(rng.randrange(0, 60)))
        seen = set()
        at = lz.parse(text[: rng.randrange(0, len(text) + 1)], seen)
        lz.parse(text, seen, at)
        assert seen == phrases(text)


def test_likeness_estimates_the_share_of_common_phrases():
    rng = np.random.default_rng(1)
    for share in (0.1, 0.5, 0.9):
        a = {f"p{k}" for k in range(20_000)}
        b = {f"p{k}" for k in range(int(20_000 * (1 - share)), int(20_000 * (2 - share)))}
        got = lz.likeness(lz.smallest(a), lz.smallest(b))
        assert abs(got - share / (2 - share)) < 0.15
    assert lz.likeness(lz.fingerprint(""), lz.fingerprint(None)) == 1.0
    assert lz.likeness(lz.fingerprint("a"), lz.fingerprint("")) == 0.0 and rng is not None
