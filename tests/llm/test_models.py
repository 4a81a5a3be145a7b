import random
import zlib

import pytest

from presswork.llm import html_extraction, language_id, toxicity
from presswork.llm.html_blocks import blocks
from presswork.llm.html_training import labelled_pages

SF_DIR = "/root/testdata/sf0.1"
ODD = [(1, None), (None, "some text here"), (2, ""), (3, "123 !?"), (4, "word " * 30_000), (5, "x"), (5, "x")]


def is_held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


# --- toxicity --------------------------------------------------------------------------------------


def test_toxicity_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    out = toxicity.score_documents(docs, labels)
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert all(is_held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    toxic = [r.predicted for r in rows if r.toxic == 1]
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert sum(toxic) >= 0.75 * len(toxic) and sum(clean) <= 0.005 * len(clean)


def test_toxicity_of_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, 1.0, 1) for i, t in ODD], "doc_id long, text string, score double, toxic int")
    rows = [(i, k % 2 if k else None) for k, i in enumerate([1, None, 2, 3, 4, 5, 5, 77])]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    out = toxicity.score_documents(docs, labels).collect()
    assert len(out) == len(ODD) and all(0 <= r.score <= 1 and r.held_out == is_held(r.doc_id) for r in out)
    # Nothing to learn from: every row is scored low.
    assert {r.predicted for r in toxicity.score_documents(docs, labels.limit(0)).collect()} == {0}
    assert toxicity.score_documents(docs.limit(0), labels).count() == 0
    kept = toxicity.drop_toxic(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == len(ODD)


def test_labels_of_held_out_rows_are_not_learned(spark):
    ids = range(400)
    docs = spark.createDataFrame([(i, "bad word here" if is_held(i) else "good word here") for i in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(is_held(i))) for i in ids], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.score_documents(docs, labels).collect()} == {0}


def test_skip_grams_tell_what_single_words_do_not(spark):
    rng, ids = random.Random(3), [i for i in range(3000) if not is_held(i)][:1500]
    pairs = [("a", "b"), ("c", "d"), ("a", "d"), ("c", "b")]
    rows = []
    for i in ids:
        k = rng.randrange(4)
        first, second = pairs[k]
        rows.append((i, f"z{rng.randrange(9)} {first} m{rng.randrange(50)} {second} y{rng.randrange(9)}", int(k < 2)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    out = toxicity.score_documents(docs.select("doc_id", "text"), docs.select("doc_id", "toxic")).join(docs, "doc_id")
    assert out.where("predicted = toxic").count() >= 0.99 * len(rows)


# --- language --------------------------------------------------------------------------------------


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(is_held(r.doc_id) and 0 <= r.score <= 1 for r in out)
    right = [r.lang == r.lang_pred for r in out]
    assert sum(right) >= 0.98 * len(right)
    accepted = [r.lang == r.lang_pred for r in out if not r.rejected]
    assert sum(accepted) >= 0.985 * len(accepted)


def test_language_of_odd_rows(spark):
    train = [(i, "der die das und nicht" if i % 2 else "the and that with this", "de" if i % 2 else "en") for i in range(100, 300)]
    rows = [(i, t, None) for i, t in ODD] + train
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    out = {r.doc_id: r for r in language_id.identify(docs).collect()}
    assert all(out[i].lang_pred == "und" and out[i].score == 0 and out[i].rejected for i in (1, 2, 3))
    assert {out[i].lang_pred for i in (None, 4, 5)} <= {"de", "en"}
    assert all(out[i].lang_pred == lang for i, _, lang in train)
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}
    assert language_id.identify(docs.limit(0)).count() == 0


def test_subwords_stay_inside_words():
    assert sorted(language_id.subwords("ab cd")) == sorted([*language_id.subwords("ab"), *language_id.subwords("cd")])
    assert not len(language_id.subwords("12 - 3")) and not len(language_id.subwords(None))


# --- pages -----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def labeller():
    return html_extraction.Labeller(html_extraction.train())


def test_labels_of_held_out_pages(labeller):
    wrong = total = 0
    for page, labels in labelled_pages(100, seed=77):
        wrong += sum(a != b for a, b in zip(labeller.labels(page), labels))
        total += len(labels)
    assert wrong <= 0.005 * total


def test_viterbi_finds_the_best_labelling(labeller):
    page = labelled_pages(1, seed=5)[0][0][:9]

    def score(labels):
        total = sum(labeller._score(block)[label] for block, label in zip(page, labels))
        return total + sum(labeller.step[a][b] for a, b in zip(labels, labels[1:]))

    best = max(([(k >> i) & 1 for i in range(len(page))] for k in range(1 << len(page))), key=score)
    assert labeller.labels(page) == best


def test_main_text(spark):
    html = (
        '<html><head><title>t</title><style>p{}</style></head><body><nav><ul><li><a href="/a">Home</a></li></ul></nav>'
        '<div class="ad">Buy now, please do.</div><article><h1>A &amp; B</h1><p>First&nbsp;line <b>bo</b>ld\n text.</p>'
        '<script>var x = "<p>no</p>";</script><p>Second &#233; one, with more words in it.<div class="comment"><p>I say so.</p></div>'
        "</article><form><label>Mail</label></form><footer>&copy; me</footer>"
    )
    rows = [(1, "u", html), (2, None, None), (3, "u", ""), (4, "u", "<nav>x</nav>"), (None, "u", "<p"), (1, "u", html)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    out = html_extraction.main_text(pages).collect()
    texts = sorted((str(r.page_id), r.text) for r in out)
    article = "A & B First line bold text. Second é one, with more words in it."
    assert texts[:2] == [("1", article)] * 2 and all(r.n_chars == len(r.text) for r in out)
    assert [t for i, t in texts if i in ("2", "3", "4")] == ["", "", ""] and len(out) == len(rows)
    assert html_extraction.main_text(pages.limit(0)).count() == 0


def test_broken_markup_never_fails():
    rng, pieces = random.Random(1), ["<p>", "</p>", "<b", "<a href='x", '"', ">", "text ", "<!--", "-->", "<script>", "&#x;", "&amp", "</div>", "<", "\x00"]
    for _ in range(300):
        blocks("".join(rng.choice(pieces) for _ in range(rng.randrange(40))))
    assert [b.text for b in blocks("<p>one<p>two<div>three</b></div>four")] == ["one", "two", "three", "four"]
    assert len(blocks("<div>" * 5000 + "x" + "<p>y" * 5000)) == 5001
