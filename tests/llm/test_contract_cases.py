"""Clashing names, shared ids, texts without letters, targets of archive records, pieces of a mix."""

import gzip
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from presswork.llm import decontamination, language_id, minhash_dedup, mixing, warc

SF_DIR = "/root/testdata/sf0.001"
CLASHES = ["_lost", "_copies", "_copy", "_doc", "_id", "_hash", "key", "a.b", "bucket", "run", "rank", "sidx", "hash"]


def test_stages_keep_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name in CLASHES:
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        assert out.columns[: len(docs.columns)] == docs.columns, name
        wrong = [F.col(f"`{c}`") != F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in CLASHES]
        assert out.count() > 0 and out.where(F.greatest(*[w.cast("int") for w in wrong]) == 1).isEmpty(), name


def test_rows_that_share_an_id_go_by_their_own_text(spark):
    words = " ".join(f"w{k}" for k in range(40))
    rows = [(1, words), (5, words + " more"), (5, "a text of its own that is no copy of any other"), (5, words), (None, words), (None, None), (7, None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, rank string")
    kept = minhash_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(str((r.doc_id, r.text and r.text[:6])) for r in kept.collect()) == sorted(
        map(str, [(1, "w0 w1 "), (5, "a text"), (None, "w0 w1 "), (None, None), (7, None)])
    )


def test_texts_without_a_letter_have_no_language(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame([(-1, "❤️", "en"), (-2, "123 ́", "fr"), (-3, "12", "de"), (-4, "", "de"), (-5, "the é", "en")], "doc_id long, text string, lang string")
    out = language_id.identify(docs.select("doc_id", "text", "lang").unionByName(odd)).where("doc_id < 0").collect()
    assert {r.doc_id: r.lang_pred == "und" for r in out} == {-1: True, -2: True, -3: True, -4: True, -5: False}


@pytest.mark.parametrize(
    "url, uri",
    [("http://x.org/a%20b", "http://x.org/a%20b"), ("http://x.org/a b", "http://x.org/a%20b"), ("http://x.org/5%", "http://x.org/5%25"), ("http://x.org/é", "http://x.org/%C3%A9")],
)
def test_target_uris_are_not_escaped_twice(url, uri):
    data = gzip.decompress(warc.record(3, url, b"x", 1, warc.base32_sha1(b"x"), None, warc.DATE))
    assert f"WARC-Target-URI: {uri}\r\n".encode() in data and warc.parse_record(data)[1] == url


def test_record_ids_are_unique_and_revisits_name_one(spark, tmp_path):
    rows = [(1, "u", "p"), (1, "u", "q"), (1, "v", "p"), (2, "u", "p"), (2, "w", "p"), (None, "u", "p"), (None, "u", "p")]
    path = warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "a"), shard_rows=2)
    text = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(Path(path).glob("*.warc.gz"))).decode()
    ids = [line.split(": ")[1] for line in text.split("\r\n") if line.startswith("WARC-Record-ID: <urn:page")]
    refers = [line.split(": ")[1] for line in text.split("\r\n") if line.startswith("WARC-Refers-To")]
    assert len(ids) == len(set(ids)) == len(rows) and set(refers) <= set(ids) and len(refers) == 4
    assert warc.read_archive(spark, path).count() == len(rows)


def test_every_slot_of_a_mix_has_its_block(spark):
    rows = [(k, " ".join(f"s{k % 5}d{k}w{j}" for j in range(5 + 7 * k % 60)), f"s{min(k % 12, 4)}") for k in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(docs, block_words=8)
    slots = Counter((r.sidx, r.slot, r.block) for r in mixed.slots.collect())
    blocks = mixed.blocks.collect()
    assert Counter((r.sidx, r.slot, r.block) for r in blocks) == slots and set(slots.values()) == {1}
    taken = {r.doc_id: r.taken for r in mixed.documents.collect()}
    words = Counter(int(w.split("d")[1].split("w")[0]) for r in blocks for w in r.text.split(" "))
    assert {k: n for k, n in taken.items() if n} == dict(words)
    assert sum(taken.values()) == sum(r.n_words for r in blocks)


def test_contaminated_copies_go_together(spark):
    item = " ".join(f"b{k}" for k in range(20))
    docs = spark.createDataFrame([(1, item, "p"), (1, item, "q"), (2, "clean words only", "r"), (3, None, "s"), (4, "", "t")], "doc_id long, text string, _lost string")
    kept = decontamination.drop_contaminated(docs, spark.createDataFrame([(9, item)], "item_id long, text string"))
    assert kept.columns == docs.columns and sorted(r["_lost"] for r in kept.collect()) == ["r", "s", "t"]
