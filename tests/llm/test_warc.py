import base64
import gzip
import hashlib
from pathlib import Path

import pytest

from presswork.llm import warc
from presswork.sources import tables

ROWS = [
    (1, "https://a.example/1?q=%20x", "<p>é</p>"), (2, "https://a.example/2", "<p>é</p>"), (3, None, None), (4, "u\r\nX: y", ""),
    (5, "https://a.example/5", "x" * 40_000), (None, "https://a.example/n", "<p>é</p>"), (7, "u", "only\r\n\r\nonce"), (7, "u", "only\r\n\r\nonce"),
    (None, "v", "no id"), (9, "é", "y\n" * 5_000),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "clash") for r in ROWS], "page_id long, url string, html string, sha1 string")


def files(path):
    return {p.name: p.read_bytes() for p in Path(path).iterdir() if p.name.endswith(".warc.gz") and not p.name.startswith(".")}


def test_archive_round_trip(spark, pages, tmp_path):
    path = warc.write_archive(pages, str(tmp_path / "a"), shard_rows=2, roll_bytes=500)
    out = warc.read_archive(spark, path).collect()
    largest = {}
    for page_id, _, html in ROWS:
        largest[html or ""] = max(largest.get(html or "", -1), -1 if page_id is None else page_id)
    expected = []
    for page_id, url, html in ROWS:
        chosen = largest[html or ""]
        revisit = chosen >= 0 and page_id != chosen
        size = len((html or "").encode())
        payload = None if revisit else (html or "").encode()
        expected.append((page_id, url, "revisit" if revisit else "response", chosen if revisit else None, size, digest(html), payload))
    got = [(r.page_id, r.url, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, r.payload and bytes(r.payload)) for r in out]
    assert sorted(map(str, [(*g[:6], g[6] or b"") for g in got])) == sorted(map(str, [(*e[:6], e[6] or b"") for e in expected]))


def test_same_rows_give_the_same_files(spark, pages, tmp_path):
    written = [
        files(warc.write_archive(frame, str(tmp_path / name), shard_rows=3, roll_bytes=600))
        for name, frame in (("a", pages), ("b", pages.repartition(5)))
    ]
    assert written[0] == written[1] and len(written[0]) > 3
    for data in written[0].values():
        assert len(data) <= 600 or data.count(b"\x1f\x8b\x08") <= 2
        text = gzip.decompress(data)
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and text.endswith(b"\r\n\r\n")


def test_only_the_manifest_counts_and_damage_is_found(spark, pages, tmp_path):
    path = warc.write_archive(pages, str(tmp_path / "a"))
    before = warc.read_archive(spark, path, payloads=False).count()
    (tmp_path / "a" / ".shard-00009-00000.warc.gz.tmp").write_bytes(b"left behind")
    assert warc.read_archive(spark, path, payloads=False).count() == before == len(ROWS)
    name, data = sorted(files(path).items())[0]
    (tmp_path / "a" / name).write_bytes(data[:-200])
    with pytest.raises(Exception, match="record|manifest|incomplete"):
        warc.read_archive(spark, path).collect()


def test_small_payloads_may_be_kept_apart(spark, pages, tmp_path):
    path = warc.write_archive(pages, str(tmp_path / "a"), min_bytes=1)
    empty = warc.read_archive(spark, path).where("payload_bytes = 0").collect()
    assert {r.record_type for r in empty} == {"response"} and len(empty) == 2


def test_empty_table(spark, pages, tmp_path):
    path = warc.write_archive(pages.limit(0), str(tmp_path / "a"))
    assert warc.read_archive(spark, path).count() == 0 and not files(path)
    assert tables.read_table(spark, f"{path}/_manifest").count() == 0
