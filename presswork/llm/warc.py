"""Deterministic sharded WARC archives.

Records are sorted by range into shards whose bounds depend on the rows only. The writer of a
shard rolls files by compressed size, makes all headers and digests anew, and moves each
finished file from a temporary name to its own. The manifest, one row per file, is written by
Spark's committer last: what it does not list is not part of the archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from pathlib import Path
from urllib.parse import quote, unquote

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm.common import bounded_batches, small
from presswork.operators.skew import global_rank
from presswork.session import materialise, new_path

SHARD_ROWS = 1024
MAX_SHARDS = 10_000
ROLL_BYTES = 64 * 1024 * 1024
DATE = "2024-01-01T00:00:00Z"
# --- fixed values: WARC 1.1 ------------------------------------------------------------------
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:page:"
RAW_URL = "X-Page-URL"
_MANIFEST = "file string, shard int, part int, records long, bytes long, sha256 string"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path inside it; executors use the stores Arrow knows."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path if "://" in path else Path(path).absolute().as_uri())


def _sha1(html: Column) -> Column:
    return F.sha1(F.coalesce(html, F.lit("")).cast("binary"))


def roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Per payload that several rows share: ``sha1, chosen``, the largest id."""
    shared = pages.where(F.octet_length("payload") >= min_bytes).groupBy("sha1")
    found = shared.agg(F.max("page_id").alias("chosen"), F.count(F.lit(1)).alias("n"))
    return found.where("n > 1 AND chosen IS NOT NULL").select("sha1", "chosen")


def _key(page_id: int | None, sha1: str) -> tuple:
    return (page_id is not None, page_id or 0, sha1)


def shard_bounds(keys: DataFrame, shard_rows: int, max_shards: int) -> list[tuple]:
    """First key of each shard: every so many rows in order of id and payload.

    Exact ranks, not a sample, so that the same rows always give the same bounds; at most
    ``max_shards`` of them come to the driver.
    """
    ranked = global_rank(keys, ["page_id", "sha1"])
    step = max(shard_rows, -(-keys.count() // max_shards))
    first = ranked.where((F.col("rank") - 1) % step == 0).select("page_id", "sha1").distinct().collect()
    return sorted(_key(row.page_id, row.sha1) for row in first)


def _header(fields: list[tuple[str, object]]) -> bytes:
    return "\r\n".join([VERSION, *(f"{name}: {value}" for name, value in fields if value is not None), "", ""]).encode()


def _uri(url: str | None) -> str | None:
    """The url with what no URI may hold escaped; escapes that are there already stay."""
    if url is None:
        return None
    return quote(re.sub("%(?![0-9A-Fa-f]{2})", "%25", url), safe="".join(map(chr, range(33, 39))) + "'()*+,-./:;=?@[]_~!|^`{}\\<>\"")


def _record_id(page_id: int | None, digest: str, number: int) -> str:
    """Unique by page, payload and place among the rows equal in both."""
    return f"<{ID_PREFIX}{'' if page_id is None else page_id}:{digest}:{number}>"


def _page_of(record_id: str) -> str | None:
    return record_id.strip("<>").removeprefix(ID_PREFIX).split(":")[0] or None


def response_block(payload_bytes: int, payload: bytes) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n"
    return head.encode() + payload


def record(
    page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None, date: str, number: int = 0
) -> bytes:
    """One record as a gzip member; a revisit keeps the HTTP header and leaves out the payload.

    ``number`` counts rows equal in id and payload. A url that its URI does not give back is kept
    in a field of its own.
    """
    uri = _uri(url)
    block = response_block(size, payload)
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id, digest, number)),
        ("WARC-Target-URI", uri),
        (RAW_URL, None if url == uri else quote(url, safe="")),
        ("WARC-Date", date),
        ("WARC-Refers-To", None if refers_to is None else _record_id(refers_to, digest, 0)),
        ("WARC-Profile", None if refers_to is None else PROFILE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    return _member(_header(fields) + block + b"\r\n\r\n")


def _member(data: bytes) -> bytes:
    """Gzip without a time, so that equal records give equal bytes."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Shard:
    """Files of one shard, each begun under a temporary name."""

    def __init__(self, folder: str, shard: int, roll_bytes: int, date: str):
        self.store, self.folder = _store(folder)
        self.shard, self.roll_bytes, self.date = shard, roll_bytes, date
        self.part, self.out, self.done = 0, None, []

    def add(self, member: bytes) -> None:
        if self.out is not None and self.size + len(member) > self.roll_bytes:
            self.close()
        if self.out is None:
            self.name = f"shard-{self.shard:05d}-{self.part:05d}.warc.gz"
            self.temporary = f"{self.folder}/.{self.name}.{uuid.uuid4().hex}"
            self.out = self.store.open_output_stream(self.temporary, compression=None)
            self.size, self.records, self.hash = 0, 0, hashlib.sha256()
            text = f"software: presswork\r\nformat: {VERSION}\r\n".encode()
            fields = [
                ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:file:{self.name}>"), ("WARC-Date", self.date),
                ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields"), ("Content-Length", len(text)),
            ]
            self._write(_member(_header(fields) + text + b"\r\n\r\n"))
        self._write(member)
        self.records += 1

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.hash.update(data)
        self.size += len(data)

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        self.store.move(self.temporary, f"{self.folder}/{self.name}")
        self.done.append((self.name, self.shard, self.part, self.records, self.size, self.hash.hexdigest()))
        self.part, self.out = self.part + 1, None


def write_archive(
    pages: DataFrame,
    path: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_bytes: int = 0,
    shard_rows: int = SHARD_ROWS,
    roll_bytes: int = ROLL_BYTES,
    date: str = DATE,
) -> str:
    """Write the archive to ``path`` (a new folder in the working folder if not given); returns it.

    A null html is an empty payload; a null url gives a record without target. Of rows with equal
    payloads of at least ``min_bytes``, those with the largest id are responses and the others
    revisits; rows without an id are revisits too unless no row of the payload has one. Rows
    equal in id and payload share a shard, which is streamed, never held. An empty table gives
    an archive without files.
    """
    spark = pages.sparkSession
    bounded_batches(spark, 256)
    path = new_path(spark, "warc") if path is None else path
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("payload"),
    ).withColumn("sha1", _sha1(F.col("payload")))
    bounds = shard_bounds(rows.select("page_id", "sha1"), shard_rows, MAX_SHARDS)
    shared = materialise(roles(rows, min_bytes), "roles")

    @F.pandas_udf("int")
    def shard_of(page_id: pd.Series, sha1: pd.Series) -> pd.Series:
        ids = [None if pd.isna(i) else int(i) for i in page_id]
        return pd.Series([max(0, bisect_right(bounds, _key(i, s)) - 1) for i, s in zip(ids, sha1)], dtype="int32")

    revisit = F.col("chosen").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("chosen"))
    typed = rows.join(small(shared), "sha1", "left").select(
        shard_of("page_id", "sha1").alias("shard"),
        F.col("page_id").cast("string").alias("id_text"),
        "page_id", "url", "sha1",
        F.octet_length("payload").cast("long").alias("size"),
        F.when(revisit, F.col("chosen")).cast("string").alias("refers_to"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )
    ordered = typed.repartition("shard").sortWithinPartitions("shard", "page_id", "sha1", "url").drop("page_id")
    store, folder = _store(path)
    store.create_dir(folder, recursive=True)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, same, number = None, None, 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                number = number + 1 if same == (row.id_text, row.sha1) else 0
                same = (row.id_text, row.sha1)
                if current is None or current.shard != row.shard:
                    if current is not None:
                        current.close()
                        yield pd.DataFrame(current.done, columns=names)
                    current = _Shard(path, int(row.shard), roll_bytes, date)
                digest = base64.b32encode(bytes.fromhex(row.sha1)).decode()
                page_id = None if row.id_text is None else int(row.id_text)
                refers_to = None if row.refers_to is None else int(row.refers_to)
                payload = b"" if row.payload is None else row.payload.encode()
                current.add(record(page_id, row.url, payload, int(row.size), digest, refers_to, date, number))
        if current is not None:
            current.close()
            yield pd.DataFrame(current.done, columns=names)

    names = ["file", "shard", "part", "records", "bytes", "sha256"]
    ordered.mapInPandas(write, _MANIFEST).write.parquet(f"{path}/_manifest")
    return path


def _members(stream, check: "hashlib._Hash") -> Iterator[bytes]:
    """Unpacked gzip members of a file, one at a time."""
    unpacker, parts, rest = zlib.decompressobj(31), [], b""
    while chunk := rest or stream.read(1 << 20):
        if not rest:
            check.update(chunk)
        parts.append(unpacker.decompress(chunk))
        rest = unpacker.unused_data
        if unpacker.eof:
            yield b"".join(parts)
            unpacker, parts = zlib.decompressobj(31), []
    if parts and any(parts):
        raise ValueError("archive file ends inside a record")


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if line)


def parse_record(data: bytes) -> tuple | None:
    """(page_id, url, type, refers_to, payload bytes, digest, payload or None); None for a warcinfo.

    Raises if a length or digest does not fit.
    """
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["Content-Length"])]
    if fields["WARC-Type"] == "warcinfo":
        return None
    if rest[len(block) :] != b"\r\n\r\n" or f"sha1:{base32_sha1(block)}" != fields["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    size, digest = int(_fields(http)["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
    response = fields["WARC-Type"] == "response"
    if response and (size != len(payload) or digest != base32_sha1(payload)):
        raise ValueError(f"damaged payload {fields['WARC-Record-ID']}")
    ids = [_page_of(fields.get(name, "")) for name in ("WARC-Record-ID", "WARC-Refers-To")]
    url = unquote(fields[RAW_URL]) if RAW_URL in fields else fields.get("WARC-Target-URI")
    return (
        ids[0], url, fields["WARC-Type"], ids[1], size, digest,
        payload if response else None,
    )


def read_archive(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of the files that the manifest lists, one row each.

    Columns ``page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload``;
    a revisit has no payload of its own. Files are streamed record by record; lengths, digests
    and the file hashes of the manifest are checked, and damage fails the job. Without
    ``payloads`` the column is null.
    """
    bounded_batches(spark, 256)
    manifest = spark.read.schema(_MANIFEST).parquet(f"{path}/_manifest")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, folder = _store(path)
        for batch in batches:
            for row in batch.itertuples(index=False):
                check, found, held, records = hashlib.sha256(), [], 0, 0
                with store.open_input_stream(f"{folder}/{row.file}", compression=None) as stream:
                    for data in _members(stream, check):
                        parsed = parse_record(data)
                        if parsed is None:
                            continue
                        records += 1
                        found.append(parsed if payloads else (*parsed[:6], None))
                        held += len(data) if payloads else 200
                        if held > 4_000_000:
                            yield pd.DataFrame(found, columns=names)
                            found, held = [], 0
                if check.hexdigest() != row.sha256 or records != row.records:
                    raise ValueError(f"{row.file} is not the file of the manifest")
                yield pd.DataFrame(found, columns=names)

    names = ["id_text", "url", "record_type", "refers_text", "payload_bytes", "payload_digest", "payload"]
    schema = (
        "id_text string, url string, record_type string, refers_text string, payload_bytes long, "
        "payload_digest string, payload binary"
    )
    # A task per file: the manifest is small, what it lists is not.
    rows = manifest.repartition(max(1, manifest.count())).mapInPandas(read, schema)
    return rows.select(
        F.col("id_text").cast("long").alias("page_id"), "url", "record_type",
        F.col("refers_text").cast("long").alias("refers_to"), "payload_bytes", "payload_digest", "payload",
    )
