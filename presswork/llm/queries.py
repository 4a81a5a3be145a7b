"""The operators over their whole tables, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from presswork.llm import (
    decontamination,
    embedding_dedup,
    fingerprints,
    html_extraction,
    language_id,
    minhash_dedup,
    mixing,
    secrets,
    sharding,
    spelling,
    toxicity,
    warc,
    whitening,
)
from presswork.session import materialise

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=13, percent=5
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_archive(table(spark, sf_dir, "pages"), min_bytes=0)
    return warc.read_archive(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the mix; returns what it took of each document."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.0, cap=3)
    materialise(mixed.blocks, "mix")
    return mixed.documents.select("doc_id", "size", "source_size", "target", "taken", "source")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.main_text(table(spark, sf_dir, "pages"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), shards=24)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"), components=32)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), min_length=5, min_count=3, ratio=2)


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    fn.__name__: fn
    for fn in (
        op1_embedding_dedup, op2_minhash_dedup, op3_decontamination, op4_warc, op5_mixing, op6_toxicity,
        op7_html_extraction, op8_language_id, op9_sharding, op10_secrets, op11_embedding_whitening, op12_spelling_variants,
        op13_document_fingerprints,
    )
}

# Components: the smallest id over all nodes reached, by a recursion that drops repeats.
_REACH = """reach(a, b) AS (SELECT {id}, {id} FROM {nodes}
    UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
component AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)"""

_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op1_embedding_dedup": f"""WITH RECURSIVE
vectors AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
usable AS (SELECT * FROM vectors WHERE v IS NOT NULL AND len(v) > 0
    AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (SELECT p.vec_id AS a, q.vec_id AS b FROM usable p JOIN usable q ON p.vec_id <> q.vec_id
    AND len(p.v) = len(q.v) WHERE list_cosine_similarity(p.v, q.v) >= 0.95),
{_REACH.format(id="vec_id", nodes="vectors")}
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id,
    vec_id = component_id AS kept FROM vectors JOIN component ON a = vec_id""",
    "op3_decontamination": f"""WITH
d AS (SELECT doc_id, regexp_extract_all({_ASCII_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM documents),
i AS (SELECT item_id, regexp_extract_all({_ASCII_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM benchmark),
windows AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, array_to_string(w[s:s + 12], ' ') AS k, least(len(w), 13) AS n
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
places AS (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS k FROM
    (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM windows) x)),
found AS (SELECT doc_id, s, p.n, item_id FROM places p JOIN windows USING (k, n)),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM
    (SELECT doc_id, unnest(range(s, s + n)) AS pos FROM (SELECT DISTINCT doc_id, s, n FROM found)) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
    FROM found GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 100 * coalesce(n_hit, 0) >= 5 * len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op4_warc": """WITH
p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT h, max(page_id) AS chosen, substring(CAST(CAST(unhex(h) AS BIT) AS VARCHAR), 1, 160) AS bits FROM p GROUP BY h)
SELECT page_id, payload_bytes,
    array_to_string(list_transform(range(32), lambda k: substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + list_sum(list_transform(range(5), lambda j: CAST(substring(bits, CAST(5 * k + j + 1 AS INT), 1) AS INT)
            * CAST(pow(2, 4 - j) AS INT)))::INT, 1)), '') AS payload_digest,
    CASE WHEN page_id = chosen THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> chosen THEN chosen END AS refers_to
FROM p JOIN g USING (h)""",
    "op2_minhash_dedup": f"""WITH RECURSIVE
d AS (SELECT doc_id, regexp_extract_all({_ASCII_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[k] || ' ' || w[k + 1] END AS sh
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1) + 1)) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_sides AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM s p JOIN s q ON p.sh = q.sh AND p.doc_id <> q.doc_id
    GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM both_sides JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
    WHERE 100 * c >= 80 * (x.n + y.n - c)),
{_REACH.format(id="doc_id", nodes="d")}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN component ON a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
    # crc32 by its table of 256 remainders; near words share a text with one code point taken out:
    # at one place of both, or the shorter word is that text of the longer.
    "op12_spelling_variants": f"""WITH RECURSIVE
remainders AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS r),
runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc_id,
    unnest(regexp_extract_all({_ASCII_LOWER.format("coalesce(text, '')")}, '[a-z\u00C0-\u00FF]+')) AS run FROM documents)
    WHERE len(run) >= 5 GROUP BY ALL),
sums AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(strlen(doc_id || ':' || run)),
    lambda k: CAST('0x' || substring(hex(encode(doc_id || ':' || run)), 2 * k::INT + 1, 2) AS BIGINT))),
    lambda c, b: xor(c // 256, r[xor(c, b) % 256 + 1]))) AS h FROM runs, remainders),
typed AS (SELECT CASE WHEN h % 97 = 0 THEN substring(run, 1, (h % len(run))::INT) || substring(run, (h % len(run))::INT + 2)
    ELSE run END AS word, n FROM sums),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM typed WHERE len(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
less AS MATERIALIZED (SELECT word, n, k, substring(word, 1, k::INT - 1) || substring(word, k::INT + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS k FROM words)),
near AS MATERIALIZED (SELECT p.word, q.word AS other, q.n AS m FROM less p JOIN less q ON p.rest = q.rest AND p.k = q.k AND p.word <> q.word
    UNION SELECT p.word, q.word, q.n FROM less p JOIN words q ON p.rest = q.word
    UNION SELECT q.word, p.word, p.n FROM less p JOIN words q ON p.rest = q.word),
best AS (SELECT word, count(*) AS n_near, max(m) AS m, arg_min(other, (-m, encode(other))) AS other FROM near GROUP BY word),
forms AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * w.n THEN other END AS form,
    CASE WHEN m >= 2 * w.n THEN m END AS form_n FROM words w LEFT JOIN best USING (word)),
steps(word, reached) AS (SELECT word, word FROM forms
    UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON f.word = s.reached WHERE f.form IS NOT NULL)
SELECT f.word, f.form, s.reached AS root, f.n, f.n_near, f.form_n FROM forms f JOIN steps s USING (word)
    JOIN forms e ON e.word = s.reached AND e.form IS NULL""",
}
