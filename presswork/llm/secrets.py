"""Secret scans, in DataFrame operations only.

Fixed patterns find secrets of known shape. Beside them, two character Markov models, one of
random strings and one of ordinary identifiers, judge every long token by the ratio of their
likelihoods; tokens far more likely to be random are added.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions.once import computed_once, let

# --- fixed values: patterns of known secrets and the least length of what they match -----------
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
MIN_ASSIGN, MIN_ACCESS = 12, 18
BASE_KINDS = ["assign", "access", "hex"]

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
MARKOV = "markov"
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
_SAMPLE_TOKEN = r"[A-Za-z0-9+/_=-]{4,}"
#: Bound of the training sample: about so many rows.
SAMPLE_ROWS = 4_000
#: Log of the odds a token needs, for about one secret in a hundred thousand tokens.
LOG_ODDS = 12.0
_DRAWS = 1 << 30


def _spans(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Array of ``start, kind, end, token`` in code points, of matches whose group is long enough.

    The text splits at the matches; the lengths of pieces and matches add up to the places.
    """
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,token:string>>")

    def place(matches: Column) -> Column:
        pieces = F.split(text, pattern, -1)
        groups = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
        state = F.struct(F.lit(0).alias("at"), empty.alias("out"))

        def step(done: Column, i: Column) -> Column:
            start = done["at"] + F.char_length(F.get(pieces_, i))
            end = start + F.char_length(F.get(matches_, i))
            span = F.struct(
                start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), F.get(groups_, i).alias("token")
            )
            return F.struct(end.alias("at"), F.concat(done["out"], F.array(span)).alias("out"))

        def walk(parts: Column) -> Column:
            nonlocal pieces_, matches_, groups_
            pieces_, matches_, groups_ = parts["pieces"], parts["matches"], parts["groups"]
            places = F.sequence(F.lit(0), F.size(matches_) - 1)
            return F.aggregate(places, state, step, lambda done: done["out"])

        pieces_ = matches_ = groups_ = None
        parts = F.struct(pieces.alias("pieces"), matches.alias("matches"), groups.alias("groups"))
        found = let(parts, walk)
        return F.when(F.size(matches) > 0, found).otherwise(empty)

    spans = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), place)
    return F.filter(spans, lambda s: F.char_length(s["token"]) >= least) if least else spans


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns, by start and then kind."""
    assign = _spans(text, ASSIGN, 0, group=2, least=MIN_ASSIGN)
    access = _spans(text, ACCESS, 1, least=MIN_ACCESS)
    return F.array_sort(F.concat(assign, access, _spans(text, HEX, 2)))


def _listed(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in [*BASE_KINDS, MARKOV]])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ","
    )


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 13) -> list[float]:
    """Log-likelihood ratio of every pair of neighbouring characters, random against ordinary.

    Learned from labelled samples of about ``sample_rows`` rows, picked by a hash of the text.
    Ordinary: the tokens of these rows that hold no digit and touch no fixed pattern. Random:
    what the fixed patterns match there, and a digest in base64 of every ordinary token. Counts
    of pairs, at most two tables of the alphabet squared, come to the driver.
    """
    rows = docs.where("text IS NOT NULL")
    total = max(1, rows.count())
    picked = F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(_DRAWS)) < F.lit(int(min(1.0, sample_rows / total) * _DRAWS))
    sample = rows.where(picked).select("text", base_spans(F.col("text")).alias("spans"))
    bare = F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), f"{ACCESS}|{HEX}", " ")
    tokens = sample.select(F.explode(F.regexp_extract_all(bare, F.lit(_SAMPLE_TOKEN), F.lit(0))).alias("token"))
    tokens = tokens.where(~F.col("token").rlike("[0-9]"))
    found = sample.select(F.explode("spans.token").alias("token"))
    digests = tokens.select(F.base64(F.unhex(F.sha2("token", 256))).alias("token"))
    labelled = (
        tokens.withColumn("random", F.lit(False))
        .unionByName(found.withColumn("random", F.lit(True)))
        .unionByName(digests.withColumn("random", F.lit(True)))
    )
    places = F.sequence(F.lit(1), F.char_length("token") - 1)
    pairs = labelled.where(F.char_length("token") > 1).select(
        "random", F.explode(F.transform(places, lambda i: F.substring("token", i, F.lit(2)))).alias("pair")
    )
    counts = {(r.random, r.pair): r["count"] for r in pairs.groupBy("random", "pair").count().collect()}
    return _ratios(counts)


def _ratios(counts: dict[tuple[bool, str], int]) -> list[float]:
    """Row by first character; half a count is added to every pair."""
    out = []
    for a in ALPHABET:
        chance = {}
        for random in (True, False):
            row = [counts.get((random, a + b), 0) + 0.5 for b in ALPHABET]
            chance[random] = [n / sum(row) for n in row]
        out += [math.log(r / o) for r, o in zip(chance[True], chance[False])]
    return out


def log_odds(token: Column, ratios: Column) -> Column:
    """Sum of the ratios of a token's pairs of characters."""
    n = len(ALPHABET)

    def pair(i: Column) -> Column:
        a = F.instr(F.lit(ALPHABET), F.substring(token, i, F.lit(1))) - 1
        b = F.instr(F.lit(ALPHABET), F.substring(token, i + 1, F.lit(1))) - 1
        return F.get(ratios, a * n + b)

    places = F.sequence(F.lit(1), F.char_length(token) - 1)
    return F.aggregate(places, F.lit(0.0), lambda total, i: total + F.coalesce(pair(i), F.lit(0.0)))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_odds: float = LOG_ODDS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``doc_id`` and the array ``found`` of (start, kind, end, token) for every row.

    Kinds 0 to 2 are the fixed patterns, kind 3 tokens judged random that overlap none of them.
    Places are code points, ends exclusive. Null and empty texts have no spans.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ratios = F.from_json(F.lit(json.dumps(train(rows, sample_rows))), "array<double>")
    text = F.coalesce("text", F.lit(""))
    tokens = rows.select("doc_id", computed_once(base_spans(text).alias("base"), _spans(text, TOKEN, 3).alias("tokens")))
    apart = F.filter(
        "tokens",
        lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (b["end"] > t["start"]))
        & (log_odds(t["token"], ratios) >= least_odds),
    )
    return tokens.select("doc_id", F.array_sort(F.concat("base", apart)).alias("found"))


def secrets(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov`` for every row."""
    found = scan(docs, **options).select("doc_id", computed_once(F.col("found").alias("found")))
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("found", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"),
        count(3).alias("n_markov"),
    )
