"""Find secrets in text.

Three patterns give the base spans. The method adds long runs that look random: two
character Markov models, one of random strings and one of ordinary identifiers, are
compared by the logarithm of their likelihood ratio.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds in the order of reports, their patterns and least lengths.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGNED_LEAST = 6
# Runs of these match as a whole or not at all, so the least length can stand inside.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
RUN = "[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SAMPLE = 20_000  # documents that the models learn from, at most about so many
MEAN_RATIO = 0.5  # nats for each character pair
RATIO = 12.0  # nats for a run


def _found(text: Column, pattern: str, kind: int, least: int = 0) -> Column:
    """Leftmost matches that do not overlap: array of (start, end, kind, match), in code
    points. The text between matches gives the places. Matches whose second group is
    shorter than ``least`` are dropped after the search."""
    whole = F.regexp_extract_all(text, F.lit(f"({pattern})" if least == 0 else pattern), 0)
    inner = F.regexp_extract_all(text, F.lit(pattern), 2) if least else whole
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole))
    parts = F.zip_with(gaps, F.arrays_zip(whole.alias("m"), inner.alias("v")), lambda gap, x: F.struct(
        F.length(gap).alias("gap"), x["m"].alias("m"), x["v"].alias("v")))
    none = F.array().cast("array<struct<start:int,end:int,kind:int,match:string>>")

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + F.length(x["m"])
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"),
                        x["v"].alias("match"))
        kept = F.when(F.length(x["v"]) >= least, F.array(span)).otherwise(none)
        return F.struct(end.alias("at"), F.concat(state["spans"], kept).alias("spans"))

    spans = F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("spans")), add,
                        lambda state: state["spans"])
    return F.when(text.rlike(pattern), spans).otherwise(none)


def base_spans(text: Column) -> Column:
    return F.concat(_found(text, ASSIGN, 0, ASSIGNED_LEAST), _found(text, ACCESS, 1), _found(text, HEX, 2))


def _pair_counts(strings: DataFrame) -> dict[str, int]:
    """How often each two characters follow each other; at most 67 * 67 rows."""
    places = F.sequence(F.lit(1), F.length("string") - 1)
    pairs = strings.filter(F.length("string") > 1).select(
        F.explode(F.transform(places, lambda i: F.substring(F.col("string"), i, F.lit(2)))).alias("pair"))
    known = pairs.filter(F.col("pair").rlike(r"^[A-Za-z0-9+/_=-]{2}$"))
    return {r["pair"]: r["count"] for r in known.groupBy("pair").count().collect()}


def _log_chances(counts: dict[str, int]) -> dict[str, float]:
    """Log chance of the second character after the first."""
    after: dict[str, int] = defaultdict(int)
    for pair, n in counts.items():
        after[pair[0]] += n
    return {
        a + b: math.log((counts.get(a + b, 0) + 0.5) / (after[a] + 0.5 * len(ALPHABET)))
        for a in ALPHABET for b in ALPHABET
    }


def learn(docs: DataFrame, sample: int = SAMPLE) -> list[float]:
    """Log likelihood ratio, random against ordinary, of each pair of characters, by place
    in the alphabet.

    The labelled samples: what the base patterns match, and texts of random bits (hashes
    in base 64 and base 16), are random; words that begin with a letter, as far as the
    base patterns match nothing in their text, are ordinary. About ``sample`` documents,
    picked by a hash of the text, are read. Without ordinary words the model only
    prefers what is random.
    """
    rows = docs.count()
    drawn = docs.select("text").filter("text is not null").filter(
        F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < 1_000_000 * min(1.0, sample / max(rows, 1)))
    marked = drawn.select("text", base_spans(F.col("text")).alias("spans"))
    secret = marked.select(F.explode("spans").alias("s")).select(F.col("s.match").alias("string"))
    digest = F.sha2(F.col("text").cast("binary"), 256)
    random = drawn.select(F.explode(F.array(digest, F.upper(digest), F.base64(F.unhex(digest)))).alias("string"))
    words = marked.filter(F.size("spans") == 0).select(
        F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z][A-Za-z0-9_-]{3,}"), 0)).alias("string"))
    chances = _log_chances(_pair_counts(secret.unionByName(random)))
    usual = _log_chances(_pair_counts(words))
    return [chances[a + b] - usual[a + b] for a in ALPHABET for b in ALPHABET]


def _ratio(string: Column, table: list[float]) -> Column:
    """Summed log likelihood ratio of the string's character pairs."""
    values = F.array(*(F.lit(x) for x in table))
    places = F.sequence(F.lit(1), F.length(string) - 1)

    def place(i: Column) -> Column:
        return F.instr(F.lit(ALPHABET), F.substring(string, i, F.lit(1)))

    size = len(ALPHABET)
    return F.aggregate(places, F.lit(0.0), lambda total, i: total + F.element_at(
        values, (place(i) - 1) * size + place(i + 1)))


def spans(docs: DataFrame, table: list[float]) -> DataFrame:
    """doc_id and found: all spans of each row of ``docs`` as (start, end, kind, match),
    by start and then by kind as listed; ``match`` is the secret's text.

    Null text counts as empty and has none; repeated rows are rows of their own, and null
    ids stay null. Runs that the base spans cover are not given again.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = docs.select("doc_id", base_spans(text).alias("base"), _found(text, RUN, 3).alias("runs"))
    likely = F.filter("runs", lambda r: (
        (_ratio(r["match"], table) >= F.greatest(F.lit(RATIO), MEAN_RATIO * F.length(r["match"])))
        & ~F.exists("base", lambda b: (b["start"] <= r["start"]) & (r["end"] <= b["end"]))))
    ordered = F.array_sort(F.transform(F.concat("base", likely), lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["match"].alias("match"))))
    return marked.select("doc_id", ordered.alias("found"))


def report(found: DataFrame) -> DataFrame:
    """Counts by base kind, the hash of the base spans' places, and all places."""
    names = F.array(*(F.lit(k) for k in KINDS))

    def places(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("found", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
        F.sha2(places(base).cast("binary"), 256).alias("base_sha256"), places(F.col("found")).alias("spans"))
