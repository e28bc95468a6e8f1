"""Keep or reject documents by rules that are learned from labels.

Method: learned decision lists. Sequential covering grows conjunctions of thresholds on
a document's statistics, prunes each on labels held back, and puts those that hold up in
order; the list becomes one Spark conditional expression.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.common import by_batch, in_slices

# The base limits.
LEAST_WORDS = 50
SYMBOLS = b"#*$%&|<>"

SAMPLE = 20_000  # labelled documents that the rules are learned from
MOST_RULES = 16
MOST_CONDITIONS = 4
PRECISION = 0.97  # of a rule on the labels held back
CUTS = 32

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper",
              "n_marks", "n_lines")
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_MARKS = b"!\"'(),-./:;?@[]_{}~^`\\+="
#: What rules test: name and expression. Shares are null where there is nothing to share.
FEATURES: dict[str, str] = {
    "words": "cast(n_words as double)",
    "word_length": "word_chars / nullif(n_words, 0)",
    "symbols": "n_symbols / nullif(word_chars, 0)",
    "repeated_lines": "n_dup_lines / nullif(n_lines, 0)",
    "repeated_words": "n_repeat_words / nullif(n_words, 0)",
    "capitals": "n_upper / nullif(word_chars, 0)",
    "marks": "n_marks / nullif(word_chars, 0)",
    "words_a_line": "n_words / nullif(n_lines, 0)",
}
Rule = list[tuple[str, str, float]]


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that occur twice or more, first occurrences included."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1].astype(np.int64)
    windows = pairs[:-1] * len(number) + ids[2:]
    _, where, times = np.unique(windows, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[where] > 1)
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[starts + k] = True
    return int(covered.sum())


def text_statistics(text: bytes | None) -> tuple[int, ...]:
    """The numbers of ``STATISTICS`` for a text in UTF-8; null text gives zeros."""
    text = text or b""
    words = text.split()
    # Bytes that continue a code point are not characters of their own.
    inner = len(text) - len(text.decode("utf-8", "replace"))
    lines = Counter(line for line in text.split(b"\n") if line.strip())
    n_lines = sum(lines.values())
    return (
        len(words), sum(map(len, words)) - inner, len(text) - len(text.translate(None, SYMBOLS)),
        n_lines - len(lines), repeated_words(words), len(text) - len(text.translate(None, _UPPER)),
        len(text) - len(text.translate(None, _MARKS)), n_lines)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the numbers of ``STATISTICS`` for each row of ``docs``, from whole texts."""

    def make():
        def each(batch):
            for part in in_slices(batch, "text", 1 << 24):
                columns = zip(*map(text_statistics, part["text"].to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], *(pa.array(c, pa.int64()) for c in columns)],
                    names=["doc_id", *STATISTICS])

        return each

    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = ", ".join([f"doc_id {kind}", *(f"{s} long" for s in STATISTICS)])
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(by_batch(make), shape)


def _holds(values: np.ndarray, rule: Rule, names: list[str]) -> np.ndarray:
    held = np.ones(len(values), dtype=bool)
    for name, sign, cut in rule:
        x = values[:, names.index(name)]
        held &= (x >= cut) if sign == ">=" else (x < cut)
    return held


def _grown(values: np.ndarray, bad: np.ndarray, names: list[str]) -> Rule:
    """Add the condition of most information gain until no good document is left in."""
    rule: Rule = []
    inside = np.ones(len(values), dtype=bool)
    while len(rule) < MOST_CONDITIONS and (~bad[inside]).any():
        p, n = bad[inside].sum(), (~bad[inside]).sum()
        best, added = 0.0, None
        for j, name in enumerate(names):
            x = values[inside, j]
            known = x[~np.isnan(x)]
            if not len(known):
                continue
            for cut in np.unique(np.quantile(known, np.linspace(0, 1, CUTS + 1))):
                for sign in (">=", "<"):
                    held = (x >= cut) if sign == ">=" else (x < cut)
                    p1 = (bad[inside] & held).sum()
                    n1 = held.sum() - p1
                    if p1:
                        gain = p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p / (p + n)))
                        if gain > best + 1e-9:
                            best, added = gain, (name, sign, float(cut))
        if added is None:
            break
        rule.append(added)
        inside = _holds(values, rule, names)
    return rule


def _pruned(rule: Rule, values: np.ndarray, bad: np.ndarray, names: list[str]) -> tuple[Rule, float, int]:
    """Drop last conditions as long as that is no worse on the labels held back."""

    def worth(r: Rule) -> tuple[float, float, int]:
        held = _holds(values, r, names)
        p, n = int((bad & held).sum()), int((~bad & held).sum())
        return (p - n) / max(p + n, 1), p / max(p + n, 1), p

    best = rule
    for k in range(len(rule) - 1, 0, -1):
        if worth(rule[:k])[0] >= worth(best)[0]:
            best = rule[:k]
    return best, *worth(best)[1:]


def learn_rules(values: np.ndarray, bad: np.ndarray, names: list[str]) -> list[Rule]:
    """An ordered list of rules, each of which says that a document is bad. Two thirds of
    the rows grow rules, every third one prunes them. Comparisons with a missing value
    are false."""
    back = np.arange(len(values)) % 3 == 2
    grow, grow_bad, check, check_bad = values[~back], bad[~back], values[back], bad[back]
    rules: list[Rule] = []
    while len(rules) < MOST_RULES and grow_bad.any():
        rule = _grown(grow, grow_bad, names)
        if not rule:
            break
        rule, precision, caught = _pruned(rule, check, check_bad, names)
        if precision < PRECISION or caught < 3:
            break
        rules.append(rule)
        left, left_check = ~_holds(grow, rule, names), ~_holds(check, rule, names)
        grow, grow_bad, check, check_bad = grow[left], grow_bad[left], check[left_check], check_bad[left_check]
    return rules


def learn(numbers: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Rule]:
    """Rules from ``statistics`` and labels (doc_id, quality; 0 is bad).

    About ``sample`` labelled documents, picked by a hash of the id, reach the driver.
    Null labels and ids teach nothing, and of labels that disagree the lowest counts.
    """
    known = labels.select("doc_id", "quality").dropna()
    rows = known.count()
    drawn = known.filter(
        F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < 1_000_000 * min(1.0, sample / max(rows, 1)))
    lowest = drawn.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    features = [F.expr(e).alias(name) for name, e in FEATURES.items()]
    taught = (
        numbers.join(lowest, "doc_id").filter(~base_failed())
        .select("doc_id", "quality", *features).orderBy("doc_id", *FEATURES).collect()
    )
    names = list(FEATURES)
    values = np.array([[np.nan if r[n] is None else r[n] for n in names] for r in taught], dtype=float)
    bad = np.array([r["quality"] == 0 for r in taught], dtype=bool)
    return learn_rules(values.reshape(len(taught), len(names)), bad, names)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one expression: false at the first rule that holds, else true."""
    kept = F.when(base_failed(), False)
    for rule in rules:
        holds = F.lit(True)
        for name, sign, cut in rule:
            x = F.expr(FEATURES[name])
            holds = holds & ((x >= cut) if sign == ">=" else (x < cut))
        kept = kept.when(holds, False)
    return kept.otherwise(True)


def judged(numbers: DataFrame, rules: list[Rule]) -> DataFrame:
    """doc_id, the base statistics, base_failed and kept, for each row of ``statistics``.

    Null and empty texts have no words and fail the base rule. Null ids and repeated
    rows are kept as rows; an empty table gives an empty result.
    """
    return numbers.select("doc_id", *STATISTICS[:5], base_failed().alias("base_failed"),
                          verdict(rules).alias("kept"))
