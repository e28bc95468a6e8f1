"""Predict the language of a text.

Method: word-first backoff. A known word is scored by its log frequency in each
language; a word never seen is scored by its longest known character n-grams.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrid.llm import hashes, tokens
from tallygrid.llm.common import by_batch, in_slices, stored

UNKNOWN = "und"
LEARNED_PER_LANGUAGE = 4000  # distinct texts; all of a language that has fewer
LEARNED = 400_000  # distinct texts of all languages; each has one at least
LARGEST_MODEL = 1 << 30  # bytes that every Python worker can hold
LONGEST = 5
SLICE = 1 << 22  # bytes of text that are scored at once
SMOOTHING = 0.05
_SEED = 42  # that of Spark's xxhash64

_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case."""
    found = _LETTERS.findall(text.lower())
    return found if text.isascii() else [w for w in found if w.isalpha() or any(c.isalpha() for c in w)]


def _grams(word: str, n: int) -> list[str]:
    padded = f"_{word}_"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def _hash(name: str) -> int:
    return xxhash.xxh64_intdigest(name, _SEED)


@dataclass
class Model:
    """Log frequencies by language, kept sparse: a language in which a name was not seen
    has the floor.

    ``keys`` are the hashes, in order, of the known words and of the known n-grams with
    their length in front; a digit keeps these apart from words, which are letters only.
    The entries of key i, from ``begins[i]`` to ``begins[i + 1]``, are languages and how far
    above the floor their log frequency is. ``floors`` has a row for words, one for n-grams.
    """

    languages: list[str]
    keys: np.ndarray
    begins: np.ndarray
    langs: np.ndarray
    above: np.ndarray
    floors: np.ndarray

    def rows_of(self, names: list[str]) -> np.ndarray:
        """The place of each name among the keys, -1 if it is not known."""
        hashes = np.fromiter(map(_hash, names), dtype=np.uint64, count=len(names))
        at = np.searchsorted(self.keys, hashes)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == hashes, at, -1) if len(self.keys) else np.full(len(names), -1)

    def evidence(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What is known of distinct words. Entries (word, key, weight): a known word has
        one of weight 1; any other has its longest known n-grams with equal weights. And
        for each word 0 if it is known, 1 if n-grams of it are, 2 if nothing is."""
        rows = self.rows_of(words)
        kind = np.where(rows >= 0, 0, 2)
        found = [(np.flatnonzero(rows >= 0), rows[rows >= 0], np.ones(int((rows >= 0).sum())))]
        open_ = np.flatnonzero(rows < 0).tolist()
        for n in range(LONGEST, 0, -1):
            grams = [[f"{n}{g}" for g in _grams(words[i], n)] for i in open_]
            owner = np.repeat(np.array(open_, dtype=np.int64), [len(g) for g in grams])
            at = self.rows_of([g for own in grams for g in own])
            owner, at = owner[at >= 0], at[at >= 0]
            times = np.bincount(owner, minlength=len(words))
            found.append((owner, at, 1.0 / times[owner]))
            kind[owner] = 1
            open_ = [i for i in open_ if not times[i]]
        word, key, weight = (np.concatenate(parts) for parts in zip(*found, strict=True))
        return word.astype(np.int64), key.astype(np.int64), weight, kind

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The best language of each text and its share of the likelihood."""
        counted = [Counter(words_of(t)) if t else Counter() for t in texts]
        place: dict[str, int] = {}
        word = np.array([place.setdefault(w, len(place)) for own in counted for w in own], dtype=np.int64)
        times = np.array([n for own in counted for n in own.values()], dtype=float)
        doc = np.repeat(np.arange(len(texts)), [len(own) for own in counted])
        size = len(self.languages)
        if not size or not len(word):
            return [(UNKNOWN, 0.0)] * len(texts)
        owner, key, weight, kind = self.evidence(list(place))
        # Each word's entries by language, then those of each document's words.
        many = self.begins[key + 1] - self.begins[key]
        entry = _ranges(self.begins[key], many)
        order = np.argsort(np.repeat(owner, many), kind="stable")
        value = (np.repeat(weight, many) * self.above[entry])[order]
        lang = self.langs[entry][order]
        each = np.bincount(np.repeat(owner, many), minlength=len(place))
        starts = np.cumsum(each) - each
        out: list[tuple[str, float]] = []
        most = max(1, (1 << 22) // size)
        for first in range(0, len(texts), most):
            last = min(first + most, len(texts))
            a, b = np.searchsorted(doc, [first, last])
            at = _ranges(starts[word[a:b]], each[word[a:b]])
            rows = np.repeat(doc[a:b] - first, each[word[a:b]])
            total = np.bincount(rows * size + lang[at], np.repeat(times[a:b], each[word[a:b]]) * value[at],
                                (last - first) * size).reshape(-1, size)
            for k in (0, 1):
                total += np.bincount(doc[a:b] - first, times[a:b] * (kind[word[a:b]] == k), last - first)[:, None] * self.floors[k]
            best = total.argmax(axis=1)
            sure = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            out += [(self.languages[i], float(s)) if counted[first + d] else (UNKNOWN, 0.0)
                    for d, (i, s) in enumerate(zip(best, sure, strict=True))]
        return out


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each beginning on, as many as its size says."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _counted(batches):
    counts: dict[str, Counter] = {}
    for batch in batches:
        for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist(), strict=True):
            counts.setdefault(lang, Counter()).update(words_of(text))
    for lang, own in counts.items():
        names, times = list(own), list(own.values())
        for i in range(0, len(names), 20_000):
            part = names[i : i + 20_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(part)), pa.array(part), pa.array(times[i : i + 20_000])],
                names=["lang", "name", "n"])


def drawn(labelled: DataFrame, per_language: int) -> DataFrame:
    """lang and text of ``per_language`` distinct texts of each language, those with the
    smallest hashes, or all if there are fewer; a language is a group of the shuffle, and
    only hashes are put in order."""
    spot = F.xxhash64("text")
    texts = stored(labelled.select("lang", spot.alias("spot")).distinct(), "language-texts")
    sizes = texts.groupBy("lang").agg(F.count("*").alias("n"))
    # Hashes of which about twice as many are below as are wanted.
    wanted = 2.0 * per_language + 50
    end = F.when(F.col("n") > wanted, ((wanted / F.col("n") - 0.5) * 2.0**64).cast("long")).otherwise(2**63 - 1)
    in_order = Window.partitionBy("lang").orderBy("spot")
    last = stored(
        texts.join(sizes.select("lang", end.alias("end")), "lang").filter(F.col("spot") <= F.col("end"))
        .withColumn("place", F.row_number().over(in_order)).filter(F.col("place") <= per_language)
        .groupBy("lang").agg(F.max("spot").alias("last")), "language-ends")
    return labelled.join(last, "lang").filter(spot <= F.col("last")).select("lang", "text").dropDuplicates()


def fit(labelled: DataFrame, per_language: int = LEARNED_PER_LANGUAGE, texts: int = LEARNED) -> Model:
    """Learn from the text and lang of the labelled rows given; rows where either is
    null teach nothing.

    The fit reads ``per_language`` distinct texts of each language, fewer where ``texts`` are
    not enough for all languages, and one at least; copies count once. All words of those
    texts and all their n-grams are counted in Spark and are in the model. It goes to every
    worker: that it is not larger than ``LARGEST_MODEL`` is checked.
    """
    labelled = labelled.select("text", "lang").dropna()
    names = sorted(r["lang"] for r in labelled.select("lang").distinct().collect())
    if not names:
        none = np.zeros(0)
        return Model([], none.astype(np.uint64), np.zeros(1, np.int64), none.astype(np.int32), none, np.zeros((2, 0)))
    words = stored(
        drawn(labelled, max(1, min(per_language, texts // len(names))))
        .mapInArrow(_counted, "lang string, name string, n long")
        .groupBy("lang", "name").agg(F.sum("n").alias("n")), "language-words")
    padded = F.concat(F.lit("_"), F.col("name"), F.lit("_"))

    def grams_of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(padded) - (n - 1), F.lit(1)))
        return F.when(F.length(padded) >= n, F.transform(
            starts, lambda i: F.concat(F.lit(str(n)), F.substring(padded, i, F.lit(n))))).otherwise(
            F.array().cast("array<string>"))

    every = F.flatten(F.array(*(grams_of(n) for n in range(1, LONGEST + 1))))
    grams = stored(
        words.select("lang", F.explode(every).alias("name"), "n")
        .groupBy("lang", "name").agg(F.sum("n").alias("n")), "language-grams")
    place = {x: i for i, x in enumerate(names)}
    floors = np.zeros((2, len(names)))
    for row, counts in enumerate((words, grams)):
        known = counts.select("name").distinct().count()
        sums = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
        totals = np.array([sums.get(lang, 0) for lang in names], dtype=float)
        floors[row] = np.log(SMOOTHING / (totals + SMOOTHING * (known + 1)))
    entries = words.unionByName(grams)
    if entries.count() * 24 > LARGEST_MODEL:
        raise ValueError(f"the model has {entries.count()} entries; take fewer texts than {texts}")
    table = entries.select(F.xxhash64("name").alias("key"), "lang", F.log(
        (F.col("n") + SMOOTHING) / SMOOTHING).cast("float").alias("above")).toArrow()
    keys = table["key"].to_numpy().view(np.uint64)
    langs = table["lang"].combine_chunks().dictionary_encode() if table.num_rows else pa.array([], pa.string()).dictionary_encode()
    number = np.array([place[x] for x in langs.dictionary.to_pylist()], dtype=np.int32)
    langs = number[langs.indices.to_numpy()] if len(number) else np.zeros(0, np.int32)
    order = np.lexsort((langs, keys))
    keys, begins = np.unique(keys[order], return_index=True)
    return Model(names, keys, np.append(begins, len(order)).astype(np.int64), langs[order],
                 table["above"].to_numpy()[order], floors)


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score (the winner's share of the likelihood, 0 to 1) for
    each row of ``docs``, from its whole text and nothing else.

    ``und`` with score 0 if the text is null, empty or has no letter, or if the model
    has learned no language. Ties go to the language that comes first by name. Null
    ids stay null, and repeated rows are rows of their own.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value

        def each(batch):
            for part in in_slices(batch, "text", SLICE):
                found = model.predict(part["text"].to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array([x for x, _ in found], pa.string()),
                     pa.array([x for _, x in found], pa.float64())],
                    names=["doc_id", "lang_pred", "score"])

        return each

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        by_batch(make), f"doc_id {kind}, lang_pred string, score double")


def with_language(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text has a recognised language, columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        hashes.forget()
        tokens.forget()
        model = shared.value

        def each(batch):
            for part in in_slices(batch, "text", SLICE):
                langs = [x for x, _ in model.predict(part["text"].to_pylist())]
                yield part.filter(pa.array([x != UNKNOWN for x in langs]))

        return each

    return docs.mapInArrow(by_batch(make), docs.schema)
