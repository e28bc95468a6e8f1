import hashlib
import random
import re

import pytest

from tallygrid.llm import repeats


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(rows, window=13):
    first = {}
    for doc, text, *_ in rows:
        words = words_of(text)
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            rank = (doc is None, doc or 0)
            first[key] = min(first.get(key, rank), rank)
    out = []
    for doc, text, *_ in rows:
        words = words_of(text)
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < (doc is None, doc or 0):
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def made(seed, vocabulary=300):
    draw = random.Random(seed)
    word = [f"w{i}É" for i in range(vocabulary)]
    passages = [[draw.choice(word) for _ in range(draw.randint(10, 80))] for _ in range(6)]
    rows = []
    for i in range(300):
        text = []
        for _ in range(draw.randint(0, 4)):
            text += [draw.choice(word) for _ in range(draw.randint(0, 30))]
            if draw.random() < 0.6:
                text += draw.choice(passages)
        rows.append((draw.randrange(10**6), "\n".join(text)))
    rows += [(i + 10**6, t) for i, (_, t) in enumerate(rows[:60])]
    return list({r[0]: r for r in rows}.values())


@pytest.mark.parametrize("seed,words,hot", [(1, 300, 64), (2, 3, 64), (3, 300, 2)])
def test_equals_brute_force(docs_of, rows_of, monkeypatch, seed, words, hot):
    monkeypatch.setattr(repeats, "HOT_LEAST", hot)
    rows = made(seed, words)
    docs = docs_of(*((d, t, "en", "s") for d, t in rows)).repartition(3)
    assert rows_of(repeats.repeated_words(docs)) == brute(rows)


def test_real_documents(real_docs, real_rows, rows_of):
    assert rows_of(repeats.repeated_words(real_docs)) == brute(real_rows)


def test_odd_rows(odd, odd_rows, none, rows_of):
    assert rows_of(repeats.repeated_words(odd)) == brute(odd_rows)
    for make in (repeats.repeated_words, repeats.repeated_spans, repeats.without_repeats):
        assert make(none).count() == 0


def test_spans_name_where_they_come_from(docs_of, rows_of):
    passage = [f"p{i}" for i in range(50)]
    rows = [(3, " ".join(["a", "b", *passage, "c"])), (9, " ".join(["x", *passage, "y"])), (4, "x y z")]
    docs = docs_of(*((d, t, "en", "s") for d, t in rows))
    assert rows_of(repeats.repeated_spans(docs)) == [(9, 1, 50, 3)]
    assert dict(rows_of(repeats.without_repeats(docs)))[9] == "x y"
