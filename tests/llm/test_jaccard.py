import random
import re
from collections import defaultdict

import pytest

from tallygrid.llm import jaccard
from tallygrid.llm.components import components


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [shingle_set(r[1]) for r in rows]
    having = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            having[x].append(i)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for j in having[x]:
                common[j] += j < i
        for j, n in common.items():
            if n and 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), least.get(find(i)) if sets[i] else r[0]) for i, r in enumerate(rows)), key=repr)


def family(draw, base, count, edits):
    for _ in range(count):
        words = list(base)
        for _ in range(draw.randint(*edits)):
            words[draw.randrange(len(words))] = f"e{draw.randrange(10**6)}"
        yield " ".join(words)


def made(seed):
    draw = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    texts = []
    for size, count, edits in ((150, 90, (0, 8)), (60, 30, (0, 4)), (12, 20, (0, 2)), (6, 10, (0, 1)), (400, 15, (0, 30))):
        texts += family(draw, [draw.choice(vocabulary) for _ in range(size)], count, edits)
    passage = " ".join(draw.choice(vocabulary) for _ in range(60))
    for _ in range(60):  # a passage that many share, of between a third and all of a text
        own = " ".join(f"u{draw.randrange(10**6)}" for _ in range(draw.choice((0, 5, 14, 20, 60))))
        texts.append(f"{passage} {own}".strip())
    chain = [draw.choice(vocabulary) for _ in range(100)]
    for i in range(0, 60, 4):
        texts.append(" ".join(chain[i : i + 40]))
    texts += texts[:40] + ["A b c", "a B  c", "a b c d e", "a b"]
    draw.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,group,block", [(1, 256, 1024), (2, 8, 4), (3, 16, 7)])
def test_equals_brute_force(docs_of, rows_of, monkeypatch, seed, group, block):
    monkeypatch.setattr(jaccard, "GROUP", group)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = made(seed)
    docs = docs_of(*((d, t, "en", "s") for d, t in rows))
    assert rows_of(jaccard.linked_documents(docs)) == brute(rows)


def test_real_documents(real_docs, real_rows, rows_of):
    assert rows_of(jaccard.linked_documents(real_docs)) == brute(real_rows)


def test_odd_rows(odd, odd_rows, none, rows_of):
    assert rows_of(jaccard.linked_documents(odd)) == brute(odd_rows)
    assert jaccard.linked_documents(none).count() == 0
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _, c in brute(odd_rows) if d == c}


def test_limit_is_met_exactly(docs_of, rows_of):
    base = [f"w{i}" for i in range(11)]  # seven shingles
    rows = [(1, " ".join(base)), (2, " ".join(base[:-1])), (3, " ".join(base[:-2])), (4, " ".join(base[2:]))]
    assert rows_of(jaccard.linked_documents(docs_of(*((*r, "en", "s") for r in rows)))) == brute(rows)


def test_components_of_a_long_chain(spark, rows_of):
    n = 300
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (5, 5)], "a long, b long")
    assert rows_of(components(links)) == sorted([(i, 0) for i in range(1, n + 1)] + [(1001, 1000)], key=repr)
