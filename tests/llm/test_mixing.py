import re
from collections import Counter, defaultdict

import pytest

from tallygrid.llm import mixing


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def expected_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """The excess over caps is dealt out again and again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = sum(sizes.values()) * share
    target = {s: total * weight[s] / sum(weight.values()) for s in names}
    while True:
        over = [s for s in names if target[s] > most * sizes[s] + 1e-9]
        if not over:
            return target
        excess = sum(target[s] - most * sizes[s] for s in over)
        for s in over:
            target[s] = most * sizes[s]
        free = [s for s in names if target[s] < most * sizes[s] - 1e-9]
        for s in free:
            target[s] += excess * weight[s] / sum(weight[x] for x in free)


def check(rows, docs, **how):
    out = mixing.mix(docs, **how).collect()
    sizes = defaultdict(int)
    source = defaultdict(list)
    for doc, text, _, src, _ in rows:
        sizes[src] += words(text)
        source[doc].append(src)
    target = expected_targets(sizes)
    taken = defaultdict(int)
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in rows)
    for r in out:
        src = source[r["doc_id"]][0]
        assert r["source_size"] == sizes[src]
        assert r["target"] == pytest.approx(target[src])
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert len(r["shards"]) == -(-r["taken"] // max(r["size"], 1))
        assert all(0 <= s < 16 for s in r["shards"])
        taken[src] += r["taken"]
    for src in sizes:
        assert taken[src] == int(target[src] + 0.5)
    return sorted((tuple(r) for r in out), key=repr)


def test_quotas_are_met(real_docs, real_rows):
    first = check(real_rows, real_docs)
    assert first == check(real_rows, real_docs.repartition(7))


def test_hot_source(docs_of):
    rows = [(i, "w " * (i % 9), None, "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(600)]
    check([(*r, 0) for r in rows], docs_of(*rows), blocks=16)


def test_odd_rows(odd, odd_rows):
    check([(*r, 0) for r in odd_rows], odd)


def test_no_rows(none):
    assert mixing.mix(none).count() == 0
    assert mixing.mixed_documents(none).count() == 0


def test_only_empty_texts(docs_of):
    assert {tuple(r)[1:5] for r in mixing.mix(docs_of("", None)).collect()} == {(0, 0, 0.0, 0)}


def test_shards_get_even_loads_and_their_sources_vary(real_docs):
    plan = mixing.mix(real_docs, shards=4)
    loads = Counter(s for r in plan.collect() for s in r["shards"])
    assert set(loads) == {0, 1, 2, 3} and max(loads.values()) < 2 * min(loads.values())


def test_documents_of_the_mix_are_whole(real_docs, real_rows):
    """Each copy has its text unchanged; only a quota's edge is rounded to whole documents."""
    plan = {r["doc_id"]: (r["taken"], r["size"]) for r in mixing.mix(real_docs).collect()}
    mixed = mixing.mixed_documents(real_docs)
    assert mixed.columns == real_docs.columns
    got = Counter(tuple(r) for r in mixed.collect())
    assert set(got) <= set(real_rows)
    copies = Counter()
    for row, n in got.items():
        copies[row[0]] += n
    sources = {r[0]: r[3] for r in real_rows}
    off = {d for d, (taken, size) in plan.items() if copies[d] * size != taken}
    assert all(copies[d] == (2 * plan[d][0] + plan[d][1]) // (2 * plan[d][1]) for d in off)
    assert max(Counter(sources[d] for d in off).values(), default=0) <= 1


def test_many_shards_and_ranked_ranges(real_docs, monkeypatch):
    """Copies of blocks that are ranked by ranges are split as those in one order."""
    plain = sorted(map(tuple, mixing.mix(real_docs, blocks=64, shards=16).collect()))
    monkeypatch.setattr(mixing, "PLACED", 50)
    assert sorted(map(tuple, mixing.mix(real_docs, blocks=64, shards=16).collect())) == plain
    monkeypatch.setattr(mixing, "SHARD_WORDS", 2000)
    shards = {s for r in mixing.mix(real_docs).collect() for s in r["shards"]}
    assert max(shards) >= 16
    assert mixing.mixed_documents(real_docs).count() == sum(
        len(r["shards"]) for r in mixing._planned(real_docs, whole=True).collect())


def test_clashing_names(docs_of):
    from pyspark.sql import functions as F

    names = ("size", "target", "taken", "spot", "words", "full", "node", "copy", "shards", "block", "source_size")
    docs = docs_of("a b c", "d e", None).withColumns({n: F.lit("x") for n in names})
    assert mixing.mixed_documents(docs).columns == docs.columns
