"""The trie of conversation prefixes against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from tallygrid.llm import trie

SHAPE = "conv_id long, turn long, role string, text string"


def brute(rows, group=100, head=6):
    """Without ties of turn, the order of which is a hash's."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {c: [x for _, x in sorted(turns, key=lambda t: t[0])] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % head
        built[c] = own.get(c - int(abs(c) % group * (1 if c > 0 else -1)), [])[:h] + turns[h:]
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    below = {n: [m for m in nodes if len(m) == len(n) + 1 and m[: len(n)] == n] for n in nodes}

    def totals(n):
        parts = [totals(m) for m in below[n]]
        own = (len(nodes[n]) - 1) * len(n[-1][1]) if n else 0
        return (sum(p[0] for p in parts) if parts else 1), own + sum(p[1] for p in parts)

    out = []
    for n, members in nodes.items():
        ends = sorted(c for c in members if len(built[c]) == len(n))
        out.append((min(members), len(n), min(nodes[n[:-1]]) if n else None, len(members), len(below[n]), *totals(n),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def found(spark, rows, shape=SHAPE, parts=3, **how):
    df = spark.createDataFrame(rows, shape).repartition(parts)
    return sorted(map(tuple, trie.prefix_trie(df, **how).collect()), key=lambda r: r[:2])


def conversations(seed, n, most=7, group_like=1):
    draw, rows = random.Random(seed), []
    for c in range(n):
        for t in range(draw.randint(1, most)):
            rows.append((c * group_like, t, draw.choice(["user", "assistant", None]), draw.choice(["a", "bb", "ccc é", "", None])))
    return rows


@pytest.mark.parametrize("how", [{}, {"crowd": 3, "queue": 4}])
def test_against_brute_force(spark, how):
    rows = conversations(1, 260)
    assert found(spark, rows, **how) == brute(rows)


def test_long_copies_cut_over_tasks(spark):
    turns = [(t, "user", f"turn {t % 3}") for t in range(700)]
    rows = [(c, *x) for c in (3, 5, 103, 205) for x in turns] + conversations(2, 4)
    rows = [r for r in rows if r[0] != 3 or r[1] < 650]
    keep = {}
    for r in rows:
        keep.setdefault(r[:2], r)
    rows = list(keep.values())
    assert found(spark, rows, parts=7, crowd=2, queue=3) == brute(rows)


def test_repeated_rows_and_ties_count_as_turns(spark):
    rows = [(1, 0, "user", "x")] * 40 + [(2, 0, "user", "x")] * 41
    assert found(spark, rows) == brute(rows)
    tied = [(7, 4, "user", "x"), (7, 4, "user", "y"), (7, None, "user", "z")]
    assert found(spark, tied) == found(spark, tied[::-1])
    assert [r[1] for r in found(spark, tied)] == [0, 1, 2, 3]


def test_nulls_empty_and_turnless(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "lost")]) == []
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in range(1, 90)}
    turnless = next(c for c in h if h[c] > 2)
    rows = [(turnless, None, None, None), (turnless, 1, None, "")]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows)[0][1:6] == (0, None, 1, 0, 1)
    assert found(spark, rows + [(-205, 1, "user", "neg"), (-200, 1, "user", "base")]) == brute(
        rows + [(-205, 1, "user", "neg"), (-200, 1, "user", "base")])


def test_extra_columns_with_clashing_names(spark):
    rows = conversations(3, 30)
    shape = SHAPE + ", depth int, lot int, pos string, points string, times int, n_convs int, top string, tree long"
    wide = [(*r, 1, 2, "p", "q", 3, 4, "t", 5) for r in rows]
    assert found(spark, wide, shape) == brute(rows)


def test_one_set_of_ends_over_many_tasks(spark):
    """A turn that all conversations consist of: its ids are spelled out in chunks."""
    rows = [(c, 0, "user", "hello") for c in range(30_000)]
    got = {r[1]: r for r in found(spark, rows, parts=4)}
    assert got[1][3] == 30_000
    assert got[1][7] == hashlib.sha256(",".join(map(str, range(30_000))).encode()).hexdigest()


def test_queue_spills_and_gives_back_in_order():
    draw, queue = random.Random(5), trie.SpillingQueue(most=16)
    entries = [(draw.randrange(1000), draw.randrange(9), i) for i in range(5000)]
    got = []
    for i, e in enumerate(entries):
        queue.push(*e)
        if i % 3 == 2:
            least = queue.least()
            got.append(queue.pop())
            assert got[-1] == least
    assert queue.runs
    assert len(queue.heap) <= 16
    rest = []
    while queue.least() is not None:
        rest.append(queue.pop())
    assert rest == sorted(rest)
    assert sorted(got + rest) == sorted(entries)
