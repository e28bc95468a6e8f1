import hashlib
import re
from collections import defaultdict

from tallygrid.llm import exact


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def brute(rows):
    groups = defaultdict(list)
    for i, (doc, text, *_) in enumerate(rows):
        groups[normal(text)].append((-len(text or ""), doc is None, doc or 0, i))
    out = []
    for i, (doc, text, *_) in enumerate(rows):
        group = groups[normal(text)]
        keep = min(group)[3]
        out.append((doc, rows[keep][0], len(group), i == keep, hashlib.sha256(normal(text).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_equals_brute_force(real_docs, real_rows, rows_of):
    assert rows_of(exact.exact_copies(real_docs)) == brute(real_rows)


def test_odd_rows(odd, odd_rows, rows_of):
    assert rows_of(exact.exact_copies(odd)) == brute(odd_rows)


def test_same_length_and_start_but_not_equal(docs_of, rows_of):
    start = "x" * 100
    rows = [(i, start + t, "en", "s") for i, t in enumerate(("a", "b", " a", "ab", "b "))]
    got = rows_of(exact.exact_copies(docs_of(*rows)))
    assert got == brute(rows)
    assert [r[1] for r in got] == [2, 4, 2, 3, 4]


def test_only_possible_copies_are_hashed_in_full(docs_of):
    texts = [f"{i} " + "y" * i for i in range(1, 300)] + ["7 yyyyyyy"]
    assert exact.possible_copies(docs_of(*texts)).count() < 30


def test_documents_that_stay(odd, odd_rows, none, rows_of):
    got = exact.without_copies(odd)
    assert got.columns == odd.columns
    keep = sorted({r[1] for r in brute(odd_rows)}, key=repr)
    assert sorted((r["doc_id"] for r in got.collect()), key=repr) == keep
    assert exact.without_copies(none).count() == 0
    assert exact.exact_copies(none).count() == 0


def test_one_row_of_a_group_is_kept(docs_of, rows_of):
    rows = [(5, "a b", "en", "s"), (5, "a  b", "en", "s"), (5, "a  b", "en", "s"), (7, "ab", "en", "s"),
            (None, "c", "en", "s"), (None, "c", "en", "s"), (None, " c", "en", "s"), (9, "d ", "en", "s"), (9, " d", "en", "s")]
    got = rows_of(exact.exact_copies(docs_of(*rows)))
    assert got == brute(rows)
    assert sum(r[3] for r in got) == 3


def test_more_keys_than_the_filter_holds(docs_of, real_docs, real_rows, rows_of):
    few = exact.possible_copies(real_docs, filter_words=1)
    usual = exact.possible_copies(real_docs)
    assert set(map(tuple, few.collect())) <= set(map(tuple, usual.collect()))
    assert sorted(map(repr, exact.copy_groups(few).collect())) == sorted(map(repr, exact.copy_groups(usual).collect()))
