from collections import Counter

from tallygrid.llm import counts
from tallygrid.llm.tokens import VOCABULARY, public_path


def lengths(rows):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_path(VOCABULARY))
    whole.encode_special_tokens = True
    return Counter(len(whole.encode(text or "", add_special_tokens=False).ids) for _, text, *_ in rows)


def check(out, rows):
    assert Counter(r["n_tokens"] for r in out) == lengths(rows)
    files = {}
    for r in sorted(out, key=lambda r: (r["file"], r["document"])):
        number, at = files.get(r["file"], (0, 0))
        assert (r["document"], r["start"]) == (number, at)
        files[r["file"]] = (number + 1, at + r["n_tokens"] + 1)


def test_real_documents(real_docs, real_rows):
    check(counts.document_counts(real_docs).collect(), real_rows)


def test_odd_rows(odd, odd_rows):
    check(counts.document_counts(odd.repartition(3)).collect(), odd_rows)


def test_small_blocks_are_stitched(spark, real_docs, real_rows, tmp_path):
    folder = f"file://{tmp_path}/tokens"
    counts.write_token_files(real_docs.repartition(2), folder)
    for block in (1, 7, 100, 100_000):
        check(counts.counts(spark, folder, block=block).collect(), real_rows)


def test_unfinished_document_counts(spark, tmp_path):
    import numpy as np

    ids = np.array([5, 6, counts.END, counts.END, 9, 9, 9], dtype="<u2")
    (tmp_path / "part-0").write_bytes(ids.tobytes())
    for block in (1, 2, 3, 100):
        out = counts.counts(spark, f"file://{tmp_path}", block=block).orderBy("document").collect()
        assert [(r["document"], r["start"], r["n_tokens"]) for r in out] == [(0, 0, 2), (1, 3, 0), (2, 4, 3)]


def test_no_rows(none):
    assert counts.document_counts(none).count() == 0
