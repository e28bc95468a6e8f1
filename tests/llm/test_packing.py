import zlib
from collections import defaultdict

import numpy as np
import pytest

from tallygrid.llm import packing
from tallygrid.llm.tokens import VOCABULARY, Tokens, public_path


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_path(VOCABULARY))


def ids_of(whole, text):
    return [*whole.encode(text or "", add_special_tokens=False).ids, 2]


def check(whole, rows, docs, length=4096):
    pieces = packing.pack(docs, length=length).collect()
    ids = defaultdict(list)
    for doc, text, *_ in rows:
        ids[doc].append(ids_of(whole, text))
    covered = defaultdict(int)
    for p in pieces:
        own = ids[p["doc_id"]][0]
        part = np.array(own[p["start"] : p["start"] + p["length"]], dtype="<u4")
        assert p["doc_tokens"] == len(own) and len(part) == p["length"] > 0
        assert p["ids_crc32"] == zlib.crc32(part.tobytes())
        covered[p["doc_id"]] += p["length"]
    assert covered == {d: sum(map(len, x)) for d, x in ids.items()}
    full = defaultdict(list)
    for p in pieces:
        full[p["sequence_id"]].append((p["offset"], p["length"]))
    total = sum(covered.values())
    padding = 0
    for parts in full.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    assert padding == 0
    assert sum(1 for parts in full.values() if sum(s for _, s in parts) == length) >= total // length
    return pieces


def test_real_documents(whole, real_docs, real_rows):
    check(whole, real_rows, real_docs)


def test_odd_rows(whole, odd, odd_rows):
    check(whole, odd_rows, odd, length=64)


def test_no_rows(none):
    assert packing.pack(none).count() == 0


def test_one_token(whole, docs_of):
    check(whole, [(1, None)], docs_of((1, None, None, None)))


@pytest.mark.parametrize("spelled_out", [False, True])
def test_ids_are_the_tokenizers(whole, spelled_out):
    own = Tokens(public_path(VOCABULARY), spelled_out)
    whole.encode_special_tokens = spelled_out
    draw = np.random.default_rng(5)
    alphabet = list("aBcéÉßßñÇıİσΣςµºª½²¼¾×÷_'sterdl'|<>.,!\"-\t\n   ​日本ʼ́̈\x1c\x85😀09٣")
    texts = ["".join(draw.choice(alphabet, size=40)) for _ in range(400)]
    texts += ["it's we'LL <|endoftext|>x <|startoftext|> <| endoftext|>", "", " ", "é ́e", "Ⅷ ⅷ"]
    for text in texts:
        got = np.frombuffer(own.of(text.encode()), "<u2").tolist()
        assert got == whole.encode(text, add_special_tokens=False).ids, repr(text)
    whole.encode_special_tokens = False


def test_hilbert_curve_visits_every_cell_by_single_steps():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    place = packing.hilbert(grid, bits=3)
    assert sorted(place) == list(range(512))
    path = grid[np.argsort(place)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_like_documents_become_neighbours(docs_of):
    rows = [(i, ("alpha beta gamma " if i % 2 else "delta omega kappa ") * 30, "en", "s") for i in range(40)]
    pieces = sorted(packing.pack(docs_of(*rows)).collect(), key=lambda p: (p["sequence_id"], p["offset"]))
    kinds = [p["doc_id"] % 2 for p in pieces if p["start"] == 0]
    assert sum(a != b for a, b in zip(kinds, kinds[1:])) == 1
