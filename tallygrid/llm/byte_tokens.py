"""Token ids by a byte-level vocabulary, for a batch of texts at once."""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallygrid.llm.tokens import public_path

VOCABULARY = "byte_bpe_50k.json"
IDS = np.dtype("<u2")  # every id of the vocabulary is below 2 ** 16

# Fixed value: how byte-level vocabularies of this kind cut a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# A space with white space on both sides, or at the end after some, is cut otherwise than
# before itself; everywhere else a piece begins at each space.
_INSIDE = re.compile(r"\s \s|\s \Z")
_PERHAPS_INSIDE = (
    r" [ \x09-\x0d\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]| \z")


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones
    are themselves, the others follow from code point 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _ranked(path: str):
    """The same vocabulary for ``tiktoken``, which is faster; None unless its ids rise in
    the order of its merges, as that library takes one for the other."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    vocabulary, byte = model["vocab"], _byte_of()
    parts = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    merged = [vocabulary["".join(p)] for p in parts]
    if any(a >= b for a, b in zip(merged, merged[1:])) or max(vocabulary[c] for c in byte) >= merged[0]:
        return None
    known = {*merged, *(vocabulary[c] for c in byte)}
    ranks = {bytes(byte[c] for c in name): i for name, i in vocabulary.items() if i in known}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class ByteTokens:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.ranked = _ranked(path)
        self.marks = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        names = sorted(self.whole.get_vocab().items(), key=lambda x: x[1])
        self.sizes = np.array([len(name) for name, _ in names])  # a character stands for a byte

    def _encode(self, text: str) -> np.ndarray:
        if self.ranked is None or any(mark in text for mark in self.marks):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=IDS)
        return np.array(self.ranked.encode_ordinary(text), dtype=IDS)

    def _of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of each word with a space before it: all ids, and where those of each
        word begin and how many they are. The words are encoded in one go and told apart
        by how many bytes each id stands for."""
        sizes = pc.binary_length(words).to_numpy().astype(np.int64)
        edged = (sizes == 0) | pc.not_equal(pc.utf8_trim_whitespace(words), words).to_numpy(zero_copy_only=False)
        plain = np.flatnonzero(~edged)
        ids = self._encode(" " + pc.binary_join(pa.ListArray.from_arrays(
            [0, len(plain)], words.take(pa.array(plain))), " ")[0].as_py()) if len(plain) else np.zeros(0, IDS)
        ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum(sizes[plain] + 1)) + 1
        begins, counts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        begins[plain[1:]] = ends[:-1]
        counts[plain] = np.diff(ends, prepend=0)
        others = [self._encode(f" {words[i].as_py()}") for i in np.flatnonzero(edged).tolist()]
        counts[edged] = [len(x) for x in others]
        begins[edged] = len(ids) + np.cumsum(counts[edged]) - counts[edged]
        return np.concatenate([ids, *others]), begins, counts

    def of(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, each followed by ``end``, and where each text
        begins among them (and the last ends); null is empty text."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        odd = pc.match_substring_regex(texts, _PERHAPS_INSIDE).to_numpy(zero_copy_only=False)
        for mark in self.marks:
            odd = odd | pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        alone = {}
        for i in np.flatnonzero(odd).tolist():
            text = texts[i].as_py()
            if any(mark in text for mark in self.marks) or _INSIDE.search(text):
                alone[i] = self._encode(text)
        if alone:
            texts = pc.if_else(pa.array([i in alone for i in range(len(texts))]), "", texts)
        words = pc.split_pattern(texts, " ")
        begins = words.offsets.to_numpy().astype(np.int64)
        coded = words.flatten().dictionary_encode()
        codes, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        # A text's first word has no space before it; each text has an entry of its own for that.
        firsts = [alone[i] if i in alone else self._encode(w) if w else np.zeros(0, IDS)
                  for i, w in enumerate(distinct.take(pa.array(codes[begins[:-1]])).to_pylist())]
        pool, starts, sizes = self._of_words(distinct)
        more = [*firsts, np.array([end], IDS)]
        counts = np.array([len(x) for x in more])
        starts = np.concatenate([starts, len(pool) + np.cumsum(counts) - counts])
        pool, sizes = np.concatenate([pool, *more]), np.concatenate([sizes, counts])
        codes[begins[:-1]] = len(distinct) + np.arange(len(texts))
        codes = np.insert(codes, begins[1:], len(sizes) - 1)
        each = sizes[codes]
        ends = np.cumsum(each)
        ids = pool[np.repeat(starts[codes] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)]
        last = begins[1:] + np.arange(len(texts))
        return ids, np.concatenate([[0], ends[last]])


_kept: dict[str, ByteTokens] = {}


def byte_tokens(path: str | None = None) -> ByteTokens:
    """One for each worker process."""
    path = path or public_path(VOCABULARY)
    if path not in _kept:
        _kept[path] = ByteTokens(path)
    return _kept[path]
