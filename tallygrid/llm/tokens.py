"""Token ids by a public vocabulary, with what was worked out once kept for reuse.

White space always separates tokens in this vocabulary, so a text's ids are the ids of
its words. Words repeat, so each Python worker keeps the ids of those it has met.
"""

from __future__ import annotations

import os
import re
import unicodedata

import numpy as np

VOCABULARY = "word_bpe_49k.json"
CACHED = 500_000
IDS = np.dtype("<u2")  # every id of the vocabulary is below 2 ** 16

# How the vocabulary's file says that text is cut, for the characters
# that _PLAIN admits. In them \w is letters, digits and the underscore.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
_PLAIN = re.compile("[!-~¡-©«-±´-¸»¿-ɏ]*")


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_names() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones
    for themselves, the others in turn from code point 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Tokens:
    """``of(text)`` gives the ids of UTF-8 bytes, as bytes of ``IDS``."""

    def __init__(self, path: str, spelled_out: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = spelled_out
        self.model = self.whole.model
        self.names = _byte_names()
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            named = piece if piece.isascii() else "".join(self.names[b] for b in piece.encode())
            found = np.array([t.id for t in self.model.tokenize(named)], dtype=IDS).tobytes()
            if len(self.pieces) >= CACHED:
                self.pieces.clear()
            self.pieces[piece] = found
        return found

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if word.isalpha():  # letters of ASCII only: one piece
            found = self._piece(text.lower())
        elif _PLAIN.fullmatch(text) and "<|" not in text:
            plain = unicodedata.normalize("NFC", text).lower()
            found = b"".join(map(self._piece, _PIECES.findall(plain)))
        else:
            ids = self.whole.encode(text, add_special_tokens=False).ids
            found = np.array(ids, dtype=IDS).tobytes()
        if len(self.words) >= CACHED:
            self.words.clear()
        self.words[word] = found
        return found

    def of(self, text: bytes | None) -> bytes:
        known, miss = self.words.get, self._word
        return b"".join([known(w) or miss(w) for w in text.split()]) if text else b""


_kept: dict[tuple[str, bool], Tokens] = {}


def tokens(path: str, spelled_out: bool = False) -> Tokens:
    """One for each worker process. ``spelled_out``: the names of special tokens that
    stand in a text are ordinary text."""
    if (path, spelled_out) not in _kept:
        _kept[path, spelled_out] = Tokens(path, spelled_out)
    return _kept[path, spelled_out]


def forget() -> None:
    """Give up what this worker keeps, for a stage that keeps something else."""
    _kept.clear()
