"""Ids of whole texts with the tokenizers library, one call per distinct piece.

Both kinds of tokenizer used here split a text into words before they merge, never across the
start of a run of white space, and always between a letter and a comma or full stop, and between
a line feed and a letter. So the ids of a text are those of its pieces, one after the other, and
frequent pieces are looked up.
"""

from __future__ import annotations

import os
import re
from functools import cache

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers

# White space of the Unicode property White_Space, which the tokenizers' patterns go by.
_WHITE = "\t-\r \x85\xa0  -     　"
# All of these are letters to both kinds of tokenizer: basic Latin, Latin-1, Latin Extended A and B.
_LETTERS = "a-zA-ZÀ-ÖØ-öø-ɏ"
_WORD = f"[{_LETTERS}]+(?![^{_WHITE},.!?;:#$%&*)])"  # both end a word before these
_PIECES = re.compile(f" {_WORD}|\n(?=[{_LETTERS}])|{_WORD}|[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
_BLANK = "\u0120"  # how byte-level vocabularies spell a blank
LONGEST_PIECE = 64
CACHE_PIECES = 1_200_000
_TOGETHER = 1024


class PieceEncoder:
    """Little-endian unsigned 32-bit ids of texts. The cache is bounded and starts anew when full."""

    def __init__(self, path: str, plain: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks share the cores already
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = plain
        # strings of special tokens, which count in the case they are given in
        added = self._tokenizer.get_added_tokens_decoder().values()
        self._special = [] if plain else [x.content.lower() for x in added if x.special]
        self._cache: dict[str, bytes] = {}
        # a tokenizer that lower-cases gives A-Z and a-z the same ids: look them up as one
        self._folds = "Lowercase" in str(self._tokenizer.normalizer)
        # ids that can only begin a word after a blank, or only end one
        self.vocabulary = vocabulary = self._tokenizer.get_vocab()
        # byte-level without normalizer and with all bytes in the vocabulary: ids spell their text
        whole = set(pre_tokenizers.ByteLevel.alphabet()) <= set(vocabulary)
        self.lossless = self._tokenizer.normalizer is None and "ByteLevel" in str(self._tokenizer.decoder) and whole
        suffix = self._tokenizer.model.end_of_word_suffix
        self._marks_end = bool(suffix)
        self._marked = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._marked[[i for x, i in vocabulary.items() if (x.endswith(suffix) if suffix else x.startswith(_BLANK))]] = True

    def _has_special(self, text: str) -> bool:
        lowered = text.lower()
        return any(x in lowered for x in self._special)

    def _each(self, pieces: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def _words(self, pieces: list[str]) -> list[bytes]:
        """Pieces of a blank and letters keep apart when joined, and are one word each: many in a
        call, told apart by the ids that begin or end a word."""
        ids = np.array(self._tokenizer.encode_batch_fast(["".join(pieces)], add_special_tokens=False)[0].ids, dtype="<u4")
        marks = np.flatnonzero(self._marked[ids])
        if len(marks) != len(pieces):
            return self._each(pieces)
        cut = [0, *(marks + 1).tolist()] if self._marks_end else [*marks.tolist(), len(ids)]
        data = ids.tobytes()
        return [data[4 * a : 4 * b] for a, b in zip(cut, cut[1:])]

    def _add(self, pieces: list[str]) -> None:
        spaced = [x for x in pieces if x[0] == " " and x[1:].isalpha()]
        for a in range(0, len(spaced), _TOGETHER):
            part = spaced[a : a + _TOGETHER]
            self._cache.update(zip(part, self._words(part)))
        others = [x for x in pieces if x not in self._cache]
        for a in range(0, len(others), _TOGETHER):
            part = others[a : a + _TOGETHER]
            self._cache.update(zip(part, self._each(part)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. Texts that come together share their calls."""
        if len(self._cache) > CACHE_PIECES:
            self._cache.clear()
        held, found, unseen = self._cache.get, [], set()
        for text in texts:
            if self._folds and not (self._special and self._has_special(text)):
                text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
            pieces = _PIECES.findall(text)
            ids = list(map(held, pieces))
            gaps = [i for i, x in enumerate(ids) if x is None]
            unseen.update([pieces[i] for i in gaps])
            found.append((ids, [(i, pieces[i]) for i in gaps]))
        if unseen:
            self._add(list(unseen))
        for ids, gaps in found:
            for i, piece in gaps:
                ids[i] = held(piece)
        for x in unseen:
            if len(x) > LONGEST_PIECE:
                del self._cache[x]
        return [b"".join(ids) for ids, _ in found]


@cache
def encoder(path: str, plain: bool = False) -> PieceEncoder:
    """One per process: workers are reused, and so is what they have looked up.

    Strings of special tokens in a text are those tokens, as the library has it; ordinary text
    if ``plain``.
    """
    return PieceEncoder(path, plain)
