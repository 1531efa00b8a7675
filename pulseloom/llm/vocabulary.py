"""Public tokenizer files: their place, and encoders with a bounded memory of words.

``PULSELOOM_TOKENIZERS`` names another folder than that of the installed package.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

#: Words kept per encoder; beyond that those met in one batch only are forgotten, which changes no result.
KEPT_WORDS = 1_000_000
#: Words that the tokenizer gets in one text, and the letter between them.
JOINED_WORDS = 100
_BETWEEN = "\0"
#: Longer words are encoded each time.
KEPT_CHARS = 64
#: Python splits at these, tokenizers do not.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_BLANKS = re.compile(r"[^\x20\x09-\x0D]+")


def vocabulary_path(name: str) -> str:
    folder = os.environ.get("PULSELOOM_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def public_pattern() -> str:
    """The pattern that splits text before the merges of the rank files."""
    import public_tokenizers

    return public_tokenizers.PATTERN


class WordTokenizer:
    """A tokenizer that drops white space, so that each word has ids of its own.

    ``batch`` gives the ids of each text as little-endian 32-bit numbers. They are those of the
    whole text, since no token spans white space. A worker keeps its words until it ends, also
    while it works for other operators, or until ``forget``; ``kept`` is their number, by default ``KEPT_WORDS``.
    """

    def __init__(self, path: str, kept: int | None = None) -> None:
        from tokenizers import Tokenizer

        self.kept = kept or KEPT_WORDS
        # Special tokens in a text are found, as the library does by default; they hold no white space.
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.again: set[str] = set()
        self.between = self.tokenizer.encode(_BETWEEN, add_special_tokens=False).ids

    @staticmethod
    @lru_cache(maxsize=4)
    def shared(path: str, kept: int | None = None) -> WordTokenizer:
        """One per worker process, file and number of words."""
        return WordTokenizer(path, kept)

    def forget(self) -> None:
        """Give the memory of words back."""
        self.known, self.again = {}, set()

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        if len(self.between) != 1:
            found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
            return {w: np.array(e.ids, dtype="<u4").tobytes() for w, e in zip(words, found, strict=True)}
        out = {}
        plain = [w for w in words if _BETWEEN not in w]
        for low in range(0, len(plain), JOINED_WORDS):
            part = plain[low : low + JOINED_WORDS]
            text = f" {_BETWEEN} ".join(part)
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
            ends = [*np.flatnonzero(ids == self.between[0]).tolist(), len(ids)]
            data, start = ids.tobytes(), 0
            for word, end in zip(part, ends, strict=True):
                out[word] = data[4 * start : 4 * end]
                start = end + 1
        for word in words:
            if _BETWEEN in word:
                out[word] = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return out

    def batch(self, texts: list[str]) -> list[bytes]:
        split = [_BLANKS.findall(t) if _SEPARATORS.search(t) else t.split() for t in texts]
        distinct = set().union(*split)
        new = distinct.difference(self.known)
        if len(self.known) + len(new) > self.kept:
            self.known = {w: self.known[w] for w in self.again.union(distinct - new)} if len(self.again) < self.kept // 2 else {}
            self.again = set()
            new = distinct.difference(self.known)
        self.again |= distinct - new
        long = self._learn([w for w in new if len(w) > KEPT_CHARS])
        self.known.update(self._learn([w for w in new if len(w) <= KEPT_CHARS]))
        if not long:
            return [b"".join(map(self.known.__getitem__, words)) for words in split]
        return [b"".join([self.known[w] if w in self.known else long[w] for w in words]) for words in split]
