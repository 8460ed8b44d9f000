"""Token ids of whole texts by a tokenizer that drops white space: words are encoded once and kept.

For such a tokenizer (its pre-tokenizer keeps no white space and looks at none) the ids of a text are the ids of its
words one after another, so a text costs one look-up per word and the library is called for new words only. Two
more facts of its pre-tokenizer keep the store small: it lowers case, and it always cuts between a letter or digit
and ASCII punctuation, so "word", "Word" and "word," share one entry for their letters.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Sequence

import numpy as np

from .worker import kept

#: Words kept per worker; when full, the store starts anew. Bounds memory and changes no result.
KEEP = 800_000
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_ALNUM = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789")


def cut(word: bytes) -> bytes:
    """The word without closing punctuation, where the tokenizer cuts there."""
    stem = word.rstrip(_PUNCTUATION)
    return stem if len(stem) < len(word) and stem and stem[-1] in _ALNUM and b"<|" not in word else word


class Library:
    """The tokenizer. A word of letters only is one piece of the pre-tokenizer. Normaliser and pre-tokenizer leave a-z as
    they are, so words of these are given to the tokenizer's model itself. Other words of letters are asked for in one
    text: the last id of a piece is one of those with the word-end mark, so the ids are cut there. Where the number of
    ends isn't that of the words, and for all other words, each word is asked for alone."""

    def __init__(self, path: str, dtype: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer, self.dtype = Tokenizer.from_file(path), np.dtype(dtype)
        self.size = self.tokenizer.get_vocab_size()
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True

    def _coded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype)
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def ids(self, words: list[bytes]) -> dict[bytes, bytes]:
        out, alone, plain, model = {}, [], [], self.tokenizer.model
        for w in words:
            if w.isalpha() and w.islower():
                out[w] = array(self.dtype.char, [t.id for t in model.tokenize(w.decode())]).tobytes()
            else:
                plain.append(w)
        for a in range(0, len(plain), 1000):
            part = [(w, w.decode("utf-8", "replace")) for w in plain[a:a + 1000]]
            letters = [(w, t) for w, t in part if t.isalpha()]
            if letters:
                coded = self._coded([" ".join(t for _, t in letters)])[0]
                cuts = (np.flatnonzero(self.ends[coded]) + 1).tolist()
                if len(cuts) == len(letters):
                    raw, k = coded.tobytes(), self.dtype.itemsize
                    out.update((w, raw[x * k:y * k]) for (w, _), x, y in zip(letters, [0, *cuts], cuts))
            alone += [(w, t) for w, t in part if w not in out]
        for a in range(0, len(alone), 1000):
            part = alone[a:a + 1000]
            out.update((w, x.tobytes()) for (w, _), x in zip(part, self._coded([t for _, t in part])))
        return out


class WordTokens:
    """Words to ids as little-endian bytes; two bytes an id, for vocabularies below 65,536."""

    dtype = "<u2"

    def __init__(self, path: str):
        self.library = Library(path, self.dtype)
        if self.library.size > 1 << 16:
            raise ValueError("the vocabulary needs more than two bytes an id")
        self.known: dict[bytes, bytes] = {}

    @classmethod
    def of(cls, path: str) -> "WordTokens":
        """One per Python worker and path."""
        return kept(("word-tokens", path), lambda: cls(path), large=True)

    def encode(self, raw: bytes) -> bytes:
        return self.encode_all([raw])[0]

    def encode_all(self, texts: Sequence[bytes]) -> list[bytes]:
        """The ids of each text. The new words of all are learned at once, as every call of the library has its price."""
        split = [(t if b"<|" in t else t.lower()).split() for t in texts]  # special tokens are matched as written
        self._learn(set().union(*split))
        return [b"".join(map(self.known.__getitem__, words)) for words in split]

    def _learn(self, words: set[bytes]) -> None:
        known = self.known
        new = words.difference(known)
        if len(known) + 2 * len(new) > KEEP:
            known.clear()
            new = words
        stems = {w: cut(w) for w in new}
        parts = set(stems.values())
        parts.update(w[len(s):] for w, s in stems.items() if len(s) < len(w))
        known.update(self.library.ids([p for p in parts if p not in known]))
        known.update((w, known[s] + known[w[len(s):]]) for w, s in stems.items() if len(s) < len(w))
