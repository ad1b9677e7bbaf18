"""Encoding whole texts with a public tokenizer file inside tasks.

Both tokenizer kinds used here cut a text between a word and the single space or line end around it, and between a letter
or digit and a full stop or comma that white space follows. So a text is encoded word by word and the ids of frequent words
are kept. Texts with other white space or rows of marks go to the library whole.
"""

from __future__ import annotations

import re
from itertools import islice

import numpy as np

_MARKS = re.compile(r"[.,](?=\s)(?<![^\W_][.,])")
#: Before a word that no space precedes.
_JOINED = "\x01"


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, equal to the library's for the whole text.

    ``spaced``: the tokenizer keeps the space before a word, as byte-level ones do; otherwise it drops white space.
    ``most``: words kept.
    """

    def __init__(self, path: str, spaced: bool, most: int = 700_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.spaced, self.most = Tokenizer.from_file(path), spaced, most
        self.known: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _lettered(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters, many in one call; the library's own word count parts them again."""
        out: list[bytes] = []
        prefix = " " if self.spaced else ""
        for i in range(0, len(words), 500):
            some = words[i : i + 500]
            e = self.tokenizer.encode(prefix + " ".join(some), add_special_tokens=False)
            ids, word = np.array(e.ids, "<u4"), np.array(e.word_ids)
            ends = np.searchsorted(word, np.arange(len(some)), side="right")
            if len(word) and word[-1] == len(some) - 1 and (np.diff(ends, prepend=0) > 0).all():
                raw, at = ids.tobytes(), [0, *(4 * ends).tolist()]
                out += [raw[a:b] for a, b in zip(at, at[1:])]
            else:
                out += self.whole([prefix + w for w in some])
        return out

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        lettered = [w for w in words if w.isalpha()]
        other = [w for w in words if not w.isalpha()]
        new = dict(zip(lettered, self._lettered(lettered), strict=True))
        bare = [w.removeprefix(_JOINED) if w[:1] == _JOINED or not self.spaced else f" {w}" for w in other]
        new |= zip(other, self.whole(bare), strict=True)
        self.known.update((w, i) for w, i in new.items() if len(w) <= 64)
        return new

    def _words(self, text: str) -> list[str] | None:
        """The words, or None if the text does not part so simply."""
        if _MARKS.search(text):
            return None
        if not self.spaced:
            text = text.lower() if text.isascii() else text
            return text.replace("\n", " ").replace(". ", " . ").replace(", ", " , ").split(" ")
        if _JOINED in text or " ".join(text.split()) != text.replace("\n", " "):
            return None
        text = text.replace("\n", f" {_JOINED}\n {_JOINED}").replace(". ", f" {_JOINED}. ").replace(", ", f" {_JOINED}, ")
        return f"{_JOINED}{text}".split(" ")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Null and empty texts have no ids."""
        if len(self.known) > self.most:  # frequent words are met first
            self.known = dict(islice(self.known.items(), self.most // 2))
        out: list[bytes] = [b""] * len(texts)
        whole, found, lacking = [], {}, set()
        for i, t in enumerate(texts):
            if not t:
                continue
            if (words := self._words(t)) is None:
                whole.append(i)
                continue
            ids = list(map(self.known.get, words))
            if None in ids:
                lacking.update(w for w, x in zip(words, ids) if x is None)
                found[i] = words, ids
            else:
                out[i] = b"".join(ids)
        for i, ids in zip(whole, self.whole([texts[i] for i in whole]), strict=True):
            out[i] = ids
        new = self._learn(lacking)
        for i, (words, ids) in found.items():
            out[i] = b"".join([new[w] if x is None else x for w, x in zip(words, ids)])
        return out


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, spaced: bool) -> Encoder:
    """One encoder for each file in a Python worker."""
    if (path, spaced) not in _ENCODERS:
        _ENCODERS[path, spaced] = Encoder(path, spaced)
    return _ENCODERS[path, spaced]
