"""SentencePiece encoding with seeded merge-dropout, and decoding.

Words are merged as the model's own encoder does, best candidate first from an agenda; each candidate is skipped where a keyed
hash of the seed, the document, the word's position, the pair and its place says so. An agenda depends only on those skipped
candidates that would have been best, so words are cached with these: an occurrence starts at the cut without any, goes on to the
one without the first merge that its hashes skip, and ends where they skip none. Any cut decodes to the same text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import mix, slices

SPACE = "▁"
_UNITS = re.compile(f"{SPACE}+[^{SPACE}]*")
#: Stands for the model's space sign where a text holds it; no word of a text is empty.
_SIGN = ""
_NONE, _LONG = np.int64(1 << 40), 64
#: Most skipped merges of a cut that is cached.
DEEP = 1


class PieceCoder:
    """Ids of words for one model file, seed and share of skipped merges; ``variants`` limits the cuts of a word, 0: not at all."""

    def __init__(self, path: str, dropout: float, seed: int, variants: int = 0, most: int = 500_000) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(n)]
        self.ids = {sp.id_to_piece(i): i for i in range(n) if not special[i]}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.raw = [b"" if special[i] else sp.id_to_piece(i).replace(SPACE, " ").encode() for i in range(n)]
        for b, i in enumerate(self.bytes):
            self.raw[i] = bytes([b])
        self.n, self.limit, self.seed, self.variants, self.most = n, min(int(dropout * 2**64), 2**64 - 1), seed, variants, most
        self.sign = np.array([self.bytes[b] for b in SPACE.encode()], "<u4").tobytes()
        self.known: list[dict[str, bytes]] = [{} for _ in range(variants)]
        #: Cuts without limit: ids and (word, skipped merges) by number, their merges one after another (plain and mixed) up to
        #: ``ends``, the first of each word, and those that follow.
        self.cuts: list[bytes] = []
        self.path, self.mixed, self.ends = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(1, np.int64)
        self.of: list[tuple[str, tuple[int, ...]]] = []
        self.root: dict[str, int] = {}
        self.next: dict[int, int] = {}
        # symbols: pieces by id, then characters that only occur inside pieces, then any other character
        symbols = dict(self.ids)
        for c in sorted({c for p in self.ids for c in p} - symbols.keys()):
            symbols[c] = n + len(symbols)
        self.of_char = np.full(0x110000, 1 << 20, np.int64)
        for p, i in symbols.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        ranked = sorted((p for p in self.ids if len(p) > 1), key=lambda p: -sp.get_score(self.ids[p]))
        merges = sorted(
            ((symbols[p[:k]] << 21 | symbols[p[k:]], r, self.ids[p]) for r, p in enumerate(ranked) for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols)
        )
        self.pairs, self.ranks, self.merged = (np.array(x, np.int64) for x in zip(*merges, strict=True))

    def _candidates(self, left: np.ndarray, right: np.ndarray, place: np.ndarray, row: np.ndarray, keys: np.ndarray | None, skipped: np.ndarray | None) -> np.ndarray:
        """Place in the merge table of each pair of neighbours, as rank * 2**20 + place; none where there is none or it is skipped."""
        pair = left << 21 | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        out = np.where(self.pairs[at] == pair, self.ranks[at] << 20 | at, _NONE)
        if skipped is not None and len(skipped):
            code = row << 34 | self.ranks[at] << 8 | place
            out[skipped[np.minimum(np.searchsorted(skipped, code), len(skipped) - 1)] == code] = _NONE
        if keys is not None and self.limit:
            drop = mix(keys[row] ^ mix((self.ranks[at] << 24 | place).astype(np.uint64), 12), 13) < np.uint64(self.limit)
            out[drop] = _NONE
        return out

    def units(self, words: list[str], variant: int) -> list[bytes]:
        """Ids of words in one variant."""
        import xxhash

        keys = [xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"), self.seed * 1_000_003 + variant) for w in words]
        return self._merge(words, np.array(keys, np.uint64))

    def _merge(self, words: list[str], keys: np.ndarray | None, skipped: np.ndarray | None = None, trace: list | None = None) -> list[bytes]:
        """Ids of words, all merged together: each round takes the best candidate of every word's agenda.

        Candidates are skipped by the hashes of ``keys``, or where ``skipped`` (sorted) names them; ``trace`` gets the merges.
        """
        out: list[bytes] = [b""] * len(words)
        if not words:
            return out
        sizes = np.array([len(w) for w in words])
        sym = self.of_char[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)]
        row = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        chars = None if (sym < self.n).all() else "".join(words)
        origin = np.arange(len(row))
        best = np.full(len(row), _NONE)
        joint = np.nonzero(row[:-1] == row[1:])[0]
        best[joint] = self._candidates(sym[joint], sym[joint + 1], place[joint], row[joint], keys, skipped)
        while len(row):
            first = np.nonzero(np.r_[True, row[1:] != row[:-1]])[0]
            # of equal ranks the leftmost goes first, whatever its halves
            least = np.minimum.reduceat(best >> 20, first)
            size = np.diff(np.r_[first, len(row)])
            if (least == _NONE >> 20).any():
                done = np.repeat(least == _NONE >> 20, size)
                self._emit(out, row[done], sym[done], origin[done], chars)
                row, sym, place, origin, best = (x[~done] for x in (row, sym, place, origin, best))
                continue
            hits = np.nonzero(best >> 20 == np.repeat(least, size))[0]
            at = hits[np.r_[True, row[hits[1:]] != row[hits[:-1]]]]
            if trace is not None:
                trace.append((row[at], best[at] >> 20 << 24 | place[at]))
            sym[at] = self.merged[best[at] & 0xFFFFF]
            keep = np.ones(len(row), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))  # one symbol of each earlier word is gone
            row, sym, place, origin, best = (x[keep] for x in (row, sym, place, origin, best))
            changed = np.concatenate([at - 1, at])  # where two words meet one is named twice, but makes no pair there
            changed = changed[(changed >= 0) & (changed < len(row))]
            best[at] = _NONE
            joint = changed[(changed + 1 < len(row))]
            joint = joint[row[joint] == row[joint + 1]]
            best[joint] = self._candidates(sym[joint], sym[joint + 1], place[joint], row[joint], keys, skipped)
        return out

    def _emit(self, out: list[bytes], row: np.ndarray, sym: np.ndarray, origin: np.ndarray, chars: str | None) -> None:
        first = np.nonzero(np.r_[True, row[1:] != row[:-1]])[0]
        ends = np.r_[first[1:], len(row)].tolist()
        raw = sym.astype("<u4").tobytes()
        plain = np.maximum.reduceat(sym, first) < self.n
        for r, a, b, simple in zip(row[first].tolist(), first.tolist(), ends, plain.tolist(), strict=True):
            if simple:
                out[r] = raw[4 * a : 4 * b]
            else:
                ids: list[int] = []
                for s, o in zip(sym[a:b].tolist(), origin[a:b].tolist(), strict=True):
                    ids += [s] if s < self.n else [self.bytes[x] for x in chars[o].encode("utf-8", "surrogatepass")]
                out[r] = np.array(ids, "<u4").tobytes()

    def _cut(self, asked: list[tuple[str, tuple[int, ...]]]) -> range:
        """Numbers of new cuts, of words without the merges given."""
        trace: list[tuple[np.ndarray, np.ndarray]] = []
        skipped = [r << 34 | c >> 24 << 8 | c & 0xFFFFFF for r, (_, codes) in enumerate(asked) for c in codes]
        self.cuts += self._merge([w for w, _ in asked], None, np.array(sorted(skipped), np.int64), trace)
        row, code = (np.concatenate(x) for x in zip((np.zeros(0, np.int64),) * 2, *trace, strict=True))
        order = np.argsort(row, kind="stable")
        code, ends = code[order], np.searchsorted(row[order], np.arange(1, len(asked) + 1))
        self.ends = np.r_[self.ends, ends + len(self.path)]
        self.path, self.mixed = np.r_[self.path, code], np.r_[self.mixed, mix(code.astype(np.uint64), 12)]
        self.of += asked
        return range(len(self.of) - len(asked), len(self.of))

    def _forget(self) -> None:
        """Keep the first cuts, as frequent words are met first; a cut comes after the one it follows from."""
        if len(self.of) > self.most:
            n = self.most // 2
            self.cuts, self.of, self.ends = self.cuts[:n], self.of[:n], self.ends[: n + 1]
            self.path, self.mixed = self.path[: self.ends[-1]], self.mixed[: self.ends[-1]]
            self.root, self.next = ({k: v for k, v in d.items() if v < n} for d in (self.root, self.next))

    def occurrences(self, words: list[str], keys: np.ndarray) -> list[bytes]:
        """Ids of words, each with a key of its own."""
        self._forget()
        found = [self.root.get(w, -1) for w in words]
        lacking = sorted({w for w, k in zip(words, found, strict=True) if k < 0 and w != _SIGN and len(w) <= _LONG})
        if lacking:
            self.root.update(zip(lacking, self._cut([(w, ()) for w in lacking]), strict=True))
            found = [self.root.get(w, -1) if k < 0 else k for w, k in zip(words, found, strict=True)]
        cut = np.array(found, np.int64)
        left = np.nonzero(cut >= 0)[0] if self.limit else np.zeros(0, np.int64)
        while len(left):
            left = left[self.ends[cut[left] + 1] > self.ends[cut[left]]]
            if not len(left):
                break
            start = self.ends[cut[left]]
            size = self.ends[cut[left] + 1] - start
            first = np.cumsum(size) - size
            nth = np.arange(size.sum()) - np.repeat(first, size)
            codes = self.mixed[np.repeat(start, size) + nth]
            drop = mix(np.repeat(keys[left], size) ^ codes, 13) < np.uint64(self.limit)
            nth = np.minimum.reduceat(np.where(drop, nth, _LONG), first)
            left, nth = left[nth < _LONG], nth[nth < _LONG]
            follow, which = np.unique(cut[left] << 8 | nth, return_inverse=True)
            # cuts of many skipped merges seldom recur: such an occurrence is merged by its own hashes instead
            new = [x for x in follow.tolist() if x not in self.next and len(self.of[x >> 8][1]) < DEEP]
            if new:
                asked = [(self.of[x >> 8][0], (*self.of[x >> 8][1], int(self.path[self.ends[x >> 8] + (x & 255)]))) for x in new]
                self.next.update(zip(new, self._cut(asked), strict=True))
            cut[left] = np.array([self.next.get(x, -1) for x in follow.tolist()], np.int64)[which]
            left = left[cut[left] >= 0]
        out = [self.cuts[k] if k >= 0 else self.sign for k in cut.tolist()]
        own = [i for i in np.nonzero(cut < 0)[0].tolist() if words[i] != _SIGN]
        for i, x in zip(own, self._merge([words[i] for i in own], keys[own]), strict=True):
            out[i] = x
        return out

    def encode(self, texts: list[str | None], doc_ids: list[int | None]) -> list[bytes]:
        """Ids of whole texts; null and empty texts have none. The model's space sign within a text is kept as bytes."""
        if self.variants:
            return self._encode_in_variants(texts, doc_ids)
        split = [self._words(t) if t else [] for t in texts]
        keys = [self._keys(len(w), d) for w, d in zip(split, doc_ids, strict=True)]
        ids = iter(self.occurrences([w for words in split for w in words], np.concatenate([np.zeros(0, np.uint64), *keys])))
        return [b"".join(islice(ids, len(words))) for words in split]

    def _encode_in_variants(self, texts: list[str | None], doc_ids: list[int | None]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        found: dict[int, list] = {}
        lacking: list[set[str]] = [set() for _ in range(self.variants)]
        for v, known in enumerate(self.known):
            if len(known) > self.most // self.variants:  # frequent words are met first
                self.known[v] = dict(islice(known.items(), self.most // self.variants // 2))
        for i, (text, doc_id) in enumerate(zip(texts, doc_ids, strict=True)):
            if not text:
                continue
            words = self._words(text)
            which = self._variants(len(words), doc_id)
            ids = [self.known[v].get(w) for w, v in zip(words, which, strict=True)]
            if None in ids:
                for w, v, x in zip(words, which, ids, strict=True):
                    if x is None:
                        lacking[v].add(w)
                found[i] = [words, which, ids]
            else:
                out[i] = b"".join(ids)
        new = []
        for v, words in enumerate(lacking):
            names = sorted(words - {_SIGN})
            new.append(dict(zip(names, self.units(names, v), strict=True)) | {_SIGN: self.sign})
        for i, (words, which, ids) in found.items():
            out[i] = b"".join([new[v][w] if x is None else x for w, v, x in zip(words, which, ids, strict=True)])
        for v, got in enumerate(new):
            self.known[v].update((w, x) for w, x in got.items() if len(w) <= _LONG and w != _SIGN)
        return out

    def _words(self, text: str) -> list[str]:
        if SPACE in text:
            # the sign is a word of its own, which goes to bytes
            words = []
            for k, part in enumerate(text.split(SPACE)):
                words += [_SIGN] if k else []
                lead = SPACE if k == 0 else ""
                words += re.findall(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+", lead + part.replace(" ", SPACE))
            return words
        parts = text.split(" ")
        return _UNITS.findall(SPACE + text.replace(" ", SPACE)) if "" in parts else [SPACE + w for w in parts]

    def _keys(self, n: int, doc_id: int | None) -> np.ndarray:
        """Keys of the words of a document by their position."""
        key = np.uint64((0 if doc_id is None else doc_id + 1) % 2**64)
        return mix(np.arange(n, dtype=np.uint64) ^ mix(np.array([key]), self.seed)[0], self.seed + 1)

    def _variants(self, n: int, doc_id: int | None) -> list[int]:
        return (self._keys(n, doc_id) % np.uint64(self.variants)).astype(int).tolist()

    def decode(self, ids: bytes) -> str:
        """The text of any ids made by ``encode``."""
        joined = b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return (joined[1:] if joined[:1] == b" " else joined).decode("utf-8", "surrogatepass")


_CODERS: dict[tuple, PieceCoder] = {}


def coder(*key) -> PieceCoder:
    """One coder for each setting in a Python worker."""
    if key not in _CODERS:
        _CODERS[key] = PieceCoder(*key)
    return _CODERS[key]


def encode(docs: DataFrame, model: str, dropout: float = 0.1, seed: int = 1, variants: int = 0, check: bool = False) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit) of every whole text, with ``text`` beside them.

    ``check`` adds ``decoded``, the text that the ids alone give back, in the same pass.

    ``dropout`` is the chance that a candidate merge is skipped; with 0 the ids are the model's own. Another ``seed`` cuts anew.
    Each occurrence of a word is cut by itself; ``variants`` above 0 leaves every word that many cuts.
    Null and empty texts have no ids. Repeated rows get equal ids. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(model, dropout, seed, variants)
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(texts):
                ids = code.encode(texts[a:b], doc_ids[a:b])
                out = {"doc_id": batch.column(0).slice(a, b - a), "ids": pa.array(ids, pa.binary()), "text": batch.column(1).slice(a, b - a)}
                if check:
                    out["decoded"] = pa.array([code.decode(x) for x in ids], pa.string())
                yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, ids binary, text string" + (", decoded string" if check else "")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """Adds ``decoded`` to rows with ``ids``; needs neither seed nor text. Null ids: null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(model, 0.0, 0, 1)
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            texts = [None if x is None else code.decode(x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{kinds}, decoded string")
