"""Toxicity scores from a weighted lexicon.

Texts are folded (case, marks, compatibility forms, look-alike letters, digits written for letters, letters spelt one by one) and matched with an Aho-Corasick automaton against
whole words and word beginnings. Weights are learned from labelled documents as smoothed log ratios; of the entries that match one
word the strongest counts. Matches inside an exception phrase don't count. A logistic model turns the weighted matches, as such
and by text length, into a score.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import stage

# For each Latin letter the small letters of other scripts, phonetic letters and signs that are read as it.
_LOOK_ALIKES = {
    "a": "аαɑ@", "b": "вьƀɓβ", "c": "сϲɕ", "d": "ԁɗđ", "e": "еεєɛə", "f": "ƒ", "g": "ɡɢց", "h": "нһհ", "i": "іιıɪ", "j": "јʝ", "k": "кκ",
    "l": "ӏłʟ", "m": "мʍ", "n": "пηո", "o": "оοօøσ", "p": "рρ", "q": "ԛ", "r": "гʀɾ", "s": "ѕꜱʂ$", "t": "тτŧ", "u": "υսʋ", "v": "ѵν", "w": "ԝωѡ",
    "x": "хχ", "y": "уүγʏ", "z": "ʐƶ",
}
#: Digits written for letters; they count as letters only in words that hold a letter.
_DIGITS = {"0": "o", "1": "i", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g"}
#: Harmless phrases that hold an otherwise listed word; ``fit`` takes others.
EXCEPTIONS = ("clown fish", "trash can", "trash bin", "class clown", "sore loser", "pond scum")
_SIGNS = {ord(c): letter for letter, others in _LOOK_ALIKES.items() for c in others}
_FOLD = str.maketrans(_DIGITS)
#: Combining marks of the Latin, Greek and Cyrillic letters, and signs without width.
_MARKS = re.compile("[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f\u00ad\u200b-\u200f\u2060\ufeff]+")
#: Letters one by one with a dot, dash, star or underscore between them.
_SPELT = re.compile(r"(?<![^\W_])(?:[^\W_][.*_·-]){2,}[^\W_](?![^\W_])")
_GAPS = re.compile(r"[.*_·-]")
_WORDS = re.compile(r"\d*[^\W\d_][^\W_]*")
_SHORTEST, _LONGEST = 3, 9


def fold(text: str | None) -> str:
    """The folded words, each with a space before and after.

    Compatibility forms (full width, mathematical, ligatures), marks, look-alike letters, digits inside words and letters spelt
    one by one are read as plain letters; numbers are no words.
    """
    text = (text or "").lower()
    if not text.isascii():
        text = unicodedata.normalize("NFC", _MARKS.sub("", unicodedata.normalize("NFKD", text)).lower())
    text = _SPELT.sub(lambda m: _GAPS.sub("", m[0]), text.translate(_SIGNS))
    words = _WORDS.findall(text)
    return f" {' '.join(words)} ".translate(_FOLD) if words else " "


def _entries(word: str) -> list[str]:
    return [f" {word} ", *(f" {word[:k]}" for k in range(_SHORTEST, min(len(word), _LONGEST) + 1))]


@dataclass
class Lexicon:
    """Weighted entries, ``" stem"`` or ``" word "``, and phrases in which they don't count."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    _automaton: object = field(default=None, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "exceptions": self.exceptions, "_automaton": None}

    def matches(self, folded: str) -> dict[int, float]:
        """The strongest weight at each word that matches."""
        import ahocorasick

        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            folded_weights: dict[str, float] = {}
            for entry, weight in self.weights.items():
                plain = fold(entry) if entry.endswith(" ") else fold(entry)[:-1]
                if plain.strip():
                    folded_weights[plain] = max(weight, folded_weights.get(plain, 0.0))
            for entry, weight in folded_weights.items():
                self._automaton.add_word(entry, (len(entry), weight))
            for phrase in self.exceptions:
                if (entry := fold(phrase)) != " ":
                    self._automaton.add_word(entry, (len(entry), -1.0))
            self._automaton.make_automaton()
        if not len(self._automaton):
            return {}
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, weight) in self._automaton.iter(folded):
            at = end - size + 1
            if weight < 0:  # a phrase, from its first word up to the space after its last
                spared.append((at, end))
            elif weight > best.get(at, 0.0):
                best[at] = weight
        if not spared:
            return best
        spared.sort()
        kept, k, until = {}, 0, -1
        for at in sorted(best):
            while k < len(spared) and spared[k][0] <= at:
                until = max(until, spared[k][1])
                k += 1
            if at >= until:
                kept[at] = best[at]
        return kept

    def features(self, text: str | None) -> list[float]:
        folded = fold(text)
        best = self.matches(folded)
        words, total, most = folded.count(" ") - 1, sum(best.values()), max(best.values(), default=0.0)
        kinds = len({folded[a : folded.index(" ", a + 1)] for a in best})
        length = math.log1p(max(words, 0))
        dense = math.log1p(100 * total / (words + 5))
        return [1.0, math.log1p(total), dense, most, math.log1p(kinds), length, length * math.log1p(kinds), length * most, length * math.log1p(total)]


@dataclass
class Model:
    lexicon: Lexicon
    means: np.ndarray
    scales: np.ndarray
    weights: np.ndarray
    constant: float | None = None

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        x = np.array([self.lexicon.features(t) for t in texts]).reshape(len(texts), len(self.means))
        return 1 / (1 + np.exp(-np.clip(((x - self.means) / self.scales) @ self.weights, -40, 40)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _small(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """A few rows at a time, so that few whole texts are Python strings at once."""
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and occurrences (at most 3 a document's word) of each entry by half and label; entry "" counts all."""

    def flush(docs: Counter, seen: Counter) -> pa.RecordBatch:
        half, label, entry = zip(*docs, strict=True)
        return pa.RecordBatch.from_pydict({
            "half": pa.array(half, pa.int64()), "label": pa.array(label, pa.int64()), "entry": pa.array(entry, pa.string()),
            "docs": pa.array(docs.values(), pa.int64()), "seen": pa.array([seen[k] for k in docs], pa.int64()),
        })

    docs, seen = Counter(), Counter()
    for batch in _small(batches):
        for text, label, half in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            words, own = Counter(fold(text).split()), Counter()
            for w, n in words.items():
                for entry in _entries(w):
                    own[entry] += min(n, 3)
            own[""] = sum(words.values())
            for entry, n in own.items():
                docs[half, label, entry] += 1
                seen[half, label, entry] += n
            if len(docs) > 100_000:
                yield flush(docs, seen)
                docs, seen = Counter(), Counter()
    if docs:
        yield flush(docs, seen)


def _lexicon(rows: list[tuple[str, int, int, int, int]]) -> dict[str, float]:
    """Weights from (entry, toxic documents, clean documents, toxic and clean occurrences)."""
    total = next((r[1:] for r in rows if r[0] == ""), (0, 0, 0, 0))
    out = {}
    for entry, toxic, clean, often, rare in rows:
        if entry == "" or toxic < 4:
            continue
        by_docs = math.log((toxic + 0.5) / (total[0] + 1)) - math.log((clean + 0.5) / (total[1] + 1))
        by_words = math.log((often + 0.5) / (total[2] + 1)) - math.log((rare + 0.5) / (total[3] + 1))
        unsure = math.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
        ratio = max(by_docs, by_words)
        if ratio > 3 * unsure and ratio - 1.3 * unsure > 0.7:
            out[entry] = ratio - 1.3 * unsure
    return out


def fit(docs: DataFrame, labels: DataFrame, most: int = 20_000, exceptions: tuple[str, ...] = EXCEPTIONS) -> Model:
    """Learn from labelled rows that are not held out: about ``most`` of them, picked by a hash of the id, never over twice that.

    The lexicon counts over all those rows. The logistic part sees each half of them through a lexicon of the other half,
    so that entries don't look better than they are. Words inside one of the ``exceptions`` don't count. A null label counts as
    none; of several labels the highest holds. With rows of one label only, every score is that share. Of ``docs`` only ``doc_id`` and
    ``text`` are read, of ``labels`` only ``doc_id`` and ``toxic``; a null text has no words, a repeated row counts as often as it is there.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("long").alias("toxic"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = stage(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "labels")
    n = known.count()
    share = 1.0 if n <= most else most / n
    picked = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).limit(2 * most)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    half = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(2))
    # at most 2 * most rows of two numbers are broadcast
    rows = stage(texts.join(F.broadcast(picked), "doc_id").select("text", "toxic", half.alias("half")), "training")
    counted = rows.mapInArrow(_counts, "half long, label long, entry string, docs long, seen long")
    cells = [F.sum(F.when((F.col("label") == label) & (F.col("half") == h), F.col(c))).alias(f"{c}{label}{h}") for c in ("docs", "seen") for label in (1, 0) for h in (0, 1)]
    table = counted.groupBy("entry").agg(*cells).na.fill(0).filter("docs10 + docs11 >= 4 or entry = ''").toArrow().to_pylist()

    def of(*halves: int) -> Lexicon:
        return Lexicon(_lexicon([(r["entry"], *(sum(r[f"{c}{label}{h}"] for h in halves) for c in ("docs", "seen") for label in (1, 0))) for r in table]), exceptions)

    total = next((r for r in table if r["entry"] == ""), None)
    toxic = total["docs10"] + total["docs11"] if total else 0
    clean = total["docs00"] + total["docs01"] if total else 0
    if not toxic or not clean:
        return Model(Lexicon({}), np.zeros(9), np.ones(9), np.zeros(9), constant=float(bool(toxic)))
    other = {0: of(1), 1: of(0)}

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            found = [other[h].features(t) for t, h in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.float64()))], names=["toxic", "x"])

    seen = rows.mapInArrow(features, "toxic long, x array<double>").toArrow()
    y = seen["toxic"].to_numpy().clip(0, 1).astype(float)
    x = np.array(seen["x"].to_pylist())
    order = np.lexsort((*x.T, y))  # sums in one order, whatever order the rows came in
    x, y = x[order], y[order]
    means, scales = x.mean(axis=0), x.std(axis=0)
    means[0], scales[scales == 0] = 0.0, 1.0
    z, w = (x - means) / scales, np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        w += np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + np.eye(len(w)), z.T @ (y - p) - w)
    return Model(of(0, 1), means, scales, w)


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``row`` (all columns of ``docs``), ``score`` and ``predicted`` (1 from ``threshold`` on) of every whole text; null: empty.

    A row is sent once, and its text taken out of it, so columns of any name pass through. Time grows with the length of a text as
    it is, however long; repeated rows and texts that tie score alike; an empty table gives no rows.
    """
    at = docs.columns.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            found = model.score(pc.struct_field(batch.column(0), [at]).cast(pa.string()).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), pa.array((found >= threshold).astype(np.int32))], names=["row", "score", "predicted"])

    rows = docs.select(F.struct("*").alias("row"))
    return rows.mapInArrow(scan, f"row {rows.schema['row'].dataType.simpleString()}, score double, predicted int")
