"""Removal of word passages that occur more than once, found with a compressed full-text index per shard.

Every window of ``window`` words belongs to the least of its short word groups (its anchor), so equal windows share an
anchor wherever they stand, and neighbouring windows with one anchor form a stretch. Anchors of one stretch, once in it, are done with.
Equal stretches are counted first; they repeat as a whole. The different stretches of one anchor go to one shard, whose index
answers by backward search which windows occur twice. Anchors with more text than a shard holds are settled window by
window, by counting, so that no shard grows with a frequent passage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import slices, stage, text_key
from emberlog.llm.fmindex import repeated_spans
from emberlog.llm.words import Sequences, least, words_of

#: Words of an anchor; words of a shard; words of one anchor from which windows are counted instead.
ANCHOR, SHARD, HOT = 6, 400_000, 100_000


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _stretches(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            for a, b in slices(texts.to_pylist(), 2_000_000):
                w = words_of(texts.slice(a, b - a))
                n = len(w.hashes)
                if n < window:
                    continue
                seq = Sequences(w.hashes)
                at = np.arange(n - ANCHOR + 1)
                groups = seq.of(at, at + ANCHOR, 1)
                anchors = least(groups, window - ANCHOR + 1)
                doc = np.searchsorted(w.first, np.arange(n - window + 1), side="right") - 1
                ok = np.nonzero(np.arange(n - window + 1) + window <= w.first[doc + 1])[0]
                if not len(ok):
                    continue
                doc, anchors = doc[ok], anchors[ok]
                fresh = np.nonzero(np.r_[True, (np.diff(ok) != 1) | (doc[1:] != doc[:-1]) | (anchors[1:] != anchors[:-1])])[0]
                count = np.diff(np.r_[fresh, len(ok)])
                start, doc, anchors = ok[fresh], doc[fresh], anchors[fresh]
                # a stretch that holds its anchor twice may hold a window twice
                inside = count + window - ANCHOR
                ends = np.cumsum(inside)
                place = np.arange(ends[-1]) + np.repeat(start - ends + inside, inside)
                again = np.add.reduceat(groups[place] == np.repeat(anchors, inside), ends - inside, dtype=np.int64) > 1
                rows = pa.array(doc + a)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows), batch.column(1).take(rows), pa.array((start - w.first[doc]).astype(np.int64)),
                        pa.array(count.astype(np.int64)), _signed(anchors), _signed(seq.of(start, start + count + window - 1, 2)), pa.array(again),
                    ],
                    names=["doc_id", "th", "first", "n", "anchor", "seg", "again"],
                )

    return cut


def _contents(window: int):
    """Of each asked stretch: the word hashes, or if its anchor is hot the hashes of its windows."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, asked = batch.column(0), batch.column(1)
            for a, b in slices(texts.to_pylist(), 2_000_000):
                w = words_of(texts.slice(a, b - a))
                seq = Sequences(w.hashes)
                rows = []
                for k, wanted in enumerate(asked.slice(a, b - a).to_pylist()):
                    base = int(w.first[k])
                    for s in wanted:
                        start, n = base + s["first"], s["n"]
                        if s["hot"]:
                            at = np.arange(start, start + n)
                            data = np.stack([seq.of(at, at + window, 3), seq.of(at, at + window, 4)], axis=1)
                        else:
                            data = w.hashes[start : start + n + window - 1]
                        rows.append((s["anchor"], s["seg"], n, s["c"], s["hot"], data.tobytes()))
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["anchor", "seg", "n", "c", "hot", "data"]
                    )

    return fetch


def _search(window: int):
    def search(table: pa.Table) -> pa.Table:
        rows = {(a, s, n): (c, d) for a, s, n, c, d in zip(*(table[x].to_pylist() for x in ("anchor", "seg", "n", "c", "data")), strict=True)}
        texts = [np.frombuffer(d, np.uint64) for _, d in rows.values()]
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        spans = repeated_spans(np.concatenate(texts), first, np.array([c for c, _ in rows.values()]), window)
        keys = list(zip(*rows, strict=True))
        found = [[{"a": x, "b": y} for x, y in s] for s in spans]
        kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        return pa.table([pa.array(keys[0]), pa.array(keys[1]), pa.array(keys[2]), pa.array(found, kind)], names=["anchor", "seg", "n", "spans"])

    return search


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        anchor, seg, n, c, data = (batch.column(i).to_pylist() for i in range(5))
        for k in range(batch.num_rows):
            pairs = np.frombuffer(data[k], np.int64).reshape(-1, 2)
            m = len(pairs)
            yield pa.RecordBatch.from_arrays(
                [pa.array([v] * m, pa.int64()) for v in (anchor[k], seg[k], n[k], c[k])] + [pa.array(np.arange(m)), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])],
                names=["anchor", "seg", "n", "c", "at", "w1", "w2"],
            )


def repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """Rows ``doc_id, th, spans``: the word spans (from ``a`` to before ``b``) covered by windows that also start elsewhere.

    ``th`` is ``text_key()``; documents without such windows have no row. Repeated rows count as documents of their own.
    Sequences are compared by 64-bit hashes of words, inside whose shard words are kept in full order.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select("doc_id", text_key().alias("th"), "text")
    runs = stage(rows.mapInArrow(_stretches(window), "doc_id long, th long, first long, n long, anchor long, seg long, again boolean"), "stretches")
    common = stage(runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("c"), F.max("again").alias("again")).filter("c > 1 or again").select("anchor"), "anchors")
    shared = stage(runs.join(common, "anchor"), "shared")
    parts = shared.groupBy("anchor", "seg", "n").agg(F.count(F.lit(1)).alias("c"), F.max("again").alias("again"), F.min(F.struct("doc_id", "th", "first")).alias("at"))
    parts = stage(parts.select("anchor", "seg", "n", "c", "again", "at.doc_id", "at.th", "at.first"), "parts")
    sizes = parts.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.sum(F.col("n") + window - 1).alias("size"), F.max("again").alias("again"))
    sizes = stage(sizes.filter("kinds > 1 or again").select("anchor", (F.col("size") > HOT).alias("hot"), "size"), "open")
    words = sizes.filter("not hot").agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    asked = parts.join(sizes.drop("size"), "anchor").groupBy("doc_id", "th").agg(F.collect_list(F.struct("first", "n", "anchor", "seg", "c", "hot")).alias("asked"))
    asked = asked.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), "asked")
    texts = rows.join(asked.hint("merge"), rows["doc_id"].eqNullSafe(F.col("_d")) & (rows["th"] == F.col("_t"))).select("text", "asked")
    contents = stage(texts.mapInArrow(_contents(window), "anchor long, seg long, n long, c long, hot boolean, data binary"), "contents")

    shards = max(1, -(-words // SHARD))
    cold = contents.filter("not hot").groupBy(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"))
    cold = cold.applyInArrow(_search(window), "anchor long, seg long, n long, spans array<struct<a:long,b:long>>")
    windows = contents.filter("hot").dropDuplicates(["anchor", "seg", "n"]).select("anchor", "seg", "n", "c", "data")
    windows = windows.mapInArrow(_unpack, "anchor long, seg long, n long, c long, at long, w1 long, w2 long")
    windows = stage(windows, "windows")
    often = stage(windows.groupBy("w1", "w2").agg(F.sum("c").alias("c")).filter("c > 1").select("w1", "w2"), "often")
    hot = windows.join(often, ["w1", "w2"]).groupBy("anchor", "seg", "n").agg(
        F.collect_list(F.struct(F.col("at").alias("a"), (F.col("at") + window).alias("b"))).alias("spans")
    )
    whole = F.array(F.struct(F.lit(0).cast("long").alias("a"), (F.col("n") + window - 1).alias("b")))
    equal = parts.filter("c > 1").select("anchor", "seg", "n", whole.alias("spans"))
    # a stretch that occurs twice repeats as a whole, whatever the search adds
    found = stage(equal.union(cold.filter(F.size("spans") > 0)).union(hot), "spans")
    found = stage(found.groupBy("anchor", "seg", "n").agg(F.flatten(F.collect_list("spans")).alias("spans")), "spans")
    placed = shared.join(found, ["anchor", "seg", "n"]).select("doc_id", "th", F.transform("spans", lambda s: F.struct((s["a"] + F.col("first")).alias("a"), (s["b"] + F.col("first")).alias("b"))).alias("spans"))
    return placed.groupBy("doc_id", "th").agg(F.flatten(F.collect_set("spans")).alias("spans"))


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, spans = batch.column(0), batch.column(1)
        for a, b in slices(texts.to_pylist(), 2_000_000):
            w = words_of(texts.slice(a, b - a))
            raw = w.data.tobytes()
            total, removed, kept = [], [], []
            for k, found in enumerate(spans.slice(a, b - a).to_pylist()):
                lo, hi = int(w.first[k]), int(w.first[k + 1])
                keep = np.ones(hi - lo, bool)
                for s in found or ():
                    keep[s["a"] : s["b"]] = False
                at = np.nonzero(keep)[0] + lo
                total.append(hi - lo)
                removed.append(hi - lo - len(at))
                kept.append(b" ".join([raw[x:y] for x, y in zip(w.starts[at].tolist(), w.ends[at].tolist(), strict=True)]))
            rest = [batch.column(i).slice(a, b - a) for i in range(2, batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), *rest],
                names=["n_words", "n_removed", "kept", *batch.schema.names[2:]],
            )


def without_repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """Every row of ``docs`` as a struct ``row``, with ``n_words``, ``n_removed`` and ``kept``, the kept words joined by a space.

    Words covered by a window of ``window`` words that also starts anywhere else, in the same document too, are removed; all
    windows are judged on the input. Null texts have no words; texts below ``window`` words keep all. Documents equal in id
    and text get equal results. Columns of any name pass through in ``row``.
    """
    found = stage(repeats(docs, window), "repeats").select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), "spans")
    rows = docs.select(F.struct("*").alias("row")).select(
        "row", F.col("row.doc_id").cast("long").alias("_id"), F.col("row.text").cast("string").alias("text")
    ).withColumn("_th", text_key())
    joined = rows.join(found.hint("merge"), F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_th") == F.col("_t")), "left").select("text", "spans", "row")
    kind = docs.select(F.struct("*").alias("row")).schema["row"].dataType.simpleString()
    return joined.mapInArrow(_strip, f"n_words long, n_removed long, kept string, row {kind}")
