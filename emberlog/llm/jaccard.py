"""Near-duplicate documents by Jaccard similarity of word shingles: a chosen-path join.

Every set of shingles is embedded as tokens (place, least hash at that place). A run sends each set down the paths of its
sampled tokens; sets that share a path meet in a bucket. Small buckets are compared at once, large ones are split by further
sampled tokens of the path, and runs repeat until pairs at the threshold are missed with a chance below 1e-4. What buckets
propose is then decided exactly on the whole sets. Equal sets are one node, and only links of a spanning forest leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import components, mix, slices, stage, text_key
from emberlog.llm.words import Sequences, words_of

#: Tokens of a set; sets of a bucket compared at once; levels of splitting; sets and shingles of an exact cell.
TOKENS, SMALL, DEPTH, CELL, CELL_SHINGLES = 64, 1000, 4, 1024, 4_000_000


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the ``width``-word shingles of each text; shorter texts have one shingle of all words."""
    w = words_of(texts)
    seq = Sequences(w.hashes)
    for k in range(len(texts)):
        a, b = int(w.first[k]), int(w.first[k + 1])
        at = np.arange(a, max(b - width + 1, a + (b > a)))
        yield np.unique(seq.of(at, np.minimum(at + width, b), 5))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least shingle in each of ``TOKENS`` equal ranges; an empty range takes the next one's, marked by the distance."""
    bits = 64 - (TOKENS.bit_length() - 1)
    at = np.searchsorted(shingles, np.arange(TOKENS, dtype=np.uint64) << np.uint64(bits))
    of = (shingles >> np.uint64(bits)).astype(np.int64)
    full = np.unique(of)
    own = np.searchsorted(full, np.arange(TOKENS)) % len(full)
    source = full[own]
    gap = (source - np.arange(TOKENS)) % TOKENS
    return (mix(shingles[at[source]], 6) + gap.astype(np.uint64)).astype(np.uint32)


def _nodes(width: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            for a, b in slices(texts.to_pylist(), 2_000_000):
                node, size, sig = [], [], []
                for s in shingle_sets(texts.slice(a, b - a), width):
                    with np.errstate(over="ignore"):
                        digest = int(mix(np.array([s.sum(dtype=np.uint64) + np.uint64(len(s))]), 7).view(np.int64)[0]) if len(s) else None
                    node.append(digest)
                    size.append(len(s))
                    sig.append(signature(s).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(node, pa.int64()), pa.array(size, pa.int64()), pa.array(sig, pa.binary())],
                    names=["doc_id", "th", "node", "size", "sig"],
                )

    return scan


def _sampled(path: np.ndarray, threshold: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and the places their paths sample: one each and, by a keyed hash, more, ``1 / threshold`` on average.

    All sets on one path choose alike. No path ends for want of a sample, which keeps the chance to lose a pair low.
    """
    order = np.argsort(mix(path[:, None] ^ mix(np.arange(TOKENS, dtype=np.uint64), seed)[None, :], 9), axis=1)
    whole, part = divmod(1 / threshold, 1.0)
    count = int(whole) + (mix(path, seed + 1) < np.uint64(int(part * 2**64))).astype(np.int64)
    rows = np.repeat(np.arange(len(path)), count)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
    return rows, order[rows, nth]


def _descend(threshold: float, runs: int, level: int):
    """Rows (path, node) to rows of the paths one token longer; at the root there is one path for each run."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint32).reshape(-1, TOKENS).astype(np.uint64)
            node = batch.column(1).to_numpy()
            starts = [mix(np.array([r], np.uint64), 8) for r in range(runs)] if level == 0 else [batch.column(2).to_numpy().view(np.uint64)]
            for path in starts:
                rows, place = _sampled(path, threshold, 20 + level)
                if level == 0:
                    rows, place = np.repeat(np.arange(len(node)), len(place)), np.tile(place, len(node))
                    path = np.broadcast_to(path, len(node))
                longer = mix(path[rows] ^ mix(sig[rows, place] + (place.astype(np.uint64) << np.uint64(32)), 10), 11)
                yield pa.RecordBatch.from_arrays([pa.array(longer.view(np.int64)), pa.array(node[rows])], names=["path", "node"])

    return go


def _labels(near: np.ndarray) -> np.ndarray:
    """Least member of the connected part of each row of a square matrix of links."""
    n = len(near)
    label = np.arange(n)
    while True:
        step = np.where(near, label[None, :], n).min(axis=1, initial=n)
        step = np.minimum(step, label)
        step = np.minimum(step, step[step])
        if (step == label).all():
            return label
        label = step


def _propose(threshold: float):
    """Links between sets of one bucket whose tokens agree often enough; sets of few shingles get more allowance."""

    def propose(table: pa.Table) -> pa.Table:
        node = table["node"].to_numpy()
        node, at = np.unique(node, return_index=True)
        sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint32).reshape(-1, TOKENS)[at]
        size = table["size"].to_numpy()[at]
        least = np.maximum(threshold - 4 * np.sqrt(threshold * (1 - threshold) / np.minimum(size, TOKENS)), 0.02) * TOKENS
        agree = np.zeros((len(node), len(node)), np.int16)
        for p in range(TOKENS):
            agree += sig[:, p][:, None] == sig[:, p][None, :]
        near = agree >= np.maximum(least[:, None], least[None, :])
        # sizes too different for the threshold
        near &= np.minimum(size[:, None], size[None, :]) >= threshold * np.maximum(size[:, None], size[None, :]) - 1e-9
        label = node[_labels(near)]
        far = label != node
        return pa.table([pa.array(node[far], pa.int64()), pa.array(label[far], pa.int64())], names=["a", "b"])

    return propose


def _fetch(width: int):
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            for a, b in slices(texts.to_pylist(), 2_000_000):
                sets = [s.tobytes() for s in shingle_sets(texts.slice(a, b - a), width)]
                rest = [batch.column(i).slice(a, b - a) for i in range(1, batch.num_columns)]
                yield pa.RecordBatch.from_arrays([pa.array(sets, pa.binary()), *rest], names=["shingles", *batch.schema.names[1:]])

    return fetch


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Common shingles of all pairs of sets: bit rows over the shingles that occur twice, some at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, name, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    twice = np.cumsum(count > 1) - 1
    keep = (count > 1)[name]
    owner, name = owner[keep], twice[name[keep]]
    order = np.argsort(name, kind="stable")
    owner, name = owner[order], name[order]
    total = np.zeros((len(sets), len(sets)), np.int64)
    step = 1 << 14
    for start in range(0, int(name[-1]) + 1 if len(name) else 0, step):
        lo, hi = np.searchsorted(name, [start, start + step])
        width = min(step, int(name[hi - 1]) - start + 1)
        bits = np.zeros((len(sets), -(-width // 64) * 64), bool)
        bits[owner[lo:hi], name[lo:hi] - start] = True
        packed = np.packbits(bits, axis=1).view(np.uint64)
        for i in range(len(sets)):
            total[i] += np.bitwise_count(packed[i] & packed).sum(axis=1, dtype=np.int64)
    return total


def _decide(threshold: float):
    """Exact links of one shard of cells: rows (node, label, links); a label joins the nodes of a connected part."""

    def decide(table: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        cell = np.array([table["root"].to_numpy(), table["left"].to_numpy(), table["right"].to_numpy()])
        order = np.lexsort(cell)
        cell = cell[:, order]
        cuts = np.nonzero(np.r_[True, (cell[:, 1:] != cell[:, :-1]).any(axis=0), True])[0]
        node, block, weight = (table[c].to_numpy()[order] for c in ("node", "block", "c"))
        raw = table["shingles"].combine_chunks() if table["shingles"].num_chunks != 1 else table["shingles"].chunk(0)
        for a, b in zip(cuts, cuts[1:]):
            left, right = cell[1, a], cell[2, a]
            names, first = np.unique(node[a:b], return_index=True)
            sets = [np.frombuffer(raw[int(order[a + k])].as_buffer(), np.uint64) for k in first]
            size = np.array([len(s) for s in sets])
            common = _overlaps(sets)
            # the link test as integers where possible: common / union >= threshold
            near = common >= threshold * (size[:, None] + size[None, :] - common) - 1e-9
            np.fill_diagonal(near, False)
            part, c = block[a:b][first], weight[a:b][first]
            if left != right:
                near &= part[:, None] != part[None, :]
            out.append((names, names[_labels(near)], near @ c))
        columns = [np.concatenate(x) if out else np.zeros(0, np.int64) for x in zip(*out, strict=True)]
        return pa.table([pa.array(x.astype(np.int64)) for x in columns], names=["node", "label", "links"])

    return decide


def near_duplicates(docs: DataFrame, width: int = 5, threshold: float = 0.8, runs: int = 8) -> DataFrame:
    """``doc_id, th, class_id, n_links`` for every row of ``docs`` (``th``: ``text_key()``).

    Two documents are linked if their sets of ``width``-word shingles have a Jaccard similarity of ``threshold`` or more;
    words are parted by white space and unchanged. ``n_links`` counts all other linked rows, copies too. A class is a
    connected part, named by its least ``doc_id``. Texts of fewer than ``width`` words are one shingle; null and empty texts are
    linked to none. A null id counts as a document and names no class.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select("doc_id", text_key().alias("th"), "text")
    scanned = stage(rows.mapInArrow(_nodes(width), "doc_id long, th long, node long, size long, sig binary"), "sets")
    nodes = scanned.filter("node is not null").groupBy("node").agg(
        F.count(F.lit(1)).alias("c"), F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "th")).alias("at"), F.first("size").alias("size"), F.first("sig").alias("sig")
    )
    nodes = stage(nodes.select("node", "c", "least", "at.doc_id", "at.th", "size", "sig"), "nodes")

    proposals: DataFrame | None = None
    paths = nodes.select("sig", "node").mapInArrow(_descend(threshold, runs, 0), "path long, node long")
    for level in range(DEPTH + 1):
        paths = stage(paths, "paths")
        met = stage(paths.groupBy("path").count().filter("count > 1"), "met")
        crowd = paths.join(met, "path").select("path", "node", F.ceil(F.col("count") / SMALL).cast("int").alias("g"))
        done = crowd if level == DEPTH else crowd.filter("g = 1")
        # a bucket that stays large is compared block by block
        block = F.pmod(F.xxhash64("node", "path"), F.col("g")).cast("int")
        done = done.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
        done = done.select("path", "node", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"))
        found = done.join(nodes.select("node", "size", "sig"), "node").groupBy("path", "left", "right").applyInArrow(_propose(threshold), "a long, b long")
        found = stage(found.distinct(), "proposals")
        proposals = found if proposals is None else proposals.union(found)
        if level == DEPTH:
            break
        large = stage(crowd.filter("g > 1").select("path", "node"), "large")
        if large.isEmpty():
            break
        paths = large.join(nodes.select("node", "sig"), "node").select("sig", "node", "path").mapInArrow(_descend(threshold, runs, level + 1), "path long, node long")

    coarse = components(proposals)
    members = coarse.join(nodes.select("node", "c", "doc_id", "th", "size"), "node")
    members = stage(members, "coarse")
    groups = members.groupBy("root").agg(F.count(F.lit(1)).alias("k"), F.sum("size").alias("s"))
    groups = stage(groups.select("root", F.greatest(F.ceil(F.col("k") / CELL), F.ceil(F.col("s") / CELL_SHINGLES)).cast("int").alias("g")), "groups")
    asked = members.join(groups, "root").select(
        "node", "c", "root", "g", F.col("doc_id").alias("_d"), F.col("th").alias("_t"), "size", F.pmod(F.xxhash64("node"), F.col("g")).cast("int").alias("block")
    )
    asked = stage(asked, "asked")
    volume = asked.agg(F.coalesce(F.sum(F.col("size") * F.col("g")), F.lit(0))).first()[0]
    # by shuffle at every size: what is asked for grows with the corpus
    texts = rows.join(asked.hint("merge"), rows["doc_id"].eqNullSafe(F.col("_d")) & (rows["th"] == F.col("_t")))
    texts = texts.select("text", "node", "c", "root", "block", F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("other"))
    texts = texts.select("text", "node", "c", "root", "block", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"))
    kind = "shingles binary, node long, c long, root long, block int, left int, right int"
    shards = max(1, -(-volume // (CELL_SHINGLES // 16)))
    cells = texts.mapInArrow(_fetch(width), kind).groupBy(F.pmod(F.xxhash64("root", "left", "right"), F.lit(shards)).alias("shard"))
    decided = stage(cells.applyInArrow(_decide(threshold), "node long, label long, links long"), "decided")
    links = decided.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(decided.filter("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b")))

    named = nodes.join(roots, "node", "left").select("node", "c", "least", F.coalesce("root", "node").alias("root"))
    named = named.join(links, "node", "left").select("node", "root", (F.coalesce("links", F.lit(0)) + F.col("c") - 1).alias("n_links"), "least")
    named = stage(named, "named")
    names = stage(named.groupBy("root").agg(F.min("least").alias("class_id")), "names")
    named = stage(named.join(names, "root").select("node", "class_id", "n_links"), "classes")
    out = scanned.select("doc_id", "th", "node").join(named, "node", "left")
    return out.select("doc_id", "th", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def one_of_each(docs: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` with one document of each class: that of the least id (null ids are kept apart), once if it repeats."""
    found = near_duplicates(docs, width, threshold).filter("doc_id is null or doc_id = class_id")
    found = found.groupBy("doc_id").agg(F.min("th").alias("th")).filter("doc_id is not null").union(found.filter("doc_id is null").select("doc_id", "th").distinct())
    found = stage(found.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t")), "kept")
    rows = docs.select(F.struct("*").alias("row")).select("row", F.col("row.doc_id").cast("long").alias("_id"), F.col("row.text").cast("string").alias("text")).withColumn("_th", text_key())
    kept = rows.join(found.hint("merge"), F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_th") == F.col("_t")), "left_semi")
    return kept.dropDuplicates(["_id", "_th"]).select("row.*")
