"""Approximate nearest neighbours by cosine: a forest of random-projection trees.

The trees are fitted on a bounded sample and index every row. A query walks all trees through one priority queue: the branch
whose worst margin so far is least comes next, whichever tree it belongs to, until ``visits`` leaves are open. Rows of the
open leaves are then scored exactly.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm import neighbours as N


@dataclass
class Tree:
    normals: np.ndarray
    cuts: np.ndarray
    below: np.ndarray  # child below the cut, -1 in a leaf
    above: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        while len(inner := np.nonzero(self.below[node] >= 0)[0]):
            at = node[inner]
            side = np.einsum("ij,ij->i", x[inner], self.normals[at]) > self.cuts[at]
            node[inner] = np.where(side, self.above[at], self.below[at])
        return node


def fit_tree(points: np.ndarray, leaf: int, seed: int) -> Tree:
    """Each node is cut at the median of the projections on a direction between two parts of its points."""
    rng = np.random.default_rng(seed)
    normals, cuts, below, above = [np.zeros(points.shape[1])], [0.0], [-1], [-1]
    todo = [(0, np.arange(len(points)))]
    while todo:
        node, rows = todo.pop()
        if len(rows) <= leaf:
            continue
        here = points[rows]
        a, b = here[rng.choice(len(here), 2, replace=False)]
        for _ in range(3):
            near_a = here @ (a - b) > (a @ a - b @ b) / 2
            if 0 < near_a.sum() < len(here):
                a, b = here[near_a].mean(axis=0), here[~near_a].mean(axis=0)
        length = np.linalg.norm(a - b)
        if not length > 1e-12:
            continue
        normal = (a - b) / length
        shadow = here @ normal
        cut = float(np.median(shadow))
        side = shadow > cut
        if not 0 < side.sum() < len(rows):
            continue
        normals[node], cuts[node] = normal, cut
        for children, part in ((below, rows[~side]), (above, rows[side])):
            children[node] = len(cuts)
            normals.append(np.zeros(points.shape[1]))
            cuts.append(0.0)
            below.append(-1)
            above.append(-1)
            todo.append((children[node], part))
    return Tree(np.array(normals), np.array(cuts), np.array(below), np.array(above))


def open_leaves(trees: list[Tree], x: np.ndarray, visits: int) -> list[list[tuple[int, int]]]:
    """The (tree, leaf) pairs that each row of ``x`` opens, nearest first."""
    margins = [x @ t.normals.T - t.cuts for t in trees]
    out = []
    for row in range(len(x)):
        queue, found = [(-np.inf, t, 0) for t in range(len(trees))], []
        while queue and len(found) < visits:
            worst, t, node = heapq.heappop(queue)
            if trees[t].below[node] < 0:
                found.append((t, node))
                continue
            m = margins[t][row, node]
            heapq.heappush(queue, (max(worst, -m), t, int(trees[t].above[node])))
            heapq.heappush(queue, (max(worst, m), t, int(trees[t].below[node])))
        out.append(found)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of paired rows in double precision, scaled first so that no square leaves the range of a double."""
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        plain = N.sequential(a, b) / (np.sqrt(N.sequential(a, a)) * np.sqrt(N.sequential(b, b)))
    if not np.isfinite(plain).all():
        a, b = a / np.abs(a).max(axis=1, keepdims=True), b / np.abs(b).max(axis=1, keepdims=True)
        scaled = N.sequential(a, b) / (np.sqrt(N.sequential(a, a)) * np.sqrt(N.sequential(b, b)))
        plain = np.where(np.isfinite(plain), plain, scaled)
    return plain


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, trees: int = 6, leaf: int = 256, visits: int = 140, fit_on: int = 20_000, seed: int = 1) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each row whose id divides by ``every``.

    Trees are fitted on about ``fit_on`` vectors with ``leaf`` of them to a leaf; ``visits`` leaves are opened per query
    over all trees. Rows with a null id or a null, zero or not finite vector take no part; shorter vectors count as padded
    with zeros. A repeated id counts once, at its best; rows with the query's id are no candidates. Equal scores go to the smaller id.
    Other columns are not read. Leaves above ``BLOCK`` rows are split into cells, all of which are searched.
    """
    rows = N.clean(vectors, nonzero=True)
    n, dim = N.bounds(rows)
    spark = vectors.sparkSession
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    points = _unit(N.sample(rows, fit_on, n, dim))
    forest = [fit_tree(points, leaf, seed * 1000 + t) for t in range(trees)]
    first = np.cumsum([0, *(len(t.cuts) for t in forest)])  # node numbers over all trees

    def leaf_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(first[-1], np.int64)
        for batch in batches:
            x = _unit(N.matrix(batch.column(0), dim))
            for t, tree in enumerate(forest):
                total[first[t] : first[t + 1]] += np.bincount(tree.leaves(x), minlength=len(tree.cuts))
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_pydict({"node": at, "n": total[at]})

    sizes = {r[0]: r[1] for r in rows.select("v").mapInArrow(leaf_counts, "node long, n long").groupBy("node").agg(F.sum("n")).collect()}
    chunks = {node: -(-c // N.BLOCK) for node, c in sizes.items()}
    queries = rows.filter(N.is_query(every))
    # queries beside one leaf stay bounded too: the data of a leaf is repeated for each part of the queries
    parts = max(1, -(-queries.count() // N.QUERIES))
    number, ddl = N.component(rows)
    kinds = pa.schema([("node", pa.int64()), ("chunk", pa.int64()), ("part", pa.int64()), ("vec_id", pa.int64()), ("v", pa.list_(number))])
    schema = f"node long, chunk long, part long, vec_id long, v array<{ddl}>"

    def cells(batch: pa.RecordBatch, rows_: list[int], node: list[int], chunk: list[int], part: list[int]) -> pa.RecordBatch:
        picked = batch.take(pa.array(rows_, pa.int64()))
        columns = [pa.array(node, pa.int64()), pa.array(chunk, pa.int64()), pa.array(part, pa.int64()), picked.column(0), picked.column(1).cast(pa.list_(number))]
        return pa.RecordBatch.from_arrays(columns, schema=kinds)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            x = _unit(N.matrix(batch.column(1), dim))
            for t, tree in enumerate(forest):
                nodes = (tree.leaves(x) + first[t]).tolist()
                out = [(i, m, (seen + i) % chunks.get(m, 1), p) for i, m in enumerate(nodes) for p in range(parts)]
                yield cells(batch, *map(list, zip(*out, strict=True)))
            seen += batch.num_rows

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                some = batch.slice(a, 256)
                out = []
                for i, found in enumerate(open_leaves(forest, _unit(N.matrix(some.column(1), dim)), visits)):
                    for t, node in found:
                        m = int(first[t]) + node
                        out += [(i, m, c, (seen + i) % parts) for c in range(chunks.get(m, 0))]
                if out:
                    yield cells(some, *map(list, zip(*out, strict=True)))
                seen += some.num_rows

    def rough(q: np.ndarray, x: np.ndarray) -> np.ndarray:
        return _unit(q) @ _unit(x).T

    keys = ["node", "chunk", "part"]
    found = N.search_cells(queries.mapInArrow(probe, schema), rows.mapInArrow(index, schema), keys, dim, k, rough, _cosine, 1e-9, "double")
    return N.best(found, k)
