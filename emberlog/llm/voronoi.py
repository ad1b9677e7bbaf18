"""Exact largest integer inner products by a Voronoi kNN join.

An added component that brings all data vectors to one length turns the largest inner product into the least distance.
Queries and data are grouped by their nearest pivot. From each group's count, radius and least distances to its pivot comes
a bound within which all queries of a group have their neighbours; a data row goes to those query groups only which that
bound can't rule out, and each cell is then searched locally.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm import neighbours as N

_SAFE = 2.0**53


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as whole doubles; beyond the range of a long they count as its ends."""
    return np.clip(np.floor(scale * x), -(2.0**63), 2.0**63 - 1024)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of paired rows as longs (which wrap beyond 64 bits, as Spark's own do)."""
    total = np.zeros(len(a), np.int64)
    for d in range(a.shape[1]):
        total += a[:, d].astype(np.int64) * b[:, d].astype(np.int64)
    return total


def _spread(points: np.ndarray, n: int) -> np.ndarray:
    """Pivots far from each other: each is the point farthest from those before."""
    picked = [0]
    gap = np.linalg.norm(points - points[0], axis=1)
    while len(picked) < min(n, len(points)) and gap.max() > 0:
        picked.append(int(gap.argmax()))
        gap = np.minimum(gap, np.linalg.norm(points - points[picked[-1]], axis=1))
    return points[picked]


def largest_products(vectors: DataFrame, every: int = 50, k: int = 5, scale: int = 256, pivots: int = 12, fit_on: int = 4096) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products of each row whose id divides by ``every``; exact.

    Components become floor(``scale`` * x). Pivots come from a sample of about ``fit_on`` rows, which bounds the summaries and
    not the result. Rows with a null id or a null or not finite vector take no part; zero vectors do. Shorter vectors count as
    padded with zeros. A repeated id counts once, at its best; rows with the query's id are no candidates. Equal scores go
    to the smaller id. Other columns are not read.
    """
    rows = N.clean(vectors, nonzero=False)
    n, dim = N.bounds(rows)
    spark = vectors.sparkSession
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = 0.0
        for batch in batches:
            x = integers(N.matrix(batch.column(0), dim), scale)
            most = max(most, float((x * x).sum(axis=1).max(initial=0.0)))
        yield pa.RecordBatch.from_pydict({"most": [most]})

    square = rows.select("v").mapInArrow(longest, "most double").agg(F.max("most")).first()[0]
    whole = square < _SAFE  # then no product or partial sum leaves the whole doubles

    def lifted(x: np.ndarray, data: bool) -> np.ndarray:
        x = integers(x, scale)
        last = np.sqrt(np.maximum(square - (x * x).sum(axis=1), 0.0)) if data else np.zeros(len(x))
        return np.hstack([x, last[:, None]])

    points = _spread(lifted(N.sample(rows, fit_on, n, dim), data=True), pivots)
    p = len(points)
    between = np.linalg.norm(points[:, None] - points[None], axis=2)
    tiny = 1e-7 * (1.0 + np.sqrt(square))

    def distances(x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (points * points).sum(axis=1)[None] - 2 * x @ points.T, 0.0))

    queries = rows.filter(N.is_query(every))

    def summary(data: bool):
        def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            radius, count, least = np.zeros(p), np.zeros(p, np.int64), [np.array([])] * p
            for batch in batches:
                far = distances(lifted(N.matrix(batch.column(0), dim), data))
                own = far.argmin(axis=1)
                for j in np.unique(own):
                    d = far[own == j, j]
                    radius[j], count[j] = max(radius[j], d.max()), count[j] + len(d)
                    least[j] = np.sort(np.concatenate([least[j], d]))[: 4 * (k + 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(p), pa.int64()), pa.array(count), pa.array(radius), pa.array([x.tolist() for x in least], pa.list_(pa.float64()))],
                names=["j", "n", "radius", "least"],
            )

        source = (rows if data else queries).select("v").mapInArrow(summarise, "j long, n long, radius double, least array<double>")
        nearest = F.slice(F.sort_array(F.flatten(F.collect_list("least"))), 1, k + 1)
        merged = source.groupBy("j").agg(F.sum("n"), F.max("radius"), nearest).collect()
        return {r[0]: r[1:] for r in merged if r[1]}

    asked, there = summary(False), summary(True)
    repeated = rows.groupBy("vec_id").count().filter("count > 1").limit(1).count() > 0
    bound = np.full(p, np.inf)
    for i, (_, radius, _) in asked.items():
        reach = sorted(between[i, j] + radius + d for j, (_, _, least) in there.items() for d in least)
        # one row may be the query's own; with repeated ids the k-th may not be the k-th different one
        if len(reach) > k and not repeated:
            bound[i] = reach[k] + tiny

    def needed(x: np.ndarray) -> np.ndarray:
        """Rows by query groups: whether the bounds leave it possible that the row is among the neighbours."""
        far = distances(x)
        own = far.argmin(axis=1)
        near = far[np.arange(len(x)), own]
        out = np.zeros((len(x), p), bool)
        for i, (_, radius, _) in asked.items():
            by_pivot = np.maximum(far[:, i] - radius, np.abs(between[i, own] - near) - radius)
            with np.errstate(divide="ignore", invalid="ignore"):
                by_plane = np.where(own == i, 0.0, (far[:, i] ** 2 - near**2) / (2 * between[i, own]))
            out[:, i] = np.maximum(by_pivot, np.nan_to_num(by_plane, nan=0.0, posinf=0.0)) <= bound[i] + tiny
        return out

    def demand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(p, np.int64)
        for batch in batches:
            total += needed(lifted(N.matrix(batch.column(0), dim), True)).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"i": np.arange(p), "n": total})

    sent = {r[0]: r[1] for r in rows.select("v").mapInArrow(demand, "i long, n long").groupBy("i").agg(F.sum("n")).collect()}
    chunks = [max(1, -(-sent.get(i, 0) // N.BLOCK)) for i in range(p)]
    parts = [max(1, -(-asked.get(i, (0,))[0] // N.QUERIES)) for i in range(p)]
    number, ddl = N.component(rows)
    kinds = pa.schema([("i", pa.int64()), ("chunk", pa.int64()), ("part", pa.int64()), ("vec_id", pa.int64()), ("v", pa.list_(number))])
    schema = f"i long, chunk long, part long, vec_id long, v array<{ddl}>"

    def cells(batch: pa.RecordBatch, out: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
        at, i, chunk, part = zip(*out, strict=True)
        picked = batch.take(pa.array(at, pa.int64()))
        columns = [pa.array(i, pa.int64()), pa.array(chunk, pa.int64()), pa.array(part, pa.int64()), picked.column(0), picked.column(1).cast(pa.list_(number))]
        return pa.RecordBatch.from_arrays(columns, schema=kinds)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            to = needed(lifted(N.matrix(batch.column(1), dim), True))
            for i in asked:
                at = np.nonzero(to[:, i])[0].tolist()
                if at:
                    yield cells(batch, [(r, i, (seen + r) % chunks[i], q) for r in at for q in range(parts[i])])
            seen += batch.num_rows

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            own = distances(lifted(N.matrix(batch.column(1), dim), False)).argmin(axis=1).tolist()
            yield cells(batch, [(r, i, c, (seen + r) % parts[i]) for r, i in enumerate(own) for c in range(chunks[i])])
            seen += batch.num_rows

    def rough(q: np.ndarray, x: np.ndarray) -> np.ndarray:
        q, x = integers(q, scale), integers(x, scale)
        return q @ x.T if whole else np.stack([_products(np.broadcast_to(r, x.shape), x) for r in q])

    def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return _products(integers(a, scale), integers(b, scale))

    found = N.search_cells(queries.mapInArrow(ask, schema), rows.mapInArrow(send, schema), ["i", "chunk", "part"], dim, k, rough, exact, 0.0 if whole else square * 1e-12, "long")
    return N.best(found, k)
