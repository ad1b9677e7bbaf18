"""Hard negatives through lists that the anchors of a cluster share.

Anchors are clustered by direction. For a cluster the candidates are sorted once by an angular upper bound: no member scores more
than its own length times ``|x| * cos(angle(x, centre) - widest angle of a member)``. Every member walks that list from the top and
stops as soon as no later candidate can matter. First come the nearest rows of the anchor's own label (the positives), then the rows
of other labels whose score lies in a window below each positive (the negatives). Each search has two rounds: the rows at home in a
group of clusters are searched first, and the scores found there certify which other rows have to be sent to the group at all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.llm import neighbours as N
from emberlog.llm.common import mix, stage

#: Data rows of a cell, anchors beside them, candidates that a walk scores at a time.
BLOCK, ANCHORS, STRIDE = 8192, 8192, 512
#: Anchors of a cluster where there are few, and most clusters; centres are fitted on about ``FIT_ON`` anchors.
MEMBERS, CLUSTERS, FIT_ON = 16, 1024, 16_384
_TINY, _EXACT = 1e-6, 2.0**53
_LEAST, _NEVER = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def _whole(x: np.ndarray, scale: int) -> np.ndarray:
    return np.clip(np.floor(scale * x), -(2.0**63), 2.0**63 - 1024)


def _scores(a: np.ndarray, x: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products of all rows of ``a`` with all of ``x``; beyond the whole doubles in longs, component by component."""
    if exact:
        return (a @ x.T).astype(np.int64)
    out = np.zeros((len(a), len(x)), np.int64)
    for d in range(a.shape[1]):
        out += a[:, d].astype(np.int64)[:, None] * x[:, d].astype(np.int64)[None]
    return out


def _lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def _angles(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Angle of each row to each unit centre; a zero row counts as lying on all of them."""
    size = _lengths(x)
    cosine = (x @ centres.T) / np.where(size > 0, size, 1.0)[:, None]
    return np.where((size > 0)[:, None], np.arccos(np.clip(cosine, -1.0, 1.0)), 0.0)


def _own(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x @ centres.T).argmax(axis=1)


def upper_bounds(angles: np.ndarray, lengths: np.ndarray, widest: np.ndarray | float) -> np.ndarray:
    """Most that a unit vector within ``widest`` of a centre can score with vectors of these angles to it and lengths."""
    return lengths * np.cos(np.maximum(0.0, angles - widest - _TINY)) + _TINY * lengths


def fit_centres(points: np.ndarray, n: int, seed: int = 1, rounds: int = 8) -> np.ndarray:
    """Spherical k-means over unit ``points``."""
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), min(n, len(points)), replace=False)]
    for _ in range(rounds):
        own = (points @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        size = _lengths(sums)
        centres = np.where((size > 1e-12)[:, None], sums / np.where(size > 1e-12, size, 1.0)[:, None], centres)
    return centres


class Best:
    """The ``k`` best of every slot so far: larger scores first, ties to the smaller id."""

    def __init__(self, slots: int, k: int) -> None:
        self.k = k
        self.score = np.full((slots, k), _LEAST)
        self.id = np.full((slots, k), _NEVER)
        self.n = np.zeros(slots, np.int64)

    def last(self) -> np.ndarray:
        """The k-th score of each slot, the least long while there are fewer."""
        return self.score[:, -1]

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        touched = np.unique(slot)
        old_slot = np.repeat(touched, self.n[touched])
        kept = [np.arange(self.k) < self.n[t] for t in touched]
        old_score = np.concatenate([self.score[t][m] for t, m in zip(touched, kept, strict=True)])
        old_ids = np.concatenate([self.id[t][m] for t, m in zip(touched, kept, strict=True)])
        slot, score, ids = np.r_[old_slot, slot], np.r_[old_score, score], np.r_[old_ids, ids]
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        good = place < self.k
        slot, place = slot[good], place[good]
        self.score[slot, place], self.id[slot, place] = score[good], ids[good]
        self.n[touched] = np.minimum(self.k, np.bincount(np.searchsorted(touched, slot), minlength=len(touched)))

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot, place = np.nonzero(np.arange(self.k)[None] < self.n[:, None])
        return slot, self.id[slot, place], self.score[slot, place]


def walk(
    anchors: np.ndarray, angles: np.ndarray, data: np.ndarray, data_angles: np.ndarray, ids: np.ndarray, exact: bool, need: Callable[[], np.ndarray],
    take: Callable[[np.ndarray, np.ndarray, np.ndarray], None],
) -> np.ndarray:
    """Let the members of one cluster walk the list of ``data``; how many candidates each of them scored.

    ``need`` tells the least score that can still matter to each member; ``take`` gets members, columns and scores of a stride.
    """
    bounds = upper_bounds(data_angles, _lengths(data), angles.max())
    order = np.lexsort((ids, -bounds))
    sizes, walked = _lengths(anchors), np.zeros(len(anchors), np.int64)
    for a in range(0, len(order), STRIDE):
        # a bound below zero is best met by the shortest anchor, that of a zero anchor is zero
        active = np.flatnonzero(need() <= sizes * bounds[order[a]] + _TINY * sizes)
        if not len(active):
            break
        columns = order[a : a + STRIDE]
        take(active, columns, _scores(anchors[active], data[columns], exact))
        walked[active] += len(columns)
    return walked


def _clean(vectors: DataFrame, shift_every: int, labels: int) -> DataFrame:
    """``vec_id, v, label`` of the rows that take part; of rows that share an id the least one by label and vector."""
    v = F.col("embedding")
    vec_id, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    moved = F.when(F.pmod(vec_id, F.lit(shift_every)) == 0, (label + 1) % labels).otherwise(label)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(vec_id.isNotNull() & label.isNotNull() & v.isNotNull() & finite).select(vec_id.alias("vec_id"), v.alias("v"), moved.alias("label"))
    twice = rows.groupBy("vec_id").count().filter("count > 1").select("vec_id")
    if twice.isEmpty():
        return rows
    once = rows.join(twice, "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.v", "r.label")
    return rows.join(twice, "vec_id", "left_anti").unionByName(once)


class _Wanted:
    """What the anchors of one cell still look for: ``slots`` lists of ``k`` an anchor, each with a range of scores."""

    def __init__(self, k: int, low: np.ndarray, high: np.ndarray, same: bool, ids: np.ndarray, labels: np.ndarray) -> None:
        self.low, self.high, self.same, self.ids, self.labels = low, high, same, ids, labels
        self.slots = low.shape[1]
        self.best = Best(low.size, k)

    def need(self, members: np.ndarray) -> np.ndarray:
        return self._floor(members).min(axis=1, initial=_NEVER).astype(np.float64)

    def _floor(self, members: np.ndarray) -> np.ndarray:
        low, high = self.low[members], self.high[members]
        last = self.best.last().reshape(-1, self.slots)[members]
        return np.where(low <= high, np.maximum(low, last), _NEVER)

    def take(self, members: np.ndarray, ids: np.ndarray, labels: np.ndarray, scores: np.ndarray) -> None:
        fits = (labels[None] == self.labels[members][:, None]) == self.same
        fits &= ids[None] != self.ids[members][:, None]
        floor, high = self._floor(members), self.high[members]
        for j in range(self.slots):
            i, c = np.nonzero(fits & (scores >= floor[:, j, None]) & (scores <= high[:, j, None]))
            self.best.add(members[i] * self.slots + j, scores[i, c], ids[c])


@dataclass
class Lists:
    """Clusters of the anchors and the groups whose anchors share cells; sent to all tasks."""

    scale: int
    dim: int
    centres: np.ndarray
    widest: np.ndarray
    group: np.ndarray
    parts: list[int]
    exact: bool

    def vectors(self, column: pa.Array | pa.ChunkedArray) -> np.ndarray:
        return _whole(N.matrix(column, self.dim), self.scale)

    def home(self, x: np.ndarray) -> np.ndarray:
        """Rows by groups: the group of the nearest centre."""
        out = np.zeros((len(x), len(self.parts)), bool)
        out[np.arange(len(x)), self.group[_own(x, self.centres)]] = True
        return out

    def elsewhere(self, x: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Rows by groups: not at home there, but within reach of a member of one of its clusters; ``least`` by cluster, a unit of length."""
        bounds = upper_bounds(_angles(x, self.centres), _lengths(x)[:, None], self.widest[None])
        reach = bounds >= least[None] - _TINY * (1.0 + np.abs(least[None]))
        starts = np.searchsorted(self.group, np.arange(len(self.parts)))
        return np.logical_or.reduceat(reach, starts, axis=1) & ~self.home(x)


def shared_lists(rows: DataFrame, is_anchor: Column, scale: int) -> Lists | None:
    """Cluster the anchors among ``rows`` (``vec_id, v, label``); nothing where there are none."""
    n = rows.filter(is_anchor).count()
    if not n:
        return None
    dim = max(1, N.bounds(rows)[1])
    sample = _whole(N.sample(rows.filter(is_anchor), FIT_ON, n, dim), scale)
    sample = sample[_lengths(sample) > 0]
    centres = fit_centres(sample / _lengths(sample)[:, None], max(1, min(CLUSTERS, n // MEMBERS))) if len(sample) else np.eye(1, dim)
    # neighbouring clusters share a group: they are ordered along the direction in which centres differ most
    along = np.linalg.svd(centres - centres.mean(axis=0), full_matrices=False)[2][0]
    centres = centres[np.argsort(centres @ along, kind="stable")]
    k = len(centres)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, widest, most = np.zeros(k, np.int64), np.zeros(k), 0.0
        for batch in batches:
            x = _whole(N.matrix(batch.column(0), dim), scale)
            most = max(most, float((x * x).sum(axis=1).max(initial=0.0)))
            x = x[batch.column(1).to_numpy(zero_copy_only=False).astype(bool)]
            own = _own(x, centres)
            np.add.at(count, own, 1)
            np.maximum.at(widest, own, _angles(x, centres)[np.arange(len(x)), own])
        yield pa.RecordBatch.from_pydict({"c": np.arange(k), "n": count, "widest": widest, "most": np.full(k, most)})

    # one row a cluster
    found = rows.select("v", is_anchor).mapInArrow(measure, "c long, n long, widest double, most double")
    found = found.groupBy("c").agg(F.sum("n"), F.max("widest"), F.max("most")).orderBy("c").collect()
    count = np.array([r[1] for r in found])
    group, load, at = np.zeros(k, np.int64), 0, 0
    for c in range(k):
        if load and load + count[c] > ANCHORS:
            at, load = at + 1, 0
        group[c], load = at, load + count[c]
    members = np.bincount(group, weights=count)
    return Lists(scale, dim, centres, np.array([r[2] for r in found]), group, [max(1, -(-int(m) // ANCHORS)) for m in members], found[0][3] < _EXACT)


def _round(rows: DataFrame, lists: Lists, asked: DataFrame, to: Callable[[np.ndarray], np.ndarray], k: int, same: bool) -> DataFrame:
    """``anchor_id, slot, vec_id, score``: the ``k`` best of each slot among the rows that ``to`` sends to the anchors' groups."""
    groups = len(lists.parts)

    def demand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(groups, np.int64)
        for batch in batches:
            total += to(lists.vectors(batch.column(0))).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"g": np.arange(groups), "n": total})

    # one row a group
    sent = {r[0]: r[1] for r in rows.select("v").mapInArrow(demand, "g long, n long").groupBy("g").agg(F.sum("n")).collect()}
    chunks = [-(-sent.get(g, 0) // BLOCK) for g in range(groups)]
    number, ddl = N.component(rows)

    def cells(batch: pa.RecordBatch, at: np.ndarray, *cell: int | np.ndarray) -> pa.RecordBatch:
        """The rows ``at`` of a batch with the cell (group, part, chunk) of each."""
        picked = batch.take(pa.array(at))
        numbers = [pa.array(np.broadcast_to(np.asarray(c, np.int64), len(at))) for c in cell]
        v = picked.column(1).cast(pa.list_(number))
        return pa.RecordBatch.from_arrays([*numbers, picked.column(0), v, *picked.columns[2:]], names=["g", "part", "chunk", "vec_id", "v", *picked.schema.names[2:]])

    def dealt(batch: pa.RecordBatch, n: int, seed: int) -> np.ndarray:
        """A number below ``n`` for each row, from its id only, so that a task run again deals alike."""
        return (mix(batch.column(0).to_numpy().astype(np.uint64), seed) % np.uint64(n)).astype(np.int64)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = to(lists.vectors(batch.column(1)))
            for g in np.flatnonzero(wanted.any(axis=0)).tolist():
                at = np.flatnonzero(wanted[:, g])
                chunk = dealt(batch, chunks[g], 1)[at]
                for part in range(lists.parts[g]):
                    yield cells(batch, at, g, part, chunk)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = lists.group[_own(lists.vectors(batch.column(1)), lists.centres)]
            for g in np.unique(own).tolist():
                at = np.flatnonzero(own == g)
                part = dealt(batch, lists.parts[g], 2)[at]
                for chunk in range(chunks[g]):
                    yield cells(batch, at, g, part, chunk)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)] * 4
        if left.num_rows and right.num_rows:
            a, x = lists.vectors(left["v"]), lists.vectors(right["v"])
            a_ids, ids, labels = left["vec_id"].to_numpy(), right["vec_id"].to_numpy(), right["label"].to_numpy()
            low, high = (np.array(left[c].to_pylist(), np.int64).reshape(len(a), -1) for c in ("low", "high"))
            wanted = _Wanted(k, low, high, same, a_ids, left["label"].to_numpy())
            own = np.where(_lengths(a) > 0, _own(a, lists.centres), -1)
            for c in np.unique(own):
                members = np.flatnonzero(own == c)
                centre = lists.centres[max(c, 0)][None]
                angles = _angles(a[members], centre)[:, 0]
                walk(
                    a[members], angles, x, _angles(x, centre)[:, 0], ids, lists.exact, lambda m=members: wanted.need(m),
                    lambda active, columns, scores, m=members: wanted.take(m[active], ids[columns], labels[columns], scores),
                )
            slot, found, score = wanted.best.rows()
            out = [a_ids[slot // wanted.slots], slot % wanted.slots, found, score]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("anchor_id", "slot", "vec_id", "score"), out, strict=True)})

    cell = f"g long, part long, chunk long, vec_id long, v array<{ddl}>, label long"
    data = rows.select("vec_id", "v", "label").mapInArrow(send, cell)
    queries = asked.select("vec_id", "v", "label", "low", "high").mapInArrow(ask, f"{cell}, low array<long>, high array<long>")
    keys = ["g", "part", "chunk"]
    found = queries.groupBy(*keys).cogroup(data.groupBy(*keys)).applyInArrow(search, "anchor_id long, slot long, vec_id long, score long")
    return _best(found, k)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search(rows: DataFrame, lists: Lists, asked: DataFrame, k: int, same: bool) -> DataFrame:
    """Both rounds for anchors with ranges ``low`` to ``high`` by slot: ``anchor_id, slot, vec_id, score, rank``."""
    first = stage(_round(rows, lists, asked, lists.home, k, same), "near")
    if len(lists.parts) == 1:
        return first
    # the k-th score found at home certifies what lies below it
    kth = first.filter(F.col("rank") == k).groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("kth"))
    raised = F.transform("low", lambda x, j: F.greatest(x, F.coalesce(F.get(F.map_values(F.map_filter("kth", lambda s, _: s == j)), F.lit(0)), x)))
    asked = stage(asked.join(kth, F.col("vec_id") == F.col("anchor_id"), "left").select("vec_id", "v", "label", raised.alias("low"), "high"), "raised")

    def certify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = np.full(len(lists.centres), np.inf)
        for batch in batches:
            x = lists.vectors(batch.column(0))
            low, high = (np.array(batch.column(i).to_pylist(), np.int64).reshape(len(x), -1) for i in (1, 2))
            need = np.where(low <= high, low, np.inf).min(axis=1, initial=np.inf)
            size = _lengths(x)
            share = np.where(np.isinf(need), np.inf, np.where(size > 0, need / np.where(size > 0, size, 1.0), -np.inf))
            np.minimum.at(least, _own(x, lists.centres), share)
        yield pa.RecordBatch.from_pydict({"c": np.arange(len(least)), "least": least})

    # one row a cluster
    found = asked.select("v", "low", "high").mapInArrow(certify, "c long, least double").groupBy("c").agg(F.min("least")).collect()
    least = np.full(len(lists.centres), np.inf)
    for c, value in found:
        least[c] = value
    return _best(first.drop("rank").unionByName(_round(rows, lists, asked, lambda x: lists.elsewhere(x, least), k, same).drop("rank")), k)


def hard_negatives(
    vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, scale: int = 256, shift_every: int = 7, labels: int = 10
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; exact.

    Anchors are the rows whose id divides by ``every``; components become floor(``scale`` * x), scores are integer inner products, and
    the label of a row whose id divides by ``shift_every`` first becomes (label + 1) % ``labels``. For each anchor and each of its
    ``positives`` best rows of its own label the ``negatives`` best rows of other labels follow whose score is at least half and at most
    95 hundredths of the positive's; equal scores go to the smaller id. Rows with a null id or label, a null vector, or a null or not
    finite component take no part; empty and zero vectors do (they score 0), shorter vectors count as padded with zeros. Of rows that
    share an id the least by label and vector counts. Anchors without positives, and positives without negatives, give no rows; an
    empty table gives none. Other columns are not read.
    """
    rows = _clean(vectors, shift_every, labels)
    is_anchor = N.is_query(every)
    lists = shared_lists(rows, is_anchor, scale)
    if lists is None:
        return vectors.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    anchors = rows.filter(is_anchor)
    ends = [F.array(F.lit(int(x)).cast("long")).alias(n) for n, x in (("low", _LEAST), ("high", _NEVER))]
    found = stage(_search(rows, lists, anchors.select("vec_id", "v", "label", *ends), positives, same=True), "positives")

    score = F.col("score")
    cap = F.expr("score div 20 * 19 + score % 20 * 19 div 20")
    half = F.when(score % 2 == 0, F.expr("score div 2")).otherwise(F.expr("(score + 1) div 2"))
    window = F.struct("rank", F.when(score < 0, F.lit(1)).otherwise(half).alias("low"), F.when(score < 0, F.lit(0)).otherwise(cap).alias("high"))
    windows = found.groupBy("anchor_id").agg(F.array_sort(F.collect_list(window)).alias("w"))  # at most ``positives`` an anchor
    picked = [F.transform("w", lambda w: w[n].cast("long")).alias(n) for n in ("low", "high")]
    asked = stage(anchors.join(windows, F.col("vec_id") == F.col("anchor_id")).select("vec_id", "v", "label", *picked), "windows")
    below = _search(rows, lists, asked, negatives, same=False).select(
        F.col("anchor_id").alias("_anchor"), (F.col("slot") + 1).alias("_place"), F.col("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    above = found.select("anchor_id", F.col("rank").alias("_rank"), F.col("vec_id").alias("positive_id"), score.alias("positive_score"))
    joined = above.join(below, (F.col("anchor_id") == F.col("_anchor")) & (F.col("_rank") == F.col("_place")))
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
