"""Isolation Forest (Liu, Ting, Zhou 2008): small samples per tree, path lengths as anomaly evidence."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.operators.quantiles import exact_percentiles
from emberlog.schema import CONTAMINATION, MODEL_FEATURES
from emberlog.session import stage

EULER_GAMMA = 0.5772156649015329
NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, size int, depth int"


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Expected path length of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype=float)
    big = np.where(n > 2, n, 3.0)
    grown = 2.0 * (np.log(big - 1.0) + EULER_GAMMA) - 2.0 * (big - 1.0) / big
    return np.where(n > 2, grown, np.where(n == 2, 1.0, 0.0))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A uniform hash of unsigned 64-bit values (two rounds of multiplying and folding)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def _grow(points: np.ndarray, tree: int, seed: int, max_depth: int) -> pd.DataFrame:
    """One tree over at most a sample of rows, as a node table."""
    rng = np.random.default_rng([seed, tree])
    nodes: list[list] = []
    pending = [(np.arange(len(points)), 0, -1, "")]
    while pending:
        rows, depth, parent, side = pending.pop()
        number = len(nodes)
        nodes.append([tree, number, -1, 0.0, -1, -1, len(rows), depth])
        if parent >= 0:
            nodes[parent][4 if side == "left" else 5] = number
        low, high = points[rows].min(axis=0), points[rows].max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= max_depth or len(rows) <= 1 or not len(usable):
            continue
        feature = int(rng.choice(usable))
        cut = float(rng.uniform(low[feature], high[feature]))
        goes_left = points[rows, feature] <= cut
        nodes[number][2], nodes[number][3] = feature, cut
        pending.append((rows[~goes_left], depth + 1, number, "right"))
        pending.append((rows[goes_left], depth + 1, number, "left"))
    return pd.DataFrame(nodes, columns=[c.split()[0] for c in NODE_SCHEMA.split(", ")])


@dataclass(frozen=True)
class Forest:
    """Node table of all trees (bounded by trees x twice the sample), the sample size and the decision offset."""

    features: tuple[str, ...]
    nodes: pd.DataFrame
    sample_size: int
    offset: float | None = None

    def score(self, df: DataFrame, name: str = "raw_score") -> DataFrame:
        """Add the score in (0, 1], higher for shorter paths."""
        trees = self.nodes.sort_values(["tree", "node"]).reset_index(drop=True)
        starts = trees.groupby("tree")["node"].size().cumsum().shift(fill_value=0)
        base = trees["tree"].map(starts).to_numpy()
        leaf = trees["feature"].to_numpy() < 0
        own = np.arange(len(trees))
        # a leaf leads to itself; the two next nodes stand side by side, the one for values above the cut first
        turns = [np.where(leaf, own, base + trees["right"]), np.where(leaf, own, base + trees["left"])]
        arrays = {
            "roots": starts.to_numpy().astype(np.int64),
            "feature": np.where(leaf, 0, trees["feature"]).astype(np.int64),
            "cut": np.where(leaf, np.inf, trees["threshold"]),
            "next": np.column_stack(turns).astype(np.int64).ravel(),
            "length": trees["depth"].to_numpy() + average_path(trees["size"].to_numpy()),
        }
        steps = int(trees["depth"].max()) if len(trees) else 0
        norm = float(average_path(self.sample_size)) or 1.0
        count = len(self.features)
        # The node table is bounded by the model parameters, not by the data.
        shared = df.sparkSession.sparkContext.broadcast(arrays)

        @F.pandas_udf("double")
        def path_score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            a = shared.value
            for columns in batches:
                columns = (columns,) if isinstance(columns, pd.Series) else columns
                x = np.column_stack([c.to_numpy(np.float64) for c in columns])
                n, total, flat = len(x), np.zeros(len(x)), x.ravel()
                offset = np.arange(n) * count
                # all steps work in the same arrays
                at, place = np.empty(n, np.int64), np.empty(n, np.int64)
                value, cut, goes_left = np.empty(n), np.empty(n), np.empty(n, bool)
                for root in a["roots"]:
                    at.fill(root)
                    for _ in range(steps):
                        a["feature"].take(at, out=place, mode="clip")
                        place += offset
                        np.less_equal(flat.take(place, out=value, mode="clip"), a["cut"].take(at, out=cut, mode="clip"), out=goes_left)
                        at += at
                        at += goes_left
                        at, place = a["next"].take(at, out=place, mode="clip"), at
                    total += a["length"].take(at, mode="clip")
                yield pd.Series(np.power(2.0, -(total / len(a["roots"])) / norm))

        return df.withColumn(name, path_score(*[F.col(f).cast("double") for f in self.features]))

    def decide(self, df: DataFrame) -> DataFrame:
        """Add ``anomaly_score`` (above the offset is anomalous) and ``is_anomaly``."""
        if self.offset is None:
            raise ValueError("the forest has no decision offset yet")
        out = self.score(df, "__raw").withColumn("anomaly_score", F.col("__raw") - F.lit(self.offset)).drop("__raw")
        return out.withColumn("is_anomaly", F.col("anomaly_score") > 0)


def fit_forest(
    df: DataFrame,
    features: Sequence[str] = MODEL_FEATURES,
    trees: int = 100,
    sample_size: int = 256,
    seed: int = 42,
    order: Sequence[str] = ("us", "seq"),
) -> Forest:
    """Fit on all rows of ``df``: each tree sees its own sample without replacement.

    Each row gets a keyed hash for each tree, and the least hashes make the sample: one scan without ranks, from which only about
    1.5 samples a tree are shuffled. The sample depends on the rows and the seed, not on partitions or order; rows that agree in
    ``order`` and all features share their hashes. A tree grows from its 256 rows, so groups have a fixed size.
    """
    columns = list(features)
    rows = df.count()
    if rows == 0:
        raise ValueError("no rows to fit on")
    size = min(sample_size, rows)
    limit = max(1, math.ceil(math.log2(max(size, 2))))
    # A tree's sample is its rows of the ``size`` least keys. Keys are uniform, so they lie below this bound with a margin that
    # fails once in 10^9 trees; a tree that gets too few is drawn again from all rows.
    bound = min(1.0, (size + 6.5 * math.sqrt(size) + 20) / rows)

    def draw(limit_key: float, wanted: Sequence[int]) -> DataFrame:
        keep = np.array(wanted, np.uint64)

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = batch.column(0).to_numpy().astype(np.uint64)
                for a in range(0, len(keep), 16):
                    keys = _mixed(own[None] ^ _mixed(keep[a : a + 16] + np.uint64((seed + 1) << 20))[:, None])
                    t, r = np.nonzero(keys < np.uint64(min(limit_key * 2.0**64, 2.0**64 - 2048)) if limit_key < 1 else np.ones(keys.shape, bool))
                    if len(t):
                        picked = batch.take(pa.array(r))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keep[a : a + 16][t].astype(np.int64)), pa.array((keys[t, r] >> np.uint64(1)).astype(np.int64)), *picked.columns],
                            names=["tree", "key", *batch.schema.names],
                        )

        identity = F.xxhash64(*order, *features).alias("own")
        narrow = df.select(identity, *[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], *[F.col(f).cast("double").alias(f) for f in features])
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields)
        return narrow.mapInArrow(pick, f"tree long, key long, {ddl}")

    places = ["key", *[f"o{i}" for i in range(len(order))]]

    def grow(sample: pd.DataFrame) -> pd.DataFrame:
        sample = sample.sort_values([*places, *columns], kind="stable").head(size)
        grown = _grow(sample[columns].to_numpy(np.float64), int(sample["tree"].iloc[0]), seed, limit)
        return grown if len(sample) == size else grown.head(0)

    def nodes_of(limit_key: float, wanted: Sequence[int]) -> pd.DataFrame:
        # a group holds the margin's rows at most; only its ``size`` least stay
        return draw(limit_key, wanted).groupBy("tree").applyInPandas(grow, NODE_SCHEMA).toPandas()

    nodes = nodes_of(bound, range(trees))
    while short := [t for t in range(trees) if t not in set(nodes["tree"])]:
        bound = min(1.0, 4 * bound)
        nodes = pd.concat([nodes, nodes_of(bound, short)])
    return Forest(tuple(features), nodes.sort_values(["tree", "node"]).reset_index(drop=True), size)


def contamination_offset(scored: DataFrame, column: str, contamination: float = CONTAMINATION) -> float:
    """The exact score quantile above which the given share of the training rows lies."""
    # Scores are computed once; counting and ordering read the stored column.
    return exact_percentiles(stage(scored.select(column), "scores"), column, [1 - contamination]).first()["q0"]


def fit_decision(forest: Forest, train: DataFrame, contamination: float = CONTAMINATION, scores: DataFrame | None = None) -> Forest:
    """Add the offset; ``scores`` are the ``raw_score`` of the training rows where they are stored already."""
    offset = contamination_offset(forest.score(train) if scores is None else scores, "raw_score", contamination)
    return Forest(forest.features, forest.nodes, forest.sample_size, offset)
