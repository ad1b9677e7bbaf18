"""Parts shared by the nearest-neighbour searches: clean vectors, local search over bounded cells, the final merge."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of one cell: data rows in a block, queries beside it.
BLOCK, QUERIES = 4096, 16384


def clean(vectors: DataFrame, nonzero: bool) -> DataFrame:
    """``vec_id, v`` of rows that take part: id and vector not null, every component finite, not zero where ``nonzero``."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v).filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
    rows = rows.filter(finite)
    if nonzero:
        rows = rows.filter(F.exists(v, lambda x: x != 0))
    return rows.withColumnRenamed("embedding", "v").dropDuplicates(["vec_id", "v"])


def component(rows: DataFrame) -> tuple[pa.DataType, str]:
    """The type of a vector's components, in Arrow and in a schema: kept as it is while rows move."""
    return (pa.float32(), "float") if isinstance(rows.schema["v"].dataType.elementType, T.FloatType) else (pa.float64(), "double")


def is_query(every: int) -> Column:
    return F.pmod(F.col("vec_id"), F.lit(every)) == 0


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Doubles in ``dim`` columns; shorter vectors are padded with zeros, which changes no product."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    ends, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(ends)
    if (sizes == dim).all():
        return flat[ends[0] : ends[-1]].reshape(-1, dim)
    out = np.zeros((len(column), dim))
    for i, (a, n) in enumerate(zip(ends, sizes, strict=False)):
        out[i, :n] = flat[a : a + n]
    return out


def bounds(rows: DataFrame) -> tuple[int, int]:
    """Number of rows, most components of a vector; 0 where there are none."""
    n, dim = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    return n, dim


Score = Callable[[np.ndarray, np.ndarray], np.ndarray]


def search_cells(queries: DataFrame, data: DataFrame, keys: list[str], dim: int, k: int, rough: Score, exact: Score, slack: float, kind: str) -> DataFrame:
    """Best ``k`` of each query within each cell: ``query_id, vec_id, score``.

    Both sides hold ``keys``, ``vec_id`` and ``v``; a cell has at most about ``BLOCK`` data rows and ``QUERIES`` queries.
    ``rough`` scores all pairs at once; what lies within ``slack`` of the k-th best is scored by ``exact`` pair by pair.
    """

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        parts: list[tuple[np.ndarray, ...]] = []
        if left.num_rows and right.num_rows:
            q_ids, ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
            q, x = matrix(left["v"], dim), matrix(right["v"], dim)
            for a in range(0, len(q), 512):
                some, names = q[a : a + 512], q_ids[a : a + 512]
                near = rough(some, x).astype(np.float64)
                near[names[:, None] == ids[None, :]] = -np.inf
                # an id with several vectors may fill several places; the merge needs k different ids
                wanted = min(k, len(ids)) if len(np.unique(ids)) == len(ids) else len(ids)
                least = np.partition(near, -wanted, axis=1)[:, -wanted]
                i, j = np.nonzero((near >= (least - slack)[:, None]) & (near > -np.inf))
                score = exact(some[i], x[j])
                order = np.lexsort((ids[j], -score, i))
                i, j, score = i[order], j[order], score[order]
                best = np.arange(len(i)) - np.searchsorted(i, i) < wanted
                parts.append((names[i[best]], ids[j[best]], score[best]))
        joined = [np.concatenate([p[c] for p in parts]) if parts else np.array([]) for c in range(3)]
        number = pa.int64() if kind == "long" else pa.float64()
        return pa.table({"query_id": pa.array(joined[0], pa.int64()), "vec_id": pa.array(joined[1], pa.int64()), "score": pa.array(joined[2].astype(np.int64 if kind == "long" else float), number)})

    columns = [*keys, "vec_id", "v"]
    pairs = queries.select(*columns).groupBy(*keys).cogroup(data.select(*columns).groupBy(*keys))
    return pairs.applyInArrow(search, f"query_id long, vec_id long, score {'long' if kind == 'long' else 'double'}")


def best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query over all cells: ``query_id, rank, vec_id, score``; ties to the smaller id."""
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranks = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranks.select("query_id", "rank", "vec_id", "score")


def sample(rows: DataFrame, most: int, n: int, dim: int) -> np.ndarray:
    """About ``most`` vectors picked by a hash of id and vector, never above twice as many."""
    share = 1.0 if n <= most else most / n
    picked = rows.filter(F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).select("v").limit(2 * most)
    return matrix(picked.toArrow()["v"], dim)


def sequential(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed component by component, so that equal vectors score equally everywhere."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total
