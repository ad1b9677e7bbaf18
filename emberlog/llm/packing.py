"""Best-fit packing of documents into token sequences.

Whether a piece fits depends on its length only, so the plan is made over the counts of lengths (as many as the capacity at
most) and holds for any number of documents. Pieces above one third of the capacity go at most two to a sequence: the
longest takes the longest that still fits (greedy matching). Shorter ones, longest first, go where the least room is left.
Spark then ranks the pieces of each length and looks up the place of each rank.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import ranked, slices, stage
from emberlog.llm.tokens import encoder

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """Rows ``doc_id, piece, start, length, ids_crc32`` (and ``ids``, little-endian unsigned 32-bit) of every whole text.

    A document's ids end with ``end_id``; a null or empty text has that id only. Documents longer than ``capacity`` are cut
    into full pieces and a rest. Rows keep their ``doc_id``, null and repeated ones too; other columns are not read.
    """
    schema = PIECES + (", ids binary" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer, spaced=False), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(texts):
                rows: list[tuple] = []
                for doc_id, ids in zip(doc_ids[a:b], enc.encode(texts[a:b]), strict=True):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), part))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                names = ("doc_id", "piece", "start", "length", "ids_crc32", "ids")
                arrays = {n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(names, kinds, strict=True))}
                if not with_ids:
                    del arrays["ids"]
                yield pa.RecordBatch.from_pydict(arrays)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, schema)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(length, first_rank, pieces, first_sequence, offset)``: pieces of one length, one to each of some sequences.

    Sequences are numbered from 0 without gaps. The number of runs depends on the lengths, not on the number of pieces.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    taken = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # room left: sequences (first, how many)
    rooms: list[int] = []
    sequences = 0

    def put(length: int, n: int, first: int, offset: int) -> None:
        runs.append((length, taken[length], n, first, offset))
        taken[length] += n
        left[length] -= n

    def leave(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in gaps:
                gaps[room] = []
                bisect.insort(rooms, room)
            gaps[room].append((first, n))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        fits = bisect.bisect_right(large, capacity - a) - 1
        b = large[fits] if fits >= 0 else 0
        if b == a and left[a] == 1:
            b = large[fits - 1] if fits > 0 else 0
        n = left[a] if not b else left[a] // 2 if b == a else min(left[a], left[b])
        put(a, n, sequences, 0)
        if b:
            put(b, n, sequences, a)
        leave(capacity - a - b, sequences, n)
        sequences += n
        large = [x for x in large if left[x]]

    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = gaps[room].pop()
                if not gaps[room]:
                    del gaps[room], rooms[at]
            else:
                room, first = capacity, sequences
                n = -(-left[length] // (capacity // length))
                sequences += n
            each = min(room // length, left[length])
            full = min(n, left[length] // each)
            for k in range(each):
                put(length, full, first, capacity - room + k * length)
            leave(room - each * length, first, full)
            leave(room, first + full, n - full)
    return runs


def place(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces (``length`` from 1 to ``capacity``; see ``token_pieces``).

    Equal rows get different places. Only the counts of lengths pass through the driver. An empty table gives no rows.
    """
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    if counts and not (0 < min(counts) and max(counts) <= capacity):
        raise ValueError("a piece is empty or longer than the capacity")
    runs = pieces.sparkSession.createDataFrame(
        plan(counts, capacity), "_length bigint, _rank bigint, _n bigint, _first bigint, _offset bigint"
    )
    rows = ranked(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], "_at", sum(counts.values()))
    inside = (F.col("length") == F.col("_length")) & F.col("_at").between(F.col("_rank"), F.col("_rank") + F.col("_n") - 1)
    return rows.join(F.broadcast(runs), inside).select(
        *pieces.columns, (F.col("_first") + F.col("_at") - F.col("_rank")).alias("sequence_id"), F.col("_offset").alias("offset")
    )


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """Token pieces of ``docs`` with their sequence and place; ``with_ids`` keeps the ids themselves."""
    return place(stage(token_pieces(docs, tokenizer, end_id, capacity, with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed ids, ``sequence_id, n_tokens, ids`` (one binary each), of ``pack(..., with_ids=True)``."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"), F.sum("length").alias("n_tokens"))
    joined = F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    return parts.select("sequence_id", "n_tokens", joined.alias("ids"))
