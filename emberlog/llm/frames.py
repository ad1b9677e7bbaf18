"""Token ids in seekable zstandard files.

A file is a row of independent zstandard frames, one for each document (its ids as little-endian unsigned 32-bit integers),
then two skippable frames: the document ids, and the seek table of the public seekable format with the compressed size, the
size and the checksum (low half of xxh64 over the contents) of every frame. Any zstandard tool reads the whole file; a
reader here finds a document in the table and decompresses its frame only.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.llm.common import slices, stage
from emberlog.llm.tokens import encoder
from emberlog.session import fresh_path

#: Fixed values of the seekable format.
SKIPPABLE_IDS, SKIPPABLE_TABLE, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80


class FrameWriter:
    """Writes one file to an open binary stream."""

    def __init__(self, out, level: int = 3) -> None:
        import zstandard

        self.out, self.squeeze = out, zstandard.ZstdCompressor(level=level, write_content_size=True, write_checksum=False)
        self.entries: list[tuple[int, int, int]] = []
        self.doc_ids: list[int | None] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        import xxhash

        frame = self.squeeze.compress(ids)
        self.out.write(frame)
        self.entries.append((len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        self.doc_ids.append(doc_id)

    def close(self) -> None:
        known = np.array([d is not None for d in self.doc_ids], np.uint8).tobytes()
        names = known + np.array([d or 0 for d in self.doc_ids], "<i8").tobytes()
        self.out.write(struct.pack("<II", SKIPPABLE_IDS, len(names)) + names)
        table = np.array(self.entries, "<u4").reshape(-1, 3).tobytes()
        table += struct.pack("<IBI", len(self.entries), CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE_TABLE, len(table)) + table)


class FrameReader:
    """Reads single documents of one file from a seekable binary stream; a damaged frame raises ``ValueError``."""

    def __init__(self, source) -> None:
        source.seek(0, 2)
        size = source.tell()
        source.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError("not a seekable file with checksums")
        at = size - 9 - 12 * n - 8 - 9 * n
        source.seek(at)
        names = source.read(9 * n)
        source.seek(8, 1)
        self.table = np.frombuffer(source.read(12 * n), "<u4").reshape(-1, 3).astype(np.int64)
        self.known, self.doc_ids = np.frombuffer(names[:n], np.uint8), np.frombuffer(names[n:], "<i8")
        self.places = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        self.source = source

    def __len__(self) -> int:
        return len(self.table)

    def doc_id(self, k: int) -> int | None:
        return int(self.doc_ids[k]) if self.known[k] else None

    def ids(self, k: int) -> bytes:
        """The ids of the ``k``-th document of the file."""
        import xxhash
        import zstandard

        packed, size, check = self.table[k].tolist()
        self.source.seek(int(self.places[k]))
        data = zstandard.ZstdDecompressor().decompress(self.source.read(packed), max_output_size=size) if size else b""
        if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} is damaged")
        return data


@dataclass(frozen=True)
class TokenFiles:
    """Files in order of their documents: path, documents, ids of all files before."""

    spark: SparkSession
    files: list[tuple[str, int, int]]


def write(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None) -> TokenFiles:
    """Encode every whole text and write its ids and ``end_id`` in ascending ``doc_id`` order (null ids first).

    Rows are range-partitioned by id, ties by text and row, and each partition becomes one file under ``folder`` (by default
    in the shared working folder). A task that runs again writes a file of another name; the list, kept by Spark's own
    commit, names those that count. Null and empty texts have the end id only. No rows: no files. Other columns are not read.
    """
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "tokens")

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end, task = encoder(tokenizer, spaced=True), np.array([end_id], "<u4").tobytes(), TaskContext.get()
        store, root = fs.FileSystem.from_uri(folder)
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}.zst"
        out = writer = None
        n = tokens = 0
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(texts):
                for doc_id, ids in zip(doc_ids[a:b], enc.encode(texts[a:b]), strict=True):
                    if writer is None:
                        store.create_dir(root, recursive=True)
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                        writer = FrameWriter(out)
                    writer.add(doc_id, ids + end)
                    n, tokens = n + 1, tokens + len(ids) // 4 + 1
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({"part": [task.partitionId()], "name": [name], "docs": [n], "tokens": [tokens]})

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = rows.withColumn("_tie", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), "_tie", "_row"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    listed = stage(rows.mapInArrow(save, "part bigint, name string, docs bigint, tokens bigint"), "token-files").orderBy("part").collect()
    before = [0, *accumulate(r["tokens"] for r in listed)]
    return TokenFiles(spark, [(f"{folder}/{r['name']}", r["docs"], s) for r, s in zip(listed, before, strict=False)])


def scan(files: TokenFiles, with_ids: bool = False) -> DataFrame:
    """Read all documents back: ``doc_id, start, n_tokens, ids_crc32`` (and ``ids``); ``start`` counts all ids before."""
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids binary" if with_ids else "")

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, place = fs.FileSystem.from_uri(path)
                with store.open_input_file(place) as source:
                    reader = FrameReader(source)
                    for a in range(0, len(reader), 500):
                        rows = [(reader.doc_id(k), reader.ids(k)) for k in range(a, min(a + 500, len(reader)))]
                        counts = [len(x) // 4 for _, x in rows]
                        starts = [start, *accumulate(counts, initial=start)][1:-1]
                        start += sum(counts)
                        out = {
                            "doc_id": pa.array([d for d, _ in rows], pa.int64()), "start": pa.array(starts, pa.int64()),
                            "n_tokens": pa.array(counts, pa.int64()),
                            "ids_crc32": pa.array([zlib.crc32(x) for _, x in rows], pa.int64()),
                        }
                        yield pa.RecordBatch.from_pydict(out | ({"ids": pa.array([x for _, x in rows], pa.binary())} if with_ids else {}))

    listed = files.spark.createDataFrame([(p, s) for p, _, s in files.files], "path string, start bigint")
    return listed.repartition(max(1, len(files.files))).mapInArrow(load, schema)
