"""State tables written under the micro-batch that produced them.

A retried batch reads what the batches before it left and writes its own version again, so state never counts a
batch twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEPT_VERSIONS = 3
COMPACT_EVERY = 50


class Folder:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _path(self, child: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{child}" if child else self.path)

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def numbers(self, prefix: str) -> list[int]:
        """Completed children named ``prefix=<number>``."""
        fs, root = self._fs(), self._path()
        names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        return sorted(
            int(n[len(prefix) + 1:]) for n in names
            if n.startswith(f"{prefix}=") and fs.exists(self._path(f"{n}/_SUCCESS"))
        )

    def children(self, child: str = "") -> list[str]:
        fs, p = self._fs(), self._path(child)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def remove(self, child: str) -> None:
        self._fs().delete(self._path(child), True)


class VersionedTable(Folder):
    """A table replaced as a whole by each batch."""

    def __init__(self, spark: SparkSession, path: str, schema: str) -> None:
        super().__init__(spark, path)
        self.schema = schema

    def versions(self) -> list[int]:
        return self.numbers("version")

    def read(self, before: int | None = None) -> DataFrame:
        """The latest version, or the latest one before a batch; empty when there is none."""
        found = [v for v in self.versions() if before is None or v < before]
        if not found:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/version={found[-1]}")

    def write(self, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/version={batch_id}")
        for old in self.versions()[:-KEPT_VERSIONS]:
            self.remove(f"version={old}")


class RunningSums(Folder):
    """Sums per key kept as one increment per batch, folded into a snapshot now and then.

    A batch writes the keys it saw, not the whole table.
    """

    def __init__(self, spark: SparkSession, path: str, key: str) -> None:
        super().__init__(spark, path)
        self.key, self.schema = key, f"{key} string, n long"

    def read(self, before: int) -> DataFrame:
        snapshots = [v for v in self.numbers("snapshot") if v < before]
        base = snapshots[-1] if snapshots else -1
        parts = [f"{self.path}/snapshot={base}"] if snapshots else []
        parts += [f"{self.path}/increment={v}" for v in self.numbers("increment") if base < v < before]
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*parts).groupBy(self.key).agg(F.sum("n").alias("n"))

    def add(self, counts: DataFrame, batch_id: int) -> None:
        counts.select(self.key, "n").write.mode("overwrite").parquet(f"{self.path}/increment={batch_id}")
        if batch_id % COMPACT_EVERY == COMPACT_EVERY - 1:
            # The last increments stay apart, so that a retried batch still finds the state before it.
            upto = batch_id - KEPT_VERSIONS
            self.read(upto + 1).write.mode("overwrite").parquet(f"{self.path}/snapshot={upto}")
            for old in self.numbers("increment"):
                if old <= upto:
                    self.remove(f"increment={old}")
            for old in self.numbers("snapshot")[:-1]:
                self.remove(f"snapshot={old}")
