"""Shards of near equal bytes, tokens and rows by vector bin packing.

The unit is a group of equal texts. A group's vector is its bytes, tokens and rows as shares of one shard's part; it goes
to the shard where its dot product with what that shard still lacks is highest. Groups below a thousandth of a part are
first dealt by hash into lots of about that size, and a group above a quarter of a part is cut, so the number of items placed on the
driver has a fixed bound for any table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import ranked, stage

#: Lots, and the least size of a group placed by itself, per shard.
LOTS, LARGE = 200, 1000


def place(items: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item; columns are sizes in some dimensions, each is scaled to the mean of a shard."""
    part = np.maximum(items.sum(axis=0) / shards, 1e-9)
    scaled = items / part
    lacking = np.ones((shards, items.shape[1]))
    out = np.zeros(len(items), np.int64)
    for k in np.argsort(-scaled.max(axis=1), kind="stable"):
        out[k] = best = int(np.argmax(lacking @ scaled[k]))
        lacking[best] -= scaled[k]
    return out


def shard(docs: DataFrame, shards: int = 24) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row; the law is ``bytes``.

    Size is the UTF-8 bytes of the text plus 8 (null: 8); tokens are its words. Equal texts share a shard unless they make up over a
    quarter of a shard. Slots are gapless from 0 in each shard. Null texts are one group. Other columns are not read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.regexp_count(text, F.lit(r"[^\s]+")).cast("long").alias("_tokens"),
        F.xxhash64(text).alias("_group"), F.xxhash64(F.lit(1), text, F.col("text").isNull()).alias("_other"),
    )
    rows = stage(rows, "sizes")
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    part = max(1, total // shards)
    keys = ["_group", "_other"]
    # a group above a quarter of a part is cut by id into pieces of about a 16th; there are at most 4 * shards such groups
    large = rows.groupBy(*keys).agg(F.sum("size").alias("b")).filter(F.col("b") * 4 > part)
    large = stage(large.select(*keys, F.ceil(F.col("b") * 16 / part).cast("int").alias("_cuts")), "cut")
    rows = rows.join(F.broadcast(large), keys, "left")
    rows = rows.withColumn("_piece", F.coalesce(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.col("_cuts")), F.lit(0)).cast("int")).drop("_cuts")
    groups = rows.groupBy(*keys, "_piece").agg(F.sum("size").alias("b"), F.sum("_tokens").alias("t"), F.count(F.lit(1)).alias("r"))
    groups = stage(groups, "groups")
    lot = F.pmod(F.col("_group"), F.lit(LOTS * shards)).cast("int")
    whole = F.col("b") * LARGE >= part
    lots = groups.filter(~whole).groupBy(lot.alias("lot")).agg(*[F.sum(c).alias(c) for c in "btr"]).collect()
    alone = groups.filter(whole).collect()
    items = [[r[c] for c in "btr"] for r in (*alone, *lots)]
    where = place(np.array(items, float).reshape(-1, 3), shards).tolist()
    spark = docs.sparkSession
    # bounded: at most shards * LARGE large pieces and LOTS * shards lots
    big = [(r["_group"], r["_other"], r["_piece"], s) for r, s in zip(alone, where, strict=False)]
    big = spark.createDataFrame(big, "_group bigint, _other bigint, _piece int, _big int")
    small = spark.createDataFrame([(r["lot"], s) for r, s in zip(lots, where[len(alone) :], strict=True)], "_lot int, _small int")
    placed = rows.withColumn("_lot", lot).join(F.broadcast(big), [*keys, "_piece"], "left").join(F.broadcast(small), "_lot", "left")
    placed = placed.select("doc_id", "size", "text_crc32", F.coalesce("_big", "_small").alias("shard"))
    out = ranked(placed, ["shard"], ["doc_id", "text_crc32"], "slot", n)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
