"""The prefix trie of conversations, its subtree totals found by time-forward processing.

A node is a distinct sequence of first turns; it is named by its depth and a 128-bit hash of the sequence (the XOR of position-keyed
hashes of SHA-256 digests, so a prefix hash is a running aggregate and needs no task to hold a conversation). The trie is cut into
shards: subtrees of bounded weight, and above them, in the crown of heavy nodes, stretches of paths. A shard's nodes are sorted in
reverse level order; a node's totals travel to its parent through a priority queue that spills. What the shard roots owe each other is
settled on the tree of shard roots, and the crown then runs with these sums in its queues.
"""

from __future__ import annotations

import hashlib
import heapq
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberlog.llm.common import stage
from emberlog.operators.ordered import running_totals, split_order

#: Largest weight (turns of its members from there on) of a light node; a light subtree has no more nodes than that.
SHARD = 16_384
#: Turns of a stretch of one path, ids that are joined to one piece of text, messages that a queue keeps in memory.
STRETCH, PIECE, IN_MEMORY = 65_536, 4_096, 500_000
#: Characters of a text that order turns which agree in number and role.
HEAD = 100
NODE = ["depth", "k1", "k2"]
_RECORD = 4096


class SpillingQueue:
    """A priority queue of equally long tuples of longs that keeps at most ``most`` in memory and the rest in sorted runs.

    The later half goes to an anonymous temporary file when memory is full, as a sort spills: nothing else reads it, it ends with
    the task, and a task that is run again writes its own.
    """

    def __init__(self, most: int = IN_MEMORY) -> None:
        self.most, self.heap, self.runs, self.held = max(2, most), [], [], 0

    def push(self, entry: tuple[int, ...]) -> None:
        heapq.heappush(self.heap, (*entry, -1))
        self.held += 1
        if self.held > self.most:
            self._spill()

    def _spill(self) -> None:
        own = sorted(e[:-1] for e in self.heap if e[-1] < 0)
        heads = [e for e in self.heap if e[-1] >= 0]
        keep = len(own) // 2
        file = tempfile.TemporaryFile()  # noqa: SIM115  (unlinked from the start; closed when its run is read)
        file.write(np.array(own[keep:], np.int64).tobytes())
        file.seek(0)
        self.runs.append((self._read(file, len(own[0])),))
        self.heap = [(*e, -1) for e in own[:keep]] + heads
        heapq.heapify(self.heap)
        self.held = keep
        self._next(len(self.runs) - 1)

    @staticmethod
    def _read(file, width: int) -> Iterator[tuple[int, ...]]:
        with file:
            while block := file.read(8 * width * _RECORD):
                yield from map(tuple, np.frombuffer(block, np.int64).reshape(-1, width).tolist())

    def _next(self, run: int) -> None:
        entry = next(self.runs[run][0], None)
        if entry is not None:
            heapq.heappush(self.heap, (*entry, run))

    def peek(self) -> tuple[int, ...] | None:
        return self.heap[0][:-1] if self.heap else None

    def pop(self) -> tuple[int, ...]:
        *entry, run = heapq.heappop(self.heap)
        if run >= 0:
            self._next(run)
        else:
            self.held -= 1
        return tuple(entry)


_TOTALS = pa.schema([(n, pa.int64()) for n in (*NODE, "n_leaves", "saved_tokens")])


def forward(nodes: DataFrame, shard: list[str], most: int = IN_MEMORY) -> DataFrame:
    """Subtree totals within each shard: ``depth, k1, k2, n_leaves, saved_tokens``.

    ``nodes`` has its own values and what it got from other shards as ``leaves`` and ``saved``, its parent's hash ``p1, p2``, and
    ``inside``: whether the parent is in the same shard. Shards of a task share one queue: their nodes stand in reverse level order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(most)
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            leaves_out, saved_out = [], []
            for depth, k1, k2, p1, p2, inside, leaves, saved in zip(*columns, strict=True):
                here = (-depth, k1, k2)
                while (head := queue.peek()) is not None and head[:3] == here:
                    _, _, _, more_leaves, more_saved = queue.pop()
                    leaves, saved = leaves + more_leaves, saved + more_saved
                leaves_out.append(leaves)
                saved_out.append(saved)
                if inside:
                    queue.push((1 - depth, p1, p2, leaves, saved))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(leaves_out, pa.int64()), pa.array(saved_out, pa.int64())], schema=_TOTALS)

    level = nodes.repartition(*shard).sortWithinPartitions(F.desc("depth"), "k1", "k2")
    level = level.select(*[F.col(c).cast("long").alias(c) for c in NODE], "p1", "p2", "inside", "leaves", "saved")
    return level.mapInArrow(run, ", ".join(f"{n} long" for n in _TOTALS.names))


def numbered_turns(conversations: DataFrame, rows_per_bucket: int | None = None) -> DataFrame:
    """``conv_id, pos, digest, chars`` of every turn, ``pos`` from 1 in the order of the turns; stored.

    A null turn comes first; turns with one number are put in the order of role, the first ``HEAD`` characters of the text, digest.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").isNotNull().cast("int").alias("has"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        role.alias("role"), F.substring(text, 1, HEAD).alias("head"), F.sha2(F.concat(F.length(role), F.lit(":"), role, text), 256).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    )
    turns = stage(turns, "turns")
    order = ("conv_id", "has", "turn", "role", "head", "digest")
    splits = split_order(turns, order, rows_per_bucket)
    placed = running_totals(turns, order, {"pos": F.lit(1).cast("long")}, ("conv_id",), splits)
    return stage(placed.select("conv_id", "pos", "digest", "chars"), "numbered")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (``conv_id, n`` turns after rebuilding) and their turns (``conv_id, n, depth, digest, chars``), both stored.

    Conversation c starts with the first crc32(c) % 6 turns of c - c % 100 and goes on with its own after as many.
    """
    c = F.col("conv_id")
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")).withColumns({"h": F.crc32(c.cast("string").cast("binary")) % 6, "base": c - c % 100})
    bases = own.filter(c == F.col("base")).select(F.col("base").alias("_base"), F.col("own").alias("_n"))
    shared = F.least("h", F.coalesce("_n", F.lit(0)))
    convs = own.join(bases, F.col("base") == F.col("_base"), "left").select(
        "conv_id", "base", "h", shared.alias("shared"), (shared + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n")
    )
    convs = stage(convs, "conversations")
    heads = turns.filter((F.col("pos") <= 5) & (c % 100 == 0)).withColumnRenamed("conv_id", "base")
    first = convs.filter("shared > 0").join(heads, "base").filter("pos <= shared").select("conv_id", "n", F.col("pos").alias("depth"), "digest", "chars")
    rest = turns.join(convs, "conv_id").filter("pos > h").select("conv_id", "n", (F.col("pos") - F.col("h") + F.col("shared")).alias("depth"), "digest", "chars")
    return convs.select("conv_id", "n"), first.unionByName(rest)


def prefixes(turns: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """Add the hash of the first ``depth`` turns, ``k1, k2``, and of those before the last, ``p1, p2``; stored.

    A conversation is dealt by stretches of its depth; the XOR of the stretches before enters each as a row in front.
    """
    lanes = {f"x{i}": F.xxhash64(F.lit(i), "digest", "depth") for i in (1, 2)}
    rows = turns.withColumns(lanes).withColumn("part", F.expr(f"(depth - 1) div {stretch}")).drop("digest")
    later = rows.filter(F.col("n") > stretch)
    totals = later.groupBy("conv_id", "part").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    fronts = totals.select("conv_id", "part", *[F.bit_xor(x).over(before).alias(x) for x in lanes], F.lit(0).cast("long").alias("depth")).filter("part > 0")
    inside = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.unionByName(fronts, allowMissingColumns=True).withColumns({f"k{i}": F.bit_xor(f"x{i}").over(inside) for i in (1, 2)})
    summed = summed.filter("depth > 0").withColumns({f"p{i}": F.col(f"k{i}").bitwiseXOR(F.col(f"x{i}")) for i in (1, 2)})
    return stage(summed.select("conv_id", "n", "chars", *NODE, "p1", "p2"), "prefixes")


def _ends(ending: DataFrame) -> DataFrame:
    """``depth, k1, k2, ends_sha256``: hash of the ids of each node in ascending order, joined by commas.

    Ids are joined piece by piece first; the task that hashes a node streams its pieces, for a hash is taken from front to back.
    """
    pieces = ending.groupBy(*NODE, F.floor(F.col("conv_id") / F.lit(PIECE)).alias("piece")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = state = None

        def table(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip((*NODE, "ends_sha256"), o, strict=True)) for o in out])

        for batch in batches:
            out = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids")), strict=True):
                if key != node:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            if out:
                yield table(out)
        if node is not None:
            yield table([(*node, state.hexdigest())])

    return pieces.repartition("k1", "k2").sortWithinPartitions(*NODE, "piece").mapInArrow(hashed, "depth long, k1 long, k2 long, ends_sha256 string")


def _settle(units: DataFrame) -> DataFrame:
    """Subtree sums over the tree of shard roots: ``rep, part, leaves, saved`` of ``units`` with all below them.

    ``units`` names each unit's parent as ``above, above_part`` (null at the top). Each round doubles the reach of every unit, so the
    rounds grow with the logarithm of the height. Sums combine before they are shuffled.
    """
    units = stage(units, "units")
    while not units.filter(F.col("above").isNotNull()).isEmpty():
        given = units.filter(F.col("above").isNotNull()).groupBy(F.col("above").alias("rep"), F.col("above_part").alias("part")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        jump = units.select(F.col("rep").alias("_rep"), F.col("part").alias("_part"), F.col("above").alias("_above"), F.col("above_part").alias("_above_part"))
        jump = jump.filter(F.col("_above").isNotNull())
        far = units.join(jump, (F.col("above") == F.col("_rep")) & (F.col("above_part") == F.col("_part")), "left")
        far = far.select("rep", "part", F.col("_above").alias("above"), F.col("_above_part").alias("above_part"), "leaves", "saved")
        zero = F.lit(0).cast("long")
        units = far.join(given, ["rep", "part"], "left").select(
            "rep", "part", "above", "above_part", (F.col("leaves") + F.coalesce("l", zero)).alias("leaves"), (F.col("saved") + F.coalesce("s", zero)).alias("saved")
        )
        units = stage(units, "units")
    return units.select("rep", "part", "leaves", "saved")


def prefix_trie(conversations: DataFrame, shard: int = SHARD, stretch: int = STRETCH, most: int = IN_MEMORY) -> DataFrame:
    """One row a node: ``depth, k1, k2, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Conversations are rebuilt and compared by role and text as the module says. ``saved_tokens`` sums (members - 1) times the code points
    of the last text over the subtree. A null role or text counts as empty; rows with a null ``conv_id`` take no part; repeated rows
    are turns of their own; turns with one number follow role, text start and digest. An empty table has no root and gives no rows.
    Other columns are not read, texts are read once and hashed whole. Neither a conversation nor a node nor a set of equal
    conversations has to fit into a task; only the ids that end at one node are hashed in a row, streamed.
    """
    convs, turns = rebuilt(numbered_turns(conversations))
    rows = prefixes(turns, stretch)
    long = F.lit(0).cast("long")
    inner = rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
        F.sum(F.col("n") - F.col("depth") + 1).alias("weight"),
    )
    zeros = [long.alias(c) for c in NODE]
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), long.alias("chars"), F.sum(F.col("n") + 1).alias("weight")).filter("n_convs > 0")
    root = root.select(*zeros, "conv_id", "n_convs", "chars", F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"), "weight")
    nodes = stage(inner.select(*[F.col(c).cast("long").alias(c) for c in NODE], "conv_id", "n_convs", "chars", "p1", "p2", "weight").unionByName(root), "nodes")

    up = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    children = nodes.filter("depth > 0").select(*up).groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), F.col("weight").alias("above"))
    linked = nodes.join(children, NODE, "left").join(parents, ["depth", "p1", "p2"], "left")
    n_children = F.coalesce("n_children", long)
    heavy = (F.col("weight") > shard) | (F.col("depth") == 0)
    linked = stage(linked.select(
        *NODE, "p1", "p2", "conv_id", "parent_conv_id", "n_convs", n_children.alias("n_children"), heavy.alias("heavy"),
        ((F.col("above") > shard) | (F.col("depth") <= 1)).alias("tops"), (n_children == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
    ), "linked")

    # light shards: a member passes one topmost light node, and all nodes below that have it as theirs
    tops = linked.filter("not heavy and tops").select(*NODE, F.xxhash64(*NODE).alias("shard"))
    passing = rows.select("conv_id", *NODE).join(tops, NODE).select("conv_id", "shard")
    light = linked.filter("not heavy").join(passing, "conv_id").withColumn("inside", ~F.col("tops"))
    light_totals = stage(forward(light, ["shard"], most), "light")

    # the crown: stretches of the path of each smallest member
    owed = linked.filter("not heavy and tops").select(*NODE, "p1", "p2").join(light_totals, NODE)
    owed = owed.groupBy(*up).agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
    part = F.expr(f"depth div {stretch}")
    crown = linked.filter("heavy").join(owed, NODE, "left").select(
        *NODE, "p1", "p2", F.col("conv_id").alias("rep"), part.alias("part"), "parent_conv_id", (F.col("leaves") + F.coalesce("l", long)).alias("leaves"), (F.col("saved") + F.coalesce("s", long)).alias("saved")
    )
    crown = stage(crown, "crown")
    top = F.min_by(F.struct("depth", "k1", "k2", "p1", "p2", "parent_conv_id"), "depth").alias("top")
    units = stage(crown.groupBy("rep", "part").agg(top, F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "units")
    above = F.when(F.col("top.depth") > 0, F.col("top.parent_conv_id"))
    sums = _settle(units.select("rep", "part", above.alias("above"), F.when(F.col("top.depth") > 0, F.expr(f"(top.depth - 1) div {stretch}")).alias("above_part"), "leaves", "saved"))
    sums = sums.join(units.select("rep", "part", "top"), ["rep", "part"]).filter("top.depth > 0")
    sums = sums.groupBy((F.col("top.depth") - 1).alias("depth"), F.col("top.p1").alias("k1"), F.col("top.p2").alias("k2")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
    crown = crown.join(units.select("rep", "part", F.col("top.depth").alias("first")), ["rep", "part"]).join(sums, NODE, "left").select(
        *NODE, "p1", "p2", "rep", "part", (F.col("depth") > F.col("first")).alias("inside"), (F.col("leaves") + F.coalesce("l", long)).alias("leaves"), (F.col("saved") + F.coalesce("s", long)).alias("saved")
    )
    totals = light_totals.unionByName(forward(crown, ["rep", "part"], most))

    ending = rows.filter("n = depth").select(*NODE, "conv_id").unionByName(convs.filter("n = 0").select(*zeros, "conv_id"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return linked.join(totals, NODE).join(_ends(ending), NODE, "left").select(
        *NODE, "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256")
    )
