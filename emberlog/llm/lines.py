"""Fuzzy line deduplication with DataFrame functions only.

Normalised lines get a 63-bit SimHash of their words. Hashes within three bits of each other share two of five blocks, so
an equi-join on pairs of blocks finds all of them; edit similarity then decides. One occurrence of each connected group stays.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import components, stage, text_key

#: Bits of a SimHash: 9 accumulators of 7 lanes, each lane a byte that counts up to ``PART`` votes.
ACCUMULATORS, LANES, PART = 9, 7, 127
_ONES, _COPIES = 0x01010101010101, 0x02040810204081
#: First bit and number of bits of each block, and how far hashes may differ.
BLOCKS, APART = ((0, 13), (13, 13), (26, 13), (39, 12), (51, 12)), 3
#: Lines of one hash that are compared with as many at a time.
BLOCK = 256
TABLES = tuple(combinations(range(len(BLOCKS)), len(BLOCKS) - APART))


def words_of_line(line: Column) -> Column:
    """Lower-case words of letters and digits: the normalised line."""
    return F.array_remove(F.split(F.lower(line), r"[^\p{L}\p{N}]+"), "")


def _vote(votes: DataFrame, keys: list[str]) -> DataFrame:
    """Majority of the bits of ``h`` in each group of at most ``PART`` votes, as ``h``."""
    sums = []
    for k in range(ACCUMULATORS):
        seven = F.shiftright("h", LANES * k).bitwiseAND(F.lit(127))
        sums.append(F.sum((seven * F.lit(_COPIES)).bitwiseAND(F.lit(_ONES))).alias(f"a{k}"))
    counted = votes.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *sums)
    total = F.lit(0).cast("long")
    for k in range(ACCUMULATORS):
        above = (F.col(f"a{k}") + (F.lit(PART) - F.floor(F.col("n") / 2)) * F.lit(_ONES)).bitwiseAND(F.lit(_ONES << 7))
        y = F.shiftright(above, 7)
        packed = y
        for s in range(1, LANES):
            packed = packed.bitwiseOR(F.shiftright(y, LANES * s))
        total = total.bitwiseOR(F.shiftleft(packed.bitwiseAND(F.lit(127)), LANES * k))
    return counted.select(*keys, total.alias("h"))


def _lines(docs: DataFrame) -> DataFrame:
    """``row, doc_id, th, line, words, node`` of every line; ``node`` names its normalised text.

    A generated row holds the words: filters and columns after it would otherwise split the line once more each.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_key().alias("th"), "text")
    lines = rows.select("row", "doc_id", "th", F.posexplode(F.split("text", "\n")).alias("line", "raw"))
    return lines.select("row", "doc_id", "th", "line", F.explode(F.array(words_of_line(F.col("raw")))).alias("words")).withColumn("node", F.xxhash64("words"))


def hashed_lines(docs: DataFrame, min_words: int) -> DataFrame:
    """``doc_id, th, line, node, h, full`` of every line with a word; ``full`` marks those with ``min_words`` words or more."""
    lines = _lines(docs).withColumn("full", F.size("words") >= min_words).withColumn("long", F.size("words") > PART)
    keys = ["row", "doc_id", "th", "line", "node", "full", "long"]
    words = lines.select(*keys, F.posexplode("words").alias("at", "word"))
    votes = words.select(*keys, F.floor(F.col("at") / PART).cast("int").alias("part"), F.shiftrightunsigned(F.xxhash64("word"), 1).alias("h"))
    # long lines vote in parts, then their parts vote
    voted = stage(_vote(votes, [*keys, "part"]), "votes")
    rest = voted.filter("long")
    while not rest.filter("part > 0").isEmpty():
        rest = stage(_vote(rest.withColumn("part", F.floor(F.col("part") / PART).cast("int")), [*keys, "part"]), "long")
    out = ["doc_id", "th", "line", "node", "h", "full"]
    return voted.filter("not long").select(*out).union(rest.select(*out))


def _block(h: Column, b: int) -> Column:
    first, bits = BLOCKS[b]
    return F.shiftright(h, first).bitwiseAND(F.lit((1 << bits) - 1))


def _keyed(values: DataFrame) -> DataFrame:
    """Every row of ``values`` once for each table, with the ``key`` that its hash ``h`` has there."""
    h = F.col("h")
    keys = [F.shiftleft(_block(h, i), 32).bitwiseOR(F.shiftleft(_block(h, j), 8)).bitwiseOR(F.lit(t)) for t, (i, j) in enumerate(TABLES)]
    return values.select("*", F.explode(F.array(*keys)).alias("key"))


def _differ() -> Column:
    return F.col("h").bitwiseXOR(F.col("g"))


def with_close(values: DataFrame) -> DataFrame:
    """The hashes ``h`` that have another one within ``APART`` bits, however many."""
    # both sides are one plan, so they share one shuffle
    keyed, other = _keyed(values.select("h")).alias("x"), _keyed(values.select("h")).alias("y")
    near = (F.col("x.key") == F.col("y.key")) & (F.col("x.h") != F.col("y.h")) & (F.bit_count(F.col("x.h").bitwiseXOR(F.col("y.h"))) <= APART)
    return keyed.join(other, near, "left_semi").select("h").distinct()


def close_hashes(values: DataFrame, only: Column | None = None) -> DataFrame:
    """All pairs of different hashes ``h`` within ``APART`` bits, once each: ``h``, ``g``.

    ``only`` leaves out pairs by the other columns of ``values``, which those of ``g`` follow with a leading ``_``.
    """
    keyed = _keyed(values)
    other = keyed.select(F.col("h").alias("g"), *[F.col(c).alias(f"_{c}") for c in keyed.columns if c != "h"])
    # of the tables in which a pair meets, the first one reports it
    first = F.lit(len(TABLES))
    for t, (i, j) in reversed(list(enumerate(TABLES))):
        first = F.when((_block(_differ(), i) == 0) & (_block(_differ(), j) == 0), t).otherwise(first)
    near = (F.col("key") == F.col("_key")) & (F.col("h") < F.col("g")) & (F.bit_count(_differ()) <= APART)
    near = near if only is None else near & only
    return keyed.join(other, near & (F.col("key").bitwiseAND(F.lit(255)) == first)).select("h", "g")


def _held(rows: DataFrame, **values: Column) -> DataFrame:
    """``rows`` with new columns, each worked out once: a generated row holds them, which filters and columns after it would otherwise repeat."""
    made = rows.select("*", F.explode(F.array(F.struct(*[v.alias(k) for k, v in values.items()]))).alias("__held"))
    return made.select(*rows.columns, *[F.col("__held")[k].alias(k) for k in values])


def keep_similar(pairs: DataFrame, a: str, b: str, least: float, name: str = "same") -> DataFrame:
    """Adds whether the normalised lines ``a`` and ``b`` (single spaces, not equal) have an edit similarity, 1 - distance / longer length, of ``least`` or more.

    Words that both begin or end with change no distance and are left out. Replacing all of the rest, or word by word, bounds
    the distance from above; where that decides nothing it is computed, for lines that share most words within a narrow band first.
    """
    x, y = F.col("__x"), F.col("__y")

    def equal(u: Column, v: Column) -> Column:
        """Number of leading words that are equal (the lines differ)."""
        return F.array_position(F.zip_with(u, v, lambda p, q: ~p.eqNullSafe(q)), True).cast("int") - 1

    def rest(u: Column) -> Column:
        n = F.size(u) - F.col("__head") - F.col("__tail")
        return F.when(n <= 0, "").otherwise(F.concat(F.lit(" "), F.array_join(F.slice(u, F.col("__head") + 1, F.greatest(n, F.lit(0))), " ")))

    rows = _held(pairs, __x=F.split(a, " "), __y=F.split(b, " "))
    rows = _held(rows, __head=equal(x, y), __back=equal(F.reverse(x), F.reverse(y)))
    rows = rows.withColumn("__tail", F.least("__back", F.least(F.size(x), F.size(y)) - F.col("__head")))
    replaced = F.zip_with(x, y, lambda p, q: F.when(p == q, 0).otherwise(F.greatest(F.length(p), F.length(q))))
    full = F.floor((1 - least) * F.greatest(F.length(a), F.length(b)) + 1e-9).cast("int")
    rows = _held(rows, __a=rest(x), __b=rest(y), __full=full, __by_word=F.when(F.size(x) == F.size(y), F.aggregate(replaced, F.lit(0), lambda s, v: s + v)))
    rows = _held(rows, __m=F.length("__a"), __n=F.length("__b"))
    alike = "2 * size(array_intersect(__x, __y)) >= size(array_union(__x, __y))"
    test = F.expr(
        "abs(__m - __n) <= __full and (greatest(__m, __n) <= __full or coalesce(__by_word <= __full, false) or "
        f"({alike} and levenshtein(__a, __b, least(__full, cast(greatest(__m, __n) / 16 + 8 as int))) >= 0) or levenshtein(__a, __b, __full) >= 0)"
    )
    return rows.select(*pairs.columns, test.alias(name))


def to_leaders(nodes: DataFrame, shift: float) -> DataFrame:
    """For each of ``nodes`` (``node, h, n, c``) at most one pair ``a, b`` with the leader of a group that it is in.

    A group has one key and about one length; the most frequent of its lines leads it. Of the leaders within ``APART`` bits, the closest counts.
    """
    keyed = _keyed(nodes.withColumn("size", F.floor(F.log("n") / F.log(F.lit(1.1)) + F.lit(shift)).cast("int")))
    lead = keyed.groupBy("key", "size").agg(F.count(F.lit(1)).alias("k"), F.max_by(F.struct("node", "h"), F.struct("c", "node")).alias("lead")).filter("k > 1")
    led = keyed.join(lead.select("key", "size", F.col("lead.node").alias("b"), F.col("lead.h").alias("g")), ["key", "size"])
    bits = F.bit_count(_differ())
    near = led.filter((F.col("node") != F.col("b")) & (bits <= APART)).groupBy(F.col("node").alias("a"))
    return near.agg(F.min_by("b", F.struct(bits, "b")).alias("b"))


def unconnected(members: DataFrame, least: float) -> DataFrame:
    """Pairs of ``members`` (``node, h, n, root``) of equal or close hashes, with different roots and lengths close enough: ``a, b, root_a, root_b, gap``.

    Hashes whose members have one root in common, or lengths too far apart, never meet. The members of a hash are cut into blocks
    of about ``BLOCK``, so no task gets all pairs of a frequent one; two blocks that hold one root only are left out.
    """
    short = F.lit(least - 1e-9)
    hashes = members.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("n").alias("n"), F.max("n").alias("m"))
    hashes = stage(hashes, "hashes")
    only = (F.least("lo", "_lo") != F.greatest("hi", "_hi")) & (F.col("m") >= short * F.col("_n")) & (F.col("_m") >= short * F.col("n"))
    meetings = stage(close_hashes(hashes, only).union(hashes.filter("lo <> hi").select("h", F.col("h").alias("g"))), "meetings")
    met = meetings.select("h").union(meetings.select("g")).distinct()
    members = members.join(met, "h", "left_semi")
    counts = members.groupBy("h").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("k"))
    blocked = stage(members.join(counts, "h").withColumn("block", F.pmod(F.xxhash64("node"), F.col("k")).cast("int")).drop("k"), "blocked")
    blocks = stage(blocked.groupBy("h", "block").agg(F.min("root").alias("lo"), F.max("root").alias("hi")), "blocks")
    left = blocks.select("h", F.col("block").alias("i"), "lo", "hi")
    right = blocks.select(F.col("h").alias("g"), F.col("block").alias("j"), F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"))
    met = meetings.join(left, "h").join(right, "g").filter((F.col("h") != F.col("g")) | (F.col("i") <= F.col("j")))
    met = stage(met.filter(F.least("lo", "lo_b") != F.greatest("hi", "hi_b")).select("h", "i", "g", "j"), "meetings")
    one = blocked.select("h", F.col("block").alias("i"), F.col("node").alias("a"), F.col("n"), F.col("root").alias("root_a"))
    two = blocked.select(F.col("h").alias("g"), F.col("block").alias("j"), F.col("node").alias("b"), F.col("n").alias("m"), F.col("root").alias("root_b"))
    apart = (F.col("root_a") != F.col("root_b")) & (F.least("n", "m") >= short * F.greatest("n", "m"))
    once = (F.col("h") != F.col("g")) | (F.col("i") != F.col("j")) | (F.col("a") < F.col("b"))
    return met.join(one, ["h", "i"]).join(two, ["g", "j"]).filter(apart & once).select("a", "b", "root_a", "root_b", F.abs(F.col("n") - F.col("m")).alias("gap"))


def _rooted(rows: DataFrame, roots: DataFrame, name: str) -> DataFrame:
    """``rows`` with the root of the node ``name`` in its place; a node without links is its own."""
    found = roots.select(F.col("node").alias("__n"), F.col("root").alias("__r"))
    return rows.join(found, F.col(name) == F.col("__n"), "left").withColumn(name, F.coalesce("__r", name)).drop("__n", "__r")


def line_groups(docs: DataFrame, min_words: int = 5, least: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """All lines with a word, ``doc_id, th, line, node, full``, and ``node``, ``root`` of the nodes of similar lines.

    Each line that has one of an equal or close hash is first compared with a leader or two, which joins near copies at a cost in
    proportion to their number. Then all lines of equal and close hashes are compared that are not connected by that.
    """
    lines = hashed_lines(docs, min_words)
    nodes = lines.filter("full").groupBy("node").agg(F.first("h").alias("h"), F.count(F.lit(1)).alias("c"), F.min(F.struct("doc_id", "th", "line")).alias("at"))
    nodes = stage(nodes, "nodes")
    kinds = nodes.groupBy("h").count()
    wanted = stage(with_close(kinds).union(kinds.filter("count > 1").select("h")).distinct(), "wanted")
    asked = nodes.join(wanted, "h").groupBy(F.col("at.doc_id").alias("_d"), F.col("at.th").alias("_t")).agg(F.collect_list(F.struct("at.line", "node", "h", "c")).alias("asked"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select("doc_id", text_key().alias("th"), "text")
    texts = rows.join(asked.hint("merge"), rows["doc_id"].eqNullSafe(F.col("_d")) & (rows["th"] == F.col("_t"))).select(F.split("text", "\n").alias("raw"), "asked")
    texts = texts.select("raw", F.explode("asked").alias("x")).select("x.node", "x.h", "x.c", F.array_join(words_of_line(F.element_at("raw", F.col("x.line") + 1)), " ").alias("norm"))
    every = stage(texts.dropDuplicates(["node"]).withColumn("n", F.length("norm")), "texts")
    texts, members = every.select("node", "norm"), every.select("node", "h", "n", "c")

    def verified(pairs: DataFrame) -> DataFrame:
        """The similar ones of pairs of nodes ``a, b``."""
        both = pairs.join(texts.select(F.col("node").alias("a"), F.col("norm").alias("text")), "a")
        both = both.join(texts.select(F.col("node").alias("b"), F.col("norm").alias("other")), "b")
        return stage(keep_similar(both, "text", "other", least).filter("same").select("a", "b"), "links")

    # leaders only save work: every pair that they leave unconnected is verified, after one pair of each two parts
    led = stage(to_leaders(members, 0.0).union(to_leaders(members, 0.5)).distinct(), "led")
    roots = components(verified(led))
    pairs = stage(unconnected(_rooted(members.withColumn("root", F.col("node")), roots, "root"), least), "pairs")
    tried = pairs.groupBy(F.least("root_a", "root_b").alias("x"), F.greatest("root_a", "root_b").alias("y"))
    tried = stage(tried.agg(F.min_by(F.struct("a", "b"), F.struct("gap", "a", "b")).alias("p")).select("p.a", "p.b"), "pairs")
    rest = pairs.select("a", "b").join(tried, ["a", "b"], "left_anti")
    while not tried.isEmpty():
        # parts are few: only their roots meet again
        merged = components(_rooted(_rooted(verified(tried), roots, "a"), roots, "b"))
        moved = _rooted(roots, merged, "root")
        roots = stage(moved.union(merged.join(roots, "node", "left_anti").select("node", "root")), "roots")
        parts = rest.select("a", "b", F.col("a").alias("root_a"), F.col("b").alias("root_b"))
        tried = stage(_rooted(_rooted(parts, roots, "root_a"), roots, "root_b").filter("root_a <> root_b").select("a", "b"), "pairs")
        rest = rest.limit(0)
    return lines.select("doc_id", "th", "line", "node", "full"), roots


def without_similar_lines(docs: DataFrame, min_words: int = 5, least: float = 0.8, short_copies: bool = False) -> DataFrame:
    """Every row of ``docs`` as ``row``, with ``n_lines``, ``n_removed`` and ``text`` of the lines that stay.

    Lines are linked if they are equal when normalised, or if their SimHashes differ in at most ``APART`` bits and their edit
    similarity is ``least`` or more; of each connected group the occurrence with the least document id and line stays. Lines
    of fewer than ``min_words`` words are linked to none; with ``short_copies`` one of those that are equal when normalised stays,
    and lines without any word all stay. Rows equal in id and text get equal results; a null text has no lines and stays
    null. Whole lines count, however long. Columns of any name pass through in ``row``.
    """
    lines, roots = line_groups(docs, min_words, least)
    lines = lines if short_copies else lines.filter("full")
    sizes = lines.groupBy("node").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("doc_id", "th", "line")).alias("at"))
    named = sizes.join(roots, "node", "left").select("node", "c", "at", F.coalesce("root", "node").alias("root"))
    groups = named.groupBy("root").agg(F.sum("c").alias("size"), F.min("at").alias("keep")).filter("size > 1")
    named = stage(named.join(groups, "root").select("node", F.col("keep.doc_id").alias("_d"), F.col("keep.th").alias("_t"), F.col("keep.line").alias("_l")), "groups")
    hit = lines.join(named, "node").filter(~(F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")) & (F.col("line") == F.col("_l"))))
    removed = hit.groupBy("doc_id", "th").agg(F.collect_set("line").alias("removed"))
    removed = stage(removed.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), "removed"), "removed")
    rows = docs.select(F.struct("*").alias("row")).select("row", F.col("row.doc_id").cast("long").alias("_id"), F.col("row.text").cast("string").alias("text")).withColumn("_th", text_key())
    rows = rows.join(removed.hint("merge"), F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_th") == F.col("_t")), "left")
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("removed", i)), "\n")
    count = F.coalesce(F.size("removed"), F.lit(0))
    return rows.select(
        "row", F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines"),
        F.when(F.col("removed").isNull(), 0).otherwise(count).cast("long").alias("n_removed"),
        F.when(F.col("removed").isNull(), F.col("text")).otherwise(kept).alias("text"),
    )
