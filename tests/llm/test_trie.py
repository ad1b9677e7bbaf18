"""The prefix trie against a plain recursive version."""

import hashlib
import random
import zlib

import pytest

from emberlog.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, k1 string, row string"


def plain(rows):
    """Every node by its sequence of turns."""
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    kids = {}
    for seq in members:
        if seq:
            kids.setdefault(seq[:-1], []).append(seq)
    leaves, saved = {}, {}
    for seq in sorted(members, key=len, reverse=True):
        own_saved = (len(members[seq]) - 1) * len(seq[-1][1]) if seq else 0
        leaves[seq] = sum(leaves[k] for k in kids[seq]) if seq in kids else 1
        saved[seq] = own_saved + sum(saved[k] for k in kids.get(seq, []))
    out = []
    for seq, cs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in cs if built[c] == seq))
        parent = min(members[seq[:-1]]) if seq else None
        out.append((min(cs), len(seq), parent, len(cs), len(kids.get(seq, [])), leaves[seq], saved[seq], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    got = trie.prefix_trie(df, **kw).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(map(tuple, got.collect()), key=repr)


def forest(seed, n, turns, words=3):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-150, 400), n):
        for t in range(rng.randint(1, turns)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice("ab ÿ𝄞"[:words]) * rng.randint(0, 2)))
    return rows


@pytest.mark.parametrize("shard, stretch, most", [(16_384, 65_536, 1000), (6, 2, 2), (1, 3, 3)])
def test_trie_is_that_of_the_plain_version(spark, shard, stretch, most):
    rows = forest(1, 120, 9) + [(7, t, "user", "same") for t in range(40)] + [(8, t, "user", "same") for t in range(30)]
    assert run(spark, rows, shard=shard, stretch=stretch, most=most) == plain(rows)


def test_nulls_ties_repeats_and_empty_tables(spark):
    rows = [
        (100, 0, None, None), (100, 0, "b", "x"), (100, None, "z", "first"), (100, 1, "u", "t"), (100, 1, "u", "t"),
        (101, 5, "u", ""), (None, 0, "u", "lost"), (350, 0, "u", "alone"), (199, None, None, "é𝄞"),
    ]
    assert run(spark, rows) == plain(rows)
    assert run(spark, []) == run(spark, [(None, 0, "u", "x")]) == []


def test_one_conversation_and_one_set_of_copies_hold_most_rows(spark):
    """A very long conversation lies in many stretches; a thousand equal ones end at one node."""
    rows = [(0, t, "user", f"turn {t}") for t in range(700)] + [(c, t, "user", f"{t}" * 3) for c in range(1000, 1300) for t in range(3)]
    assert run(spark, rows, shard=64, stretch=50, most=20) == plain(rows)


def test_queue_spills_in_order():
    rng = random.Random(3)
    queue, out, other = trie.SpillingQueue(most=10), [], []
    for step in range(3000):
        if rng.random() < 0.6 or not other:
            entry = (rng.randint(0, 500), rng.randint(-(2**62), 2**62), step)
            queue.push(entry)
            other.append(entry)
        else:
            assert queue.pop() == min(other)
            other.remove(min(other))
    while queue.peek() is not None:
        out.append(queue.pop())
    assert out == sorted(other) and len(queue.runs) > 5 and len(queue.heap) == 0
