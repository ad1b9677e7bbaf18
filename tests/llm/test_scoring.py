"""Toxicity, shards, ranks."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlog.llm import common, sharding, toxicity

BAD = ("grobwort", "miesling", "tölpel")


@pytest.fixture(scope="module")
def labelled(spark, make):
    r = random.Random(3)
    vocab = ["".join(r.choice("aeiourstlnm") for _ in range(r.randint(3, 8))) for _ in range(300)]
    rows, labels = [], []
    for i in range(900):
        w = [r.choice(vocab) for _ in range(r.randint(5, 80))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(r.randint(1, 3)):
                w.insert(r.randrange(len(w)), r.choice(BAD) + r.choice(["", "en", "isch"]))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    labels += [(None, 1, 1), (3, 0, None), (5000, 1, 1), (6, 1, 1)]
    return make(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows_are_told_apart(labelled):
    docs, labels = labelled
    got = toxicity.score(docs, toxicity.fit(docs, labels)).select("row.doc_id", "score", "predicted").collect()
    by = {r["doc_id"]: r for r in got}
    test = [i for i in range(900) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(test) > 150
    right = sum(by[i]["predicted"] == (i % 6 == 0) for i in test)
    assert right >= 0.97 * len(test) and all(0 <= r["score"] <= 1 for r in got)


def test_held_out_labels_teach_nothing(spark, labelled):
    docs, labels = labelled
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, turned)
    assert a.lexicon.weights == b.lexicon.weights and np.allclose(a.weights, b.weights)


def test_folding_and_exceptions():
    assert toxicity.fold("IDI0T, 1d1ot! ｉｄｉｏｔ іdіоt\n") == " idiot idiot idiot idiot "
    assert toxicity.fold(None) == toxicity.fold("") == " "
    lex = toxicity.Lexicon({" trash ": 3.0, " tras": 1.0, " töl": 2.0})
    assert sorted(lex.matches(toxicity.fold("Trash and trashy; tölpel")).values()) == [1.0, 2.0, 3.0]
    assert lex.matches(toxicity.fold("a trash can here")) == {}
    assert len(lex.matches(toxicity.fold("trash trash can"))) == 1
    assert toxicity.Lexicon({}, ()).features("word " * 5000)[1] == 0


@pytest.mark.parametrize("form", [
    "ｉｄｉ０ｔ", "ídïöt", "𝐢𝐝𝐢𝐨𝐭", "𝓲𝓭𝓲𝓸𝓽", "i.d.i.o.t", "I-D-I-0-T", "id\u200biot", "i\u0301diot", "1d10t", "іԁіоt", "id\u00adiot", "ⓘⓓⓘⓞⓣ",
])
def test_disguised_words_are_folded(form):
    assert toxicity.fold(f"an {form}!") == " an idiot "


def test_what_folding_leaves_alone():
    assert toxicity.fold("8itch 9ross 6oon 2ero") == " bitch gross goon zero "
    assert toxicity.fold("2024, 3.14 e.g. 한국어 v1.2.3") == toxicity.fold("e g 한국어 v1")
    assert toxicity.fold("well-known a-b") == " well known a b "


def plain_matches(lexicon, folded):
    """Every entry tried at every place."""
    best, spared = {}, set()
    for phrase in lexicon.exceptions:
        entry = toxicity.fold(phrase)
        spared |= {x for at in range(len(folded)) if folded.startswith(entry, at) for x in range(at, at + len(entry) - 1)}
    for entry, weight in lexicon.weights.items():
        for at in range(len(folded)):
            if folded.startswith(entry, at) and at not in spared:
                best[at] = max(best.get(at, 0.0), weight)
    return best


def test_matches_against_every_place():
    r = random.Random(5)
    words = ["trash", "trashy", "can", "bin", "clown", "class", "fish", "scum", "pond", "a"]
    for _ in range(300):
        entries = {e: r.random() + 0.1 for w in r.sample(words, 5) for e in toxicity._entries(w)}
        pairs = tuple(" ".join(r.sample(words, r.randint(2, 3))) for _ in range(r.randint(0, 6)))
        lexicon = toxicity.Lexicon(entries, pairs)
        folded = toxicity.fold(" ".join(r.choice(words) for _ in range(r.randint(0, 40))))
        assert lexicon.matches(folded) == plain_matches(lexicon, folded)


def test_many_exceptions_in_one_text():
    lexicon = toxicity.Lexicon({" trash ": 2.0, " bad ": 1.0})
    assert len(lexicon.matches(toxicity.fold("trash can bad " * 100_000))) == 100_000


def test_odd_rows_and_one_sided_labels(spark, make, labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels)
    got = toxicity.score(make([(None, None), (1, ""), (1, ""), (2, "grobwort " * 20000), (3, None)]), model).collect()
    assert len(got) == 5 and {r["predicted"] for r in got if r["row"]["doc_id"] != 2} == {0}
    assert [r["predicted"] for r in got if r["row"]["doc_id"] == 2] == [1]
    assert toxicity.score(make([]), model).count() == 0
    assert toxicity.fit(docs, labels.filter("toxic = 0")).constant == 0.0
    assert toxicity.fit(docs, labels.filter("toxic is null")).constant == 0.0


def test_shards_balance(spark, make):
    r = random.Random(8)
    rows = [(i, f"wörd{i % 900} " * r.randint(0, 60)) for i in range(3000)] + [(4000 + i, "same text " * 30) for i in range(900)] + [(None, None), (7, "x"), (7, "x"), (9, None)]
    got = sharding.shard(make(rows).repartition(4), shards=6).collect()
    assert Counter((r["doc_id"], r["text_crc32"], r["size"]) for r in got) == Counter((i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 8) for i, t in rows)
    size, slots = Counter(), {}
    for x in got:
        size[x["shard"]] += x["size"]
        slots.setdefault(x["shard"], []).append(x["slot"])
        assert x["law"] == "bytes" and x["grown_shard"] is None
    assert set(size) == set(range(6)) and max(size.values()) <= 1.03 * min(size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(make([])).count() == 0


def test_groups_stay_together_below_a_quarter(make):
    rows = [(i, f"text {i // 3} " * 5) for i in range(3000)]
    where = {}
    for x in sharding.shard(make(rows), shards=4).collect():
        where.setdefault(x["text_crc32"], set()).add(x["shard"])
    assert all(len(s) == 1 for s in where.values())


def test_ranks_of_hot_groups(spark):
    rows = [(1 if i % 3 else i % 50, i, None if i % 7 else i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g long, x long, y long")
    got = common.ranked(df, ["g"], ["x", "y"], "r", 2000).collect()
    by = {}
    for r in got:
        by.setdefault(r["g"], []).append(r["r"])
    assert len(got) == 2000 and all(sorted(v) == list(range(len(v))) for v in by.values())
    nulls = common.ranked(spark.createDataFrame([(None, 1), (None, 1)], "g long, x long"), ["g"], ["x"], "r", 2).collect()
    assert sorted(r["r"] for r in nulls) == [0, 1]
