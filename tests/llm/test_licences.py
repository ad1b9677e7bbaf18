"""Licence scans: base phrases against plain word sequences, rules against planted texts, suppression against all pairs."""

import random
import re

import pytest

from emberlog.llm import licences as L
from emberlog.llm.common import read

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in L.BASE:
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(words), sorted(places), sorted(labels)


@pytest.mark.parametrize("table", ["documents"])
def test_base_columns_are_those_of_plain_search(spark, table):
    docs = read(spark, "/root/testdata/sf0.01", table)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = L.labelled(L.scan(docs)).collect()
    assert len(got) == len(texts)
    for r in got:
        n, places, labels = plain(texts[r["doc_id"]])
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (
            n, len(places), places[0] if places else None, places[-1] if places else None, ",".join(labels))
        assert set(labels) <= set(r["labels"].split(",")) | {""} and 0 <= r["score"] <= 1 and (r["score"] > 0 or not places)


CASES = [
    ("Licensed under the Apache License, Version 2.0 (the \"License\")", {"apache-2"}),
    ("under the MIT license under the mit LICENSE", {"mit"}),
    ("cc-by-nc cc_by_nc-sa 4.0", {"cc-by-nc", "cc-by-nc-sa-4"}),
    ("// SPDX-License-Identifier: LGPL-2.1-or-later", {"lgpl-2.1"}),
    ("distributed under the terms of the GNU Affero General Public License version 3 or later", {"agpl-3"}),
    ("GPLv3 code", {"gpl-3"}),
    ("Redistribution and use in source and binary forms, with or without\n modification, are permitted", {"bsd"}),
    ("see https://www.apache.org/licenses/LICENSE-2.0", {"apache-2"}),
    ("This is free and unencumbered software released into the public domain.", {"unlicense"}),
    ("the university MIT and the apache server 2.4, a gnu in the zoo", set()),
    ("", set()), (None, set()), ("ñandú Ünder thé mit liçense", set()),
]


def test_rules_find_planted_licences(spark, make):
    docs = make([t for t, _ in CASES] + [CASES[0][0]])
    got = {r["doc_id"]: set(filter(None, r["labels"].split(","))) for r in L.labelled(L.scan(docs)).collect()}
    assert [got[i] for i in range(len(CASES))] == [want for _, want in CASES] and got[len(CASES)] == {"apache-2"}


def test_there_are_hundreds_of_rules_in_order():
    ordered = L.rules()
    assert len(ordered) > 300 and [r.tier for r in ordered] == sorted(r.tier for r in ordered)
    scanner = L._own_rules()
    for r in ordered:
        assert set(r.keywords) <= set(scanner.gates)


def test_keywords_miss_no_rule():
    """The prefilter changes nothing: all rules on all keywords give the same detections."""
    scanner = L._own_rules()
    for text, _ in CASES:
        words = f" {' '.join(WORD.findall((text or '').lower().encode().decode('latin-1')))} "
        gated = scanner.detect(words, scanner.prefilter(words))
        every = scanner.detect(words, set(scanner.gates))
        assert (gated[0], gated[1], set(gated[2])) == (every[0], every[1], set(every[2]))


def test_containment_is_that_of_all_pairs():
    scanner, rng = L._own_rules(), random.Random(1)
    for _ in range(200):
        found = [L.Found(a := rng.randint(0, 20), a + rng.randint(1, 8), rng.randrange(len(scanner.rules))) for _ in range(rng.randint(0, 25))]
        kept = []
        for f in sorted(found, key=lambda f: (scanner.tiers[f.rule], -(f.stop - f.start), f.start, f.rule)):
            if not any(k.start <= f.start and f.stop <= k.stop for k in kept):
                kept.append(f)
        assert scanner.resolve(found) == sorted(kept, key=lambda f: (f.start, f.stop, f.rule))


def test_long_texts_and_empty_tables(spark, make):
    long = "licensed under the mit license " * 60_000 + "Cc-By-Nc"
    row = L.labelled(L.scan(make([long, "x" * 3_000_000, None]))).orderBy("doc_id").collect()
    assert (row[0]["n_words"], row[0]["n_base"], row[0]["first_word"], row[0]["last_word"], row[0]["labels"]) == (300_003, 60_001, 1, 300_000, "cc-by-nc,mit")
    assert (row[1]["n_words"], row[2]["n_words"], row[2]["labels"], row[2]["first_word"], row[2]["score"]) == (1, 0, "", None, 0.0)
    assert L.labelled(L.scan(make(["x"]).limit(0))).count() == 0


def test_all_columns_may_be_carried(spark, make):
    docs = make(["licensed under the isc license"])
    out = L.scan(docs, keep=docs.columns).collect()[0]
    assert out["row"]["score"] == "x" and out["row"]["doc_id"] == 0 and out["found"][0]["label"] == "isc"
