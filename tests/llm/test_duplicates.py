"""Near-duplicates, repeated passages and lines against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from emberlog.llm import common, fmindex, jaccard, lines, repeats, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def vocabulary(seed, n=400):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    r, vocab = random.Random(4), vocabulary(4)
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    docs = [text(r.randint(1, 120)) for _ in range(60)]
    base, passage = text(90), text(50)
    for _ in range(40):  # near copies of one text
        w = base.split()
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = r.choice(vocab)
        docs.append(" ".join(w))
    docs += [base] * 12 + [f"{text(20)} {passage} {text(20)}" for _ in range(30)]
    docs += ["a b c " * 40, "x " * 100, "one two three four five six seven " * 6, "short", "", None, " \n\t ", text(4000)]
    docs += [docs[3]] * 3
    return docs


def links_of(docs, width=5, threshold=0.8):
    sets = []
    for t in docs:
        w = WORD.findall(t or "")
        sets.append({tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1 if w else 0))})
    n, near, label = len(docs), Counter(), list(range(len(docs)))
    for a in range(n):
        for b in range(a + 1, n):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
                near[a] += 1
                near[b] += 1
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    return {i: (label[i], near[i]) for i in range(n)}


@pytest.mark.parametrize("small", [1000, 8])
def test_near_duplicates(make, corpus, monkeypatch, small):
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "CELL", max(small // 2, 3))
    got = jaccard.near_duplicates(make(corpus).repartition(3)).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in got} == links_of(corpus)
    assert len(got) == len(corpus)


def test_one_document_of_each_class(make, corpus):
    want = {i for i, (c, _) in links_of(corpus).items() if i == c}
    kept = jaccard.one_of_each(make(corpus))
    assert {r["doc_id"] for r in kept.collect()} == want and kept.columns == make(corpus).columns
    twice = make([(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (None, "a b c d e f g"), (None, "zz yy")])
    assert sorted(((r["doc_id"], r["text"]) for r in jaccard.one_of_each(twice).collect()), key=str) == [(1, "a b c d e f g"), (None, "a b c d e f g"), (None, "zz yy")]
    assert jaccard.near_duplicates(make([])).count() == jaccard.one_of_each(make([])).count() == 0


def stripped(docs, window):
    parts = [WORD.findall(t or "") for t in docs]
    count = Counter(tuple(w[i : i + window]) for w in parts for i in range(len(w) - window + 1))
    out = []
    for w in parts:
        keep = [True] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                keep[i : i + window] = [False] * window
        kept = [x for x, k in zip(w, keep, strict=True) if k]
        out.append((len(w), len(w) - len(kept), " ".join(kept)))
    return out


@pytest.mark.parametrize(("shard", "hot"), [(400_000, 100_000), (300, 100), (400_000, 0)])
def test_repeated_passages(make, corpus, monkeypatch, shard, hot):
    """Few and many shards, and windows counted for every anchor."""
    monkeypatch.setattr(repeats, "SHARD", shard)
    monkeypatch.setattr(repeats, "HOT", hot)
    got = {r["row"]["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in repeats.without_repeats(make(corpus).repartition(3)).collect()}
    assert got == dict(enumerate(stripped(corpus, 35)))


def test_repeats_of_repeated_and_null_rows(make):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (1, text), (None, "lone " + text), (None, None)]
    got = sorted((str(r["row"]["doc_id"]), r["n_removed"], r["kept"]) for r in repeats.without_repeats(make(rows)).collect())
    assert got == [("1", 40, ""), ("1", 40, ""), ("None", 0, ""), ("None", 40, "lone")]
    assert repeats.without_repeats(make([])).count() == 0


def test_index_against_counting():
    rng = np.random.default_rng(3)
    for _ in range(80):
        window, kinds = int(rng.integers(2, 7)), int(rng.integers(2, 6))
        texts = [rng.integers(0, kinds, rng.integers(1, 40)).astype(np.uint64) for _ in range(int(rng.integers(1, 12)))]
        weights = rng.integers(1, 3, len(texts))
        count = Counter()
        for t, c in zip(texts, weights, strict=True):
            for i in range(len(t) - window + 1):
                count[tuple(t[i : i + window])] += c
        first = np.r_[0, np.cumsum([len(t) for t in texts])]
        for t, spans in zip(texts, fmindex.repeated_spans(np.concatenate(texts), first, weights, window), strict=True):
            got, want = np.zeros(len(t), bool), np.zeros(len(t), bool)
            for a, b in spans:
                got[a:b] = True
            for i in range(len(t) - window + 1):
                if count[tuple(t[i : i + window])] > 1:
                    want[i : i + window] = True
            assert (got == want).all()


def test_words_of_odd_texts():
    import pyarrow as pa

    texts = ["a b  c", "", None, "\tx\n\x0b y ", "é ü z", "a b c d", "w" * 3_000_000 + " tail", " "]
    w = words.words_of(pa.array(texts))
    for k, t in enumerate(texts):
        assert [bytes(w.data[w.starts[i] : w.ends[i]]).decode() for i in w.text(k)] == WORD.findall(t or "")
    assert w.hashes[w.first[0]] == w.hashes[w.first[5]] and w.first[-1] == len(w.hashes)


def simhash(line):
    """63 majorities over the words' hashes, in parts of 127 as the operator votes."""
    import xxhash

    votes = [(xxhash.xxh64_intdigest(x.encode(), 42)) >> 1 for x in line.split(" ")]
    first = True
    while first or len(votes) > 1:
        first = False
        new = []
        for a in range(0, len(votes), 127):
            part = votes[a : a + 127]
            new.append(sum(1 << b for b in range(63) if sum(v >> b & 1 for v in part) > len(part) // 2))
        votes = new
    return votes[0]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.fixture(scope="module")
def lined():
    r, vocab = random.Random(9), vocabulary(9, 300)
    line = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    common_line, long = line(30), line(700)
    docs = ["\n".join(line(r.randint(1, 25)) for _ in range(r.randint(1, 5))) for _ in range(25)]
    for k in range(25):
        w = common_line.split()
        if k % 3:
            w[r.randrange(30)] = r.choice(vocab)
        docs.append(f"{line(8)}\n{' '.join(w).upper() if k % 4 == 0 else '  '.join(w) + '!'}\n\n{line(6)}")
    docs += ["ab " * k for k in range(5, 40)]  # one hash, many lengths
    return [*docs, long, long.replace("a", "A") + " more", "", None, "\n", docs[0], "too few words"]


def kept_lines(docs, least=0.8):
    rows = []
    for i, t in enumerate(docs):
        for k, raw in enumerate((t if t is not None else "").split("\n") if t is not None else []):
            norm = re.sub(r"[\W_]+", " ", raw.lower()).strip(" ")
            if len(norm.split(" ")) >= 5:
                rows.append((i, k, norm))
    kinds = sorted({n for *_, n in rows})
    h = {n: simhash(n) for n in kinds}
    label = {n: n for n in kinds}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(kinds)):
        for b in range(a):
            x, y = kinds[a], kinds[b]
            if bin(h[x] ^ h[y]).count("1") <= 3 and distance(x, y) <= int((1 - least) * max(len(x), len(y)) + 1e-9):
                label[root(x)] = root(y)
    first = {}
    for i, k, n in rows:
        first.setdefault(root(n), (i, k))
    gone = {(i, k) for i, k, n in rows if first[root(n)] != (i, k)}
    return {i: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in enumerate(docs)}, len(gone)


def test_similar_lines(make, lined):
    want, gone = kept_lines(lined)
    got = lines.without_similar_lines(make(lined).repartition(3)).collect()
    assert {r["row"]["doc_id"]: r["text"] for r in got} == want
    assert sum(r["n_removed"] for r in got) == gone > 30


@pytest.mark.parametrize("order", [(28, 34, 35, 43), (43, 35, 34, 28), (35, 28, 43, 34)])
def test_links_through_followers(make, order):
    docs = ["ab " * k for k in order]  # a chain of lengths, two of them in one length class
    got = lines.without_similar_lines(make(docs)).collect()
    assert sum(r["n_removed"] for r in got) == 3


@pytest.mark.parametrize("block", [2, 256])
def test_links_of_one_hash_against_all_pairs(make, monkeypatch, block):
    monkeypatch.setattr(lines, "BLOCK", block)
    r = random.Random(5)
    bag, docs = vocabulary(5, 6), []
    for k in sorted(r.sample(range(5, 300), 45)):  # gaps in the lengths
        docs.append("ab " * k)
    for _ in range(40):  # one hash, mostly not similar
        w = bag * 2
        r.shuffle(w)
        docs.append(" ".join(w))
    r.shuffle(docs)
    want, gone = kept_lines(docs)
    got = lines.without_similar_lines(make(docs)).collect()
    assert {x["row"]["doc_id"]: x["text"] for x in got} == want and sum(x["n_removed"] for x in got) == gone > 10


def test_near_copies_do_not_all_meet(make, monkeypatch):
    """Copies with one changed word have many close hashes; leaders connect them, so their pairs are not listed."""
    r, vocab = random.Random(8), vocabulary(8, 200)
    base = [r.choice(vocab) for _ in range(101)]
    docs = [" ".join(base)]
    for k in range(80):
        w = list(base)
        w[r.randrange(101)] = f"new{k}"
        docs.append(" ".join(w))
    listed, keep = {}, lines.stage

    def counted(df, name="stage"):
        out = keep(df, name)
        listed[name] = listed.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(lines, "stage", counted)
    assert sum(x["n_removed"] for x in lines.without_similar_lines(make(docs)).collect()) > 20
    assert listed["meetings"] <= len(docs)


def test_lines_of_repeated_and_null_rows(make):
    text = "one two three four five\nanother line of five words"
    got = lines.without_similar_lines(make([(4, text), (4, text), (2, text), (None, None)])).collect()
    assert sorted((str(r["row"]["doc_id"]), r["text"]) for r in got) == [("2", text), ("4", ""), ("4", ""), ("None", None)]
    assert lines.without_similar_lines(make([])).count() == 0


def test_copies_of_short_lines(make):
    docs = ["Home\n\n一二三四五六七八九十\none two", "home!\n\n一二三四五六七八九十\nOne  two.\none three", "\nhome", None]
    got = lines.without_similar_lines(make(docs), short_copies=True).collect()
    assert {r["row"]["doc_id"]: (r["text"], r["n_removed"]) for r in got} == {0: (docs[0], 0), 1: ("\none three", 3), 2: ("", 1), 3: (None, 0)}
    assert sum(r["n_removed"] for r in lines.without_similar_lines(make(docs)).collect()) == 0


def test_line_plan_has_no_python(make, lined):
    done = lines.without_similar_lines(make(lined))
    plan = done._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_close_hashes_against_all_pairs(spark):
    r = random.Random(1)
    base = [r.getrandbits(63) for _ in range(40)]
    values = sorted({b ^ sum(1 << r.randrange(63) for _ in range(r.randint(0, 4))) for b in base for _ in range(8)})
    got = lines.close_hashes(spark.createDataFrame([(v,) for v in values], "h long")).collect()
    want = {(a, b) for a in values for b in values if a < b and bin(a ^ b).count("1") <= 3}
    assert len(got) == len(want) and {(x["h"], x["g"]) for x in got} == want


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (5, 5), (3, 2), *((100 + i, 101 + i) for i in range(300))]
    got = {r["node"]: r["root"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[k] for k in (1, 2, 3, 4)} == {1} and {got[k] for k in (7, 8, 9)} == {7} and got[5] == 5
    assert {got[100 + i] for i in range(301)} == {100}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_kept_text_digest(make, corpus):
    from pyspark.sql import functions as F

    done = repeats.without_repeats(make(corpus)).select("row.doc_id", F.sha2("kept", 256).alias("s")).collect()
    want = stripped(corpus, 35)
    assert all(r["s"] == hashlib.sha256(want[r["doc_id"]][2].encode()).hexdigest() for r in done)


def test_similar_pairs_against_distances(spark):
    """Any mix of replaced, inserted, dropped and moved words, and characters of several bytes."""
    r, vocab = random.Random(12), [*vocabulary(12, 60), "où", "größe", "一二", "x"]
    pairs = []
    for _ in range(150):
        x = [r.choice(vocab) for _ in range(r.randint(1, 40))]
        y = list(x)
        for _ in range(r.randint(0, 6)):
            k = r.randrange(len(y) + 1)
            y[k : k + r.randint(0, 1)] = [r.choice(vocab) for _ in range(r.randint(0, 2))]
        y = y if r.random() < 0.9 else r.sample(y, len(y))
        if x != y and y:
            pairs.append((" ".join(x), " ".join(y)))
    got = lines.keep_similar(spark.createDataFrame(pairs, "a string, b string"), "a", "b", 0.8).collect()
    want = {p: distance(*p) <= int(0.2 * max(map(len, p)) + 1e-9) for p in pairs}
    assert {(x["a"], x["b"]): x["same"] for x in got} == want and 20 < sum(want.values()) < len(want) - 20


def test_lines_are_split_once_for_a_comparison(spark):
    rows = lines.keep_similar(spark.createDataFrame([("a b", "a c")], "a string, b string"), "a", "b", 0.8).filter("same")
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("split(") == 2


def test_hashes_are_shuffled_once_to_find_close_ones(spark):
    close = lines.with_close(spark.createDataFrame([(1,), (3,), ((1 << 40) - 1,)], "h long").repartition(2))
    assert sorted(x["h"] for x in close.collect()) == [1, 3]
    assert "ReusedExchange" in close._jdf.queryExecution().executedPlan().toString()
