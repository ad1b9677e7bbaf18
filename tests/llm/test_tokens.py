"""Token frames, packing and merge-dropout against the libraries, with odd texts, null and repeated rows."""

import io
import inspect
import zlib
from collections import Counter

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
P = pytest.importorskip("public_tokenizers")

from hypothesis import given, settings
from hypothesis import strategies as st

from emberlog.llm import frames, packing, pieces
from emberlog.llm.tokens import Encoder

TEXTS = [
    "a. b, c. d.", "x.. y", "a., b", "a_. b", "naïve.\nÉté, x.\n\ny", "c²., d². e", "a.\nb,\nc", "x.\n", "don't, it's. No", "a\t \nb", " x", "x ",
    "a  b", "", None, " ", "Á ́x ΑΣ ΣΑ", "<|endoftext|> a <|endoftext|>b", "\x1c a \x1c b", "word " * 3000, "x" * 9000, "a\x01b c", "日本 語", "a▁b ▁ c",
]


@pytest.fixture(scope="module", params=[("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def pair(request):
    path = P.path(request.param[0])
    return Encoder(path, request.param[1]), tokenizers.Tokenizer.from_file(path)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_library(pair):
    own, library = pair
    for text, got in zip(TEXTS, own.encode(TEXTS), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == ids_of(library, text), text


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab.,'1 \n\té²_Σ", max_size=30))
def test_encoder_equals_library_on_any_text(text):
    for name, spaced in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        own = ENCODERS.setdefault(name, Encoder(P.path(name), spaced, most=50))
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == ids_of(own.tokenizer, text)


ENCODERS: dict = {}


def test_frame_file_reads_single_documents_and_finds_damage():
    out = io.BytesIO()
    w = frames.FrameWriter(out)
    docs = {None: b"", 7: b"abcd" * 5, -3: b"wxyz"}
    for k, v in docs.items():
        w.add(k, v)
    w.close()
    r = frames.FrameReader(out)
    assert {r.doc_id(k): r.ids(k) for k in range(len(r))} == docs
    import zstandard

    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True).read()
    assert whole == b"".join(docs.values())
    broken = bytearray(out.getvalue())
    broken[int(r.places[1]) + 8] ^= 255
    with pytest.raises(Exception):
        frames.FrameReader(io.BytesIO(bytes(broken))).ids(1)


def test_token_files_round_trip(spark, make):
    library = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows = [(i * 3 - 20, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (5, "again"), (5, "again")]
    files = frames.write(make(rows).repartition(3), P.path("byte_bpe_50k.json"), end_id=2)
    got = frames.scan(files, with_ids=True).collect()
    assert len(got) == len(rows)
    start = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == start and zlib.crc32(r["ids"]) == r["ids_crc32"]
        start += r["n_tokens"]
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])] == [None, *sorted(i for i, _ in rows if i is not None)]
    want = Counter((i, *ids_of(library, t), 2) for i, t in rows)
    assert Counter((r["doc_id"], *np.frombuffer(r["ids"], "<u4").tolist()) for r in got) == want


def test_no_documents_no_files(spark, make):
    files = frames.write(make([]), P.path("byte_bpe_50k.json"), end_id=2)
    assert files.files == [] and frames.scan(files).count() == 0


def check_packed(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(by) == list(range(len(by)))
    return len(by)


def test_packing_of_documents(spark, make):
    library = tokenizers.Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = [*enumerate(TEXTS), (None, "no id"), (5, "again and"), (5, "again and"), *((100 + i, "one two three " * (i % 40)) for i in range(120))]
    packed = packing.pack(make(rows).repartition(3), P.path("word_bpe_49k.json"), end_id=0, capacity=64, with_ids=True)
    got = packed.collect()
    n = check_packed(got, 64)
    assert n <= -(-sum(r["length"] for r in got) // 64) + 2
    want = Counter()
    for i, t in rows:
        ids = [*ids_of(library, t), 0]
        for k in range(0, len(ids), 64):
            want[i, k // 64, k, *ids[k : k + 64]] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], *np.frombuffer(r["ids"], "<u4").tolist()) for r in got) == want
    joined = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert joined[r["sequence_id"]][4 * r["offset"] : 4 * (r["offset"] + r["length"])] == r["ids"]
    assert packing.pack(make([]), P.path("word_bpe_49k.json"), end_id=0).count() == 0


def plain_best_fit(lengths, capacity):
    """One piece at a time: large ones pair greedily, then longest first into the least room."""
    large = sorted(n for n in lengths if 3 * n > capacity)
    rooms = []
    while large:
        a = large.pop()
        fit = [k for k, n in enumerate(large) if n <= capacity - a]
        rooms.append(capacity - a - (large.pop(fit[-1]) if fit else 0))
    for n in sorted((n for n in lengths if 3 * n <= capacity), reverse=True):
        fits = [k for k, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=lambda k: rooms[k])] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=120))
def test_plan_over_counts_equals_plan_over_pieces(lengths):
    counts = Counter(lengths)
    runs = packing.plan(counts, 30)
    rows, ranks = [], Counter()
    for length, rank, n, first, offset in runs:
        assert rank == ranks[length]
        ranks[length] += n
        rows += [{"sequence_id": first + k, "offset": offset, "length": length} for k in range(n)]
    assert ranks == counts
    assert check_packed(rows, 30) == plain_best_fit(lengths, 30)


def scalar_merges(coder, word, key, limit):
    """The same agenda for one word, one merge at a time."""
    from emberlog.llm.common import mix

    sym, place = [int(coder.of_char[ord(c)]) for c in word], list(range(len(word)))
    table = dict(zip(coder.pairs.tolist(), zip(coder.ranks.tolist(), coder.merged.tolist(), strict=True), strict=True))
    while True:
        best = None
        for k in range(len(sym) - 1):
            if (found := table.get(sym[k] << 21 | sym[k + 1])) and (best is None or found[0] < best[0]):
                x = mix(np.array([key], np.uint64) ^ mix(np.array([found[0] << 24 | place[k]], np.uint64), 12), 13)[0]
                if not limit or int(x) >= limit:
                    best = (found[0], k, found[1])
        if best is None:
            return sym
        _, k, merged = best
        sym[k : k + 2], place[k : k + 2] = [merged], [place[k]]


def test_merge_dropout():
    import sentencepiece
    import xxhash

    path = P.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    plain, drop = pieces.PieceCoder(path, 0.0, 1, 1), pieces.PieceCoder(path, 0.3, 7, 3)
    odd = [*TEXTS, "é́ ﬁ", "​b \x00c", "▁", "  ▁ x▁▁y \n"]
    for text, a, b in zip(odd, plain.encode(odd, [1] * len(odd)), drop.encode(odd, [None, *range(len(odd) - 1)]), strict=True):
        if "▁" not in (text or ""):
            assert np.frombuffer(a, "<u4").tolist() == library.encode(text or "")
        assert plain.decode(a) == drop.decode(b) == (text or "")
    words = ["▁understanding", "▁the", "▁representation", "▁aaaaaaa", "▁ononon"]
    for v in range(3):
        for w, got in zip(words, drop.units(words, v), strict=True):
            key = xxhash.xxh3_64_intdigest(w.encode(), 7 * 1_000_003 + v)
            assert np.frombuffer(got, "<u4").tolist() == scalar_merges(drop, w, key, drop.limit)
    assert len({drop.encode(["representation understanding " * 9], [d])[0] for d in range(20)}) > 1


def test_each_occurrence_has_its_own_agenda():
    path = P.path("piece_bpe_32k.model")
    drop = pieces.PieceCoder(path, 0.3, 7, most=60)  # cuts are forgotten and made again
    texts = ["the representation of understanding aaaaaaa ▁ " * 9, "x" * 70 + " onononon", "", None, "the " * 60]
    for _ in range(2):
        got = drop.encode(texts, [5, None, 1, 2, 2**40])
        for text, doc_id, ids in zip(texts, [5, None, 1, 2, 2**40], got, strict=True):
            words = drop._words(text) if text else []
            want = []
            for w, key in zip(words, drop._keys(len(words), doc_id).tolist(), strict=True):
                want += np.frombuffer(drop.sign, "<u4").tolist() if w == pieces._SIGN else scalar_merges(drop, w, key, drop.limit)
            assert np.frombuffer(ids, "<u4").tolist() == want and drop.decode(ids) == (text or "")
    cuts = set(drop.occurrences(["▁representation"] * 500, drop._keys(500, 3)))
    assert len(cuts) > 20
    assert inspect.signature(pieces.encode).parameters["variants"].default == 0


def test_coding_in_spark(spark, make):
    path = P.path("piece_bpe_32k.model")
    rows = [*enumerate(TEXTS), (None, "no id"), (1, TEXTS[1]), (1, TEXTS[1])]
    got = pieces.decode(pieces.encode(make(rows).repartition(2), path, dropout=0.2, seed=3), path).collect()
    assert len(got) == len(rows) and all(r["decoded"] == (r["text"] or "") for r in got)
    again = pieces.encode(make(rows), path, dropout=0.2, seed=3).collect()
    other = pieces.encode(make(rows), path, dropout=0.2, seed=4).collect()
    key = lambda rows: Counter((r["doc_id"], r["ids"]) for r in rows)
    assert key(got) == key(again) != key(other)
    assert pieces.encode(make([]), path).count() == 0


@given(st.lists(st.sampled_from(["▁", "\x00", "sign", "\x00sign", " ", "the ", "é", "\ud800", "日本", "\n", "a"]), max_size=12).map("".join), st.sampled_from([0, 3]))
@settings(max_examples=150, deadline=None)
def test_any_text_comes_back(text, variants):
    code = pieces.coder(P.path("piece_bpe_32k.model"), 0.3, 5, variants)
    assert code.decode(code.encode([text], [9])[0]) == text


def test_cuts_of_many_skipped_merges_are_not_cached(monkeypatch):
    """Occurrences that skip more are merged by their own hashes, to the same ids."""
    import numpy as np
    import public_tokenizers

    import emberlog.llm.pieces as P

    words = [P.SPACE + w for w in ("international", "understanding", "of", "a", "counterrevolutionaries") * 60]
    keys = np.arange(len(words), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    own = P.PieceCoder(public_tokenizers.path("piece_bpe_32k.model"), 0.3, 1)
    want = own._merge(words, keys)
    for deep in (0, P.DEEP, 40):
        monkeypatch.setattr(P, "DEEP", deep)
        code = P.PieceCoder(public_tokenizers.path("piece_bpe_32k.model"), 0.3, 1)
        assert code.occurrences(words, keys) == want
        assert max(len(codes) for _, codes in code.of) <= deep
