"""LM scoring against exact counts in plain Python."""

import math
import zlib
from collections import Counter

import numpy as np

from cindermill.llm import lm_scoring as lm


def tokens(text):
    return [w.lower() if w.isascii() else w for w in (text or "").encode().translate(lm.FOLD).decode().split(" ") if w] + ["</s>"]


def brute(rows):
    train = [t for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 10]
    c = Counter(w for t in train for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return {i: (len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t))) for i, t in rows}


def test_base_scores_and_counts(spark):
    rows = [(i, " ".join(f"w{(i * k) % 7}" for k in range(i % 9))) for i in range(60)] + [(100, None), (101, ""), (102, "Ä Hot hot HOT " * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    for hot in (3, 100_000):
        got = {r.doc_id: r for r in lm.scored(docs, max_hot=hot).collect()}
        for i, (n, known, total, base) in want.items():
            assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (n, known, total)
            assert math.isclose(got[i].base_score, base, rel_tol=1e-9, abs_tol=1e-9)
            assert got[i].held_out == (zlib.crc32(str(i).encode()) % 10 == 0)
            assert got[i].score <= 0


def test_filter_and_join_agree(spark):
    rows = [(i, " ".join(f"w{(i * k) % 11}" for k in range(20))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    a = {r.doc_id: r.score for r in lm.scored(docs).collect()}
    b = {r.doc_id: r.score for r in lm.scored(docs, max_bytes=0).collect()}
    assert all(abs(a[i] - b[i]) < 0.1 * abs(b[i]) for i in a)


def test_empty_table(spark):
    assert lm.scored(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_filter_gives_back_levels():
    grams = np.arange(1, 5001, dtype=np.uint64) * lm.M1
    q = 1 + np.arange(5000) % 5
    f = lm.Filter(np.zeros(20_000, np.uint64), 4)
    for level in range(1, 6):
        at = grams[q >= level]
        place, mask = lm.keys(at, level, f.size)
        np.bitwise_or.at(f.words, (lm.slice_of(at, 4) * np.uint64(f.size) + place).astype(np.int64), mask)
    assert (f.quantised(grams) >= q).all()  # never too low
    assert (f.quantised(grams) == q).mean() > 0.98
    assert (f.quantised(grams + np.uint64(1)) == 0).mean() > 0.98


def by_filter(rows, slices, size):
    """The scores by one filter built in plain numpy."""
    texts = [t for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 10]
    t = lm.Tokens(texts)
    grams, c = np.unique(np.concatenate([t.hashes[t.ids], t.pairs()[1]]), return_counts=True)
    f, q = lm.Filter(np.zeros(slices * size, np.uint64), slices), lm.quantised(c)
    for level in range(1, int(q.max()) + 1):
        place, mask = lm.keys(grams[q >= level], level, size)
        np.bitwise_or.at(f.words, (lm.slice_of(grams[q >= level], slices) * np.uint64(size) + place).astype(np.int64), mask)
    out, (n, v) = {}, (len(t.ids), len(t.words))
    end = np.array([lm.xxhash.xxh3_64_intdigest(lm.END)], np.uint64)
    for i, text in rows:
        t = lm.Tokens([text])
        word, pair = (lm.counted(f.quantised(x)) for x in (t.hashes[t.ids], t.pairs()[1]))
        before = np.concatenate([lm.counted(f.quantised(end)), word[:-1]])
        out[i] = float(lm.probability(pair, before, word, n, v).sum())
    return out


def test_filter_at_every_size(spark, monkeypatch):
    """Whatever the size, the scores are those of the filter, with its false positives."""
    rows = [(i, " ".join(f"w{(i * i + k * k * (i % 7)) % 997}" for k in range(40)) + (" only%d" % i) * (i % 2)) for i in range(200)] + [(300, None), (301, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    n = sum(len(tokens(t)) for i, t in rows if zlib.crc32(str(i).encode()) % 10)
    monkeypatch.setattr(lm, "SLICE", 1000)
    slices = -(-n // 1000)
    want = by_filter(rows, slices, max(16, -(-n * lm.BITS // 64 // slices)))
    for max_bytes in (0, 1 << 20):
        got = {r.doc_id: r.score for r in lm.scored(docs, max_bytes=max_bytes).collect()}
        assert got.keys() == want.keys()
        assert all(math.isclose(got[i], want[i], rel_tol=1e-9) for i in want)


def test_parts_hold_every_row(monkeypatch):
    monkeypatch.setattr(lm, "BLOCK", 10)
    for texts in ([None], ["a" * 50, "b"], ["a", None, "b" * 9, "c" * 30, "", "d"], ["x"] * 40):
        parts = lm.parts_of(texts)
        assert [i for a, b in parts for i in range(a, b)] == list(range(len(texts)))
        assert all(b - a == 1 or sum(len(t or "") + 1 for t in texts[a:b]) <= 10 for a, b in parts)


def test_few_false_positives():
    """Pairs seen once, as many as tokens, fill the filter most: 5 % of unseen ones are found."""
    grams = np.arange(1, 200_001, dtype=np.uint64) * lm.M1
    size = len(grams) * lm.BITS // 64
    f = lm.Filter(np.zeros(size, np.uint64), 1)
    place, mask = lm.keys(grams, 1, size)
    np.bitwise_or.at(f.words, place.astype(np.int64), mask)
    assert (f.quantised(grams + np.uint64(1)) > 0).mean() < 0.055
