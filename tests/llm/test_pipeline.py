"""The quality verdicts and the whole pipeline against plain Python."""

import math
import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from conftest import SCHEMA, prose, rows
from pyspark.sql import functions as F
from test_jaccard_cases import plain
from tokenizers import Tokenizer

from cindermill.llm import quality, token_counts

SPACE = r"[^\x20\x09-\x0D]+"


def plain_votes(text):
    """Votes and whether the base check fails, by regular expressions."""
    words, text = re.findall(SPACE, text or ""), text or ""
    n = len(words)
    grams = [tuple(words[k : k + 3]) for k in range(n - 2)]
    often = Counter(grams)
    repeats = len({k + j for k, g in enumerate(grams) if often[g] > 1 for j in range(3)})
    failed = n < 50 or 100 * repeats > 50 * n
    if not n:
        return (0,) * 9, failed
    lines = [x for x in text.split("\n") if re.search(SPACE, x)]
    symbols, upper, marks = len(re.findall(r"[#*$%&|<>]", text)), sum(w.encode().isupper() for w in words), text.count("!")
    junk = [symbols >= 0.1 * n, repeats >= 0.3 * n, upper >= 0.3 * n, n >= 50 and len(set(words)) <= 0.2 * n, marks >= 0.15 * n, text.count("|") >= 0.08 * n, len(lines) >= 4 and len(lines) - len(set(lines)) >= 0.5 * len(lines)]
    clean = symbols <= 0.02 * n and upper <= 0.2 * n and marks <= 0.05 * n and repeats <= 0.25 * n
    return (*(-int(x) for x in junk), int(clean), int(sum(map(text.count, ".?!")) >= 0.02 * n and 3 * n <= sum(map(len, words)) <= 9 * n)), failed


def plain_posteriors(votes):
    """Expectation-maximisation document by document, with dictionaries."""
    share, p = quality.PRIOR, {}
    for i, rule in enumerate(quality.RULES):
        for good in (0, 1):
            if rule in quality.GOOD_RULES:
                speaks = quality.RIGHT_GOOD if good else 0.5
                p[i, good] = {-1: 1e-6, 0: 1 - speaks, 1: speaks}
            else:
                speaks = quality.WRONG if good else quality.RIGHT_JUNK
                p[i, good] = {-1: speaks, 0: 1 - speaks, 1: 1e-6}

    def good_of(v):
        odds = math.log(share / (1 - share)) + sum(math.log(p[i, 1][x] / p[i, 0][x]) for i, x in enumerate(v))
        return 1 / (1 + math.exp(-odds))

    for _ in range(quality.ROUNDS):
        g = [good_of(v) for v in votes]
        share = min(0.99, max(0.01, sum(g) / len(g)))
        for i in range(len(quality.RULES)):
            for good in (0, 1):
                seen = {k: quality.SMOOTH for k in (-1, 0, 1)}
                for v, x in zip(votes, g, strict=True):
                    seen[v[i]] += x if good else 1 - x
                total = sum(seen.values())
                p[i, good] = {k: x / total for k, x in seen.items()}
    return [good_of(v) for v in votes]


def plain_good(docs):
    votes = [plain_votes(t) for _, t in docs]
    return [not failed and x >= 0.5 for (_, failed), x in zip(votes, plain_posteriors([v for v, _ in votes]), strict=True)]


def plain_lines(docs, least=50):
    """Texts less the runs of lines that occurred before; None for documents left with nothing."""
    runs, order = defaultdict(set), sorted({d for d in docs if d[1] is not None}, key=lambda d: (d[0] is not None, d[0] or 0))
    place = {}
    for d in order:
        lines = [(i, x, len(re.findall(SPACE, x))) for i, x in enumerate(d[1].split("\n")) if re.search(SPACE, x)]
        ends = set()
        for s in range(len(lines)):
            total = 0
            for e in range(s, len(lines)):
                total += lines[e][2]
                if total >= least:
                    ends.add((s, e))
                    break
        for e in range(len(lines)):
            total = 0
            for s in range(e, -1, -1):
                total += lines[s][2]
                if total >= least:
                    ends.add((s, e))
                    break
        for s, e in ends:
            runs[tuple(x for _, x, _ in lines[s : e + 1])].add((order.index(d), s, e))
        place[d] = [i for i, _, _ in lines]
    gone = defaultdict(set)
    for at in runs.values():
        for k, s, e in sorted(at)[1:]:
            gone[order[k]] |= set(place[order[k]][s : e + 1])
    out = []
    for d in docs:
        text = d[1]
        if d in gone:
            text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone[d])
            text = text if re.search(SPACE, text) else None
            if text is None:
                continue
        out.append((d[0], text))
    return out


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_clean(docs, items):
    windows = {tuple(w[k : k + 10]) for w in map(words_of, items) if w for k in range(max(1, len(w) - 9))}
    sizes = {len(w) for w in windows}
    return [d for d in docs if not any(tuple(w[k : k + n]) in windows for w in [words_of(d[1])] for n in sizes for k in range(len(w) - n + 1))]


def plain_one_of_each(docs):
    """The row of the least id of each component; ids are distinct here but for repeated rows."""
    kept, known = [], sorted({d for d in docs if d[0] is not None})
    least = {i: c for i, _, c in plain([(i, t or "") for i, t in known])}
    for d in known:
        if least[d[0]] == d[0]:
            kept.append(d)
    return kept + [d for d in docs if d[0] is None]


def texts():
    """The hard rows, with documents long and plain enough to stay, copies, shared passages and benchmark text."""
    rng = random.Random(11)
    sentence = lambda: " ".join(prose(rng, 10).split()).replace(",", "") + "."
    long = lambda n: "\n".join(" ".join(sentence() for _ in range(2)) for _ in range(n))
    passage = long(4)
    out = [(1000 + i, long(6)) for i in range(30)]
    out += [(1100 + i, f"{long(3)}\n{passage}\n{long(3)}") for i in range(5)]
    out += [(1200, out[0][1] + " and more"), (1201, out[0][1].replace("word1 ", "word2 ", 1)), (1202, passage), (1203, long(5) + "\nthe capital of France is the city of Paris they say\n" + long(2))]
    out += [(1300 + i, "BUY NOW !!! $$$ | # " * 30 + str(i)) for i in range(6)] + [(1400, out[3][1])] * 2 + [(None, long(6))]
    return rows() + out


BENCHMARK = [("b1", "The capital of France is the city of Paris, they say."), ("b2", None), ("b3", "")]


def save(spark, folder, documents, **extra):
    docs = spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in documents], SCHEMA).withColumns({c: F.lit(v) for c, v in extra.items()})
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(BENCHMARK, "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_quality_verdicts(spark):
    documents = texts()
    votes = [plain_votes(t) for _, t in documents]
    want = plain_posteriors([v for v, _ in votes])
    got = quality.judged(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(documents)], "doc_id long, text string").repartition(3)).collect()
    assert len(got) == len(documents)
    for r in got:
        assert (tuple(r.votes), r.base_failed) == votes[r.doc_id]
        assert math.isclose(r.quality, want[r.doc_id], abs_tol=1e-6)
        assert r.kept == (not r.base_failed and want[r.doc_id] >= 0.5)


@pytest.mark.parametrize("extra", [{}, {"id": "x", "h": "x", "component": "x", "kept": "x", "spans": "x"}])
def test_pipeline(spark, tmp_path, extra):
    documents = texts()
    left = [d for d, good in zip(documents, plain_good(documents), strict=True) if good]
    assert 20 < len(left) < len(documents)
    left = plain_lines(left)
    left = plain_one_of_each(left)
    left = plain_clean(left, [t for _, t in BENCHMARK])
    t = Tokenizer.from_file(token_counts.public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for i, text in left:
        n = len(t.encode(text or "", add_special_tokens=False).ids) + 1
        want.update((i, piece, at, min(2048, n - at)) for piece, at in enumerate(range(0, n, 2048)))
    got = corpus_pipeline.run(spark, save(spark, tmp_path, documents, **extra)).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for placed in places.values():
        ends = [0, *(a + n for a, n in sorted(placed))]
        assert [a for a, _ in sorted(placed)] == ends[:-1] and ends[-1] <= 2048


def test_pipeline_without_rows(spark, tmp_path):
    assert corpus_pipeline.run(spark, save(spark, tmp_path, [])).collect() == []
    only = [(1, None), (2, ""), (None, None), (3, "one")]
    (tmp_path / "only").mkdir()
    assert corpus_pipeline.run(spark, save(spark, tmp_path / "only", only)).collect() == []
