"""The bootstrapped extraction against plain Python."""

import random
from collections import defaultdict
from math import exp, log

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from test_operators import plain_spans

from cindermill.llm import pii


def keys(m):
    _, _, _, instance, left, right, shape, exact, name = m
    out = {("b", left, shape, right), ("l", left, shape), ("r", shape, right), ("w", left, right), ("s", exact), ("g", shape), ("p", instance[:4], len(instance))}
    return out | ({("n", name, shape)} if name is not None else set())


def bootstrapped(texts):
    """All spans and secrets of every text: rounds over dictionaries instead of joins."""
    found = [pii.mentions(t or "", plain_spans(t or "")) for t in texts]
    holds, known = defaultdict(set), {}
    for m in (m for ms in found for m in ms):
        for k in keys(m):
            holds[k].add(m[3])
        if m[2] is not None:
            known[m[3]] = min(m[2], known.get(m[3], 9))
    seeds = dict(known)
    for _ in range(pii.ROUNDS):
        votes = defaultdict(float)
        for held in holds.values():
            for kind in range(5):
                n = sum(known.get(i) == kind for i in held)
                for i in held if n >= pii.SUPPORT else ():
                    own = known.get(i) == kind
                    confidence = (n - own) / (len(held) + 1 - own)
                    if n - own >= pii.SUPPORT and confidence >= pii.CONFIDENT:
                        votes[i, kind] += log(1 - confidence)
        best = {}
        for (i, kind), doubt in votes.items():
            best[i] = max(best.get(i, (0, -9)), (1 - exp(doubt), -kind))
        fresh = {i: -k for i, (score, k) in best.items() if score >= pii.ACCEPT}
        known = fresh | seeds
    spans, secrets = [], []
    for ms, t in zip(found, texts, strict=True):
        more = {(a, fresh[i], b) for a, b, k, i, *_ in ms if k in (None, pii.SECRET) and i in fresh and seeds.get(i, pii.SECRET) == pii.SECRET}
        write = lambda of: ",".join(f"{pii.ALL_KINDS[k]}:{a}:{b}" for a, k, b in sorted(of))
        spans.append(write({(a, k, b) for a, k, b in plain_spans(t or "")} | {x for x in more if x[1] != pii.SECRET}))
        secrets.append(write({x for x in more if x[1] == pii.SECRET}))
    return spans, secrets


def corpus():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(5))
    hexed = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    cards = [f"4{rng.randrange(10**15):015d}" for _ in range(400)]
    texts = [f"{word()} card {c} {word()}" for c in cards if pii.luhn(c)] + [f"{word()} 12.4.5.7 {c} {word()}" for c in cards if pii.luhn(c)][:6]
    texts += [f"{word()} {word()} password={hexed(18)} {word()}" for _ in range(60)] + [f"{word()} password=abcdefabcdefabc123 x"]
    texts += [f'{word()} {name} = "{hexed(18)}" {word()}' for name in ("token", "api") for _ in range(20)] + [f"{word()} 9f8e7d6c5b4a3f2e1d alone {word()}"]
    texts += [f"{word()} AKIA{''.join(rng.choice('ABCDEFGH2345') for _ in range(16))} {word()}" for _ in range(60)]
    texts += [f"{word()} +1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)} {word()}" for _ in range(20)]
    texts += [f"call +1 (555) 555-1234 {c} now" for c in cards[:3]] + [f"{word()} {rng.randrange(1000)} {rng.randrange(10**6)} {word()}" for _ in range(50)]
    return [*texts, None, "", "1" * 400, texts[0]]


def test_bootstrap_as_plain_python(spark):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in pii.digest(docs).collect()}
    want, secrets = bootstrapped(texts)
    assert [got[i].spans for i in range(len(texts))] == want
    assert [got[i].secrets for i in range(len(texts))] == secrets
    assert [got[i].n_added for i in range(len(texts))] == [len(list(filter(None, w.split(",")))) - len(plain_spans(t or "")) for w, t in zip(want, texts, strict=True)]
    assert dict(zip(texts, want, strict=True))["call +1 (555) 555-1234 " + texts_card(texts) + " now"].startswith("phone:5:22")
    by_text = dict(zip(texts, secrets, strict=True))
    assert by_text[next(t for t in texts if t and "abcdefabcdefabc123" in t)]
    assert not any(s for t, s in by_text.items() if t and not any(w in t for w in ("password", "AKIA", "token", "api", "alone")))
    assert all(bool(s) == (sum(map(str.isdigit, t)) >= 3) for t, s in by_text.items() if t and "AKIA" in t)  # fewer digits: no candidate


@pytest.mark.parametrize("tenth", [0, 3, 7])
def test_hidden_seeds_are_found(spark, tenth):
    """With a tenth of the given documents' seeds hidden, patterns find 9 of 10 of each kind but card, whose digits alone tell it from other numbers."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet", "/root/testdata/sf0.1/documents.parquet")
    m = pii.found(docs).select(F.explode("mentions").alias("m")).select("m.*").persist()
    seeds = m.where("kind is not null").groupBy("instance").agg(F.min("kind").alias("kind"))
    tenths = seeds.withColumn("tenth", F.ntile(10).over(Window.partitionBy("kind").orderBy(F.xxhash64("instance"))))
    hidden = {r.instance: r.kind for r in tenths.where(F.col("tenth") == tenth + 1).collect()}
    hide = F.col("instance").isin(list(hidden))
    got = {r.instance: r.kind for r in pii.accepted(pii.edges_of(m.withColumn("kind", F.when(~hide, F.col("kind"))))).collect()}
    m.unpersist()
    for kind in (0, 1, 3, pii.SECRET):
        of = [i for i, k in hidden.items() if k == kind]
        assert len(of) >= 5 and sum(got.get(i) == kind for i in of) >= 0.9 * len(of)
    assert not any(got.get(i, k) != k for i, k in hidden.items())
    assert not any(i.isdigit() for i in got)  # 16-digit numbers, of which half fail the card's check digit


def texts_card(texts):
    return next(t for t in texts if t and t.startswith("call")).split()[4]


@pytest.mark.parametrize(("text", "shape", "exact"), [("+1 (017) 555-77", "+9 (9) 9-9", "+91 (93) 93-92"), ("a1b2", "x", "x4"), ("é1", "x", "x2"), ("ab.cd12", "a.x", "a.x4")])
def test_shapes(text, shape, exact):
    assert (pii.shape(text), pii.shape(text, lengths=True)) == (shape, exact)
