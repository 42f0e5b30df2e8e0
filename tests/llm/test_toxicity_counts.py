"""The choice of words and the risk's gradient against plain versions."""

import math
import random

import numpy as np
import pytest

from cindermill.llm import toxicity


def risk(w, b, positive, unlabelled, prior):
    """The two parts of the risk, text by text."""
    g = lambda row: sum(w[i] for i in row) + b
    mean = lambda rows, sign: sum(math.log1p(math.exp(sign * g(r))) for r in rows) / len(rows)
    return prior * mean(positive, -1), mean(unlabelled, 1) - prior * mean(positive, 1)


@pytest.mark.parametrize("prior", [0.1, 0.95])
def test_gradient_is_the_risks(prior):
    """By differences; where the negative part is below 0 its gradient alone, reversed."""
    rng = random.Random(3)
    positive = [[i for i in range(5) if rng.random() < 0.7] for _ in range(20)]
    unlabelled = [[i for i in range(5) if rng.random() < 0.2] for _ in range(30)]
    w, b = np.array([0.5, 1.0, -0.3, 0.8, 0.2]), 0.4
    rows = positive + unlabelled
    at, word = np.array([(i, x) for i, r in enumerate(rows) for x in r]).T
    got, bias = toxicity.gradient(w, b, at, word, np.arange(len(rows)) < len(positive), prior)
    one, two = risk(w, b, positive, unlabelled, prior)
    assert (two < 0) == (prior > 0.5)
    value = lambda w, b: sum(risk(w, b, positive, unlabelled, prior)) if two >= 0 else -risk(w, b, positive, unlabelled, prior)[1]
    step = 1e-5
    want = [(value(w + step * e, b) - value(w - step * e, b)) / (2 * step) for e in np.eye(5)]
    assert np.allclose(got, want, atol=1e-7)
    assert abs(bias - (value(w, b + step) - value(w, b - step)) / (2 * step)) < 1e-7


def test_words_are_chosen_by_all_rows(spark, monkeypatch):
    """Plain counts over all rows: repeated, null and empty texts count; a word that is rare in the positives is not chosen."""
    rng = random.Random(4)
    common, bad = [f"plain{c}word" for c in "abcdefghij"], ["vilest", "wretch", "wretched", "fools"]
    corpus = [" ".join(rng.choice(common) for _ in range(8)) for _ in range(400)] + [None, "", "plainaword"] * 3
    positive = [f"{rng.choice(bad)} {rng.choice(bad)} {rng.choice(common)}" for _ in range(60)] + ["seldom vilest"] * 2 + [None]
    corpus += positive
    frame = lambda texts: spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    held = lambda texts, w: sum(w in toxicity.features(t) for t in texts)
    score = {}
    for w in {w for t in positive for w in toxicity.features(t)}:
        p, n = held(positive, w), held(corpus, w)
        rate_p, rate_u = (p + 0.5) / (len(positive) + 1), (n + 0.5) / (len(corpus) + 1)
        if p >= max(toxicity.MIN_DOCUMENTS, toxicity.MIN_SHARE * len(positive)) and rate_p >= toxicity.MIN_RATIO * rate_u:
            score[w] = abs(math.sqrt(rate_p) - math.sqrt(rate_u))
    want = sorted(score, key=lambda w: (-round(score[w], 12), w))
    assert toxicity.chosen_words(frame(positive), frame(corpus)) == want
    assert "vilest" in want and "seldom" not in want and not set(common) & set(want)
    monkeypatch.setattr(toxicity, "MAX_WORDS", 3)
    assert toxicity.chosen_words(frame(positive), frame(corpus)) == want[:3]
