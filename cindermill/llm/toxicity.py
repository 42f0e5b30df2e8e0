"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents (label 1) are the positive sample, documents of any label or none the unlabelled
one. A logistic classifier over the presence of words and of stems (beginnings of words) is trained by gradient descent in numpy on the risk
pi * E_pos[l(g)] + max(0, E_unl[l(-g)] - pi * E_pos[l(-g)]), with the class prior pi taken from the labelled
rows; where the second part is negative, its gradient is reversed.

Bounds: at most MAX_POSITIVE positive documents, the smallest by hash of their ids, are learnt from, and for the
gradient steps alone at most MAX_UNLABELLED others, taken likewise. Words, at most MAX_WORDS, are chosen by their
counts in these positive documents and in all rows of the corpus, which Spark gathers; the words counted there are
those that a MIN_SHARE of the positive documents hold, so at most 1 / MIN_SHARE times the words of a mean one. Every
whole text is scored, in one narrow pass. Only rows whose crc32(doc_id as text) mod 4 is not 2 are learnt from.

Null texts count as empty; an empty text gets the score of the bias alone; a null id is not held out and not
learnt from; repeated rows give repeated rows, and count as many in the counts; other columns are not read; without positives all scores are
the prior's.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cindermill.llm.common import crc_mod, discard, map_batches, py_crc_mod, staged

MAX_POSITIVE, MAX_UNLABELLED, MAX_WORDS = 4000, 16000, 4096
#: A word is learnt from if this share of the positive rows, or MIN_DOCUMENTS rows if more, holds it,
#: and if it is so much more frequent there than in the corpus.
MIN_SHARE, MIN_DOCUMENTS, MIN_RATIO = 0.02, 5, 3.0
EPOCHS, RATE, DECAY = 300, 0.1, 5e-4
THRESHOLD = 0.3
STEMS = (4, 5, 6, 7)
WORD = re.compile(r"[^\W\d_]+")


def features(text: str | None, stems: set[str] | None = None) -> set[str]:
    """A text's distinct words; and stems (beginnings of STEMS letters) that begin 1, 2 or 4 distinct words or more.

    ``stems``: the first letters of the stems and words that matter; others are skipped.
    """
    words = set(WORD.findall((text or "").lower()))
    if stems is not None:
        words = {w for w in words if w[: STEMS[0]] in stems}
    begun = Counter(w[:k] for w in words for k in STEMS if len(w) > k)
    return words | {f"{least}^{stem}" for stem, n in begun.items() for least in (1, 2, 4) if n >= least}


def gradient(w: np.ndarray, b: float, at: np.ndarray, word: np.ndarray, is_p: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """The step's direction by weight and bias: the risk's gradient, of the negative part alone and reversed where that is below 0.

    Row ``at[i]`` holds word ``word[i]``; ``is_p`` tells the positive rows.
    """
    n_p, n_u = max(1, int(is_p.sum())), max(1, int((~is_p).sum()))
    g = np.bincount(at, w[word], len(is_p)) + b
    p = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
    loss = np.log1p(np.exp(np.clip(g, -30, 30)))  # of taking a row for negative
    negative = loss[~is_p].sum() / n_u - prior * loss[is_p].sum() / n_p
    if negative >= 0:
        slope = np.where(is_p, prior * (p - 1) / n_p - prior * p / n_p, p / n_u)
    else:
        slope = np.where(is_p, prior * p / n_p, -p / n_u)
    return np.bincount(word, slope[at], len(w)), float(slope.sum())


def train(positive: list[list[int]], unlabelled: list[list[int]], n_words: int, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias of the non-negative risk's minimum; rows are lists of word numbers."""
    rows = positive + unlabelled
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    word = np.array([w for r in rows for w in r], np.int64)
    is_p = np.arange(len(rows)) < len(positive)
    w, b = np.zeros(n_words), math.log(prior / (1 - prior))
    m, v = np.zeros(n_words + 1), np.zeros(n_words + 1)
    for step in range(1, EPOCHS + 1 if positive else 1):
        by_word, by_bias = gradient(w, b, at, word, is_p, prior)
        grad = np.append(by_word + DECAY * w, by_bias)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


class Model:
    def __init__(self, words: list[str], weights: np.ndarray, bias: float):
        self.weight, self.bias = dict(zip(words, weights.tolist(), strict=True)), bias
        self.stems = stems_of(words)

    def score(self, text: str | None) -> float:
        get = self.weight.get
        g = self.bias + math.fsum(get(w, 0.0) for w in features(text, self.stems))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, g))))


def stems_of(words) -> set[str]:
    """The first letters of words and stems, as ``features`` takes them."""
    return {w.rpartition("^")[2][: STEMS[0]] for w in words}


def row_counts(texts: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """word, n: how many rows of ``texts`` (text) hold each word, or each of ``words`` (word); counted in tasks first."""
    of = None
    if words is not None:
        known = [r.word for r in words.collect()]
        of = texts.sparkSession.sparkContext.broadcast((frozenset(known), stems_of(known)))

    def run(batch):
        n = Counter()
        for t in batch.column(0).to_pylist():
            n.update(features(t) if of is None else features(t, of.value[1]) & of.value[0])
        return {"word": list(n), "n": list(n.values())}

    return map_batches(texts.select("text"), run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def chosen_words(positive: DataFrame, corpus: DataFrame) -> list[str]:
    """The words to learn from, by their counts in all rows of ``positive`` and of ``corpus`` (text), best first."""
    n_p, n_u = positive.count(), corpus.count()
    often = staged(row_counts(positive).where(F.col("n") >= max(MIN_DOCUMENTS, MIN_SHARE * n_p)).withColumnRenamed("n", "p"))
    both = often.join(row_counts(corpus, often), "word", "left")
    rate_p, rate_u = (F.col("p") + 0.5) / (n_p + 1), (F.coalesce("n", F.lit(0)) + 0.5) / (n_u + 1)
    gain = F.abs(F.sqrt(rate_p) - F.sqrt(rate_u))
    words = [r.word for r in both.where(rate_p >= MIN_RATIO * rate_u).orderBy(gain.desc(), "word").limit(MAX_WORDS).collect()]
    discard(often)
    return words


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    spark = docs.sparkSession
    learn = labels.where(crc_mod(F.col("doc_id"), 4) != 2).where("toxic is not null").select("doc_id", "toxic").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = learn.agg(F.avg("toxic").alias("prior")).first().prior
    prior = min(0.5, max(0.001, share or 0.0))
    order = F.xxhash64("doc_id")
    positive = learn.where("toxic = 1").select("doc_id", order.alias("o")).orderBy("o", "doc_id").limit(MAX_POSITIVE)
    corpus = docs.where(crc_mod(F.col("doc_id"), 4) != 2).select("doc_id", "text")
    others = corpus.select("doc_id").distinct().select("doc_id", order.alias("o")).orderBy("o", "doc_id").limit(MAX_UNLABELLED)
    chosen = [(r.doc_id, 1) for r in positive.collect()] + [(r.doc_id, 0) for r in others.collect()]
    kind = docs.schema["doc_id"].dataType.simpleString()
    if not any(y for _, y in chosen):
        return Model([], np.zeros(0), math.log(prior / (1 - prior)))
    ids = F.broadcast(spark.createDataFrame(chosen, f"doc_id {kind}, positive int"))  # at most MAX_POSITIVE + MAX_UNLABELLED rows
    # of rows with one id the least text alone, so that repeats keep the bound
    sample = corpus.join(ids, "doc_id").groupBy("doc_id", "positive").agg(F.min("text").alias("text")).select("text", "positive")
    words = chosen_words(sample.where("positive = 1"), corpus)
    number, first = {w: i for i, w in enumerate(words)}, stems_of(words)
    rows = map_batches(sample, lambda b: {"positive": b.column(1), "row": [sorted(number[w] for w in features(t, first) & number.keys()) for t in b.column(0).to_pylist()]}, "positive int, row array<int>")
    got = sorted((r.positive, r.row) for r in rows.collect())
    return Model(words, *train([r for y, r in got if y], [r for y, r in got if not y], len(words), prior))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batch):
        score = [model.value.score(t) for t in batch.column(1).to_pylist()]
        return {"doc_id": batch.column(0), "held_out": [py_crc_mod(i, 4) == 2 for i in batch.column(0).to_pylist()], "score": score, "predicted": [int(s >= THRESHOLD) for s in score]}

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, held_out boolean, score double, predicted int")
