"""Quality rules by weak supervision.

Seven rules vote junk (-1) or abstain (0), two vote good (1) or abstain, each on a whole text. Spark counts the vote patterns, at most
3 to the number of rules, whatever the corpus; expectation-maximisation over those counts estimates what
each rule votes on good and on junk documents, and the posterior probability of good decides.

Null and empty texts have no words, and the base check fails; repeated rows give repeated rows; columns
other than ``doc_id`` and ``text`` are not read for a verdict; no rows give no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cindermill.llm.common import columns_ddl, map_batches, staged

RULES = ("symbols", "repetition", "shouting", "vocabulary", "exclamation", "tables", "lines", "clean", "prose")
SYMBOLS = "#*$%&|<>"
NAMES = ("n_words_", "word_chars_", "n_symbols_", "n_dup_lines_", "n_repeat_words_")
STATS = ", ".join(f"{c} long" for c in NAMES)
#: Start of the estimation: share of good documents; how often a rule speaks rightly (junk rules, good rules) and wrongly.
PRIOR, RIGHT_JUNK, RIGHT_GOOD, WRONG, ROUNDS, SMOOTH = 0.85, 0.25, 0.9, 0.02, 50, 0.5
GOOD_RULES = ("clean", "prose")


def repeated_words(words: list[bytes]) -> tuple[int, int]:
    """Words in 3-word windows found twice or more, and distinct words."""
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    n, m = len(words), len(number)
    if n < 4 or m == n:
        return 0, m
    key = (ids[:-2] * m + ids[1:-1]) * m + ids[2:] if m < 2_000_000 else np.unique(np.stack([ids[:-2], ids[1:-1], ids[2:]]), axis=1, return_inverse=True)[1].ravel()
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0, m
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[k : n - 2 + k] |= twice
    return int(hit.sum()), m


def measured(text: str | None) -> tuple[list[int], list[int]]:
    """The base statistics and the votes of one text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    chars = len(text) - sum(text.count(c) for c in " \t\n\v\f\r")
    counts = {c: raw.count(c.encode()) for c in SYMBOLS}
    symbols = sum(counts.values())
    repeats, distinct = repeated_words(words)
    lines = [x for x in raw.split(b"\n") if x.strip(b" \t\v\f\r")]
    dup = len(lines) - len(set(lines))
    upper = sum(w.isupper() for w in words)
    stops = sum(raw.count(c) for c in (b".", b"?", b"!"))
    votes = [0] * len(RULES)
    if n:
        junk = (
            symbols / n >= 0.1,
            repeats / n >= 0.3,
            upper / n >= 0.3,
            n >= 50 and distinct / n <= 0.2,
            raw.count(b"!") / n >= 0.15,
            counts["|"] / n >= 0.08,
            len(lines) >= 4 and dup / len(lines) >= 0.5,
        )
        clean = symbols / n <= 0.02 and upper / n <= 0.2 and raw.count(b"!") / n <= 0.05 and repeats / n <= 0.25
        prose = stops / n >= 0.02 and 3 <= chars / n <= 9
        votes = [-bool(x) for x in junk] + [int(clean), int(prose)]
    return [n, chars, symbols, dup, repeats], votes


def votes(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``carry``, the base statistics and the votes (an array in the order of RULES) of every row."""
    carried = docs.select(*carry)

    def run(batch):
        rows = [measured(t) for t in batch.column(len(carry)).to_pylist()]
        return dict(zip(carry, batch.columns, strict=False)) | {"votes_": [v for _, v in rows]} | {c: [s[i] for s, _ in rows] for i, c in enumerate(NAMES)}

    return map_batches(docs.select(*carry, F.col("text").alias("text_")), run, f"{columns_ddl(carried)}, {STATS}, votes_ array<tinyint>")


def estimate(patterns: dict[tuple[int, ...], int]) -> tuple[float, np.ndarray]:
    """Share of good documents and, by rule and vote (-1, 0, 1), its probability on junk and on good ones."""
    v = np.array(list(patterns), dtype=np.int64).reshape(len(patterns), len(RULES))
    c = np.array(list(patterns.values()), dtype=float)
    share, p = PRIOR, np.empty((v.shape[1], 3, 2))
    for i, rule in enumerate(RULES):
        right, tiny = (RIGHT_GOOD, 0.5) if rule in GOOD_RULES else (RIGHT_JUNK, WRONG), 1e-6
        p[i] = ((tiny, tiny), (1 - right[1], 1 - right[0]), (right[1], right[0])) if rule in GOOD_RULES else ((right[0], right[1]), (1 - right[0], 1 - right[1]), (tiny, tiny))
    for _ in range(ROUNDS if c.sum() else 0):
        good = posterior(v, share, p)
        share = float(np.clip((good @ c) / c.sum(), 0.01, 0.99))
        for k in range(3):
            at = v == k - 1
            p[:, k, 1], p[:, k, 0] = (at * (good * c)[:, None]).sum(0) + SMOOTH, (at * ((1 - good) * c)[:, None]).sum(0) + SMOOTH
        p /= p.sum(axis=1, keepdims=True)
    return share, p


def posterior(v: np.ndarray, share: float, p: np.ndarray) -> np.ndarray:
    rules = np.arange(v.shape[1])
    odds = np.log(share / (1 - share)) + np.log(p[rules, v + 1, 1] / p[rules, v + 1, 0]).sum(axis=1)
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def judged(docs: DataFrame, threshold: float = 0.5, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry``, base statistics, base_failed, kept, quality (the posterior) and the votes of every row."""
    voted = staged(votes(docs, carry))
    counts = {tuple(r.votes_): r.n for r in voted.groupBy("votes_").agg(F.count("*").alias("n")).collect()}
    share, p = estimate(counts)
    weights = np.log(p[:, :, 1] / p[:, :, 0])
    odds = F.lit(float(np.log(share / (1 - share))))
    for i in range(len(RULES)):
        junk, abstain, good = map(float, weights[i])
        vote = F.col("votes_")[i]
        odds = odds + F.when(vote == -1, junk).when(vote == 1, good).otherwise(abstain)
    quality = 1 / (1 + F.exp(-odds))
    failed = (F.col("n_words_") < 50) | (100 * F.col("n_repeat_words_") > 50 * F.col("n_words_"))
    return voted.select(*carry, *[F.col(c).alias(c[:-1]) for c in NAMES], failed.alias("base_failed"), (~failed & (quality >= threshold)).alias("kept"), quality.alias("quality"), F.col("votes_").alias("votes"))


def good_documents(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The kept rows of ``docs``, with its columns."""
    judged_rows = judged(docs.toDF(*[f"_{c}" for c in docs.columns]).withColumn("text", F.col("_text")), threshold, tuple(f"_{c}" for c in docs.columns))
    return judged_rows.where("kept").select(*[F.col(f"_{c}").alias(c) for c in docs.columns])
