"""The n-gram Jaccard join in the cases that the shared rows lack."""

import random

import pytest

from cindermill.llm import jaccard_join


def plain(rows):
    """Least id by brute force over all pairs of rows with words; rows with one id are apart."""
    sets = []
    for _, text in rows:
        w = text.lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    at = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                old, new = max(at[i], at[j]), min(at[i], at[j])
                at = [new if x == old else x for x in at]
    least = {c: min(rows[i][0] for i in range(len(rows)) if at[i] == c) for c in set(at)}
    return sorted((r[0], len(s), least[c]) for r, s, c in zip(rows, sets, at, strict=True))


def words(rng, n):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


@pytest.mark.parametrize("block", [3, 2_000])
def test_one_token_in_most_documents(spark, monkeypatch, block):
    """A passage that makes up most prefixes, held by documents of many components, met by pairs of blocks."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rng = random.Random(3)
    passage = words(rng, 8)
    rows = [(i, f"{passage} {words(rng, 12)}") for i in range(80)]
    rows += [(100 + i, f"{rows[i % 9][1]} tail") for i in range(60)] + [(200 + i, f"{passage} {words(rng, 1)}") for i in range(40)]
    got = jaccard_join.joined(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == plain(rows)


def test_string_ids_and_ids_with_two_texts(spark):
    rng = random.Random(4)
    a, b = words(rng, 60), words(rng, 60)
    rows = [("k9", a), ("k10", a + " more"), ("k11", b), ("k9", b + " x"), ("z", words(rng, 30)), ("k10", a + " more")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    assert sorted(map(tuple, jaccard_join.joined(docs).collect())) == plain(rows)
    left = sorted(map(tuple, jaccard_join.one_of_each(docs).collect()))
    assert left == sorted([("k10", a + " more"), ("k11", b), rows[4]])
