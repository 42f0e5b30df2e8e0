"""Small hard documents that the tests of all operators share."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    vocabulary = [f"word{i}" for i in range(400)]
    return " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ".", ","]) for _ in range(n))


def rows():
    """(doc_id, text): copies, near copies, shared passages, nulls, empty and long texts, odd characters, repeated rows."""
    rng = random.Random(7)
    out = [(i, prose(rng, rng.randint(1, 180))) for i in range(60)]
    long = prose(rng, 300)
    words = long.split()
    out += [(100 + i, long) for i in range(8)]
    out += [(120 + i, " ".join([*words[:i], "changed", *words[i + 1 :]])) for i in range(8)]
    passage = "\n".join(prose(rng, 12) for _ in range(6))
    out += [(140 + i, f"Head {i}\n\n{passage}\nTail {i} {prose(rng, 20)}") for i in range(6)]
    out += [(160, None), (161, ""), (162, "  \n\t\n"), (163, "one"), (164, "One"), (165, "a b c d e"), (166, "A B C D E")]
    out += [(170, "x" * 50_000 + " tail"), (171, prose(rng, 30_000)), (172, "é\u0301 ﬁ \u00a0 <|endoftext|> 漢字 \x1c ’s I'll don't"), (173, "$$ ## | | | !!! " * 30)]
    out += [(None, "a row without an id"), (None, None), (180, long), (180, long), (181, prose(rng, 30)), (181, prose(rng, 30))]
    return out


@pytest.fixture(scope="session")
def hard(spark):
    return spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in rows()], SCHEMA).repartition(3).persist()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
