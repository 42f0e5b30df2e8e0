"""The Merkle manifest against trees built in plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cindermill.llm import manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part int, s string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, source, lang, n_chars, text):
    return sha(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)])


def climb(level):
    """The root of a list of digests, and for each of them (before, after) by level."""
    paths, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for k, i in enumerate(at):
            run = level[i // 16 * 16 : i // 16 * 16 + 16]
            paths[k].append((run[: i % 16], run[i % 16 + 1 :]))
        level, at = [sha(*level[j : j + 16]) for j in range(0, len(level), 16)], [i // 16 for i in at]
    return level[0], paths


def plain(rows):
    by = {}
    for r in rows:
        i, text, lang, source, n = r[:5]
        now = text.translate({c: c + 32 for c in range(65, 91)}) if text and i is not None and zlib.crc32(str(i).encode()) % 5 == 0 else text
        by.setdefault(source, []).append((i, plain_leaf(i, source, lang, n, text), plain_leaf(i, source, lang, n, now)))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        by[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append(climb([leaf for _, leaf, _ in by[s]]))
    root, tops = climb([r for r, _ in trees]) if trees else (None, [])
    out = []
    for s, (subroot, paths), top in zip(sources, trees, tops):
        for (i, leaf, fresh), path in zip(by[s], paths):
            h = fresh
            for before, after in path + top:
                h = sha(*before, h, *after)
            out.append((i, leaf, subroot, root, sha(*[x for b, a in path + top for x in b + a]), h, h == root))
    return out


def rows_of(sizes, seed=1):
    rng = random.Random(seed)
    ids = list(range(sum(sizes.values())))
    rng.shuffle(ids)
    return [((i := ids.pop()), rng.choice([None, "", "Ünï Text A", f"Doc {i} ABC", "x" * 3000]), rng.choice([None, "en"]), source, rng.choice([None, i]), 0, "") for source, n in sizes.items() for _ in range(n)]


CASES = {
    "sizes around runs": rows_of({"a": 1, "b": 16, "c": 17, "d": 256, "e": 257, None: 3, "": 2, "é": 15, "z": 33, "𝄞": 1, "ﬁ": 2}),
    "one source": rows_of({"only": 300}),
    "one row": rows_of({"only": 1}),
    "one row, no source": rows_of({None: 1}),
    "many sources": rows_of({f"s{i}": 1 + i % 3 for i in range(290)}),
    "no rows": [],
    "repeated rows, null ids": [(7, "Same Text", "en", "a", 9, 0, "")] * 40 + [(None, "Nothing", None, "a", None, 0, ""), (None, None, None, "a", None, 0, ""), (None, None, None, None, None, 0, "")] + rows_of({"a": 30, "b": 5}),
}


@pytest.mark.parametrize("case", CASES)
def test_digest_is_the_plain_result(spark, case):
    rows = CASES[case]
    out = manifest.digest(spark.createDataFrame(rows, SCHEMA).repartition(6))
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(plain(rows), key=repr)


def test_hard_documents(spark, hard):
    rows = [tuple(r) for r in hard.collect()]
    assert sorted(map(tuple, manifest.digest(hard).collect()), key=repr) == sorted(plain(rows), key=repr)


def test_proofs_of_some_leaves_are_those_of_all(spark):
    m = manifest.built(spark.createDataFrame(CASES["sizes around runs"], SCHEMA))
    wanted = m.leaves.where("doc_id % 37 = 0").select("s", "i")
    some, every = manifest.proofs(m, wanted), manifest.proofs(m)
    ids = {r.doc_id for r in m.leaves.where("doc_id % 37 = 0").collect()}
    assert sorted(map(str, some.collect())) == sorted(str(r) for r in every.collect() if r.doc_id in ids)
    assert every.where(manifest.folded(F.col("leaf"), F.col("path")) != m.root).count() == 0


def test_ranks_do_not_depend_on_parts(spark):
    rows = spark.range(3000).select((F.col("id") % 7).cast("string").alias("source"), (F.col("id") * 7919 % 3001).alias("doc_id"), F.lit("x").alias("leaf"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = manifest.ranked(rows, ["source"], ["doc_id"], ("s", "i", "n")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    by = {}
    for r in out:
        by.setdefault((r.s, r.source, r.n), []).append((r.i, r.doc_id))
    assert sorted(k[:2] for k in by) == [(i, str(i)) for i in range(7)]
    for (_, _, n), places in by.items():
        places.sort()
        assert [i for i, _ in places] == list(range(n)) and [d for _, d in places] == sorted(d for _, d in places)
