"""Merkle dataset manifest: a content-addressed store of digests to children, and proofs by descent from the root.

A row's leaf is the SHA-256 of its fields; a source's leaves, in the order of ids, are hashed in runs of 16, the runs'
digests again, up to one subroot; the subroots, in the order of sources, likewise up to the root. The store has a record
(digest, children) a node, a table a height. A proof is asked for by a leaf's place: its rank among the sources and in
its own, in digits of base 16. All requests that share the leading digits go down from the root as one row: each level
joins the digests reached with the store, follows the digit's child, and puts the children not followed (those before and
those after) on the path. At the leaves, paths are turned round: a proof lists the siblings from the leaf up.

Ranks need no group in one task, however large a source: rows are parted by ranges of (source, id), numbered inside each
part, and the parts' counts by source give where each begins; equal rows are told apart by a number, so ranges split
them too. Only ids and digests are shuffled, never texts. Paths live on runs of 16 leaves, not on leaves. The levels of the
tree (log 16 of the rows) are the only loop. Digests go as text, as they are hashed.

Nulls in any field have a mark of their own; the null source comes first, then null ids first inside a source, equal ids
in the order of their leaves. Repeated rows are leaves of their own, and a digest that two nodes share has one record. An
empty table has no root and gives no rows. Columns beside the five are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cindermill.llm.common import crc_mod, discard, staged

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RUN = 16
#: One row in so many is tampered with, by the id's crc32.
TAMPERED = 5


def leaf(*fields: Column) -> Column:
    """The digest of a row's fields: each as its byte count, a colon and its text, or a dash."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def node(children: Column) -> Column:
    return F.sha2(F.array_join(children, ""), 256)


def ranked(rows: DataFrame, group: list[str], order: list[str], names: tuple[str, str, str]) -> DataFrame:
    """``rows`` with ``names``: the rank of the group among groups, the rank in the group (both from 0), the group's size; nulls come first.

    Rows are numbered by ranges of the keys, not by one window a group.
    """
    rows = staged(rows.withColumn("twin", F.monotonically_increasing_id()))
    keys = [*group, *order, "twin"]
    parts = staged(rows.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()))
    discard(rows)
    counts = parts.groupBy(*group, "part").agg(F.count("*").alias("n"))
    whole = Window.partitionBy(*group)  # of counts: a row a part
    before = F.coalesce(F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    of_group, in_group, size = names
    begins = counts.select("part", *group, before.alias("begins"), F.sum("n").over(whole).cast("bigint").alias(size))
    if group:
        places = staged(ranked(begins.select(*group).distinct(), [], group, ("all", of_group, "every")).drop("all", "every"))
        begins = joined_on(begins, places, group)
    else:
        begins = begins.withColumn(of_group, F.lit(0).cast("bigint"))
    inside = F.row_number().over(Window.partitionBy(*group, "part").orderBy(*order, "twin")) - 1
    out = joined_on(parts.withColumn("inside", inside), begins, [*group, "part"])
    return out.withColumn(in_group, (F.col("begins") + F.col("inside")).cast("bigint")).drop("twin", "part", "inside", "begins")


def joined_on(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Join in which nulls of the key meet."""
    right = right.withColumnsRenamed({c: f"{c}_right" for c in key})
    same = [F.col(c).eqNullSafe(F.col(f"{c}_right")) for c in key]
    return left.join(right, same).drop(*[f"{c}_right" for c in key])


@dataclass
class Tree:
    """Trees over ranked digests, one a group ``s``."""

    #: The nodes' records (digest, children) by height, from 1.
    store: list[DataFrame]
    #: s, height, digest of every root.
    roots: DataFrame


def grown(level: DataFrame) -> Tree:
    """The trees over ``level`` (s, i, n, digest; i: rank inside s, n: how many s has)."""
    store, height = [], 0
    alone = lambda rows, h: rows.where("n = 1").select("s", F.lit(h).alias("height"), "digest")
    roots = alone(level, 0)
    while not (many := level.where("n > 1")).isEmpty():
        children = F.transform(F.array_sort(F.collect_list(F.struct("i", "digest"))), lambda x: x["digest"])  # of a run
        runs = many.groupBy("s", F.shiftright("i", 4).alias("i")).agg(children.alias("children"), F.shiftright(F.max("n") + (RUN - 1), 4).alias("n"))
        level = staged(runs.select("s", "i", "n", node(F.col("children")).alias("digest"), "children"))
        store.append(level.select("digest", "children").dropDuplicates(["digest"]))
        height += 1
        roots = roots.union(alone(level, height))
    return Tree(store, roots)


def joined(digests: Column) -> Column:
    return F.array_join(digests, "")


PATH = "array<struct<before:string,after:string>>"


def with_siblings(path: str, children: str, digit: Column) -> Column:
    """The path and the children that the digit does not pick."""
    before, after = F.slice(children, F.lit(1), digit), F.slice(children, digit + 2, F.lit(RUN))
    return F.array_append(path, F.struct(joined(before).alias("before"), joined(after).alias("after")))


def step(at: DataFrame, store: DataFrame) -> DataFrame:
    """From nodes (s, i, digest, origin, path) to their children."""
    below = at.join(store, "digest").select("s", "i", "origin", "path", "children", F.posexplode("children").alias("digit", "child"))
    return below.select("s", (F.shiftleft("i", 4) + F.col("digit")).alias("i"), F.col("child").alias("digest"), "origin", with_siblings("path", "children", F.col("digit")).alias("path"))


def descended(tree: Tree, entries: DataFrame, to: int = 0, wanted: DataFrame | None = None) -> DataFrame:
    """The nodes (s, i, digest, origin: the tree's root, path) at height ``to``, reached from ``entries`` (s, height, digest, path), each a tree's root.

    ``wanted`` (s, i: ranks of leaves) prunes the way to what leads there.
    """
    below = last = None
    for height in range(len(tree.store), to - 1, -1):
        here = entries.where(F.col("height") == height).select("s", F.lit(0).cast("bigint").alias("i"), "digest", F.col("digest").alias("origin"), "path")
        here = here if below is None else here.unionByName(below)
        if wanted is not None:
            here = here.join(wanted.select("s", F.shiftright("i", 4 * height).alias("i")).distinct(), ["s", "i"], "left_semi")
        here, done = staged(here), last
        if done is not None:
            discard(done)
        last, below = here, step(here, tree.store[height - 1]) if height else None
    return last


@dataclass
class Manifest:
    """A data set's manifest."""

    #: s (rank of the source), i (rank in the source), n (leaves of the source), doc_id, source, leaf, fresh (the leaf as it is now; null: the same).
    leaves: DataFrame
    trees: Tree
    top: Tree
    root: str | None


def built(docs: DataFrame) -> Manifest:
    """The manifest of ``docs``. A column ``text_now``, where there is one, is the text found later, of which ``fresh`` is the leaf."""
    fields, fresh = [F.col(f) for f in FIELDS], F.lit(None).cast("string")
    if "text_now" in docs.columns:
        fresh = F.when(~F.col("text").eqNullSafe(F.col("text_now")), leaf(*fields[:-1], F.col("text_now")))
    rows = docs.select("doc_id", "source", leaf(*fields).alias("leaf"), fresh.alias("fresh"))
    leaves = staged(ranked(rows, ["source"], ["doc_id", "leaf"], ("s", "i", "n")))
    trees = grown(leaves.select("s", "i", "n", F.col("leaf").alias("digest")))
    trees.roots = staged(trees.roots)
    sources = trees.roots.count()
    top = grown(trees.roots.select(F.lit(0).cast("bigint").alias("s"), F.col("s").alias("i"), F.lit(sources).cast("bigint").alias("n"), "digest"))
    root = top.roots.select("digest").first()  # one row
    return Manifest(leaves, trees, top, root and root.digest)


def proofs(m: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """doc_id, leaf, fresh, subroot, path of every leaf, or of those at ``wanted`` (s, i): the siblings before and after, from the leaf up to the root."""
    tops = descended(m.top, m.top.roots.withColumn("path", F.array().cast(PATH))).select(F.col("i").alias("s"), "path")
    entries = staged(m.trees.roots.join(tops, "s").select("s", "height", "digest", "path"))
    asked = m.leaves if wanted is None else m.leaves.join(wanted.select("s", "i").distinct(), ["s", "i"], "left_semi")
    out = entries.where("height = 0").join(asked.where("n = 1"), "s").select("doc_id", "leaf", "fresh", F.col("digest").alias("subroot"), "path")
    if m.trees.store:
        runs = descended(m.trees, entries, 1, wanted)
        request = F.struct((F.col("i") % RUN).cast("int").alias("digit"), "doc_id", "fresh")
        requests = asked.where("n > 1").groupBy("s", F.shiftright("i", 4).alias("i")).agg(F.collect_list(request).alias("requests"))  # of a run
        answered = runs.join(m.trees.store[0], "digest").join(requests, ["s", "i"]).select("origin", "path", "children", F.inline("requests"))
        at = F.col("digit")
        out = out.unionByName(answered.select("doc_id", F.get("children", at).alias("leaf"), "fresh", F.col("origin").alias("subroot"), with_siblings("path", "children", at).alias("path")))
    return out.withColumn("path", F.reverse("path"))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(path, start, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def tampered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text_now``: A-Z in lower case in the rows that the ids' crc32 picks."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    now = F.when(crc_mod(F.col("doc_id"), TAMPERED) == 0, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))
    return docs.select(*FIELDS, now.alias("text_now"))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns: the proof of every leaf by its hash, and whether the leaf as it is now leads to the root."""
    m = built(tampered(docs))
    rows = proofs(m).withColumn("root", F.lit(m.root).cast("string"))
    proof = F.sha2(joined(F.transform("path", lambda s: F.concat(s["before"], s["after"]))), 256)
    out = rows.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded(F.coalesce("fresh", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle(levels: int = 5) -> str:
    """DuckDB SQL of the contract, for up to 16 ** ``levels`` leaves a source and as many sources."""
    field = lambda c: f"coalesce(concat(strlen(CAST({c} AS STRING)), ':', CAST({c} AS STRING)), '-')"
    hashed = lambda text: f"sha256(concat({', '.join(map(field, FIELDS[:-1]))}, {field(text)}))"
    crc = "list_reduce(list_prepend(4294967295, [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(doc_id AS STRING), '')]), lambda c, b: xor(c // 256, tab[CAST(1 + xor(c % 256, b) AS BIGINT)]))"
    ctes = [
        "crc AS (SELECT i, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) t(i) UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM crc WHERE k < 8)",
        "tab AS MATERIALIZED (SELECT list(c ORDER BY i) AS tab FROM crc WHERE k = 8)",
        f"d AS MATERIALIZED (SELECT *, {hashed('text')} AS leaf, {hashed('now')} AS fresh FROM (SELECT *, CASE WHEN xor({crc}, 4294967295) % {TAMPERED} = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS now FROM documents, tab))",
        "p AS MATERIALIZED (SELECT doc_id, leaf, fresh, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d)",
    ]

    def tree(name: str, start: str) -> None:
        ctes.append(f"{name}0 AS ({start})")
        for k in range(levels):
            ctes.append(f"{name}r{k} AS MATERIALIZED (SELECT s, i // 16 AS j, list(x ORDER BY i) AS run FROM {name}{k} WHERE s IN (SELECT s FROM {name}{k} GROUP BY s HAVING count(*) > 1) GROUP BY ALL)")
            ctes.append(f"{name}{k + 1} AS (SELECT s, j AS i, sha256(array_to_string(run, '')) AS x FROM {name}r{k})")
        ctes.append(f"{name}root AS MATERIALIZED ({' UNION ALL '.join(f'SELECT s, any_value(x) AS x FROM {name}{k} GROUP BY s HAVING count(*) = 1' for k in range(levels + 1))})")

    tree("a", "SELECT s, i, leaf AS x FROM p")
    # a tree of more than one node ends in a level of one, which is its root; so each s has one
    tree("b", "SELECT 0 AS s, s AS i, x FROM aroot")
    last = "SELECT doc_id, leaf, s, i, fresh AS h, '' AS siblings FROM p"
    for name, rank, group in (("a", "p.i", "p.s"), ("b", "p.s", "0")):
        for k in range(levels):
            digit = f"{rank} // {16**k} % 16"
            before, after = f"array_to_string(list_slice(run, 1, {digit}), '')", f"array_to_string(list_slice(run, {digit} + 2, 16), '')"
            ctes.append(f"{name}d{k} AS MATERIALIZED (SELECT doc_id, leaf, p.s, i, CASE WHEN run IS NULL THEN h ELSE sha256(concat({before}, h, {after})) END AS h, CASE WHEN run IS NULL THEN siblings ELSE concat(siblings, {before}, {after}) END AS siblings FROM ({last}) p LEFT JOIN {name}r{k} r ON r.s = {group} AND r.j = {rank} // {16 ** (k + 1)})")
            last = f"SELECT * FROM {name}d{k}"
    return f"""WITH RECURSIVE {", ".join(ctes)}
    SELECT doc_id, leaf, aroot.x AS subroot, broot.x AS root, sha256(siblings) AS proof_sha256, h AS folded_root, h = broot.x AS verified FROM ({last}) q JOIN aroot USING (s), broot"""


ORACLE = oracle()
