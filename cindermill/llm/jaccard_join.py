"""N-gram Jaccard join by grouped prefixes.

A document's set holds the hashes of its distinct 5-word shingles. Sets that are equal form one class. In one
order for all sets (shingles found often in a sample of documents last, else by hash) two sets of similarity
0.8 or more share a token of their prefixes, the first n - ceil(0.8 n) + 1 of n tokens. Classes with the same
prefix and size form one group; group pairs are found by joining the prefix tokens that two groups hold, with
the size and position filters in the join, then expanded to classes and verified: first by an exact bound (the
Hamming distance of parity bitmaps is at most that of the sets), then on the whole sets.

So that a common passage or a thousand near copies don't give all pairs, two steps look for links. Stars:
every group with the first group of each of its tokens, and every class with the first of its group. Then the
classes that verified stars connect get one component, and only pairs between different components, which could
still change something, are emitted and verified. No partner or candidate is dropped: a pair is left out only if
a filter proves that it is no link or if it is connected already.

The sample decides the order alone, never a result. Null and empty texts have no shingles and are linked with
nothing; fewer than 5 words form one shingle; rows with a null id get their own class, linked with nothing, and a
null component; repeated rows give repeated rows; rows of one id with different texts are sets of their own, and
a component's id is the least of its documents' ids, of whatever type these are; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cindermill.llm.common import discard, map_batches, staged
from cindermill.llm.lm_scoring import M3, Tokens, mix

SHINGLE = 5
#: Documents in SAMPLE one is counted for the order; at most MAX_COMMON tokens, found COMMON times or more, come last.
SAMPLE, COMMON, MAX_COMMON = 16, 2, 1_000_000
#: Bytes of ids that may be sent to all workers; more are joined.
MAX_BYTES = 32 << 20
#: Holders of one prefix token in a block: pairs are emitted by pairs of blocks.
BLOCK = 2_000


def sets_of(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    t, out = Tokens(texts), []
    own = t.hashes[t.ids]
    chained = own.copy()
    for j in range(1, SHINGLE):
        chained[: len(own) - j] = mix(chained[: len(own) - j] * M3 + own[j:])
    for start, size in zip(t.starts.tolist(), (t.sizes - 1).tolist(), strict=True):  # less the end token
        if size >= SHINGLE:
            out.append(np.unique(chained[start : start + size - SHINGLE + 1]))
        elif size:
            acc = np.full(1, size, np.uint64)
            for h in own[start : start + size]:
                acc = mix(acc * M3 + h)
            out.append(acc)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def common_tokens(docs: DataFrame) -> np.ndarray:
    """Sorted tokens that come last in the order."""
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)
    tokens = map_batches(sample.select("text"), lambda b: {"token": np.concatenate([np.empty(0, np.uint64), *sets_of(b.column(0).to_pylist())]).view(np.int64)}, "token long")
    found = tokens.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON).orderBy(F.desc("n"), "token").limit(MAX_COMMON)
    return np.sort(np.array([r.token for r in found.select("token").toLocalIterator()], np.int64).view(np.uint64))


def parity(tokens: np.ndarray) -> bytes:
    """A bitmap of 2 to 4 bits a token, each the parity of the tokens hashed to it."""
    bits = max(64, 1 << int(2 * len(tokens) - 1).bit_length()) if len(tokens) else 64
    at = (mix(tokens) % np.uint64(bits)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def distance(a: bytes, b: bytes) -> int:
    """Hamming distance of two bitmaps, the larger one folded to the size of the smaller."""
    x, y = (np.frombuffer(v, np.uint8) for v in (a, b))
    while len(x) != len(y):
        if len(x) > len(y):
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        else:
            y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def described(docs: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text), n, cls (digest of the set), grp (digest of size and prefix), prefix, bitmap of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    common = docs.sparkSession.sparkContext.broadcast(common_tokens(docs))  # at most MAX_COMMON numbers

    def run(batch):
        last, prefixes, sets = common.value, [], sets_of(batch.column(1).to_pylist())
        for s in sets:
            n = len(s)
            at = np.searchsorted(last, s)
            is_last = last[np.minimum(at, len(last) - 1)] == s if len(last) else np.zeros(n, bool)
            prefixes.append(np.concatenate([s[~is_last], s[is_last]])[: n - (4 * n + 4) // 5 + 1 if n else 0])
        digest = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
        group = [xxhash.xxh3_128_digest(len(s).to_bytes(8, "little") + p.tobytes()) for s, p in zip(sets, prefixes, strict=True)]
        return {"doc_id": batch.column(0), "h": batch.column(2), "n": [len(s) for s in sets], "cls": digest, "grp": group, "prefix": [p.view(np.int64) for p in prefixes], "bitmap": [parity(s) for s in sets]}

    return map_batches(docs.select("doc_id", "text", F.xxhash64("text").alias("h")), run, f"doc_id {kind}, h long, n long, cls binary, grp binary, prefix array<long>, bitmap binary")


def components(links: DataFrame) -> DataFrame:
    """node, component (the least node reachable) of every node of ``links`` (a, b): least labels and pointer jumping."""
    both = staged(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("near"))
        best = staged(labels.join(near, F.col("node") == F.col("a")).select("node", "component", F.least("component", "near").alias("new")))
        jump = best.select(F.col("node").alias("at"), F.col("new").alias("far"))
        after = staged(best.join(jump, F.col("new") == F.col("at")).select("node", F.least("new", "far").alias("component"), (F.least("new", "far") < F.col("component")).alias("moved")))
        moved = after.where("moved").limit(1).count()
        discard(labels, best)
        labels = after
        if not moved:
            discard(both)
            return labels.select("node", "component")


def sent_if_small(ids: DataFrame) -> DataFrame:
    """A staged table, to be sent to all workers if its bytes are few."""
    size = ids.agg(F.sum(sum(F.octet_length(F.col(c).cast("string")) + 8 for c in ids.columns))).first()[0]
    return F.broadcast(ids) if (size or 0) <= MAX_BYTES else ids


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """a, b of the ``pairs`` (of nodes, a < b) that are links. ``classes``: node, rep (a document that has the set), cls, n, bitmap."""
    side = lambda c: classes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("bitmap").alias(f"bitmap_{c}"))
    maps = pairs.select("a", "b").distinct().join(side("a"), "a").join(side("b"), "b").where(5 * F.least("n_a", "n_b") >= 4 * F.greatest("n_a", "n_b"))

    def near(batch):
        c = {x: batch.column(x).to_pylist() for x in ("a", "b", "n_a", "n_b", "bitmap_a", "bitmap_b")}
        ok = [9 * ((m + n - distance(x, y)) // 2) >= 4 * (m + n) for m, n, x, y in zip(c["n_a"], c["n_b"], c["bitmap_a"], c["bitmap_b"], strict=True)]
        return {x: [v for v, k in zip(c[x], ok, strict=True) if k] for x in ("a", "b")}

    left = staged(map_batches(maps, near, "a long, b long"))
    needed = left.select(F.col("a").alias("node")).union(left.select(F.col("b").alias("node"))).distinct()
    asked = staged(classes.select("node", F.col("rep").alias("doc_id"), "cls").join(needed, "node", "left_semi"))
    ids = staged(asked.select("doc_id").distinct())
    texts = docs.select("doc_id", "text").join(sent_if_small(ids), "doc_id", "left_semi")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def whole_sets(batch):
        tokens = [s.tobytes() for s in sets_of(batch.column(1).to_pylist())]
        return {"doc_id": batch.column(0), "cls": [xxhash.xxh3_128_digest(s) for s in tokens], "tokens": tokens}

    # of several texts under one id, the class's own
    sets = staged(map_batches(texts, whole_sets, f"doc_id {kind}, cls binary, tokens binary").join(asked, ["doc_id", "cls"]).dropDuplicates(["node"]))
    whole = left.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")

    def linked(batch):
        c = {x: batch.column(x).to_pylist() for x in ("a", "b", "x", "y")}
        ok = []
        for x, y in zip(c["x"], c["y"], strict=True):
            x, y = (np.frombuffer(v, np.uint64) for v in (x, y))
            both = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(100 * both >= 80 * (len(x) + len(y) - both))
        return {x: [v for v, k in zip(c[x], ok, strict=True) if k] for x in ("a", "b")}

    out = staged(map_batches(whole.select("a", "b", "x", "y"), linked, "a long, b long"))
    discard(left, asked, ids, sets)
    return out


def ordered(a: str, b: str):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


#: A pair can be a link: the sizes, and the tokens left from the shared one on (as if it were the first).
SIZES = "5L * least(x.n, y.n) >= 4L * greatest(x.n, y.n)"
PLACES = "9L * least(x.n - x.pos, y.n - y.pos) >= 4L * (cast(x.n as long) + y.n)"


def blocked(held: DataFrame, hot: DataFrame, own: str, other: str) -> DataFrame:
    """Holders of a token with the block each is in (``own``) and, once each, all blocks of the token (``other``)."""
    rows = held.join(hot, "token", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own_block = F.pmod(F.xxhash64("grp"), "blocks").alias(own)
    return rows.select(*held.columns, own_block, F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias(other))


def labelled(docs: DataFrame) -> DataFrame:
    """doc_id, h, n_shingles, component (null: linked with nothing and no set), component_id of every row of ``docs``."""
    docs = docs.select("doc_id", "text")
    rows = staged(described(docs))
    sets = rows.where("doc_id is not null and n > 0")
    # groups by numbers of their own: exact as the digests are, at half the bytes; one row of tokens a group, however many copies
    groups = staged(sets.select("grp", "n", "prefix").dropDuplicates(["grp"]).withColumn("number", F.monotonically_increasing_id()))
    of_sets = sets.groupBy("cls", "grp", "n").agg(F.min("doc_id").alias("rep")).join(groups.select("grp", "number"), "grp")
    classes = staged(of_sets.select("cls", F.col("number").alias("grp"), "n", "rep").withColumn("node", F.monotonically_increasing_id()))
    tokens = groups.select(F.col("number").alias("grp"), F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("pos", "token"))
    shared = tokens.groupBy("token").agg(F.min("grp").alias("g"), F.max("grp").alias("h")).where("g < h").select("token")
    held = staged(tokens.join(shared, "token"))
    discard(groups)
    full = sets.select("doc_id", "cls", "n", "bitmap").join(classes.select(F.col("rep").alias("doc_id"), "cls", "node"), ["doc_id", "cls"])
    maps = staged(full.dropDuplicates(["node"]).select("node", F.col("doc_id").alias("rep"), "cls", "n", "bitmap"))

    member = classes.select("grp", "node")
    first = member.groupBy("grp").agg(F.min("node").alias("first"))
    hub = staged(held.groupBy("token").agg(F.min(F.struct("pos", "n", "grp")).alias("hub"), F.count("*").alias("holders")))
    x, y = held.alias("x"), hub.select("token", "hub.*").alias("y")
    stars = x.join(y, "token").where("x.grp <> y.grp").where(SIZES).where(PLACES).select(F.col("x.grp").alias("grp"), F.col("y.grp").alias("hub")).distinct()
    stars = stars.join(first.select(F.col("grp").alias("hub"), F.col("first").alias("h")), "hub").join(first, "grp").select(*ordered("h", "first"))
    inner = member.join(first, "grp").where("node <> first").select(*ordered("node", "first"))
    links = verified(staged(stars.union(inner)), maps, docs)

    found = components(links)
    label = staged(member.join(found, "node", "left").select("grp", "node", F.coalesce("component", "node").alias("component")))
    # one component for the whole group, or null
    of = label.groupBy("grp").agg(F.min("component").alias("low"), F.max("component").alias("high")).select("grp", F.when(F.col("low") == F.col("high"), F.col("low")).alias("one"))
    sided = staged(held.join(of, "grp"))
    hot = staged(hub.where(F.col("holders") > BLOCK).select("token", F.ceil(F.col("holders") / BLOCK).alias("blocks")))
    discard(held, hub)
    x, y = blocked(sided, hot, "p", "q").alias("x"), blocked(sided, hot, "q", "p").alias("y")
    cross = x.join(y, F.expr(f"x.token = y.token and x.p = y.p and x.q = y.q and x.grp < y.grp and (x.one is null or y.one is null or x.one <> y.one) and {SIZES} and {PLACES}"))
    cross = cross.select(F.col("x.grp").alias("g"), F.col("y.grp").alias("h")).distinct()
    split = of.where("one is null").select("grp")
    same = label.join(split, "grp", "left_semi")
    p, q = label.alias("p"), label.alias("q")
    pairs = cross.join(p, F.col("g") == F.col("p.grp")).join(q, F.col("h") == F.col("q.grp")).where("p.component <> q.component").select(F.col("p.node").alias("r"), F.col("q.node").alias("s"))
    p, q = same.alias("p"), same.alias("q")
    within = p.join(q, F.expr("p.grp = q.grp and p.node < q.node and p.component <> q.component")).select(F.col("p.node").alias("r"), F.col("q.node").alias("s"))
    candidates = staged(pairs.union(within).select(*ordered("r", "s")))
    discard(sided, hot)
    more = verified(candidates, maps, docs)

    linked = staged(classes.select("cls", "rep", "node").join(components(links.union(more)), "node"))
    least = staged(linked.groupBy("component").agg(F.min("rep").alias("component_id")))
    of_class = linked.join(least, "component").select("cls", "component", "component_id")
    of_class = staged(classes.select("cls", "rep", "node").join(of_class, "cls", "left").select("cls", F.coalesce("component", "node").alias("component"), F.coalesce("component_id", "rep").alias("component_id")))
    out = rows.select("doc_id", "h", "n", "cls", (F.col("doc_id").isNotNull() & (F.col("n") > 0)).alias("known")).join(of_class, "cls", "left")
    return out.select("doc_id", "h", F.col("n").alias("n_shingles"), F.when(F.col("known"), F.col("component")).alias("component"), F.when(F.col("known"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def joined(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``."""
    return labelled(docs).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` less all but one document of each component: that of the least id and, of several texts under it, the least text hash.

    Rows without a set (no words) or without an id stay; of rows with the same id and text one stays.
    """
    verdict = staged(labelled(docs).where("component is not null").select("doc_id", "h", "component"))
    at = F.struct("doc_id", "h")
    best = staged(verdict.groupBy("component").agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first < last").select("component", "first"))
    gone = staged(verdict.join(best, "component").where(at != F.col("first")).select(F.col("doc_id").alias("gone_id"), F.col("h").alias("gone_h")).distinct())
    h = F.xxhash64("text")
    left = docs.join(sent_if_small(gone), (F.col("doc_id") == F.col("gone_id")) & (h == F.col("gone_h")), "left_anti").select(docs.columns)
    twice = docs.where("doc_id is not null").groupBy("doc_id", h.alias("twice_h")).count().where("count > 1").select(F.col("doc_id").alias("twice_id"), "twice_h")
    twice = staged(twice)
    if twice.limit(1).count():
        on = (F.col("doc_id") == F.col("twice_id")) & (h == F.col("twice_h"))
        again = left.join(twice, on, "left_semi").select(docs.columns).dropDuplicates(["doc_id", "text"])
        left = left.join(twice, on, "left_anti").select(docs.columns).union(again)
    return left


#: DuckDB: shingles as strings, all pairs that share one, links, then the least id reachable.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i+4], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), z AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (
  SELECT a, b FROM p JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)
), e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a AS node, a AS seen FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a),
m AS (SELECT node, min(seen) AS c FROM r GROUP BY 1)
SELECT w.doc_id, CAST(coalesce(z.n, 0) AS BIGINT) AS n_shingles, coalesce(m.c, w.doc_id) AS component_id FROM w LEFT JOIN z USING (doc_id) LEFT JOIN m ON m.node = w.doc_id
"""
