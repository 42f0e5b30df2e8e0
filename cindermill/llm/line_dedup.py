"""Line dedup by a suffix array over line-ID sequences. DataFrame operations only.

A document is the sequence of its lines that hold a word; a line's ID is its 128-bit hash. Distributed prefix
doubling names, for k = 0, 1, 2, ..., every block of 2^k lines by its rank among the repeated blocks of that
length: blocks are pairs of ranks of the round before, grouped (with map-side combine), sorted by range and
numbered in that order. Suffixes whose block is unique drop out, so later rounds hold only repeated text. The
ranks of round k order the suffix array by 2^k lines; suffixes that agree on m lines form one interval of
longest common prefix >= m, named by the two overlapping blocks of 2^floor(log2 m) lines that cover m lines.

A run of lines with ``min_words`` words or more that occurred before (by doc_id, then place) is deleted. Every
such run is the union of minimal runs (no line can be left off at its end, or at its start, without going below
``min_words``), which have at most ``min_words`` lines; so sorting to that depth suffices, and each suffix is
looked up in the intervals of its two minimal runs. The first member of an interval keeps its lines.

Null texts stay null and empty ones empty; lines without a word are never deleted and end no run; rows with the
same id and text are one document and are treated alike; a document that loses all lines with words has an
empty text; other columns are carried. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cindermill.llm.common import discard, staged

MIN_WORDS = 50
WORD = r"[^\x20\x09-\x0D]+"
KEY = ("id", "h")


def keyed(docs: DataFrame) -> DataFrame:
    """id (nulls first) and text hash: what tells documents apart."""
    return docs.withColumns({"id": F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id").alias("value")), "h": F.xxhash64("text")})


def line_ids(docs: DataFrame) -> DataFrame:
    """One row a line with a word: document, s (place among these), i (place among all), words, 128-bit ID."""
    lines = F.filter(F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("i"), x.alias("line"))), lambda x: x["line"].rlike(WORD))
    rows = keyed(docs.where(F.col("text").isNotNull()).select("doc_id", "text")).select(*KEY, F.posexplode(lines).alias("s", "x"))
    line = F.col("x.line")
    return rows.select(*KEY, "s", F.col("x.i").alias("i"), F.regexp_count(line, F.lit(WORD)).alias("w"), F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def ranked(blocks: DataFrame, a: str, b: str, to: str) -> DataFrame:
    """Repeated pairs (a, b) with a rank that follows their order."""
    at = F.struct(*KEY, "s")
    repeated = blocks.groupBy(a, b).agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first < last").select(a, b)
    return staged(repeated.repartitionByRange(a, b).sortWithinPartitions(a, b).withColumn(to, F.monotonically_increasing_id()))


def suffix_ranks(docs: DataFrame, depth: int) -> DataFrame:
    """Lines that repeat, with r0, r1, ...: the ranks of the blocks of 1, 2, 4, ... lines from each on (null: unique)."""
    lines = staged(line_ids(docs))
    names = ranked(lines, "a", "b", "r0")
    state = staged(lines.join(names, ["a", "b"]).drop("a", "b").distinct())  # repeated rows are one document
    discard(lines, names)
    k = 0
    while 2 ** (k + 1) <= depth:
        ahead = Window.partitionBy(*KEY).orderBy("s").rangeBetween(2**k, 2**k)
        # suffixes already unique get a key of their own, so that they do not meet in one task
        alone = -F.pmod(F.xxhash64(*KEY, "s"), F.lit(2**62)) - 1
        pairs = state.withColumn("next", F.max(f"r{k}").over(ahead)).withColumn("a", F.when(F.col("next").isNotNull(), F.col(f"r{k}"))).withColumn("a", F.coalesce("a", alone))
        pairs = staged(pairs.withColumn("next", F.coalesce("next", F.lit(-1))))
        names = ranked(pairs.where("a >= 0"), "a", "next", f"r{k + 1}")
        following = staged(pairs.join(names, ["a", "next"], "left").drop("a", "next"))
        discard(state, pairs, names)
        state, k = following, k + 1
    return state


def minimal_runs(state: DataFrame, min_words: int) -> DataFrame:
    """The minimal runs [s, e) of repeated lines from each line on, and up to each line."""
    document = Window.partitionBy(*KEY)
    sums = state.select(*KEY, "s", "w").withColumn("upto", F.sum(F.col("w").cast("long")).over(document.orderBy("s"))).withColumn("before", F.col("upto") - F.col("w"))
    onward, back = document.orderBy("before").rangeBetween(0, min_words - 1), document.orderBy("upto").rangeBetween(1 - min_words, 0)
    found = sums.select(
        *KEY, "s", "before", "upto", F.max("s").over(onward).alias("end"), F.max("upto").over(onward).alias("reached"),
        F.min("s").over(back).alias("start"), F.min("before").over(back).alias("left"),
    )
    runs = F.array(
        F.when(F.col("reached") - F.col("before") >= min_words, F.struct(F.col("s").alias("s"), (F.col("end") + 1).alias("e"))),
        F.when(F.col("upto") - F.col("left") >= min_words, F.struct(F.col("start").alias("s"), (F.col("s") + 1).alias("e"))),
    )
    return found.select(*KEY, F.explode(F.array_distinct(F.array_compact(runs))).alias("run")).select(*KEY, "run.s", "run.e")


def deleted_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """id, h, i of the lines to delete: those in a run of ``min_words`` words or more that occurred before."""
    state = suffix_ranks(docs, min_words)
    levels = sum(c[0] == "r" and c[1:].isdigit() for c in state.columns)
    ranks = state.select(*KEY, "s", F.array(*[f"r{j}" for j in range(levels)]).alias("r"))
    runs = minimal_runs(state, min_words).withColumn("m", F.col("e") - F.col("s")).where(F.col("m") < 2**levels)
    runs = runs.withColumn("k", F.floor(F.log2("m")).cast("int")).withColumn("k", F.expr("if(shiftleft(1, k + 1) <= m, k + 1, k)"))
    runs = runs.join(ranks, [*KEY, "s"]).withColumn("ra", F.element_at("r", F.col("k") + 1)).drop("r").where("ra is not null")
    tail = ranks.withColumnRenamed("s", "t")
    runs = runs.withColumn("t", F.col("e") - F.expr("shiftleft(1, k)")).join(tail, [*KEY, "t"]).withColumn("rb", F.element_at("r", F.col("k") + 1)).drop("r").where("rb is not null")
    runs = staged(runs.select(*KEY, "s", "e", "m", "ra", "rb"))
    interval, at = ["m", "ra", "rb"], F.struct(*KEY, "s")
    # a table of its own: the join can then split the members of a large interval
    first = staged(runs.groupBy(*interval).agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first < last").drop("last"))
    later = runs.join(first, interval).where(at > F.col("first")).groupBy(*KEY, "s").agg(F.max("e").alias("e"))
    upto = Window.partitionBy(*KEY).orderBy("s")
    covered = state.select(*KEY, "s", "i").join(later, [*KEY, "s"], "left").withColumn("e", F.max("e").over(upto))
    return covered.where(F.col("e") > F.col("s")).select(*KEY, "i")


def shortened(docs: DataFrame, min_words: int) -> DataFrame:
    """row (all columns of ``docs``), left (the text less its deleted lines), n_lines, n_deleted."""
    gone = deleted_lines(docs, min_words).groupBy(*KEY).agg(F.collect_set("i").alias("gone"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    left = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda i: F.col("lines")[i]), "\n"))
    # a document that lost every line with a word keeps none of its blank ones
    left = F.when(F.col("gone").isNotNull() & ~left.rlike(WORD), "").otherwise(left)
    own = keyed(docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")).drop("doc_id", "text")  # the text is shuffled once
    out = own.join(gone, list(KEY), "left").withColumn("text", F.col("row.text")).withColumn("lines", F.split("text", "\n", -1))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size("lines"))
    return out.select("row", left.alias("left"), n_lines.cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_deleted"))


def carried(docs: DataFrame) -> list:
    return [F.col("left").alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` with ``text`` less its deleted lines, and ``n_lines``, ``n_deleted`` (instead of columns of these names)."""
    own = docs.drop("n_lines", "n_deleted")
    return shortened(own, min_words).select(*carried(own), "n_lines", "n_deleted")


def without_copied_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later copies of repeated runs deleted; documents left with nothing are dropped."""
    return shortened(docs, min_words).where((F.col("n_deleted") == 0) | (F.col("left") != "")).select(carried(docs))


#: DuckDB: minimal runs as strings instead of ranks.
ORACLE = r"""
WITH l AS (
  SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS s, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w
  FROM (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS i, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), c AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY s) AS upto FROM l),
runs AS (
  SELECT doc_id, s, min(e) AS e FROM (SELECT a.doc_id, a.s, b.s AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.s BETWEEN a.s AND a.s + 50 AND b.upto - a.upto + a.w >= 50) GROUP BY 1, 2
  UNION
  SELECT doc_id, max(s) AS s, e FROM (SELECT a.doc_id, a.s, b.s AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.s BETWEEN a.s AND a.s + 50 AND b.upto - a.upto + a.w >= 50) GROUP BY 1, 3
), named AS (
  SELECT r.doc_id, r.s, r.e, string_agg(l.line, chr(10) ORDER BY l.s) AS k FROM runs r JOIN l ON l.doc_id = r.doc_id AND l.s BETWEEN r.s AND r.e GROUP BY 1, 2, 3
), later AS (SELECT doc_id, s, e FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS n FROM named) WHERE n > 1),
gone AS (SELECT DISTINCT l.doc_id, l.i FROM l JOIN later x ON l.doc_id = x.doc_id AND l.s BETWEEN x.s AND x.e),
g AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY 1),
t AS (
  SELECT d.doc_id, string_split(text, chr(10)) AS lines, coalesce(gone, []) AS gone, text FROM documents d LEFT JOIN g USING (doc_id)
), k AS (SELECT doc_id, lines, gone, array_to_string([lines[i + 1] FOR i IN range(len(lines)) IF NOT list_contains(gone, i)], chr(10)) AS kept FROM t)
SELECT doc_id, CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines, CAST(len(gone) AS BIGINT) AS n_deleted,
       sha256(CASE WHEN len(gone) > 0 AND NOT regexp_matches(kept, '[^\x20\x09-\x0D]') THEN '' ELSE kept END) AS text_sha256
FROM k
"""
