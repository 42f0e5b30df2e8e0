"""Benchmark decontamination with one Aho-Corasick automaton.

Texts are normalised to lower-cased words with one space around each; the windows of every benchmark item
(10 consecutive words, or all words of a shorter item) become the patterns of one automaton, which each
document's normalised text passes once. A match's end, counted in spaces, is a word index; word indices
lead back to places in the original text.

The automaton is sent to the workers only while the items hold at most ``MAX_WORDS`` words; beyond that the
items, long ones in pieces, are dealt into as many shards as that bound needs. Each shard is sent for a pass of its own over the
documents, written before the next one begins, and the hit words of a document are united; no worker and no
broadcast ever holds more than one shard.

Null and empty texts have no words, hit nothing and are not contaminated; null items are ignored; repeated
rows give repeated rows; other columns are not read; without items nothing is contaminated.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import defaultdict

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cindermill.llm.common import columns_ddl, kept, map_batches, staged

WINDOW = 10
#: Words of benchmark items in one automaton: about 0.35 GB at 7 letters a word.
MAX_WORDS = 100_000
#: A word is a run of digits, letters and bytes beyond ASCII; A-Z become a-z, all else a space.
FOLD = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
WORD = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def padded(words: list[bytes]) -> str:
    """The words with a space on both sides of each, one character a byte."""
    return (b" " + b" ".join(words) + b" ").decode("latin-1") if words else ""


def windows(words: list[bytes]) -> list[str]:
    return [padded(words[i : i + WINDOW]) for i in range(max(1, len(words) - WINDOW + 1))] if words else []


@kept
def automaton(items: tuple[tuple[str, str], ...]) -> ahocorasick.Automaton:
    of: dict[str, set[str]] = defaultdict(set)
    for item_id, text in items:
        for w in windows(words_of(text)):
            of[w].add(item_id)
    a = ahocorasick.Automaton()
    for w, ids in of.items():
        a.add_word(w, (w.count(" ") - 1, frozenset(ids)))
    a.make_automaton()
    return a


def scan(texts: list[str | None], items: tuple[tuple[str, str], ...]) -> list[tuple[int, np.ndarray, set[str]]]:
    """Of each text: number of words, indices of hit words, items with an occurring window."""
    machine, out = automaton(items), []
    for text in texts:
        words = words_of(text)
        line, found, edges, spaces = padded(words), set(), [], None
        for end, (n, ids) in machine.iter(line) if words and len(machine) else ():
            if spaces is None:
                spaces = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
            last = int(np.searchsorted(spaces, end))
            edges.append((last - n, last))
            found |= ids
        hit = np.zeros(len(words) + 1, np.int64)
        for a, b in edges:
            hit[a] += 1
            hit[b] -= 1
        out.append((len(words), np.flatnonzero(np.cumsum(hit) > 0) if edges else np.empty(0, np.int64), found))
    return out


def spans(text: str, hit: list[int]) -> list[tuple[int, int]]:
    """Runs of hit words as places [start, end) in the original text."""
    at, out = [m.span() for m in WORD.finditer(text or "")], []
    for _, run in itertools.groupby(enumerate(hit), lambda x: x[1] - x[0]):
        run = [i for _, i in run]
        out.append((at[run[0]][0], at[run[-1]][1]))
    return out


def item_shards(benchmark: DataFrame, max_words: int) -> tuple[DataFrame, int]:
    """The items in pieces of a tenth of ``max_words`` (with the windows of the item, each once), the shard of each, and the number of shards."""
    items = benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull())
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda x: x != "")
    items = items.select(F.col("item_id").cast("string").alias("item_id"), words.alias("words"))
    n = -(-(items.agg(F.sum(F.size("words"))).first()[0] or 0) // max_words) or 1
    step = max(1, max_words // 10)
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("words") - WINDOW), F.lit(step))
    pieces = items.select("item_id", "words", F.explode(starts).alias("start")).select("item_id", "start", F.array_join(F.slice("words", F.col("start") + 1, step + WINDOW - 1), " ").alias("text"))
    return pieces.withColumn("shard", F.pmod(F.xxhash64("item_id", "start"), F.lit(n))), n


def sent(dealt: DataFrame, shard: int):
    """The items of one shard, broadcast: about ``max_words`` words."""
    items = dealt.where(F.col("shard") == shard).select("item_id", "text")
    return dealt.sparkSession.sparkContext.broadcast(tuple(sorted((r.item_id, r.text) for r in items.collect())))


def one_pass(rows: DataFrame, items, last: bool) -> DataFrame:
    """Add a shard's hit words and items to those of the passes before; the last pass drops the text and adds spans."""
    kind, held = rows.schema["doc_id"].dataType.simpleString(), len(rows.columns) > 2

    def run(batch):
        texts = batch.column(1).to_pylist()
        done = scan(texts, items.value)
        before = list(zip(*(batch.column(k).to_pylist() for k in (2, 3)), strict=True)) if held else [((), ())] * len(texts)
        hits = [sorted({*hit.tolist(), *old}) for (_, hit, _), (old, _) in zip(done, before, strict=True)]
        out = {"doc_id": batch.column(0), "text": batch.column(1), "n_words": [n for n, _, _ in done], "hit_words": hits}
        out["items"] = [sorted({*ids, *old}) for (_, _, ids), (_, old) in zip(done, before, strict=True)]
        if last:
            out["spans"] = [[{"start": a, "end": b} for a, b in spans(t, h)] if h else [] for t, h in zip(texts, hits, strict=True)]
        return out

    if last:
        return map_batches(rows, run, f"doc_id {kind}, n_words long, hit_words array<long>, items array<string>, spans array<struct<start:long,end:long>>")
    return staged(map_batches(rows, run, f"doc_id {kind}, text string, hit_words array<long>, items array<string>"))


def contaminated(docs: DataFrame, benchmark: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """Of every row: doc_id, n_words, the hit word indices, item ids and [start, end) spans in the original text."""
    dealt, n = item_shards(benchmark, max_words)
    rows = docs.select("doc_id", "text")
    for i in range(n):
        rows = one_pass(rows, sent(dealt, i), i == n - 1)
    return rows


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminated(docs, benchmark).select(
        "doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hit_words") > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """The rows of ``docs`` that hit no window, with the columns of ``docs``."""
    dealt, n = item_shards(benchmark, max_words)
    names = docs.columns

    def clean(rows: DataFrame, items) -> DataFrame:
        def run(batch):
            texts = batch.column(names.index("text")).to_pylist()
            hit = np.array([bool(found) for _, _, found in scan(texts, items.value)])
            return dict(zip(names, batch.filter(pa.array(~hit)).columns, strict=True))

        return map_batches(rows, run, columns_ddl(docs))

    for i in range(n):
        docs = clean(docs if i == 0 else staged(docs), sent(dealt, i))
    return docs


#: DuckDB: windows of both sides as word lists, joined.
ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), p AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i+9], ' ') AS k
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)
), sizes AS (SELECT DISTINCT n FROM p),
d AS (
  SELECT doc_id, i, n, array_to_string(ws[i:i+n-1], ' ') AS k
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, sizes WHERE len(ws) >= n)
), hits AS (SELECT d.doc_id, d.i, d.n, p.item_id FROM d JOIN p ON d.k = p.k AND d.n = p.n),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hits) GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
