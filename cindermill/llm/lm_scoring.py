"""Language-model scoring with a log-frequency Bloom filter.

Words and word pairs of the training texts are counted by Spark. A count c is quantised to
q = 1 + floor(log_BASE c), and the filter holds the keys (n-gram, 1) ... (n-gram, q): a look-up probes level
after level until one is missing, which gives the count back. All bits of a key lie in one 64-bit word. The
filter consists of slices, one group of n-grams a slice, and is never held in one place, whatever its size: the
n-grams of a block of texts are taken once each, with how often the block trains on them, and dealt by slice; a
slice's task sets its bits and probes them for every block, and the levels found go back to the block. As a
count c gives at most c keys, the tokens bound the keys, and so the size.

The model is a word-pair model with Dirichlet smoothing: p(w | v) = (c(v w) + K p(w)) / (c(v) + K), where
p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)), counts from the filter. The base score uses exact counts: the MAX_HOT
most frequent words are sent to the workers, the other occurrences are joined with the table of counts.

Tokens: lower-cased (A-Z) words between white space and one end a text. Null and empty texts consist of the
end; a null id is trained on; repeated rows give repeated rows (and count repeatedly); other columns are not
read; without training texts every count is 0.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cindermill.llm.common import BATCH_ROWS, as_arrow, crc_mod, map_batches, pa_schema, py_crc_mod, staged

END = b" end"
BASE, K, ADD = 1.5, 8.0, 0.1
#: Bits of the filter a training token (keys are fewer than tokens), bits set by an entry; training tokens and bytes of a slice; words sent to the workers.
BITS, PROBES, SLICE, MAX_BYTES, MAX_HOT = 7, 4, 500_000, 1 << 28, 100_000
#: Characters of the texts in one block.
BLOCK = 4 << 20
#: Constants of the 64-bit mixers: odd numbers of no further meaning.
M1, M2, M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Bytes of an n-gram's hash inside its slice (a slice has some 500,000 n-grams, two of which agree in 48 bits once in 2,000 slices).
GRAM_BYTES = 6


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * M1
    x = (x ^ (x >> np.uint64(29))) * M2
    return x ^ (x >> np.uint64(32))


class Tokens:
    """The tokens of a batch of texts: numbers into ``words``, with where each text ends."""

    def __init__(self, texts: list[str | None]):
        number: dict[bytes, int] = {}
        put, rows = number.setdefault, []
        for t in texts:
            words = (t or "").encode("utf-8", "surrogatepass").translate(FOLD).split()
            words.append(END)
            rows.append([put(w, len(number)) for w in words])
        self.words = list(number)
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.ids = np.fromiter((i for r in rows for i in r), np.int64, int(self.sizes.sum()))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the context of every token (0: the start of a text) and of the pair."""
        own = self.hashes[self.ids]
        before = np.roll(own, 1)
        before[self.starts] = np.uint64(0)
        return before, mix(before * M3 + own)


def training(docs: DataFrame) -> DataFrame:
    return docs.select("text").where(F.coalesce(crc_mod(F.col("doc_id"), 10), F.lit(-1)) != 0)


def word_counts(texts: DataFrame) -> DataFrame:
    """word, c: exact counts; each task adds up its own words in parts of bounded size."""
    schema = "word string, n long"
    target = pa_schema(texts.sparkSession, schema)
    texts.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def run(batches):
        held: dict[bytes, int] = {}

        def out():
            cols = [pa.array([w.decode("utf-8", "surrogatepass") for w in held]), pa.array(list(held.values()))]
            return pa.RecordBatch.from_arrays([as_arrow(c, x.type) for c, x in zip(cols, target, strict=True)], schema=target)

        for b in batches:
            t = Tokens(b.column(0).to_pylist())
            for w, n in zip(t.words, np.bincount(t.ids, minlength=len(t.words)).tolist(), strict=True):
                held[w] = held.get(w, 0) + n
            if len(held) > 200_000:
                yield out()
                held.clear()
        if held:
            yield out()

    return texts.mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("c"))


def quantised(c: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(c, 1)) / math.log(BASE) + 1e-9).astype(np.int64)


def counted(q: np.ndarray) -> np.ndarray:
    """The count that a level stands for: the middle, on the log scale, of those quantised to it."""
    return np.where(q <= 0, 0.0, np.where(q <= 1, 1.0, BASE ** (q - 0.5)))


def keys(grams: np.ndarray, level: int | np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Place (a 64-bit word: slices by the n-gram's own high bits) and bits of the keys (n-gram, level)."""
    h = mix((grams & np.uint64((1 << 8 * GRAM_BYTES) - 1)) + np.asarray(level).astype(np.uint64) * M2)
    mask = np.zeros(len(grams), np.uint64)
    for i in range(PROBES):
        mask |= np.uint64(1) << ((h >> np.uint64(6 * i)) & np.uint64(63))
    return ((h >> np.uint64(32)) * np.uint64(n_words)) >> np.uint64(32), mask


def slice_of(grams: np.ndarray, slices: int) -> np.ndarray:
    return ((mix(grams ^ M3) >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)


class Filter:
    """Slices of equal size side by side; an n-gram's keys lie all in its slice."""

    def __init__(self, words: np.ndarray, slices: int):
        self.words, self.slices, self.size = words, slices, len(words) // slices

    def quantised(self, grams: np.ndarray) -> np.ndarray:
        q, left, base = np.zeros(len(grams), np.int64), np.arange(len(grams)), slice_of(grams, self.slices) * np.uint64(self.size)
        level = 1
        while len(left):
            place, mask = keys(grams[left], level, self.size)
            left = left[(self.words[base[left] + place] & mask) == mask]
            q[left] = level
            level += 1
        return q


def dealt(grams: np.ndarray, slices: int) -> tuple[np.ndarray, list[int], list[tuple[int, int]]]:
    """The order of n-grams by slice, the slices met and the span of each in that order."""
    at = slice_of(grams, slices).astype(np.int64)
    order = np.argsort(at, kind="stable")
    met, first = np.unique(at[order], return_index=True)
    cut = [*first.tolist(), len(grams)]
    return order, met.tolist(), list(zip(cut, cut[1:], strict=False))


def sizes_of(tokens: int, max_bytes: int) -> tuple[int, int]:
    """Number of slices of the filter for so many training tokens, and 64-bit words of each (16 or more).

    ``max_bytes`` bounds a slice, but not under 4 KB: small slices fill unevenly.
    """
    slices = max(1, -(-tokens // SLICE), -(-tokens * BITS // 8 // max(4096, max_bytes)))
    return slices, max(16, -(-tokens * BITS // 64 // slices))


class Block:
    """The tokens of some texts as they are kept: word hashes, the words' numbers, sizes of the texts and whether they are trained on."""

    FIELDS = (("hashes", np.uint64), ("ids", np.uint8), ("sizes", np.int64), ("trained", np.bool_))
    TYPE = "struct<" + ",".join(f"{name}:binary" for name, _ in FIELDS) + ">"

    def __init__(self, kept: dict[str, bytes]):
        self.hashes, _, self.sizes, self.trained = (np.frombuffer(kept[name], kind) for name, kind in self.FIELDS)
        planes = pa.decompress(kept["ids"], 4 * int(self.sizes.sum()), "zstd", asbytes=True)
        self.ids = np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view(np.int32).ravel()
        self.starts = np.cumsum(self.sizes) - self.sizes
        pairs, self.pair = np.unique(Tokens.pairs(self)[1], return_inverse=True)
        self.grams = np.concatenate([self.hashes, pairs])

    @staticmethod
    def kept(t: Tokens, trained: list[bool]) -> dict[str, bytes]:
        planes = t.ids.astype(np.int32).view(np.uint8).reshape(-1, 4).T.tobytes()  # low bytes first: they pack better
        return {"hashes": t.hashes.tobytes(), "ids": pa.compress(planes, "zstd", asbytes=True), "sizes": t.sizes.tobytes(), "trained": np.array(trained, np.bool_).tobytes()}

    def counts(self) -> np.ndarray:
        """How often the trained texts hold each n-gram."""
        on = np.repeat(self.trained, self.sizes)
        words = np.bincount(self.ids[on], minlength=len(self.hashes))
        return np.concatenate([words, np.bincount(self.pair[on], minlength=len(self.grams) - len(words))])

    def scores(self, q: np.ndarray, n: int, v: int) -> np.ndarray:
        """The model's score of every text from the levels of the n-grams."""
        c = counted(q)
        word = c[self.ids]
        before = np.roll(word, 1)
        before[self.starts] = word[self.starts + self.sizes - 1]  # the end of a text stands before its start
        return np.add.reduceat(probability(c[len(self.hashes) + self.pair], before, word, n, v), self.starts)


def packed(grams: np.ndarray) -> bytes:
    """The bytes of n-grams that tell them apart inside a slice."""
    return grams.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :GRAM_BYTES].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // GRAM_BYTES, 8), np.uint8)
    out[:, :GRAM_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, GRAM_BYTES)
    return out.view("<u8").ravel().astype(np.uint64)


def packed_counts(n: np.ndarray) -> bytes:
    """A byte each, or four where one needs more."""
    return n.astype(np.uint8 if n.max(initial=0) < 256 else np.uint32).tobytes()


def unpacked_counts(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8 if len(data) == n else np.uint32)


def slice_bits(grams: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """The bits of one slice: n-grams (repeats add up) with their counts."""
    gram, at = np.unique(grams, return_inverse=True)
    c, bits = np.bincount(at, n, len(gram)), np.zeros(size, np.uint64)
    gram, q = gram[c > 0], quantised(c[c > 0])
    for level in range(1, int(q.max(initial=0)) + 1):
        place, mask = keys(gram[q >= level], level, size)
        np.bitwise_or.at(bits, place.astype(np.int64), mask)
    return bits


def levels(blocks: DataFrame, slices: int, size: int) -> DataFrame:
    """block, slice, q: the filter's answers, a byte each, for the n-grams of every block (in the order of ``dealt``)."""
    schema = "slice long, block long, grams binary, counts binary"

    def deal(batch):
        out = {"slice": [], "block": [], "grams": [], "counts": []}
        for number, kept in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            block = Block(kept)
            order, met, spans = dealt(block.grams, slices)
            grams, n = block.grams[order], block.counts()[order]
            out["slice"] += met
            out["block"] += [number] * len(met)
            out["grams"] += [packed(grams[a:b]) for a, b in spans]
            out["counts"] += [packed_counts(n[a:b]) for a, b in spans]
        return out

    def probe(key, group):
        parts = [unpacked(x) for x in group.column("grams").to_pylist()]
        grams = np.concatenate(parts)
        n = np.concatenate([unpacked_counts(x, len(p)) for x, p in zip(group.column("counts").to_pylist(), parts, strict=True)])
        asked, at = np.unique(grams, return_inverse=True)
        q = Filter(slice_bits(grams, n, size), 1).quantised(asked).astype(np.uint8)[at]
        ends = np.cumsum([len(x) for x in parts]).tolist()
        q = [q[a:b].tobytes() for a, b in zip([0, *ends], ends, strict=False)]
        return pa.table({"block": group.column("block"), "slice": group.column("slice"), "q": pa.array(q, pa.binary())})

    return map_batches(blocks, deal, schema).groupBy("slice").applyInArrow(probe, "block long, slice long, q binary")


def model_scores(blocks: DataFrame, n: int, v: int, max_bytes: int) -> DataFrame:
    """row, model: the scores of the texts of ``blocks`` (block: the first text's row)."""
    slices, size = sizes_of(n, max_bytes)
    found = staged(levels(blocks, slices, size))  # an execution of its own: its shuffle goes when it ends

    def score(key, own, answers):
        block = Block(own.column("kept").to_pylist()[0])
        order, _, _ = dealt(block.grams, slices)
        q = np.empty(len(order), np.int64)
        q[order] = np.frombuffer(b"".join(answers.sort_by("slice").column("q").to_pylist()), np.uint8)
        first = key[0].as_py()
        return pa.table({"row": pa.array(range(first, first + len(block.sizes)), pa.int64()), "model": block.scores(q, n, v)})

    return blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(score, "row long, model double")


def probability(pair: np.ndarray, context: np.ndarray, word: np.ndarray, n: int, v: int) -> np.ndarray:
    """log10 p(w | v) from the three counts."""
    alone = (word + ADD) / (n + ADD * (v + 1))
    return np.log10((np.minimum(np.minimum(pair, context), word) + K * alone) / (context + K))


def parts_of(texts: list[str | None]) -> list[tuple[int, int]]:
    """Spans of rows of BLOCK characters each, or of one text."""
    cuts, size = [0], 0
    for i, t in enumerate(texts):
        size += len(t or "") + 1
        if size > BLOCK and i > cuts[-1]:
            cuts.append(i)
            size = len(t or "") + 1
    return list(zip(cuts, [*cuts[1:], len(texts)], strict=True))


def rows_of(docs: DataFrame, hot: dict[bytes, int], n: int, v: int) -> DataFrame:
    """Of every row: row key, doc_id, fold, tokens, sums over the frequent words, the other words; of a block's first row the block."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    floor = math.log10(n + ADD * (v + 1))
    schema = f"row long, doc_id {kind}, held_out boolean, n_tokens long, known long, base double, rare array<struct<word:string,tf:long>>, kept {Block.TYPE}"
    target = pa_schema(docs.sparkSession, schema)
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    hot = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches):
        pa.default_memory_pool().release_unused()  # of the counting tasks before
        row = TaskContext.get().partitionId() << 33
        for whole in batches:
            texts = whole.column(1).to_pylist()
            for lo, hi in parts_of(texts) if texts else ():
                t = Tokens(texts[lo:hi])
                c = np.fromiter((hot.value.get(w, 0) for w in t.words), np.int64, len(t.words))
                token = c[t.ids]
                base = np.add.reduceat(np.where(token > 0, np.log10(np.maximum(token, 1) + ADD) - floor, 0.0), t.starts)
                words = [w.decode("utf-8", "surrogatepass") for w in t.words]
                cold = np.flatnonzero(token == 0)
                at = np.repeat(np.arange(len(t.sizes)), t.sizes)[cold] * len(words) + t.ids[cold]
                at, tf = np.unique(at, return_counts=True)  # each text's other words once
                cut = np.searchsorted(at // len(words), np.arange(len(t.sizes) + 1))
                other = pa.StructArray.from_arrays([pa.array(words, pa.string()).take(pa.array(at % len(words))), pa.array(tf)], ["word", "tf"])
                rare = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), other)
                ids = whole.column(0).slice(lo, hi - lo)
                held_out = [py_crc_mod(i, 10) == 0 for i in ids.to_pylist()]
                out = {
                    "row": range(row, row + len(ids)), "doc_id": ids, "held_out": held_out, "n_tokens": t.sizes,
                    "known": np.add.reduceat((token > 0).astype(np.int64), t.starts), "base": base, "rare": rare,
                    "kept": [Block.kept(t, [not h for h in held_out])] + [None] * (len(ids) - 1),
                }
                row += len(ids)
                yield pa.RecordBatch.from_arrays([as_arrow(out[x.name], x.type) for x in target], schema=target)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def scored(docs: DataFrame, max_bytes: int = MAX_BYTES, max_hot: int = MAX_HOT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``."""
    texts = training(docs)
    counts = staged(word_counts(texts))
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = total.n, total.v
    hot = {r.word.encode("utf-8", "surrogatepass"): r.c for r in counts.orderBy(F.desc("c"), "word").limit(max_hot).toLocalIterator()}
    rows = staged(rows_of(docs, hot, n, v))
    rare = rows.select("row", F.explode("rare").alias("x")).select("row", "x.word", "x.tf")
    c = F.coalesce("c", F.lit(0))
    per = rare.join(counts, "word", "left").select("row", (F.col("tf") * (F.log10(c + ADD) - math.log10(n + ADD * (v + 1)))).alias("base_"), F.when(c > 0, F.col("tf")).otherwise(0).alias("known_"))
    per = staged(per.groupBy("row").agg(F.sum("base_").alias("base_"), F.sum("known_").alias("known_")))  # of its own, as ``levels`` are
    model = model_scores(rows.where("kept is not null").select(F.col("row").alias("block"), "kept"), n, v, max_bytes)
    out = rows.drop("rare", "kept").join(per, "row", "left").join(model, "row")
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("known_", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_", F.lit(0.0))).alias("base_score"), F.col("model").alias("score"),
    )
