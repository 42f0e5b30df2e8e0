"""Best-fit packing by exact-complement hashing.

Spark tokenizes every text in one pass and counts pieces by length: a histogram of at most ``capacity`` rows,
whatever the size of the corpus. Over that histogram the driver plans patterns (tuples of lengths with a
number of sequences): for each length, single, pair and triple sums that fill its gap exactly are looked up
in the index of available lengths and consumed as long as counts last; the residue is packed best-fit
decreasing. Spark then ranks the pieces of each length (counts by task, running sums over tasks) and looks
every rank up in the plan. Nothing but the histogram and the plan passes the driver.

Null text counts as empty: one piece, the end id alone. Repeated rows are packed as often as they come;
null ids are kept; columns other than ``doc_id`` and ``text`` are not read; no rows give no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cindermill.llm.common import BATCH_ROWS, make_room, map_batches, pa_schema, staged, trim
from cindermill.llm.token_counts import VOCABULARY, pre_tokens

END = (0).to_bytes(4, "little")
#: Rows whose ids are made at once; a worker's memory follows.
ENCODED_ROWS = 500


class Lengths:
    """Available lengths with counts; a bit mask of those left answers the sum look-ups."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.count, self.capacity, self.mask, self.mirror = dict(counts), capacity, 0, 0
        for n in counts:
            self.mask |= 1 << n
            self.mirror |= 1 << (capacity - n)

    def take(self, lengths: tuple[int, ...]) -> int:
        """Consume ``lengths`` together as often as the counts allow."""
        need = Counter(lengths)
        n = min(self.count[x] // k for x, k in need.items())
        for x, k in need.items():
            self.spend(x, k * n)
        return n

    def spend(self, x: int, n: int) -> None:
        self.count[x] -= n
        if not self.count[x]:
            self.mask &= ~(1 << x)
            self.mirror &= ~(1 << (self.capacity - x))

    def has(self, lengths: tuple[int, ...]) -> bool:
        return all(self.count.get(x, 0) >= k for x, k in Counter(lengths).items())

    def single(self, first: int, gap: int) -> tuple[int, ...] | None:
        return (gap,) if self.has((first, gap)) else None

    def pair(self, held: tuple[int, ...], gap: int) -> tuple[int, ...] | None:
        """Two lengths that sum to ``gap``, the larger one as large as possible."""
        found = self.mask & (self.mirror >> (self.capacity - gap)) if gap > 1 else 0
        found &= (1 << gap) - 1
        while found:
            x = found.bit_length() - 1
            if 2 * x < gap:
                return None
            if self.has((*held, x, gap - x)):
                return (x, gap - x)
            found ^= 1 << x
        return None

    def triple(self, first: int, gap: int) -> tuple[int, ...] | None:
        left = self.mask & ((1 << max(gap - 1, 0)) - 1)
        while left:
            x = left.bit_length() - 1
            if 3 * x < gap:
                return None
            if rest := self.pair((first, x), gap - x):
                return (x, *rest)
            left ^= 1 << x
        return None


def plan_patterns(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths, each with its number of sequences, that use up ``counts``."""
    left, plan = Lengths({n: c for n, c in counts.items() if c}, capacity), []
    for first in sorted(left.count, reverse=True):
        gap = capacity - first
        if not gap:
            plan.append(((first,), left.take((first,))))
            continue
        for look in (left.single, lambda f, g: left.pair((f,), g), left.triple):
            while left.count[first] and (rest := look(first, gap)):
                plan.append(((first, *rest), left.take((first, *rest))))
    opened: dict[int, list[list]] = defaultdict(list)
    gaps = 0

    def keep(pattern: tuple[int, ...], n: int) -> None:
        nonlocal gaps
        gap = capacity - sum(pattern)
        opened[gap].append([pattern, n])
        gaps |= 1 << gap

    for length in sorted((x for x, c in left.count.items() if c), reverse=True):
        c = left.count[length]
        while c:
            if fits := gaps >> length:
                gap = length + (fits & -fits).bit_length() - 1
                pattern, n = opened[gap][-1]
                used = min(n, c)
                opened[gap][-1][1] -= used
                if used == n:
                    opened[gap].pop()
                    if not opened[gap]:
                        gaps &= ~(1 << gap)
                keep((*pattern, length), used)
                c -= used
            else:
                k = capacity // length
                if c >= k:
                    keep((length,) * k, c // k)
                if c % k:
                    keep((length,) * (c % k), 1)
                c = 0
    return plan + [(p, n) for group in opened.values() for p, n in group]


def segments(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first ranks (ascending), the sequence of each first rank, the place in the sequence."""
    used, base, out = Counter(), 0, defaultdict(list)
    for pattern, n in plan:
        at = 0
        for length in pattern:
            out[length].append((used[length], base, at))
            used[length] += n
            at += length
        base += n
    return {k: tuple(np.array(c, dtype=np.int64) for c in zip(*v, strict=True)) for k, v in out.items()}


def tokenized_pieces(docs: DataFrame, vocabulary: str, capacity: int) -> DataFrame:
    """One row a piece, with its task and its rank among the task's pieces of that length."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, nth long"
    target = pa_schema(docs.sparkSession, schema)
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def cut(batches):
        make_room(__name__)
        known, task, seen = pre_tokens(vocabulary), TaskContext.get().partitionId(), Counter()
        for batch in (whole.slice(i, ENCODED_ROWS) for whole in batches for i in range(0, whole.num_rows, ENCODED_ROWS)):
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), known.encode(batch.column(1)).ids(), strict=True):
                ids += END
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    length = len(part) // 4
                    rows.append((doc_id, piece, at // 4, length, zlib.crc32(part), task, seen[length]))
                    seen[length] += 1
            columns = zip(*rows, strict=True) if rows else [()] * len(target)
            yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(columns, target, strict=True)], schema=target)
        trim()

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = 2048) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of ``docs``."""
    pieces = staged(tokenized_pieces(docs, vocabulary, capacity))
    by_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    counts = {r.length: r.n for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = segments(plan_patterns(counts, capacity))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = pieces.join(first, ["task", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("nth")).alias("rank"))

    def place(batch):
        length, rank = (batch.column(i).to_numpy() for i in (3, 5))
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for x in np.unique(length):
            at = np.flatnonzero(length == x)
            firsts, bases, places = plan[int(x)]
            k = np.searchsorted(firsts, rank[at], side="right") - 1
            sequence[at], offset[at] = bases[k] + rank[at] - firsts[k], places[k]
        return {c: batch.column(i) for i, c in enumerate(batch.schema.names)} | {"sequence_id": sequence, "offset": offset}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(ranked, place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
