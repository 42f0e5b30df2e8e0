"""Integrity rules as frames of violations; merging and hashing of artifact sets."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cindermill.functions.canonical import canonical_json, canonical_text


class Violated(ValueError):
    """Some rows break a rule."""


def require_empty(violations: DataFrame, code: str) -> None:
    """Raise with the first violation, if there is one."""
    if first := violations.limit(1).collect():
        raise Violated(f"{code}: {first[0].asDict()}")


def duplicates(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return rows.groupBy(*key).agg(F.count("*").alias("occurrences")).where("occurrences > 1")


def identity_conflicts(rows: DataFrame, key: list[str], content: str) -> DataFrame:
    """Violations: identities with more than one content."""
    clash = rows.groupBy(*key).agg(F.min(content).alias("low"), F.max(content).alias("high")).where("low <> high")
    return clash.select(F.lit("canonical_identity_conflict").alias("code"), F.concat_ws("@", *key).alias("subject"))


def last_wins(rows: DataFrame, key: list[str], order: list[str], keep: list[str]) -> DataFrame:
    """Of each key the row that comes last in ``order``; an aggregate, so that no key is gathered in a window."""
    last = F.max_by(F.struct(*keep), F.struct(*order)).alias("last")
    return rows.groupBy(*key).agg(last).select(*key, "last.*")


def canonical_merge(rows: DataFrame, key: list[str], content: str, precedence: str) -> DataFrame:
    """One row a key: contents met, whether they conflict, and the content of the lowest precedence."""
    return rows.groupBy(*key).agg(
        F.countDistinct(content).alias("contents"), F.count("*").alias("copies"), F.min_by(content, precedence).alias(content)
    ).withColumn("conflict", F.col("contents") > 1)


#: Characters of one chunk of a list's text.
CHUNK = 16_384


def list_hashes(rows: DataFrame, group: list[str], order: str, text: str, before: str = "[", after: str = "]") -> DataFrame:
    """``group``, set_hash: the SHA-256 of ``before``, each group's texts in the order of ``order`` with commas between, and ``after``.

    Rows are parted by ranges of (group, order), so a group of any size is spread; each part writes its texts as chunks, and
    the chunks of a group then pass through one task in order, a batch of them at a time. Equal keys go in the order of the texts.
    """
    key = F.to_json(F.struct(*group)) if group else F.lit("")
    parts = rows.select(key.alias("g"), F.col(order).alias("o"), F.col(text).alias("t")).repartitionByRange("g", "o", "t").sortWithinPartitions("g", "o", "t")
    chunks = parts.select("g", "t").mapInArrow(_chunks, "g string, part int, number int, chunk string")
    hashes = chunks.repartition("g").sortWithinPartitions("g", "part", "number").mapInArrow(_hasher(before, after), "g string, set_hash string")
    if not group:
        return hashes.select("set_hash")
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.select(*group).dtypes)
    return hashes.select(F.from_json("g", schema).alias("g"), "set_hash").select("g.*", "set_hash")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, number, at, held, size = TaskContext.get().partitionId(), 0, None, [], 0
    out: list[tuple] = []
    for batch in batches:
        for g, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if held and (g != at or size >= CHUNK):
                out.append((at, part, number, ",".join(held)))
                number, held, size = number + 1, [], 0
            at = g
            held.append(t)
            size += len(t)
        yield _batch(out)
        out = []
    if held:
        yield _batch([(at, part, number, ",".join(held))])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int32(), pa.int32(), pa.string()), strict=True)], ["g", "part", "number", "chunk"])


def _hasher(before: str, after: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None
        for batch in batches:
            done: list[tuple[str, str]] = []
            for g, chunk in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if g == at:
                    digest.update(b",")
                else:
                    if digest:
                        digest.update(after.encode())
                        done.append((at, digest.hexdigest()))
                    at, digest = g, hashlib.sha256(before.encode())
                digest.update(chunk.encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], pa.string()) for i in range(2)], ["g", "set_hash"])
        if digest:
            digest.update(after.encode())
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in (at, digest.hexdigest())], ["g", "set_hash"])

    return run


def set_hash(rows: DataFrame, group: list[str], order: str, fields: list[str]) -> DataFrame:
    """``group``, entries, set_hash: the hash of each group's canonical list of entries (``fields`` as texts) in the order of ``order``."""
    entry = canonical_text(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in fields])), nfc=False)
    sizes = rows.groupBy(*group).agg(F.count("*").alias("entries"))
    hashes = list_hashes(rows.withColumn("entry", entry), group, order, "entry").withColumnsRenamed({c: f"{c}_of" for c in group})
    return sizes.join(hashes, [F.col(c).eqNullSafe(F.col(f"{c}_of")) for c in group]).drop(*[f"{c}_of" for c in group])


def key_hash(selected: DataFrame, document: dict, field: str) -> str | None:
    """The hash of a canonical key document whose list at ``field`` (a path of keys) is ``selected`` (one text column) in the order of code points."""
    mark = "\x00"
    at = document = json.loads(json.dumps(document))
    *way, last = field.split("/")
    for k in way:
        at = at.setdefault(k, {})
    at[last] = [mark]
    before, after = (canonical_json(document, nfc=True) + "\n").split(json.dumps(mark))
    texts = selected.toDF("key").withColumn("text", canonical_text(F.to_json(F.array("key"))))
    inner = texts.withColumn("text", F.expr("substring(text, 2, length(text) - 2)"))
    found = list_hashes(inner, [], "key", "text", before, after).first()  # one row
    return found.set_hash if found else hashlib.sha256((before + after).encode()).hexdigest()


def numbered(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """1-based numbers inside each group."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def record_count(text: str):
    """Records of a file's text, one a line; the last one counts without a line end too."""
    ends = F.length(text) - F.length(F.replace(F.col(text), F.lit("\n"), F.lit("")))
    return (ends + F.when((F.length(text) == 0) | F.endswith(F.col(text), F.lit("\n")), 0).otherwise(1)).cast("long")
