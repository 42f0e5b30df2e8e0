"""Frames written as a bundle: gzipped NDJSON artifacts and the manifest that lists them, in one commit."""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cindermill.sources.archive import MANIFEST
from cindermill.sources.shared import scratch
from cindermill.sources.sink import write_files

#: Rows of one artifact, about; items of one feed page.
ROWS = 10_000


ARTIFACT = "path string, content binary, uncompressedSha256 string, uncompressedByteSize long, recordCount long, kind string"


def artifacts(kind: str, rows: DataFrame, size: int = ROWS) -> DataFrame:
    """The artifacts of a kind: path, content, and what the manifest says of them. Rows are dealt by hash and ordered in their task, which packs them batch by batch and begins an artifact after every ``size`` of them."""
    lines = rows.select(F.to_json(F.struct("*")).alias("line"))
    return lines.repartition(F.xxhash64("line")).sortWithinPartitions("line").mapInArrow(_packer(kind, size), ARTIFACT)


def _packer(kind: str, size: int):
    """Of a task's lines, one artifact at a time: gzip, the same lines give the same bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, at = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            lines = batch.column(0)
            while len(lines):
                at = at or Packed()
                now = lines.slice(0, size - at.records)
                at.add(now)
                lines = lines.slice(len(now))
                if at.records == size:
                    yield at.row(kind, part, number)
                    number, at = number + 1, None
        if at:
            yield at.row(kind, part, number)

    return run


class Packed:
    """Lines on their way into a gzipped artifact."""

    def __init__(self):
        self.zip, self.out, self.hash, self.byte_size, self.records = zlib.compressobj(6, zlib.DEFLATED, 31), [], hashlib.sha256(), 0, 0

    def add(self, lines: pa.Array) -> None:
        text = "\n".join([*lines.to_pylist(), ""]).encode()
        self.hash.update(text)
        self.out.append(self.zip.compress(text))
        self.byte_size, self.records = self.byte_size + len(text), self.records + len(lines)

    def row(self, kind: str, part: int, number: int) -> pa.RecordBatch:
        values = f"data/{kind}-{part:05d}-{number:06d}.ndjson.gz", b"".join([*self.out, self.zip.flush()]), self.hash.hexdigest(), self.byte_size, self.records, kind
        return pa.RecordBatch.from_pydict({f.split()[0]: [x] for f, x in zip(ARTIFACT.split(", "), values, strict=True)})


def manifest(entries: list[dict], calculation: str, schema: str) -> str:
    """The manifest's text with the hash of itself; ``schema`` names its contract."""
    text = json.dumps({"artifacts": entries, "bundleContentHash": "0" * 64, "calculationId": calculation, "schemaVersion": schema}, separators=(",", ":"))
    field = f'"bundleContentHash":"{"0" * 64}",'
    return text.replace("0" * 64, hashlib.sha256(text.replace(field, "").encode()).hexdigest())


def write_bundle(spark: SparkSession, frames: dict[str, DataFrame], target: str, calculation: str = "calculation", schema: str = "bundle.v2") -> str:
    """A bundle of the frames (by kind), which ``archive.Intake`` reads. The artifacts go through a staged table, so each is made once."""
    every = None
    for kind, rows in frames.items():
        files = artifacts(kind, rows)
        every = files if every is None else every.unionByName(files)
    path = scratch(spark, "artifacts")
    every.write.parquet(path)
    staged = spark.read.parquet(path)
    digest = staged.select("kind", "path", F.lit("gzip").alias("compression"), F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("long").alias("byteSize"), "uncompressedSha256", "uncompressedByteSize", "recordCount")
    entries = [r.asDict() for r in digest.orderBy("path").collect()]  # an artifact each, as the manifest lists them
    listing = spark.createDataFrame([(MANIFEST, manifest(entries, calculation, schema).encode())], "path string, content binary")
    return write_files(staged.select("path", "content").union(listing), target)


def write_pages(items: DataFrame, target: str, size: int = 200) -> str:
    """``items`` (number: from 0 without gaps; item: JSON text) as the pages of a feed, ``size`` each."""
    at = F.floor(F.col("number") / size)
    last = items.agg(F.max(at)).first()[0]
    name = lambda n: F.when(n == 0, F.lit("first")).otherwise(F.format_string("page-%08d", n))
    pages = items.groupBy(at.alias("at")).agg(F.transform(F.array_sort(F.collect_list(F.struct("number", "item"))), lambda x: x["item"]).alias("items"))
    following = F.when(F.col("at") < F.lit(last), F.concat(F.lit(',"nextCursor":"'), name(F.col("at") + 1), F.lit('"'))).otherwise("")
    content = F.concat(F.lit('{"items":['), F.array_join("items", ","), F.lit("]"), following, F.lit("}"))
    return write_files(pages.select(F.concat(name(F.col("at")), F.lit(".json")).alias("path"), content.alias("content")), target)
