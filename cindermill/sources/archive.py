"""Bundles in a ZIP archive or a folder: a catalog of their members, and the lines of their artifacts, as Python data sources.

The driver reads the list of members (bounded by ``MAX_ENTRIES``), rejects what is unsafe and deals the members over
partitions by size; tasks open the archive where it lies and stream their members, so nothing is unpacked and no member
is held whole. Paths may be URIs of any file system that Arrow knows.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import re
import stat
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cindermill.functions.canonical import bundle_hash
from cindermill.sources.bundle import SCHEMAS
from cindermill.sources.files import Rejected, place

#: How many entries and bytes an archive may hold, the manifest's name.
MAX_ENTRIES, MAX_BYTES = 10_000, 16 * 1024**3
MANIFEST = "calculation-bundle.json"
#: Bytes of members in one partition (a larger member has one of its own), of one read, lines of one batch; how many bytes a gzipped byte counts for.
PART_BYTES, CHUNK, LINES, UNPACKED = 64 * 1024**2, 1024**2, 2000, 16


@dataclass(frozen=True)
class Member:
    name: str
    byte_size: int


@dataclass
class Members(InputPartition):
    """The members that one task reads."""

    names: list[str]


class Bundle:
    """A bundle's members, checked; open for reading."""

    def __init__(self, path: str, max_entries: int = MAX_ENTRIES, max_bytes: int = MAX_BYTES):
        self.path, self.max_entries, self.max_bytes = path, max_entries, max_bytes
        self.system, self.inner = place(path)
        info = self.system.get_file_info(self.inner)
        if info.type == arrow_fs.FileType.NotFound:
            raise Rejected("bundle_not_found", path)
        self.folder = info.type == arrow_fs.FileType.Directory

    def members(self) -> list[Member]:
        """All members in the order of their names."""
        found = self._files() if self.folder else self._entries()
        return sorted(found, key=lambda m: m.name)

    def _files(self) -> list[Member]:
        if isinstance(self.system, arrow_fs.LocalFileSystem):  # links are a matter of local folders; before the listing, which follows them
            self._no_links(self.inner)
        files = self.system.get_file_info(arrow_fs.FileSelector(self.inner, recursive=True))
        return [Member(f.path[len(self.inner) :].lstrip("/"), f.size) for f in files if f.type == arrow_fs.FileType.File]

    def _no_links(self, folder: str) -> None:
        import os

        for entry in os.scandir(folder):
            if entry.is_symlink():
                raise Rejected("bundle_symlink_rejected", entry.path)
            if entry.is_dir():
                self._no_links(entry.path)

    def _entries(self) -> list[Member]:
        with self._zip() as archive:
            out, total, seen = [], 0, set()
            for n, entry in enumerate(archive.infolist(), 1):
                total += entry.file_size
                if n > self.max_entries or total > self.max_bytes:
                    raise Rejected("bundle_limits_exceeded", self.path)
                name = entry.orig_filename.replace("\\", "/")
                if name.startswith("/") or ".." in name.split("/") or re.match("[A-Za-z]:", name):
                    raise Rejected("unsafe_bundle_path", entry.orig_filename)
                if stat.S_ISLNK(entry.external_attr >> 16):
                    raise Rejected("bundle_symlink_rejected", entry.orig_filename)
                if name.endswith("/"):
                    continue
                if name in seen:
                    raise Rejected("bundle_entry_exists", name)
                seen.add(name)
                out.append(Member(name, entry.file_size))
        return out

    def _zip(self) -> zipfile.ZipFile:
        try:
            return zipfile.ZipFile(self.system.open_input_file(self.inner))
        except (zipfile.BadZipFile, ValueError) as e:  # Arrow refuses to seek where no directory can be
            raise Rejected("bundle_archive_invalid", f"{self.path}: {e}") from e

    def chunks(self, names: list[str]) -> Iterator[tuple[str, io.BufferedIOBase]]:
        """Every member with an open stream of its bytes."""
        if self.folder:
            for name in names:
                with self.system.open_input_file(f"{self.inner}/{name}") as f:
                    yield name, f
            return
        with self._zip() as archive:
            entries = {e.orig_filename.replace("\\", "/"): e for e in archive.infolist()}
            for name in names:
                with archive.open(entries[name]) as f:
                    yield name, f

    def read(self, name: str) -> bytes:
        for _, f in self.chunks([name]):
            return f.read()

    def manifest(self) -> tuple[str, bytes]:
        """The manifest's folder (with a slash, or empty) and bytes: in the root, or in exactly one folder of it."""
        names = {m.name for m in self.members()}
        if MANIFEST in names:
            return "", self.read(MANIFEST)
        found = [n for n in names if n.count("/") == 1 and n.endswith(f"/{MANIFEST}")]
        if len(found) != 1:
            raise Rejected("bundle_manifest_not_found", f"{len(found)} in {self.path}")
        return found[0][: -len(MANIFEST)], self.read(found[0])


def dealt(members: list[Member], size: int = PART_BYTES) -> list[Members]:
    """Members in partitions of about ``size`` bytes to read, which of a gzipped one are more than its own."""
    out, held = [], 0
    for m in members:
        bytes_read = m.byte_size * (UNPACKED if m.name.endswith(".gz") else 1)
        if not out or held + bytes_read > size:
            out.append(Members([]))
            held = 0
        out[-1].names.append(m.name)
        held += bytes_read
    return out


@dataclass
class Digest:
    """What a stream of bytes comes to."""

    byte_size: int = 0
    lines: int = 0
    last: bytes = b"\n"

    def __post_init__(self):
        self.hash = hashlib.sha256()

    def add(self, data: bytes) -> bytes:
        self.hash.update(data)
        self.byte_size += len(data)
        self.lines += data.count(b"\n")
        self.last = data[-1:] or self.last
        return data

    @property
    def records(self) -> int:
        """Lines, the last one with or without its end."""
        return self.lines + (self.last != b"\n")


class Metered(io.RawIOBase):
    """A stream that digests what passes."""

    def __init__(self, f, digest: Digest):
        self.f, self.digest = f, digest

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.digest.add(self.f.read(len(buffer)))
        buffer[: len(data)] = data
        return len(data)


class Reader(DataSourceReader):
    def __init__(self, options):
        limits = (int(options.get("maxEntries", MAX_ENTRIES)), int(options.get("maxBytes", MAX_BYTES)))
        self.bundle, self.part = (options["path"], *limits), int(options.get("partBytes", PART_BYTES))

    def members(self) -> list[Member]:
        return Bundle(*self.bundle).members()

    def partitions(self) -> list[Members]:
        return dealt(self.members(), self.part)


class CatalogReader(Reader):
    def read(self, partition: Members) -> Iterator[tuple]:
        for name, f in Bundle(*self.bundle).chunks(partition.names):
            raw, plain = Digest(), Digest()
            stream = io.BufferedReader(Metered(f, raw), CHUNK)
            try:
                unpacked = gzip.GzipFile(fileobj=stream) if name.endswith(".gz") else stream
                while data := unpacked.read(CHUNK):
                    plain.add(data)
            except (OSError, EOFError) as e:  # no gzip after all, or cut short
                while stream.read(CHUNK):
                    pass
                yield name, raw.byte_size, raw.hash.hexdigest(), None, None, None, f"{type(e).__name__}: {e}"
                continue
            yield name, raw.byte_size, raw.hash.hexdigest(), plain.byte_size, plain.hash.hexdigest(), plain.records, None


class LinesReader(Reader):
    def __init__(self, options):
        super().__init__(options)
        self.names = json.loads(options["members"])

    def members(self) -> list[Member]:
        wanted = set(self.names)
        return [m for m in super().members() if m.name in wanted]

    def read(self, partition: Members) -> Iterator[pa.RecordBatch]:
        for name, f in Bundle(*self.bundle).chunks(partition.names):
            stream = io.BufferedReader(gzip.GzipFile(fileobj=f) if name.endswith(".gz") else Metered(f, Digest()), CHUNK)
            number, numbers, lines, size = 0, [], [], 0
            for line in stream:
                number += 1
                if line.strip():  # blank lines count but hold no record
                    numbers.append(number)
                    lines.append(line.rstrip(b"\r\n").decode("utf-8", "replace"))
                    size += len(line)
                if len(lines) >= LINES or size >= CHUNK:
                    yield self.batch(name, numbers, lines)
                    numbers, lines, size = [], [], 0
            if lines:
                yield self.batch(name, numbers, lines)

    @staticmethod
    def batch(name: str, numbers: list[int], lines: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([name] * len(lines), pa.string()), pa.array(numbers, pa.int64()), pa.array(lines, pa.string())], ["member", "line", "value"])


class Catalog(DataSource):
    """``spark.read.format("bundle_members")``: every member with its size and digest, and those of what it holds when unpacked."""

    @classmethod
    def name(cls) -> str:
        return "bundle_members"

    def schema(self) -> str:
        return "member string, byte_size long, sha256 string, unpacked_byte_size long, unpacked_sha256 string, records long, error string"

    def reader(self, schema) -> DataSourceReader:
        return CatalogReader(self.options)


class Lines(DataSource):
    """``spark.read.format("bundle_lines")``: the lines of the members named (option ``members``, a JSON list), unpacked, blank ones left out."""

    @classmethod
    def name(cls) -> str:
        return "bundle_lines"

    def schema(self) -> str:
        return "member string, line long, value string"

    def reader(self, schema) -> DataSourceReader:
        return LinesReader(self.options)


def catalog(spark: SparkSession, path: str, **options) -> DataFrame:
    spark.dataSource.register(Catalog)
    return spark.read.format("bundle_members").options(**options).load(path)


ARTIFACT = "kind string, path string, compression string, sha256 string, byteSize long, uncompressedSha256 string, uncompressedByteSize long, recordCount long"


class Intake:
    """A bundle by its manifest: its artifacts, their records as frames, and whether all bytes are what the manifest says.

    ``schema``: the manifest's schemaVersion that is read; None takes any.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str | None = None, **options):
        spark.dataSource.register(Lines)
        self.spark, self.path, self.options = spark, path, options
        limits = {k: int(options[o]) for k, o in (("max_entries", "maxEntries"), ("max_bytes", "maxBytes")) if o in options}
        self.root, raw = Bundle(path, **limits).manifest()
        try:
            self.manifest = json.loads(raw)
        except ValueError as e:
            raise Rejected("unsupported_bundle", str(e)) from e
        m = self.manifest if isinstance(self.manifest, dict) else {}
        if (schema and m.get("schemaVersion") != schema) or not isinstance(m.get("artifacts"), list) or not re.fullmatch("[0-9a-f]{64}", str(m.get("bundleContentHash"))):
            raise Rejected("unsupported_bundle", path)
        try:
            self.observed_hash = bundle_hash(raw)
        except ValueError as e:
            raise Rejected(str(e), path) from e
        if self.observed_hash != m["bundleContentHash"]:
            raise Rejected("bundle_content_hash_mismatch", f"expected {m['bundleContentHash']}, observed {self.observed_hash}")
        self.manifest_sha256 = hashlib.sha256(raw).hexdigest()
        for a in m["artifacts"]:
            if not isinstance(a.get("path"), str) or self.member(a["path"]) is None:
                raise Rejected("unsafe_artifact_path", str(a.get("path")))

    def member(self, path: str) -> str | None:
        """The member that an artifact's path names, seen from the manifest; None where it leads out of its folder."""
        parts: list[str] = []
        for p in path.split("/"):
            if p == ".." and not parts or path.startswith("/"):
                return None
            parts = parts[:-1] if p == ".." else parts if p in ("", ".") else [*parts, p]
        return self.root + "/".join(parts) if parts else None

    def artifacts(self) -> DataFrame:
        """The manifest's artifacts, with the member of each: as many rows as the manifest lists, which the caps bound."""
        fields = [f.split()[0] for f in ARTIFACT.split(", ")]
        rows = [(self.member(a["path"]), *[a.get(f) for f in fields]) for a in self.manifest["artifacts"]]
        return self.spark.createDataFrame(rows, f"member string, {ARTIFACT}")

    def records(self, kind: str) -> DataFrame:
        """The records of a kind of artifact in the columns of ``SCHEMAS``; ``_corrupt_record`` has the text of those that don't fit."""
        names = sorted({self.member(a["path"]) for a in self.manifest["artifacts"] if a.get("kind") == kind})
        lines = self.spark.read.format("bundle_lines").options(members=json.dumps(names), **self.options).load(self.path)
        parsed = F.from_json("value", SCHEMAS[kind] + ", _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
        return lines.select("member", "line", parsed.alias("r")).select("member", "line", "r.*")

    def frames(self) -> dict[str, DataFrame]:
        return {kind: self.records(kind) for kind in SCHEMAS}

    def verification(self) -> DataFrame:
        """The artifacts beside what their members come to, and the code of the rule that one breaks, if any."""
        expected, found = self.artifacts(), catalog(self.spark, self.path, **self.options)
        rows = expected.alias("e").join(found.withColumnsRenamed({"sha256": "found_sha256"}).alias("f"), "member", "left")
        differs = lambda a, b: F.col(a).isNotNull() & ~F.col(a).eqNullSafe(F.col(b))
        raw = ~F.col("sha256").eqNullSafe(F.col("found_sha256")) | ~F.col("byteSize").eqNullSafe(F.col("byte_size"))
        plain = differs("uncompressedSha256", "unpacked_sha256") | differs("uncompressedByteSize", "unpacked_byte_size") | ~F.col("recordCount").eqNullSafe(F.col("records")) | F.col("error").isNotNull()
        code = F.when(F.col("byte_size").isNull(), "artifact_missing").when(raw, "artifact_integrity_mismatch").when((F.col("compression") == "gzip") & plain, "artifact_uncompressed_integrity_mismatch")
        count = F.when(F.col("compression") == "gzip", F.col("records")).otherwise(F.col("recordCount"))
        return rows.select("kind", "path", "member", F.col("found_sha256").alias("sha256"), count.alias("record_count"), code.alias("code"))

    def documents(self, schema: str, report_schema: str) -> dict[str, str]:
        """The intake's manifest and verification report as canonical JSON; the first broken rule (least code and path) is an error. The two schemas' names are parameters."""
        from cindermill.functions.canonical import canonical_json

        rows = self.verification()
        if bad := rows.where("code is not null").agg(F.min(F.struct("code", "path"))).first()[0]:
            raise Rejected(bad.code, bad.path)
        by = {r.path: r for r in rows.collect()}  # bounded as the manifest is
        m = self.manifest
        listed = [{"kind": a.get("kind"), "path": by[a["path"]].member, "sha256": by[a["path"]].sha256, "recordCount": by[a["path"]].record_count} for a in m["artifacts"]]
        source = {"adapter": "worker-calculation-bundle.v2", "calculationId": m.get("calculationId"), "bundleContentHash": m["bundleContentHash"], "manifestSha256": self.manifest_sha256}
        intake = {"schemaVersion": schema, "source": source, "artifacts": listed, "verification": {"manifest": "verified", "artifacts": "verified"}}
        report = {"schemaVersion": report_schema, "outcome": "verified", "artifactCount": len(listed), "calculationId": m.get("calculationId"), "bundleContentHash": m["bundleContentHash"]}
        return {"intake-manifest.json": canonical_json(intake) + "\n", "verification-report.json": canonical_json(report) + "\n"}
