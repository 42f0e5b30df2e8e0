"""Staged writes: a dataset appears under its name complete or not at all, and is never overwritten by accident."""

from __future__ import annotations

import hashlib
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from cindermill.functions.canonical import canonical_text
from cindermill.sources.files import Rejected, exists, place, read_bytes, remove, unsafe


def commit(df: DataFrame, target: str, fmt: str = "json") -> str:
    """Write beside ``target`` and rename; fails if ``target`` exists. Works on any file system Spark can reach."""
    spark = df.sparkSession
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(target)
    fs = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if fs.exists(at):
        raise FileExistsError(target)
    staging = f"{target}.staging-{uuid.uuid4().hex}"
    try:
        df.write.format(fmt).mode("errorifexists").save(staging)
        if fs.exists(at) or not fs.rename(jvm.org.apache.hadoop.fs.Path(staging), at):
            raise FileExistsError(target)
    finally:
        fs.delete(jvm.org.apache.hadoop.fs.Path(staging), True)
    return target


@dataclass
class Written(WriterCommitMessage):
    """What one task has put into the staging folder."""

    files: int
    byte_size: int


class FileWriter(DataSourceWriter):
    """One file a row (path, content), under a staging folder that the driver renames to the target in the end.

    A task may run again, or twice at a time: it writes each file under a name of its own attempt, and then gives it its
    name. A name that is taken by the same bytes is what an earlier attempt has left; by other bytes, an error. As many
    files as rows must be there at the commit, so two rows of one path are an error too. What fails leaves nothing.
    """

    def __init__(self, target: str, replace: bool):
        self.target, self.replace, self.token = target, replace, uuid.uuid4().hex
        system, path = place(target)
        if exists(system, path) and not replace:
            raise Rejected("output_exists", target)

    def folders(self) -> tuple[arrow_fs.FileSystem, str, str, str]:
        system, path = place(self.target)
        return system, path, f"{path}.staging-{self.token}", f"{path}.parts-{self.token}"

    def write(self, iterator: Iterator[Row]) -> Written:
        system, _, staging, parts = self.folders()
        mine, files, size = posixpath.join(parts, uuid.uuid4().hex), 0, 0
        system.create_dir(mine)
        for path, content in iterator:
            if unsafe(path):
                raise Rejected("unsafe_artifact_path", path)
            data = content.encode() if isinstance(content, str) else bytes(content)
            own, final = posixpath.join(mine, str(files)), posixpath.join(staging, path)
            with system.open_output_stream(own, compression=None) as out:
                out.write(data)
            system.create_dir(posixpath.dirname(final))
            if not exists(system, final):
                system.move(own, final)
            elif hashlib.sha256(read_bytes(system, final)).digest() != hashlib.sha256(data).digest():
                raise Rejected("duplicate_dataset", path)
            files, size = files + 1, size + len(data)
        return Written(files, size)

    def commit(self, messages: list[Written | None]) -> None:
        system, path, staging, parts = self.folders()
        rows = sum(m.files for m in messages if m)
        system.create_dir(staging)
        found = sum(f.type == arrow_fs.FileType.File for f in system.get_file_info(arrow_fs.FileSelector(staging, recursive=True)))
        if found != rows:
            raise Rejected("duplicate_dataset", f"{rows} rows, {found} files")
        if exists(system, path):
            if not self.replace:
                raise Rejected("output_exists", self.target)
            system.delete_dir(path)
        system.move(staging, path)
        remove(system, parts)

    def abort(self, messages: list[Written | None]) -> None:
        system, _, staging, parts = self.folders()
        remove(system, staging)
        remove(system, parts)


class FileSink(DataSource):
    """``df.write.format("dataset_files")``: mode append creates the target and refuses one that exists, overwrite replaces it."""

    @classmethod
    def name(cls) -> str:
        return "dataset_files"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return FileWriter(self.options["path"], overwrite)


def write_files(rows: DataFrame, target: str, replace: bool = False) -> str:
    """One file a row (path: relative, content: text or bytes), all of them or none."""
    rows.sparkSession.dataSource.register(FileSink)
    rows.select("path", "content").write.format("dataset_files").mode("overwrite" if replace else "append").save(target)
    return target


#: Entries in one file of an index.
ENTRIES = 10_000


def dataset_files(rows: DataFrame, folder: str) -> DataFrame:
    """path, content of the canonical file of every dataset (uuid, version, document: JSON text): ``<folder>/<uuid>_<version>.json``."""
    path = F.concat(F.lit(f"{folder}/"), F.lower("uuid"), F.lit("_"), "version", F.lit(".json"))
    return rows.select(path.alias("path"), F.concat(canonical_text("document"), F.lit("\n")).alias("content"))


def index_files(files: DataFrame, folder: str = "index") -> DataFrame:
    """path, content of an index of ``files``: one line (path, byteSize, sha256) a file, in files of about ``ENTRIES`` lines by hash, ordered by path."""
    shards = F.greatest(F.lit(1), F.ceil(files.count() / F.lit(ENTRIES)))
    line = F.to_json(F.struct(F.octet_length("content").alias("byteSize"), "path", F.sha2("content", 256).alias("sha256")))
    rows = files.select(F.pmod(F.xxhash64("path"), shards).alias("shard"), "path", line.alias("line"))
    lines = F.array_sort(F.collect_list(F.struct("path", "line")))  # about ENTRIES, by hash
    return rows.groupBy("shard").agg(lines.alias("lines")).select(
        F.format_string(f"{folder}/part-%06d.ndjson", "shard").alias("path"), F.concat(F.array_join(F.transform("lines", lambda x: x["line"]), "\n"), F.lit("\n")).alias("content")
    )


def write_datasets(rows: DataFrame, target: str, folder: str = "canonical-datasets", replace: bool = False) -> str:
    """One canonical file a dataset (uuid, version, document) and the index of these, in one commit."""
    files = dataset_files(rows, folder)
    return write_files(files.unionByName(index_files(files)), target, replace)
