"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import re
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of text in one Arrow batch; bounds the memory of a Python worker.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or (unset, and all in one process, as in tests) a temporary one."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="cindermill-")
        spark.sparkContext.setCheckpointDir(path)
    return path


def staged(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage: what is lost with an executor is read again, never recomputed with other row ids.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged/{uuid.uuid4().hex}"
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Remove staged tables that no later step reads."""
    for df in frames:
        if path := getattr(df, "_staged_path", None):
            jvm = df.sparkSession._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


_kept: list = []
_owner = ""


def kept(f: Callable) -> Callable:
    """Keep the last result in a Python worker, between the tasks of one operator."""
    _kept.append(f := functools.lru_cache(maxsize=1)(f))
    return f


def trim() -> None:
    """Free memory returns to the system: Arrow's, and where the C library can, the rest."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def make_room(owner: str) -> None:
    """Workers are used again: what another operator's tasks have left goes, and free memory returns to the system.

    Arrow takes its memory from the C library, which returns large blocks at once; a pool of its own would keep them.
    """
    global _owner
    pa.set_memory_pool(pa.system_memory_pool())
    if owner != _owner:
        for f in _kept:
            f.cache_clear()
        gc.collect()
        _owner = owner
    trim()


def map_batches(df: DataFrame, f: Callable[[pa.RecordBatch], dict | None], schema: str, rows: int = 0) -> DataFrame:
    """``mapInArrow`` with small batches; ``f`` turns a batch into columns (lists) by name.

    ``rows``: join batches of small values up to so many rows first. The session keeps the batch size set here.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    target = pa_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room(f.__module__)
        for batch in joined(batches, rows) if rows else batches:
            if batch.num_rows and (out := f(batch)) is not None:
                yield pa.RecordBatch.from_arrays([as_arrow(out[x.name], x.type) for x in target], schema=target)
                out = None
        trim()

    return df.mapInArrow(run, schema)


def joined(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def as_arrow(values, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


def columns_ddl(df: DataFrame) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in df.dtypes)


def pa_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def crc_mod(doc_id, modulus: int):
    """crc32 of the id as text, modulo ``modulus``: the fixed folds."""
    return F.crc32(doc_id.cast("string")) % modulus


def py_crc_mod(doc_id, modulus: int) -> int | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % modulus
