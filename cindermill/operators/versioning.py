"""Version decisions against the previous release, and allocation of versions inside a lineage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The parts of a version have two digits.
LAST_MAJOR, LAST_MINOR = 99, 99
FIRST = "01.00.000"


def source_key(source: str = "root_id", version: str = "root_version") -> Column:
    """What tells the source variants of a lineage apart."""
    return F.concat_ws("@", F.lower(source), version)


def bumped(version: Column, part: str) -> Column:
    """The next major or minor version; null where two digits don't hold it."""
    major, minor = (F.split(version, r"\.")[i].cast("int") for i in range(2))
    next_major, next_minor = (major + 1, F.lit(0)) if part == "major" else (major, minor + 1)
    fits = (next_major <= LAST_MAJOR) & (next_minor <= LAST_MINOR)
    return F.when(fits, F.format_string("%02d.%02d.000", next_major, next_minor))


def resolved(drafts: DataFrame, previous: DataFrame) -> DataFrame:
    """The version and change of every draft: without a previous one initial, else major, minor or reuse by the first hash that differs.

    The content hash plays no part. A version that cannot be bumped is null (see ``overflows``).
    """
    hashes = ("semantic_hash", "significant_hash")
    old = previous.select(F.lower("root_id").alias("old_id"), F.col("root_version").alias("old_version"), F.col("version").alias("old"), *[F.col(c).alias(f"old_{c}") for c in hashes])
    rows = drafts.join(old, (F.lower("root_id") == F.col("old_id")) & (F.col("root_version") == F.col("old_version")), "left")
    changed = {c: F.col(c) != F.col(f"old_{c}") for c in hashes}
    change = F.when(F.col("old").isNull(), "initial").when(changed["semantic_hash"], "major").when(changed["significant_hash"], "minor").otherwise("reuse")
    rows = rows.withColumn("change", change)
    old_version, kind = F.col("old"), F.col("change")
    version = F.when(kind == "initial", FIRST).when(kind == "major", bumped(old_version, "major")).when(kind == "minor", bumped(old_version, "minor")).otherwise(old_version)
    return rows.select("process_index", "lineage", "root_id", "root_version", F.col("old").alias("previous_version"), version.alias("version"), "change")


def overflows(rows: DataFrame) -> DataFrame:
    """Violations: drafts that got no version."""
    return rows.where("version is null").select(F.lit("dataset_version_overflow").alias("code"), F.col("process_index").cast("string").alias("subject"))


def content_collisions(rows: DataFrame, previous: DataFrame) -> DataFrame:
    """Violations: the same identity and version with another content. ``rows`` and ``previous``: root_id, root_version, version, content_hash."""
    key = ["root_id", "root_version", "version"]
    old = previous.select(*key, F.col("content_hash").alias("old_content"))
    clash = rows.join(old, key).where("content_hash <> old_content")
    return clash.select(F.lit("dataset_identity_content_conflict").alias("code"), F.concat_ws("@", "root_id", "root_version").alias("subject"))


ALLOCATED = "process_index bigint, lineage string, version string, change string"


def allocated(rows: DataFrame, previous: DataFrame) -> DataFrame:
    """Distinct versions inside each lineage, given in the order of the sources; a version that another source holds becomes the next free major.

    ``rows`` as given by ``resolved``; ``previous`` (lineage, root_id, root_version, version): every version that the lineage has
    ever used is held, also those of sources that have left. A lineage's drafts pass through one task in order, a batch at a time,
    as each takes what those before have left; what is kept is who holds each version, of which two digits allow 9,900.
    """
    owner, none = source_key(), F.lit(None)
    known = previous.where("lineage is not null and version is not null").groupBy("lineage", "version").agg(F.min(owner).alias("owner"), F.max(owner).alias("other"))
    held = known.select("lineage", F.lit(False).alias("draft"), none.cast("string").alias("source"), none.cast("string").alias("source_version"), none.cast("bigint").alias("process_index"), "version", none.cast("string").alias("change"), F.lit(False).alias("known"), "owner", "other")
    drafts = rows.select("lineage", F.lit(True), F.lower("root_id"), "root_version", F.col("process_index").cast("bigint"), "version", "change", F.col("previous_version").isNotNull(), owner, none.cast("string"))
    order = ("lineage", "draft", "source", "source_version", "process_index", "version", "change")
    every = held.union(drafts).repartition("lineage").sortWithinPartitions(*order)
    return every.select("lineage", "draft", "process_index", "version", "change", "known", "owner", "other").mapInArrow(_allocate, ALLOCATED)


def _allocate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, many = [f"{m:02d}.00.000" for m in range(LAST_MAJOR + 1)], object()
    at, holders, free = None, {}, {}  # of the lineage: the owner of each version held, and from each major the first that may be free
    for batch in batches:
        out = []
        for lineage, draft, process, version, change, known, owner, other in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if lineage != at:
                at, holders, free = lineage, {}, {}
            if not draft:
                holders[version] = owner if owner == other else many
                continue
            if version is not None:
                holder = holders.get(version)
                if holder is not None and holder != owner:
                    first = int(version[:2])
                    major = free.get(first, first)
                    while major <= LAST_MAJOR and names[major] in holders:
                        major += 1
                    free[first] = major
                    version, change = names[major] if major <= LAST_MAJOR else None, "major" if known else "initial"
                if version is not None:
                    holders[version] = owner
            out.append((process, lineage, version, change))
        columns = zip(*out, strict=True) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)], ["process_index", "lineage", "version", "change"])
