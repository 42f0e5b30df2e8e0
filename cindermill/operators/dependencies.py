"""Expansion of the flows that impact methods refer to: found anywhere in a document, resolved from the cache of published flows."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cindermill.operators.selection import missing, valid_version

#: How many flows an expansion may need; an exact id of versions 1 to 5.
LIMIT = 100_000
UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
KEY = ["uuid", "version"]


def flow_references(document: dict) -> list[dict]:
    """The flow references at any depth under a method's characterisation factors; an explicit stack, so depth has no bound."""
    found, left = [], [(document.get("LCIAMethodDataSet") or {}).get("characterisationFactors")]
    while left:
        value = left.pop()
        if isinstance(value, dict):
            reference = value.get("referenceToFlowDataSet")
            if isinstance(reference, dict):
                found.append({"uuid": str(reference.get("@refObjectId") or "").lower(), "version": str(reference.get("@version") or "")})
            left.extend(value.values())
        elif isinstance(value, list):
            left.extend(value)
    return found


def references_in(documents: str):
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda d: [] if d is None else flow_references(json.loads(d)))

    return F.pandas_udf(run, "array<struct<uuid:string,version:string>>")(documents)


def method_references(closure: DataFrame) -> DataFrame:
    """method, uuid, version: every occurrence of a reference in the methods of ``closure`` (dataset_type, uuid, version, document)."""
    methods = closure.where("dataset_type = 'lciamethod'").select(F.concat_ws("@", "uuid", "version").alias("method"), F.explode(references_in("document")).alias("reference"))
    return methods.select("method", "reference.*")


def invalid_references(references: DataFrame) -> DataFrame:
    """Violations: references without an exact id and version."""
    bad = references.where(~F.col("uuid").rlike(UUID) | ~valid_version(F.col("version")))
    return bad.select(F.lit("release_intake_flow_reference_invalid").alias("code"), F.concat_ws(":", "method", F.concat_ws("@", *KEY)).alias("subject"))


def lower_keys(rows: DataFrame) -> DataFrame:
    return rows.withColumn("uuid", F.lower("uuid"))


def needed(references: DataFrame, closure: DataFrame) -> DataFrame:
    """The flows referred to that the closure lacks, each once."""
    present = lower_keys(closure.where("dataset_type = 'flow'").select(*KEY))
    return missing(lower_keys(references), present, KEY)


def expanded(references: DataFrame, closure: DataFrame, cache: DataFrame) -> DataFrame:
    """The records (dataset_type, uuid, version, document) of the cache that supplement ``closure``, in the order of their identity."""
    found = lower_keys(cache).join(needed(references, closure), KEY, "left_semi").dropDuplicates(KEY)
    return found.select(F.lit("flow").alias("dataset_type"), *KEY, "document").orderBy(*KEY)


def expansion_violations(references: DataFrame, closure: DataFrame, cache: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Violations: more flows than ``limit`` are needed; the least one that the cache lacks."""
    wanted = needed(references, closure)
    many = wanted.agg(F.count("*").alias("n")).where(F.col("n") > limit).select(F.lit("release_intake_dependency_limit_exceeded").alias("code"), F.col("n").cast("string").alias("subject"))
    least = missing(wanted, lower_keys(cache), KEY).agg(F.min(F.struct(*KEY)).alias("k")).where("k is not null")
    return many.union(least.select(F.lit("release_intake_exact_flow_missing").alias("code"), F.concat_ws("@", "k.uuid", "k.version").alias("subject")))


def summary(references: DataFrame, closure: DataFrame) -> DataFrame:
    """One row: methods, occurrences, distinct references, those the closure has."""
    distinct = lower_keys(references).select(*KEY).distinct()
    own = lower_keys(closure.where("dataset_type = 'flow'").select(*KEY)).distinct().withColumn("own", F.lit(1))
    counts = references.agg(F.count("*").alias("occurrences"))
    per = distinct.join(own, KEY, "left").agg(F.count("*").alias("distinct_references"), F.count("own").alias("already_present"))
    return closure.agg(F.count_if(F.col("dataset_type") == "lciamethod").alias("methods")).crossJoin(counts).crossJoin(per)  # one row each
