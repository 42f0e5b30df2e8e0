"""Calculation bundles: NDJSON artifacts of fixed schemas, read as DataFrames; integrity of their files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

IDENTITY = "struct<id:string,version:string>"
#: The columns of each artifact kind. Amounts may be numbers or texts, so they are read as text.
SCHEMAS = {
    "process_axis": f"processIndex int, rootProcess {IDENTITY}, quantitativeReference struct<exchangeInternalId:string,flow:{IDENTITY},direction:string,referenceUnit:string,meanAmount:string>",
    "source_closure": "schemaVersion string, datasetType string, role string, uuid string, version string, path string, sha256 string, document string",
    "lci": f"processIndex int, flow {IDENTITY}, direction string, unit string, location string, meanAmount string",
    "biosphere_edges": f"processIndex int, flow {IDENTITY}, direction string, unit string, location string, meanAmount string",
    "lcia": f"processIndex int, method {IDENTITY}, meanAmount string",
    "technosphere_edges": f"dependentProcessIndex int, balancingProcessIndex int, residualExchangeInternalId string, balancingReferenceExchangeInternalId string, residualCoefficient double, referenceCoefficient double, routingWeight double, activityRequirement string, flow {IDENTITY}, location string",
}


def read_artifact(spark: SparkSession, kind: str, paths: list[str]) -> DataFrame:
    """All files of a kind (gzip by extension, blank lines skipped); rows that don't fit keep their text in ``_corrupt_record``."""
    schema = SCHEMAS[kind] + ", _corrupt_record string"
    rows = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(paths)
    return rows.withColumn("source_path", F.col("_metadata.file_path"))


def amounts(rows: DataFrame, column: str = "meanAmount") -> DataFrame:
    """``column`` as a double; what is no finite number becomes null, for the caller to reject."""
    value = F.col(column).try_cast("double")
    return rows.withColumn(column, F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value))


def raw_line_counts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines of each file, blank ones included."""
    return spark.read.text(paths).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("records"))


def file_digests(spark: SparkSession, folder: str) -> DataFrame:
    """path, byte_size, sha256 of every file under a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", F.col("length").alias("byte_size"), F.sha2("content", 256).alias("sha256"))


def drift(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Files that are missing, unexpected, or differ in size or hash from what the manifest says."""
    e, a = expected.alias("e"), actual.alias("a")
    rows = e.join(a, "path", "full").select("path", F.col("e.sha256").alias("expected"), F.col("a.sha256").alias("found"), F.col("e.byte_size").eqNullSafe(F.col("a.byte_size")).alias("same_size"))
    return rows.where(~F.col("expected").eqNullSafe(F.col("found")) | ~F.col("same_size"))
