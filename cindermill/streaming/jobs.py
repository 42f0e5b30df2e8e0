"""Job status as a stream: the latest state of each job from a folder of status records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATUS = "jobId string, state string, completed long, total long, updatedAt timestamp"


def status_records(spark: SparkSession, folder: str) -> DataFrame:
    """Status records as they arrive; one kept of those with the same job and time within ten minutes."""
    rows = spark.readStream.schema(STATUS).json(folder)
    return rows.withWatermark("updatedAt", "10 minutes").dropDuplicatesWithinWatermark(["jobId", "updatedAt"])


def latest(rows: DataFrame) -> DataFrame:
    """The newest state and progress of each job (output mode complete or update)."""
    newest = F.max_by(F.struct("state", "completed", "total"), "updatedAt").alias("s")
    out = rows.groupBy("jobId").agg(newest, F.max("updatedAt").alias("updated_at")).select("jobId", "s.*", "updated_at")
    return out.withColumn("progress", F.when(F.col("total") > 0, F.col("completed") / F.col("total")))
