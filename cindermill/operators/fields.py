"""Declarations of fields: every field of a derived dataset comes from the source that its declaration ranks first, and conflicts are told."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolved(values: DataFrame, declarations: DataFrame) -> DataFrame:
    """One row a (dataset, field): value and winning source, how many sources gave a value, whether they differ, and what is wrong.

    ``values``: dataset, field, source, value (null or blank: the source has none). ``declarations``: field, source, rank
    (1 first), policy (``precedence``: the first source wins; ``equal``: all must agree). Values of sources or fields that are
    not declared count as conflicts of their own. Among equal ranks the least source wins.
    """
    ranked = values.where(F.length(F.trim("value")) > 0).join(declarations, ["field", "source"], "left")
    declared = F.col("rank").isNotNull()
    first = F.min(F.when(declared, F.struct("rank", "source", "value"))).alias("first")
    rows = ranked.groupBy("dataset", "field").agg(
        first, F.count_if(declared).alias("sources"), (F.countDistinct(F.when(declared, F.col("value"))) > 1).alias("conflict"),
        F.max(F.when(declared, F.col("policy"))).alias("policy"), F.count_if(~declared).alias("undeclared"),
    )
    code = F.when(F.col("first").isNull(), "field_source_undeclared").when((F.col("policy") == "equal") & F.col("conflict"), "field_conflict")
    return rows.select("dataset", "field", F.when(code.isNull(), F.col("first.value")).alias("value"), F.when(code.isNull(), F.col("first.source")).alias("source"), "sources", "conflict", "undeclared", code.alias("code"))


def composed(demand: DataFrame, edges: DataFrame, depth: int, stage) -> DataFrame:
    """target, process_index, depth, amount: what ``demand`` (target, process_index, amount) asks of every process, hop by hop down ``edges`` (dependent_index, balancing_index, activity), to a depth.

    A hop is a sparse product: one join and one sum, so a process reached in many ways is one row a target and depth.
    ``stage`` writes a frame and reads it back, so that hops don't repeat those before.
    """
    at = stage(demand.groupBy("target", "process_index").agg(F.sum("amount").alias("amount")))
    out = at.withColumn("depth", F.lit(0))
    for d in range(1, depth + 1):
        hop = at.join(edges, F.col("process_index") == F.col("dependent_index")).groupBy("target", F.col("balancing_index").alias("process_index"))
        at = stage(hop.agg(F.sum(F.col("amount") * F.col("activity")).alias("amount")))
        out = out.unionByName(at.withColumn("depth", F.lit(d)))
    return out


def revisited(composition: DataFrame) -> DataFrame:
    """target, process_index, depths of the processes that a target reaches at more than one depth: where cycles, or ways of different lengths, are."""
    per = composition.groupBy("target", "process_index").agg(F.sort_array(F.collect_set("depth")).alias("depths"))  # as many as hops
    return per.where(F.size("depths") > 1)
