"""Inventory operators: keyed sums, one-hop reconstruction with group-scaled tolerance, weighted combination."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The tolerances of the reconstruction check.
ABSOLUTE, RELATIVE = 1e-12, 1e-8
KEY = ("process_index", "flow_id", "flow_version", "direction", "unit", "location")
MISMATCH = "one_hop_reconstruction_mismatch"


def normalised(rows: DataFrame) -> DataFrame:
    """Key columns as they are compared: ids and directions in lower case, no location as an empty one; numbers stay."""
    texts = {c for c, kind in rows.dtypes if kind == "string"}
    return rows.withColumns({c: F.lower(c) for c in ("flow_id", "direction") if c in texts} | {"location": F.coalesce("location", F.lit(""))})


def inventory_sum(rows: DataFrame, key: tuple[str, ...] = KEY, amount: str = "amount") -> DataFrame:
    """Sum of ``amount`` by the composite key; columns stay apart, no joined string keys."""
    return rows.groupBy(*key).agg(F.sum(amount).alias(amount))


def by_process(rows: DataFrame) -> DataFrame:
    """Rows parted by process into as many parts as the session's shuffles have; that number holds, as packed rows are small and parts are not to be merged by their size."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "process_index")


def contributions(biosphere: DataFrame, edges: DataFrame, lci: DataFrame) -> DataFrame:
    """Direct inventory, and each provider's inventory times the activity required of it: several rows may have one key. They are parted by process."""
    scaled = edges.join(lci, edges.balancing_index == lci.process_index).select(edges.dependent_index, *[lci[c] for c in KEY[1:]], edges.activity * lci.amount)
    return normalised(by_process(biosphere.select(*KEY, "amount").union(scaled)))  # by position


def reconstructed(biosphere: DataFrame, edges: DataFrame, lci: DataFrame) -> DataFrame:
    """The contributions summed by key."""
    return inventory_sum(contributions(biosphere, edges, lci))


def compared(observed: DataFrame, expected: DataFrame) -> DataFrame:
    """Full comparison by key (missing: 0), each difference against the scale of its process, direction and unit.

    Rows of either side, several a key as they come, are parted by process; sums, scales and what is counted by process
    stay there. A key with a null in it equals none, so its sides stay apart.
    """
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in KEY])
    sides = []
    for rows, name in ((observed, "observed"), (normalised(expected.select(*KEY, "amount")), "target")):
        other = {c: F.lit(None) for c in ("observed", "target") if c != name}
        rows = by_process(rows).withColumnRenamed("amount", name).withColumns(other)
        sides.append(rows.withColumn("side", F.when(~known, F.lit(name))))
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("observed", "target")]
    both = sides[0].unionByName(sides[1]).groupBy(*KEY, "side").agg(*sums)
    group = Window.partitionBy("process_index", "direction", "unit")
    scale = F.max(F.greatest(F.abs("observed"), F.abs("target"))).over(group)
    both = both.withColumn("difference", F.abs(F.col("observed") - F.col("target"))).withColumn("scale", scale)
    return both.withColumn("allowed", F.lit(ABSOLUTE) + F.lit(RELATIVE) * F.col("scale"))


def evidence(biosphere: DataFrame, edges: DataFrame, lci: DataFrame, expected: DataFrame) -> DataFrame:
    """One row a process: compared keys, provider edges, the four maxima, failed keys, whether all are within tolerance."""
    rows = compared(contributions(biosphere, edges, lci), expected)
    relative = F.when(F.col("scale") > 0, F.col("difference") / F.col("scale")).otherwise(0.0)
    checks = rows.groupBy("process_index").agg(
        F.count("*").alias("flow_count"), F.max(F.col("difference").cast("double")).alias("max_absolute_difference"), F.max("allowed").alias("max_allowed_difference"),
        F.max(relative).alias("max_relative_difference"), F.max(F.col("difference") / F.col("allowed")).alias("max_tolerance_ratio"), F.count_if(F.col("difference") > F.col("allowed")).alias("failed_keys"),
    )
    providers = edges.groupBy(F.col("dependent_index").alias("process_index")).agg(F.count("*").alias("edges"))
    out = checks.join(providers, "process_index", "left").withColumn("provider_edge_count", F.coalesce("edges", F.lit(0))).drop("edges")
    return out.withColumn("passed", F.col("failed_keys") == 0)


def mismatches(biosphere: DataFrame, edges: DataFrame, lci: DataFrame, expected: DataFrame) -> DataFrame:
    """Violations: the keys whose difference is beyond what is allowed."""
    rows = compared(contributions(biosphere, edges, lci), expected).where("difference > allowed")
    return rows.select(F.lit(MISMATCH).alias("code"), F.concat_ws("|", *[F.col(c).cast("string") for c in KEY]).alias("subject"))


def weighted_combination(weights: DataFrame, lci: DataFrame) -> DataFrame:
    """Sum of weight times amount by target and inventory key."""
    joined = weights.join(lci, "process_index")
    return joined.groupBy("target", *KEY[1:]).agg(F.sum(F.col("weight") * F.col("amount")).alias("amount"))
