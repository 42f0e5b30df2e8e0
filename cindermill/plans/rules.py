"""Queries of the constraint rules: the domain views with faults planted by key, and SQL that knows the faults but not the rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from cindermill.operators import constraints, selection
from cindermill.plans.registry import query
from cindermill.plans.views import Views

#: What the fault of an axis (its key modulo 31) must give: the fault, with a supplied pivot (1), without (0) or both (None), code, detail.
REFERENCE, MISMATCH = "invalid_quantitative_reference", "quantitative_reference_pivot_mismatch"
AXIS_FAULTS = [
    (0, None, "unit_process_missing", ""), (1, None, "unit_process_missing", ""), (2, None, REFERENCE, "exchange"), (3, None, REFERENCE, "exchange"),
    (4, None, REFERENCE, "sourceDirection"), (4, 1, MISMATCH, "rawDirection"), (5, None, REFERENCE, "sourceMeanAmount"), (5, 1, MISMATCH, "rawMeanAmount"), (6, None, REFERENCE, "flow"),
    (7, 1, REFERENCE, "rawDirection"), (7, 1, MISMATCH, "rawDirection"), (7, 1, MISMATCH, "signedRawCoefficient"),
    (8, 1, MISMATCH, "rawMeanAmount"), (8, 1, MISMATCH, "signedRawCoefficient"), (8, 1, MISMATCH, "meanAmount"),
    (9, 1, REFERENCE, "signedRawCoefficient"), (9, 1, MISMATCH, "signedRawCoefficient"), (9, 1, MISMATCH, "normalizedCoefficient"),
    (10, 1, MISMATCH, "normalizationScale"), (10, 1, MISMATCH, "meanAmount"), (11, 1, MISMATCH, "normalizedCoefficient"), (12, None, MISMATCH, "meanAmount"), (13, None, REFERENCE, "meanAmount"), (14, None, REFERENCE, "exchange"),
]


def fault(k: int):
    return F.col("process_index") % 31 == k


def faulty_axes(v: Views):
    """Axes, half of them with a supplied pivot, and their source documents."""
    c = F.col
    raw = F.when(fault(8), c("raw_amount") + 1).otherwise(c("raw_amount"))
    signed = F.when(fault(9), 0.0).otherwise(-c("raw_amount"))
    scale = F.when(fault(10), 2 / c("raw_amount")).otherwise(1 / c("raw_amount"))
    pivot = F.struct(
        F.when(fault(7), "Up").otherwise(F.upper("direction")).alias("raw_direction"), raw.alias("raw_mean_amount"), signed.alias("signed_raw_coefficient"), scale.alias("normalization_scale"),
        F.when(fault(11), 1.0).otherwise(-1.0).alias("normalized_coefficient"),
    )
    axes = v.process_axis.select(
        "process_index", "root_id", "root_version", F.when(fault(2), "4").otherwise("3").alias("exchange_id"), "flow_id", F.lit("01.00.000").alias("flow_version"),
        F.when(fault(12), 7.0).when(~fault(13), 1.0).alias("mean_amount"), F.when(c("direction") == "Input", pivot).alias("pivot"),
    )
    exchange = lambda i, flow: F.concat(
        F.lit(f'{{"@dataSetInternalID":"{i}","referenceToFlowDataSet":{{"@refObjectId":"'), flow, F.lit('","@version":"01.00.000"},"exchangeDirection":"'), F.when(fault(4), "sideways").otherwise(F.lower("direction")),
        F.lit('","meanAmount":"'), F.when(fault(5), 0.0).otherwise(c("raw_amount")).cast("string"), F.lit('"}'),
    )
    own = exchange(3, F.when(fault(6), "other").otherwise(F.upper("flow_id")))
    exchanges = F.when(fault(3), F.concat(F.lit("["), own, F.lit(","), own, F.lit("]"))).when(fault(15), own).otherwise(F.concat(F.lit("["), exchange(1, F.lit("x")), F.lit(","), own, F.lit("]")))
    document = F.concat(F.lit('{"processDataSet":{"processInformation":{"quantitativeReference":{"referenceToReferenceFlow":"3"}},"exchanges":{"exchange":'), exchanges, F.lit("}}}"))
    closure = v.process_axis.where(~fault(0)).select(
        F.lit("process").alias("dataset_type"), F.upper("root_id").alias("uuid"), c("root_version").alias("version"), F.when(fault(1), "other").otherwise("unit_process").alias("role"), F.lit("p").alias("path"),
        F.when(fault(14), "no document").otherwise(document).alias("document"),
    )
    return axes, closure


def values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join("NULL" if x is None else repr(x) for x in r) + ")" for r in rows)


@query(f"""
SELECT code, detail, CAST(process_index AS STRING) AS subject FROM process_axis JOIN (VALUES {values(AXIS_FAULTS)}) f(k, supplied, code, detail)
ON process_index % 31 = k AND (supplied IS NULL OR supplied = CASE direction WHEN 'Input' THEN 1 ELSE 0 END)""")
def axis_violations(v):
    """Every rule that an axis breaks against its source document: all in one scan of axes joined with sources."""
    return constraints.axis_violations(*faulty_axes(v))


@query("""
SELECT process_index, direction AS raw_direction, raw_amount AS raw_mean_amount, CASE direction WHEN 'Input' THEN -raw_amount ELSE raw_amount END AS signed_raw_coefficient, 1 / raw_amount AS normalization_scale,
       CASE direction WHEN 'Input' THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS normalized_coefficient, raw_amount * (1 / raw_amount) AS normalized_mean_amount,
       CASE direction WHEN 'Input' THEN 'calculation_bundle_process_axis.v2' ELSE 'exact_source_closure_legacy_fallback.v1' END AS evidence_source FROM process_axis WHERE process_index % 31 > 14""")
def resolved_pivots(v):
    """The pivots of the axes without faults: supplied, or derived from the source's exchange."""
    axes, closure = faulty_axes(v)
    rows = constraints.pivots(constraints.with_sources(axes.where("process_index % 31 > 14"), closure))
    return rows.select("process_index", *constraints.PIVOT, "normalized_mean_amount", "evidence_source")


@query("""
WITH s AS (SELECT DISTINCT concat('proc-', CAST(o_orderkey % 400 AS STRING), CASE WHEN o_orderkey % 2 = 0 THEN concat('@01.0', CAST(o_orderkey % 10 AS STRING), '.000') ELSE '' END) AS selector FROM orders),
a AS (SELECT root_id, root_version FROM process_axis UNION ALL SELECT root_id, '99.00.000' FROM process_axis WHERE process_index % 7 = 0)
SELECT CASE WHEN count(root_id) = 0 THEN 'process_not_in_bundle' ELSE 'ambiguous_process_selection' END AS code, '' AS detail, selector AS subject
FROM s LEFT JOIN a ON lower(root_id) = split_part(selector, '@', 1) AND (split_part(selector, '@', 2) = '' OR split_part(selector, '@', 2) = root_version) GROUP BY selector HAVING count(root_id) <> 1""")
def selection_violations(v):
    """Selectors that name no axis, or more than one."""
    k = F.col("o_orderkey")
    version = F.when(k % 2 == 0, F.concat(F.lit("@01.0"), (k % 10).cast("string"), F.lit(".000"))).otherwise("")
    more = v.process_axis.where("process_index % 7 = 0").withColumn("root_version", F.lit("99.00.000"))
    selectors = v.orders.select(F.concat(F.lit("proc-"), (k % 400).cast("string"), version).alias("selector"))
    return constraints.selection_violations(selection.select_axes(v.process_axis.union(more), selectors))


@query("""
WITH r AS (SELECT *, concat(process_index, '|', flow_id, '|', flow_version) AS subject FROM inventory)
SELECT 'support_dataset_missing' AS code, 'flow' AS detail, subject FROM r WHERE flow_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
UNION ALL SELECT 'non_finite_result', 'meanAmount', subject FROM r WHERE amount % 17 = 0
UNION ALL SELECT 'invalid_lci_direction', '', subject FROM r WHERE direction = 'F' AND unit = 'R'""")
def result_violations(v):
    """Inventory rows whose flow is no support dataset, whose amount is not finite or whose direction is unknown."""
    amount = F.when(F.col("amount") % 34 == 0, F.lit(float("nan"))).when(F.col("amount") % 17 == 0, F.lit(float("inf"))).otherwise(F.col("amount").cast("double"))
    direction = F.when(F.col("direction") == "O", "OUTPUT").when(F.col("unit") == "R", "F").otherwise("input")
    rows = v.inventory.select("process_index", F.col("flow_id").cast("string").alias("id"), F.col("flow_version").alias("version"), amount.alias("amount"), direction.alias("direction"))
    support = v.supplier.where("s_acctbal > 0").select(F.lit("flow").alias("dataset_type"), F.col("s_suppkey").cast("string").alias("uuid"), F.explode(F.array(F.lit("01.00.000"), F.lit("01.00.001"))).alias("version"))
    return constraints.result_violations(rows, support, "flow")


@query("""
WITH e AS (SELECT *, concat(dependent_index, '|', exchange_id, '|', balancing_index) AS subject FROM technosphere_edges)
SELECT 'result_catalog_incomplete' AS code, 'root' AS detail, subject FROM e WHERE dependent_index % 19 = 0
UNION ALL SELECT 'result_catalog_incomplete', 'provider', subject FROM e WHERE balancing_index % 19 = 0
UNION ALL SELECT 'non_finite_model_value', 'activityRequirement', subject FROM e WHERE activity = 3""")
def edge_violations(v):
    """Edges whose root or provider has no result, or whose activity is no number."""
    activity = F.when(F.col("activity") != 3, F.col("activity").cast("double"))
    return constraints.edge_violations(v.technosphere_edges.withColumn("activity", activity), v.process_axis.where("process_index % 19 <> 0"))


@query("""
WITH p AS (SELECT *, process_index % 23 AS k FROM previous), d AS (SELECT *, concat(lineage, '@', CASE WHEN k = 2 THEN 'v1' WHEN k <> 1 THEN version END) AS subject FROM p)
SELECT 'previous_manifest_invalid' AS code, 'version' AS detail, lineage AS subject FROM d WHERE k = 1
UNION ALL SELECT 'previous_manifest_invalid', 'versionFormat', subject FROM d WHERE k = 2
UNION ALL SELECT 'previous_manifest_invalid', 'semantic_hash', subject FROM d WHERE k = 3
UNION ALL SELECT 'previous_manifest_invalid', 'version_significant_hash', subject FROM d WHERE k = 4
UNION ALL SELECT 'previous_manifest_invalid', 'canonical_content_hash', subject FROM d WHERE k = 5
UNION ALL SELECT 'previous_manifest_invalid', 'sourceProcess', subject FROM d WHERE k = 6
UNION ALL SELECT 'previous_source_variant_duplicate', '', concat(lower(lineage), ':', lower(root_id), '@', root_version) FROM d WHERE k = 7
UNION ALL SELECT 'previous_dataset_version_duplicate', '', concat(lower(lineage), '@', ver) FROM (
  SELECT lineage, CASE WHEN k = 2 THEN 'v1' WHEN k = 1 THEN NULL ELSE version END AS ver, k FROM d UNION ALL SELECT lineage, version, k FROM d WHERE k = 7) WHERE ver IS NOT NULL GROUP BY lower(lineage), ver HAVING count(*) > 1""")
def previous_violations(v):
    """A previous manifest with fields missing, versions malformed or repeated, sources given twice; a third of its datasets are of another type."""
    k = F.col("process_index") % 23
    version = F.when(k == 2, "v1").when(k != 1, F.col("version"))
    rows = v.previous.select(
        F.lit("result").alias("dataset_type"), F.col("lineage").alias("uuid"), version.alias("version"), F.when(k == 4, "").otherwise("x").alias("version_significant_hash"), F.when(k != 3, "x").alias("semantic_hash"),
        F.when(k != 5, "x").alias("canonical_content_hash"), F.when(k == 6, "").otherwise(F.col("root_id")).alias("source_id"), F.col("root_version").alias("source_version"), k.alias("k"),
    )
    others = rows.withColumns({"dataset_type": F.lit("model"), "version": F.lit(None).cast("string")})
    return constraints.previous_violations(rows.union(rows.where("k = 7")).union(others), "result")


@query("""
WITH a AS (SELECT *, CASE doc_id % 13 WHEN 0 THEN concat('/', path) WHEN 1 THEN concat('x/../', path) ELSE path END AS p FROM artifacts)
SELECT 'canonical_index_unsafe_path' AS code, '' AS detail, p AS subject FROM a WHERE doc_id % 13 < 2
UNION ALL SELECT 'canonical_index_content_mismatch', '', p FROM a WHERE doc_id % 13 IN (2, 3)
UNION ALL SELECT 'canonical_index_duplicate_identity', '', concat(dataset, '@01.00.000') FROM a GROUP BY dataset HAVING count(*) > 1""")
def index_violations(v):
    """An index with unsafe paths, files that are missing or differ, and identities given twice."""
    k = F.col("doc_id") % 13
    path = F.when(k == 0, F.concat(F.lit("/"), "path")).when(k == 1, F.concat(F.lit("x/../"), "path")).otherwise(F.col("path"))
    entries = v.artifacts.select(F.col("dataset").alias("uuid"), F.lit("01.00.000").alias("version"), path.alias("path"), "sha256")
    files = v.artifacts.where(k != 3).select("path", F.when(k == 2, "other").otherwise(F.col("sha256")).alias("sha256"))
    return constraints.index_violations(entries, files)


@query("""
WITH l AS (SELECT l_orderkey AS o, l_linenumber AS n, CASE WHEN l_orderkey % 11 = 0 AND l_linenumber = 2 THEN 1 ELSE l_linenumber END AS id FROM order_lines)
SELECT 'generated_process_internal_reference_invalid' AS code, 'exchange_id' AS detail, CAST(o AS STRING) AS subject FROM l GROUP BY o HAVING count(DISTINCT CASE WHEN o % 29 = 0 AND n = 1 THEN 0 ELSE id END) < count(*) OR (o % 29 = 0 AND min(n) = 1)
UNION ALL SELECT 'generated_process_internal_reference_invalid', 'quantitative_reference', CAST(o AS STRING) FROM l GROUP BY o HAVING max(CASE WHEN id = 1 + o % 5 AND NOT (o % 29 = 0 AND n = 1) THEN 1 ELSE 0 END) = 0
UNION ALL SELECT 'generated_process_internal_reference_invalid', 'allocation_coproduct', CAST(o AS STRING) FROM l GROUP BY o HAVING o % 3 = 0 OR (o % 29 <> 0 AND min(id) > 1)
UNION ALL SELECT 'generated_process_internal_reference_invalid', 'variable_parameter', CAST(o AS STRING) FROM l WHERE o % 4 = 0 GROUP BY o HAVING max(n % 2) = 1""")
def document_violations(v):
    """Documents (one an order, an exchange a line) with ids missing or given twice, and references that lead nowhere; fields that hold one object or many."""
    o, n = F.col("l_orderkey"), F.col("l_linenumber")
    number = F.when((o % 11 == 0) & (n == 2), 1).otherwise(n).cast("string")
    field = F.when((o % 29 == 0) & (n == 1), F.lit("")).otherwise(F.concat(F.lit('"@dataSetInternalID":"'), number, F.lit('",')))
    product = F.when(o % 3 == 0, F.concat(F.lit('"allocations":{"allocation":[{"@internalReferenceToCoProduct":"'), (n + 9).cast("string"), F.lit('"}]},'))).when(o % 29 == 0, F.lit("")).otherwise(F.lit('"allocations":{"allocation":{"@internalReferenceToCoProduct":"1"}},'))
    exchange = F.concat(F.lit("{"), field, product, F.lit('"referenceToVariable":"v'), (n % 2).cast("string"), F.lit('"}'))
    rows = v.order_lines.groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_list(exchange)), ",").alias("exchanges"), F.count("*").alias("n"))
    names = F.when(o % 4 == 0, F.lit('{"@name":"v0"}')).otherwise(F.lit('[{"@name":"v0"},{"@name":"v1"}]'))
    document = F.concat(F.lit('{"processDataSet":{"processInformation":{"quantitativeReference":{"referenceToReferenceFlow":'), (1 + o % 5).cast("string"), F.lit('},"mathematicalRelations":{"variableParameter":'), names, F.lit('}},"exchanges":{"exchange":['), "exchanges", F.lit("]}}}"))
    return constraints.document_violations(rows.select(o.alias("subject"), document.alias("document")))


@query("""
WITH t AS (SELECT o_custkey AS target, o_orderkey, o_orderstatus AS unit, year(o_orderdate) AS flow, o_orderpriority AS purpose FROM orders)
SELECT 'incompatible_combination' AS code, 'unit' AS detail, CAST(target AS STRING) AS subject FROM t GROUP BY target HAVING count(DISTINCT unit) > 1
UNION ALL SELECT 'incompatible_combination', 'flow', CAST(target AS STRING) FROM t GROUP BY target HAVING count(DISTINCT flow) > 1
UNION ALL SELECT 'incompatible_combination', 'functionalUnit', CAST(target AS STRING) FROM t GROUP BY target HAVING count(DISTINCT purpose) > 1
UNION ALL SELECT 'incompatible_combination', 'weight', CAST(target AS STRING) FROM t GROUP BY target HAVING max(CASE WHEN o_orderkey % 37 = 0 THEN 1 ELSE 0 END) = 1""")
def combination_violations(v):
    """Weighted combinations (a customer's orders) whose terms differ in unit, reference flow or functional unit, or lack a weight."""
    weight = F.when(F.col("o_orderkey") % 37 != 0, F.col("o_totalprice"))
    terms = v.orders.select(F.col("o_custkey").alias("target"), F.col("o_orderkey").alias("process_index"), weight.alias("weight"), F.col("o_orderstatus").alias("unit"), F.year("o_orderdate").alias("reference_flow"), F.col("o_orderpriority").alias("functional_unit"))
    return constraints.combination_violations(terms)


@query("""
SELECT process_index, k NOT IN (0) AS has_source, CASE WHEN k = 0 THEN NULL WHEN k = 1 THEN 'other' ELSE 'unit_process' END AS role, CASE WHEN k IN (0, 14) THEN 0 WHEN k = 3 THEN 2 ELSE 1 END AS matches,
       CASE WHEN k NOT IN (0, 14) THEN CASE WHEN k = 6 THEN 'other' ELSE flow_id END END AS source_flow FROM (SELECT *, process_index % 31 AS k FROM process_axis)""")
def axis_source(v):
    """Every axis beside its source document: whether there is one, its role, how many of its exchanges the reference names, and their flow."""
    rows = constraints.with_sources(*faulty_axes(v))
    return rows.select("process_index", F.col("role").isNotNull().alias("has_source"), "role", F.greatest("matches", F.lit(0)).alias("matches"), "source_flow")
