"""Rules as data: all row rules of a table are evaluated in one projection, and what they find is (code, detail, subject).

A rule says when a row is broken. Null counts as not broken, so a rule on a value that may be missing must say so itself.
Rules that need another table get its columns by one join before, shared by all of them; rules of uniqueness are counts by
key. The first violation, by which a job that fails closed fails, is the least (code, detail, subject).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cindermill.functions import variants
from cindermill.operators.selection import finite, nearly_equal, valid_version
from cindermill.sources.files import Rejected


@dataclass
class Rule:
    code: str
    detail: str
    broken: Column


def violations(rows: DataFrame, rules: list[Rule], subject: Column, count: Observation | None = None) -> DataFrame:
    """code, detail, subject of every rule that a row breaks: one scan. ``count`` observes rows and broken rules by code on the way."""
    if count is not None:
        by = {}
        for r in rules:
            by.setdefault(r.code, []).append(F.coalesce(r.broken, F.lit(False)).cast("int"))
        rows = rows.observe(count, F.count("*").alias("rows"), *[F.sum(reduce(lambda a, b: a + b, x)).alias(code) for code, x in by.items()])
    found = F.array_compact(F.array(*[F.when(r.broken, F.struct(F.lit(r.code).alias("code"), F.lit(r.detail).alias("detail"))) for r in rules]))
    return rows.select(F.explode(found).alias("v"), subject.cast("string").alias("subject")).select("v.*", "subject")


def repeated(rows: DataFrame, code: str, detail: str, key: list[str], subject: Column) -> DataFrame:
    """Violations of uniqueness: one a key that occurs more than once."""
    twice = rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
    return twice.select(F.lit(code).alias("code"), F.lit(detail).alias("detail"), subject.cast("string").alias("subject"))


def fail_closed(found: DataFrame) -> None:
    """Raise the first violation, if there is one."""
    if first := found.agg(F.min(F.struct("code", "detail", "subject"))).first()[0]:
        raise Rejected(first.code, f"{first.detail} {first.subject}".strip())


def known_direction(c: Column) -> Column:
    return F.coalesce(F.lower(c).isin("input", "output"), F.lit(False))


def proper(c: Column) -> Column:
    """Finite and not zero; a missing number is not."""
    return F.coalesce(finite(c) & (c != 0), F.lit(False))


def sign(direction: Column) -> Column:
    return F.when(F.lower(direction) == "input", F.lit(-1.0)).otherwise(F.lit(1.0))


def blank(c: Column) -> Column:
    return c.isNull() | (c == "")


PIVOT = ("raw_direction", "raw_mean_amount", "signed_raw_coefficient", "normalization_scale", "normalized_coefficient")


def with_sources(axes: DataFrame, closure: DataFrame) -> DataFrame:
    """Axes (process_index, root_id, root_version, exchange_id, flow_id, flow_version, mean_amount, pivot: struct or null) beside what their source documents say (the last of a key by path wins)."""
    last = F.max_by(F.struct("role", "document"), "path").alias("s")
    keyed = closure.where("dataset_type = 'process'").select(F.lower("uuid").alias("source_id"), F.col("version").alias("source_version"), "role", "document", "path")
    parts = int(closure.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # by number, as packed documents are small and parts are not to be merged by their size
    sources = keyed.repartition(parts, "source_id", "source_version").groupBy("source_id", "source_version").agg(last)  # no task sorts the documents as it reads them, and none holds all of them
    rows = axes.join(sources.hint("merge"), (F.lower("root_id") == F.col("source_id")) & (F.col("root_version") == F.col("source_version")), "left")
    rows = rows.withColumn("d", variants.at(variants.document(F.col("s.document")), "processDataSet"))
    internal = variants.text(F.col("d"), "processInformation", "quantitativeReference", "referenceToReferenceFlow")
    rows = rows.withColumn("internal_id", internal)
    matching = F.filter(variants.many(variants.at(F.col("d"), "exchanges", "exchange")), lambda x: variants.text(x, "@dataSetInternalID") == F.col("internal_id"))
    rows = rows.withColumn("matching", matching)
    x = F.get("matching", F.lit(0))
    return rows.select(
        *axes.columns, F.col("s.role").alias("role"), "internal_id", F.size("matching").alias("matches"), variants.text(x, "exchangeDirection").alias("source_direction"),
        variants.text(x, "meanAmount").try_cast("double").alias("source_amount"), F.lower(variants.text(x, "referenceToFlowDataSet", "@refObjectId")).alias("source_flow"), variants.text(x, "referenceToFlowDataSet", "@version").alias("source_flow_version"),
    )


def pivots(rows: DataFrame) -> DataFrame:
    """Rows as ``with_sources`` gives them, with the pivot: supplied by the axis, or else derived from the source's exchange."""
    supplied = F.col("pivot").isNotNull()
    given = lambda name, derived: F.when(supplied, F.col(f"pivot.{name}")).otherwise(derived)
    rows = rows.withColumn("raw_direction", F.initcap(F.lower(given("raw_direction", F.col("source_direction")))))
    rows = rows.withColumn("raw_mean_amount", given("raw_mean_amount", F.col("source_amount")))
    rows = rows.withColumn("signed_raw_coefficient", given("signed_raw_coefficient", sign(F.col("raw_direction")) * F.col("raw_mean_amount")))
    size = F.when(F.col("signed_raw_coefficient") != 0, F.abs("signed_raw_coefficient"))
    rows = rows.withColumn("normalization_scale", given("normalization_scale", 1 / size)).withColumn("normalized_coefficient", given("normalized_coefficient", F.signum("signed_raw_coefficient")))
    evidence = F.when(supplied, "calculation_bundle_process_axis.v2").otherwise("exact_source_closure_legacy_fallback.v1")
    return rows.withColumn("normalized_mean_amount", F.col("raw_mean_amount") * F.col("normalization_scale")).withColumn("evidence_source", evidence)


def axis_rules() -> list[Rule]:
    """Of rows as ``pivots`` gives them. What a missing source leaves unknown is not reported again."""
    c = F.col
    there = c("role").eqNullSafe(F.lit("unit_process"))
    reference = lambda detail, broken: Rule("invalid_quantitative_reference", detail, there & broken)
    one = (c("matches") == 1) & c("internal_id").eqNullSafe(c("exchange_id"))
    off = lambda detail, a, b: Rule("quantitative_reference_pivot_mismatch", detail, there & one & ~nearly_equal(a, b))
    size = F.when(c("signed_raw_coefficient") != 0, F.abs("signed_raw_coefficient"))
    return [
        Rule("unit_process_missing", "", ~there), reference("exchange", ~one), reference("sourceDirection", one & ~known_direction(c("source_direction"))), reference("sourceMeanAmount", one & ~proper(c("source_amount"))),
        reference("flow", one & ~(c("source_flow").eqNullSafe(F.lower("flow_id")) & c("source_flow_version").eqNullSafe(c("flow_version")))),
        reference("rawDirection", one & c("pivot").isNotNull() & ~known_direction(c("raw_direction"))),
        *[reference(name, one & c("pivot").isNotNull() & ~proper(c(column))) for name, column in (("rawMeanAmount", "raw_mean_amount"), ("signedRawCoefficient", "signed_raw_coefficient"), ("normalizationScale", "normalization_scale"), ("normalizedCoefficient", "normalized_coefficient"))],
        reference("meanAmount", one & ~proper(c("mean_amount"))),
        Rule("quantitative_reference_pivot_mismatch", "rawDirection", there & one & (F.lower("raw_direction") != F.lower("source_direction"))),
        off("rawMeanAmount", c("raw_mean_amount"), c("source_amount")), off("signedRawCoefficient", c("signed_raw_coefficient"), sign(c("raw_direction")) * c("raw_mean_amount")),
        off("normalizationScale", c("normalization_scale"), 1 / size), off("normalizedCoefficient", c("normalized_coefficient"), F.signum("signed_raw_coefficient")), off("meanAmount", c("mean_amount"), c("normalized_mean_amount")),
    ]


def axis_violations(axes: DataFrame, closure: DataFrame, count: Observation | None = None) -> DataFrame:
    return violations(pivots(with_sources(axes, closure)), axis_rules(), F.col("process_index"), count)


def selection_violations(selected: DataFrame) -> DataFrame:
    """Of the selectors as ``select_axes`` gives them."""
    return violations(selected, [Rule("process_not_in_bundle", "", F.col("matches") == 0), Rule("ambiguous_process_selection", "", F.col("matches") > 1)], F.col("selector"))


def result_violations(rows: DataFrame, support: DataFrame, dataset_type: str) -> DataFrame:
    """Of inventory (dataset_type flow: direction too) or impact rows (process_index, id, version, amount) against the support datasets (dataset_type, uuid, version)."""
    known = support.where(F.col("dataset_type") == dataset_type).select(F.lower("uuid").alias("known_id"), F.col("version").alias("known_version")).distinct()
    joined = rows.join(known, (F.lower("id") == F.col("known_id")) & (F.col("version") == F.col("known_version")), "left")
    rules = [Rule("support_dataset_missing", dataset_type, F.col("known_id").isNull()), Rule("non_finite_result", "meanAmount", ~F.coalesce(finite(F.col("amount")), F.lit(False)))]
    if dataset_type == "flow":
        rules.append(Rule("invalid_lci_direction", "", ~known_direction(F.col("direction"))))
    return violations(joined, rules, F.concat_ws("|", "process_index", "id", "version"))


def edge_violations(edges: DataFrame, catalog: DataFrame) -> DataFrame:
    """Of edges (dependent_index, balancing_index, exchange_id, activity) against the catalog of results (process_index)."""
    of = lambda name: catalog.select(F.col("process_index").alias(name)).distinct()
    rows = edges.join(of("own"), F.col("dependent_index") == F.col("own"), "left").join(of("provider"), F.col("balancing_index") == F.col("provider"), "left")
    rules = [
        Rule("result_catalog_incomplete", "root", F.col("own").isNull()), Rule("result_catalog_incomplete", "provider", F.col("provider").isNull()),
        Rule("non_finite_model_value", "activityRequirement", ~F.coalesce(finite(F.col("activity")), F.lit(False))),
    ]
    return violations(rows, rules, F.concat_ws("|", "dependent_index", "exchange_id", "balancing_index"))


#: The fields that a dataset of a previous manifest must have.
REQUIRED = ("dataset_type", "uuid", "version", "version_significant_hash", "semantic_hash", "canonical_content_hash")


def previous_violations(previous: DataFrame, dataset_type: str) -> DataFrame:
    """Of the previous manifest's datasets of a type (``REQUIRED``, source_id, source_version): fields, versions, sources, and uniqueness inside each lineage."""
    rows = previous.where(F.col("dataset_type") == dataset_type)
    rules = [Rule("previous_manifest_invalid", f, blank(F.col(f))) for f in REQUIRED]
    rules += [Rule("previous_manifest_invalid", "versionFormat", ~blank(F.col("version")) & ~valid_version(F.col("version"))), Rule("previous_manifest_invalid", "sourceProcess", blank(F.col("source_id")) | blank(F.col("source_version")))]
    source = F.when(~blank(F.col("source_id")) & ~blank(F.col("source_version")), F.concat_ws("@", F.lower("source_id"), "source_version"))
    keyed = rows.select(F.lower("uuid").alias("lineage"), source.alias("source"), "version")
    lineage = F.col("lineage")
    found = violations(rows, rules, F.concat_ws("@", "uuid", "version"))
    return found.union(repeated(keyed.where("source is not null"), "previous_source_variant_duplicate", "", ["lineage", "source"], F.concat_ws(":", lineage, "source"))).union(
        repeated(keyed.where("version <> ''"), "previous_dataset_version_duplicate", "", ["lineage", "version"], F.concat_ws("@", lineage, "version"))
    )


def index_violations(entries: DataFrame, files: DataFrame) -> DataFrame:
    """Of an index (uuid, version, path, sha256) against the files found (path, sha256)."""
    unsafe = F.col("path").startswith("/") | F.col("path").contains("\\") | F.exists(F.split("path", "/"), lambda x: x.isin("", ".", ".."))
    found = files.select(F.col("path").alias("found_path"), F.col("sha256").alias("found_sha256"))
    rows = entries.join(found, F.col("path") == F.col("found_path"), "left")
    rules = [Rule("canonical_index_unsafe_path", "", unsafe), Rule("canonical_index_content_mismatch", "", ~unsafe & ~F.col("sha256").eqNullSafe(F.col("found_sha256")))]
    identity = F.concat_ws("@", F.lower("uuid"), "version")
    return violations(rows, rules, F.col("path")).union(repeated(entries.withColumn("identity", identity), "canonical_index_duplicate_identity", "", ["identity"], F.col("identity"))).union(
        repeated(entries, "canonical_index_duplicate_path", "", ["path"], F.col("path"))
    )


def document_violations(documents: DataFrame) -> DataFrame:
    """Of result documents (subject, document: JSON text): exchange ids, quantitative reference, co-products and variables that lead nowhere. One row of rules a document; nothing is exploded."""
    d = F.col("d")
    rows = documents.select("subject", variants.at(variants.document(F.col("document")), "processDataSet").alias("d"))
    exchange = variants.many(variants.at(d, "exchanges", "exchange"))
    rows = rows.withColumn("exchanges", F.transform(exchange, lambda x: F.struct(
        F.coalesce(variants.text(x, "@dataSetInternalID"), F.lit("")).alias("id"),
        F.transform(variants.many(variants.at(x, "allocations", "allocation")), lambda a: F.coalesce(variants.text(a, "@internalReferenceToCoProduct"), F.lit(""))).alias("products"),
        F.transform(variants.many(variants.at(x, "referenceToVariable")), lambda a: F.coalesce(variants.text(a), F.lit(""))).alias("variables"),
    )))
    names = F.filter(F.transform(variants.many(variants.at(d, "processInformation", "mathematicalRelations", "variableParameter")), lambda p: variants.text(p, "@name")), lambda n: n.isNotNull() & (n != ""))
    rows = rows.withColumn("ids", F.transform("exchanges", lambda x: x["id"])).withColumn("names", names)
    reference = F.coalesce(variants.text(d, "processInformation", "quantitativeReference", "referenceToReferenceFlow"), F.lit(""))
    code = "generated_process_internal_reference_invalid"
    stray = lambda field, known: F.size(F.array_except(F.flatten(F.transform("exchanges", lambda x: x[field])), F.filter(known, lambda i: i != ""))) > 0
    rules = [
        Rule(code, "exchange_id", F.array_contains("ids", "") | (F.size(F.array_distinct("ids")) < F.size("ids"))),
        Rule(code, "quantitative_reference", (reference == "") | ~F.array_contains("ids", reference)),
        Rule(code, "allocation_coproduct", stray("products", F.col("ids"))), Rule(code, "variable_parameter", stray("variables", F.col("names"))),
    ]
    return violations(rows, rules, F.col("subject"))


def combination_violations(terms: DataFrame) -> DataFrame:
    """Of the terms of weighted combinations (target, process_index, weight, unit, reference_flow, functional_unit): weights must be finite, and a target's terms agree in what they are for."""
    per = terms.groupBy("target").agg(F.countDistinct("unit").alias("units"), F.countDistinct("reference_flow").alias("flows"), F.countDistinct("functional_unit").alias("purposes"), F.count_if(~F.coalesce(finite(F.col("weight")), F.lit(False))).alias("weights"))
    code = "incompatible_combination"
    return violations(per, [Rule(code, "unit", F.col("units") > 1), Rule(code, "flow", F.col("flows") > 1), Rule(code, "functionalUnit", F.col("purposes") > 1), Rule(code, "weight", F.col("weights") > 0)], F.col("target"))
