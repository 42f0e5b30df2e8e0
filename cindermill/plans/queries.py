"""The registered queries: each applies an operator to the domain views, with its SQL counterpart."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cindermill.functions.canonical import MODEL_PROFILE, NOT_SIGNIFICANT, json_hash
from cindermill.functions.methods import METHODS, methods
from cindermill.operators import control, dependencies, integrity, inventory, selection, versioning
from cindermill.plans.registry import query
from cindermill.sources import archive, bundle, export, feed
from cindermill.sources.shared import scratch
from cindermill.sources.sink import write_files

@query("""
WITH t AS (SELECT process_index, flow_id, flow_version, lower(direction) AS direction, unit, coalesce(location, '') AS location, sum(amount) AS amount FROM expected_lci GROUP BY ALL),
x AS (SELECT process_index, direction, unit, coalesce(o.amount, 0) AS o, coalesce(t.amount, 0) AS t
      FROM exact_lci o FULL JOIN t USING (process_index, flow_id, flow_version, direction, unit, location)),
y AS (SELECT *, abs(o - t) AS d, max(greatest(abs(o), abs(t))) OVER (PARTITION BY process_index, direction, unit) AS scale FROM x),
z AS (SELECT *, 1e-12::DOUBLE + 1e-8::DOUBLE * scale AS allowed FROM y)
SELECT process_index, count(*) AS flow_count, max(d) AS max_absolute_difference, max(allowed) AS max_allowed_difference, max(CASE WHEN scale > 0 THEN d / scale ELSE 0 END) AS max_relative_difference,
       max(d / allowed) AS max_tolerance_ratio, count(*) FILTER (d > allowed) AS failed_keys, coalesce(any_value(edges), 0) AS provider_edge_count, count(*) FILTER (d > allowed) = 0 AS passed
FROM z LEFT JOIN (SELECT dependent_index AS process_index, count(*) AS edges FROM technosphere_edges GROUP BY 1) e USING (process_index) GROUP BY process_index""")
def one_hop_reconstruction(v):
    return inventory.evidence(v.biosphere, v.technosphere_edges, v.provider_lci, v.expected_lci)


@query("SELECT flow_id, flow_version, lower(direction) AS direction, unit, coalesce(location, '') AS location, CAST(sum(amount) AS BIGINT) AS amount FROM inventory GROUP BY ALL")
def inventory_sum(v):
    return inventory.inventory_sum(inventory.normalised(v.inventory), inventory.KEY[1:])


@query("SELECT w.target, flow_id, flow_version, direction, unit, location, CAST(sum(weight * amount) AS BIGINT) AS amount FROM weights w JOIN inventory USING (process_index) GROUP BY ALL")
def weighted_combination(v):
    return inventory.weighted_combination(v.weights, v.inventory)


@query("""
WITH s AS (SELECT DISTINCT concat('proc-', CAST(o_orderkey % 400 AS STRING), CASE WHEN o_orderkey % 2 = 0 THEN concat('@01.0', CAST(o_orderkey % 10 AS STRING), '.000') ELSE '' END) AS selector FROM orders)
SELECT selector, count(process_index) AS matches, coalesce(min(process_index), -1) AS process_index, count(process_index) = 1 AS ok
FROM s LEFT JOIN process_axis ON lower(root_id) = split_part(selector, '@', 1) AND (split_part(selector, '@', 2) = '' OR split_part(selector, '@', 2) = root_version) GROUP BY selector""")
def select_axes(v):
    k = F.col("o_orderkey")
    version = F.when(k % 2 == 0, F.concat(F.lit("@01.0"), (k % 10).cast("string"), F.lit(".000"))).otherwise("")
    return selection.select_axes(v.process_axis, v.orders.select(F.concat(F.lit("proc-"), (k % 400).cast("string"), version).alias("selector")))


#: The selected processes: all those that are inputs (they depend on others).
SELECTED = "direction = 'Input'"
ROOTS = f"SELECT process_index FROM process_axis WHERE {SELECTED}"
REQUIRED = f"SELECT process_index FROM ({ROOTS}) UNION SELECT balancing_index FROM technosphere_edges WHERE dependent_index IN ({ROOTS})"


def roots(v):
    return v.process_axis.where(SELECTED)


@query(REQUIRED)
def required_axes(v):
    return selection.required_axes(roots(v), v.technosphere_edges)


@query(f"SELECT process_index FROM ({ROOTS}) EXCEPT SELECT dependent_index FROM technosphere_edges")
def selection_subset(v):
    return selection.missing(roots(v), v.technosphere_edges.withColumnRenamed("dependent_index", "process_index"), ["process_index"])


@query("SELECT DISTINCT flow_id FROM inventory WHERE flow_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)")
def support_missing(v):
    return selection.missing(v.inventory, v.supplier.where("s_acctbal > 0").withColumnRenamed("s_suppkey", "flow_id"), ["flow_id"])


@query("""
SELECT process_index, direction, raw_amount, CASE direction WHEN 'Input' THEN -raw_amount ELSE raw_amount END AS signed_coefficient, 1 / raw_amount AS scale,
       CASE direction WHEN 'Input' THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS normalized_coefficient FROM process_axis""")
def reference_pivot(v):
    return selection.reference_pivot(v.process_axis)


@query("SELECT direction, CASE lower(direction) WHEN 'input' THEN -1 ELSE 1 END AS sign, count(*) AS n FROM process_axis GROUP BY ALL")
def direction_sign(v):
    return v.process_axis.groupBy("direction", selection.direction_sign("direction").alias("sign")).agg(F.count("*").alias("n"))


@query("""
WITH t AS (SELECT o_orderkey, o_totalprice AS a, o_totalprice * (1 + CASE WHEN o_orderkey % 3 = 0 THEN 1e-6 ELSE 0 END) AS b FROM orders)
SELECT o_orderkey, abs(a - b) <= 1e-12 * greatest(abs(a), abs(b), 1) AS equal FROM t""")
def nearly_equal(v):
    a, k = F.col("o_totalprice"), F.col("o_orderkey")
    return v.orders.select("o_orderkey", selection.nearly_equal(a, a * (1 + F.when(k % 3 == 0, F.lit(1e-6)).otherwise(F.lit(0.0)))).alias("equal"))


@query("SELECT job_id, coalesce(isfinite(TRY_CAST(x AS DOUBLE)), false) AS finite FROM (SELECT job_id, CASE job_id % 4 WHEN 0 THEN 'NaN' WHEN 1 THEN 'abc' WHEN 2 THEN 'Infinity' ELSE '2.5' END AS x FROM tasks)")
def finite_check(v):
    k = F.col("job_id") % 4
    x = F.when(k == 0, "NaN").when(k == 1, "abc").when(k == 2, "Infinity").otherwise("2.5").try_cast("double")
    return v.tasks.select("job_id", F.coalesce(selection.finite(x), F.lit(False)).alias("finite"))


@query("SELECT process_index, regexp_full_match(root_version, '[0-9]{2}\\.[0-9]{2}\\.[0-9]{3}') AS valid FROM (SELECT process_index, CASE WHEN process_index % 5 = 0 THEN concat('v', root_version) ELSE root_version END AS root_version FROM process_axis)")
def identity_validation(v):
    version = F.when(F.col("process_index") % 5 == 0, F.concat(F.lit("v"), "root_version")).otherwise(F.col("root_version"))
    return v.process_axis.select("process_index", selection.valid_version(version).alias("valid"))


@query("""
WITH p AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN concat('/', path) WHEN 1 THEN replace(path, '/', '/../') WHEN 2 THEN replace(path, '/', '//') ELSE path END AS path FROM artifacts)
SELECT doc_id, NOT starts_with(path, '/') AND len(list_filter(string_split(path, '/'), lambda x: x IN ('', '.', '..'))) = 0 AS safe FROM p""")
def path_safety(v):
    k, p = F.col("doc_id") % 4, F.col("path")
    path = F.when(k == 0, F.concat(F.lit("/"), p)).when(k == 1, F.replace(p, F.lit("/"), F.lit("/../"))).when(k == 2, F.replace(p, F.lit("/"), F.lit("//"))).otherwise(p)
    return v.artifacts.select("doc_id", selection.safe_path(path).alias("safe"))


@query("""
SELECT process_index, CAST(row_number() OVER (PARTITION BY process_index ORDER BY flow_id, flow_version, direction, unit, coalesce(location, '')) AS INTEGER) AS exchange_id, flow_id, flow_version, direction, unit, location, amount
FROM inventory WHERE NOT (flow_id = process_index % 97 AND direction = 'F')""")
def inventory_exchanges(v):
    rows = v.inventory.where("not (flow_id = process_index % 97 and direction = 'F')")
    order = ["flow_id", "flow_version", "direction", "unit", F.coalesce("location", F.lit(""))]
    return integrity.numbered(rows, ["process_index"], order, "exchange_id").select("process_index", "exchange_id", *inventory.KEY[1:], "amount")


@query("SELECT process_index, lower(flow_id) AS flow_id, concat('../flows/', lower(flow_id), '_', root_version, '.xml') AS uri, raw_amount AS mean_amount FROM process_axis")
def reference_exchange(v):
    return v.process_axis.select("process_index", F.lower("flow_id").alias("flow_id"), F.concat(F.lit("../flows/"), F.lower("flow_id"), F.lit("_"), "root_version", F.lit(".xml")).alias("uri"), F.col("raw_amount").alias("mean_amount"))


@query("""
SELECT dependent_index AS process_index, CAST(row_number() OVER (PARTITION BY dependent_index ORDER BY exchange_id, balancing_index) AS INTEGER) AS instance, balancing_index, activity FROM technosphere_edges
UNION ALL SELECT DISTINCT dependent_index, 0, dependent_index, 1 FROM technosphere_edges""")
def process_instances(v):
    edges = v.technosphere_edges.withColumnRenamed("dependent_index", "process_index")
    providers = integrity.numbered(edges, ["process_index"], ["exchange_id", "balancing_index"], "instance").select("process_index", "instance", "balancing_index", "activity")
    roots = edges.select("process_index", F.lit(0).alias("instance"), F.col("process_index").alias("balancing_index"), F.lit(1).cast("long").alias("activity")).distinct()
    return providers.unionByName(roots)


ROLES = f"""SELECT process_index, 'lifecycle-model' AS route, CASE WHEN {SELECTED} THEN 'resulting' ELSE 'dependency' END AS role FROM ({REQUIRED}) JOIN process_axis USING (process_index)
UNION ALL SELECT process_index, 'result-process', 'primary' FROM ({ROOTS})"""


@query(ROLES)
def materialization_role(v):
    return selection.roles(roots(v), v.technosphere_edges)


@query(f"SELECT route, count(*) FILTER (role = 'primary') AS n_primary, count(*) FILTER (role = 'resulting') AS n_resulting, count(*) FILTER (role = 'dependency') AS n_dependency FROM ({ROLES}) GROUP BY 1")
def role_summary(v):
    rows = selection.roles(roots(v), v.technosphere_edges)
    return rows.groupBy("route").agg(*[F.count_if(F.col("role") == r).alias(f"n_{r}") for r in ("primary", "resulting", "dependency")])


@query("SELECT dataset, count(*) AS occurrences FROM artifacts GROUP BY 1 HAVING count(*) > 1")
def duplicate_identity(v):
    return integrity.duplicates(v.artifacts, ["dataset"])


@query("SELECT dataset, doc_id, path, sha256 FROM artifacts QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY doc_id DESC) = 1")
def last_wins(v):
    return integrity.last_wins(v.artifacts, ["dataset"], ["doc_id"], ["doc_id", "path", "sha256"])


@query("SELECT dataset, count(DISTINCT sha256) AS contents, count(*) AS copies, arg_min(sha256, doc_id) AS sha256, count(DISTINCT sha256) > 1 AS conflict FROM artifacts GROUP BY 1")
def canonical_merge(v):
    return integrity.canonical_merge(v.artifacts, ["dataset"], "sha256", "doc_id")


@query("SELECT DISTINCT CAST(o_custkey AS BIGINT) AS id FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def missing_references(v):
    return selection.missing(v.orders.select(F.col("o_custkey").alias("id")), v.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("id")), ["id"])


@query("SELECT o_orderkey AS document, 1 + o_orderkey % 5 AS reference FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = 1 + o_orderkey % 5)")
def internal_references(v):
    """Documents (orders) whose quantitative reference names none of their own exchanges (lines)."""
    wanted = v.orders.select(F.col("o_orderkey").alias("document"), (1 + F.col("o_orderkey") % 5).alias("reference"))
    return selection.missing(wanted, v.lineitem.select(F.col("l_orderkey").alias("document"), F.col("l_linenumber").cast("long").alias("reference")), ["document", "reference"])


@query("""
WITH r AS (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 1 ELSE len(string_split(text, chr(10))) END AS expected,
                  len(text) - len(replace(text, chr(10), '')) + CASE WHEN text = '' OR suffix(text, chr(10)) THEN 0 ELSE 1 END AS found FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CAST(expected AS BIGINT) AS expected, CAST(found AS BIGINT) AS found, expected <> found AS drift FROM r""")
def record_count(v):
    """Lines of each file's text, the last one with or without its end, against the number that is expected."""
    expected = F.when(F.col("doc_id") % 9 == 0, F.lit(1)).otherwise(F.size(F.split("text", "\n", -1)))
    rows = v.documents.where("text is not null").select("doc_id", expected.cast("long").alias("expected"), integrity.record_count("text").alias("found"))
    return rows.withColumn("drift", F.col("expected") != F.col("found"))


@query("SELECT doc_id, path, byte_size FROM artifacts WHERE kind = 'de'")
def artifact_by_kind(v):
    return v.artifacts.where("kind = 'de'").select("doc_id", "path", "byte_size")


@query("""
SELECT kind, count(*) AS entries,
       sha256(concat('[', string_agg(concat('{"datasetType":"process","path":"', path, '","sha256":"', sha256, '","uuid":"', dataset, '","version":"01.00.000"}'), ',' ORDER BY path), ']')) AS set_hash
FROM artifacts GROUP BY 1""")
def artifact_set_hash(v):
    entries = v.artifacts.withColumns({"datasetType": F.lit("process"), "version": F.lit("01.00.000"), "uuid": F.col("dataset")})
    return integrity.set_hash(entries, ["kind"], "path", ["datasetType", "uuid", "version", "path", "sha256"])


#: A document of a process as JSON text: nulls, nested keys that do not count, an amount whose text is not canonical.
DOCUMENT = """concat('{"common:timeStamp":null,"info":{"common:dataSetVersion":"', root_version, '","id":"', root_id, '","note":null},"exchanges":[{"amount":', CAST(CAST(raw_amount AS BIGINT) AS STRING), '.50,"direction":"', direction, '"}]}')"""


@query("""SELECT process_index, sha256(concat('{"exchanges":[{"amount":', CAST(CAST(raw_amount AS BIGINT) AS STRING), '.5,"direction":"', direction, '"}],"info":{"id":"', root_id, '","note":null}}')) AS significant_hash FROM process_axis""")
def significant_hash(v):
    return v.process_axis.select("process_index", json_hash(F.expr(DOCUMENT), without=NOT_SIGNIFICANT).alias("significant_hash"))


@query("SELECT kind, count(*) AS dataset_count, CAST(sum(byte_size) AS BIGINT) AS byte_size, min(path) AS first_path, max(path) AS last_path FROM artifacts GROUP BY 1")
def dataset_index(v):
    return v.artifacts.groupBy("kind").agg(F.count("*").alias("dataset_count"), F.sum("byte_size").alias("byte_size"), F.min("path").alias("first_path"), F.max("path").alias("last_path"))


#: The key of a materialization, but for the processes it resolves to; names of contracts are parameters.
KEY = {
    "schemaVersion": "key.v1", "source": {"calculationId": "calc-1", "bundleContentHash": "0" * 64}, "scope": {"mode": "explicit"}, "outputType": "lifecycle-model", "resultProcessLayer": "lci-lcia",
    "modelProfile": MODEL_PROFILE, "generationBase": {"mode": "first-generation", "previousManifestSha256": None}, "metadataPolicySha256": "1" * 64, "recipeContractVersion": "recipe.v1",
}


@query(f"""
SELECT count(*) AS entries, sha256(concat('{{"generationBase":{{"mode":"first-generation","previousManifestSha256":null}},"metadataPolicySha256":"{"1" * 64}","modelProfile":"{MODEL_PROFILE}","outputType":"lifecycle-model","recipeContractVersion":"recipe.v1","resultProcessLayer":"lci-lcia","schemaVersion":"key.v1","scope":{{"mode":"explicit","resolvedProcesses":[',
  string_agg(concat('"', lower(root_id), '@', root_version, '"'), ',' ORDER BY concat(lower(root_id), '@', root_version)), ']}},"source":{{"bundleContentHash":"{"0" * 64}","calculationId":"calc-1"}}}}', chr(10))) AS key_sha256 FROM process_axis WHERE {SELECTED}""")
def selection_key(v):
    """The hash of the canonical key document of a materialization; its list of the selected processes (id and version) is hashed as it streams."""
    key = F.concat_ws("@", F.lower("root_id"), "root_version")
    selected = roots(v)
    return selected.agg(F.count("*").alias("entries")).withColumn("key_sha256", F.lit(integrity.key_hash(selected.select(key), KEY, "scope/resolvedProcesses")))


RESOLVED = """
SELECT d.process_index, d.lineage, d.root_id, d.root_version, p.version AS previous_version,
       CASE WHEN p.version IS NULL THEN '01.00.000' WHEN d.semantic_hash <> p.semantic_hash THEN CASE WHEN left(p.version, 2) <> '99' THEN concat(lpad(CAST(CAST(left(p.version, 2) AS INT) + 1 AS STRING), 2, '0'), '.00.000') END
            WHEN d.significant_hash <> p.significant_hash THEN CASE WHEN substr(p.version, 4, 2) <> '99' THEN concat(left(p.version, 2), '.', lpad(CAST(CAST(substr(p.version, 4, 2) AS INT) + 1 AS STRING), 2, '0'), '.000') END ELSE p.version END AS version,
       CASE WHEN p.version IS NULL THEN 'initial' WHEN d.semantic_hash <> p.semantic_hash THEN 'major' WHEN d.significant_hash <> p.significant_hash THEN 'minor' ELSE 'reuse' END AS change
FROM drafts d LEFT JOIN previous p USING (root_id, root_version)"""


@query(RESOLVED)
def version_resolution(v):
    return versioning.resolved(v.drafts, v.previous)


@query("""SELECT process_index, lineage, concat(lpad(CAST(row_number() OVER (PARTITION BY lineage ORDER BY lower(root_id), root_version) AS STRING), 2, '0'), '.00.000') AS version, 'initial' AS change FROM drafts""")
def version_allocation(v):
    """The first release of all: no source has a version yet."""
    none = v.previous.limit(0)
    return versioning.allocated(versioning.resolved(v.drafts, none), none)


@query(f"""
WITH RECURSIVE r AS MATERIALIZED (
  SELECT *, concat(lower(root_id), '@', root_version) AS owner, row_number() OVER (PARTITION BY lineage ORDER BY lower(root_id), root_version) AS k FROM ({RESOLVED}) WHERE process_index % 13 <> 0
), h AS (SELECT lineage, list(version) AS versions, list(concat(lower(root_id), '@', root_version)) AS owners FROM (SELECT DISTINCT lineage, version, root_id, root_version FROM previous) GROUP BY 1),
s AS (
  SELECT lineage, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS process_index, CAST(NULL AS STRING) AS version, CAST(NULL AS STRING) AS change, coalesce(versions, []) AS versions, coalesce(owners, []) AS owners
  FROM (SELECT DISTINCT lineage FROM r) LEFT JOIN h USING (lineage)
  UNION ALL
  SELECT lineage, k, process_index, v, CASE WHEN lost THEN CASE WHEN previous_version IS NULL THEN 'initial' ELSE 'major' END ELSE change END,
         CASE WHEN v IS NULL THEN versions ELSE list_append(versions, v) END, CASE WHEN v IS NULL THEN owners ELSE list_append(owners, owner) END
  FROM (
    SELECT *, CASE WHEN lost THEN list_filter([concat(lpad(CAST(m AS STRING), 2, '0'), '.00.000') FOR m IN range(CAST(left(version, 2) AS INT), 100)], lambda x: NOT list_contains(versions, x))[1] ELSE version END AS v
    FROM (SELECT r.*, s.versions, s.owners, len(list_filter(list_zip(s.versions, s.owners), lambda x: x[1] = r.version AND x[2] <> r.owner)) > 0 AS lost FROM s JOIN r ON r.lineage = s.lineage AND r.k = s.k + 1)
  )
)
SELECT process_index, lineage, version, change FROM s WHERE k > 0""")
def version_allocation_next_release(v):
    """A later release; the sources of one thirteenth have left, but what they hold stays held."""
    return versioning.allocated(versioning.resolved(v.drafts.where("process_index % 13 <> 0"), v.previous), v.previous)


@query(f"SELECT change, count(*) AS n FROM ({RESOLVED}) GROUP BY 1")
def version_change_counts(v):
    return versioning.resolved(v.drafts, v.previous).groupBy("change").agg(F.count("*").alias("n"))


FLOW = "concat(lpad(CAST({} AS STRING), 8, '0'), '-0000-4000-8000-000000000000')"


@query(f"""
WITH r AS (SELECT {FLOW.format("o_custkey")} AS uuid FROM orders UNION SELECT {FLOW.format("o_orderkey % 5000")} FROM orders),
own AS (SELECT {FLOW.format("c_custkey")} AS uuid FROM customer WHERE c_nationkey < 12), cache AS (SELECT {FLOW.format("c_custkey")} AS uuid FROM customer WHERE c_acctbal > 0)
SELECT uuid, '01.00.000' AS version, uuid IN (SELECT uuid FROM cache) AS resolved FROM r WHERE uuid NOT IN (SELECT uuid FROM own)""")
def method_dependencies(v):
    """The flows that methods (one an order) refer to at some depth and the closure lacks, and whether the cache has them."""
    references, closure, cache = dependency_frames(v)
    found = cache.select("uuid", "version").distinct().withColumn("found", F.lit(True))
    return dependencies.needed(references, closure).join(found, ["uuid", "version"], "left").select("uuid", "version", F.coalesce("found", F.lit(False)).alias("resolved"))


def dependency_frames(v):
    """References of methods at two depths, the closure with some of the flows, the cache of published ones."""
    version = "01.00.000"
    reference = lambda c: F.concat(F.lit('{"referenceToFlowDataSet":{"@refObjectId":"'), c, F.lit(f'","@version":"{version}"}}}}'))
    shallow, deep = reference(F.upper(F.expr(FLOW.format("o_custkey")))), reference(F.expr(FLOW.format("o_orderkey % 5000")))
    document = F.concat(F.lit('{"LCIAMethodDataSet":{"characterisationFactors":{"factor":['), shallow, F.lit(',{"group":[['), deep, F.lit("]]}]}}}"))
    methods = v.orders.select(F.lit("lciamethod").alias("dataset_type"), F.col("o_orderkey").cast("string").alias("uuid"), F.lit(version).alias("version"), document.alias("document"))
    flows = v.customer.select(F.lit("flow").alias("dataset_type"), F.expr(FLOW.format("c_custkey")).alias("uuid"), F.lit(version).alias("version"), F.lit("{}").alias("document"), "c_nationkey", "c_acctbal")
    closure = methods.unionByName(flows.where("c_nationkey < 12").drop("c_nationkey", "c_acctbal"))
    return dependencies.method_references(methods), closure, flows.where("c_acctbal > 0").drop("c_nationkey", "c_acctbal")


REFERRED = f"""r AS (SELECT {FLOW.format("o_custkey")} AS uuid FROM orders UNION SELECT {FLOW.format("o_orderkey % 5000")} FROM orders),
own AS (SELECT {FLOW.format("c_custkey")} AS uuid FROM customer WHERE c_nationkey < 12), cache AS (SELECT {FLOW.format("c_custkey")} AS uuid FROM customer WHERE c_acctbal > 0)"""


@query(f"""
WITH {REFERRED}, n AS (SELECT uuid FROM r WHERE uuid NOT IN (SELECT uuid FROM own))
SELECT 'supplement' AS code, concat(uuid, '@01.00.000') AS subject FROM n WHERE uuid IN (SELECT uuid FROM cache)
UNION ALL SELECT 'release_intake_exact_flow_missing', concat(min(uuid), '@01.00.000') FROM n WHERE uuid NOT IN (SELECT uuid FROM cache) HAVING count(*) > 0
UNION ALL SELECT 'release_intake_dependency_limit_exceeded', CAST(count(*) AS STRING) FROM n HAVING count(*) > 1000""")
def dependency_expand(v):
    """The records that supplement the closure, and what makes the expansion fail: too many flows (of a limit of 1000 here), the least one that the cache lacks."""
    frames = dependency_frames(v)
    supplement = dependencies.expanded(*frames).select(F.lit("supplement").alias("code"), F.concat_ws("@", "uuid", "version").alias("subject"))
    return supplement.union(dependencies.expansion_violations(*frames, limit=1000))


@query(f"""
WITH {REFERRED} SELECT (SELECT count(*) FROM orders) AS methods, 2 * (SELECT count(*) FROM orders) AS occurrences, count(*) AS distinct_references, count(*) FILTER (uuid IN (SELECT uuid FROM own)) AS already_present FROM r""")
def reference_counts(v):
    references, closure, _ = dependency_frames(v)
    return dependencies.summary(references, closure)


def exported(v):
    """The views' inventories, axes and edges, written as a bundle; returns its path."""
    identity = lambda i, version: F.struct(i.cast("string").alias("id"), version.alias("version"))
    lci = lambda rows: rows.select(F.col("process_index").alias("processIndex"), identity(F.col("flow_id"), F.col("flow_version")).alias("flow"), "direction", "unit", "location", F.col("amount").alias("meanAmount"))
    axes = v.process_axis.select(F.col("process_index").alias("processIndex"), identity(F.col("root_id"), F.col("root_version")).alias("rootProcess"), F.struct(F.col("direction"), F.col("raw_amount").alias("meanAmount")).alias("quantitativeReference"))
    edges = v.technosphere_edges.select(F.col("dependent_index").alias("dependentProcessIndex"), F.col("balancing_index").alias("balancingProcessIndex"), F.col("exchange_id").alias("residualExchangeInternalId"), F.col("activity").alias("activityRequirement"))
    frames = {"process_axis": axes, "lci": lci(v.provider_lci), "biosphere_edges": lci(v.biosphere), "technosphere_edges": edges}
    return export.write_bundle(v.spark, frames, scratch(v.spark, "bundle"))


@query("""
WITH n AS (SELECT 'process_axis' AS kind, process_index, CAST(NULL AS STRING) AS unit, raw_amount AS amount FROM process_axis
UNION ALL SELECT CASE WHEN process_index % 2 = 1 THEN 'lci' ELSE 'biosphere_edges' END, process_index, unit, CAST(amount AS DOUBLE) FROM inventory
UNION ALL SELECT 'technosphere_edges', dependent_index, NULL, CAST(activity AS DOUBLE) FROM technosphere_edges)
SELECT kind, CAST(process_index AS INTEGER) AS process_index, count(*) AS records, count(DISTINCT unit) AS units, sum(amount) AS amount FROM n GROUP BY ALL""")
def scan_ndjson(v):
    """The records of a bundle's artifacts, read back from its NDJSON, by kind and process."""
    frames = archive.Intake(v.spark, exported(v), "bundle.v2").frames()
    rows = None
    for kind, process, unit, value in (("process_axis", "processIndex", None, "quantitativeReference.meanAmount"), ("lci", "processIndex", "unit", "meanAmount"), ("biosphere_edges", "processIndex", "unit", "meanAmount"), ("technosphere_edges", "dependentProcessIndex", None, "activityRequirement")):
        frame = frames[kind].where("_corrupt_record is null").select(F.lit(kind).alias("kind"), F.col(process).alias("process_index"), (F.col(unit) if unit else F.lit(None).cast("string")).alias("unit"), F.col(value).try_cast("double").alias("amount"))
        rows = frame if rows is None else rows.union(frame)
    return rows.groupBy("kind", "process_index").agg(F.count("*").alias("records"), F.countDistinct("unit").alias("units"), F.sum("amount").alias("amount"))


@query("""
SELECT kind, CAST(sum(n) AS BIGINT) AS records, 'verified' AS state FROM (SELECT 'process_axis' AS kind, count(*) AS n FROM process_axis UNION ALL SELECT CASE WHEN process_index % 2 = 1 THEN 'lci' ELSE 'biosphere_edges' END, count(*) FROM inventory GROUP BY 1
UNION ALL SELECT 'technosphere_edges', count(*) FROM technosphere_edges) GROUP BY 1 HAVING sum(n) > 0""")
def file_integrity(v):
    """The artifacts of a written bundle against its manifest: bytes, unpacked bytes and records of every file, by kind."""
    checked = archive.Intake(v.spark, exported(v), "bundle.v2").verification()
    return checked.groupBy("kind").agg(F.sum("record_count").alias("records"), F.coalesce(F.min("code"), F.lit("verified")).alias("state"))


@query("""
SELECT job_id, CAST(1 + (row_number() OVER (ORDER BY job_id) - 1) // 200 AS INTEGER) AS page, CAST(1 + (row_number() OVER (ORDER BY job_id) - 1) % 200 AS INTEGER) AS position, nullif(trim(worker_status), '') AS worker_status FROM task_feed QUALIFY job_id % 3 <> 0""")
def feed_pages(v):
    """The calculation tasks of a feed written as pages of 200, each a partition; a third of its items are of other kinds."""
    number = F.row_number().over(Window.partitionBy("range").orderBy("job_id")) - 1
    ranges = v.task_feed.withColumn("range", F.floor(F.col("job_id") / 5000))
    counts = ranges.groupBy("range").agg(F.count("*").alias("n"))
    begins = counts.select("range", F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("begins"))  # a row a range
    kind = F.when(F.col("job_id") % 3 == 0, "other").otherwise(feed.JOB_KIND)
    item = F.to_json(F.struct(F.col("job_id").cast("string").alias("jobId"), kind.alias("jobKind"), F.col("worker_status").alias("workerStatus")))
    items = ranges.withColumn("inside", number).join(begins, "range").select((F.col("begins") + F.col("inside")).alias("number"), item.alias("item"))
    path = export.write_pages(items, scratch(v.spark, "feed"))
    rows = feed.tasks(feed.feed(v.spark, path, 2**31 - 1))
    return rows.select(F.col("jobId").cast("long").alias("job_id"), "page", "position", F.col("workerStatus").alias("worker_status"))


@query("""SELECT o_orderkey AS id FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey % 4 <> 0""")
def json_path_filter(v):
    """Datasets whose document says that they are elementary flows; some documents lack the path, some are no JSON."""
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "Elementary flow").otherwise("Product flow")
    document = F.concat(F.lit('{"flowDataSet":{"modellingAndValidation":{"LCIMethod":{"typeOfDataSet":"'), kind, F.lit('"}}}}'))
    key = F.col("o_orderkey")
    document = F.when(key % 8 == 0, F.lit('{"flowDataSet":[]}')).when(key % 8 == 4, F.lit("Elementary flow")).otherwise(document)
    return v.orders.select(key.alias("id"), document.alias("document")).where(selection.elementary_flow("document")).select("id")


@query("SELECT id, lower(uuid) AS uuid, trim(version) AS version, modified_at FROM published_flows WHERE state_code BETWEEN 100 AND 199")
def published_scan(v):
    return control.published(v.published_flows).select("id", F.lower("uuid").alias("uuid"), F.trim("version").alias("version"), "modified_at")


@query("SELECT count(*) AS published_count, max(modified_at) AS max_modified_at FROM published_flows WHERE state_code BETWEEN 100 AND 199")
def snapshot_watermark(v):
    return control.watermark(v.published_flows)


@query("""
WITH w AS (SELECT count(*) AS published_count, max(modified_at) AS max_modified_at FROM published_flows WHERE state_code BETWEEN 100 AND 199)
SELECT unnest(['missing', 'invalid', 'fresh', 'stale', 'stale']) AS state, unnest(['none', 'changed', 'same', 'fewer', 'older']) AS cache, published_count, max_modified_at FROM w""")
def cache_freshness(v):
    """Five caches of the published flows: none, one whose file has changed since, the same, one with a row less, an older one. Their files are written, and hashed again where they lie."""
    now = control.watermark(v.published_flows)
    published = control.published(v.published_flows)
    shards = F.greatest(F.lit(1), F.ceil(published.count() / F.lit(export.ROWS)))
    flows = published.select(F.to_json(F.struct("uuid", "version")).alias("line"), F.pmod(F.xxhash64("id"), shards).alias("shard"))
    parts = flows.groupBy("shard").agg(F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("content")).select(F.format_string("part-%06d.ndjson", "shard").alias("path"), "content")
    named = lambda files: files.select(F.element_at(F.split("path", "/"), -1).alias("path"), F.concat_ws(":", F.element_at(F.split("path", "/"), -1), "sha256").alias("entry"))
    digest = lambda files, name: integrity.list_hashes(named(files), [], "path", "entry").select(F.col("set_hash").alias(name))
    expected = digest(parts.withColumn("sha256", F.sha2("content", 256)), "expected_sha256")
    found = {}
    for name, files in (("intact", parts), ("changed", parts.withColumn("content", F.when(F.col("path") == "part-000000.ndjson", F.concat("content", F.lit("\n"))).otherwise(F.col("content"))))):
        found[name] = digest(bundle.file_digests(v.spark, write_files(files, scratch(v.spark, "cache"))), "found_sha256")
    count, newest = F.col("published_count"), F.col("max_modified_at")
    caches = None
    for name, files, n, at in (("none", "intact", F.lit(None).cast("long"), newest), ("changed", "changed", count, newest), ("same", "intact", count, newest), ("fewer", "intact", count - 1, newest), ("older", "intact", count, newest - F.expr("interval 1 second"))):
        case = now.select(F.lit(name).alias("cache"), n.alias("cached_count"), at.alias("cached_max")).crossJoin(expected).crossJoin(found[files])  # one row each
        caches = case if caches is None else caches.union(case)
    return control.freshness(caches, now).select("cache", "state", "published_count", "max_modified_at")


@query(f"""SELECT a.process_index, root_id, root_version, route, role, coalesce(n, 0) AS lci_rows FROM process_axis a JOIN ({ROLES}) r USING (process_index) LEFT JOIN (SELECT process_index, count(*) AS n FROM inventory GROUP BY 1) i USING (process_index)""")
def descriptors(v):
    counts = v.inventory.groupBy("process_index").agg(F.count("*").alias("n"))
    rows = v.process_axis.join(selection.roles(roots(v), v.technosphere_edges), "process_index").join(counts, "process_index", "left")
    return rows.select("process_index", "root_id", "root_version", "route", "role", F.coalesce("n", F.lit(0)).alias("lci_rows"))


@query("SELECT dependent_index AS process_index, count(DISTINCT balancing_index) AS providers, CAST(sum(activity) AS BIGINT) AS activity FROM technosphere_edges GROUP BY 1")
def provider_counts(v):
    return v.technosphere_edges.groupBy(F.col("dependent_index").alias("process_index")).agg(F.countDistinct("balancing_index").alias("providers"), F.sum("activity").alias("activity"))


@query("SELECT process_index, count(*) AS lci, count(DISTINCT unit) AS lcia FROM inventory GROUP BY 1")
def result_counts(v):
    return v.inventory.groupBy("process_index").agg(F.count("*").alias("lci"), F.countDistinct("unit").alias("lcia"))


@query("SELECT id, modified_at FROM published_flows ORDER BY modified_at DESC, id DESC LIMIT 51")
def bounded_list(v):
    return control.bounded_list(v.published_flows.select("id", "modified_at"), [F.desc("modified_at"), F.desc("id")], 50)


@query("SELECT id, uuid, state_code FROM published_flows WHERE id = 7")
def point_lookup(v):
    return v.published_flows.where("id = 7").select("id", "uuid", "state_code")


@query("SELECT job_id, worker_status, updated_at FROM tasks WHERE user_id = 3")
def feed_lookup(v):
    return v.tasks.where("user_id = 3").select("job_id", "worker_status", "updated_at")


@query("SELECT job_id, lower(worker_status) AS status, value / 1000 AS progress, nullif(trim(props), '') AS detail FROM tasks")
def task_projection(v):
    return v.tasks.select("job_id", F.lower("worker_status").alias("status"), (F.col("value") / 1000).alias("progress"), F.nullif(F.trim("props"), F.lit("")).alias("detail"))


@query("""
SELECT job_id, worker_status IN ('completed', 'failed', 'cancelled', 'canceled', 'blocked', 'stale') AS is_terminal,
       worker_status IN ('failed', 'blocked', 'stale') OR (worker_status = 'completed' AND NOT (coalesce(domain_status, '') = 'passed' AND domain_validity = 'valid')) AS diagnostics FROM task_feed""")
def task_state(v):
    return control.task_state(v.task_feed).select("job_id", "is_terminal", "diagnostics")


@query("""
SELECT closure_id, coalesce(run_status, '') = 'passed' AND scan_completeness = 'complete' AND certificate_validity = 'valid' AND trim(scope_hash) <> '' AND policy_fingerprint IS NOT NULL AS ready FROM closures""")
def closure_ready(v):
    return control.closure_ready(v.closures).select("closure_id", "ready")


@query("SELECT o_orderkey AS id, coalesce(nullif(trim(CASE WHEN o_orderkey % 2 = 0 THEN ' ' ELSE o_orderpriority END), ''), o_orderstatus) AS name FROM orders")
def alias_projection(v):
    first = F.when(F.col("o_orderkey") % 2 == 0, " ").otherwise(F.col("o_orderpriority"))
    return v.orders.select(F.col("o_orderkey").alias("id"), F.coalesce(F.nullif(F.trim(first), F.lit("")), "o_orderstatus").alias("name"))


@query("SELECT job_id, json_extract_string(props, '$.k') AS k, len(props) AS bytes FROM tasks WHERE json_extract_string(props, '$.k') IS NOT NULL")
def bundle_projection(v):
    return v.tasks.where(F.get_json_object("props", "$.k").isNotNull()).select("job_id", F.get_json_object("props", "$.k").alias("k"), F.length("props").cast("long").alias("bytes"))


@query("""
SELECT job_id, CASE WHEN alive OR s IN ('succeeded', 'failed', 'cancelled', 'interrupted') THEN s WHEN code = 0 THEN 'succeeded' WHEN code IS NOT NULL THEN 'failed' WHEN s = 'cancelling' THEN 'cancelled' WHEN started THEN 'interrupted' ELSE s END AS state
FROM (SELECT job_id, ['queued', 'running', 'cancelling', 'succeeded', 'failed', 'cancelled'][1 + job_id % 6] AS s, job_id % 4 = 0 AS alive, CASE WHEN job_id % 5 < 2 THEN NULL ELSE job_id % 5 - 2 END AS code, job_id % 7 <> 0 AS started FROM tasks)""")
def job_state(v):
    k = F.col("job_id")
    states = F.array(*map(F.lit, ("queued", "running", "cancelling", "succeeded", "failed", "cancelled")))
    return v.tasks.select("job_id", control.job_state(F.get(states, (k % 6).cast("int")), k % 4 == 0, F.when(k % 5 >= 2, k % 5 - 2), k % 7 != 0).alias("state"))


@query("SELECT job_id, left(props, 4000) AS line FROM tasks QUALIFY row_number() OVER (ORDER BY updated_at DESC, job_id DESC) <= 100")
def log_tail(v):
    return v.tasks.orderBy(F.desc("updated_at"), F.desc("job_id")).limit(100).select("job_id", control.log_line(F.col("props")).alias("line"))


@query("SELECT p_partkey AS process_index, method_id, name, indicator FROM part JOIN (VALUES {}) m(i, method_id, version, name, indicator) ON m.i = p_partkey % 30".format(", ".join(str((i, *m)) for i, m in enumerate(METHODS))))
def static_lookup(v):
    """The default method that each process is assessed by; keys beyond the 25 have none."""
    places = F.create_map(*[F.lit(x) for i, m in enumerate(METHODS) for x in (m[0], i)])
    table = methods(v.spark).withColumn("i", F.element_at(places, F.col("method_id")))
    return v.part.join(F.broadcast(table), F.col("p_partkey") % 30 == F.col("i")).select(F.col("p_partkey").alias("process_index"), "method_id", "name", "indicator")  # a fixed list of 25 rows


@query("""
SELECT coalesce(a.k, b.k) AS key, CASE WHEN b.k IS NULL THEN 'missing' WHEN a.k IS NULL THEN 'copied' ELSE 'preserved' END AS status
FROM (SELECT DISTINCT process_index AS k FROM inventory WHERE process_index % 3 <> 0) a FULL JOIN (SELECT process_index AS k FROM process_axis WHERE process_index % 2 = 0) b ON a.k = b.k""")
def key_partition(v):
    a = v.inventory.where("process_index % 3 <> 0").select(F.col("process_index").alias("key"), F.lit(1).alias("a")).distinct()
    b = v.process_axis.where("process_index % 2 = 0").select(F.col("process_index").alias("key"), F.lit(1).alias("b"))
    return a.join(b, "key", "full").select("key", F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "copied").otherwise("preserved").alias("status"))


@query("SELECT process_index, concat('../processes/', lower(root_id), '_', root_version, '.xml') AS uri, lower(root_id) AS ref_object_id FROM process_axis")
def global_reference(v):
    return v.process_axis.select("process_index", F.concat(F.lit("../processes/"), F.lower("root_id"), F.lit("_"), "root_version", F.lit(".xml")).alias("uri"), F.lower("root_id").alias("ref_object_id"))


@query("""
SELECT p_partkey AS process_index, array_to_string([concat(l, ':', CASE WHEN l = 'en' THEN concat(p_name, ' — aggregated') ELSE p_name END) FOR l IN CASE p_partkey % 3 WHEN 0 THEN ['en', 'de'] WHEN 1 THEN ['zh'] ELSE ['de', 'en', 'zh'] END], '|') AS names FROM part""")
def suffix_name(v):
    """Names in several languages, of which the English ones get a suffix."""
    key = F.col("p_partkey") % 3
    languages = F.when(key == 0, F.array(F.lit("en"), F.lit("de"))).when(key == 1, F.array(F.lit("zh"))).otherwise(F.array(F.lit("de"), F.lit("en"), F.lit("zh")))
    names = F.transform(languages, lambda x: F.struct(x.alias("lang"), F.col("p_name").alias("text")))
    joined = F.array_join(F.transform(selection.suffixed(names, "aggregated"), lambda n: F.concat_ws(":", n["lang"], n["text"])), "|")
    return v.part.select(F.col("p_partkey").alias("process_index"), joined.alias("names"))


@query("SELECT job_id, coalesce(nullif(trim(CASE WHEN job_id % 3 = 0 THEN '' ELSE props END), ''), ' ') AS text FROM tasks")
def compat_fill(v):
    text = F.when(F.col("job_id") % 3 == 0, "").otherwise(F.col("props"))
    return v.tasks.select("job_id", F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit(" ")).alias("text"))


@query("SELECT DISTINCT i.flow_id, s.s_name AS name FROM inventory i JOIN supplier s ON i.flow_id = s.s_suppkey")
def support_reference(v):
    return v.inventory.select("flow_id").distinct().join(v.supplier, F.col("flow_id") == F.col("s_suppkey")).select("flow_id", F.col("s_name").alias("name"))
