"""Queries of scalar formats, field declarations and compositions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cindermill.functions import formats
from cindermill.operators import fields
from cindermill.plans.registry import query
from cindermill.sources.shared import scratch


@query("""
SELECT event_id, concat('ResultSet-', strftime(ts + INTERVAL 8 HOUR, '%Y%m%d-%H%M')) AS result_set_name, concat(strftime(ts + INTERVAL 8 HOUR, '%Y.%m'), '.0') AS release_name FROM events""")
def dated_names(v):
    """Names by the time of events; the names' zone is eight hours ahead of UTC all year."""
    at = F.col("ts").cast("timestamp_ntz")
    return v.events.select("event_id", formats.result_set_name(at).alias("result_set_name"), formats.release_name(at).alias("release_name"))


@query("""
WITH u AS (SELECT doc_id, doc_id % 8 AS k, concat(source, '/a b/', CAST(doc_id AS STRING), '+x.json') AS key FROM documents)
SELECT doc_id, CASE WHEN k < 3 THEN CASE k WHEN 0 THEN 'bucket' WHEN 1 THEN 'b c' ELSE 'd' END END AS bucket, CASE WHEN k < 3 THEN key END AS object_key,
       CASE WHEN k = 3 THEN 'https://x.example.org' WHEN k IN (1, 2) THEN 'https://x.example.org/storage' END AS project,
       sha256(concat('https://x.example.org', chr(0), CAST(doc_id AS STRING))) AS fingerprint FROM u""")
def storage_locations(v):
    """Buckets and keys of addresses of both kinds, and of addresses that name neither; project addresses; fingerprints."""
    k, key = F.col("doc_id") % 8, F.concat(F.col("source"), F.lit("/a%20b/"), F.col("doc_id").cast("string"), F.lit("+x.json"))
    url = F.when(k == 0, F.concat(F.lit("s3://Bucket/"), key)).when(k == 1, F.concat(F.lit("https://x.example.org/storage/v1/s3/b%20c/"), key, F.lit("?q=1"))).when(k == 2, F.concat(F.lit("https://x.example.org/y/storage/v1/s3/d/"), key))
    url = url.when(k == 3, "https://x.example.org/functions/v1/do//").when(k == 4, "s3://bucket").when(k == 5, "https://x.example.org/storage/v1/s3/only").when(k == 6, "no address")
    project = F.when(k == 3, formats.project_url(url)).when(k.isin(1, 2), formats.project_url(F.lit(" https://x.example.org/storage/functions/v1 ")))
    ref = formats.storage_ref(url)
    return v.documents.select("doc_id", ref["bucket"].alias("bucket"), ref["objectKey"].alias("object_key"), project.alias("project"), formats.fingerprint(F.lit("https://x.example.org"), F.col("doc_id").cast("string")).alias("fingerprint"))


@query("""
SELECT event_id, k BETWEEN 1 AND 8 AS request, k BETWEEN 1 AND 5 AS reference, k = 4 AS job, event_id % 5 < 2 AS release FROM (SELECT event_id, event_id % 10 AS k FROM events)""")
def identity_rules(v):
    """Which of the three rules of UUIDs an identity meets, by its version; which release versions are valid."""
    k = F.col("event_id") % 10
    uuid = F.concat(F.lit("0000000A-0000-"), k.cast("string"), F.lit("000-b000-"), F.lpad(F.col("event_id").cast("string"), 12, "0"))
    r = F.col("event_id") % 5
    release = F.when(r == 0, "2024.01.0").when(r == 1, F.repeat(F.lit("a"), 64)).when(r == 2, F.repeat(F.lit("a"), 65)).when(r == 3, "1..2").otherwise("1.")
    return v.events.select("event_id", *[formats.valid_uuid(uuid, name).alias(name) for name in formats.UUIDS], formats.valid_release(release).alias("release"))


@query("""
WITH x AS (SELECT o_custkey AS dataset, f AS field, CASE o_orderkey % 4 WHEN 0 THEN 'user' WHEN 1 THEN 'input' WHEN 2 THEN 'derived' ELSE 'other' END AS source, CASE f WHEN 'status' THEN o_orderstatus ELSE o_orderpriority END AS value FROM orders, (VALUES ('status'), ('priority')) t(f)),
d AS (SELECT *, CASE source WHEN 'user' THEN 1 WHEN 'input' THEN 2 WHEN 'derived' THEN 3 END AS rank FROM x)
SELECT dataset, field, CASE WHEN ok THEN substr(first, 10) END AS value, CASE WHEN ok THEN CASE left(first, 1) WHEN '1' THEN 'user' WHEN '2' THEN 'input' ELSE 'derived' END END AS source, sources, conflict, undeclared,
       CASE WHEN first IS NULL THEN 'field_source_undeclared' WHEN NOT ok THEN 'field_conflict' END AS code
FROM (SELECT *, first IS NOT NULL AND NOT (field = 'status' AND conflict) AS ok FROM (SELECT dataset, field, min(CASE WHEN rank IS NOT NULL THEN concat(rank, rpad(source, 8, ' '), value) END) AS first, count(rank) AS sources, count(DISTINCT CASE WHEN rank IS NOT NULL THEN value END) > 1 AS conflict, count(*) - count(rank) AS undeclared FROM d GROUP BY ALL))""")
def field_declarations(v):
    """Fields of derived datasets (customers) from the sources that their orders stand for; the status must agree, of priorities the first source's wins."""
    source = F.element_at(F.array(*map(F.lit, ("user", "input", "derived", "other"))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    values = v.orders.select(F.col("o_custkey").alias("dataset"), source.alias("source"), F.expr("stack(2, 'status', o_orderstatus, 'priority', o_orderpriority) AS (field, value)"))
    declared = [(f, s, i + 1, policy) for f, policy in (("status", "equal"), ("priority", "precedence")) for i, s in enumerate(("user", "input", "derived"))]
    return fields.resolved(values, v.spark.createDataFrame(declared, "field string, source string, rank int, policy string"))


CHAIN = "SELECT a.part AS dependent_index, b.part AS balancing_index, CAST(min(a.act) % 3 + 1 AS BIGINT) AS activity FROM order_lines a JOIN order_lines b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1 WHERE a.part <> b.part GROUP BY a.part, b.part"


@query(f"""
WITH RECURSIVE e AS MATERIALIZED ({CHAIN}), h0 AS (SELECT target, process_index, CAST(sum(weight) AS BIGINT) AS amount FROM weights GROUP BY ALL),
h1 AS (SELECT target, balancing_index AS process_index, CAST(sum(amount * activity) AS BIGINT) AS amount FROM h0 JOIN e ON process_index = dependent_index GROUP BY ALL),
h2 AS (SELECT target, balancing_index AS process_index, CAST(sum(amount * activity) AS BIGINT) AS amount FROM h1 JOIN e ON process_index = dependent_index GROUP BY ALL),
h3 AS (SELECT target, balancing_index AS process_index, CAST(sum(amount * activity) AS BIGINT) AS amount FROM h2 JOIN e ON process_index = dependent_index GROUP BY ALL),
c AS (SELECT *, 0 AS depth FROM h0 UNION ALL SELECT *, 1 FROM h1 UNION ALL SELECT *, 2 FROM h2 UNION ALL SELECT *, 3 FROM h3)
SELECT target, process_index, depth, amount, count(*) OVER (PARTITION BY target, process_index) > 1 AS revisited FROM c""")
def model_composition(v):
    """What weighted sets of processes ask of all others, three hops down the chain of lines, and which are reached more than once."""

    def stage(df):
        path = scratch(v.spark, "composition")
        df.write.parquet(path)
        return v.spark.read.parquet(path)

    a, b = v.order_lines.alias("a"), v.order_lines.alias("b")
    lines = a.join(b, (F.col("a.l_orderkey") == F.col("b.l_orderkey")) & (F.col("b.l_linenumber") == F.col("a.l_linenumber") + 1)).where("a.part <> b.part")
    edges = stage(lines.groupBy(F.col("a.part").alias("dependent_index"), F.col("b.part").alias("balancing_index")).agg((F.min("a.act") % 3 + 1).alias("activity")))
    rows = fields.composed(v.weights.withColumnRenamed("weight", "amount"), edges, 3, stage)
    again = fields.revisited(rows).select("target", "process_index", F.lit(True).alias("again"))
    return rows.join(again, ["target", "process_index"], "left").select("target", "process_index", "depth", "amount", F.coalesce("again", F.lit(False)).alias("revisited"))
