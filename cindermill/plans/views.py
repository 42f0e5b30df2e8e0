"""Domain views over the driver's tables, in SQL that Spark and DuckDB both read."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from cindermill.operators.inventory import by_process

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")

VIEWS = {
    "process_axis": """
        SELECT p_partkey AS process_index, concat('PROC-', CAST(p_partkey AS STRING)) AS root_id, concat('01.0', CAST(p_size % 10 AS STRING), '.000') AS root_version,
               concat('flow-', CAST(p_partkey % 97 AS STRING)) AS flow_id, CASE WHEN p_partkey % 2 = 0 THEN 'Input' ELSE 'Output' END AS direction,
               CAST(1 + p_size % 10 AS DOUBLE) AS raw_amount, concat(p_brand, '/', p_type, '/', CAST(p_size % 5 AS STRING)) AS lineage
        FROM part""",
    "order_lines": """
        SELECT l_orderkey, l_linenumber, min(l_partkey) AS part, min(CAST(round(l_discount * 100) AS BIGINT)) AS act FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "technosphere_edges": """
        SELECT a.part AS dependent_index, b.part AS balancing_index, min(concat(CAST(a.l_orderkey AS STRING), ':', CAST(a.l_linenumber AS STRING))) AS exchange_id,
               b.part % 97 AS flow_id, min(a.act) + 1 AS activity
        FROM order_lines a JOIN order_lines b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1
        WHERE a.part % 2 = 0 AND b.part % 2 = 1 GROUP BY a.part, b.part""",
    "inventory": """
        SELECT process_index, flow_id, flow_version, direction, unit, location, CAST(sum(quantity) AS BIGINT) AS amount FROM (
          SELECT l_partkey AS process_index, l_suppkey AS flow_id, concat('01.00.00', CAST(l_linenumber % 2 AS STRING)) AS flow_version, l_linestatus AS direction, l_returnflag AS unit,
                 CASE WHEN l_tax < 0.03 THEN 'GLO' WHEN l_tax < 0.06 THEN 'DE' END AS location, CAST(round(l_quantity) AS BIGINT) AS quantity FROM lineitem
        ) t GROUP BY process_index, flow_id, flow_version, direction, unit, location""",
    "provider_lci": "SELECT * FROM inventory WHERE process_index % 2 = 1",
    "biosphere": "SELECT * FROM inventory WHERE process_index % 2 = 0",
    "exact_lci": """
        SELECT process_index, flow_id, flow_version, lower(direction) AS direction, unit, coalesce(location, '') AS location, CAST(sum(amount) AS BIGINT) AS amount FROM (
          SELECT process_index, flow_id, flow_version, direction, unit, location, amount FROM biosphere
          UNION ALL SELECT e.dependent_index, i.flow_id, i.flow_version, i.direction, i.unit, i.location, e.activity * i.amount FROM technosphere_edges e JOIN provider_lci i ON e.balancing_index = i.process_index
        ) t GROUP BY process_index, flow_id, flow_version, lower(direction), unit, coalesce(location, '')""",
    "expected_lci": """
        SELECT process_index, flow_id, flow_version, upper(direction) AS direction, unit, location,
               CAST(amount AS DOUBLE) + CASE process_index % 50 WHEN 0 THEN 1e0 WHEN 10 THEN 5e-9 * amount WHEN 20 THEN 2e-8 * amount ELSE 0e0 END AS amount FROM exact_lci""",
    "published_flows": "SELECT o_orderkey AS id, o_custkey % 300 AS state_code, o_orderdate AS modified_at, concat('flow-', CAST(o_custkey AS STRING)) AS uuid, concat(' 01.00.00', CAST(o_orderkey % 10 AS STRING), ' ') AS version FROM orders",
    "task_feed": """
        SELECT event_id AS job_id, CASE event_id % 9 WHEN 0 THEN 'completed' WHEN 1 THEN 'failed' WHEN 2 THEN 'cancelled' WHEN 3 THEN 'canceled' WHEN 4 THEN 'blocked' WHEN 5 THEN 'stale' WHEN 6 THEN 'running' WHEN 7 THEN 'queued' ELSE ' ' END AS worker_status,
               CASE event_id % 4 WHEN 0 THEN 'passed' WHEN 1 THEN 'failed' WHEN 2 THEN 'passed' END AS domain_status, CASE WHEN event_id % 5 = 0 THEN 'expired' ELSE 'valid' END AS domain_validity FROM events""",
    "closures": """
        SELECT event_id AS closure_id, CASE event_id % 5 WHEN 0 THEN 'failed' WHEN 1 THEN NULL ELSE 'passed' END AS run_status, CASE WHEN event_id % 7 = 0 THEN 'partial' ELSE 'complete' END AS scan_completeness,
               CASE WHEN event_id % 11 = 0 THEN 'expired' ELSE 'valid' END AS certificate_validity, CASE event_id % 6 WHEN 0 THEN ' ' ELSE 'scope' END AS scope_hash, CASE WHEN event_id % 13 = 0 THEN NULL ELSE 'policy' END AS policy_fingerprint FROM events""",
    "tasks": "SELECT event_id AS job_id, user_id, event_type AS worker_status, value, ts AS updated_at, props FROM events",
    "artifacts": "SELECT doc_id, lang AS kind, concat(source, '/', CAST(doc_id AS STRING), '.json') AS path, sha256_text AS sha256, n_chars AS byte_size, dataset FROM hashed_documents",
    "hashed_documents": "SELECT doc_id, lang, source, n_chars, concat('ds-', CAST(doc_id % 700 AS STRING)) AS dataset, {sha} AS sha256_text FROM documents",
    "drafts": """
        SELECT process_index, lineage, root_id, root_version, CAST(process_index % 7 AS STRING) AS semantic_hash, CAST(process_index % 5 AS STRING) AS significant_hash, CAST(process_index % 11 AS STRING) AS content_hash
        FROM process_axis""",
    "previous": """
        SELECT process_index, lineage, root_id, root_version, concat('0', CAST(1 + process_index % 3 AS STRING), '.0', CAST(process_index % 4 AS STRING), '.000') AS version,
               CAST((process_index + CASE WHEN process_index % 9 = 0 THEN 1 ELSE 0 END) % 7 AS STRING) AS semantic_hash,
               CAST((process_index + CASE WHEN process_index % 6 = 0 THEN 1 ELSE 0 END) % 5 AS STRING) AS significant_hash,
               CAST((process_index + CASE WHEN process_index % 4 = 0 THEN 1 ELSE 0 END) % 11 AS STRING) AS content_hash
        FROM process_axis WHERE process_index % 3 <> 0""",
    "weights": "SELECT CAST(n_nationkey AS BIGINT) AS target, CAST(n_nationkey * 7 + k AS BIGINT) AS process_index, CAST(1 + (n_nationkey + k) % 4 AS BIGINT) AS weight FROM nation CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) t",
}
#: Views a view reads, before it.
ORDER = ("process_axis", "order_lines", "technosphere_edges", "inventory", "provider_lci", "biosphere", "exact_lci", "expected_lci", "published_flows", "task_feed", "closures", "tasks", "hashed_documents", "artifacts", "drafts", "previous", "weights")

#: Views of grouped rows: Spark parts these rows by process before, so that what reads the view by process moves nothing again.
PARTED = ("inventory", "exact_lci")


class Views:
    """The domain views of one folder as DataFrames; nothing is registered in the caller's session."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.held = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self.held:
            if name in TABLES:
                self.held[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                used: dict[str, DataFrame] = {}

                def frame(m: re.Match) -> str:
                    used[m[2]] = getattr(self, m[2])
                    return f"{m[1]} {{{m[2]}}}"

                sql = re.sub(rf"\b(FROM|JOIN) ({'|'.join((*TABLES, *ORDER))})\b", frame, VIEWS[name].replace("{sha}", "sha2(text, 256)"))
                if name in PARTED:
                    head, rows, tail = re.fullmatch(r"(.*?) FROM \((.*)\) t (GROUP BY.*)", sql, re.S).groups()
                    rows = by_process(self.spark.sql(rows, **used))
                    self.held[name] = self.spark.sql(f"{head} FROM {{rows}} t {tail}", rows=rows)
                else:
                    self.held[name] = self.spark.sql(sql, **used)
        return self.held[name]


def with_views(sql: str) -> str:
    """DuckDB: ``sql`` with the views it needs in front."""
    ctes = ", ".join(f"{v} AS ({VIEWS[v].replace('{sha}', 'sha256(text)')})" for v in ORDER)
    sql = sql.strip()
    for start in ("WITH RECURSIVE ", "WITH "):
        if sql.upper().startswith(start):
            return f"{start}{ctes}, {sql[len(start) :]}"
    return f"WITH {ctes} {sql}"
