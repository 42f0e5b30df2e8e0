"""Centroid clustering: Lloyd's rounds in whole numbers, with ns-bounds that spare distances.

A vector of d finite components becomes d integers, floor(256 * x). A row keeps, for every centroid, the squared distance
when it was last evaluated and the round of that evaluation. All earlier positions of the centroids are retained, so a
stored distance is loosened by the norm of the centroid's total displacement since that round (not by the sum of its
drifts round by round, which can only be larger). A row whose loosened distance to its own centroid lies under all
others' keeps its centroid unseen; of the others, the own distance is evaluated, then those that may lie at or under it,
in whole numbers. So assignments, ties (the smaller number) and sums are exact.

Rows stay where they are: a round maps the partitions of a staged table to the next one (one is kept, the one before
goes), and only sums by cluster are shuffled, added up on the map side. The driver holds the centroids of all rounds:
rounds x clusters x d numbers, whatever the number of rows.

Vectors of another length, with a null or non-finite component, and null vectors are left out. Repeated rows are vectors
of their own; equal hashes are ordered by components. A null id has no hash: it starts a cluster only where others are
too few. Fewer vectors than clusters: every vector starts one. An empty table gives no rows. Other columns are not read.
A component whose integer passes 2^27 in size is an error, as squared distances would not fit a long.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cindermill.llm.common import discard, map_batches, staged

DIMENSIONS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 40, 5, 256, 2
LARGEST = 2**27
#: Rows of one numpy step.
ROWS = 4000
#: Relative slack of bounds, far above what rounding of doubles can add up to.
SLACK = 1e-9


def integer_vectors(rows: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """id, v of the rows (id, embedding) whose vectors are whole."""
    usable = (F.size("embedding") == dimensions) & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(usable).select("id", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def starts(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors whose ids have the smallest hashes."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).asc_nulls_last()
    return np.array([r.v for r in vectors.orderBy(order, "v").limit(clusters).select("v").collect()], np.int64)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows to rows, one to one."""
    d = a - b
    return (d * d).sum(1)


def all_squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centroids."""
    return (v * v).sum(1)[:, None] + (c * c).sum(1) - 2 * (v @ c.T)


def reassigned(v: np.ndarray, own: np.ndarray, stored: np.ndarray, at: np.ndarray, history: list[np.ndarray]) -> int:
    """Assign rows to the last centroids of ``history``; ``own``, ``stored`` and ``at`` change in place. Gives the distances evaluated."""
    now, i = len(history) - 1, np.arange(len(v))
    moved = np.sqrt([squared(history[now], c) for c in history])
    roots, shift = np.sqrt(stored), moved[at, np.arange(len(history[now]))]
    slack = SLACK * (roots + shift + 1)
    lower = roots - shift - slack
    upper = (roots + shift + slack)[i, own]
    lower[i, own] = np.inf
    open_ = np.flatnonzero(upper >= lower.min(1))
    if not len(open_):
        return 0
    mine = own[open_]
    exact = squared(v[open_], history[now][mine])
    stored[open_, mine], at[open_, mine] = exact, now
    seen = np.full((len(open_), lower.shape[1]), np.iinfo(np.int64).max)
    seen[np.arange(len(open_)), mine] = exact
    row, j = np.nonzero(lower[open_] <= (np.sqrt(exact) * (1 + SLACK) + SLACK)[:, None])
    for part in np.array_split(np.arange(len(row)), max(1, len(row) // ROWS)):
        r, c = row[part], j[part]
        seen[r, c] = squared(v[open_[r]], history[now][c])
    stored[open_[row], j], at[open_[row], j] = seen[row, j], now
    own[open_] = seen.argmin(1)
    return len(open_) + len(row)


def matrix(column: pa.Array, kind=np.int64) -> np.ndarray:
    """A column of lists of one length, as rows of an array of its own."""
    return np.array(column.flatten().to_numpy(zero_copy_only=False), kind).reshape(len(column), -1)


def lists(values: np.ndarray) -> pa.Array:
    n, d = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d), pa.array(values.ravel()))


def assigned(state: DataFrame, history: list[np.ndarray]) -> DataFrame:
    """The state (id, v, own, stored, at, n_distances) after one more assignment; at first only id and v are there."""
    first = "own" not in state.columns
    kind = state.schema["id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> dict:
        v = matrix(batch["v"])
        if first:
            stored = all_squared(v, history[-1])
            own, at, n = stored.argmin(1), np.zeros(stored.shape, np.int64), stored.size
        else:
            own, stored, at = np.array(batch["own"]).astype(np.int64), matrix(batch["stored"]), matrix(batch["at"])
            n = reassigned(v, own, stored, at, history)
        spent = np.zeros(len(v), np.int64)
        spent[0] = n
        return {"id": batch["id"], "v": batch["v"], "own": pa.array(own), "stored": lists(stored), "at": lists(at), "n_distances": pa.array(spent)}

    return map_batches(state, run, f"id {kind}, v array<bigint>, own int, stored array<bigint>, at array<int>, n_distances bigint", ROWS)


def moved_to(state: DataFrame, last: np.ndarray, exact: str) -> np.ndarray:
    """The floors of the means of every cluster's vectors; a cluster without any stays."""
    sums = [F.sum(F.get("v", i).cast(exact)).alias(f"s{i}") for i in range(last.shape[1])]
    out = last.copy()
    for own, n, *total in state.groupBy("own").agg(F.count("*"), *sums).collect():  # a row a cluster
        out[own] = [int(s) // n for s in total]
    return out


def clustered(vectors: DataFrame, first: np.ndarray | None = None, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """The state (id, v, own, n_distances: distances evaluated in the last round, on one row of every step) after ``rounds`` rounds and a last assignment, and the centroids of all rounds."""
    state = staged(vectors)
    n, most = state.agg(F.count("*"), F.max(F.greatest(F.array_max("v"), -F.array_min("v")))).first()
    if n and most > LARGEST:
        raise ValueError(f"a component reaches {most} after scaling; distances fit a long up to {LARGEST}")
    if not n:
        return state.withColumns({"own": F.lit(0), "n_distances": F.lit(0).cast("bigint")}), [np.zeros((0, 0), np.int64) if first is None else first]
    history = [starts(state) if first is None else first]
    exact = "bigint" if n * most < 2**63 else "decimal(38,0)"
    for _ in range(rounds):
        state, last = staged(assigned(state, history)), state
        discard(last)
        history.append(moved_to(state, history[-1], exact))
    state, last = staged(assigned(state, history)), state
    discard(last)
    return state, history


def digest(embeddings: DataFrame) -> DataFrame:
    """The contract's columns: the cluster of every kept vector, its squared distance and the sums of these."""
    state, history = clustered(integer_vectors(embeddings.select(F.col("vec_id").alias("id"), "embedding")))
    spark, last = embeddings.sparkSession, history[-1]
    names = [(j, [int(x) for x in c], hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest()) for j, c in enumerate(last)]
    centroids = F.broadcast(spark.createDataFrame(names, "own int, c array<bigint>, centroid_sha256 string"))  # at most CLUSTERS rows
    distance = F.aggregate(F.zip_with("v", "c", lambda a, b: (a - b) * (a - b)), F.lit(0).cast("bigint"), lambda s, x: s + x)
    rows = state.join(centroids, "own").select(F.col("id").alias("vec_id"), F.col("own").alias("cluster"), distance.alias("distance"), "centroid_sha256")
    per = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    every = per.agg(F.sum("cluster_inertia").alias("inertia"))
    sums = F.broadcast(per.crossJoin(every))  # a row a cluster, beside one row
    return rows.join(sums, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(dimensions: int = DIMENSIONS, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """DuckDB SQL of the contract, round by round, over one row a component."""
    ctes = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
        WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"c0 AS MATERIALIZED (SELECT k, i, v[i] AS x FROM (SELECT row_number() OVER (ORDER BY sha256(concat('{SEED}:', CAST(vec_id AS STRING))), v) - 1 AS k, v FROM kept QUALIFY k < {clusters}) CROSS JOIN range(1, {dimensions + 1}) t(i))",
        f"p AS MATERIALIZED (SELECT r, i, v[i] AS x FROM kept CROSS JOIN range(1, {dimensions + 1}) t(i))",
    ]
    for t in range(rounds + 1):
        ctes.append(f"a{t} AS MATERIALIZED (SELECT r, arg_min(k, d * 1000 + k) AS k, min(d) AS d FROM (SELECT r, k, CAST(sum((p.x - c.x) * (p.x - c.x)) AS BIGINT) AS d FROM p JOIN c{t} c USING (i) GROUP BY r, k) GROUP BY r)")
        if t < rounds:
            # // rounds towards zero
            mean = "CAST(s // n - CASE WHEN s < 0 AND s % n <> 0 THEN 1 ELSE 0 END AS BIGINT)"
            ctes.append(f"c{t + 1} AS MATERIALIZED (SELECT k, i, coalesce({mean}, c.x) AS x FROM c{t} c LEFT JOIN (SELECT k, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM a{t} JOIN p USING (r) GROUP BY k, i) USING (k, i))")
    return f"""WITH {", ".join(ctes)},
    h AS (SELECT k, sha256(string_agg(CAST(x AS STRING), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY k)
    SELECT vec_id, CAST(k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
    FROM a{rounds} JOIN kept USING (r) JOIN h USING (k)"""


ORACLE = oracle()
