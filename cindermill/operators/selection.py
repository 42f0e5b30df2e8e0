"""Selecting axes, closing over providers, finding what is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_axes(axes: DataFrame, selectors: DataFrame) -> DataFrame:
    """selector, matches (axes of that id and, if the selector names one, version), process_index (none: -1), ok (exactly one)."""
    at = F.split("selector", "@")
    wanted = selectors.select("selector", F.lower(at[0]).alias("id"), F.when(F.size(at) > 1, at[1]).alias("version")).distinct()
    found = wanted.join(axes, (F.lower("root_id") == F.col("id")) & (F.col("version").isNull() | (F.col("version") == F.col("root_version"))), "left")
    return found.groupBy("selector").agg(F.count("process_index").alias("matches"), F.coalesce(F.min("process_index"), F.lit(-1)).alias("process_index")).withColumn("ok", F.col("matches") == 1)


def required_axes(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """The roots and their direct providers, each once."""
    providers = edges.join(roots, edges.dependent_index == roots.process_index, "left_semi").select(F.col("balancing_index").alias("process_index"))
    return roots.select("process_index").union(providers).distinct()


#: Routes: with models, the selected processes result from their providers; without, they stand alone.
ROUTES = {"lifecycle-model": "resulting", "result-process": "primary"}


def roles(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """process_index, route, role: selected processes are resulting or primary by the route; direct providers (with models only) are dependencies."""
    roots = roots.select("process_index").distinct()
    model, alone = ROUTES
    providers = required_axes(roots, edges).join(roots, "process_index", "left_anti")
    own = roots.select("process_index", F.explode(F.create_map(*[F.lit(x) for kv in ROUTES.items() for x in kv])).alias("route", "role"))
    return own.union(providers.select("process_index", F.lit(model), F.lit("dependency")))


def missing(wanted: DataFrame, present: DataFrame, key: list[str]) -> DataFrame:
    """Keys of ``wanted`` that ``present`` lacks."""
    return wanted.select(*key).distinct().join(present.select(*key), key, "left_anti")


def reference_pivot(axes: DataFrame) -> DataFrame:
    """Signed coefficient of the reference flow, the scale to one unit and the normalised coefficient."""
    sign = direction_sign("direction")
    signed = sign * F.col("raw_amount")
    return axes.select("process_index", "direction", "raw_amount", signed.alias("signed_coefficient"), (1 / F.abs(signed)).alias("scale"), F.signum(signed).alias("normalized_coefficient"))


def direction_sign(direction: str):
    """-1 for input, 1 for output, null for anything else."""
    return F.when(F.lower(direction) == "input", F.lit(-1)).when(F.lower(direction) == "output", F.lit(1))


def nearly_equal(a, b):
    """Equal within 1e-12 of the larger magnitude, or of 1."""
    return F.abs(a - b) <= F.lit(1e-12) * F.greatest(F.abs(a), F.abs(b), F.lit(1.0))


def finite(x):
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


#: A version, a safe relative path.
VERSION = r"^[0-9]{2}\.[0-9]{2}\.[0-9]{3}$"


def valid_version(c):
    return c.rlike(VERSION)


def safe_path(c):
    """Relative, no backslash, no empty, ``.`` or ``..`` segment."""
    return ~c.startswith("/") & ~c.contains("\\") & ~F.exists(F.split(c, "/"), lambda x: x.isin("", ".", ".."))


def elementary_flow(document: str):
    """Whether a document says that its dataset is an elementary flow; what is no JSON says nothing."""
    kind = F.get_json_object(document, "$.flowDataSet.modellingAndValidation.LCIMethod.typeOfDataSet")
    return kind.eqNullSafe(F.lit("Elementary flow"))


def suffixed(names, suffix: str):
    """Names (lang, text) of which the English ones end in a dash and ``suffix``."""
    return F.transform(names, lambda n: F.struct(n["lang"].alias("lang"), F.when(n["lang"] == "en", F.concat(n["text"], F.lit(f" — {suffix}"))).otherwise(n["text"]).alias("text")))
