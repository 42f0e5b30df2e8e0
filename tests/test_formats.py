"""Scalar formats and field declarations in the cases that their queries don't reach."""

import base64
import json

import pytest
from pyspark.sql import functions as F

from cindermill.functions import formats
from cindermill.operators import fields


def one(spark, expression, *texts):
    return [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(expression).collect()]


def test_credentials(spark):
    key = lambda x: base64.b64encode(json.dumps(x).encode()).decode()
    got = one(spark, formats.credentials(F.col("t")), f"  {key({'email': ' a@b.c ', 'password': 'p'})} ", key({"email": "a"}), key({"email": " ", "password": "p"}), "%%%", key([1]), None, "")
    assert [tuple(x) if x else None for x in got] == [("a@b.c", "p"), None, None, None, None, None, None]


def test_storage_refs(spark):
    got = one(spark, formats.storage_ref(F.col("t")), "s3://B/a/b%2Fc?x", "S3://b//k", "s3://b/", "https://h/v/storage/v1/s3/b/", "https://h/storage/v1/s3//k", "https://h/storage/v1/s3/b/%zz", None, "/storage/v1/s3/b/k")
    assert [tuple(x) if x else None for x in got] == [("b", "a/b/c"), ("b", "k"), None, None, None, None, None, None]


@pytest.mark.parametrize("text,want", [("a", True), ("a.", False), (".a", False), ("a..b", False), ("a_b-c.1", True), ("", False), ("a" * 64, True), ("a" * 65, False)])
def test_release_versions(spark, text, want):
    assert one(spark, formats.valid_release(F.col("t")), text) == [want]


def test_times_and_paths(spark):
    assert one(spark, formats.valid_time(F.col("t")), "2024-01-01T00:00:00Z", "soon", None, "") == ["2024-01-01T00:00:00Z", None, None, None]
    assert one(spark, formats.intake_path(F.col("t"), F.lit("c"), F.lit("h")), "/root//", "x") == ["/root/result-materialization/intakes/c/h", "x/result-materialization/intakes/c/h"]
    assert one(spark, formats.result_set_name(F.to_timestamp_ntz("t")), "2023-12-31 16:05:00") == ["ResultSet-20240101-0005"]


def test_declared_fields(spark):
    values = spark.createDataFrame([(1, "f", "a", "x"), (1, "f", "b", "y"), (1, "g", "a", None), (1, "g", "b", " "), (1, "h", "a", "x"), (1, "e", "a", "x"), (1, "e", "b", "y"), (2, "e", "a", "x"), (2, "e", "b", "x"), (2, "e", "c", "z")], "dataset int, field string, source string, value string")
    declared = spark.createDataFrame([("f", "b", 1, "precedence"), ("f", "a", 2, "precedence"), ("g", "a", 1, "equal"), ("e", "a", 1, "equal"), ("e", "b", 1, "equal")], "field string, source string, rank int, policy string")
    got = {(r.dataset, r.field): (r.value, r.source, r.conflict, r.undeclared, r.code) for r in fields.resolved(values, declared).collect()}
    assert got == {(1, "f"): ("y", "b", True, 0, None), (1, "h"): (None, None, False, 1, "field_source_undeclared"), (1, "e"): (None, None, True, 0, "field_conflict"), (2, "e"): ("x", "a", False, 1, None)}


def test_composition_with_a_cycle(spark):
    edges = spark.createDataFrame([(1, 2, 2.0), (2, 1, 3.0), (2, 4, 1.0), (1, 4, 5.0)], "dependent_index int, balancing_index int, activity double")
    rows = fields.composed(spark.createDataFrame([("t", 1, 1.0)], "target string, process_index int, amount double"), edges, 3, lambda df: df.persist())
    got = sorted((r.depth, r.process_index, r.amount) for r in rows.collect())
    assert got == [(0, 1, 1.0), (1, 2, 2.0), (1, 4, 5.0), (2, 1, 6.0), (2, 4, 2.0), (3, 2, 12.0), (3, 4, 30.0)]
    assert {r.process_index: r.depths for r in fields.revisited(rows).collect()} == {1: [0, 2], 2: [1, 3], 4: [1, 2, 3]}
