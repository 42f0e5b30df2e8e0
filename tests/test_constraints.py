"""Rules as data: what they find, how failing closed picks, and that all of a table's rules take one scan and no Python."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from cindermill.functions import variants
from cindermill.operators import constraints
from cindermill.operators.constraints import Rule
from cindermill.plans import rules
from cindermill.plans.views import Views
from cindermill.sources.files import Rejected

SF = "/root/testdata/sf0.001"


def test_rules_nulls_and_the_first_violation(spark):
    rows = spark.createDataFrame([(1, 5.0), (2, None), (3, -1.0)], "id int, x double")
    found = constraints.violations(rows, [Rule("b", "low", F.col("x") < 0), Rule("a", "missing", F.col("x").isNull()), Rule("a", "big", F.col("x") > 4)], F.col("id"))
    assert sorted(map(tuple, found.collect())) == [("a", "big", "1"), ("a", "missing", "2"), ("b", "low", "3")]
    with pytest.raises(Rejected, match="a: big 1"):
        constraints.fail_closed(found)
    constraints.fail_closed(found.where("code = 'c'"))


def test_all_rules_of_a_table_take_one_scan_without_python(spark):
    axes, closure = rules.faulty_axes(Views(spark, SF))
    out = io.StringIO()
    with redirect_stdout(out):
        constraints.axis_violations(axes, closure).explain("formatted")
    plan = out.getvalue()
    assert len(constraints.axis_rules()) == 17
    assert plan.split("\n\n")[0].count("Scan parquet") == 2 and "Python" not in plan  # axes, sources


def test_counts_are_observed_on_the_way(spark):
    seen = Observation()
    found = constraints.axis_violations(*rules.faulty_axes(Views(spark, SF)), count=seen).groupBy("code").count().collect()
    got = {k: v for k, v in seen.get.items() if k != "rows" and v}
    assert got == {r.code: r["count"] for r in found}


def test_one_object_or_many(spark):
    texts = ['{"a": {"b": [1, "x"]}}', '{"a": {"b": 1}}', '{"a": {"b": null}}', '{"a": {}}', '{"a": 3}', "[1]", "no json", None, '{"a": {"b": []}}', '{"a": {"b": {"c": 2}}}']
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    b = variants.at(variants.document(F.col("t")), "a", "b")
    out = rows.select("i", F.transform(variants.many(b), lambda x: F.to_json(x)).alias("many"), variants.text(b).alias("text")).orderBy("i").collect()
    assert [r.many for r in out] == [["1", '"x"'], ["1"], [], [], [], [], [], [], [], ['{"c":2}']]
    assert [r.text for r in out] == [None, "1", None, None, None, None, None, None, None, None]


def test_keys_with_odd_characters(spark):
    row = spark.createDataFrame([('{"@dataSetInternalID": 7, "common:x.y": {"#text": "t"}}',)], "t string")
    d = variants.document(F.col("t"))
    assert tuple(row.select(variants.text(d, "@dataSetInternalID"), variants.text(d, "common:x.y", "#text")).first()) == ("7", "t")


def test_empty_tables(spark):
    axes, closure = rules.faulty_axes(Views(spark, SF))
    assert constraints.axis_violations(axes.limit(0), closure).count() == 0
    assert constraints.axis_violations(axes, closure.limit(0)).groupBy("code").count().collect()[0].code == "unit_process_missing"
    assert constraints.document_violations(spark.createDataFrame([("a", "{}"), ("b", None)], "subject string, document string")).where("detail = 'quantitative_reference'").count() == 2


def test_documents_are_dealt_before_they_are_sorted_and_never_broadcast(spark):
    out = io.StringIO()
    with redirect_stdout(out):
        constraints.with_sources(*rules.faulty_axes(Views(spark, SF))).explain()
    plan = out.getvalue()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    below = plan[plan.rindex("REPARTITION_BY_NUM") :]  # where the documents are read
    assert "Aggregate" not in below and "Sort" not in below
