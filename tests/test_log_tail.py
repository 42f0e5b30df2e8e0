"""The log tail keeps whole lines up to the reference's limit."""

from types import SimpleNamespace

from cindermill.plans import queries


def test_log_tail_keeps_lines(spark):
    lines = ['{"k": 69}', "y" * 4000, "z" * 5000, None]
    tasks = spark.createDataFrame([(i, i, t) for i, t in enumerate(lines)], "job_id long, updated_at long, props string")
    got = {r.job_id: r.line for r in queries.log_tail(SimpleNamespace(tasks=tasks)).collect()}
    assert got == {0: lines[0], 1: lines[1], 2: "z" * 4000 + "…", 3: None}
