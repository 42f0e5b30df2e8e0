"""The sink of one file a dataset: whole or not at all, whatever happens to tasks."""

import hashlib
import json
import os

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from cindermill.sources import sink


def files_of(folder):
    return {os.path.relpath(os.path.join(at, f), folder): open(os.path.join(at, f), "rb").read() for at, _, names in os.walk(folder) for f in names}


def datasets(spark, n=500):
    rows = spark.range(n).select(F.concat(F.lit("AB-"), "id").alias("uuid"), F.lit("01.00.000").alias("version"), F.concat(F.lit('{"z": 1.50, "a": "é", "n": '), "id", F.lit("}")).alias("document"))
    return rows.repartition(7)


def test_one_canonical_file_a_dataset_and_an_index(spark, tmp_path):
    target = f"{tmp_path}/out"
    sink.write_datasets(datasets(spark), target)
    found = files_of(target)
    index = [json.loads(line) for name, text in found.items() if name.startswith("index/") for line in text.decode().splitlines()]
    assert found["canonical-datasets/ab-7_01.00.000.json"] == '{"a":"é","n":7,"z":1.5}\n'.encode()
    assert len(found) == 501 and len(index) == 500
    for entry in index:
        data = found[entry["path"]]
        assert entry["byteSize"] == len(data) and entry["sha256"] == hashlib.sha256(data).hexdigest()
    assert os.listdir(tmp_path) == ["out"]
    sink.write_datasets(datasets(spark).orderBy("uuid"), f"file:{tmp_path}/again")
    assert files_of(f"{tmp_path}/again") == found


def test_a_target_is_refused_or_replaced(spark, tmp_path):
    target = f"{tmp_path}/out"
    sink.write_datasets(datasets(spark, 5), target)
    before = files_of(target)
    with pytest.raises(Exception, match="output_exists"):
        sink.write_datasets(datasets(spark, 6), target)
    assert files_of(target) == before and os.listdir(tmp_path) == ["out"]
    sink.write_datasets(datasets(spark, 2), target, replace=True)
    assert len(files_of(target)) == 3 and os.listdir(tmp_path) == ["out"]


@pytest.mark.parametrize("content", ["same", "other"])
def test_two_rows_of_one_path_leave_nothing(spark, tmp_path, content):
    rows = spark.createDataFrame([("a.json", "same"), ("a.json", content), ("b.json", "x")], "path string, content string")
    with pytest.raises(Exception, match="duplicate_dataset"):
        sink.write_files(rows.repartition(3), f"{tmp_path}/out")
    assert os.listdir(tmp_path) == []


@pytest.mark.parametrize("path", ["/etc/x", "../x", "a/../b", "a//b", "c:x", "a\\b", ""])
def test_unsafe_paths_leave_nothing(spark, tmp_path, path):
    with pytest.raises(Exception, match="unsafe_artifact_path"):
        sink.write_files(spark.createDataFrame([("ok", "1"), (path, "2")], "path string, content string"), f"{tmp_path}/out")
    assert os.listdir(tmp_path) == []


def test_a_failing_task_leaves_nothing(spark, tmp_path):
    def run(batches):
        for batch in batches:
            yield batch
        if TaskContext.get().partitionId() == 2:
            raise RuntimeError("lost")

    rows = datasets(spark, 50).select(F.col("uuid").alias("path"), F.col("document").alias("content"))
    with pytest.raises(Exception, match="lost"):
        sink.write_files(rows.mapInArrow(run, rows.schema), f"{tmp_path}/out")
    assert os.listdir(tmp_path) == []


def test_a_second_attempt_takes_over_what_the_first_left(tmp_path):
    writer = sink.FileWriter(f"{tmp_path}/out", False)
    rows = [("a/1.json", "one"), ("a/2.json", "two")]
    writer.write(iter(rows[:1]))  # lost before it told of it
    done = writer.write(iter(rows))
    writer.commit([done, None])
    assert files_of(f"{tmp_path}/out") == {"a/1.json": b"one", "a/2.json": b"two"}
    assert os.listdir(tmp_path) == ["out"]


def test_no_rows_make_an_empty_dataset(spark, tmp_path):
    sink.write_files(spark.createDataFrame([], "path string, content binary"), f"{tmp_path}/out")
    assert os.listdir(f"{tmp_path}/out") == []
