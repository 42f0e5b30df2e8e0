"""Progress as keyed state: throttle, rates, records out of order, silent jobs, restarts."""

import json

import pytest

from cindermill.streaming import progress


def test_rates_guard_zero_and_unknown():
    assert progress.rates(10, 30, 2.0) == (5.0, 4.0)
    assert progress.rates(10, 30, 0.0) == (None, None) and progress.rates(None, 30, 2.0) == (None, None)
    assert progress.rates(0, 30, 2.0) == (0.0, None) and progress.rates(5, None, 2.0) == (2.5, None) and progress.rates(40, 30, 2.0) == (20.0, 0.0)


def test_what_is_told():
    state, told = None, []
    for r in [("a", 0, 4, 0, 1000), ("a", 1, 4, 0, 1500), ("a", 2, 4, 0, 2000), ("a", 3, 4, 0, 2500), ("a", 1, 4, 0, 1800), ("a", 4, 4, 0, 2600), ("b", None, None, 0, 2600), ("b", 1, None, 0, 3599), ("b", 2, None, 0, 3600)]:
        state, why = progress.advance(state, r)
        told.append(why)
    assert told == ["phase", None, "interval", None, None, "complete", "phase", None, "interval"]
    assert state == ("b", 2600, 3600, 3600, 2, None, 0)


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, progress.ROCKSDB)
    yield spark
    spark.conf.set(name, before)


def put(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    text = "".join(json.dumps({"jobId": j, "phase": p, "completed": c, "total": t, "outputBytes": 7, "at": f"2024-01-01T00:{s // 60:02}:{s % 60:02}Z"}) + "\n" for j, p, c, t, s in rows)
    (folder / name).write_text(text)


def test_a_stream_of_jobs(rocks, tmp_path):
    spark, folder = rocks, tmp_path / "in"

    def run():
        q = progress.throttled(progress.progress_records(spark, str(folder)), silent=60).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
        q.awaitTermination(180)
        assert not q.isActive and q.exception() is None
        rows = spark.read.parquet(f"{tmp_path}/out").collect()
        return sorted((r.jobId, int(r["at"].timestamp()) % 3600, r.reason, r.phase, r.completed, r.itemsPerSecond, r.etaSeconds) for r in rows)

    put(folder, "1.json", ("x", "a", 2, 10, 4), ("x", "a", 0, 10, 0), ("y", "a", 5, None, 1))  # out of order in a batch
    first = run()
    assert first == [("x", 0, "phase", "a", 0, None, None), ("x", 4, "interval", "a", 2, 0.5, 16.0), ("y", 1, "phase", "a", 5, None, None)]
    put(folder, "2.json", ("x", "a", 1, 10, 3), ("x", "a", 10, 10, 4))  # a late one changes nothing; the end is told at once, over a restart
    second = run()
    assert [r for r in second if r not in first] == [("x", 4, "complete", "a", 10, 2.5, 0.0)]
    put(folder, "3.json", ("z", "b", 1, 2, 100))
    run()
    put(folder, "4.json", ("z", "b", 1, 2, 101))
    last = run()
    assert [r[:4] for r in last if r[2] == "silent"] == [("x", 4, "silent", "a"), ("y", 1, "silent", "a")]
    assert len([r for r in last if r[0] == "z"]) == 2
