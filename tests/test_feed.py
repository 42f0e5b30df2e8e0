"""The paged feed: bounded look-ups, and a stream that gives each task once over restarts."""

import json
import os

import pytest

from cindermill.sources import feed


def put(folder, cursor, ids, following=None, **more):
    os.makedirs(folder, exist_ok=True)
    items = [{"jobId": f"job-{i}", "jobKind": feed.JOB_KIND, "workerStatus": " ", "progressFraction": i / 100} | more for i in ids]
    page = {"items": items} | ({"nextCursor": following} if following else {})
    tmp = f"{folder}/.tmp"
    with open(tmp, "w") as f:
        json.dump(page, f)
    os.rename(tmp, f"{folder}/{feed.page_name(cursor)}")


def chain(folder, n, size=3):
    for k in range(n):
        put(folder, feed.FIRST if k == 0 else f"c/{k}?", range(k * size, k * size + size), f"c/{k + 1}?" if k + 1 < n else None)


def test_pages_are_partitions_and_the_bound_shows(spark, tmp_path):
    folder = f"{tmp_path}/pages"
    chain(folder, 7)
    rows = feed.feed(spark, folder)
    assert rows.rdd.getNumPartitions() == 6
    assert sorted((r.page, r.position) for r in rows.where("item is not null").collect()) == [(p, i) for p in range(1, 6) for i in range(1, 4)]
    assert [r.cursor for r in rows.where("item is null").collect()] == ["c/5?"]
    every = feed.tasks(feed.feed(spark, folder, 100))
    assert every.count() == 21 and every.where("workerStatus is null").count() == 21


def test_a_long_feed_has_bounded_partitions(spark, tmp_path):
    folder = f"{tmp_path}/pages"
    chain(folder, 600, 2)
    rows = feed.feed(spark, folder, 599)
    assert rows.rdd.getNumPartitions() == 201
    assert sorted((r.page, r.position, r.cursor) for r in rows.where("item is not null").collect()) == [(p, i, feed.FIRST if p == 1 else f"c/{p - 1}?") for p in range(1, 600) for i in (1, 2)]
    assert [r.cursor for r in rows.where("item is null").collect()] == ["c/599?"]


@pytest.mark.parametrize("job,pages,want", [("job-7", 5, (3, None)), ("job-20", 5, (None, "calculation_task_lookup_incomplete")), ("job-20", 7, (7, None)), ("job-99", 7, (None, "calculation_task_not_found"))])
def test_lookup(spark, tmp_path, job, pages, want):
    folder = f"{tmp_path}/pages"
    chain(folder, 7)
    r = feed.lookup(spark, folder, job, pages).collect()
    assert [(x.page, x.code) for x in r] == [want]


def test_other_kinds_missing_pages_loops_and_odd_pages(spark, tmp_path):
    folder = f"{tmp_path}/pages"
    put(folder, feed.FIRST, [1], "b", jobKind="other")
    put(folder, "b", [2], "gone")
    with pytest.raises(Exception, match="feed_page_missing"):
        feed.feed(spark, folder).count()
    assert [r.jobId for r in feed.tasks(feed.feed(spark, folder, 2)).collect()] == ["job-2"]
    put(folder, "gone", [3], feed.FIRST)
    with pytest.raises(Exception, match="feed_cursor_repeats"):
        feed.feed(spark, folder).count()
    put(folder, "gone", range(201))
    with pytest.raises(Exception, match="feed_page_too_large"):
        feed.feed(spark, folder).count()
    for text in ("[]", "{}", '{"items": 3}'):
        with open(f"{folder}/first.json", "w") as f:
            f.write(text)
        assert feed.feed(spark, folder).count() == 0


def run(spark, folder, out, batches):
    """Let the stream do so many triggers, then stop it."""
    q = feed.tasks(feed.feed_stream(spark, folder, 2)).writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/check").trigger(processingTime="0 seconds").start()
    try:
        before = q.lastProgress["batchId"] if q.lastProgress else -1
        for _ in range(600):
            q.processAllAvailable()
            if (q.lastProgress and q.lastProgress["batchId"] >= before + batches) or q.status["message"].startswith("Waiting"):
                break
    finally:
        q.stop()


def test_a_restart_gives_each_task_once(spark, tmp_path):
    folder, out = f"{tmp_path}/pages", f"{tmp_path}/out"
    chain(folder, 5)
    run(spark, folder, out, 2)
    read = lambda: sorted(r.jobId for r in spark.read.parquet(f"{out}/rows").collect())
    first = read()
    assert first == sorted(f"job-{i}" for i in range(15))
    run(spark, folder, out, 2)
    assert read() == first
    put(folder, "c/4?", range(12, 15), "c/5?")  # the end goes on
    put(folder, "c/5?", range(15, 18))
    run(spark, folder, out, 2)
    assert read() == sorted(f"job-{i}" for i in range(18))
    assert len(os.listdir(f"{out}/check/commits")) >= 4


def test_the_same_offsets_give_the_same_rows(tmp_path):
    folder = f"{tmp_path}/pages"
    chain(folder, 7)
    reader, at, batches = feed.PageStream({"path": folder}), {"page": "", "number": 0}, []
    while True:
        rows, end = reader.read(at)
        if end == at:
            break
        batches.append((at, end, list(rows)))
        at = end
    assert [len(b[2]) for b in batches] == [15, 6]
    assert all(list(feed.PageStream({"path": folder}).readBetweenOffsets(a, b)) == rows for a, b, rows in batches)
