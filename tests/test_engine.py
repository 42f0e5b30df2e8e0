"""The engine's rules on small cases where they differ from plausible other ones."""

import gzip
import hashlib
import io
import json
import os
import re
import uuid
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from cindermill.functions import canonical
from cindermill.operators import control, dependencies, integrity, inventory, selection, versioning
from cindermill.plans import queries  # noqa: F401  they register themselves
from cindermill.plans import registry as plans
from cindermill.sources import bundle, sink
from cindermill.streaming import jobs

PROCESS, FLOW = "11111111-1111-4111-8111-111111111111", "22222222-2222-4222-8222-222222222222"
ROW = "process_index long, flow_id string, flow_version string, direction string, unit string, location string, amount double"
DRAFT = "process_index long, lineage string, root_id string, root_version string, semantic_hash string, significant_hash string, content_hash string"
PREVIOUS = DRAFT + ", version string"


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def checked(spark, direct, target):
    lci = spark.createDataFrame(target, ROW)
    edges = spark.createDataFrame([], "dependent_index long, balancing_index long, activity double")
    return inventory.evidence(spark.createDataFrame(direct, ROW), edges, lci, lci).first()


@pytest.mark.parametrize(("amount", "passed"), [(1e-7, True), (1e-4, False), (1e-6 + 5e-13, True), (1e-6 + 5e-12, False)])
def test_tolerance_adds_both_parts_on_the_scale_of_direction_and_unit(spark, amount, passed):
    large, small = (0, "A", "01.00.000", "Output", "kg", None, 100.0), (0, "b", "01.00.000", "output", "kg", "", amount)
    got = checked(spark, [large, small], [(0, "a", "01.00.000", "OUTPUT", "kg", "", 100.0)])
    assert (got.passed, got.flow_count, got.max_allowed_difference) == (passed, 2, 1e-12 + 1e-8 * 100.0)
    assert got.max_absolute_difference == amount and got.max_relative_difference == amount / 100


def test_locations_and_versions_are_keys_of_their_own(spark):
    base = [(0, "a", "01.00.000", "Output", "kg", "DE", 1.0), (0, "a", "01.00.000", "Output", "kg", "FR", 2.0), (0, "a", "02.00.000", "Output", "kg", "FR", 3.0)]
    assert checked(spark, base, base).flow_count == 3
    assert not checked(spark, base, [(0, "a", "01.00.000", "Output", "kg", "DE", 6.0)]).passed
    edges = spark.createDataFrame([], "dependent_index long, balancing_index long, activity double")
    direct, other = spark.createDataFrame(base, ROW), spark.createDataFrame(base[:2], ROW)
    assert rows(inventory.mismatches(direct, edges, other, other), "code", "subject") == [(inventory.MISMATCH, "0|a|02.00.000|output|kg|FR")]


def test_version_decisions(spark):
    old = [(i, "l", f"P{i}", "01.00.000", "a", "b", "c", v) for i, v in enumerate(["01.02.000", "01.02.000", "01.02.000", "01.02.000", "99.00.000", "01.99.000"])]
    new = [(0, "l", "p0", "01.00.000", "a", "b", "c"), (1, "l", "P1", "01.00.000", "a", "x", "c"), (2, "l", "P2", "01.00.000", "x", "b", "c"), (3, "l", "P3", "01.00.000", "a", "b", "x")]
    new += [(4, "l", "P4", "01.00.000", "x", "b", "c"), (5, "l", "P5", "01.00.000", "a", "x", "c"), (6, "l", "P6", "01.00.000", "a", "b", "c")]
    previous = spark.createDataFrame(old, PREVIOUS)
    got = versioning.resolved(spark.createDataFrame(new, DRAFT), previous)
    want = [(0, "01.02.000", "reuse"), (1, "01.03.000", "minor"), (2, "02.00.000", "major"), (3, "01.02.000", "reuse"), (4, None, "major"), (5, None, "minor"), (6, "01.00.000", "initial")]
    assert rows(got, "process_index", "version", "change") == want
    assert rows(versioning.overflows(got), "code", "subject") == [("dataset_version_overflow", "4"), ("dataset_version_overflow", "5")]
    final = spark.createDataFrame([(3, "l", "P3", "01.00.000", "a", "b", "x", "01.02.000")], PREVIOUS)
    assert rows(versioning.content_collisions(final, previous), "subject") == [("P3@01.00.000",)]


def test_variants_of_a_lineage(spark):
    drafts = spark.createDataFrame([(1, "r", PROCESS, "01.01.002", "a", "a", "a"), (2, "r", PROCESS, "01.01.005", "b", "b", "b")], DRAFT)
    none = spark.createDataFrame([], PREVIOUS)
    first = versioning.allocated(versioning.resolved(drafts, none), none)
    assert rows(first, "process_index", "version", "change") == [(1, "01.00.000", "initial"), (2, "02.00.000", "initial")]
    released = drafts.join(first.select("process_index", "version"), "process_index")
    assert rows(versioning.allocated(versioning.resolved(drafts, released), released), "version", "change") == [("01.00.000", "reuse"), ("02.00.000", "reuse")]
    # a source that has left keeps its version; 99 majors at most
    fresh = spark.createDataFrame([(9, "r", "zz", "01.00.000", "q", "q", "q")], DRAFT)
    assert rows(versioning.allocated(versioning.resolved(fresh, released), released), "version") == [("03.00.000",)]
    full = spark.createDataFrame([(i, "r", f"s{i}", "01.00.000", "a", "a", "a", f"{i:02d}.00.000") for i in range(1, 100)], PREVIOUS)
    out = versioning.allocated(versioning.resolved(fresh, full), full)
    assert rows(versioning.overflows(out), "subject") == [("9",)]


def test_a_lineage_of_any_size_is_allocated_in_order(spark):
    n = 3000
    drafts = spark.range(n).selectExpr("id AS process_index", "'r' AS lineage", "format_string('S%05d', id) AS root_id", "'01.00.000' AS root_version", "'a' AS semantic_hash", "'a' AS significant_hash", "'a' AS content_hash")
    held = [(i, "r", f"gone{i}", "01.00.000", "a", "a", "a", v) for i, v in enumerate(("02.00.000", "04.00.000"))] + [(5, "r", "s00007", "01.00.000", "a", "a", "a", "07.00.000"), (6, "other", "x", "01.00.000", "a", "a", "a", "03.00.000")]
    previous = spark.createDataFrame(held, PREVIOUS)
    out = versioning.allocated(versioning.resolved(drafts, previous), previous)
    free = [m for m in range(1, 100) if m not in (2, 4, 7)]
    want, change = dict(zip([i for i in range(n) if i != 7], (f"{m:02d}.00.000" for m in free), strict=False)), {7: "reuse"}
    want[7] = "07.00.000"
    assert {r.process_index: (r.version, r.change) for r in out.collect()} == {i: (want.get(i), change.get(i, "initial")) for i in range(n)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "collect_set" not in plan  # no lineage is gathered in a row


def test_job_and_task_states(spark):
    cases = [("running", True, 1, True, "running"), ("running", False, 0, True, "succeeded"), ("cancelling", False, None, True, "cancelled"), ("queued", False, 3, True, "failed")]
    cases += [("running", False, None, True, "interrupted"), ("queued", False, None, False, "queued"), ("interrupted", False, 0, True, "interrupted"), ("failed", False, 0, True, "failed")]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, state string, alive boolean, code int, started boolean, want string")
    got = df.select("i", control.job_state(F.col("state"), F.col("alive"), F.col("code"), F.col("started")).alias("got"), "want").collect()
    assert all(r.got == r.want for r in got)
    tasks = [("completed", "passed", "valid", True, False), ("completed", "passed", None, True, True), ("stale", "passed", "valid", True, True), ("cancelled", None, None, True, False), ("running", None, None, False, False), (None, None, None, False, False)]
    df = spark.createDataFrame(tasks, "worker_status string, domain_status string, domain_validity string, t boolean, d boolean")
    assert all((r.is_terminal, r.diagnostics) == (r.t, r.d) for r in control.task_state(df).collect())


def test_roles_by_route(spark):
    roots = spark.createDataFrame([(1,), (2,)], "process_index long")
    edges = spark.createDataFrame([(1, 2), (1, 3), (7, 8)], "dependent_index long, balancing_index long")
    want = [(1, "lifecycle-model", "resulting"), (1, "result-process", "primary"), (2, "lifecycle-model", "resulting"), (2, "result-process", "primary"), (3, "lifecycle-model", "dependency")]
    assert rows(selection.roles(roots, edges), "process_index", "route", "role") == want


def test_set_hash_is_of_the_canonical_list(spark):
    rows = [("k", "b", "x\u001f"), ("k", "a", 'q"é'), ("m", "c", None), (None, "d", "y"), (None, "d", "x")]
    got = {r.kind: (r.entries, r.set_hash) for r in integrity.set_hash(spark.createDataFrame(rows, "kind string, path string, uuid string"), ["kind"], "path", ["uuid", "path"]).collect()}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = {"k": (2, sha('[{"path":"a","uuid":"q\\"é"},{"path":"b","uuid":"x\\u001f"}]')), "m": (1, sha('[{"path":"c"}]')), None: (2, sha('[{"path":"d","uuid":"x"},{"path":"d","uuid":"y"}]'))}
    assert got == want


def test_a_set_of_any_size_has_one_hash(spark):
    """Three groups, one of them nearly all rows, over many parts and batches: the digests of the flat documents."""
    n = 200_000
    rows = spark.range(n).select(F.when(F.col("id") % 1000 == 7, "small").when(F.col("id") == 5, "one").otherwise("large").alias("kind"), F.format_string("p/%09d", (F.col("id") * 7919) % n).alias("path")).repartition(9)
    paths = {"large": [], "small": [], "one": []}
    for i in range(n):
        paths["small" if i % 1000 == 7 else "one" if i == 5 else "large"].append(f"p/{i * 7919 % n:09}")
    got = {r.kind: r.set_hash for r in integrity.set_hash(rows, ["kind"], "path", ["path"]).collect()}
    assert got == {k: hashlib.sha256(("[" + ",".join(f'{{"path":"{p}"}}' for p in sorted(x)) + "]").encode()).hexdigest() for k, x in paths.items()}


def test_key_document_is_hashed_whole(spark):
    key = {"b": {"list": None, "z": 1}, "a": ["é", None]}
    rows = spark.createDataFrame([("p@2",), ("p@10",), ('q"',)], "x string")
    text = '{"a":["é",null],"b":{"list":["p@10","p@2","q\\""],"z":1}}\n'
    assert integrity.key_hash(rows, key, "b/list") == hashlib.sha256(text.encode()).hexdigest()
    assert integrity.key_hash(rows.limit(0), key, "b/list") == hashlib.sha256(b'{"a":["\xc3\xa9",null],"b":{"list":[],"z":1}}\n').hexdigest()


def test_identities_and_hashes(spark):
    df = spark.createDataFrame([(PROCESS.upper(), FLOW)], "p string, f string")
    assert df.select(canonical.result_uuid("p", "f").alias("u")).first().u == "e69b636c-c09d-5584-a00e-5ae3380594de"
    document = f'{{"modelProfileId":"{canonical.MODEL_PROFILE}","referenceFlowUuid":"{FLOW}","rootProcessUuid":"{PROCESS}","schema":"s.v1"}}'
    assert df.select(canonical.model_uuid("p", "f", "s.v1").alias("u")).first().u == str(uuid.uuid5(uuid.UUID(canonical.MODEL_NAMESPACE), document))
    field = b'"bundleContentHash":"' + b"a" * 64 + b'",'
    assert canonical.bundle_hash(b'{"big":12345678901234567890,' + field + b'"x":1}') == hashlib.sha256(b'{"big":12345678901234567890,"x":1}').hexdigest()
    for bad in (b"{}", field + field, field.replace(b":", b": ")):
        with pytest.raises(ValueError, match="bundle_content_hash_field_invalid"):
            canonical.bundle_hash(bad)


def test_canonical_json():
    value = {"\u20ac": 1, "\r": 2, "1": 3, "\U0001f600": 4, "\ufb33": 5, "n": [1e21, 1e-7, -0.0, 4.50, 1e6, 333333333.33333329], "s": "e\u000f\"\\", "t": [None, True]}
    want = '{"\\r":2,"1":3,"n":[1e+21,1e-7,0,4.5,1000000,333333333.3333333],"s":"e\\u000f\\"\\\\","t":[null,true],"\u20ac":1,"\U0001f600":4,"\ufb33":5}'
    assert canonical.canonical_json(value) == want
    assert canonical.canonical_json({"e\u0301": "e\u0301"}, nfc=True) == '{"\u00e9":"\u00e9"}'
    assert canonical.without_keys({"a": [{"common:timeStamp": 1, "b": None}]}, frozenset(canonical.NOT_SIGNIFICANT)) == {"a": [{"b": None}]}


@pytest.fixture
def folder(tmp_path):
    lines = ['{"processIndex":1,"flow":{"id":"F","version":"01.00.000"},"meanAmount":"2.5"}', "", '{"processIndex":2,"flow":{"id":"G"},"meanAmount":3}', '{"processIndex":3,"meanAmount":"abc"}']
    with gzip.open(tmp_path / "lci-2.ndjson.gz", "wt") as f:
        f.write("\n".join(lines))
    (tmp_path / "lci-1.ndjson").write_text('{"processIndex":4,"meanAmount":"Infinity"}\n{"processIndex":\n')
    return tmp_path


def test_artifacts_of_text_and_gzip(spark, folder):
    paths = [str(folder / n) for n in ("lci-1.ndjson", "lci-2.ndjson.gz")]
    read = bundle.amounts(bundle.read_artifact(spark, "lci", paths)).cache()
    got = {r.processIndex: r for r in read.collect()}
    assert {i: got[i].meanAmount for i in (1, 2, 3, 4)} == {1: 2.5, 2: 3.0, 3: None, 4: None}
    assert got[None]._corrupt_record == '{"processIndex":' and got[1]._corrupt_record is None
    counts = {os.path.basename(r.path): r.records for r in bundle.raw_line_counts(spark, paths).collect()}
    assert counts == {"lci-1.ndjson": 2, "lci-2.ndjson.gz": 4}


def test_files_against_their_index(spark, folder):
    found = bundle.file_digests(spark, str(folder))
    raw = {p.name: p.read_bytes() for p in folder.iterdir()}
    got = {os.path.basename(r.path): (r.byte_size, r.sha256) for r in found.collect()}
    assert got == {n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in raw.items()}
    assert bundle.drift(found, found).collect() == []
    other = found.withColumn("sha256", F.when(F.col("path").endswith("gz"), "0").otherwise(F.col("sha256"))).union(spark.createDataFrame([("gone", 1, "x")], "path string, byte_size long, sha256 string"))
    assert sorted(os.path.basename(r.path) for r in bundle.drift(other, found).collect()) == ["gone", "lci-2.ndjson.gz"]


def test_commit_is_complete_and_never_replaces(spark, tmp_path):
    target = str(tmp_path / "out")
    sink.commit(spark.range(3), target)
    assert spark.read.json(target).count() == 3
    with pytest.raises(FileExistsError):
        sink.commit(spark.range(5), target)
    assert spark.read.json(target).count() == 3 and os.listdir(tmp_path) == ["out"]


def test_job_status_stream(spark, tmp_path):
    source = tmp_path / "status"
    source.mkdir()
    events = [("a", "running", 1, 4, "2024-01-01T00:00:00"), ("a", "running", 2, 4, "2024-01-01T00:01:00"), ("a", "running", 2, 4, "2024-01-01T00:01:00"), ("b", "queued", 0, 0, "2024-01-01T00:00:00")]
    (source / "1.json").write_text("\n".join(json.dumps(dict(zip(("jobId", "state", "completed", "total", "updatedAt"), e, strict=True))) for e in events))
    query = jobs.latest(jobs.status_records(spark, str(source))).writeStream.format("memory").queryName("job_status").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert rows(spark.table("job_status"), "jobId", "state", "completed", "progress") == [("a", "running", 2, 0.5), ("b", "queued", 0, None)]


def closure(spark):
    ref = lambda i, v="01.00.000": {"referenceToFlowDataSet": {"@refObjectId": i, "@version": v}}
    a, b, c = (f"{x * 8}-{x * 4}-4{x * 3}-8{x * 3}-{x * 12}" for x in "abc")
    method = {"LCIAMethodDataSet": {"characterisationFactors": {"factor": [ref(a.upper()), ref(b), ref(a)]}, "other": ref("ignored")}}
    nested = json.dumps({"LCIAMethodDataSet": {"characterisationFactors": {"x": 0}}}).replace('"x": 0', f'"x": {"[" * 900}{json.dumps(ref(c))}{"]" * 900}')
    data = [("lciamethod", "m1", "01.00.000", json.dumps(method)), ("lciamethod", "m2", "01.00.000", nested), ("flow", b, "01.00.000", "{}"), ("process", "p", "01.00.000", json.dumps(method))]
    return (a, b, c), spark.createDataFrame(data, "dataset_type string, uuid string, version string, document string")


def test_dependency_expansion(spark):
    (a, b, c), own = closure(spark)
    found = dependencies.method_references(own)
    assert rows(found, "uuid") == sorted([(a,), (a,), (b,), (c,)])
    assert dependencies.invalid_references(found).count() == 0
    cache = spark.createDataFrame([(a.upper(), "01.00.000", "A"), (a, "02.00.000", "other"), (c, "01.00.000", "C"), (b, "01.00.000", "B")], "uuid string, version string, document string")
    assert [(r.uuid, r.document) for r in dependencies.expanded(found, own, cache).collect()] == [(a, "A"), (c, "C")]
    assert dependencies.expansion_violations(found, own, cache).collect() == []
    assert rows(dependencies.expansion_violations(found, own, cache.limit(0), limit=1), "code", "subject") == [("release_intake_dependency_limit_exceeded", "2"), ("release_intake_exact_flow_missing", f"{a}@01.00.000")]
    got = dependencies.summary(found, own).first()
    assert tuple(got) == (2, 4, 3, 1)
    broken = spark.createDataFrame([("m", "no-id", "1")], "method string, uuid string, version string")
    assert rows(dependencies.invalid_references(broken), "subject") == [("m:no-id@1",)]


def test_require_empty(spark):
    integrity.require_empty(spark.range(0), "code")
    with pytest.raises(integrity.Violated, match="code"):
        integrity.require_empty(spark.range(1), "code")
    twice = spark.createDataFrame([("a", "1", "x"), ("a", "1", "y"), ("b", "1", "x"), ("b", "1", "x")], "id string, version string, sha string")
    assert rows(integrity.identity_conflicts(twice, ["id", "version"], "sha"), "subject") == [("a@1",)]


def test_the_reconstruction_moves_its_rows_by_process_alone(spark):
    found = plans.QUERIES["one_hop_reconstruction"](spark, "/root/testdata/sf0.001")
    assert len(found.collect()) == 100  # the final plan is known then
    out = io.StringIO()
    with redirect_stdout(out):
        found.explain()
    final = re.sub(r"#\d+L?", "", out.getvalue().split("== Initial Plan ==")[0])
    moved = re.findall(r"[^\n]*Exchange hashpartitioning\(process_index, ([a-z0-9_]+)[^\n]*\n([^\n]*)", final)
    assert all(second.isdigit() for second, _ in moved)  # none by key, or by group for the scale
    assert sum("Union" in below for _, below in moved) == 1  # expected and observed read one exchange of contributions


def test_a_key_with_a_null_equals_none(spark):
    direct = spark.createDataFrame([(0, "a", "1", "Input", None, "DE", 2.0), (0, "a", "1", "Input", "kg", None, 3.0)], ROW)
    edges, lci = spark.createDataFrame([], "dependent_index long, balancing_index long, activity double"), spark.createDataFrame([], ROW)
    found = inventory.evidence(direct, edges, lci, direct.unionByName(direct.where("unit = 'kg'"))).first()
    assert (found.flow_count, found.failed_keys, found.max_absolute_difference) == (3, 3, 3.0)
