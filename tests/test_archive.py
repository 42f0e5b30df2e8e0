"""Bundles from archives and folders: records, digests, and what is rejected with which code."""

import gzip
import hashlib
import json
import os
import stat
import zipfile

import pytest

from cindermill.sources import archive
from cindermill.sources.bundle import SCHEMAS
from cindermill.sources.files import Rejected


def lines(*rows):
    return "".join(json.dumps(r) + "\n" for r in rows).encode()


def content():
    lci = [{"processIndex": i % 7, "flow": {"id": f"f{i}", "version": "01.00.000"}, "direction": "Input", "unit": "kg", "meanAmount": i / 4} for i in range(5000)]
    return {
        "data/axis.ndjson": lines({"processIndex": 1, "rootProcess": {"id": "P", "version": "01.00.000"}, "quantitativeReference": {"exchangeInternalId": "3", "meanAmount": "2.5"}}, {"processIndex": 0}),
        "data/lci-2.ndjson.gz": gzip.compress(b"\n" + lines(*lci[:2000]) + b" \n" + lines(*lci[2000:])[:-1], mtime=0),
        "data/lci-1.ndjson.gz": gzip.compress(lines({"processIndex": 9, "meanAmount": 1}) + b"{broken\n", mtime=0),
        "data/sources.ndjson": lines({"datasetType": "process", "uuid": "P", "version": "01.00.000", "document": {"a": [1, {"b": "é"}]}}),
        "data/lcia.ndjson": b"", "data/bio.ndjson": b"\n\n", "data/edges.ndjson": lines({"dependentProcessIndex": 1, "activityRequirement": 0.5}),
    }


KINDS = {"axis": "process_axis", "lci-2": "lci", "lci-1": "lci", "sources": "source_closure", "lcia": "lcia", "bio": "biosphere_edges", "edges": "technosphere_edges"}


def manifest(files, change=lambda a: None):
    artifacts = []
    for path, data in files.items():
        gz = path.endswith(".gz")
        plain = gzip.decompress(data) if gz else data
        a = {"kind": KINDS[path.split("/")[1].split(".")[0]], "path": path, "sha256": hashlib.sha256(data).hexdigest(), "byteSize": len(data), "recordCount": plain.count(b"\n") + (plain[-1:] not in (b"", b"\n"))}
        if gz:
            a |= {"compression": "gzip", "uncompressedSha256": hashlib.sha256(plain).hexdigest(), "uncompressedByteSize": len(plain)}
        change(a)
        artifacts.append(a)
    text = json.dumps({"artifacts": artifacts, "bundleContentHash": "HASH", "calculationId": "c1", "schemaVersion": "bundle.v2"}, separators=(",", ":"))
    bare = text.replace('"bundleContentHash":"HASH",', "")
    return text.replace("HASH", hashlib.sha256(bare.encode()).hexdigest()).encode()


def bundle(tmp_path, form, folder="", change=lambda a: None, **more):
    files = content()
    every = {f"{folder}{k}": v for k, v in (files | {"calculation-bundle.json": manifest(files, change)} | more).items()}
    path = f"{tmp_path}/bundle"
    if form == "zip":
        path += ".zip"
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("empty/", b"")
            for k, v in every.items():
                z.writestr(k, v)
    else:
        for k, v in every.items():
            os.makedirs(os.path.dirname(f"{path}/{k}"), exist_ok=True)
            with open(f"{path}/{k}", "wb") as f:
                f.write(v)
    return path


@pytest.mark.parametrize("form,folder", [("zip", ""), ("zip", "inner/"), ("folder", ""), ("folder", "inner/")])
def test_a_bundle_reads_as_its_six_frames(spark, tmp_path, form, folder):
    m = archive.Intake(spark, bundle(tmp_path, form, folder), "bundle.v2", partBytes="1000")
    frames = m.frames()
    assert set(frames) == set(SCHEMAS)
    lci = frames["lci"]
    assert lci.where("_corrupt_record is null").count() == 5001 and lci.count() == 5002
    assert lci.rdd.getNumPartitions() == 2  # a member each
    assert [(r.line, r.processIndex, r.meanAmount) for r in lci.where("member like '%lci-2%'").orderBy("line").limit(2).collect()] == [(2, 0, "0.0"), (3, 1, "0.25")]
    assert lci.where("member like '%lci-2%'").agg({"line": "max"}).first()[0] == 5002
    assert lci.where("_corrupt_record is not null").collect()[0]._corrupt_record == "{broken"
    assert frames["process_axis"].orderBy("processIndex").collect()[1].quantitativeReference.meanAmount == "2.5"
    assert json.loads(frames["source_closure"].first().document) == {"a": [1, {"b": "é"}]}
    assert frames["lcia"].count() == 0 and frames["biosphere_edges"].count() == 0 and frames["technosphere_edges"].first().activityRequirement == "0.5"
    checked = m.verification().collect()
    assert len(checked) == 7 and {r.code for r in checked} == {None}
    documents = m.documents("intake.v1", "report.v1")
    intake = json.loads(documents["intake-manifest.json"])
    assert intake["source"]["manifestSha256"] == m.manifest_sha256 and [a["path"] for a in intake["artifacts"]] == [folder + p for p in content()]
    assert {a["path"]: a["recordCount"] for a in intake["artifacts"]}[folder + "data/lci-2.ndjson.gz"] == 5002


def test_members_are_spread_and_digested(spark, tmp_path):
    path = bundle(tmp_path, "zip")
    frame = archive.catalog(spark, path, partBytes="100")
    assert frame.rdd.getNumPartitions() >= 5
    rows = {r.member: r for r in frame.collect()}
    for name, data in content().items():
        plain = gzip.decompress(data) if name.endswith(".gz") else data
        assert (rows[name].byte_size, rows[name].sha256, rows[name].unpacked_sha256) == (len(data), hashlib.sha256(data).hexdigest(), hashlib.sha256(plain).hexdigest())
    assert rows["data/bio.ndjson"].records == 2 and rows["data/lcia.ndjson"].records == 0


CHANGES = {
    "artifact_integrity_mismatch": [lambda a: a.update(sha256="0" * 64), lambda a: a.update(byteSize=a["byteSize"] + 1), lambda a: a.pop("sha256")],
    "artifact_uncompressed_integrity_mismatch": [lambda a: a.update(recordCount=1), lambda a: a.update(uncompressedSha256="0" * 64), lambda a: a.update(uncompressedByteSize=3)],
    "artifact_missing": [lambda a: a.update(path="data/none.gz")],
}


@pytest.mark.parametrize("code,i", [(c, i) for c, changes in CHANGES.items() for i in range(len(changes))])
def test_what_the_manifest_says_is_checked(spark, tmp_path, code, i):
    m = archive.Intake(spark, bundle(tmp_path, "zip", change=lambda a: "lci-2" in a["path"] and CHANGES[code][i](a)))
    assert {r.code for r in m.verification().collect()} == {None, code}
    with pytest.raises(Rejected, match=code):
        m.documents("a", "b")


def test_a_damaged_gzip_is_a_mismatch_not_a_crash(spark, tmp_path):
    cut = content()["data/lci-2.ndjson.gz"][:-20]
    change = lambda a: "lci-2" in a["path"] and a.update(sha256=hashlib.sha256(cut).hexdigest(), byteSize=len(cut))
    m = archive.Intake(spark, bundle(tmp_path, "folder", change=change, **{"data/lci-2.ndjson.gz": cut}))
    assert [r.code for r in m.verification().where("code is not null").collect()] == ["artifact_uncompressed_integrity_mismatch"]


@pytest.mark.parametrize("path", ["/etc/passwd", "../x", "data/../../x", None, 7])
def test_unsafe_artifact_paths(spark, tmp_path, path):
    with pytest.raises(Rejected, match="unsafe_artifact_path"):
        archive.Intake(spark, bundle(tmp_path, "zip", change=lambda a: a.update(path=path)))


def zipped(tmp_path, *entries):
    path = f"{tmp_path}/x.zip"
    with zipfile.ZipFile(path, "w") as z:
        for e, data in entries:
            z.writestr(e, data)
    return path


@pytest.mark.parametrize("name", ["../x", "a/../../x", "/x", "c:x", "a\\..\\x"])
def test_slips_are_rejected(spark, tmp_path, name):
    path = zipped(tmp_path, (name, b"1"))
    with pytest.raises(Rejected, match="unsafe_bundle_path"):
        archive.Bundle(path).members()
    with pytest.raises(Exception, match="unsafe_bundle_path"):
        archive.catalog(spark, path).collect()


def test_caps(spark, tmp_path):
    path = zipped(tmp_path, *[(f"f{i}", b"123") for i in range(12)])
    assert archive.catalog(spark, path, maxEntries="12", maxBytes="36").count() == 12
    for option in ({"maxEntries": "11"}, {"maxBytes": "35"}):
        with pytest.raises(Exception, match="bundle_limits_exceeded"):
            archive.catalog(spark, path, **option).count()


def test_links_copies_and_what_is_no_archive(spark, tmp_path):
    link = zipfile.ZipInfo("link")
    link.external_attr = (stat.S_IFLNK | 0o777) << 16
    with pytest.raises(Rejected, match="bundle_symlink_rejected"):
        archive.Bundle(zipped(tmp_path, (link, b"/etc/passwd"))).members()
    folder = bundle(tmp_path, "folder")
    os.symlink("/etc", f"{folder}/data/etc")
    with pytest.raises(Rejected, match="bundle_symlink_rejected"):
        archive.Bundle(folder).members()
    with pytest.warns(UserWarning), pytest.raises(Rejected, match="bundle_entry_exists"):
        archive.Bundle(zipped(tmp_path, ("a", b"1"), ("a", b"2"))).members()
    with open(f"{tmp_path}/no.zip", "wb") as f:
        f.write(b"not an archive")
    with pytest.raises(Rejected, match="bundle_archive_invalid"):
        archive.Bundle(f"{tmp_path}/no.zip").members()
    with pytest.raises(Rejected, match="bundle_not_found"):
        archive.Bundle(f"{tmp_path}/nothing")


def test_manifests(spark, tmp_path):
    with pytest.raises(Rejected, match="bundle_manifest_not_found"):
        archive.Intake(spark, zipped(tmp_path, ("a/calculation-bundle.json", b"{}"), ("b/calculation-bundle.json", b"{}")))
    with pytest.raises(Rejected, match="bundle_manifest_not_found"):
        archive.Intake(spark, zipped(tmp_path, ("a/b/calculation-bundle.json", b"{}")))
    for text in (b"{", b"[]", b"{}", b'{"artifacts":[],"bundleContentHash":"x"}'):
        with pytest.raises(Rejected, match="unsupported_bundle"):
            archive.Intake(spark, zipped(tmp_path, ("calculation-bundle.json", text)))
    good = manifest({})
    assert archive.Intake(spark, zipped(tmp_path, ("calculation-bundle.json", good)), "bundle.v2").verification().count() == 0
    with pytest.raises(Rejected, match="unsupported_bundle"):
        archive.Intake(spark, zipped(tmp_path, ("calculation-bundle.json", good)), "bundle.v3")
    with pytest.raises(Rejected, match="bundle_content_hash_mismatch"):
        archive.Intake(spark, zipped(tmp_path, ("calculation-bundle.json", good.replace(b"c1", b"c2"))))
    with pytest.raises(Rejected, match="bundle_content_hash_field_invalid"):
        archive.Intake(spark, zipped(tmp_path, ("calculation-bundle.json", good.replace(b'"bundleContentHash":', b'"bundleContentHash": '))))
