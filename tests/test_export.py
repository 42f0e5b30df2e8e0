"""Artifacts of a written bundle: packed line by line, of a bounded size, and dealt finely enough when they are read."""

import gzip
import hashlib
import io
from contextlib import redirect_stdout

from cindermill.sources import archive, export


def test_artifacts_are_packed_as_their_lines_come_and_end_at_their_size(spark):
    made = export.artifacts("lci", spark.range(1000).repartition(3), 70)
    out = io.StringIO()
    with redirect_stdout(out):
        made.explain()
    assert "collect_list" not in out.getvalue()  # no artifact's text is gathered
    rows, lines = made.collect(), []
    for r in rows:
        text = gzip.decompress(r.content)
        assert r.recordCount == text.count(b"\n") <= 70 and r.kind == "lci" and r.content[4:8] == b"\0" * 4  # no time in it
        assert (r.uncompressedByteSize, r.uncompressedSha256) == (len(text), hashlib.sha256(text).hexdigest())
        assert text.splitlines() == sorted(text.splitlines())
        lines += text.decode().splitlines()
    assert sorted(lines) == sorted(f'{{"id":{i}}}' for i in range(1000)) and len({r.path for r in rows}) == len(rows)
    assert export.artifacts("lci", spark.range(0)).count() == 0


def test_what_a_gzipped_member_unpacks_to_is_dealt():
    members = [archive.Member(f"{i}.ndjson.gz", 30) for i in range(4)]
    assert len(archive.dealt(members, 1000)) == 2 and len(archive.dealt([archive.Member("a", 30)] * 4, 1000)) == 1
