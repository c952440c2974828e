"""The archive against SQL, a plain reader of WARC bytes, and damaged stores."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import data
import pytest
from oracle import compare, connect

from hazardlake.llm import archive, queries

PAGE = "<html>" + "a page of some length, " * 6
ROWS = [
    (5, "http://a/5", PAGE),
    (3, "http://a/3", PAGE),
    (3, "http://a/3", PAGE),
    (None, None, PAGE),
    (9, None, PAGE),
    (1, "http://a/1", "short"),
    (2, "http://a/2", "short"),
    (4, "http://a/4", None),
    (6, "http://a/6", ""),
    (7, "line\r\nWARC-Type: revisit", "ünïcödé \U0001f642" + "y" * 300_000),
    (8, "http://a/8", PAGE + "!"),
    (None, "x", "only nulls " * 20),
    (None, "y", "only nulls " * 20),
]
SCHEMA = "page_id long, url string, html string, " + ", ".join(f"`{c}` string" for c in ["digest", "row", "first", "kind", "warc"])
CLASHING = ("a", "b", "c", "d", "e")


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([r + CLASHING for r in ROWS], SCHEMA).repartition(3)


def plain(rows, least=100):
    groups = defaultdict(list)
    for i, _, html in rows:
        if i is not None:
            groups[html or ""].append(i)
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        first = min(groups[html or ""], default=None)
        again = len(body) >= least and first is not None and i != first
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first if again else None))
    return Counter(out)


def parsed(raw):
    """``(headers, block)`` of the records in the bytes of a WARC file."""
    while raw:
        head, rest = raw.split(b"\r\n\r\n", 1)
        version, *lines = head.decode().split("\r\n")
        assert version == "WARC/1.1"
        fields = dict(line.split(": ", 1) for line in lines)
        n = int(fields["Content-Length"])
        assert rest[n : n + 4] == b"\r\n\r\n"
        yield fields, rest[:n]
        raw = rest[n + 4 :]


def test_op13_equals_sql(spark):
    name = "op13_warc"
    assert compare(spark, connect(data.SF), name, queries.QUERIES[name], queries.ORACLES[name], data.SF) == ""


@pytest.mark.parametrize("bits", [64, 1 << 26])
def test_records_of_odd_rows(spark, pages, monkeypatch, bits):
    # with few bits every row is taken for a copy
    monkeypatch.setattr("hazardlake.llm.common.FILTER_BITS", bits)
    got = archive.archived(pages).collect()
    assert Counter((r.page_id, r.size, r.digest, r.kind, r.refers_to) for r in got) == plain(ROWS)
    assert all(r.row.asDict().keys() == set(pages.columns) - {"html"} for r in got)


def test_original_records_are_a_warc_file(spark, pages, folder):
    archive.write_archive(pages, f"{folder}/a")
    rows = archive.original_records(spark, f"{folder}/a").collect()
    file = b"".join(bytes(r.record) for r in rows)
    found = list(parsed(file))
    assert len(found) == len(ROWS)
    ids = {f["WARC-Record-ID"] for f, _ in found if f["WARC-Type"] == "response"}
    bodies = {}
    for fields, block in found:
        http, body = block.split(b"\r\n\r\n", 1)
        assert http.startswith(b"HTTP/1.1 200 OK")
        if fields["WARC-Type"] == "response":
            assert fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(body).hexdigest()
            bodies[fields["WARC-Payload-Digest"]] = body
        else:
            assert body == b"" and fields["WARC-Refers-To"] in ids and fields["WARC-Profile"] == archive.PROFILE
    assert {f["WARC-Payload-Digest"] for f, _ in found} == set(bodies)
    assert set(bodies.values()) == {(h or "").encode() for _, _, h in ROWS}
    stored = spark.read.parquet(f"{folder}/a/payloads")
    assert stored.count() == stored.select("digest").distinct().count() == len(bodies)


def test_large_groups_of_copies(spark):
    rows = [(k, f"u{k}", PAGE if k % 3 else f"{PAGE}{k}") for k in range(3000, 0, -1)]
    got = archive.archived(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()
    assert Counter((r.page_id, r.size, r.digest, r.kind, r.refers_to) for r in got) == plain(rows)


def test_damaged_payloads_are_found(spark, pages, folder):
    archive.write_archive(pages, f"{folder}/a")
    rows = spark.read.parquet(f"{folder}/a/payloads")
    rows.selectExpr("digest", "CAST(concat(CAST(payload AS STRING), 'x') AS BINARY) AS payload").write.parquet(f"{folder}/b/payloads")
    rows.limit(2).write.parquet(f"{folder}/c/payloads")
    records = spark.read.parquet(f"{folder}/a/records")
    for bad in ("b", "c"):
        records.write.parquet(f"{folder}/{bad}/records")
        for read in (archive.read_records, archive.original_records):
            with pytest.raises(Exception, match="damaged payload|no payload"):
                read(spark, f"{folder}/{bad}").collect()


def test_no_pages(spark, pages):
    assert archive.archived(pages.limit(0)).count() == 0
