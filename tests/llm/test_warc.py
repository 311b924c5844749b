"""WARC round trips, and broken archives."""

import base64
import hashlib
import io
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from conftest import SF  # noqa: E402
from oracle import same  # noqa: E402

from textloom.llm import queries, warc  # noqa: E402


def test_round_trip(spark):
    html = ["", None, "a\r\n\r\nWARC/1.1\r\n", "é" * 9000, "x" * 50_000, "x" * 50_000, "plain", "plain", "plain", "0\r\n\r\n", "𝄞" * 5000]
    rows = [(i * 3, f"http://h/{i}\n" if i % 2 else None, h, "clash") for i, h in enumerate(html)] + [(6, "http://again", "a\r\n\r\nWARC/1.1\r\n", "clash")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")
    got = sorted((r.key, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, bytes(r.payload) if r.payload is not None else None, r.n_segments) for r in warc.round_trip(df).collect())
    first = {}
    for key, _, h, _ in sorted(rows, key=lambda r: r[0]):
        first.setdefault(h or "", key)
    assert len(got) == len(rows)
    for (key, kind, refers, size, digest, payload, n), (want, _, h, _) in zip(got, sorted(rows, key=lambda r: r[0]), strict=True):
        raw = (h or "").encode()
        assert key == want and size == len(raw) and digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        assert (kind, refers) == (("response", None) if first[h or ""] == key else ("revisit", first[h or ""]))
        assert payload == (raw if kind == "response" else None)
        assert (n > 1) == (kind == "response" and len(raw) > 16_000)
    assert warc.round_trip(df.limit(0)).collect() == []
    assert {r.record_type for r in warc.round_trip(df, min_revisit_bytes=10**6).collect()} == {"response"}


def test_broken(spark):
    assert warc.unchunked(b"3;x=1\r\nabc\r\n0\r\n\r\n") == b"abc"
    for bad in (b"3\r\nab", b"5\r\nabc\r\n0\r\n\r\n", b""):
        with pytest.raises(ValueError):
            warc.unchunked(bad)
    with pytest.raises(ValueError):
        list(warc.parsed(io.BytesIO(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n")))


def record(block, **head):
    lines = [f"{k.replace('_', '-')}: {v}" for k, v in head.items()]
    return ("WARC/1.0\r\n" + "\r\n".join([*lines, f"Content-Length: {len(block)}"]) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def test_foreign_archives_and_rejects(spark, tmp_path):
    """Records of other writers: any type and identifier, plain or gzip, a member a record; broken ones keep a row each."""
    http = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nabc\r\n0\r\n\r\n"
    good = [
        record(b"software: x", WARC_Type="warcinfo", WARC_Record_ID="<urn:uuid:1>", Content_Type="application/warc-fields"),
        record(http, WARC_Type="response", WARC_Record_ID="<urn:uuid:2>", WARC_Target_URI="http://a", Content_Type="application/http; msgtype=response"),
        record(b"raw", WARC_Type="resource", WARC_Record_ID="<urn:uuid:3>", WARC_Payload_Digest="md5:zz", Content_Type="text/plain"),
        record(http[:60], WARC_Type="response", WARC_Record_ID="<urn:uuid:4>", Content_Type="application/http", WARC_Segment_Number="1"),
        record(http[60:], WARC_Type="continuation", WARC_Record_ID="<urn:uuid:5>", WARC_Segment_Origin_ID="<urn:uuid:4>", WARC_Segment_Number="2", WARC_Segment_Total_Length=str(len(http))),
    ]
    bad = [
        record(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n9\r\nabc", WARC_Type="response", WARC_Record_ID="<urn:uuid:6>", Content_Type="application/http"),
        record(b"raw", WARC_Type="resource", WARC_Record_ID="<urn:uuid:7>", WARC_Payload_Digest="sha1:AAAA"),
        record(b"part", WARC_Type="continuation", WARC_Record_ID="<urn:uuid:9>", WARC_Segment_Origin_ID="<urn:uuid:8>", WARC_Segment_Number="2", WARC_Segment_Total_Length="4"),
        b"garbage\r\n",
    ]
    import gzip

    (tmp_path / "a.warc").write_bytes(b"".join(good).replace(b"urn:uuid:", b"urn:else:"))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in good + bad))
    rows = warc.read_archives(spark, f"file://{tmp_path}").collect()
    assert sorted((r.record_type, bytes(r.payload), r.n_segments) for r in rows if r.error is None) == sorted([("warcinfo", b"software: x", 1), ("response", b"abc", 1), ("resource", b"raw", 1), ("response", b"abc", 2)] * 2)
    wrong = {r.record_id: r.error for r in rows if r.error is not None}
    assert len(wrong) == 4 and {"<urn:uuid:6>", "<urn:uuid:7>", None} < set(wrong) and all(r.payload is None for r in rows if r.error)
    assert "digest" in wrong["<urn:uuid:7>"] and any("segments" in e for e in wrong.values())


def test_null_and_text_keys(spark):
    rows = [(None, "same"), ("b", "same"), ("a", "same"), (None, "only"), ("x\ny", "z" * 40_000)]
    df = spark.createDataFrame([(k, "http://h", h) for k, h in rows], "page_id string, url string, html string")
    got = sorted(((r.key, r.record_type, r.refers_to, r.payload_bytes) for r in warc.round_trip(df).collect()), key=repr)
    assert got == sorted([(None, "response", None, 4), ("b", "revisit", "a", 4), ("a", "response", None, 4), (None, "response", None, 4), ("x%0Ay", "response", None, 40_000)], key=repr)
    df = spark.createDataFrame([(None, "u", "same"), (4, "u", "same")], "page_id long, url string, html string")
    assert sorted(((r.key, r.record_type) for r in warc.round_trip(df).collect()), key=repr) == sorted([(None, "response"), (4, "response")], key=repr)


def test_sql(spark):
    q = queries.REGISTRY.entries["op8_warc"]
    assert same(spark, q.build, q.sql, SF) == 250
