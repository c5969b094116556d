import base64
import hashlib
import struct

import pytest
import zstandard

from listweave.llm import warc as W

PAGES = "page_id long, url string, html string"


def test_record_round_trip():
    payload = "<p>é</p>".encode()
    r = W.parse_record(W.build_record(7, "http://x/\r\nEvil: 1", payload, len(payload), W.sha1_base32(payload), None))
    assert r.fields["warc-type"] == "response" and r.http[1] == payload and "\n" not in r.fields["warc-target-uri"] and "evil" not in r.fields


@pytest.mark.parametrize("change", [
    lambda d: d.replace(b"WARC/1.1", b"WARC/0.9"), lambda d: d[:-1], lambda d: d + b"x", lambda d: d.replace(b"WARC-Date:", b"WARC Date"),
    lambda d: d.replace(b"WARC-Type: response\r\n", b""), lambda d: d.replace(b"hello", b"jello"), lambda d: d.replace(b"WARC-Date", b"WARC-Type"),
])
def test_malformed_records_are_refused(change):
    good = W.build_record(1, "http://x/", b"hello", 5, W.sha1_base32(b"hello"), None)
    with pytest.raises(W.WarcError):
        W.parse_record(change(good))


def records(n):
    return [W.build_record(i, f"http://x/{i}", p, len(p), W.sha1_base32(p), None) for i in range(n) for p in [(f"<html><body>page {i} " + "common text " * 40).encode()]]


@pytest.mark.parametrize("n", [0, 1, 5, 300])
def test_archive_round_trip(n):
    data = W.write_archive(records(n))
    assert [r.fields["x-page-id"] for r in W.read_archive(data)] == [str(i) for i in range(n)]
    if n == 300:
        assert struct.unpack_from("<I", data)[0] == W.DICTIONARY_FRAME


def test_dictionary_may_be_stored_plain():
    rs = records(300)
    trained = W.train_dictionary(rs)
    engine = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(trained))
    data = struct.pack("<II", W.DICTIONARY_FRAME, len(trained)) + trained + b"".join(map(engine.compress, rs))
    assert len(list(W.read_archive(data))) == 300


def test_broken_archives_are_refused():
    data = W.write_archive(records(300))
    for bad in (data[:-3], data[:40], data[: len(data) // 2] + b"\0" + data[len(data) // 2 + 1 :]):
        with pytest.raises(W.WarcError):
            list(W.read_archive(bad))


def test_pages(spark):
    big = "<p>" + "long page " * 40_000 + "</p>"
    rows = [(1, "u1", "same"), (2, "u2", "same"), (9, None, "same"), (3, "u3", None), (4, "u4", ""), (5, "u5", big), (None, "u6", "same"), (None, None, None), (9, None, "same"), (6, "ü", "é")]
    got = W.round_trip(spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS payload", "2 AS sha1")).collect()
    assert len(got) == len(rows)
    html = {(i, u): h for i, u, h in rows}
    for r in got:
        data = (html[(r.page_id, r.url)] or "").encode()
        assert r.payload_bytes == len(data) and r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        if r.record_type == "response":
            assert bytes(r.payload) == data and r.refers_to is None
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in got if r.page_id}
    assert kinds[1] == ("revisit", 9) and kinds[2] == ("revisit", 9) and kinds[9] == ("response", None)
    assert kinds[3] == ("revisit", 4) and kinds[4] == ("response", None)
    assert {r.record_type for r in got if r.page_id is None} == {"response"}
    assert W.round_trip(spark.createDataFrame([], PAGES)).count() == 0
