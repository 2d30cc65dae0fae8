import base64
import gzip
import hashlib
import io

import pytest

from claimlake.llm import warc as W
from claimlake.llm.common import shared_path


@pytest.mark.parametrize("version", [1, 2])
def test_arc_round_trip(version):
    records = [("http://a.example/x", "20010203040506", "text/html", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\n<p>\n\nx</p>"), ("http://b.example/", "2002", "image/gif", b"GIF\x00\n\n"), ("dns:c", "20030101000000", "text/dns", b"")]
    got = list(W.read_arc(W.write_arc(records, version)))
    assert [r.version for r in got] == [version] * 4 and got[0].fields["url"] == "filedesc://archive.arc"
    assert [(r.fields["url"], r.fields["archive-date"], r.fields["content-type"], r.content) for r in got[1:]] == records
    assert len(got[1].fields) == len(W.ARC_FIELDS[version].split())
    warcs = [W.to_warc(r) for r in got]
    assert [w.headers["WARC-Type"] for w in warcs] == ["warcinfo", "response", "resource", "resource"]
    assert warcs[2].headers["WARC-Date"] == "2002-01-01T00:00:00Z"
    assert warcs[1].headers["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(b"<p>\n\nx</p>").digest()).decode()
    assert len({w.headers["WARC-Record-ID"] for w in warcs}) == 4
    assert warcs[1].headers["WARC-Record-ID"] == W.to_warc(got[1]).headers["WARC-Record-ID"]


def test_broken_archives_are_refused():
    good = W.write_arc([("http://a/", "2001", "text/html", b"abc")], 1)
    for bad in (good[:-1], good.replace(b" 3\nabc", b" x\nabc"), good + b"\nurl 0.0.0.0 2001 5\nabcde", good + b"\nno end"):
        with pytest.raises(ValueError):
            list(W.read_arc(bad))
    with pytest.raises(ValueError):
        list(W.read_warc(io.BytesIO(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc")))


def test_pages_to_archives_and_back(spark, monkeypatch):
    monkeypatch.setattr(W, "RECORDS_PER_FILE", 7)
    monkeypatch.setattr(W, "PAGES_PER_ARC", 3)
    html = ["<p>a</p>", None, "", "WARC/1.1\r\n\r\n\r\n\r\n", "é\r\n\r\nx", "<p>a</p>", "l" * 300_000, "<p>a</p>", "", "http HTTP/1.1"]
    pages = [(100 - i, None if i == 4 else f"http://x/{i} y z", html[i % len(html)]) for i in range(40)] + [(100, "http://again/", html[0])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS size").repartition(3)
    path = shared_path(spark, "warc-test")
    W.write_warcs(spark, W.page_arcs(df), path)
    rows = W.read_warcs(spark, path).collect()
    assert len(rows) == len(pages)
    least = {}
    for i, _, h in pages:
        least[h or ""] = min(i, least.get(h or "", i))
    by_id = {r["record_id"]: r for r in rows}
    for i, _, h in pages:
        own = [r for r in rows if r["page_id"] == i]
        for r in own:
            kinds = {x[2] or "" for x in pages if x[0] == i}
            if r["record_type"] == "revisit":
                first = by_id[r["refers_to"]]
                assert first["record_type"] == "response" and first["page_id"] < i and first["digest"] == r["digest"]
            else:
                assert any(r["digest"] == W.sha1_base32(k.encode()) and r["size"] == len(k.encode()) and least[k] == i for k in kinds)


def test_files_are_plain_gzipped_warc(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://x/", "<p>é</p>")], "page_id long, url string, html string")
    W.write_warcs(spark, W.page_arcs(df), str(tmp_path / "w"))
    data = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "w").glob("*.gz"))
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and data.endswith("<p>é</p>\r\n\r\n".encode())


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    path = shared_path(spark, "warc-test")
    W.write_warcs(spark, W.page_arcs(df), path)
    assert W.read_warcs(spark, path).count() == 0
