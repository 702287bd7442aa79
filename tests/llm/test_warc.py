import gzip
import hashlib

import pytest

from wordspace.llm import warc

PAGES = "page_id long, url string, html string, digest string"
BIG = "<p>" + "x" * 1200 + "</p>"


def expected(rows):
    best = {}
    for k, _, h, _ in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and k is not None:
            best[b] = max(best.get(b, k), k)
    out = []
    for k, _, h, _ in rows:
        b = (h or "").encode()
        again = len(b) >= 1000 and best.get(b) is not None and best[b] != k
        out.append((k, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", best[b] if again else None))
    return sorted(out, key=repr)


def test_round_trip_with_revisits_nulls_and_odd_payloads(ready):
    rows = [
        (1, "http://a/1", BIG, "x"), (2, "http://a/2", BIG, "x"), (9, None, BIG, "x"), (3, "http://a/ b\n", "small", "x"), (4, "http://a/4", "small", "x"),
        (5, "http://a/5", None, "x"), (6, "http://a/6", "", "x"), (7, "http://a/7", "é\r\n\r\nWARC/1.1\r\n\r\n" * 90, "x"),
        (8, "", "line\nhttp://x 0.0.0.0 20240101000000 text/html 5\n" * 40, "x"), (None, "http://a/n", "tiny", "x"),
    ]
    df = ready.createDataFrame(rows, PAGES).repartition(3)
    got = [tuple(r) for r in warc.archive_pages(ready, df).collect()]
    assert sorted(got, key=repr) == expected(rows)


def test_repeated_rows_and_empty_table(ready):
    rows = [(1, "u", BIG, "x"), (1, "u", BIG, "x")]
    got = sorted(r.record_type for r in warc.archive_pages(ready, ready.createDataFrame(rows, PAGES)).collect())
    assert got == ["response", "revisit"]
    assert warc.archive_pages(ready, ready.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions_and_conversion(version):
    record = warc.arc_record(version, 7, "http://x/y z", b"<p>hi</p>", "20010203040506")
    content = gzip.compress(warc.arc_header(version, "20010101000000") + b"\n" + record + b"\n")
    records = list(warc.arc_records(content))
    assert [r[1]["URL"] for r in records] == ["filedesc://pages.arc", "http://x/y%20z"]
    assert records[0][1]["version"] == version
    at, head, body = records[1]
    out = warc.convert_record("f.arc.gz", at, head, body, None) + b"\r\n\r\n"
    (fields, block), = warc.warc_records(out)
    assert fields["warc-type"] == "response" and fields["warc-date"] == "2001-02-03T04:05:06Z"
    assert warc.split_http(block)[1] == b"<p>hi</p>"
    again = warc.convert_record("f.arc.gz", at, head, body, ("urn:uuid:1", "http://o"))
    (fields, block), = warc.warc_records(again + b"\r\n\r\n")
    assert fields["warc-type"] == "revisit" and fields["warc-refers-to"] == "<urn:uuid:1>" and warc.split_http(block)[1] == b""


def test_other_records_and_wrong_lengths():
    dns = b"dns:x 1.2.3.4 20010203 text/dns 3\nabc\n"
    (at, head, body), = warc.arc_records(dns)
    (fields, block), = warc.warc_records(warc.convert_record("f", at, head, body, None) + b"\r\n\r\n")
    assert fields["warc-type"] == "resource" and fields["warc-date"] == "2001-02-03T00:00:00Z" and block == b"abc"
    with pytest.raises(ValueError):
        list(warc.arc_records(b"http://x 0.0.0.0 20010203040506 text/html 2\nabc\n"))
