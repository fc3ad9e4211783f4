import hashlib

import pytest
from pyspark.sql import functions as F

from ordermill.llm.warc import Archive, build_archive, read_archive

BIG = "<p>" + "é" * 600 + "</p>"
ROWS = [
    (1, "http://a.example/1", BIG), (2, "http://a.example/2", BIG), (9, None, BIG), (3, "http://a.example/x y\r\nz", "small"), (4, "u", "small"),
    (5, "u", None), (6, "u", ""), (7, "u", "line\r\n\r\nWARC/1.1\r\n"), (8, "u", "z" * 200_000), (8, "u", "z" * 200_000), (None, "u", "z" * 200_000), (None, "n", "n" * 2000),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*r, "x", 1) for r in ROWS], "page_id long, url string, html string, payload string, holder int")


def test_records_come_back(pages):
    got = read_archive(build_archive(pages)).collect()
    assert len(got) == len(ROWS)
    by = {(r["page_id"], r["payload_bytes"]): r for r in got}
    for page, _, html in ROWS:
        body = (html or "").encode()
        r = by[page, len(body)]
        assert bytes(r["payload"]) == body and r["payload_digest"] == hashlib.sha1(body).hexdigest()
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\n") and b"Content-Length: %d" % (len(rest) - 4) in head
        assert rest == (body if r["record_type"] == "response" else b"") + b"\r\n\r\n"


def test_revisits_refer_to_the_largest_page(pages):
    got = {(r["page_id"], r["payload_bytes"]): (r["record_type"], r["refers_to"]) for r in read_archive(build_archive(pages)).collect()}
    big = len(BIG.encode())
    assert got[1, big] == got[2, big] == ("revisit", 9) and got[9, big] == ("response", None)
    assert got[3, 5] == got[4, 5] == got[5, 0] == got[6, 0] == ("response", None)  # too small for a revisit
    assert got[8, 200_000] == ("response", None) and got[None, 200_000] == ("revisit", 8) and got[None, 2000] == ("response", None)


def test_each_payload_is_stored_once_and_verified(pages):
    archive = build_archive(pages)
    assert archive.payloads.count() == len({r[2] or "" for r in ROWS})
    broken = Archive(archive.headers, archive.payloads.withColumn("payload", F.concat("payload", F.lit(b"!"))))
    with pytest.raises(Exception, match="payload does not match"):
        read_archive(broken).select("payload_bytes").collect()


def test_empty_table(pages):
    assert read_archive(build_archive(pages.limit(0))).count() == 0
