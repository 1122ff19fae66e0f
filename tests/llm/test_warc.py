import io
import zlib

import pytest

from panelscope.llm import warc as W

SCHEMA = "page_id long, url string, html string, payload string"


def pages(spark):
    return spark.createDataFrame([
        (5, "http://a/", "<p>same</p>", "x"), (2, "http://b/", "<p>same</p>", "x"), (9, None, "é ü \r\n\r\n end", "x"),
        (3, "http://c/\r\nx", None, "x"), (4, "http://d/", "", "x"), (None, "http://e/", "<p>same</p>", "x"),
        (7, "http://f/", "y" * 300_000, "x"), (2, "http://b/", "<p>same</p>", "x")], SCHEMA).coalesce(1)


def test_round_trip_with_revisits(spark):
    got = sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in W.archive_pages(pages(spark)).collect()), key=str)
    same = len("<p>same</p>")
    assert got == sorted([(2, "response", None, same), (2, "revisit", 2, same), (5, "revisit", 2, same), (None, "revisit", 2, same),
                          (9, "response", None, len("é ü \r\n\r\n end".encode())), (3, "response", None, 0), (4, "revisit", 3, 0),
                          (7, "response", None, 300_000)], key=str)


def test_small_payloads_are_all_responses(spark):
    got = [r["record_type"] for r in W.archive_pages(pages(spark), min_bytes=100).collect()]
    assert got == ["response"] * 8


def test_payloads_come_back(spark, tmp_path):
    rows = W.write_warc(W.deduplicate(pages(spark)), f"file://{tmp_path}/w").collect()
    assert sum(r["n_records"] for r in rows) == 8
    back = {r["page_id"]: r for r in W.read_warc(spark, [r["archive"] for r in rows]).collect() if r["record_type"] == "response"}
    assert bytes(back[9]["payload"]).decode() == "é ü \r\n\r\n end"
    assert back[3]["url"] == "http://c/ x" and back[9]["url"] == "about:blank"
    assert W.base32_sha1(bytes(back[7]["payload"])) == back[7]["payload_digest"]


def test_empty(spark):
    assert W.archive_pages(pages(spark).limit(0)).collect() == []


def test_each_record_is_one_gzip_member_and_damage_is_found():
    records = [W.record_bytes(i, "http://x/", b"p" * i) for i in (0, 5, 70_000)]
    archive = b"".join(map(W.gzip_member, records))
    assert list(W.members(io.BytesIO(archive), block=7)) == records
    assert zlib.decompress(W.gzip_member(records[0]), 31) == records[0]
    with pytest.raises(EOFError):
        list(W.members(io.BytesIO(archive[:-3])))
    with pytest.raises(ValueError, match="framed"):
        W.parse_record(records[1][:-1])
    with pytest.raises(ValueError, match="digest"):
        W.parse_record(records[1].replace(b"ppppp", b"ppqpp"))
    with pytest.raises(ValueError, match="not a WARC"):
        W.parse_record(b"HTTP/1.1 200 OK\r\n\r\n")
