import base64
import glob
import gzip
import hashlib

from caskline.llm import warc


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string, n int, payload string")


ROWS = [(i, u, h, "d", 1, "p") for i, u, h in [
    (1, "http://a/", "same"), (7, None, "same"), (7, "http://b/\r\nx", "same"), (3, "http://c/", None), (4, "http://c/", ""),
    (None, "http://d/", "same"), (9, "http://e/", "<p>é 漢\r\n\r\nWARC/1.1</p>"), (10, "http://f/", "x" * 3_000_000), (None, "u", "alone"),
]]


def test_round_trip_and_revisits(spark, tmp_path):
    got = warc.archive_pages(pages(spark, ROWS), folder=str(tmp_path)).collect()
    assert len(got) == len(ROWS)
    text = {i: (h or "").encode() for i, _, h, *_ in ROWS if i is not None}
    for r in got:
        if r.id is not None:
            digest = base64.b32encode(hashlib.sha1(text[r.id]).digest()).decode()
            assert (r.payload_bytes, r.payload_digest) == (len(text[r.id]), digest)
            assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == text[r.id]
    kinds = sorted((r.id or 0, r.record_type, r.refers_to) for r in got)
    assert kinds == [(0, "response", None), (0, "revisit", 7), (1, "revisit", 7), (3, "revisit", 4), (4, "response", None),
                     (7, "response", None), (7, "response", None), (9, "response", None), (10, "response", None)]


def test_archives_are_normalised(spark, tmp_path):
    warc.archive_pages(pages(spark, ROWS), folder=str(tmp_path)).count()
    for path in glob.glob(f"{tmp_path}/raw/*.gz"):
        whole = gzip.open(path).read()
        target = path.replace("/raw/", "/records/")
        data = open(target, "rb").read()
        assert gzip.decompress(data) == whole
        at, pieces = 0, b""
        for line in open(f"{target}.idx"):
            offset, length, key, kind = line.split()
            assert int(offset) == at
            record = gzip.decompress(data[at : at + int(length)])
            assert record.startswith(b"WARC/1.1\r\n") and f"<urn:page:{key}>".encode() in record and kind.encode() in record
            at, pieces = at + int(length), pieces + record
        assert at == len(data) and pieces == whole


def test_small_payloads_answer_each(spark):
    got = warc.archive_pages(pages(spark, [(1, "u", "ab", "", 0, ""), (2, "u", "ab", "", 0, "")]), least_bytes=3).collect()
    assert {r.record_type for r in got} == {"response"}


def test_members_of_a_many_member_file_are_read(tmp_path):
    head = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    path = tmp_path / "x.gz"
    path.write_bytes(gzip.compress(head % 1 + head % 2) + gzip.compress(head % 3))
    stream = warc._Inflated(open(path, "rb"))
    keys = []
    for fields, _, n in warc._records(stream):
        assert b"".join(stream.take(n)) == b"abc"
        keys.append(fields["warc-record-id"])
    assert keys == ["<urn:page:1>", "<urn:page:2>", "<urn:page:3>"]


def test_no_pages(spark):
    assert warc.archive_pages(pages(spark, [])).count() == 0


def test_records_are_passed_on_by_bytes(spark, monkeypatch):
    pages = spark.createDataFrame([(k, f"http://a/{k}", f"{k} " * (50 + 400 * (k % 7))) for k in range(60)], "page_id long, url string, html string")
    columns = ["id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    rows = lambda: sorted(map(tuple, warc.archive_pages(pages).select(*columns).collect()))
    want = rows()
    for limit in (1, 5000):
        monkeypatch.setattr(warc, "READ_BYTES", limit)
        assert rows() == want and len(want) == 60
