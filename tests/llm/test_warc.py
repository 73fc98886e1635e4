import hashlib

import pytest

from trackloom.llm import warc
from trackloom.llm.op3 import archive_pages, http_block, made_date


def arc(version, *records):
    out = warc.arc_filedesc(version, "x.arc") + b"\n"
    for url, date, body in records:
        out += warc.arc_line(version, url, date, "text/html", len(body)).encode() + b"\n" + body + b"\n"
    return out


@pytest.mark.parametrize("version", [1, 2])
def test_arc_is_read_by_declared_lengths(version):
    bodies = [b"", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n<p>\n\nhttp://not.a.header 1 2 3 4\n", bytes(range(256))]
    data = arc(version, *((f"http://h/{i} with space", "20010203040506", b) for i, b in enumerate(bodies)))
    found = list(warc.read_arc(data))
    assert [r.block for r in found] == bodies
    assert found[0].fields["url"] == "http://h/0 with space" and found[0].fields["version"] == str(version)


def test_bad_archives_are_errors():
    with pytest.raises(ValueError):
        list(warc.read_arc(arc(1, ("u", "2001", b"abc"))[:-3]))
    with pytest.raises(ValueError):
        list(warc.read_arc(b"no header here\n"))
    with pytest.raises(ValueError):
        list(warc.read_warc(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort"))


@pytest.mark.parametrize("date,want", [("20010203040506", "2001-02-03T04:05:06Z"), ("2001", "2001-01-01T00:00:00Z"), ("200102", "2001-02-01T00:00:00Z"), ("20010203", "2001-02-03T00:00:00Z"), ("", "1970-01-01T00:00:00Z"), ("20019999000000", "1970-01-01T00:00:00Z"), ("200102030405069", "2001-02-03T04:05:06Z")])
def test_dates(date, want):
    assert warc.w3c_date(date) == want


def test_conversion_synthesises_fields_and_round_trips():
    (old,) = warc.read_arc(arc(1, ("http://h/", "20010203040506", http_block("<p>ä</p>".encode(), 7))))
    new = warc.convert(old)
    assert new.fields["WARC-Type"] == "response" and new.fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256("<p>ä</p>".encode()).hexdigest()
    assert warc.convert(old).fields["WARC-Record-ID"] == new.fields["WARC-Record-ID"]
    (back,) = warc.read_warc(warc.warc_bytes(new) + warc.END)
    assert back.block == old.block and back.fields["WARC-Target-URI"] == "http://h/"
    second = warc.revisit(new, new.fields["WARC-Record-ID"])
    assert second.fields["WARC-Type"] == "revisit" and second.http()[1] == b""
    assert warc.convert(warc.Record({"date": "", "url": "dns:h", "address": "-", "type": "text/dns"}, b"x")).fields["WARC-Type"] == "resource"


def test_pages(spark, tmp_path):
    long = "ü" * 60
    rows = [(5, "u", long), (3, "u", long), (9, None, long), (1, "u", "short"), (2, "u", "short"), (4, " ", None), (6, "a b\nc", "\r\n\r\nWARC/1.1\r\n" * 9), (7, "u", "\r\n\r\nWARC/1.1\r\n" * 9), (None, "u", long), (3, "u", long), (11, "u", "x" * 300_000)]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id bigint, url string, html string, digest string")
    out = archive_pages(pages, str(tmp_path)).collect()
    assert len(out) == len(rows)
    payload = {p: (h or "").encode() for p, _, h in rows}
    first = {}
    for p, b in payload.items():
        if p is not None:
            first[b] = min(p, first.get(b, p))
    for r in out:
        b = payload[r["page_id"]]
        again = len(b) >= 100 and r["page_id"] != first[b]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(b), hashlib.sha256(b).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (("revisit", first[b]) if again else ("response", None))


    ids = {r["record_id"]: r for r in out}
    assert len(ids) == len(rows)  # also of repeated rows, and of revisits beside what they refer to
    for r in out:
        assert r["warc_date"].replace("-", "").replace("T", "").replace(":", "").rstrip("Z") == made_date(r["page_id"])
        if r["record_type"] == "revisit":
            assert ids[r["refers_to_record"]]["page_id"] == r["refers_to"] and ids[r["refers_to_record"]]["record_type"] == "response"
    assert len({r["warc_date"] for r in out}) > 5


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_pieces_of_any_size_read_alike(size):
    bodies = [b"", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n\r\n\r\nx\r\n\r\n", b"plain\r\n\r\n", bytes(range(256)), b"\r\n\r\n" * 3]
    data = arc(1, *((f"http://h/{i}", "20010203040506", b) for i, b in enumerate(bodies)))
    found = list(warc.read_arc(data.split(warc.END), "f"))
    assert [r.block for r in found] == bodies and [r.place for r in found] == [r.place for r in warc.read_arc(data, "f")]
    assert all(data[int(r.place.split(":")[1]) :].startswith(r.fields["url"].encode()) for r in found)
    new = b"".join(warc.warc_bytes(warc.convert(r)) + warc.END for r in found * size)
    assert [r.block for r in warc.read_warc(new.split(warc.END)[:-1])] == bodies * size
    # a file that ends with END, which the reader takes for a separator
    last = arc(2, ("http://h/", "2001", b"a\r\n\r\n"))[:-1]
    assert [r.block for r in warc.read_arc(last.split(warc.END)[:-1])] == [b"a\r\n\r\n"]


def test_no_pages(spark, tmp_path):
    assert archive_pages(spark.createDataFrame([], "page_id bigint, url string, html string"), str(tmp_path)).count() == 0
