import hashlib

import duckdb

from wayforge.llm.queries import ORACLE_SQL
from wayforge.llm.warc import gzip_member, mark_revisits, op7_warc, pages_read, read_warc, salvage, write_warc


def record(i, payload, digest=True):
    body = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    mark = f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}\r\n".encode() if digest else b""
    return b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\n%sContent-Length: %d\r\n\r\n" % (i, mark, len(body)) + body + b"\r\n\r\n"


def kinds(data):
    return [(k, (w["warc-record-id"] if k == "record" else (s, e))) for k, s, e, w, _ in salvage(data)]


def names(*ids):
    return [("record", f"<urn:page:{i}>") for i in ids]


def test_plain_members_and_mixed():
    a, b, c = (record(i, b"payload %d" % i) for i in range(3))
    assert kinds(a + b + c) == kinds(gzip_member(a) + gzip_member(b) + c) == kinds(gzip_member(a + b + c)) == names(0, 1, 2)
    assert kinds(b"") == []


def test_damage_is_quarantined_and_later_records_survive():
    a, b, c = (record(i, b"payload %d" % i * 20) for i in range(3))
    bad = b.replace(b"payload", b"paYload", 1)
    assert kinds(a + bad + c) == [*names(0), ("gap", (len(a), len(a + b))), *names(2)]
    short = b[:-30]
    assert kinds(a + short + c) == [*names(0), ("gap", (len(a), len(a + short))), *names(2)]
    assert kinds(b"junk" + a) == [("gap", (0, 4)), *names(0)]
    assert kinds(a + b[:50]) == [*names(0), ("gap", (len(a), len(a) + 50))]
    wrong = b.replace(b"Content-Length: ", b"Content-Length: 9")
    assert kinds(a + wrong + c) == [*names(0), ("gap", (len(a), len(a + wrong))), *names(2)]


def test_damaged_member_and_member_cut_off():
    a, b, c = (gzip_member(record(i, b"payload %d" % i * 50)) for i in range(3))
    bad = bytearray(b)
    bad[len(b) // 2] ^= 0x55
    assert kinds(a + bytes(bad) + c) == [*names(0), ("gap", (len(a), len(a + b))), *names(2)]
    assert kinds(a + b[: len(b) // 2]) == [*names(0), ("gap", (len(a), len(a) + len(b) // 2))]


def test_a_header_of_any_length_is_read(spark, tmp_path):
    pages = spark.createDataFrame([(1, "data:" + "x" * 200_000, "<html>" * 40), (2, "u", "<html>" * 40)], "page_id long, url string, html string")
    write_warc(mark_revisits(pages), str(tmp_path / "long"))
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in pages_read(read_warc(spark, str(tmp_path / "long"))).collect()), key=str)
    assert got == [(1, "response", None), (2, "revisit", 1)]


def test_a_version_line_inside_a_payload_is_payload():
    inner = record(7, b"inner")
    assert kinds(record(1, b"x" + inner + b"y")) == names(1)


def test_all_bytes_are_accounted_for():
    import random

    data = b"".join(record(i, bytes([65 + i]) * 300) for i in range(20))
    rng = random.Random(1)
    for _ in range(30):
        broken = bytearray(data)
        for _ in range(5):
            broken[rng.randrange(len(broken))] = rng.randrange(256)
        spans = [(s, e) for _, s, e, _, _ in salvage(bytes(broken))]
        assert spans[0][0] == 0 and spans[-1][1] == len(data) and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))


def test_round_trip_of_odd_pages(spark, tmp_path):
    long_page = "é" * 200_000
    rows = [(3, "u", "p" * 100), (1, "u\r\nx: y", "p" * 100), (2, None, "p" * 99), (4, "u", "p" * 99), (5, "u", None), (6, "u", ""), (7, "u", long_page), (7, "u", long_page), (8, "u", long_page), (9, "u", "\r\n\r\nWARC/1.1\r\n")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, record_type string")
    write_warc(mark_revisits(pages), str(tmp_path / "w"))
    got = {(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in pages_read(read_warc(spark, str(tmp_path / "w"))).collect()}
    assert got == {(3, 100, "revisit", 1), (1, 100, "response", None), (2, 99, "response", None), (4, 99, "response", None), (5, 0, "response", None), (6, 0, "response", None), (7, 400_000, "response", None), (8, 400_000, "revisit", 7), (9, 14, "response", None)}
    texts = {r.payload.decode() for r in read_warc(spark, str(tmp_path / "w")).where("kind = 'record'").collect()}
    assert {"p" * 99, "p" * 100, long_page, "\r\n\r\nWARC/1.1\r\n"} <= texts
    write_warc(mark_revisits(pages.limit(0)), str(tmp_path / "e"))
    assert read_warc(spark, str(tmp_path / "e")).count() == 0


def test_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    r = con.execute(ORACLE_SQL["op7_warc"])
    names_ = [c[0] for c in r.description]
    assert sorted(map(str, r.fetchall())) == sorted(str(tuple(x[n] for n in names_)) for x in op7_warc(spark, sf_dir).collect())
