"""Operator 10: exact round trips, foreign archives, pushed predicates, the query."""

import gzip
import hashlib
import io

import pytest

from aerolake.llm import warc
from aerolake.llm.common import prepare

LONG = "<html>" + "long page " * 150 + "é</html>"
PAGES = [(1, "http://a/1", LONG), (2, "http://a/2", LONG), (9, None, LONG), (4, "http://b/4", "short"),
         (5, "http://b/5", "short"), (6, "http://b/6", None), (7, "http://b/7\r\nx: y", ""), (8, "http://b/8", "\r\n\r\nWARC/1.1\r\n"),
         (10, "u" * 9000, "x" * 300_000), (None, "http://c", LONG), (11, "http://d", LONG[:999]), (12, "http://d", LONG[:999]),
         (13, "http://é", "y" * 1000), (13, "http://é", "y" * 1000), (None, "http://n", "z" * 2000)]


def expected(pages):
    out = []
    for page_id, _, html in pages:
        raw = (html or "").encode()
        same = [p for p, _, h in pages if (h or "").encode() == raw and p is not None]
        holder = max(same, default=None) if len(raw) >= 1000 else page_id
        revisit = holder is not None and holder != page_id
        out.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response",
                    holder if revisit else None))
    return sorted(out, key=str)


@pytest.fixture()
def archive(spark, tmp_dir):
    prepare(spark)
    df = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, payload string").repartition(3)
    path = f"{tmp_dir}/archive"
    warc.write_warc(warc.plan_records(df), path)
    return path


def test_round_trip(spark, archive):
    rows = warc.read_warc(spark, archive).collect()
    got = sorted(((int(r.record_id.removeprefix(warc.ID_URN)) if r.record_id.startswith(warc.ID_URN) else None,
                   r.payload_bytes, r.payload_digest, r.record_type,
                   int(r.refers_to.removeprefix(warc.ID_URN)) if r.refers_to else None) for r in rows), key=str)
    assert got == expected(PAGES)
    texts = {p: (h or "").encode() for p, _, h in PAGES}
    for r in rows:
        assert (r.payload is None) == (r.record_type == "revisit")
        if r.payload is not None and r.record_id.startswith(warc.ID_URN):
            assert bytes(r.payload) == texts[int(r.record_id.removeprefix(warc.ID_URN))]
    assert {r.target_uri for r in rows} == {u and u.replace("\r", "%0D").replace("\n", "%0A") for _, u, _ in PAGES}


def test_pushed_predicates(spark, archive):
    frame = warc.read_warc(spark, archive).where("record_type = 'revisit'")
    assert {r.record_type for r in frame.collect()} == {"revisit"} and frame.count() == 3
    starts = warc.read_warc(spark, archive, payload=False).where("target_uri like 'http://b/%'")
    assert starts.count() == 5 and starts.where("payload is not null").count() == 0
    assert warc.read_warc(spark, archive).where("record_type in ('request', 'metadata')").count() == 0
    assert warc.read_warc(spark, archive).where("payload_bytes > 100000 and record_type = 'response'").count() == 1


def test_unwanted_payloads_are_not_inflated():
    raw = [warc.record_bytes("response", f"urn:{i}", f"http://{i}", "00" * 20, None, 200_000, bytes([65 + i]) * 200_000)
           for i in range(3)]
    members = [warc.gzip_member(r) for r in raw]
    # damage the inside of the second payload: whoever skips it does not notice
    body = bytearray(members[1])
    body[-12:-8] = b"\xff\xff\xff\xff"
    f = io.BufferedReader(io.BytesIO(members[0] + bytes(body) + members[2]))
    got = list(warc.records(f, lambda h: h["warc-target-uri"] != "http://1", True))
    assert [h["warc-target-uri"] for h, _, _ in got] == ["http://0", "http://2"]
    assert [len(p) for _, _, p in got] == [200_000, 200_000]
    f = io.BufferedReader(io.BytesIO(members[0] + bytes(body) + members[2]))
    assert [(s, p) for _, s, p in warc.records(f, lambda h: True, False)] == [(200_000, None)] * 3


def test_foreign_archives(spark, tmp_dir):
    raw = [warc.record_bytes("response", f"urn:{i}", f"http://{i}", "00" * 20, None, 5000, bytes([97 + i]) * 5000)
           for i in range(3)]
    raw.append(b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nX: a\r\n b\r\nContent-Length: 6\r\n\r\na: b\r\n\r\n\r\n")
    for name, data in (("plain.warc", b"".join(raw)), ("packed.warc.gz", b"".join(map(gzip.compress, raw)))):
        with open(f"{tmp_dir}/{name}", "wb") as f:
            f.write(data)
    rows = warc.read_warc(spark, f"file://{tmp_dir}").collect()
    assert len(rows) == 8
    assert sorted((r.record_type, r.payload_bytes, bytes(r.payload)[:6]) for r in rows) == sorted(
        [("response", 5000, bytes([97 + i]) * 6) for i in range(3)] * 2 + [("warcinfo", 6, b"a: b\r\n")] * 2)
    assert next(r for r in rows if r.record_type == "warcinfo").headers["x"] == "a b"
    skipped = warc.read_warc(spark, tmp_dir, payload=False).where("record_type = 'warcinfo'").collect()
    assert len(skipped) == 2
    with open(f"{tmp_dir}/cut.warc", "wb") as f:
        f.write(raw[0][:300])
    with pytest.raises(Exception):
        warc.read_warc(spark, tmp_dir).collect()


def test_overwrite_and_empty(spark, tmp_dir):
    prepare(spark)
    df = spark.createDataFrame(PAGES[:4], "page_id long, url string, html string")
    path = f"{tmp_dir}/a"
    warc.write_warc(warc.plan_records(df.limit(0)), path)
    assert warc.read_warc(spark, path).count() == 0
    for _ in range(2):
        warc.write_warc(warc.plan_records(df), path, "append")
    assert warc.read_warc(spark, path).count() == 8
    warc.write_warc(warc.plan_records(df), path, "overwrite")
    assert warc.read_warc(spark, path, partition_bytes=1).count() == 4


def test_query(spark):
    from aerolake.llm import queries

    sf = "/root/testdata/sf0.001"
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    out = sorted((tuple(r) for r in queries.op10_warc(spark, sf).collect()), key=str)
    assert out == expected(pages)
