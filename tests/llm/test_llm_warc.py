import base64
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from matchlab.llm.warc import Damaged, inflate, read_archives, record, salvage, sha1_base32, unit, write_archives
from matchlab.session import scratch_path

SCHEMA = "page_id bigint, url string, html string, size string, refers string, first string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA).repartition(3)


ROWS = [(5, "http://a/ ü\r\nx", "<p>one</p>"), (3, "http://b", "<p>one</p>"), (9, None, "<p>one</p>"), (1, "http://c", None), (2, "http://d", ""),
        (7, "http://e", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\x1f" + "x\r\n\r\n" * 50), (8, "http://f", "字" * 40000), (None, "http://g", "<p>one</p>"), (None, None, None)]


def round_trip(spark, df, **more):
    path = scratch_path(spark, "warc-test")
    write_archives(df, path, **more)
    return path, read_archives(spark, path, with_payload=True)


def test_round_trip(spark):
    _, back = round_trip(spark, pages(spark, ROWS))
    rows = back.collect()
    assert not [r for r in rows if r.gap] and len(rows) == len(ROWS)
    got = {int(r.record_id): r for r in rows if r.record_id}
    for i, url, html in ROWS:
        if i is not None:
            data = (html or "").encode()
            digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
            first = min(j for j, _, h in ROWS if j is not None and (h or "") == (html or ""))
            r = got[i]
            assert (r.payload_bytes, r.payload_digest) == (len(data), digest)
            assert (r.record_type, r.refers_to) == (("response", None) if first == i else ("revisit", str(first)))
            if first == i:
                assert bytes(r.payload) == data
    assert [r.record_type for r in rows if not r.record_id] == ["response"] * 2


def test_small_payloads_are_responses(spark):
    _, back = round_trip(spark, pages(spark, ROWS), least_bytes=11)
    assert {r.record_type for r in back.collect()} == {"response"}


def test_archives_are_gzip_members(spark):
    path, _ = round_trip(spark, pages(spark, ROWS))
    for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect():
        data, at = bytes(r.content), 0
        while at < len(data):
            member, at = inflate(data, at)
            assert member.startswith(b"WARC/1.1\r\n") and member.endswith(b"\r\n\r\n")


def test_empty(spark):
    df = pages(spark, ROWS).where("page_id = -1")
    path = scratch_path(spark, "warc-test")
    write_archives(df, path)
    assert read_archives(spark, path).count() == 0


def archive(n, plain=False):
    pack = (lambda x: x) if plain else gzip.compress
    payloads = [f"<html>page {i} {'text ' * (i * 7 % 60)}</html>".encode() for i in range(n)]
    return [pack(record("response", str(i), f"http://x/{i}", None, sha1_base32(p), p, len(p))) for i, p in enumerate(payloads)]


def ids(found):
    return [int(h["warc-record-id"][10:-1]) for _, _, records, _ in found for h, _ in records if h]


@pytest.mark.parametrize("plain", [False, True])
def test_salvage(plain):
    """Damage of every kind: the rest is recovered, and gaps and units cover the bytes."""
    rnd = random.Random(4)
    for _ in range(60):
        units = archive(12, plain)
        bad = sorted(rnd.sample(range(12), rnd.randint(1, 4)))
        for k in bad:
            u = units[k]
            how = rnd.randrange(4)
            at = rnd.randrange(len(u))
            if how == 0:
                units[k] = u[:at] + bytes([u[at] ^ (1 << rnd.randrange(8))]) + u[at + 1:]
            elif how == 1:
                units[k] = u[:at]
            elif how == 2:
                units[k] = u[:at] + bytes(rnd.randrange(256) for _ in range(rnd.randint(1, 40))) + u[at:]
            else:
                units[k] = b""
        data = b"".join(units)
        found = list(salvage(data))
        at = 0
        for offset, length, records, gap in found:
            assert offset == at and length > 0 and bool(gap) != bool(records)
            at += length
        assert at == len(data)
        got = ids(found)
        assert got == sorted(got) and set(range(12)) - set(bad) <= set(got)


def test_every_flipped_header_bit_is_noticed():
    p = b"<html>a page</html>"
    for kind in ("response", "revisit"):
        clean = record(kind, "7", "http://x/7", "3", sha1_base32(p), p if kind == "response" else None, len(p))
        (head, _), = unit(clean, 0)[0]
        for at in range(clean.index(b"\r\n\r\n") + 4):
            for bit in range(8):
                bad = clean[:at] + bytes([clean[at] ^ (1 << bit)]) + clean[at + 1:]
                assert all(h == head for _, _, records, _ in salvage(bad) for h, _ in records), (at, bit)
                assert all(gap for _, _, _, gap in salvage(bad)), (at, bit)


def test_salvage_inside_a_member():
    """A member of ten records: one damaged record, a cut and a flipped byte lose what they hit only."""
    plain = archive(10, True)
    bad = plain[4].replace(b"<html>", b"<hxml>")
    data = gzip.compress(b"".join([*plain[:4], bad, *plain[5:]])) + archive(12)[11]
    found = list(salvage(data))
    assert ids(found) == [0, 1, 2, 3, 5, 6, 7, 8, 9, 11]
    inner = [x for _, _, records, _ in found for h, x in records if h is None]
    assert inner == [(sum(map(len, plain[:4])), len(bad), "another block digest")]
    rnd = random.Random(8)
    packed = gzip.compress(b"".join(plain) + rnd.randbytes(1 << 17))
    for cut in (len(packed) - 1, len(packed) - 9, len(packed) // 2):
        found = list(salvage(packed[:cut] + archive(12)[11]))
        assert ids(found) == [*range(10), 11] and sum(n for _, n, _, _ in found) == cut + len(archive(12)[11])
        assert [x for _, _, records, _ in found for h, x in records if h is None]
    flipped = packed[:-6] + bytes([packed[-6] ^ 1]) + packed[-5:]
    assert ids(salvage(flipped)) == list(range(10))
    foreign = gzip.compress(b"WARC/1.0\r\nWARC-Type: metadata\r\nWARC-Record-ID: <urn:x>\r\nWARC-Date: 2024\r\nContent-Length: 2\r\n\r\nab\r\n\r\n")
    assert [h["warc-record-id"] for _, _, r, _ in salvage(foreign) for h, _ in r] == ["<urn:x>"]
    assert [bool(g) for _, _, _, g in salvage(foreign[:-2])] == [True]     # no digest, no sound member


def test_salvage_of_clean_and_junk():
    data = b"".join(archive(5))
    assert ids(salvage(data)) == list(range(5)) and all(g is None for *_, g in salvage(data))
    assert [(a, n) for a, n, _, g in salvage(b"junk" * 9)] == [(0, 36)]
    assert list(salvage(b"")) == []
    mixed = archive(3)[0] + archive(3, True)[1] + b"\r\n" + archive(3)[2]
    assert ids(salvage(mixed)) == [0, 1, 2]
    with pytest.raises(Damaged):
        inflate(data[:20], 0)


def test_gaps_are_reported(spark):
    path, _ = round_trip(spark, pages(spark, ROWS).coalesce(1))
    blobs = [bytes(r.content) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()]
    broken = scratch_path(spark, "warc-broken")
    damaged = spark.createDataFrame([(b[:30] + b"\xff\xff\xff" + b[33:-1],) for b in blobs], "value binary")
    damaged.select(F.col("value").cast("string")).write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(broken)
    rows = read_archives(spark, broken).collect()
    gaps = [r for r in rows if r.gap]
    assert len(gaps) == len(blobs) and all(r.length > 0 and r.record_id is None for r in gaps)
    assert len(rows) - len(gaps) == len(ROWS) - len(blobs)


def test_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from matchlab.llm.queries import QUERIES, SQL
    con = duckdb.connect()
    con.execute("CREATE VIEW pages AS SELECT * FROM read_parquet('/root/testdata/sf0.001/pages.parquet')")
    cur = con.execute(SQL["op6_warc_salvage"])
    names = [d[0] for d in cur.description]
    want = sorted(str(sorted(zip(names, r))) for r in cur.fetchall())
    got = sorted(str(sorted(r.asDict().items())) for r in QUERIES["op6_warc_salvage"](spark, "/root/testdata/sf0.001").collect())
    assert got == want
