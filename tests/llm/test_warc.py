import hashlib
import io
import struct
import zipfile

import pytest

from airdata.llm import warc as W


def test_zip_directories():
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED) as z:
        z.writestr("é/a", b"first")
        with z.open("b", "w", force_zip64=True) as f:
            f.write(b"second member")
        z.writestr("empty", b"")
        z.comment = b"a comment PK\x05\x06 inside"[:9]
    data = raw.getvalue()
    got = {n: data[o:o + k] for n, (o, k) in W.members(io.BytesIO(data), len(data)).items()}
    assert got == {"é/a": b"first", "b": b"second member", "empty": b""}
    with pytest.raises(ValueError):
        W.members(io.BytesIO(b"no archive"), 10)
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"x" * 100)
    with pytest.raises(ValueError):
        W.members(raw, len(raw.getvalue()))


def test_zip64_end_and_sizes():
    """An archive whose directory and member only ZIP64 fields describe."""
    name, data = b"m", b"payload"
    local = struct.pack("<4s5H3I2H", W.LOCAL, 45, 0, 0, 0, 0, 0, len(data), len(data), 1, 0) + name + data
    extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), 0)
    central = struct.pack("<4s6H3I5H2I", W.CENTRAL, 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    end64 = struct.pack("<4sQ2H2I4Q", W.EOCD64, 44, 45, 45, 0, 0, 1, 1, len(central), len(local))
    at = struct.pack("<4sIQI", W.EOCD64_AT, 0, len(local) + len(central), 1)
    end = struct.pack("<4s4H2IH", W.EOCD, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    raw = local + central + end64 + at + end
    (o, n), = W.members(io.BytesIO(raw), len(raw)).values()
    assert raw[o:o + n] == data


def test_records():
    for args in ((5, "http://x/é a", b"body\r\n\r\nmore", "d1", None, False), (None, None, b"", "d2", None, False), (6, "http://y\r\nEvil: 1", b"x" * 2000, "d3", 9, True)):
        r = W.parse(W.record(*args))
        assert r["page_id"] == args[0] and r["digest"] == args[3] and r["refers_to"] == args[4] and r["length"] == len(args[2])
        assert r["type"] == ("revisit" if args[5] else "response") and r["payload"] == (b"" if args[5] else args[2])


def brute(rows):
    groups, out = {}, []
    for i, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and i is not None:
            groups[b] = max(groups.get(b, i), i)
    for i, h in rows:
        b = (h or "").encode()
        o = groups.get(b)
        again = o is not None and i != o and sum(x == h for _, x in rows) > 1
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", o if again else None))
    return out


def test_hard_cases(spark):
    big, other = "é<p>" * 400, "long " * 100_000
    rows = [(1, big), (2, big), (3, big), (4, None), (5, ""), (6, "short"), (7, "short"), (None, big), (None, None), (8, other), (9, "x" * 1000), (10, "x" * 1000), (10, "x" * 1000),
            (11, "y" * 999), (12, "y" * 999)]
    d = spark.createDataFrame([(i, None if i == 6 else f"http://h/{i}", h, 1) for i, h in rows], "page_id long, url string, html string, record_type int")
    d = d.selectExpr("*", "1 as payload_digest", "2 as refers_to", "3 as path")
    packages = W.write_packages(d)
    got = W.read_packages(spark, packages, read=2).collect()
    key = lambda t: tuple((x is not None, x) for x in t)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=key) == sorted(brute(rows), key=key)
    for r in got:
        if r.record_type == "response":
            assert hashlib.sha1(bytes(r.payload)).hexdigest() == r.payload_digest
    assert {r.url for r in got if r.page_id == 6} == {None}
    assert W.write_packages(d.limit(0)).count() == 0 and W.read_packages(spark, packages.limit(0)).count() == 0
