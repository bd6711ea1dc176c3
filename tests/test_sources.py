"""Feed lines, archives, pages and packs: small golden cases."""

import io
import sqlite3
import zlib

import pytest
from digestloom.functions import digests as fn
from digestloom.model import PackFormatError, pack_header, parse_header
from digestloom.operators.catalog import first_existing
from digestloom.operators.split import part_name, parts_needed
from digestloom.sources import archive, packs, pages, textfeed
from pyspark.sql import functions as F

M, M2, S1, S2 = "0123456789abcdef" * 2, "f" * 32, "a1" * 20, "b2" * 32
LINES = [
    (M, M, M), ("MD5:" + M.upper(), M, M), (f"{S2},{S1},{M}", S2, None), ("# " + M, None, None), ("; " + M, None, None), ('"SHA-1","MD5","CRC32","FileName"', None, None),
    (f'"{S1}","{M}","00000000","app.apk"', None, None), (f'"{S1}","{M}","00000000","app.apk.exe"', S1, None), (M + " app.apk", M, None), (M + "0", None, None), ("x" + M, None, None),
    ("_" + M, None, None), ("-" + M, M, None), ("  \t ", None, None), ("sha-256:" + M, M, M), (f'"{S1}","/usr/bin/x"', None, None), (f"{M} {M2}", M, None), ("filename " + M, M, None),
    ("filename md5 " + M, None, None), (f"  {S1.upper()} ", S1, S1), (f"{M},{S1}", S1, None), ("é" + M, None, None), (f"{M2}:{M}", M2, None), (f'{S1} "FILE.DEB"', None, None), (M + " ", M, M),
]


def test_feed_lines(spark):
    rows = spark.createDataFrame([(k, x[0]) for k, x in enumerate(LINES)], "k int, line string")
    got = rows.select("k", fn.free_text_digest(F.col("line")).alias("free"), fn.whole_line_digest(F.col("line")).alias("whole")).orderBy("k").collect()
    assert [(r.free, r.whole) for r in got] == [x[1:] for x in LINES]


def test_header():
    raw = pack_header(3, 1_700_000_000, 2)
    assert raw.hex() == "43565431010000000300000000f153650000000002000000"
    for bad in (raw[:20], b"x" + raw[1:], pack_header(1, 0, 0)[:8] + b"\x09" + raw[9:]):
        with pytest.raises(PackFormatError):
            parse_header(bad)
    with pytest.raises(PackFormatError):
        pack_header(1, 0, 2**32)


def test_permissive_pack(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(pack_header(1, 0, 3) + bytes(range(32)))
    with pytest.raises(Exception, match="too few"):
        packs.read_packs(spark, f"{tmp_path}/a.bin").collect()
    assert packs.read_packs(spark, f"{tmp_path}/a.bin", mode="PERMISSIVE").count() == 2


def test_pages_overflow_and_errors(spark, tmp_path):
    path = f"{tmp_path}/a.db"
    with sqlite3.connect(path) as db:
        db.execute("pragma page_size = 4096")
        db.execute("create table t (path text, crc32 text, md5 text, sha1 text, sha256 text)")
        db.executemany("insert into t values (?, '00000000', ?, ?, ?)", [("p" * (5000 if k < 3 else 20), f"{k:032x}", f"{k:040x}", f"{k:064x}" if k != 4 else "z" * 64) for k in range(6)])
    found = pages.scan_pages(spark, path)
    assert found.filter("kind = 0").count() == 3 and pages.page_digests(spark, path).count() == 8
    assert pages.page_digests(spark, path, overflow="follow").count() == 17
    for data in (b"x" * 99, b"y" * 200, pages.MAGIC + (300).to_bytes(2, "big") + bytes(100)):
        (tmp_path / "b.db").write_bytes(data)
        with pytest.raises(pages.PageError):
            pages.page_size(f"{tmp_path}/b.db")


def test_resuming_stream():
    data, broken = bytes(range(256)) * 40, []

    class Breaks(io.BytesIO):
        def read(self, n=-1):
            if self.tell() > 3000 and len(broken) < 3:
                broken.append(1)
                raise OSError("gone")
            return super().read(n)

    waits = []
    stream = archive.ResumingStream("x", lambda at: (f := Breaks(data), f.seek(at))[0], wait=waits.append)
    out = b""
    while more := stream.read(1000):
        out += more
    assert out == data and waits == [2.0, 4.0, 8.0]


def test_member_names():
    for name, want, fits in (
        ("RDS_2024.03.1_modern/RDS_2024.03.1_modern.db", archive.MEMBER, True), ("deep/er/RDS_9_MODERN.DB", archive.MEMBER, True), ("RDS_1_modern/x.db", archive.MEMBER, False),
        ("a/b/c.db", "b/c.db", True), ("a/b/c.db", "C.DB", True), ("a/bb/c.db", "b/c.db", False), ("./c.db", "c.db", True), ("c.db", "a/c.db", False), ("a/x_modern.db.bak", None, False), ("", None, False), ("", "c.db", False),
    ):
        assert archive.member_matches(name, want) == fits, (name, want)


def test_database_names(spark):
    names = ["a/b.DB", "x\\y.sqlite3", "c.sqlite", "d.dbx", "e_modern.db", "E_modern_minimal.db", ""]
    got = spark.createDataFrame([(n,) for n in names], "name string").select(fn.is_sqlite_member(F.col("name")).alias("s"), fn.is_modern_db(F.col("name")).alias("m")).collect()
    assert [(r.s, r.m) for r in got] == [(True, False), (True, False), (True, False), (False, False), (True, True), (True, False), (False, False)]


def test_names():
    assert archive.member_matches("RDS_1_modern\\RDS_1_modern.db") and not archive.member_matches("x/readme.txt")
    assert archive.member_matches("a/b_modern.db", None) and not archive.member_matches("a/b_modern_minimal.db", None)
    assert part_name("clean_md5", 7, 120, "bin") == "clean_md5_part007.bin"
    assert parts_needed(0, 16, 1000) == 1 and parts_needed(100, 16, 824) == 2
    with pytest.raises(PackFormatError):
        parts_needed(100, 32, 10)
    assert first_existing(["c", "b", "a"], {"a", "b"}.__contains__) == "b"
    assert textfeed.guess_encoding("http://h/a.GZ?x=1") == "gzip" and b"".join(textfeed.inflated(io.BytesIO(zlib.compress(b"hi")))) == b"hi"
