"""Jobs end to end: the command line, parts, restarts, splitting, uploads and resuming over http."""

import gzip
import http.server
import io
import json
import os
import sqlite3
import sys
import threading
import zipfile
import zlib
from hashlib import md5, sha1, sha256

import pytest
from digestloom import cli
from digestloom.model import PackFormatError, pack_header
from digestloom.operators import catalog
from digestloom.operators.split import parts_needed, split_plan, text_parts
from digestloom.plans import feeds
from digestloom.sources import archive, packs, pages, textfeed
from digestloom.streaming import parts as streaming
from pyspark.sql import functions as F

DIGESTS = {"md5": sorted(md5(bytes([k])).digest() for k in range(200)), "sha1": sorted(sha1(bytes([k])).digest() for k in range(150)), "sha256": sorted(sha256(bytes([k])).digest() for k in range(100))}


def database(path, n=200):
    with sqlite3.connect(path) as db:
        db.execute("create table METADATA (path text, crc32 text, md5 text, sha1 text, sha256 text)")
        db.executemany("insert into METADATA values (?, '00000000', ?, ?, ?)", [("p" * (k % 300), md5(bytes([k])).hexdigest(), sha1(bytes([k % 150])).hexdigest(), sha256(bytes([k % 100])).hexdigest()) for k in range(n)])
    return str(path)


def pack_of(folder, name, digests=None):
    algo, found = list(DIGESTS).index(name) + 1, DIGESTS[name] if digests is None else digests
    path = f"{folder}/clean_{name}.bin"
    with open(path, "wb") as f:
        f.write(pack_header(algo, 7, len(found)) + b"".join(found))
    return path


def payload(path):
    with open(path, "rb") as f:
        return f.read()[24:]


@pytest.fixture
def server():
    """Serves bytes with ranges; the first response to each path ends after 3,000 bytes, cleanly."""
    data, seen = {}, []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            body = data.get(self.path)
            if body is None:
                self.send_error(404)
                return
            at = int(self.headers["Range"].split("=")[1].split("-")[0]) if self.headers.get("Range") else 0
            upto = self.headers.get("Range", "-").rpartition("-")[2]
            whole = body[at : int(upto) + 1 if upto else None]
            self.send_response(206 if self.headers.get("Range") else 200)
            self.send_header("Content-Length", str(len(whole)))
            self.end_headers()
            short = self.command == "GET" and self.path not in seen and not upto
            seen.append(self.path)
            if self.command == "GET":
                self.wfile.write(whole[:3000] if short else whole)

        do_HEAD = do_GET

        def log_message(self, *a):
            pass

    made = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{made.server_port}", data
    made.shutdown()


def test_stream_resumes_after_a_clean_early_end(server):
    url, data = server
    data["/x"] = os.urandom(10_240)
    waits, out = [], b""
    stream = archive.ResumingStream(f"{url}/x", wait=waits.append)
    while more := stream.read(1000):
        out += more
    assert out == data["/x"] and len(waits) <= 1
    assert archive.object_size(f"{url}/x") == 10_240 and archive.url_exists(f"{url}/x") and not archive.url_exists(f"{url}/y")
    ends = archive.ResumingStream("x", lambda at: io.BytesIO(b""), retries=2, wait=waits.append, size=5)
    with pytest.raises(OSError, match="0 of 5"):
        ends.read(10)
    assert archive.measured(io.BytesIO(bytes(100)), 9, 30)[0] == 100


def test_members_with_data_descriptors(tmp_path):
    class Unseekable(io.RawIOBase):
        def __init__(self):
            self.data = bytearray()

        def writable(self):
            return True

        def write(self, b):
            self.data += bytes(b)
            return len(b)

    body = os.urandom(100_000)
    for kind in (zipfile.ZIP_DEFLATED, zipfile.ZIP_STORED):
        sink = Unseekable()
        with zipfile.ZipFile(sink, "w", kind) as z:
            z.writestr("notes/a.txt", "x" * 70_000)
            z.writestr("RDS_1_modern/RDS_1_modern_minimal.db", b"small")
            z.writestr("x\\RDS_1_modern.db", body)
        data = bytes(sink.data)
        assert b"PK\x07\x08" in data
        if kind == zipfile.ZIP_DEFLATED:
            assert b"".join(archive.member_bytes(io.BytesIO(data), None)) == body
            (tmp_path / "a.zip").write_bytes(data)
            target = archive.stage_member(f"file://{tmp_path}/a.zip", f"{tmp_path}/out.db")
            assert open(target, "rb").read() == body
            for want, found in (("none.db", "RDS_1_modern_minimal.db"), ("b/*.dbx", "RDS_1_modern.db")):
                with pytest.raises(archive.ArchiveError, match=found):
                    list(archive.member_bytes(io.BytesIO(data), want))
            with pytest.raises(archive.ArchiveError, match="too soon"):
                list(archive.member_bytes(io.BytesIO(data[:90_000]), None))
            with pytest.raises(archive.ArchiveError):
                archive.stage_member(f"file://{tmp_path}/a.zip", f"{tmp_path}/none.db", "none.db")
            assert not [x for x in os.listdir(tmp_path) if x.startswith("none.db")]
        else:
            with pytest.raises(archive.ArchiveError, match="without a size"):
                list(archive.member_bytes(io.BytesIO(data), None))


def test_inflated_members(spark, tmp_path):
    lines = [f"line {k} {'x' * (k % 50)}" for k in range(5000)]
    text = "\r\n".join(lines).encode()
    cuts = [text[:7], text[7:5000], b"", text[5000:]]
    whole = b"".join(map(gzip.compress, cuts))
    for data, mode in ((whole, "auto"), (whole + bytes(512), "gzip"), (whole + b"junk", "auto"), (zlib.compress(text), "auto"), (zlib.compress(text)[2:-4], "raw"), (b"".join(map(zlib.compress, cuts)), "zlib")):
        assert b"".join(textfeed.inflated(io.BytesIO(data), mode)) == text
        (tmp_path / "a b.bin").write_bytes(data)
        assert [r.line for r in textfeed.read_compressed_lines(spark, f"{tmp_path}/a b.bin", mode).collect()] == lines
    bomb = b"".join(textfeed.inflated(io.BytesIO(gzip.compress(bytes(50_000_000))), "gzip"))
    assert len(bomb) == 50_000_000 and max(map(len, textfeed.inflated(io.BytesIO(gzip.compress(bytes(50_000_000)))))) <= textfeed.MOST
    for broken in (whole[:-20], zlib.compress(text)[:100], b"\0" + text):
        with pytest.raises(zlib.error):
            list(textfeed.inflated(io.BytesIO(broken)))
    assert list(textfeed.framed(iter([b"a", b"b\r", b"\nc\xff\n\n", b"d"]))) == ["ab", "c", "", "d"] and list(textfeed.inflated(io.BytesIO(b""))) == []


def test_pack_writer_checks(spark, tmp_path):
    rows = spark.createDataFrame([(1, bytes([k]) * 16) for k in (3, 1, 2)], "algo int, digest binary")
    path = packs.write_pack(rows, f"{tmp_path}/a.bin", 1, 9)
    assert payload(path) == b"".join(bytes([k]) * 16 for k in (1, 2, 3)) and packs.pack_count(path) == 3
    for bad in ([(1, b"a" * 16), (1, b"a" * 16)], [(1, b"a" * 15)]):
        with pytest.raises(Exception, match="strict byte order"):
            packs.write_pack(spark.createDataFrame(bad, "algo int, digest binary"), f"{tmp_path}/b.bin", 1)
    assert sorted(os.listdir(tmp_path)) == ["a.bin"] or not os.path.exists(f"{tmp_path}/b.bin")


def test_part_packs_restart_and_merge(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "parts"
    rows = [(a + 1, d) for a, n in enumerate(DIGESTS) for d in DIGESTS[n]]
    spark.createDataFrame(rows[:300], "algo int, digest binary").coalesce(1).write.parquet(str(source))
    stream = lambda: spark.readStream.schema("algo int, digest binary").option("maxFilesPerTrigger", 1).parquet(str(source))
    streaming.write_part_packs(stream(), str(out), f"{tmp_path}/ck", updated_unix=5).awaitTermination()
    before = {p.name: p.read_bytes() for p in out.iterdir()}
    assert sorted(before) == [f"part_00000_{n}.bin" for n in ("md5", "sha1", "sha256")]
    # More input and a new start: the first part stays as it is, the rest gets a part of its own.
    spark.createDataFrame(rows[250:], "algo int, digest binary").coalesce(1).write.mode("append").parquet(str(source))
    streaming.write_part_packs(stream(), str(out), f"{tmp_path}/ck", updated_unix=5).awaitTermination()
    assert {k: (out / k).read_bytes() for k in before} == before and len(list(out.iterdir())) == 6
    assert feeds.merge_part_packs(spark, str(out), str(tmp_path), 5) == {k + 1: len(v) for k, v in enumerate(DIGESTS.values())}
    for name, digests in DIGESTS.items():
        assert payload(tmp_path / f"clean_{name}.bin") == b"".join(digests)
    with pytest.raises(PackFormatError):
        feeds.merge_part_packs(spark, f"{tmp_path}/none", str(tmp_path))


def test_carve_goes_on_where_it_stopped(spark, tmp_path):
    path, out = database(tmp_path / "a.db", 200), str(tmp_path / "parts")
    assert feeds.carve_parts(spark, path, out, 1, updated_unix=3) == 1
    os.remove(f"{out}/part_00000_md5.bin")
    assert feeds.carve_parts(spark, path, out, 1, updated_unix=3) == 1 and not os.path.exists(f"{out}/part_00000_md5.bin")
    os.remove(f"{out}/pages.done")
    seen = []
    feeds.carve_parts(spark, path, out, 1, updated_unix=3, progress=lambda *x: seen.append(x))
    assert seen[-1][0] == 1 and seen[-1][1] == seen[-1][2] and payload(f"{out}/part_00000_md5.bin") == b"".join(DIGESTS["md5"])


def test_small_parts_are_carved_together(spark, tmp_path):
    path, out, sc = str(tmp_path / "a.db"), str(tmp_path / "par{}ts"), spark.sparkContext
    with sqlite3.connect(path) as db:
        db.execute("create table METADATA (path text, crc32 text, md5 text, sha1 text, sha256 text)")
        db.executemany("insert into METADATA values (?, '00000000', ?, ?, ?)", [("p" * 900, md5(b"%d" % (k % 700)).hexdigest(), sha1(b"%d" % (k % 900)).hexdigest(), sha256(b"%d" % k).hexdigest()) for k in range(3000)])
        db.execute("create table OTHER (x text)")  # the last parts have no digests
        db.executemany("insert into OTHER values (?)", [("y" * 3000,) for _ in range(600)])
    pages_, step, seen = os.path.getsize(path) // 4096, 256, []
    sc.setJobGroup("carving", "carving")
    try:
        n = feeds.carve_parts(spark, path, out, 1, updated_unix=3, progress=lambda *x: seen.append(x))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    # In all, not for each part.
    assert n == -(-pages_ // step) > 4 and len(sc.statusTracker().getJobIdsForGroup("carving")) <= 6
    assert seen == [(k + 1, min(pages_, (k + 1) * step), pages_) for k in range(n)]
    made = {}
    for k in range(n):
        found = pages.page_digests(spark, path, firstPage=str(k * step), lastPage=str(min(pages_, (k + 1) * step))).distinct().collect()
        for algo, name in enumerate(DIGESTS, 1):
            want = sorted(bytes(r.digest) for r in found if r.algo == algo)
            with open(f"{out}/part_{k:05d}_{name}.bin", "rb") as f:
                made[k, name] = f.read()
            assert made[k, name] == pack_header(algo, 3, len(want)) + b"".join(want)
    assert len(os.listdir(out)) == 3 * n + 1 and made[n - 1, "md5"] == pack_header(1, 3, 0)
    # A start after two parts makes the others alone, alike.
    for name in os.listdir(out):
        os.remove(f"{out}/{name}")
    (tmp_path / "par{}ts" / "pages.done").write_text(str(2 * step))
    assert feeds.carve_parts(spark, path, out, 1, updated_unix=3) == n
    for key, data in made.items():
        name = f"{out}/part_{key[0]:05d}_{key[1]}.bin"
        assert os.path.exists(name) == (key[0] >= 2) and (key[0] < 2 or open(name, "rb").read() == data)


def test_uploader(tmp_path):
    for k in range(3):
        (tmp_path / f"part_0000{k}_md5.bin").write_bytes(b"x")
    (tmp_path / "part_00009_md5.bin.tmp").write_bytes(b"x")
    fails = streaming.Uploader(str(tmp_path), f"{sys.executable} -c \"import sys; sys.exit('1_md5' in sys.argv[1])\" {{path}}", wait=lambda s: None)
    assert [os.path.basename(p) for p in fails.finish()] == ["part_00001_md5.bin"] and (fails.sent, fails.failed) == (2, 4)
    assert streaming.Uploader(str(tmp_path), "no-such-command {path}", retries=0).finish()
    assert not streaming.Uploader(str(tmp_path), f"{sys.executable} -c pass {{path}}").finish() and [p.name for p in tmp_path.iterdir()] == ["part_00009_md5.bin.tmp"]


def test_split_text_and_discovery(spark, tmp_path):
    pack_of(tmp_path, "sha1")
    feeds.export_text(spark, f"{tmp_path}/clean_sha1.bin", f"{tmp_path}/clean_sha1.txt")
    pack_of(tmp_path, "md5")
    (tmp_path / "clean_md5_part01.bin").write_bytes(b"old")
    text, pack = (tmp_path / "clean_sha1.txt").read_bytes(), (tmp_path / "clean_md5.bin").read_bytes()
    assert [os.path.basename(p) for p in feeds.published(str(tmp_path))] == ["clean_md5.bin", "clean_sha1.bin", "clean_sha1.txt"]
    made = feeds.split_published([str(tmp_path)], 1000)
    for whole, source in ((text, "clean_sha1.txt"), (pack, "clean_md5.bin")):
        names = made[f"{tmp_path}/{source}"]
        assert len(names) > 1 and all(os.path.getsize(p) <= 1000 for p in names) and not os.path.exists(f"{tmp_path}/{source}")
        assert b"".join(open(p, "rb").read() for p in names) == whole
    uneven = tmp_path / "clean_x.txt"
    uneven.write_text("a\n" * 50 + "b" * 90 + "\n" + "c" * 90)
    assert text_parts([2] * 50 + [91, 90], 281, 52, 100) == 24  # three parts by size, doubled three times
    parts = feeds.split_text(str(uneven), 100)
    assert "".join(open(p).read() for p in parts) == "a\n" * 50 + "b" * 90 + "\n" + "c" * 90
    (tmp_path / "clean_y.txt").write_text("y" * 200)
    with pytest.raises(PackFormatError):
        feeds.split_text(f"{tmp_path}/clean_y.txt", 100)
    (tmp_path / "clean_z.txt").write_text("")
    assert feeds.split_text(f"{tmp_path}/clean_z.txt", 100) == [f"{tmp_path}/clean_z.txt"]


@pytest.mark.parametrize("limit", [60, 100, 1000, 4096, 10**6])
@pytest.mark.parametrize("kind", ["bin", "txt"])
def test_split_plan_follows_the_rule(spark, limit, kind):
    rows = [(a + 1, d) for a, n in enumerate(DIGESTS) for d in DIGESTS[n]]
    plan = split_plan(spark.createDataFrame(rows, "algo int, digest binary"), limit, kind)
    try:
        want = {k + 1: parts_needed(len(v), len(v[0]), limit, kind) for k, v in enumerate(DIGESTS.values())}
    except PackFormatError:
        with pytest.raises(Exception, match="don't fit"):
            plan.collect()
        return
    got = plan.collect()
    for algo, parts in want.items():
        own = sorted((r.part_no, r.records, r.bytes) for r in got if r.algo == algo)
        n = len(list(DIGESTS.values())[algo - 1])
        assert sum(r[1] for r in own) == n and max(r[1] for r in own) == -(-n // parts) and all(r[2] <= limit for r in own) and [r[0] for r in own] == list(range(1, len(own) + 1))


def test_discovery_listing_and_reports(spark):
    page = '<a href="/d/RDS_2024.03.1_modern.zip">a</a> <A HREF=\'https://h/RDS_2024.12.1_modern.zip\'> <a href="RDS_2025.03.1_modern_minimal.zip">'
    assert catalog.discover_latest(spark, lambda: (page, "https://h/x/"), [], lambda u: False) == "https://h/RDS_2024.12.1_modern.zip"
    assert catalog.page_links(page, "https://h/x/")[0] == "https://h/d/RDS_2024.03.1_modern.zip"

    def gone():
        raise OSError("gone")

    assert catalog.discover_latest(spark, gone, ["b", "a"], {"a"}.__contains__) == "a" and catalog.discover_latest(spark, lambda: ("", "x"), ["b"], lambda u: False) is None
    assert catalog.listed_assets('{"assets": [{"name": "x", "size": 3}, {"name": "y"}]}') == [("x", 3), ("y", 0)] == catalog.listed_assets('[{"name": "x", "size": "3"}, {"name": "y"}]')
    assets = spark.createDataFrame([("clean_md5_part02.bin", 5), ("clean_md5_part01.bin", 1000), ("clean_sha1.txt", 9), ("other.txt", 1)], "name string, size long")
    made = feeds.notes(assets, {"md5": 1234567})
    assert "| MD5 | pack | 1,234,567 | `clean_md5_part01.bin` | 1,000 |" in made and "cat clean_md5_part01.bin clean_md5_part02.bin > clean_md5.bin" in made and "other" not in made
    assert made.index("part01") < made.index("part02") < made.index("clean_sha1.txt")


def run(*argv):
    return cli.main([str(x) for x in argv])


def test_cli_feed_of_every_kind(spark, tmp_path):
    path = database(tmp_path / "a.db")
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.write(path, "RDS_1_modern/RDS_1_modern.db")
    text = "\n".join(d.hex() for digests in DIGESTS.values() for d in digests)
    (tmp_path / "a.txt").write_text(text)
    (tmp_path / "a.gz").write_bytes(gzip.compress(text[:999].encode()) + gzip.compress(text[999:].encode()))
    for k, (source, *options) in enumerate((("a.db",), ("a.db", "--mode", "sql"), ("a.zip",), ("a.txt",), ("a.gz",))):
        out = tmp_path / f"out{k}"
        assert run("feed", tmp_path / source, "-o", out, "--updated-unix", 5, *options) == 0
        assert {p.name: payload(p) for p in out.iterdir()} == {f"clean_{n}.bin": b"".join(d) for n, d in DIGESTS.items()}, source
    assert run("feed", tmp_path / "a.txt", "-o", tmp_path / "few", "--max-keep", 210, "--format", "text") == 0
    assert {p.name: len(p.read_text().split()) for p in (tmp_path / "few").iterdir()} == {"clean_md5.txt": 200, "clean_sha1.txt": 10, "clean_sha256.txt": 0}
    assert run("feed", path, "--parts-dir", tmp_path / "parts", "--checkpoint-mib", 1) == 0 and run("merge", tmp_path / "parts", "-o", tmp_path / "merged") == 0
    assert payload(tmp_path / "merged/clean_sha256.bin") == b"".join(DIGESTS["sha256"])
    assert run("feed", path, "--parts-dir", tmp_path / "sent", "--upload-cmd", f"{sys.executable} -c pass {{path}}") == 0 and os.listdir(tmp_path / "sent") == ["pages.done"]
    for bad in (("feed", tmp_path / "a.zip", "--member", "none.db"), ("feed", tmp_path / "missing.gz"), ("merge", tmp_path / "few"), ("feed", tmp_path / "a.txt", "--parts-dir", tmp_path / "p"), ("feed", path, "--parts-dir", tmp_path / "s2", "--upload-cmd", "false")):
        assert run(*bad, *(() if "--parts-dir" in bad else ("-o", tmp_path / "bad"))) == 2 or bad[-1] == "false"


def test_cli_text_split_notes_probe(spark, tmp_path, server, capsys):
    for name in DIGESTS:
        pack_of(tmp_path, name)
    assert run("text", tmp_path) == 0 and run("text", tmp_path, tmp_path / "all.txt", "--combined") == 0
    assert (tmp_path / "clean_md5.txt").read_text().split() == [d.hex() for d in DIGESTS["md5"]]
    assert (tmp_path / "all.txt").read_text().split() == sorted(d.hex() for x in DIGESTS.values() for d in x)
    assert run("split", tmp_path, "--limit-mib", 0.002) == 0 and run("notes", tmp_path, "-o", tmp_path / "n.md", "--publish-cmd", f"{sys.executable} -c pass {{path}}") == 0
    assert "| MD5 | pack | 200 | `clean_md5_part01.bin`" in (tmp_path / "n.md").read_text()
    url, data = server
    data["/clean_md5_part01.bin"], data["/big"] = (tmp_path / "clean_md5_part01.bin").read_bytes(), bytes(200_000)
    (tmp_path / "list.json").write_text(json.dumps([{"name": "clean_md5_part01.bin", "size": 9}]))
    assert run("notes", tmp_path / "list.json", "--counts-url", url + "/{name}") == 0 and "| 200 |" in capsys.readouterr().out
    data["/page"] = f'<a href="{url}/RDS_2024.12.1_modern.zip">'.encode()
    with zipfile.ZipFile(buffer := io.BytesIO(), "w", zipfile.ZIP_DEFLATED) as z:
        z.write(database(tmp_path / "m.db"), "RDS_1_modern/RDS_1_modern.db")
    data["/RDS_2024.12.1_modern.zip"] = buffer.getvalue()
    assert run("feed", "--latest-page", f"{url}/page", "-o", tmp_path / "new") == 0 and payload(tmp_path / "new/clean_md5.bin") == b"".join(DIGESTS["md5"])
    assert run("probe", f"{url}/big", "--seconds", 1, "--values", tmp_path / "v", "--summary", tmp_path / "s.md") == 0
    assert "will_fit=true\n" in (tmp_path / "v").read_text() and "| will fit | true |" in (tmp_path / "s.md").read_text()
    assert run("probe", f"{url}/none") == 2 and run("text", tmp_path / "new/none.bin") == 2
