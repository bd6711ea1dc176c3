"""The vectorised page decoder against the plain one, on pages made by SQLite and on damaged ones."""

import random
import sqlite3

import pytest
from digestloom.sources import pages


def plain(path):
    """All that leaf_cells() finds, page by page."""
    size, reserved = pages.page_size(path)
    out = []
    with open(path, "rb") as f:
        for k, page in enumerate(iter(lambda: f.read(size), b"")):
            if len(page) == size:
                out += [(k + 1, cell, kind, v.decode("latin-1")) for cell, values in pages.leaf_cells(page, k == 0, size - reserved) for kind, v in (enumerate(values, 1) if values else [(0, b"")])]
    return sorted(out)


def rows(path, **options):
    reader = pages.PageReader({"path": path, **options})
    return sorted(tuple(r.values()) for part in reader.partitions() for batch in reader.read(part) for r in batch.to_pylist())


@pytest.mark.parametrize("page_size", [512, 4096, 65536])
def test_runs_of_pages(tmp_path, page_size, monkeypatch):
    monkeypatch.setattr(pages, "RUN", 20_000)
    rng = random.Random(page_size)
    path = f"{tmp_path}/a.db"
    with sqlite3.connect(path) as db:
        db.execute(f"pragma page_size = {page_size}")
        db.execute("create table t (id integer, path text, n real, b blob, crc32 text, md5 text, sha1 text, sha256 text)")
        db.execute("create table other (a text, b text)")
        for k in range(1500):
            tail = [c * n for c, n in zip((rng.choice("0af"), rng.choice("0afé"), rng.choice("1b"), "c"), (8, 32 if rng.random() < 0.95 else 31, 40, 64))]
            db.execute("insert into t values (?, ?, ?, ?, ?, ?, ?, ?)", [rng.choice([None, 0, 1, 300, 2**40, -5]), "p" * rng.choice([0, 3, 60, 200, 2000]), rng.choice([None, 1.5]), rng.choice([None, b"x" * rng.randrange(90)]), *tail])
            db.execute("insert into other values (?, ?)", ["z" * rng.randrange(300), "0" * 64])
        db.execute("insert into t (rowid, crc32, md5, sha1, sha256) values (?, ?, ?, ?, ?)", [2**62, "0" * 8, "a" * 32, "b" * 40, "c" * 64])
    want = plain(path)
    assert want and any(r[2] == 0 for r in want) == (page_size == 512) and rows(path) == want == rows(path, pagesPerPartition="7")
    assert rows(path, firstPage="3", lastPage="9") == [r for r in want if 3 < r[0] <= 9]
    data = bytearray(open(path, "rb").read())
    for _ in range(len(data) // 40):  # damage outside the file's header
        data[rng.randrange(100, len(data))] = rng.randrange(256)
    open(path, "wb").write(data[: len(data) - 7])
    assert rows(path) == plain(path)
