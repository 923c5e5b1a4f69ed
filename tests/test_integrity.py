"""Hash trees of files and chains in segments, against plain versions."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import audit
from ledgerflow.sources import filetree, sinks

sha = lambda b: hashlib.sha256(b).digest()


def plain_root(data: bytes, size: int, fan: int) -> str:
    level = [sha(b"\0" + data[i : i + size]) for i in range(0, max(len(data), 1), size)]
    while len(level) > 1:
        level = [sha(b"\1" + b"".join(level[i : i + fan])) for i in range(0, len(level), fan)]
    return level[0].hex()


@pytest.mark.parametrize("size, fan", [(7, 2), (64, 3), (1 << 20, 1024)])
def test_roots_of_files(spark, tmp_path, size, fan):
    rnd = random.Random(size)
    files = {f"d{i % 3}/f{i}.bin": rnd.randbytes(n) for i, n in enumerate([2, 1, 6, 7, 8, 14, 100, 1000, 3000])}
    for name, data in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    hashes = filetree.range_hashes(spark, f"file://{tmp_path}", "*.bin", size)
    roots = filetree.file_roots(hashes, size, fan)
    strip = f"file:{tmp_path}/"
    assert {r.path.removeprefix(strip): (r.bytes, r.root) for r in roots.collect()} == {n: (len(d), plain_root(d, size, fan)) for n, d in files.items()}
    one = filetree.tree_root(roots, fan, strip).first()
    assert one.files == len(files) and filetree.tree_root(roots.repartition(7).orderBy("root"), fan, strip).first() == one
    before = spark.createDataFrame(hashes.collect(), hashes.schema)
    (tmp_path / "d0/f6.bin").write_bytes(files["d0/f6.bin"][:-1] + b"?")
    after = filetree.range_hashes(spark, f"file://{tmp_path}", "*.bin", size)
    assert {(r.path[-6:], r.part, r.change) for r in filetree.changed_ranges(before, after).collect()} == {("f6.bin", 99 // size, "changed")}
    assert filetree.tree_root(filetree.file_roots(after, size, fan), fan, strip).first().root != one.root


def test_root_of_no_files(spark, tmp_path):
    none = spark.createDataFrame([], "path string, bytes long, root string")
    assert tuple(filetree.tree_root(none).first()) == (0, hashlib.sha256(b"\1").hexdigest())
    nothing = spark.createDataFrame([], "path string, bytes long, part long, sha256 string")
    assert filetree.file_roots(nothing).count() == 0


def test_a_shrunk_file_is_an_error(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"x" * 100)
    listed = filetree.ranges(spark, f"file://{tmp_path}", "*.bin", 10).collect()
    (tmp_path / "a.bin").write_bytes(b"x" * 95)
    with pytest.raises(Exception, match="5 bytes at 90"):
        spark.createDataFrame(listed, "path string, bytes long, part long, start long, length long").mapInArrow(filetree._read, "path string, bytes long, part long, sha256 string").collect()


def plain_verify(rows):
    out = {}
    for chain in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == chain), key=lambda r: (r[1] is not None, r[1] or 0, r[4] or "", r[3] or ""))
        first = min((r[1] for r in mine if r[1] is not None), default=None)
        gaps = links = wrong = 0
        before = None
        for k, (_, seq, content, prev, own) in enumerate(mine):
            gaps += seq is not None and seq != first + k
            links += (prev or "") != (before or "")
            wrong += own != hashlib.sha256(f"{'' if seq is None else seq}|{prev or ''}|{content or ''}".encode()).hexdigest()
            before = own
        out[chain] = (len(mine), gaps, links, wrong)
    return out


def test_one_long_chain_over_many_tasks(spark):
    """A third of all rows and more in one chain; holes, repeats, tampered rows, nulls; segments end anywhere."""
    rnd, rows = random.Random(3), []
    for chain, n in (("long", 1500), ("b", 40), (None, 30), *[(f"s{i}", 3) for i in range(60)]):
        before = None
        for i in range(n):
            own = hashlib.sha256(f"{i}|{before or ''}|c{i}".encode()).hexdigest()
            rows.append((chain, i, f"c{i}", before, own))
            before = own
    for i in rnd.sample(range(len(rows)), 40):
        chain, seq, content, prev, own = rows[i]
        rows[i] = rnd.choice([(chain, seq, "tampered", prev, own), (chain, seq + 5, content, prev, own), (chain, seq, content, "x", own), (chain, None, content, prev, own), (chain, seq, content, prev, None)])
    del rows[700], rows[200]
    rows.append(rows[50])
    log = spark.createDataFrame(rows, "chain string, seq long, content string, previous string, own string")
    got = audit.verify_chain(log, "chain", "seq", F.col("content"), "previous", "own")
    assert {r.chain: tuple(r)[1:] for r in got.collect()} == plain_verify(rows)
    assert audit.verify_chain(log.limit(0), "chain", "seq", F.col("content"), "previous", "own").count() == 0


def test_manifest_of_small_and_large_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "LARGE", 1000)
    monkeypatch.setattr(filetree, "RANGE", 256)
    files = {f"f{n}.bin": random.Random(n).randbytes(n) for n in (1, 1000, 1001, 5000)}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    got = {r.path.rpartition("/")[2]: (r.bytes, r.sha256) for r in sinks.manifest(spark, f"file://{tmp_path}", "*.bin").collect()}
    assert got == {n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in files.items()}
