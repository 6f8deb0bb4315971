"""Files of any size: digests as streams and in pieces, dBase folders in ranges."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cartorio.operators import sync
from cartorio.sources import dbf, files, streams


def plain(path):
    sha = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(1 << 22):
            sha.update(block)
    return sha.hexdigest()


def test_a_file_over_two_gigabytes_is_hashed(spark, tmp_path):
    size = (2 << 30) + 12_345
    with open(tmp_path / "zeros.bin", "wb") as f:  # a hole: no disk is used
        f.truncate(size)
    row = files.digests(spark, str(tmp_path), "*.bin").first()
    assert (row["size_bytes"], row["sha256"]) == (size, plain(tmp_path / "zeros.bin"))


def test_streams_and_values_agree(spark, tmp_path):
    r = random.Random(1)
    for name, n in (("a", 2001), ("b", 1), ("c", 5000), ("d é", 4096)):
        (tmp_path / f"{name}.parquet").write_bytes(r.randbytes(n))
    rows = {whole: sorted(map(tuple, files.digests(spark, str(tmp_path), whole=whole).collect())) for whole in (0, 2000, 1 << 20)}
    assert rows[0] == rows[2000] == rows[1 << 20] and len(rows[0]) == 4
    for path, n, sha, md5 in rows[0]:
        data = (tmp_path / path.rpartition("/")[2].replace("%20", " ").replace("%C3%A9", "é")).read_bytes()
        assert (n, sha, md5) == (len(data), hashlib.sha256(data).hexdigest(), hashlib.md5(data).hexdigest())


def test_pieces_find_where_a_copy_differs(spark, tmp_path):
    data = bytearray(random.Random(2).randbytes(10_000))
    for side in ("here", "there"):
        (tmp_path / side).mkdir()
        for name in ("same", "changed", "longer"):
            (tmp_path / side / f"{name}.parquet").write_bytes(data)
    data[7_777] ^= 1
    (tmp_path / "there" / "changed.parquet").write_bytes(data)
    (tmp_path / "there" / "longer.parquet").write_bytes(bytes(10_001))
    (tmp_path / "there" / "extra.parquet").write_bytes(b"x")
    sides = [files.piece_digests(spark, str(tmp_path / side), size=1000).withColumn("path", files.below(spark, F.col("path"), str(tmp_path / side))) for side in ("here", "there")]
    assert sides[0].count() == 30 and sides[0].agg(F.sum("size_bytes")).first()[0] == 30_000
    got = {r["path"]: tuple(r)[1:] for r in sync.validate_pieces(*sides).collect()}
    assert got == {"same.parquet": (10, 0, None), "changed.parquet": (10, 1, 7000), "longer.parquet": (11, 11, 0), "extra.parquet": (1, 1, 0)}


def test_stores_that_tasks_can_open():
    assert streams.known("/a/b") and streams.known("file:/a/b") and streams.known("file:///a/b") and not streams.known("viewfs://store/in/a")
    assert streams.store("file:/a/b")[1] == streams.store("file:///a/b")[1] == "/a/b"


@pytest.fixture
def tree(tmp_path):
    rows = [(f"{i % 27:02d}", f"é {i}" if i % 5 else None, str(i)) for i in range(1000)]
    (tmp_path / "y1").mkdir()
    (tmp_path / "y1" / "a.dbf").write_bytes(dbf.dbf_bytes([("UF", 2), ("NOME", 9), ("N", 5)], rows[:700]))
    raw = bytearray(dbf.dbf_bytes([("N", 5), ("UF", 2)], [(n, u) for u, _, n in rows[700:]]))
    shape = dbf.layout(bytes(raw[: int.from_bytes(raw[8:10], "little")]))
    raw[shape.start + 3 * shape.width] = ord("*")  # record 703 is deleted
    (tmp_path / "b.DBF").write_bytes(raw)
    (tmp_path / "none.dbf").write_bytes(dbf.dbf_bytes([("N", 5), ("LATE", 3)], []))
    return str(tmp_path), [(u, x if k < 700 else None, n) for k, (u, x, n) in enumerate(rows) if k != 703]


@pytest.mark.parametrize("ranged", [True, False])
def test_a_dbf_tree_in_ranges(spark, tree, ranged, monkeypatch):
    root, rows = tree
    if not ranged:
        monkeypatch.setattr(streams, "known", lambda _: False)
    out = dbf.read_dbf_folder(spark, root, records=64)
    assert out.columns == ["_path", "LATE", "N", "NOME", "UF"]
    assert sorted((r["UF"], r["NOME"] or "", r["N"]) for r in out.collect()) == sorted((u, x or "", n) for u, x, n in rows)
    some = dbf.read_dbf_folder(spark, root, ["N"], equals={"UF": ["03", "04"]}, records=64)
    assert sorted(r["N"] for r in some.collect()) == sorted(n for u, _, n in rows if u in ("03", "04")) and some.columns == ["_path", "N"]
    assert sorted(r["N"] for r in dbf.read_dbf_folder(spark, root, ["N"], equals={"NOME": ["é 7"]}).collect()) == ["7"]
