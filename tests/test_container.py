"""Building, reading, validating and damaging a container."""

import json

import numpy as np
import pytest

from facetlake import cli
from types import SimpleNamespace

from facetlake.sources import builder, config, container
from facetlake.sources.layout import ELEV, HEADER, PACK, PACK_HEADER, TILE, Error

TOML = """
[database]
name = "Small"
output_directory = "out"
[synthetic]
amplitude_meters = {amplitude}
[local]
threads = {threads}
"""


def write(folder, amplitude=2048, threads=1, more=""):
    folder.mkdir(exist_ok=True)
    (folder / "c.toml").write_text(TOML.format(amplitude=amplitude, threads=threads) + more)
    return str(folder / "c.toml")


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("db")
    return builder.build(spark, write(folder)), folder


def test_identity(tmp_path):
    a, b, c = (config.identify(config.load(write(tmp_path / n, *x))) for n, x in (("a", (2048, 1)), ("b", (2048, 8)), ("c", (2000, 1))))
    assert a == b and a.builder_hash != c.builder_hash and a.semantic_hash != c.semantic_hash
    assert a.dataset_id == 3290402736
    assert a.semantic_hash.hex() == "27ce36659f3cf08e8804cfce98f3ba2a602790ba5c88427c28fb954371ef0448"


def test_builder_identity(tmp_path):
    #: A name and the hashes that are known for it.
    (tmp_path / "c.toml").write_text('[database]\nname = "MoonSynthetic"\n')
    assert config.identify(config.load(tmp_path / "c.toml")).builder_hash.hex() == "0bf5800676f64afcf1589d866298ae6adca5bd0699e3c2c229bb4455955af181"
    d = builder.dataset(config.load(tmp_path / "c.toml"))
    assert d["bundle_hash"].hex() == "0c7296f83a9036aa16d12a8dc08a80c27f60ee4af058d432e6393724ad2ea45a"


@pytest.mark.parametrize("more", ["[packaging]\ncodec = 'none'", "[tiles]\nmax_level = 3", "[extra]\na = 1", "[datum]\nfoo = 1", "[projection]\nversion = 'x'"])
def test_bad_config(tmp_path, more):
    with pytest.raises(Error) as e:
        config.load(write(tmp_path, more=more))
    assert e.value.code == "invalid_argument"


def test_plan(tmp_path):
    p = builder.plan(write(tmp_path))
    assert len(p["tiles"]) == 6 and p["logical_bytes"] == 805164


def test_build_and_read(spark, built):
    report, _ = built
    assert (report["tiles"], report["packs"], report["written"]) == (6, 6, 7)
    db = container.Database(spark, report["manifest"])
    tiles = {r.face: (r.min_code, r.max_code) for r in db.table("tiles").collect()}
    assert tiles[0][0] <= 31126 and tiles[0][1] >= 34833  # the apron reaches into the neighbours
    assert db.table("chunks").count() == 5 and db.table("datasets").count() == 1 and db.table("packs").count() == 6
    assert db.find(0, 0, 0) is not None and db.find(0, 1, 0) is None
    codes = np.frombuffer(db.read_tile(2, 0, 0)[ELEV], "<u2").reshape(259, 259)
    assert (int(codes.min()), int(codes.max())) == tiles[2]
    with pytest.raises(Error) as e:
        db.read_tile(2, 8, 5)
    assert e.value.code == "not_found"
    assert db.subtree(1, 0, 0).count() == 1 and db.children(1, 0, 0).count() == 0 and db.leaves(1, 0, 0).count() == db.leaves(1, 0, 0, True).count() == 1
    assert db.samples().groupBy("face").count().filter("count = 259 * 259").count() == 6


def test_rebuild_is_identical(spark, built):
    _, folder = built
    assert builder.build(spark, str(folder / "c.toml"))["written"] == 0


def test_validate(spark, built):
    out = builder.validate(spark, built[0]["manifest"], full=True)
    assert (out["tiles"], out["seams"]) == (6, 12)


@pytest.mark.parametrize("change,code", [(lambda b: b"X" + b[1:], "invalid_format"), (lambda b: b[:4] + b"\2" + b[5:], "unsupported_version"), (lambda b: b[:100], "truncated_data"), (lambda b: b[:-1] + bytes([b[-1] ^ 1]), "checksum_mismatch"), (lambda b: b[:32] + bytes(16) + b[48:], "hash_mismatch"), (lambda b: b[:230] + b"\1" + b[231:], "invalid_format")])
def test_damaged_manifest(built, change, code):
    from pathlib import Path

    data = Path(built[0]["manifest"]).read_bytes()
    container.Manifest(data)
    with pytest.raises(Error) as e:
        container.Manifest(change(data))
    assert e.value.code == code


def test_damaged_pack_and_failed_publish(spark, tmp_path):
    path = write(tmp_path)
    report = builder.build(spark, path)
    pack = next((tmp_path / "out/Packs").glob("*_F3_*"))
    old = pack.read_bytes()
    pack.write_bytes(old[:-1] + bytes([old[-1] ^ 1]))
    with pytest.raises(Error) as e:
        builder.validate(spark, report["manifest"])
    assert e.value.code == "hash_mismatch"
    manifest = (tmp_path / "out/Small.ltdb").read_bytes()
    with pytest.raises(Error) as e:
        builder.build(spark, path)
    assert e.value.code == "hash_mismatch" and (tmp_path / "out/Small.ltdb").read_bytes() == manifest
    assert not list((tmp_path / "out").rglob("*.tmp"))


def test_delta_and_zstd():
    x = np.random.default_rng(2).integers(0, 65536, (9, 7)).astype(np.uint16)
    assert container.undelta(container.delta(x), 7, 9) == x.astype("<u2").tobytes()
    data = container.deflate(b"abc" * 100)
    assert container.inflate(data, 300) == b"abc" * 100
    for bad, size in ((data, 299), (data[:-1], 300), (data + b"x", 300), (b"junk", 4)):
        with pytest.raises(Error):
            container.inflate(bad, size)


def test_cli(built, capsys):
    _, folder = built
    assert cli.main(["scan", str(folder / "c.toml"), "--json"]) == 0
    assert json.loads(capsys.readouterr().out)["dataset_id"] == 3290402736
    assert cli.main(["plan", str(folder / "c.toml")]) == 0 and "805164" in capsys.readouterr().out
    assert cli.main(["inspect", built[0]["manifest"], "QSC/F2/L00/0000/0000"]) == 0 and "4000000000000000" in capsys.readouterr().out
    assert cli.main(["inspect", built[0]["manifest"], "QSC/F2/L01/0000/0000"]) == 1 and "not_found" in capsys.readouterr().err
    assert cli.main(["scan", str(folder / "none.toml")]) == 1


def test_header_size():
    assert HEADER.size == 256


def indexed(rows, packs):
    """A manifest of a tile index and packs (id, file bytes, rows' places) alone."""
    m = container.Manifest.__new__(container.Manifest)
    m.path, m.header, m.datasets = "m", SimpleNamespace(tile_count=len(rows), max_level=9), [{"id": 5}, {"id": 9}]
    m.packs = [PACK.type(i, 0, 0, 0, 0, len(own), size, rows[own[0]].key, rows[own[-1]].key, b"") for i, size, own in packs]
    m.tiles = m._tiles(b"".join(TILE.write(*r) for r in rows))
    return m


def grid(n=2000):
    """Tiles of face 2 down to level 6, dealt over three packs in turns, with payloads of 16 bytes."""
    keys = sorted({2 << 61 | level << 56 | x % 4**level for level in range(7) for x in range(0, n, 3)})
    rows = [TILE.type(k, 10 + i % 3, 1, PACK_HEADER.size + 16 * (i // 3), 16, 32, 1, 2, 5, 100, 0, 0, 2, 0, 7, b"c" * 16, b"d" * 8) for i, k in enumerate(keys)]
    return rows, [(10 + p, PACK_HEADER.size + 16 * len(rows), list(range(p, len(rows), 3))) for p in range(3)]


def test_index_of_many_tiles():
    rows, packs = grid()
    m = indexed(rows, packs)
    assert container.entries(m.tiles.tobytes()) == rows
    assert [[rows[i] for i in own] for own in m.of_pack] == [[r for r in rows if r.pack_id == p] for p, _, _ in packs]
    for face, level, code in ((2, 0, 0), (2, 2, 3), (2, 6, 600), (2, 3, 64), (1, 0, 0), (6, 0, 0), (2, 29, 0), (2, -1, 0)):
        want = [r.key for r in rows if (k := container.key_parts(r.key))[0] == face and 0 <= level <= k[1] and k[2] >> 2 * (k[1] - level) == code]
        assert m.below(face, level, code, level, 28)["key"].tolist() == want
        assert m.below(face, level, code, level, level)["key"].tolist() == [k for k in want if container.key_parts(k)[1] == level]
    assert len(indexed([], []).tiles) == 0


@pytest.mark.parametrize(
    "at,change,code,message",
    [
        (7, {"key": 7 << 61}, "invalid_format", "increasing"),
        (-1, {"key": 6 << 61}, "invalid_tile_key", "key"),
        (-1, {"key": 2 << 61 | 6 << 56 | 4**6}, "invalid_tile_key", "key"),
        (-1, {"key": 2 << 61 | 10 << 56}, "invalid_format", "level"),
        (40, {"flags": 4}, "unsupported_feature", "flags"),
        (40, {"child_mask": 16}, "unsupported_feature", "flags"),
        (40, {"min_code": 3}, "invalid_format", "record"),
        (40, {"payload_offset": 68}, "invalid_format", "record"),
        (40, {"pack_id": 13}, "invalid_format", "pack or dataset"),
        (40, {"primary_dataset": 6}, "invalid_format", "pack or dataset"),
        (40, {"payload_offset": 0}, "invalid_format", "range"),
        (40, {"payload_offset": 2**63}, "invalid_format", "range"),
        (40, {"stored_bytes": 2**32 - 1}, "invalid_format", "range"),
        (40, {"pack_id": 12}, "invalid_format", "tiles of pack"),
        (40, {"stored_bytes": 24}, "invalid_format", "overlap"),
    ],
)
def test_damaged_index(at, change, code, message):
    rows, packs = grid()
    rows[at] = rows[at]._replace(**change)
    with pytest.raises(Error, match=message) as e:
        indexed(rows, packs)
    assert e.value.code == code


def test_packs_dealt_over_scans(spark, built, monkeypatch):
    db = container.Database(spark, built[0]["manifest"])
    read = lambda *k: sorted(map(str, db.channels(*k).collect()))
    whole, some = read(), spark.createDataFrame([("4000000000000000",), ("4000000000000000",), ("x",), (None,)], "key_hex string")
    one = read(some)
    assert len(whole) == 12 and len(one) == 2 and set(one) < set(whole)
    monkeypatch.setattr(container, "SCAN_BYTES", 160)
    monkeypatch.setattr(container, "BATCH_BYTES", 1)
    assert read() == whole and read(some) == one and read(some.limit(0)) == []
