"""Grids, generated containers, exports, incremental builds and differences."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from facetlake import cli
from facetlake.functions import hashing
from facetlake.operators import index, raster
from facetlake.sources import builder, container, fixtures, grids
from facetlake.sources.layout import ELEV, QUAL, Error

#: The rasters, sources and quality of a known small tile.
CODES = np.array([[100, 101, 103], [99, 101, 104], [98, 102, 106]])
PLACES, QUALITY = np.array([[0, 0], [1, 1]]), np.array([[0, 4], [1, 12]])
SOURCES = [(1666136, 0.5, 100.0), (1666137, 0.5, 60.0)]


@pytest.fixture(scope="module", params=[0, 1])
def small(request, tmp_path_factory):
    folder = tmp_path_factory.mktemp("small")
    files = fixtures.database("Fixture", 2, 8, 147, 92, CODES, SOURCES, PLACES, QUALITY, child_mask=5, codec=request.param)
    for name, data in files.items():
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(data)
    return folder, files


def test_reader_on_a_deep_tile(spark, small):
    folder, _ = small
    db = container.Database(spark, str(folder / "Fixture.ltdb"))
    t = db.table("tiles").first()
    #: Key, child mask, codes and summaries of that tile.
    assert int(t.key_hex, 16) == 5188146770730836901 and (t.child_mask, t.min_code, t.max_code, t.resolution_mm, t.error_mm, t.channel_count) == (5, 98, 106, 53000, 1250, 3)
    assert t.logical_bytes == 18 + 16 + 2 * 16 + 4 + 4
    face, level, m = 2, 8, t.morton
    got = db.read_tile(face, level, m)
    assert np.frombuffer(got[ELEV], "<u2").reshape(3, 3).tolist() == CODES.tolist() and list(got[QUAL]) == [0, 4, 1, 12]
    p = db.provenance().first()
    assert [(e.dataset_id, e.fraction, e.resolution_m) for e in p.palette] == [(1666136, 0.5, 100.0), (1666137, 0.5, 60.0)] and p.map == [0, 0, 1, 1]
    assert [r.error for r in db.channels().collect()] == [None] * 3
    with pytest.raises(Error) as e:
        db.read_tile(2, 8, m - 1)
    assert e.value.code == "not_found"
    assert builder.violations(db).filter("precedence = 1").count() == 0 and builder.violations(db).count() == 2  # no parent, and no children
    assert db.leaves(2, 8, m).count() == 0 and db.leaves(2, 8, m, computed=True).count() == 1


@pytest.mark.parametrize("change,code", [(lambda b: b"X" + b[1:], "invalid_format"), (lambda b: b[:4] + b"\2" + b[5:], "unsupported_version"), (lambda b: b[:100], "truncated_data"), (lambda b: b[:-1] + bytes([b[-1] ^ 1]), "checksum_mismatch")])
def test_damage(small, change, code):
    with pytest.raises(Error) as e:
        container.Manifest(change(small[1]["Fixture.ltdb"]))
    assert e.value.code == code


def test_damaged_pack(spark, tmp_path):
    files = fixtures.database("Fixture", 2, 8, 147, 92, CODES, SOURCES, PLACES, QUALITY)
    for name, data in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data if name.endswith("ltdb") else data[:-1] + bytes([data[-1] ^ 1]))
    with pytest.raises(Error) as e:
        builder.validate(spark, str(tmp_path / "Fixture.ltdb"))
    assert e.value.code == "hash_mismatch"


def test_images(spark, small):
    db = container.Database(spark, str(small[0] / "Fixture.ltdb"))
    m = db.table("tiles").first().morton
    grey = builder.export_image(db, 2, 8, m)
    assert grey.startswith(b"P5\n3 3\n65535\n") and np.frombuffer(grey[-18:], ">u2").reshape(3, 3).tolist() == CODES.tolist()
    assert builder.export_image(db, 2, 8, m, "quality") == b"P5\n2 2\n255\n" + bytes([0, 4, 1, 12])
    colour = builder.export_image(db, 2, 8, m, "provenance")
    assert colour.startswith(b"P6\n2 2\n255\n") and colour[-12:-9] == colour[-9:-6] != colour[-6:-3] == colour[-3:]
    assert builder.export_raw(db, 2, 8, m) == CODES.astype("<u2").tobytes()


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("db")
    (folder / "c.toml").write_text('[database]\nname = "Small"\noutput_directory = "a"\n')
    (folder / "d.toml").write_text('[database]\nname = "Small"\noutput_directory = "b"\n[synthetic]\namplitude_meters = 100\n')
    return folder, builder.build(spark, str(folder / "c.toml"))


def test_incremental_build(spark, built, monkeypatch):
    folder, first = built
    assert first["made"] == 6
    monkeypatch.setattr(builder, "encoded_tiles", None)  # nothing may be made
    again = builder.build(spark, str(folder / "c.toml"), incremental=True)
    assert (again["made"], again["written"], again["database_id"]) == (0, 0, first["database_id"])


def test_diff_and_exports(spark, built, tmp_path, capsys):
    folder, first = built
    other = builder.build(spark, str(folder / "d.toml"), incremental=True)
    assert other["made"] == 6
    changes = builder.diff(spark, first["manifest"], other["manifest"]).collect()
    assert sorted((r.face, r.change) for r in changes) == [(f, "changed") for f in range(6)]
    assert builder.diff(spark, first["manifest"], first["manifest"]).count() == 0
    db = container.Database(spark, first["manifest"])
    obj = builder.export_mesh(db, 0, 0, 0, "obj", 64).splitlines()
    corners = [tuple(map(float, line.split()[1:])) for line in obj if line.startswith("v ")]
    faces = [tuple(map(int, line.split()[1:])) for line in obj if line.startswith("f ")]
    assert len(corners) == 25 and len(faces) == 32 and {i for f in faces for i in f} == set(range(1, 26))
    assert all(abs(np.linalg.norm(c) - 1737400) < 3000 for c in corners)
    # Triangles turn the same way, outwards.
    a, b, c = (np.array([corners[f[k] - 1] for f in faces]) for k in range(3))
    turn = np.einsum("ij,ij->i", np.cross(b - a, c - a), a)
    assert (turn > 0).all() or (turn < 0).all()
    ply = builder.export_mesh(db, 0, 0, 0, "ply", 64)
    assert "element vertex 25" in ply and "element face 32" in ply
    builder.export_csv(db, str(tmp_path / "csv"))
    back = spark.read.option("header", True).option("inferSchema", True).csv(str(tmp_path / "csv"))
    want = db.samples().agg(F.count("*"), F.sum("code")).first()
    assert (back.count(), back.agg(F.sum((F.col("metres") + 16384) * 2)).first()[0]) == tuple(want)
    assert cli.main(["export", first["manifest"], "--tile", "QSC/F1/L00/0000/0000", "--format", "raw", "--output", str(tmp_path / "t.raw")]) == 0
    assert len((tmp_path / "t.raw").read_bytes()) == 259 * 259 * 2
    assert cli.main(["export", first["manifest"], "--tile", "QSC/F1/L00/0000/0000", "--output", str(tmp_path / "t.csv")]) == 0
    assert cli.main(["diff", first["manifest"], other["manifest"]]) == 0 and "changed 5/0/0" in capsys.readouterr().out
    assert cli.main(["export", first["manifest"], "--tile", "QSC/F1/L01/0000/0000", "--format", "raw", "--output", str(tmp_path / "x")]) == 1


GRID = "ncols 4\nnrows 3\nxllcorner 9.5\nyllcorner -0.5\ncellsize 1\nnodata_value -9999\n20 21 22 23\n10 11 12 13\n0 1 2 -9999\n"


def test_grids(spark, tmp_path):
    (tmp_path / "a.asc").write_text(GRID)
    c = grids.catalog(spark, str(tmp_path))
    row = c.first()
    assert (row.rows, row.cols, row.west, row.south, row.cell, row.no_data, row.bytes) == (3, 4, 10.0, 0.0, 1.0, -9999.0, len(GRID))
    v = grids.values(spark, str(tmp_path))
    assert v.count() == 11 and v.filter("row = 0 and col = 2").first().value == 2
    points = spark.createDataFrame([(1, 0.5, 10.25), (2, 2.0, 13.0), (3, 0.5, 12.5), (4, 1.0, 12.5), (5, 5.0, 11.0), (6, 0.0, 10.0), (7, None, 1.0)], "id long, lat double, lon double")
    for most in (10, 0):
        got = {r.id: r.value for r in grids.sample(points, c, v, most).collect()}
        assert {k: round(x, 9) for k, x in got.items()} == {1: 5.25, 2: 23.0, 4: 12.5, 6: 0.0}
    for bad in ("ncols 2\nnrows 1\n1 2", "ncols 2\nnrows 1\nxllcorner 0\nyllcorner 0\ncellsize 1\n1", "ncols 2\nnrows 1\nxllcorner 0\nyllcorner 0\ncellsize 0\n1 2"):
        with pytest.raises(ValueError):
            grids.parse(bad.encode())


def lattice(spark, tiles, level, cells=4):
    """Samples of tiles of a level from one function on the sphere."""
    rows = [(f, level, int(m), y, x) for f, m in tiles for y in range(cells + 1) for x in range(cells + 1)]
    from facetlake.functions import keys, projection

    df = spark.createDataFrame(rows, "face int, level int, morton long, y int, x int")
    span = cells * 2**level
    at = {n: (2 * (t(F.col("morton")) * cells + F.col(k)) - span) / F.lit(float(span)) for n, t, k in (("u", keys.x_of, "x"), ("v", keys.y_of, "y"))}
    return sampled(projection.inverse(df.withColumns(at))).select("face", "level", "morton", "y", "x", "code")


def sampled(rows):
    from facetlake.functions import projection

    rows = rows if "lat" in rows.columns else projection.inverse(rows)
    return rows.withColumn("code", F.round(30000 + 9000 * (F.sin("lat") + F.cos("lat") * F.cos("lon"))).cast("int"))


def test_apron_beside_no_tile(spark):
    tiles = [(f, m) for f in range(6) for m in range(16)]
    whole = raster.with_apron(lattice(spark, tiles, 2), 4)
    some = [(0, 0), (0, 3), (2, 5), (2, 10), (4, 0), (5, 15)]
    names = ["face", "level", "morton", "y", "x", "code"]
    alone = raster.with_apron(lattice(spark, some, 2), 4)
    asked = raster.with_apron(lattice(spark, some, 2), 4, sampled)
    there = spark.createDataFrame(some, "face int, morton long")
    want = sorted(map(tuple, whole.join(there, ["face", "morton"], "left_semi").select(*names).collect()))
    got = sorted(map(tuple, asked.select(*names).collect()))
    assert len(want) == 6 * 49 == len(got)
    # A sample on two faces may round differently; all others are the same.
    assert sum(a != b for a, b in zip(want, got)) <= 2 and [a[:5] for a in want] == [a[:5] for a in got]
    assert alone.count() < len(got) and whole.groupBy("face", "morton").count().filter("count = 49").count() == 96


def test_seams_of_all_levels(spark):
    rng = np.random.default_rng(3)
    tiles = [(f, m) for f in range(6) for m in range(4)]
    noisy = [(f, 1, m, y, x, int(rng.integers(0, 60000))) for f, m in tiles for y in range(5) for x in range(5)]
    df = spark.createDataFrame(noisy, "face int, level int, morton long, y int, x int, code int")
    fixed = raster.resolve_seams(df, 4)
    assert fixed.count() == len(noisy)
    s = raster.seams(fixed, 4)
    # 24 tiles have 48 shared edges of 5 samples, which now agree.
    assert s.count() == 48 * 5 and s.filter("code <> nbr_code").count() == 0
    assert raster.seams(df, 4).filter("code <> nbr_code").count() > 200
    inside = df.filter("x between 1 and 3 and y between 1 and 3")
    assert inside.exceptAll(fixed).count() == 0


def plain_balance(leaves, deepest):
    from facetlake.functions.topology import ROWS

    meets = {(f, e): (nf, ne, r) for f, e, nf, ne, r in ROWS}
    leaves = set(leaves)

    def over(f, lv, x, y, e):
        n = (1 << lv) - 1
        dx, dy = ((-1, 0), (1, 0), (0, -1), (0, 1))[e]
        if 0 <= x + dx <= n and 0 <= y + dy <= n:
            return f, x + dx, y + dy
        nf, ne, rev = meets[f, e]
        along = y if e < 2 else x
        along = n - along if rev else along
        return nf, *{0: (0, along), 1: (n, along), 2: (along, 0), 3: (along, n)}[ne]

    while True:
        split = set()
        for f, lv, x, y in leaves:
            for e in range(4):
                nf, nx, ny = over(f, lv, x, y, e)
                for up in range(2, lv + 1):
                    if (nf, lv - up, nx >> up, ny >> up) in leaves:
                        split.add((nf, lv - up, nx >> up, ny >> up))
        if not split:
            return leaves
        for f, lv, x, y in split:
            leaves.remove((f, lv, x, y))
            leaves |= {(f, lv + 1, 2 * x + i, 2 * y + j) for i in (0, 1) for j in (0, 1)}


def test_balance(spark):
    from facetlake.functions import keys

    leaves = [(0, 0, 0, 0), (1, 4, 0, 7), (2, 1, 1, 1), (3, 0, 0, 0), (5, 1, 0, 0), (5, 3, 7, 7)]
    df = spark.createDataFrame(leaves, "face int, level int, x long, y long").withColumn("morton", keys.morton(F.col("x"), F.col("y")))
    out = index.balanced(df, 4).withColumns({"x": keys.x_of(F.col("morton")), "y": keys.y_of(F.col("morton"))}).collect()
    assert {(r.face, r.level, r.x, r.y) for r in out} == plain_balance(leaves, 4)
    assert {(r.face, r.level, r.x, r.y) for r in out if not r.derived} <= set(leaves)


def test_running_sums_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(index, "WINDOW_BITS", 2)
    rng = np.random.default_rng(5)
    rows = sorted({(int(f), 4, int(m)) for f, m in zip(rng.integers(0, 3, 200), rng.integers(0, 256, 200))})
    rows = [(f, lv, m, int(rng.integers(0, 50))) for f, lv, m in rows]
    df = spark.createDataFrame(rows, "face int, level int, morton long, stored_bytes long").repartition(4)
    total: dict = {}
    want = []
    for f, lv, m, n in rows:
        want.append((f, m, total.get(f, 0) // 100))
        total[f] = total.get(f, 0) + n
    assert sorted((r.face, r.morton, r.pack_part) for r in index.pack_groups(df, 100, deepest=4).collect()) == want
    assert [r.pack_id for r in index.pack_ids(df, 4).orderBy("face", "level", "morton").collect()] == list(range(len(rows)))


def test_numbers_from_bytes(spark):
    import struct

    doubles = [0.0, -0.0, 1.5, -1e300, 5e-324, 2.2e-308, float("inf"), float("-inf"), 1737400.25]
    rows = [(i, struct.pack("<dfQ", d, np.float32(min(max(d, -3e38), 3e38)) if np.isfinite(d) else d, (1 << 64) - 1 - i)) for i, d in enumerate(doubles)] + [(99, struct.pack("<df", float("nan"), float("nan"))), (100, None)]
    df = spark.createDataFrame(rows, "i int, b binary")
    out = {r.i: r for r in df.select("i", hashing.float_from_le(F.col("b"), 0, 8).alias("d"), hashing.float_from_le(F.col("b"), 8, 4).alias("f"), hashing.from_le(F.col("b"), 12, 8).alias("u")).collect()}
    for i, d in enumerate(doubles):
        assert struct.pack("<d", out[i].d) == struct.pack("<d", d) and int(out[i].u) == (1 << 64) - 1 - i
        assert np.float32(out[i].f) == np.float32(struct.unpack("<f", rows[i][1][8:12])[0])
    assert np.isnan(out[99].d) and np.isnan(out[99].f) and out[99].u is None and out[100].d is None


@pytest.mark.parametrize("n", [0, 1, 2, 3, 9, 1023, 1024, 1025, 2049, 5001, 70001])
def test_crc32c_of_any_length(n):
    data = np.random.default_rng(n).integers(0, 256, n).astype(np.uint8).tobytes()
    crc = 0xFFFFFFFF
    for b in data:
        crc ^= b
        for _ in range(8):
            crc = crc >> 1 ^ (hashing.CASTAGNOLI if crc & 1 else 0)
    assert hashing.crc32c(data) == crc ^ 0xFFFFFFFF


def test_to_elevation_and_levels(spark):
    from facetlake.functions import elevation

    df = spark.createDataFrame([(1737401.5, 1), (12.0, 0), (None, 1)], "v double, f int")
    assert [r[0] for r in df.select(elevation.to_elevation(F.col("v"), F.col("f"))).collect()] == [1.5, 12.0, None]
    levels = spark.createDataFrame([(r,) for r in (1e9, 10661.0, 10660.0, 5000.0, 1.0, 0.0, -1.0, None)], "r double")
    assert [r[0] for r in levels.select(index.adequate_level(F.col("r"))).collect()] == [0, 0, 1, 2, 14, None, None, None]
