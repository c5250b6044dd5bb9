"""Keys, topology, projection, elevations, hashes and checks on known values."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from facetlake.functions import checks, elevation, hashing, keys, projection, topology


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_morton_and_key(spark):
    r = one(spark, keys.morton(F.lit(5), F.lit(3)).alias("m"), keys.x_of(F.lit(27)).alias("x"), keys.y_of(F.lit(27)).alias("y"))
    assert (r.m, r.x, r.y) == (27, 5, 3)
    big = (1 << 28) - 1
    r = one(spark, keys.x_of(keys.morton(F.lit(big), F.lit(0))).alias("x"), keys.morton(F.lit(big), F.lit(big)).alias("m"))
    assert (r.x, r.m) == (big, (1 << 56) - 1)
    r = one(spark, keys.key_hex(F.lit(2), F.lit(8), keys.morton(F.lit(147), F.lit(92))).alias("k"), keys.text(F.lit(2), F.lit(8), F.lit(147), F.lit(92)).alias("t"))
    assert (r.k, r.t) == ("48000000000063a5", "QSC/F2/L08/0147/0092")
    for face in range(6):
        k = keys.from_hex(keys.key_hex(F.lit(face), F.lit(28), F.lit(123456789)))
        assert tuple(one(spark, keys.face_of(k), keys.level_of(k), keys.morton_of(k))) == (face, 28, 123456789)


@pytest.mark.parametrize("key,ok", [((6, 0, 0, 0), False), ((0, 29, 0, 0), False), ((0, 0, 1, 0), False), ((0, 8, 256, 0), False), ((5, 8, 255, 255), True), ((None, 0, 0, 0), False)])
def test_validity(spark, key, ok):
    assert one(spark, keys.valid(*(F.lit(x).cast("int") for x in key)).alias("ok")).ok is ok


@pytest.mark.parametrize("text,ok", [("QSC/F2/L08/0147/0092", True), ("QSC/F2/L8/0147/0092", False), ("QSC/F2/L08/147/0092", False), ("qsc/F2/L08/0147/0092", False), ("QSC/F2/L08/0147/0092/x", False), ("QSC/F2/L08/00147/0092", False), ("QSC/F2/L15/12345/0000", True), ("", False), (None, False)])
def test_parse(spark, text, ok):
    assert (one(spark, keys.parse(F.lit(text).cast("string")).alias("p")).p is not None) is ok


def test_children_and_parent(spark):
    c = one(spark, keys.children(F.lit(7), keys.morton(F.lit(11), F.lit(29))).alias("c")).c
    xy = [tuple(one(spark, keys.x_of(F.lit(r.morton)), keys.y_of(F.lit(r.morton)))) for r in c]
    assert xy == [(22, 58), (23, 58), (22, 59), (23, 59)]
    level, m = keys.parent(F.lit(8), F.lit(c[3].morton))
    assert tuple(one(spark, level, m)) == (7, one(spark, keys.morton(F.lit(11), F.lit(29)).alias("m")).m)
    level, m = keys.parent(F.lit(0), F.lit(0))
    assert tuple(one(spark, level, m)) == (None, None)
    assert one(spark, keys.children(F.lit(28), F.lit(0)).alias("c")).c is None


def test_neighbors(spark):
    rows = topology.neighbors(spark.createDataFrame([(1, 3, 5, 0), (0, 3, 3, 4)], "face int, level int, x long, y long"))
    got = {(r.face, r.edge): (r.nbr_face, r.nbr_x, r.nbr_y, r.touching, r.reversed) for r in rows.collect()}
    assert got[(1, 2)] == (5, 7, 2, 1, True)
    assert got[(0, 0)] == (0, 2, 4, 1, False)


def test_edges_are_mutual():
    by = {r[:2]: r[2:] for r in topology.ROWS}
    assert len(by) == 24
    for (f, e), (nf, ne, rev) in by.items():
        assert by[(nf, ne)] == (f, e, rev)


def test_corner_owner(spark):
    r = one(spark, topology.corner_owner(F.lit(4), F.lit(0), F.lit(2)).alias("a"), topology.corner_owner(F.lit(5), F.lit(1), F.lit(3)).alias("b"))
    assert (r.a, r.b) == (0, 0)


def test_lattice(spark):
    at = lambda t, i, lv: one(spark, projection.lattice(F.lit(t), F.lit(i), F.lit(lv)).alias("u")).u
    assert at(0, 0, 8) == -1.0 and at(255, 256, 8) == 1.0 and at(146, 256, 8) == at(147, 0, 8)
    assert at(256, 0, 8) is None and at(0, 257, 8) is None


def test_round_trip(spark):
    pts = [(f, u, v) for f in range(6) for u, v in ((0.0, 0.0), (0.25, -0.5), (-0.75, 0.125), (0.6, 0.8), (-1.0, 0.3))]
    geo = projection.inverse(spark.createDataFrame(pts, "face int, u double, v double")).withColumnsRenamed({"face": "f0", "u": "u0", "v": "v0"})
    for r in projection.forward(geo).collect():
        if abs(r.u0) < 1:
            assert r.face == r.f0 and abs(r.u - r.u0) < 2e-14 and abs(r.v - r.v0) < 2e-14


def test_poles_and_ties(spark):
    h = math.pi / 2
    pts = [(h, 1.0), (-h, 2.0), (0.0, 3 * math.pi), (math.pi / 4, 0.0), (math.asin(1 / math.sqrt(3)), math.pi / 4), (2.0, 0.0), (None, 0.0), (float("nan"), 0.0)]
    got = [(r.face, r.u, r.v) for r in projection.forward(spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "i int, lat double, lon double")).orderBy("i").collect()]
    assert got[0] == (4, 0.0, 0.0) and got[1] == (5, 0.0, 0.0)
    assert [g[0] for g in got[2:]] == [2, 0, 0, None, None, None]
    back = projection.inverse(spark.createDataFrame([(4, 0.0, 0.0), (5, 0.0, 0.0), (6, 0.0, 0.0), (0, 1.5, 0.0)], "face int, u double, v double")).select("lat", "lon").collect()
    assert [tuple(r) for r in back] == [(h, 0.0), (-h, 0.0), (None, None), (None, None)]


def test_elevation(spark):
    q = lambda e: one(spark, elevation.quantize(F.lit(e).cast("double")).alias("q")).q
    assert q(-16384.0) == 0 and q(-16384.0 + 1.25) == 2 and q(-16384.0 + 1.75) == 4 and q(16383.5) == 65535
    assert q(-16384.1) is None and q(16384.0) is None and q(float("nan")) is None and q(None) is None
    r = one(spark, elevation.dequantize(F.lit(3)).alias("d"), elevation.millimetres(F.lit(0.0005)).alias("m"), elevation.millimetres(F.lit(-1.0)).alias("n"))
    assert (r.d, r.m, r.n) == (-16382.5, 1, None)


def test_hashes(spark):
    assert hashing.crc32c(b"123456789") == 0xE3069283
    r = one(spark, F.sha2(F.lit("abc"), 256).alias("s"), hashing.dataset_id(F.lit("fixture.dem.v1")).alias("d"), hashing.from_le(hashing.le(F.lit(305419896), 4), 0, 4).alias("n"))
    assert r.s.startswith("ba7816bf") and r.s.endswith("15ad") and r.d == 1666136 and r.n == 305419896
    data = bytes(range(100))
    assert one(spark, hashing.zeroed_hash(F.lit(data), 48, 16).alias("h")).h == hashlib.sha256(data[:48] + bytes(16) + data[64:]).hexdigest()
    rows = hashing.with_crc32c(spark.createDataFrame([("123456789",), (None,), ("",)], "t string"), "t").collect()
    assert [x.crc32c for x in rows] == [0xE3069283, None, 0]


def test_checks(spark):
    ok = lambda c: one(spark, c.alias("ok")).ok
    assert ok(checks.range_fits(F.lit(5), F.lit(5), F.lit(10))) and not ok(checks.range_fits(F.lit(6), F.lit(5), F.lit(10)))
    assert not ok(checks.range_fits(F.lit(2**62), F.lit(2**62 + 2**61), F.lit(2**62 + 5)))
    for p, good in (("a/b.ltp", True), ("/a", False), ("a//b", False), ("a/..", False), ("./a", False), ("C:a", False), ("a\\b", False), ("", False), (None, False)):
        assert ok(checks.portable_path(F.lit(p).cast("string"))) is good, p
    assert ok(checks.portable_name(F.lit("a-b_c.1"))) and not ok(checks.portable_name(F.lit("..")))
    assert ok(checks.plain_text(F.lit("é".encode()))) and not ok(checks.plain_text(F.lit(b"\xc0\x80"))) and not ok(checks.plain_text(F.lit(b"a\0")))
    assert ok(checks.json_object(F.lit('{"a":1}'))) and not ok(checks.json_object(F.lit("{a"))) and not ok(checks.json_object(F.lit("[1]")))
    assert ok(checks.only_flags(F.lit(3), 3)) and not ok(checks.only_flags(F.lit(4), 3)) and not ok(checks.finite(F.lit(float("inf"))))
    assert ok(checks.has_magic(F.lit(b"LTDBxx"), "LTDB")) and ok(checks.all_zero(F.lit(bytes(3)))) and not ok(checks.all_zero(F.lit(b"\0\1")))
    assert ok(checks.error_name(F.lit(13))) == "not_found" and ok(checks.error_name(F.lit(99))) == "unknown"
