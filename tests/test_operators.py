"""Index, raster, registry and fusion operators on small tables."""

import random

import numpy as np
from pyspark.sql import functions as F

from facetlake.operators import fusion, index, raster, registry
from facetlake.streaming import ingest

TILE = "face int, level int, morton long"


def test_empty_index(spark):
    empty = spark.createDataFrame([], f"{TILE}, code int")
    idx = index.build_index(empty)
    assert idx.count() == index.orphans(idx).count() == index.leaves(idx).count() == index.child_masks(idx).count() == 0


def test_hierarchy(spark):
    rows = [(0, 0, 0), (0, 1, 2), (0, 2, 9), (0, 3, 63), (4, 0, 0), (5, 28, (1 << 56) - 1)]
    idx = spark.createDataFrame(rows, TILE)
    keys = lambda df: sorted(tuple(r) for r in df.select("face", "level", "morton").collect())
    assert keys(index.orphans(idx)) == [(0, 3, 63), (5, 28, (1 << 56) - 1)]
    assert keys(index.leaves(idx)) == [(0, 2, 9), (0, 3, 63), (4, 0, 0), (5, 28, (1 << 56) - 1)]
    assert keys(index.subtree(idx, 0, 1, 2)) == [(0, 1, 2), (0, 2, 9)]
    assert keys(index.subtree(idx, 5, 0, 0)) == [(5, 28, (1 << 56) - 1)]
    assert {r.morton: r.child_mask for r in index.with_child_mask(idx).filter("face = 0 and level < 2").collect()} == {0: 4, 2: 2}
    near = {r.morton: (r.anc_level, r.anc_morton) for r in index.nearest_ancestor(idx, idx).filter("face = 0").collect()}
    assert near == {2: (0, 0), 9: (1, 2), 63: (0, 0)}
    assert len(keys(index.with_ancestors(idx.filter("level = 28")))) == 29


def test_index_on_disk_is_pruned(spark, tmp_path):
    rows = [(f, lv, m, m) for f in range(6) for lv in (2, 3) for m in range(4**lv)]
    index.write_index(spark.createDataFrame(rows, f"{TILE}, v long"), str(tmp_path / "t"))
    got = index.subtree(spark.read.parquet(str(tmp_path / "t")), 3, 2, 7, 3)
    assert got.count() == 5
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "PushedFilters" in plan and "face" in plan.split("PartitionFilters")[1]


def test_diff(spark):
    a = spark.createDataFrame([(0, 1, 0, "x"), (0, 1, 1, "y"), (0, 1, 2, None)], f"{TILE}, digest string")
    b = spark.createDataFrame([(0, 1, 1, "z"), (0, 1, 2, None), (0, 1, 3, "w")], f"{TILE}, digest string")
    assert {r.morton: r.change for r in index.diff(a, b).collect()} == {0: "removed", 1: "changed", 3: "added"}
    assert sorted(r.morton for r in index.to_rebuild(b, a).collect()) == [1, 2, 3]


def raster_frame(spark, codes):
    h, w = codes.shape
    return spark.createDataFrame([(0, 0, 0, y, x, int(codes[y, x])) for y in range(h) for x in range(w)], f"{TILE}, y int, x int, code int")


def test_delta2d(spark):
    codes = np.array([[100, 101, 103], [99, 101, 104], [98, 102, 106]])
    out = raster.delta2d(raster_frame(spark, codes))
    got = {(r.y, r.x): r.residual for r in out.collect()}
    want = np.array([[100, 1, 2], [-1, 1, 1], [-1, 2, 1]]) % 65536
    assert all(got[(y, x)] == want[y, x] for y in range(3) for x in range(3))
    rng = random.Random(1)
    codes = np.array([[rng.randrange(65536) for _ in range(7)] for _ in range(5)])
    back = {(r.y, r.x): r.code for r in raster.undelta2d(raster.delta2d(raster_frame(spark, codes)).drop("code")).collect()}
    assert all(back[(y, x)] == codes[y, x] for y in range(5) for x in range(7))


def test_synthetic_faces_and_seams(spark):
    faces = raster.synthetic_faces(spark, 16, 2048).cache()
    assert faces.count() == 6 * 17 * 17 and faces.filter("code is null").count() == 0
    s = raster.seams(faces, 16)
    assert s.groupBy("face", "edge").count().count() == 12 and s.filter("code <> nbr_code").count() == 0
    broken = faces.withColumn("code", F.when((F.col("face") == 3) & (F.col("x") == 0), F.col("code") + 5).otherwise(F.col("code")))
    assert raster.seams(broken, 16).filter("code <> nbr_code").count() > 0
    assert raster.seams(raster.resolve_seams(broken, 16), 16).filter("code <> nbr_code").count() == 0
    ring = raster.with_apron(faces, 16)
    assert ring.count() == 6 * 19 * 19 == ring.select("face", "y", "x").distinct().count()


def test_low_pass_of_a_plane_inside(spark):
    codes = np.add.outer(3 * np.arange(9), 5 * np.arange(9))
    got = {(r.y, r.x): r.smooth for r in raster.low_pass(raster_frame(spark, codes), "code").collect()}
    assert all(abs(got[(y, x)] - codes[y, x]) < 1e-9 for y in range(2, 7) for x in range(2, 7))


def test_string_table(spark):
    rows = [("b",), ("a",), ("a",), ("",), (None,), ("éé",)]
    got = {r.text: r.string_id for r in registry.string_table(spark.createDataFrame(rows, "text string")).collect()}
    assert got == {"a": 4, "b": 12, "éé": 20}


def test_registry_rules(spark):
    rows = spark.createDataFrame([(1, 0, 10), (2, 5, 7), (3, 10, 12), (4, 15, 20)], "i int, a long, b long")
    assert [r.i for r in registry.overlapping(rows, "a", "b").collect()] == [2]
    assert [(r.i, r.gap) for r in registry.gaps(rows.filter("i <> 2"), "a", "b").collect()] == [(4, 3)]
    assert [r.i for r in registry.not_increasing(spark.createDataFrame([(1, 5), (2, 5), (3, 6), (4, 2)], "i int, v int"), "i", "v").orderBy("i").collect()] == [2, 4]
    pal = spark.createDataFrame([(1, [(7, 0.5), (8, 0.5)]), (2, [(7, 0.5), (8, 0.4)])], "t int, palette array<struct<dataset_id:long,fraction:float>>")
    assert [r.t for r in registry.contribution_errors(pal).collect()] == [2]
    d = registry.dominant(spark.createDataFrame([(1, 9, 0.4), (1, 3, 0.4), (1, 5, 0.2)], "t int, id long, f double"), ["t"], "id", "f").first()
    assert (d.dominant, d.share) == (3, 0.4)


def test_fusion(spark):
    rows = spark.createDataFrame([(1, 10, 5, 0), (1, 20, 4, 1), (1, 30, 3, 1), (2, 40, 9, 0)], "cell int, v long, d long, p int")
    assert {r.cell: (r.v, r.d) for r in fusion.replace(rows, ["cell"], "v", "d", "p").collect()} == {1: (30, 3), 2: (40, 9)}


def test_stream(spark, tmp_path):
    data = spark.sql("select timestamp'2024-01-01 00:10:00' + make_interval(0,0,0,0,i) ts, 0 face, 1 level, cast(i % 2 as long) morton, i code from (select explode(sequence(0, 9)) i)")
    data.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(data.schema).parquet(str(tmp_path / "in"))
    q = ingest.drain(ingest.windowed_index(stream), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() > 0 and got.agg(F.sum("n")).first()[0] <= 10
