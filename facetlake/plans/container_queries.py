"""Queries over a container that is built from a configuration, published, and read again."""

from __future__ import annotations

import tempfile
from functools import lru_cache
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetlake.operators import raster
from facetlake.plans.carriers import TOPOLOGY, query, table
from facetlake.plans.key_queries import inverse_sql
from facetlake.plans.registry_queries import _framed
from facetlake.sources import builder, config, container
from facetlake.sources.layout import ELEV, sha

NAME, KEY = "Queries", "synthetic.p0.v1"
#: SQL for the terrain's amplitude, which follows the data.
AMPLITUDE = "(select 2000 + count(*) from nation)"
CELLS = builder.CELLS


def _folder(spark: SparkSession) -> Path:
    """Where the container is published: below the shared folder if that is a plain one, else a folder of this machine, for a local session."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared and (shared.startswith("file:") or "://" not in shared):
        return Path(shared.removeprefix("file://").removeprefix("file:")) / f"container-{spark.sparkContext.applicationId}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("the container is published to a folder that all executors see as a plain one")
    return Path(tempfile.gettempdir()) / f"facetlake-container-{spark.sparkContext.applicationId}"


@lru_cache(4)
def _built(folder: Path, amplitude: int) -> str:
    spark = SparkSession.getActiveSession()
    folder = folder / str(amplitude)
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "build.toml").write_text(f'[database]\nname = "{NAME}"\n[synthetic]\namplitude_meters = {amplitude}\n')
    return builder.build(spark, str(folder / "build.toml"))["manifest"]


def database(spark, sf_dir) -> container.Database:
    return container.Database(spark, f"file://{_built(_folder(spark), 2000 + table(spark, sf_dir, 'nation', 'n_nationkey').count())}")


#: SQL for the synthetic rasters of the six faces with their seams resolved (fixed) and with their aprons (ring, corner).
RASTERS = f"""uv as (select (i // 66049)::int face, i % 257 x, (i // 257) % 257 y, (2 * (i % 257) - 256) / 256.0::double u, (2 * ((i // 257) % 257) - 256) / 256.0::double v from range(396294) t(i)), {inverse_sql("uv")},
raw as (select face, y, x, round_even(({AMPLITUDE} * (0.55::double * sin(lat) + 0.25::double * cos(lat) * cos(lon) * cos(lat) * sin(lon) + 0.20::double * (cos(lat) * cos(lon) * cos(lat) * cos(lon) - cos(lat) * sin(lon) * cos(lat) * sin(lon))) + 16384) / 0.5::double, 0)::int code from geo),
edges as (select face, 0 edge, y p, code from raw where x = 0 union all select face, 1, y, code from raw where x = {CELLS} union all select face, 2, x, code from raw where y = 0 union all select face, 3, x, code from raw where y = {CELLS}),
better as (select a.face, case a.edge when 0 then 0 when 1 then {CELLS} else a.p end x, case a.edge when 2 then 0 when 3 then {CELLS} else a.p end y, t.nf own_face, b.code own
  from edges a join topo t on t.face = a.face and t.edge = a.edge and t.nf < a.face join edges b on b.face = t.nf and b.edge = t.ne and b.p = case when t.rev then {CELLS} - a.p else a.p end),
fixed as (select g.face, g.y, g.x, coalesce(b.own, g.code) code from raw g left join (select face, x, y, arg_min(own, own_face) own from better group by all) b using (face, x, y)),
inner_ as (select face, 0 edge, code from fixed where x = 1 union all select face, 1, code from fixed where x = {CELLS} - 1 union all select face, 2, code from fixed where y = 1 union all select face, 3, code from fixed where y = {CELLS} - 1),
whole as (select face, code from fixed union all select t.face, i.code from topo t join inner_ i on i.face = t.nf and i.edge = t.ne union all select face, code from fixed where x in (0, {CELLS}) and y in (0, {CELLS}))"""
DATASET = f"(select ('0x' || substr(h, 7, 2) || substr(h, 5, 2) || substr(h, 3, 2) || substr(h, 1, 2))::bigint from (select {_framed('LTDB_DATASET_V1', f"'{KEY}'")} h))"
HEX = "lpad(lower(to_hex(face::ubigint << 61)), 16, '0')"


@query("select 1737400.0::double radius, (-16384.0)::double origin, 0.5::double step, 256 cells, 257 core, 1 apron, 0 max_level, 6 tiles, 1 datasets, 6 packs, 5 chunks")
def container_header(spark, sf_dir) -> DataFrame:
    h = database(spark, sf_dir).header
    row = (h.radius, h.origin, h.step, h.cells, h.core, h.apron, h.max_level, h.tile_count, h.dataset_count, h.pack_count, h.chunk_count)
    return spark.createDataFrame([row], "radius double, origin double, step double, cells int, core int, apron int, max_level int, tiles int, datasets int, packs int, chunks int")


@query("""select * from (values ('DSET', 1, 3, 128), ('META', 1, 3, null), ('PACK', 1, 3, 6 * 80), ('STRS', 1, 3, null), ('TIDX', 1, 3, 6 * 80)) t(tag, version, flags, record_bytes)""")
def container_chunks(spark, sf_dir) -> DataFrame:
    """Chunks, whose checksums, order, padding and ranges were checked when the manifest was opened; the bytes of those of fixed records."""
    c = database(spark, sf_dir).table("chunks")
    size = F.when(F.col("tag").isin("DSET", "PACK", "TIDX") & (F.col("stored_bytes") == F.col("logical_bytes")), F.col("stored_bytes"))
    return c.select("tag", "version", "flags", size.cast("int").alias("record_bytes"))


@query(f"select unnest(['', 'Analytic terrain', 'Made by rule', '1', 'facetlake', 'QSC_v1', 'synthetic://analytic-v1', {', '.join(f"'Packs/F{f}'" for f in range(6))}]) as text")
def container_strings(spark, sf_dir) -> DataFrame:
    """The string table; names of packs without the identity in them."""
    return database(spark, sf_dir).table("strings").select(F.regexp_replace("text", f"^Packs/{NAME}_[0-9a-f]{{32}}_(F[0-5])_L00_P0000.ltp$", "Packs/$1").alias("text"))


@query(f"""select {DATASET} dataset_id, 0::bigint flags, 'Analytic terrain' product, 'facetlake' producer, 'synthetic://analytic-v1' source_uri, 10000.0::double resolution_m, null::double no_data, '{KEY}' stable_key, {AMPLITUDE} amplitude""")
def container_datasets(spark, sf_dir) -> DataFrame:
    """The dataset registry, whose hash was checked when the manifest was opened; the amplitude is told by the bundle's size and hash."""
    db = database(spark, sf_dir)
    size = F.octet_length(F.format_string('{"amplitude_meters":%d,"formula":"analytic_unit_vector_v1","version":1}', F.lit(2000 + table(spark, sf_dir, "nation", "n_nationkey").count())))
    told = F.when(F.col("bundle_bytes") == size, F.lit(2000) + F.lit(table(spark, sf_dir, "nation", "n_nationkey").count()))
    return db.table("datasets").select("dataset_id", "flags", "product", "producer", "source_uri", "resolution_m", "no_data", F.get_json_object("metadata", "$.stable_key").alias("stable_key"), told.alias("amplitude"))


@query(f"select face pack_id, 1 codec, 1::bigint tile_count, {HEX} first_key, {HEX} last_key, true bytes_fit from range(6) t(face)")
def container_packs(spark, sf_dir) -> DataFrame:
    db = database(spark, sf_dir)
    tiles = db.table("tiles").select(F.col("pack_id").alias("_p"), (F.col("payload_offset") + F.col("stored_bytes")).alias("_end"))
    own = db.table("packs").join(tiles, F.col("pack_id") == F.col("_p"))
    return own.select("pack_id", "codec", "tile_count", "first_key", "last_key", (F.col("_end") == F.col("file_bytes")).alias("bytes_fit"))


@query(f"""with {TOPOLOGY}, {RASTERS} select face, 0::int as level, 0::bigint morton, {HEX} key_hex, face::bigint pack_id, 1::bigint flags, 64::bigint payload_offset, (259 * 259 * 2 + 32)::bigint logical_bytes, min(code) min_code, max(code) max_code,
  {DATASET} primary_dataset, 10000000::bigint resolution_mm, 0::bigint error_mm, 0::int child_mask, 2::int channel_count from whole group by face""")
def container_tiles(spark, sf_dir) -> DataFrame:
    names = "face level morton key_hex pack_id flags payload_offset logical_bytes min_code max_code primary_dataset resolution_mm error_mm child_mask channel_count".split()
    return database(spark, sf_dir).table("tiles").select(*names)


@query(f"with {TOPOLOGY}, {RASTERS} select face, count(*) n, sum(code)::bigint total, bit_xor(code::bigint) mixed from whole group by face")
def container_samples(spark, sf_dir) -> DataFrame:
    """The decoded elevation of all tiles, aprons included: payloads, checksums, predictors and content hashes are checked on the way."""
    return database(spark, sf_dir).samples().groupBy("face").agg(F.count("*").alias("n"), F.sum("code").alias("total"), F.bit_xor(F.col("code").cast("long")).alias("mixed"))


@query(f"""select {HEX} key_hex, * from range(6) t(face), (values (1, 2, 1, 1, 259, 259, 259 * 259 * 2), (2, 255, 1, 0, 0, 0, 32)) c(channel_id, element, codec, predictor, width, height, bytes)""".replace(", * from range(6)", ", channel_id, element, codec, predictor, width, height, bytes from range(6)"))
def container_channels(spark, sf_dir) -> DataFrame:
    return database(spark, sf_dir).channels().filter("error is null").select("key_hex", "channel_id", "element", "codec", "predictor", "width", "height", F.octet_length("data").alias("bytes"))


@query(f"select face::int face, 0::bigint pos, {DATASET} dataset_id, 1.0::float fraction, 10000.0::float resolution_m, false has_map from range(6) t(face)")
def container_provenance(spark, sf_dir) -> DataFrame:
    own = database(spark, sf_dir).provenance()
    return own.select("face", F.posexplode("palette").alias("pos", "e"), F.col("map").isNotNull().alias("has_map")).select("face", F.col("pos").cast("long").alias("pos"), "e.dataset_id", "e.fraction", "e.resolution_m", "has_map")


_SEMANTIC = f"""'{{"algorithm_version":1,"datasets":[{{"amplitude_meters":' || {AMPLITUDE} || ',"source_uri":"synthetic://analytic-v1","stable_key":"{KEY}"}}],"datum":{{"elevation_origin_m":-16384,"elevation_step_m":0.5,"reference_radius_m":1737400}},"fusion":{{"algorithm":"synthetic_analytic_v1","version":1}},"projection":{{"id":1,"version":1}},"quantization":{{"id":1}},"tiles":{{"apron":1,"cells":256,"maximum_level":0}}}}'"""
_BUILDER = f"""'{{"package":{{"codec":"zstd","codec_level":3,"format_major":1,"format_minor":0,"name":"{NAME}","pack_naming_policy":"database_id_v1","target_pack_bytes":1073741824}},"semantic":' || {_SEMANTIC} || '}}'"""


@query(f"with j as (select {_SEMANTIC} s, {_BUILDER} b) select {_framed('LTDB_SEMANTIC_CONFIG_V1', 's')} semantic, {_framed('LTDB_BUILDER_CONFIG_V1', 'b')} builder, {DATASET} dataset_id, true same_in_header, true id_follows from j")
def container_identities(spark, sf_dir) -> DataFrame:
    db = database(spark, sf_dir)
    i = config.identify(config.load(Path(db.path.removeprefix("file://")).with_name("build.toml")))
    h = db.header
    follows = sha("LTDB_DATABASE_ID_V1", h.builder_hash, h.registry_hash)[:16] == h.database_id
    return spark.createDataFrame([(i.semantic_hash.hex(), i.builder_hash.hex(), i.dataset_id, h.builder_hash == i.builder_hash, follows)], "semantic string, builder string, dataset_id long, same_in_header boolean, id_follows boolean")


@query("select 6 tiles, 6 packs, 1 datasets, 12 seams, 0::bigint violations")
def container_validate(spark, sf_dir) -> DataFrame:
    """Every tile decoded and checked, hierarchy warnings counted, and the seams of the roots compared."""
    db = database(spark, sf_dir)
    out = builder.validate(spark, db.path, full=True)
    bad = builder.violations(db).agg(F.count("*").alias("violations"))
    return bad.select(*[F.lit(out[k]).alias(k) for k in ("tiles", "packs", "datasets", "seams")], "violations")


@query("select * from (values (0, true), (1, false)) t(level, there)")
def container_find(spark, sf_dir) -> DataFrame:
    """A key that is there and one that is not; subtree, children and leaves of the one agree with it."""
    db = database(spark, sf_dir)
    rows = [(0, db.find(3, 0, 0) is not None and db.subtree(3, 0, 0).count() == db.leaves(3, 0, 0).count() == db.leaves(3, 0, 0, True).count() == 1 and db.children(3, 0, 0).count() == 0)]
    return spark.createDataFrame([*rows, (1, db.find(3, 1, 0) is not None)], "level int, there boolean")


@query(f"with {TOPOLOGY}, {RASTERS} select face, min(code) lo, max(code) hi from fixed group by face")
def container_raw_tile(spark, sf_dir) -> DataFrame:
    """The core of each tile, read one by one and as raw bytes."""
    db, rows = database(spark, sf_dir), []
    for face in range(6):
        codes = np.frombuffer(db.read_tile(face, 0, 0)[ELEV], "<u2").reshape(259, 259)[1:-1, 1:-1]
        rows.append((face, int(codes.min()), int(codes.max())))
    return spark.createDataFrame(rows, "face int, lo int, hi int")


@query(f"""with {TOPOLOGY}, {RASTERS}, p as (select i.face, i.y, i.x, f.code, lat, lon from geo i join fixed f on f.face = i.face and f.y = i.y and f.x = i.x where i.face = 4 and i.y % 64 = 0 and i.x % 64 = 0)
select y::int j, x::int i, round((1737400 - 16384.0::double + code * 0.5::double) * cos(lat) * cos(lon))::bigint px, round((1737400 - 16384.0::double + code * 0.5::double) * cos(lat) * sin(lon))::bigint py, round((1737400 - 16384.0::double + code * 0.5::double) * sin(lat))::bigint pz from p""")
def container_points(spark, sf_dir) -> DataFrame:
    """Corners of an exported mesh, every 64th sample of a tile's core, in whole metres."""
    p = builder.points(database(spark, sf_dir), 4, 0, 0, 64)
    return p.select("j", "i", *[F.round(c).cast("long").alias(c) for c in ("px", "py", "pz")])


@query(f"with {TOPOLOGY}, {RASTERS} select count(*) samples, 0::bigint mismatches from edges e join topo t using (face, edge) where t.face < t.nf")
def container_seams(spark, sf_dir) -> DataFrame:
    core = database(spark, sf_dir).samples().filter(f"x between 1 and {CELLS + 1} and y between 1 and {CELLS + 1}").withColumns({"x": F.col("x") - 1, "y": F.col("y") - 1})
    s = raster.seams(core, CELLS)
    return s.agg(F.count("*").alias("samples"), F.count_if(F.col("code") != F.col("nbr_code")).alias("mismatches"))
