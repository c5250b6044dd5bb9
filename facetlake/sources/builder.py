"""Scan, plan, build, validate and inspect: the verbs over a container.

The raster work is DataFrame code; tiles are encoded by the executors, one group for each tile.
The driver lays out packs and the manifest, and publishes them: packs first, the manifest last.
"""

from __future__ import annotations

import hashlib
import json
import os
import struct
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetlake.functions import elevation, keys, projection
from facetlake.functions.hashing import crc32c
from facetlake.operators import index, raster
from facetlake.sources import config, container
from facetlake.sources.layout import (
    CHANNEL, CHUNK, DATASET, ELEV, ENDIAN, HEADER, MANDATORY, PACK, PACK_HEADER, PALETTE, PROVENANCE, PRVN,
    QUAL, TILE, TILE_HEADER, Error, align, framed, require, sha,
)

CELLS, SIDE = 256, 259
TILE_BYTES = SIDE * SIDE * 2 + PROVENANCE.size + PALETTE.size


def dataset(c: config.Config) -> dict:
    """Registry entry of the synthetic source."""
    artifact = config.canonical({"amplitude_meters": c.amplitude, "formula": "analytic_unit_vector_v1", "version": 1}).encode()
    digest, name = hashlib.sha256(artifact).digest(), "synthetic/p0-v1.json"
    meta = {"artifact_members": [{"bytes": len(artifact), "name": name, "sha256": digest.hex()}], "datum": {"reference_radius_m": 1737400}, "elevation_representation": "elevation_meters", "metadata_overrides": {}, "no_data": "none", "stable_key": c.stable_key}
    strings = ["Analytic terrain", c.producer, "", "", "1", c.source_uri, c.crs, "Made by rule"]
    return {"id": config.dataset_id(c.stable_key), "flags": 0, "strings": strings, "doubles": [float(config.RESOLUTION), None, None, None], "bundle_bytes": len(artifact), "bundle_hash": config.bundle_hash([(name, len(artifact), digest)]), "meta": config.canonical(meta).encode(), "quality": 0}


def dependency_hash(key: int, semantic: bytes, d: dict) -> bytes:
    s = semantic.hex()
    #: Names, algorithms and versions of the document that the hash is taken of.
    doc = {
        "builder_algorithm_version": 1, "datum_version": "synthetic_datum_v1", "fusion": {"algorithm": "synthetic_analytic_v1", "configuration_sha256": s},
        "projection": {"id": 1, "implementation_version": 1}, "quantization": {"configuration_sha256": s, "id": 1}, "semantic_configuration_sha256": s,
        "sources": [{"artifact_bundle_sha256": d["bundle_hash"].hex(), "dataset_id": d["id"], "windows": []}], "tile_key": f"{key:016x}", "tile_schema_version": 1,
    }
    return framed("LTDB_TILE_DEP_V1", config.canonical(doc).encode())


def encode_tile(key: int, samples: np.ndarray, semantic: bytes, d: dict) -> tuple[bytes, int, int, bytes, bytes, int]:
    """Payload, code range, dependency and content hash, and logical bytes of a tile."""
    raw = samples.astype("<u2").tobytes()
    provenance = PROVENANCE.write(1, 1, 0, 0, 0, 0, 0, 0) + PALETTE.write(d["id"], 0, 1.0, float(config.RESOLUTION))
    channels = []
    for id_, element, predictor, shape, decoded, logical, p1 in ((ELEV, 2, 1, SIDE, raw, container.delta(samples), 1), (PRVN, 255, 0, 0, provenance, provenance, 0)):
        stored = container.deflate(logical)
        channels.append((CHANNEL.type(id_, 1, element, 1, 1, predictor, shape, shape, 1, 0, len(stored), len(logical), crc32c(stored), 3, p1), decoded, stored))
    content = container.content_hash(key, [(c, decoded) for c, decoded, _ in channels])
    dependency = dependency_hash(key, semantic, d)
    start = align(TILE_HEADER.size + len(channels) * CHANNEL.size)
    body, records = b"", b""
    for c, _, stored in channels:
        body += bytes(align(start + len(body)) - start - len(body))
        records += CHANNEL.write(**c._replace(offset=start + len(body))._asdict())
        body += stored
    lo, hi = int(samples.min()), int(samples.max())
    head = TILE_HEADER.write(b"LTIL", 1, TILE_HEADER.size, key, 1, len(channels), CELLS, CELLS + 1, 1, 1, float(config.RESOLUTION), 0.0, -16384 + lo * 0.5, -16384 + hi * 0.5, d["id"], 1, 0, TILE_HEADER.size, len(records), start, len(body), dependency[:16], content[:16], bytes(28))
    payload = head + records
    return payload + bytes(start - len(payload)) + body, lo, hi, dependency, content, sum(c.logical_bytes for c, _, _ in channels)


def encoded_tiles(spark: SparkSession, c: config.Config, faces: list[int] | None = None) -> DataFrame:
    """A row for each root tile, or those of some faces: face, payload, lo, hi, dependency, content, logical."""
    semantic, d = config.identify(c).semantic_hash, dataset(c)
    samples = raster.with_apron(raster.resolve_seams(raster.synthetic_faces(spark, CELLS, c.amplitude), CELLS), CELLS)

    def encode(rows: pd.DataFrame) -> pd.DataFrame:
        face = int(rows["face"].iloc[0])
        grid = np.zeros((SIDE, SIDE), np.uint16)
        grid[rows["y"], rows["x"]] = rows["code"]
        payload, lo, hi, dependency, content, logical = encode_tile(face << 61, grid, semantic, d)
        return pd.DataFrame({"face": [face], "payload": [payload], "lo": [lo], "hi": [hi], "dependency": [dependency], "content": [content], "logical": [logical]})

    if faces is not None:
        samples = samples.filter(F.col("face").isin(faces))
    return samples.groupBy("face").applyInPandas(encode, "face int, payload binary, lo int, hi int, dependency binary, content binary, logical long")


def string_table(texts: list[str]) -> tuple[bytes, dict[str, int]]:
    out, ids = struct.pack("<I", 0), {"": 0}
    for t in sorted({t.encode() for t in texts if t}):
        ids[t.decode()] = len(out)
        out += struct.pack("<I", len(t)) + t
        out += bytes(align(len(out), 4) - len(out))
    return out, ids


def reusable(spark: SparkSession, c: config.Config, path: str) -> dict[int, dict]:
    """By face, the tiles of an older database whose dependency hash is that of the configuration, as encoded_tiles() has them."""
    semantic, d = config.identify(c).semantic_hash, dataset(c)
    db = container.Database(spark, path)
    m = db.manifest
    folder, packs = Path(path).parent, {p.pack_id: (p, own) for p, own in zip(m.packs, m.of_pack, strict=True)}
    out = {}
    for t in container.entries(m.tiles[container.key_parts(m.tiles["key"])[1] == 0].tobytes()):
        face, level, _ = container.key_parts(t.key)
        dependency = dependency_hash(t.key, semantic, d)
        if level == 0 and t.dependency_prefix == dependency[:8]:
            pack, own = packs[t.pack_id]
            data = (folder / m.strings[pack.path_id]).read_bytes()
            container.check_pack(data, pack, container.entries(m.tiles[own].tobytes()), path)
            payload = data[t.payload_offset : t.payload_offset + t.stored_bytes]
            container.decode_tile(payload, t, path)
            out[face] = {"face": face, "payload": payload, "lo": t.min_code, "hi": t.max_code, "dependency": dependency, "content": t.content_prefix, "logical": t.logical_bytes}
    return out


def make_files(spark: SparkSession, c: config.Config, reuse: dict[int, dict] | None = None) -> dict[str, bytes]:
    """All files of a database by relative path, the manifest last; tiles given in `reuse` are not made again."""
    identity, d = config.identify(c), dataset(c)
    registry = config.registry_hash([d])
    database_id = sha("LTDB_DATABASE_ID_V1", identity.builder_hash, registry)[:16]
    reuse = reuse or {}
    todo = [f for f in range(6) if f not in reuse]
    tiles = sorted([*(encoded_tiles(spark, c, todo).collect() if todo else ()), *reuse.values()], key=lambda r: r["face"])
    files, packs, entries = {}, [], []
    for i, t in enumerate(tiles):
        payload, key = bytes(t["payload"]), t["face"] << 61
        size = PACK_HEADER.size + len(payload)
        head = lambda prefix, i=i, size=size: PACK_HEADER.write(b"LTPK", 1, 0, PACK_HEADER.size, ENDIAN, i, 0, 1, PACK_HEADER.size, size, prefix)
        digest = hashlib.sha256(head(bytes(16)) + payload).digest()
        path = f"Packs/{c.name}_{database_id.hex()}_F{t['face']}_L00_P0000.ltp"
        files[path] = head(digest[:16]) + payload
        packs.append((i, path, size, key, digest))
        entries.append(TILE.write(key, i, 1, PACK_HEADER.size, len(payload), t["logical"], t["lo"], t["hi"], d["id"], config.RESOLUTION * 1000, 0, 0, 2, 0, crc32c(payload), bytes(t["content"])[:16], bytes(t["dependency"])[:8]))
    strings, ids = string_table([*d["strings"], *(p[1] for p in packs)])
    unknown = struct.pack("<Q", 0x7FF8000000000000) * 3
    record = bytearray(DATASET.write(d["id"], 0, *(ids[s] for s in d["strings"]), d["doubles"][0], 0.0, 0.0, 0.0, d["bundle_bytes"], d["bundle_hash"], 0, len(d["meta"]), 0, 0))
    record[48:72] = unknown
    chunks = dict(zip(MANDATORY, (bytes(record), d["meta"], b"".join(PACK.write(i, 0, ids[p], 1, 0, 1, n, k, k, h) for i, p, n, k, h in packs), strings, b"".join(entries)), strict=True))
    parts = [struct.pack("<HH", 1, 0), identity.builder_hash, struct.pack("<I", len(chunks))]
    parts += [t + struct.pack("<HHQ", 1, 3, len(x)) + x for t, x in chunks.items()]
    parts += [struct.pack("<I", len(packs))] + [struct.pack("<I", i) + h for i, _, _, _, h in packs]
    body, directory, start = b"", b"", align(HEADER.size + len(chunks) * CHUNK.size)
    for t, x in chunks.items():
        body += bytes(align(len(body)) - len(body))
        directory += CHUNK.write(t, 1, 3, start + len(body), len(x), len(x), crc32c(x), 0)
        body += x
    header = HEADER.write(b"LTDB", 1, 0, HEADER.size, ENDIAN, 0, len(chunks), HEADER.size, database_id, 1737400.0, -16384.0, 0.5, CELLS, CELLS + 1, 1, 0, 1, 1, len(tiles), 1, len(packs), identity.builder_hash, registry, framed("LTDB_TILE_INDEX_V1", chunks[b"TIDX"]), sha("LTDB_DATABASE_CONTENT_V1", *parts), bytes(32))
    manifest = header + directory
    files[f"{c.name}.ltdb"] = manifest + bytes(start - len(manifest)) + body
    return files


def publish(files: dict[str, bytes], folder: Path) -> list[str]:
    """Write files so that a reader sees the old database or the new: packs first, the manifest last; what is equal stays.

    A pack of the same name with other bytes is an error and leaves everything as it was. Returns the files written.
    """
    *packs, manifest = files
    todo = []
    for name in packs:
        at = folder / name
        if at.exists():
            require(at.read_bytes() == files[name], "hash_mismatch", "a pack of this name differs", path=str(at))
        else:
            todo.append(name)
    if not ((folder / manifest).exists() and (folder / manifest).read_bytes() == files[manifest]):
        todo.append(manifest)
    staged: list[Path] = []
    try:
        for name in todo:
            at = folder / name
            at.parent.mkdir(parents=True, exist_ok=True)
            staged.append(at.with_name(f".{at.name}.{os.getpid()}.tmp"))
            with staged[-1].open("wb") as f:
                f.write(files[name])
                f.flush()
                os.fsync(f.fileno())
        for name, temp in zip(todo, staged, strict=True):
            os.replace(temp, folder / name)
    except OSError as e:
        raise Error("io_error", str(e), path=str(folder)) from e
    finally:
        for temp in staged:
            temp.unlink(missing_ok=True)
    return todo


def scan(path: str) -> dict:
    c = config.load(path)
    i = config.identify(c)
    return {"name": c.name, "output": str(c.output), "stable_key": c.stable_key, "amplitude_meters": c.amplitude, "dataset_id": i.dataset_id, "semantic_sha256": i.semantic_hash.hex(), "builder_sha256": i.builder_hash.hex()}


def plan(path: str) -> dict:
    config.load(path)
    return {"tiles": [f"QSC/F{f}/L00/0000/0000" for f in range(6)], "logical_bytes": 6 * TILE_BYTES}


def build(spark: SparkSession, path: str, incremental: bool = False) -> dict:
    """Make and publish a database; an incremental build makes only tiles whose dependency hash is not that of the database there."""
    c = config.load(path)
    there = c.output / f"{c.name}.ltdb"
    reuse = reusable(spark, c, str(there)) if incremental and there.exists() else {}
    files = make_files(spark, c, reuse)
    written = publish(files, c.output)
    m = container.Manifest(files[f"{c.name}.ltdb"])
    return {"manifest": str(c.output / f"{c.name}.ltdb"), "database_id": m.header.database_id.hex(), "tiles": len(m.tiles), "packs": len(m.packs), "bytes": sum(map(len, files.values())), "written": len(written), "made": 6 - len(reuse)}


def violations(db: container.Database) -> DataFrame:
    """Failed checks of all tiles (precedence, key_hex, message), orphans and child masks that disagree as warnings."""
    tiles = db.table("tiles")
    bad = db.channels().filter("error is not null").select(F.lit(1).alias("precedence"), "key_hex", F.col("error").alias("message"))
    lost = index.orphans(tiles).select(F.lit(2).alias("precedence"), "key_hex", F.lit("warning: the parent is no tile").alias("message"))
    mask = index.with_child_mask(tiles.withColumnRenamed("child_mask", "stored")).filter("stored <> child_mask").select(F.lit(2).alias("precedence"), "key_hex", F.lit("warning: the child mask differs from the tiles").alias("message"))
    return bad.unionByName(lost).unionByName(mask)


def validate(spark: SparkSession, path: str, full: bool = False) -> dict:
    """Open, decode every tile, and, if full, compare the seams of root tiles; the first failed check raises."""
    db = container.Database(spark, path)
    first = violations(db).filter("precedence = 1").orderBy("precedence", "key_hex").first()
    if first:
        code, _, message = first["message"].partition(": ")
        raise Error(code, message, path=path, tile_key=first["key_hex"])
    out = {"tiles": len(db.manifest.tiles), "packs": len(db.manifest.packs), "datasets": len(db.manifest.datasets), "seams": 0}
    if full:
        core = db.samples().filter(f"level = 0 and x between 1 and {CELLS + 1} and y between 1 and {CELLS + 1}").withColumns({"x": F.col("x") - 1, "y": F.col("y") - 1})
        s = raster.seams(core, CELLS).groupBy("face", "edge").agg(F.count("*").alias("n"), F.count_if(F.col("code") != F.col("nbr_code")).alias("bad")).collect()
        require(all(r["bad"] == 0 for r in s), "invalid_format", "edge samples disagree", path=path)
        out["seams"] = len(s)
    return out


def parsed(spark: SparkSession, key: str) -> tuple[int, int, int]:
    """Face, level and Morton code of a canonical text."""
    p = spark.range(1).select(keys.parse(F.lit(key)).alias("p")).select("p.*", keys.morton(F.col("p.x"), F.col("p.y")).alias("m")).first()
    require(p["face"] is not None, "invalid_argument", f"no tile key: {key}")
    return p["face"], p["level"], p["m"]


def inspect(spark: SparkSession, path: str, key: str | None = None) -> dict:
    """Header figures, or the index entry of a tile by its canonical text."""
    db = container.Database(spark, path)
    h = db.header
    if key is None:
        return {"database_id": h.database_id.hex(), "tiles": h.tile_count, "packs": h.pack_count, "datasets": h.dataset_count, "max_level": h.max_level, "builder_sha256": h.builder_hash.hex()}
    row = db.find(*parsed(spark, key))
    require(row is not None, "not_found", f"no tile {key}", path=path)
    return {k: v.hex() if isinstance(v, bytes | bytearray) else v for k, v in row.asDict().items()}


def report(values: dict, as_json: bool) -> str:
    """A report as lines of name and value, or as one JSON object."""
    if as_json:
        return json.dumps(values, separators=(",", ":"))
    return "\n".join(f"{k}: {', '.join(map(str, v)) if isinstance(v, list) else v}" for k, v in values.items())


def diff(spark: SparkSession, path: str, other: str) -> DataFrame:
    """Tiles that differ between two databases: face, level, morton, change (added, removed, changed), by content."""
    a, b = (container.Database(spark, p).table("tiles").withColumn("digest", F.hex("content_prefix")) for p in (path, other))
    return index.diff(a, b)


def export_csv(db: container.Database, path: str) -> None:
    """Elevations in metres of all samples as CSV, a folder for each face and level."""
    rows = db.samples().withColumn("metres", F.lit(-16384.0) + F.col("code") * 0.5)
    rows.select("face", "level", "morton", "y", "x", "metres").write.partitionBy("face", "level").mode("overwrite").option("header", True).csv(path)


def export_raw(db: container.Database, face: int, level: int, morton: int) -> bytes:
    """The raster of a tile as 16-bit codes, least byte first, row by row."""
    return db.read_tile(face, level, morton)[ELEV]


def points(db: container.Database, face: int, level: int, morton: int, step: int = 1) -> DataFrame:
    """Every `step`-th sample of a tile's core with its place about the body's centre: j, i, px, py, pz in metres."""
    own = db.samples(db.tile(face, level, morton)).withColumns({"j": F.col("y") - 1, "i": F.col("x") - 1})
    own = own.filter(f"j between 0 and {CELLS} and i between 0 and {CELLS} and j % {step} = 0 and i % {step} = 0")
    at = {n: projection.lattice(t(F.col("morton")), F.col(k), F.col("level")) for n, t, k in (("u", keys.x_of, "i"), ("v", keys.y_of, "j"))}
    own = projection.inverse(own.withColumns(at))
    x, y, z = projection.cartesian(F.col("lat"), F.col("lon"), elevation.dequantize(F.col("code")).cast("double"), db.header.radius)
    return own.select("j", "i", x.alias("px"), y.alias("py"), z.alias("pz"))


def export_mesh(db: container.Database, face: int, level: int, morton: int, kind: str = "obj", step: int = 1) -> str:
    """A tile's surface as a text of kind obj or ply: corners row by row, and two triangles for each cell."""
    require(kind in ("obj", "ply") and CELLS % step == 0, "invalid_argument", f"no mesh of kind {kind} with step {step}")
    corners = [tuple(r) for r in points(db, face, level, morton, step).orderBy("j", "i").select("px", "py", "pz").collect()]
    n = CELLS // step + 1
    faces = [(a, a + 1, b) if k else (a + 1, b + 1, b) for r in range(n - 1) for c in range(n - 1) for a, b in ((r * n + c, (r + 1) * n + c),) for k in (1, 0)]
    if kind == "obj":
        return "".join([f"v {x:.3f} {y:.3f} {z:.3f}\n" for x, y, z in corners] + [f"f {a + 1} {b + 1} {c + 1}\n" for a, b, c in faces])
    head = f"ply\nformat ascii 1.0\nelement vertex {len(corners)}\nproperty double x\nproperty double y\nproperty double z\nelement face {len(faces)}\nproperty list uchar int vertex_indices\nend_header\n"
    return head + "".join([f"{x:.3f} {y:.3f} {z:.3f}\n" for x, y, z in corners] + [f"3 {a} {b} {c}\n" for a, b, c in faces])


def export_image(db: container.Database, face: int, level: int, morton: int, channel: str = "elevation") -> bytes:
    """A tile as a portable image: elevation as 16-bit grey, provenance as a colour for each source, quality as 8-bit grey."""
    own = db.channels(index.find(db.table("tiles"), face, level, morton)).filter("error is null")
    id_ = {"elevation": ELEV, "provenance": PRVN, "quality": QUAL}.get(channel)
    require(id_ is not None, "invalid_argument", f"no channel {channel}")
    row = own.filter(F.col("channel_id") == id_).first()
    require(row is not None, "not_found", f"the tile has no channel {channel}", path=db.path)
    data, w, h = bytes(row["data"]), row["width"], row["height"]
    if channel == "elevation":
        return b"P5\n%d %d\n65535\n" % (w, h) + np.frombuffer(data, "<u2").astype(">u2").tobytes()
    if channel == "quality":
        return b"P5\n%d %d\n255\n" % (w, h) + data
    p = PROVENANCE.read(data)
    ids = np.array([PALETTE.read(data, PROVENANCE.size + i * PALETTE.size).dataset_id for i in range(p.palette_count)], np.int64)
    places = np.frombuffer(data, f"<u{p.index_width}", offset=PROVENANCE.size + p.palette_count * PALETTE.size) if p.flags & 1 else np.zeros(1, np.uint8)
    w, h = (p.width, p.height) if p.flags & 1 else (1, 1)
    colour = np.stack([ids * k % 251 for k in (37, 91, 173)], axis=1).astype(np.uint8)
    return b"P6\n%d %d\n255\n" % (w, h) + colour[places].tobytes()


def export(spark: SparkSession, path: str, key: str, kind: str, output: str) -> dict:
    """Write a tile, named by its canonical text, to a file: csv, raw, obj, ply, or an image of elevation, provenance or quality."""
    db = container.Database(spark, path)
    face, level, morton = parsed(spark, key)
    if kind == "csv":
        rows = db.samples(index.find(db.table("tiles"), face, level, morton)).orderBy("y", "x").collect()
        data = ("y,x,metres\n" + "".join(f"{r.y},{r.x},{-16384.0 + r.code * 0.5}\n" for r in rows)).encode()
    elif kind == "raw":
        data = export_raw(db, face, level, morton)
    elif kind in ("obj", "ply"):
        data = export_mesh(db, face, level, morton, kind).encode()
    else:
        data = export_image(db, face, level, morton, kind)
    Path(output).write_bytes(data)
    return {"output": output, "bytes": len(data)}
