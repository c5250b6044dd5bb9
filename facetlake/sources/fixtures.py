"""A generator of small containers, one tile each, of any level, rasters and channels: for tests of readers."""

from __future__ import annotations

import hashlib
import struct

import numpy as np

from facetlake.functions.hashing import crc32c
from facetlake.sources import builder, config, container
from facetlake.sources.layout import (
    CHANNEL, CHUNK, DATASET, ELEV, ENDIAN, HEADER, MANDATORY, PACK, PACK_HEADER, PALETTE, PROVENANCE, PRVN,
    QUAL, TILE, TILE_HEADER, UNKNOWN, align, framed, sha,
)


def tile(key: int, codes: np.ndarray, sources: list[tuple[int, float, float]], places: np.ndarray | None, quality: np.ndarray | None, resolution: float, error: float, codec: int) -> tuple[bytes, bytes, int]:
    """Payload, content hash and logical bytes of a tile with provenance (dataset, fraction, resolution), its map, and quality."""
    provenance = PROVENANCE.write(1, len(sources), *((places.shape[1], places.shape[0], 1) if places is not None else (0, 0, 0)), 0, int(places is not None), 0)
    provenance += b"".join(PALETTE.write(d, 0, f, r) for d, f, r in sources) + (places.astype(np.uint8).tobytes() if places is not None else b"")
    parts = [(ELEV, 2, 1, codes.shape, codes.astype("<u2").tobytes(), container.delta(codes), 1)]
    parts.append((PRVN, 255, 0, places.shape if places is not None else (0, 0), provenance, provenance, 0))
    if quality is not None:
        data = quality.astype(np.uint8).tobytes()
        parts.append((QUAL, 1, 0, quality.shape, data, data, 0))
    channels = []
    for id_, element, predictor, (h, w), decoded, logical, p1 in parts:
        stored = container.deflate(logical) if codec else logical
        channels.append((CHANNEL.type(id_, 1, element, 1, codec, predictor, w, h, int(id_ != QUAL), 0, len(stored), len(logical), crc32c(stored), 3 if codec else 0, p1), decoded, stored))
    content = container.content_hash(key, [(c, d) for c, d, _ in channels])
    start = align(TILE_HEADER.size + len(channels) * CHANNEL.size)
    body, records = b"", b""
    for c, _, stored in channels:
        body += bytes(align(len(body)) - len(body))
        records += CHANNEL.write(**c._replace(offset=start + len(body))._asdict())
        body += stored
    low, high = (-16384.0 + 0.5 * int(x) for x in (codes.min(), codes.max()))
    flags = 1 | 2 * (quality is not None)
    head = TILE_HEADER.write(b"LTIL", 1, TILE_HEADER.size, key, flags, len(channels), 256, 257, 1, 1, resolution, error, low, high, sources[0][0], len(sources), 0, TILE_HEADER.size, len(records), start, len(body), sha("fixture", struct.pack("<Q", key))[:16], content[:16], bytes(28))
    return (head + records).ljust(start, b"\0") + body, content, sum(c.logical_bytes for c, _, _ in channels)


def database(name: str, face: int, level: int, x: int, y: int, codes: np.ndarray, sources: list[tuple[int, float, float]], places: np.ndarray | None = None, quality: np.ndarray | None = None, child_mask: int = 0, resolution: float = 53.0, error: float = 1.25, codec: int = 0) -> dict[str, bytes]:
    """Files by relative path, the manifest last, of a container whose one tile is given."""
    morton = sum((x >> i & 1) << 2 * i | (y >> i & 1) << 2 * i + 1 for i in range(level))
    key = face << 61 | level << 56 | morton
    payload, content, logical = tile(key, codes, sources, places, quality, resolution, error, codec)
    path = f"Packs/{name}_F{face}_L{level:02d}_P0000.ltp"
    size = PACK_HEADER.size + len(payload)
    pack = lambda prefix: PACK_HEADER.write(b"LTPK", 1, 0, PACK_HEADER.size, ENDIAN, 0, 0, 1, PACK_HEADER.size, size, prefix)
    digest = hashlib.sha256(pack(bytes(16)) + payload).digest()
    meta = [config.canonical({"stable_key": f"{name.lower()}.{d}", "datum": {"reference_radius_m": 1737400}}).encode() for d, _, _ in sources]
    rows = [{"id": d, "flags": 0, "strings": [f"{name} {d}", "facetlake", "", "", "1", f"fixture://{d}", "QSC_v1", "Made by rule"], "doubles": [r, None, None, None], "bundle_bytes": 5, "bundle_hash": hashlib.sha256(m).digest(), "meta": m, "quality": 1} for (d, _, r), m in zip(sources, meta, strict=True)]
    rows.sort(key=lambda r: r["id"])
    strings, ids = builder.string_table([s for r in rows for s in r["strings"]] + [path])
    records, blob = b"", b""
    for r in rows:
        record = bytearray(DATASET.write(r["id"], 0, *(ids[s] for s in r["strings"]), r["doubles"][0], 0.0, 0.0, 0.0, r["bundle_bytes"], r["bundle_hash"], len(blob), len(r["meta"]), 1, 0))
        record[48:72] = struct.pack("<Q", UNKNOWN) * 3
        records, blob = records + bytes(record), blob + r["meta"]
    entry = TILE.write(key, 0, 1 | 2 * (quality is not None), PACK_HEADER.size, len(payload), logical, int(codes.min()), int(codes.max()), sources[0][0], round(resolution * 1000), round(error * 1000), child_mask, 2 + (quality is not None), 0, crc32c(payload), content[:16], sha("fixture", struct.pack("<Q", key))[:8])
    chunks = dict(zip(MANDATORY, (records, blob, PACK.write(0, 0, ids[path], codec, 0, 1, size, key, key, digest), strings, entry), strict=True))
    builder_hash, registry = framed("LTDB_BUILDER_CONFIG_V1", name.encode()), config.registry_hash(rows)
    parts = [struct.pack("<HH", 1, 0), builder_hash, struct.pack("<I", len(chunks))] + [t + struct.pack("<HHQ", 1, 3, len(c)) + c for t, c in chunks.items()] + [struct.pack("<II", 1, 0) + digest]
    body, directory, start = b"", b"", align(HEADER.size + len(chunks) * CHUNK.size)
    for t, c in chunks.items():
        body += bytes(align(len(body)) - len(body))
        directory += CHUNK.write(t, 1, 3, start + len(body), len(c), len(c), crc32c(c), 0)
        body += c
    header = HEADER.write(b"LTDB", 1, 0, HEADER.size, ENDIAN, 0, len(chunks), HEADER.size, sha("LTDB_DATABASE_ID_V1", builder_hash, registry)[:16], 1737400.0, -16384.0, 0.5, 256, 257, 1, max(level, 8), 1, 1, 1, len(rows), 1, builder_hash, registry, framed("LTDB_TILE_INDEX_V1", entry), sha("LTDB_DATABASE_CONTENT_V1", *parts), bytes(32))
    return {path: pack(digest[:16]) + payload, f"{name}.ltdb": (header + directory).ljust(start, b"\0") + body}
