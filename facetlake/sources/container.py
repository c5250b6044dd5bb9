"""Reader of the binary tile container.

The manifest is one file of registries; it is parsed and checked as a whole, and its tables become
DataFrames with explicit schemas. The tile index stays what it is in the file, 80 bytes a tile, as a
sorted array: keys and subtrees are slices of it, and a pack's tasks get the entries of their packs.
Packs are read as binary files by the executors, one hash for each pack however many of its tiles are
asked for, and payloads are decoded there, a few at a time.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from facetlake.functions import keys
from facetlake.functions.hashing import crc32c
from facetlake.operators import index
from facetlake.sources import config
from facetlake.sources.layout import (
    CHANNEL, CHUNK, DATASET, ELEMENT_BYTES, ELEV, ENDIAN, HEADER, MANDATORY, PACK, PACK_HEADER, PALETTE,
    PROVENANCE, PRVN, QUAL, TILE, TILE_HEADER, UNKNOWN, Error, align, framed, require, sha,
)

SCHEMAS = {
    "chunks": "tag string, version int, flags int, offset long, stored_bytes long, logical_bytes long, crc32c long",
    "strings": "string_id long, text string",
    "datasets": "dataset_id long, flags long, product string, producer string, mission string, instrument string, version string, source_uri string, crs string, license string, resolution_m double, h_accuracy_m double, v_accuracy_m double, no_data double, bundle_bytes long, bundle_sha256 binary, metadata string, quality_schema long",
    "packs": "pack_id long, path string, codec int, tile_count long, file_bytes long, first_key string, last_key string, sha256 binary",
    "tiles": "face int, level int, morton long, key_hex string, pack_id long, flags long, payload_offset long, stored_bytes long, logical_bytes long, min_code int, max_code int, primary_dataset long, resolution_mm long, error_mm long, child_mask int, channel_count int, payload_crc32c long, content_prefix binary, dependency_prefix binary",
}
#: An entry of the tile index as one element of an array; its fields are those of TILE.
ENTRY = np.dtype(list(zip(TILE.type._fields, "<u8 <u4 <u4 <u8 <u4 <u4 <u2 <u2 <u4 <u4 <u4 u1 u1 <u2 <u4 V16 V8".split(), strict=True)))
#: Bytes of index entries that one scan of packs carries to its tasks; more of them are dealt over several scans.
SCAN_BYTES = 64 << 20
#: Decoded bytes of one Arrow batch, but for its last tile.
BATCH_BYTES = 16 << 20
CHANNELS = "key_hex string, channel_id int, element int, codec int, predictor int, width int, height int, flags long, parameter1 long, data binary, error string"


def key_parts(key: int) -> tuple[int, int, int]:
    return key >> 61, key >> 56 & 31, key & (1 << 56) - 1


def check_key(key: int, **where) -> None:
    face, level, m = key_parts(key)
    require(face <= 5 and level <= keys.MAX_LEVEL and m >> 2 * level == 0, "invalid_tile_key", f"{key:016x}", **where)


def portable(path: str) -> bool:
    return bool(path) and not any(c in path for c in "\\:\0") and all(s not in ("", ".", "..") for s in path.split("/"))


def increasing(values: list, what: str, **where) -> None:
    require(all(a < b for a, b in zip(values, values[1:], strict=False)), "invalid_format", f"{what} are not strictly increasing", **where)


def apart(ranges: list[tuple[int, int]], what: str, **where) -> None:
    ranges = sorted(ranges)
    require(all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:], strict=False)), "invalid_format", f"{what} overlap", **where)


def entries(data: bytes) -> list:
    """Index entries one by one."""
    return [TILE.type(*t) for t in TILE.struct.iter_unpack(data)]


def found(values: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where values stand among sorted ones (some place, if they do not), and whether they do."""
    if not len(among):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return at, among[at] == values


class Manifest:
    """All tables of a manifest, checked as they are read; the first failed check raises."""

    def __init__(self, data: bytes, path: str = ""):
        self.path = path
        h = self.header = HEADER.read(data)
        require(h.magic == b"LTDB", "invalid_format", "not a manifest", path=path, offset=0)
        require(h.major == 1, "unsupported_version", f"major version {h.major}", path=path, offset=4)
        require(h.header_bytes == HEADER.size and h.endian == ENDIAN, "invalid_format", "header size or byte order", path=path, offset=8)
        require(h.flags == 0, "unsupported_feature", "database flags", path=path, offset=16)
        require(not any(h.reserved), "invalid_format", "reserved header bytes", path=path, offset=224)
        require(5 <= h.chunk_count <= 4096 and h.directory == HEADER.size, "invalid_format", "chunk directory", path=path, offset=20)
        require(all(map(math.isfinite, (h.radius, h.origin, h.step))) and h.radius > 0 and h.step > 0, "invalid_format", "datum", path=path, offset=48)
        require((h.cells, h.core, h.apron) == (256, 257, 1) and h.max_level <= keys.MAX_LEVEL, "invalid_format", "tile shape", path=path, offset=72)
        require(h.projection == 1 and h.quantization == 1, "unsupported_feature", "projection or quantization", path=path, offset=78)
        self.chunks, raw = self._chunks(data)
        self.strings = self._strings(raw[b"STRS"])
        self.datasets = self._datasets(raw[b"DSET"], raw[b"META"])
        self.packs = self._packs(raw[b"PACK"])
        self.tiles = self._tiles(raw[b"TIDX"])
        require(framed("LTDB_TILE_INDEX_V1", raw[b"TIDX"]) == h.index_hash, "hash_mismatch", "tile index", path=path)
        identity = [c for c in self.chunks if c.flags & 2]
        parts = [struct.pack("<HH", h.major, h.minor), h.builder_hash, struct.pack("<I", len(identity))]
        parts += [c.tag + struct.pack("<HHQ", c.version, c.flags, c.logical_bytes) + raw[c.tag] for c in identity]
        parts += [struct.pack("<I", len(self.packs))] + [struct.pack("<I", p.pack_id) + p.sha256 for p in self.packs]
        require(sha("LTDB_DATABASE_CONTENT_V1", *parts) == h.content_hash, "hash_mismatch", "database content", path=path)
        require(sha("LTDB_DATABASE_ID_V1", h.builder_hash, h.registry_hash)[:16] == h.database_id, "hash_mismatch", "database id", path=path)

    def _chunks(self, data: bytes):
        h, path = self.header, self.path
        chunks = [CHUNK.read(data, h.directory + i * CHUNK.size) for i in range(h.chunk_count)]
        increasing([c.tag for c in chunks], "chunk tags", path=path)
        end = h.directory + h.chunk_count * CHUNK.size
        raw = {}
        for i, c in enumerate(chunks):
            at = h.directory + i * CHUNK.size
            require(c.flags & ~3 == 0, "unsupported_feature", "chunk flags", path=path, offset=at + 6)
            require(c.reserved == 0 and c.offset % 8 == 0 and c.offset >= end, "invalid_format", "chunk record", path=path, offset=at)
            require(c.offset <= len(data) and c.stored_bytes <= len(data) - c.offset, "truncated_data", "chunk range", path=path, offset=at + 8)
            raw[c.tag] = data[c.offset : c.offset + c.stored_bytes]
            require(crc32c(raw[c.tag]) == c.crc32c, "checksum_mismatch", f"chunk {c.tag!r}", path=path, offset=c.offset)
            if c.tag in MANDATORY:
                require(c.version == 1, "unsupported_version", f"chunk {c.tag!r}", path=path, offset=at + 4)
                require(c.flags == 3 and c.stored_bytes == c.logical_bytes, "invalid_format", f"chunk {c.tag!r}", path=path, offset=at)
            else:
                require(not c.flags & 1, "unsupported_feature", f"unknown required chunk {c.tag!r}", path=path, offset=at)
        apart([(c.offset, c.offset + c.stored_bytes) for c in chunks], "chunks", path=path)
        ends = [end, *sorted(c.offset + c.stored_bytes for c in chunks)]
        for a, b in zip(ends, sorted(c.offset for c in chunks), strict=False):
            require(not any(data[a:b]), "invalid_format", "padding between chunks", path=path, offset=a)
        require(all(t in raw for t in MANDATORY), "invalid_format", "a mandatory chunk is missing", path=path)
        return chunks, raw

    def _strings(self, data: bytes) -> dict[int, str]:
        out: dict[int, str] = {}
        at, last = 0, None
        while at < len(data):
            require(at + 4 <= len(data), "truncated_data", "string record", path=self.path, offset=at)
            size = struct.unpack_from("<I", data, at)[0]
            text, end = data[at + 4 : at + 4 + size], align(at + 4 + size, 4)
            require(len(text) == size and end <= len(data) and not any(data[at + 4 + size : end]), "truncated_data", "string record", path=self.path, offset=at)
            require((size == 0) == (at == 0) and b"\0" not in text and (last is None or text > last), "invalid_format", "string order", path=self.path, offset=at)
            try:
                out[at] = text.decode()
            except UnicodeDecodeError as e:
                raise Error("invalid_format", "string is no UTF-8", path=self.path, offset=at) from e
            at, last = end, text
        require(0 in out, "invalid_format", "empty string table", path=self.path)
        return out

    def _records(self, record, data: bytes, count: int, what: str) -> list:
        require(len(data) == count * record.size, "invalid_format", f"{what}: bytes and count disagree", path=self.path)
        return [record.read(data, i * record.size) for i in range(count)]

    def _text(self, string_id: int) -> str:
        require(string_id in self.strings, "invalid_format", f"string id {string_id}", path=self.path)
        return self.strings[string_id]

    def _datasets(self, data: bytes, meta: bytes) -> list[dict]:
        rows = self._records(DATASET, data, self.header.dataset_count, "datasets")
        increasing([r.dataset_id for r in rows], "dataset ids", path=self.path)
        out = []
        for i, r in enumerate(rows):
            bits = struct.unpack_from("<4Q", data, i * DATASET.size + 40)
            require(r.flags & ~3 == 0 and r.reserved == 0, "unsupported_feature", "dataset flags", path=self.path)
            for x, b in ((r.h_accuracy, bits[1]), (r.v_accuracy, bits[2])):
                require(b == UNKNOWN or math.isfinite(x) and x > 0, "invalid_format", "dataset accuracy", path=self.path)
            require(math.isfinite(r.resolution) and r.resolution > 0, "invalid_format", "dataset resolution", path=self.path)
            require(r.meta_offset + r.meta_bytes <= len(meta), "truncated_data", "META range", path=self.path)
            doc = meta[r.meta_offset : r.meta_offset + r.meta_bytes]
            require(not doc or doc[:1] == b"{" and doc[-1:] == b"}", "invalid_format", "META document", path=self.path)
            strings = [self._text(getattr(r, f"s{k}")) for k in range(8)]
            doubles = [None if b == UNKNOWN else x for x, b in zip((r.resolution, r.h_accuracy, r.v_accuracy, r.no_data), bits, strict=True)]
            out.append({"id": r.dataset_id, "flags": r.flags, "strings": strings, "doubles": doubles, "bundle_bytes": r.bundle_bytes, "bundle_hash": r.bundle_hash, "meta": doc, "quality": r.quality_schema})
        apart(sorted({(r.meta_offset, r.meta_offset + r.meta_bytes) for r in rows if r.meta_bytes}), "META documents", path=self.path)
        require(config.registry_hash(out) == self.header.registry_hash, "hash_mismatch", "dataset registry", path=self.path)
        return out

    def _packs(self, data: bytes) -> list:
        rows = self._records(PACK, data, self.header.pack_count, "packs")
        increasing([r.pack_id for r in rows], "pack ids", path=self.path)
        for r in rows:
            require(r.flags == 0 and r.reserved == 0, "unsupported_feature", "pack flags", path=self.path)
            require(portable(self._text(r.path_id)) and r.codec <= 1 and r.tile_count > 0 and r.file_bytes >= PACK_HEADER.size, "invalid_format", "pack record", path=self.path)
            for k in (r.first_key, r.last_key):
                check_key(k, path=self.path)
            require(r.first_key <= r.last_key and key_parts(r.first_key)[:2] == key_parts(r.last_key)[:2], "invalid_format", "pack bounds", path=self.path)
        return rows

    def _tiles(self, data: bytes) -> np.ndarray:
        """The entries as an array, each checked; of_pack holds the places of each pack's own, in its order."""
        require(len(data) == self.header.tile_count * TILE.size, "invalid_format", "tiles: bytes and count disagree", path=self.path)
        t = np.frombuffer(data, ENTRY)
        key = t["key"]
        require(bool((key[:-1] < key[1:]).all()), "invalid_format", "tile keys are not strictly increasing", path=self.path)
        face, level, m = key_parts(key)
        pack_ids = np.array([p.pack_id for p in self.packs], np.uint32)
        pack, there = found(t["pack_id"], pack_ids)
        size = np.array([p.file_bytes for p in self.packs] or [0], np.uint64)[pack]
        start, stored = t["payload_offset"], t["stored_bytes"].astype(np.uint64)
        inside = (start >= PACK_HEADER.size) & (start <= size)
        bad = [
            ("invalid_tile_key", "tile key", (face > 5) | (level > keys.MAX_LEVEL) | (m >> 2 * level != 0)),
            ("unsupported_feature", "tile flags", (t["flags"] & ~np.uint32(3) != 0) | (t["child_mask"] & 0xF0 != 0)),
            ("invalid_format", "tile record", (t["reserved"] != 0) | (t["min_code"] > t["max_code"]) | (start % 8 != 0)),
            ("invalid_format", "tile level", level > self.header.max_level),
            ("invalid_format", "tile's pack or dataset", ~there | ~found(t["primary_dataset"], np.array([d["id"] for d in self.datasets], np.uint32))[1]),
            ("invalid_format", "payload range", ~inside | (stored > np.where(inside, size - start, 0))),
        ]
        any_bad = np.logical_or.reduce([b for _, _, b in bad])
        if any_bad.any():
            first = int(any_bad.argmax())
            code, message = next((c, w) for c, w, b in bad if b[first])
            raise Error(code, message, path=self.path, tile_key=f"{int(key[first]):016x}")
        order = np.argsort(t["pack_id"], kind="stable")
        held = t["pack_id"][order]
        self.of_pack = [order[a:b] for a, b in zip(np.searchsorted(held, pack_ids), np.searchsorted(held, pack_ids, "right"), strict=True)]
        for p, places in zip(self.packs, self.of_pack, strict=True):
            own = t[places]
            require(len(own) == p.tile_count and int(own["key"][0]) == p.first_key and int(own["key"][-1]) == p.last_key, "invalid_format", f"tiles of pack {p.pack_id}", path=self.path)
            own = own[np.lexsort((own["stored_bytes"], own["payload_offset"]))]
            require(bool((own["payload_offset"][1:] >= (own["payload_offset"] + own["stored_bytes"])[:-1]).all()), "invalid_format", "payloads overlap", path=self.path)
        return t

    def below(self, face: int, level: int, morton: int, first: int, last: int) -> np.ndarray:
        """Entries of the levels first to last at or below a key, a slice of the index for each; none for what is no key."""
        if not (0 <= face <= 5 and 0 <= level <= keys.MAX_LEVEL and 0 <= morton < 1 << 2 * level):
            return self.tiles[:0]
        key, out = self.tiles["key"], []
        for deep in range(max(first, level), min(last, keys.MAX_LEVEL) + 1):
            lo = face << 61 | deep << 56 | morton << 2 * (deep - level)
            a, b = np.searchsorted(key, np.array([lo, lo + (1 << 2 * (deep - level))], np.uint64))
            out.append(self.tiles[a:b])
        return np.concatenate(out) if out else self.tiles[:0]


def inflate(data: bytes, size: int, **where) -> bytes:
    """One Zstandard frame, without a dictionary, of exactly the declared size."""
    try:
        frame = zstandard.get_frame_parameters(data)
        require(frame.content_size == size and frame.dict_id == 0, "decompression_failed", "frame header", **where)
        unpacker = zstandard.ZstdDecompressor().decompressobj()
        out = unpacker.decompress(data)
    except zstandard.ZstdError as e:
        raise Error("decompression_failed", str(e), **where) from e
    require(len(out) == size and not unpacker.unused_data, "decompression_failed", "frame size", **where)
    return out


def deflate(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3, write_content_size=True, write_checksum=False, write_dict_id=False).compress(data)


def undelta(data: bytes, width: int, height: int) -> bytes:
    """Samples of a raster of residuals; the predictor's inverse is a sum along both axes."""
    x = np.frombuffer(data, "<u2").reshape(height, width).astype(np.uint32)
    return np.cumsum(np.cumsum(x, axis=0, dtype=np.uint32), axis=1, dtype=np.uint32).astype("<u2").tobytes()


def delta(samples: np.ndarray) -> bytes:
    x = samples.astype(np.int64)
    x = np.diff(np.diff(x, axis=0, prepend=0), axis=1, prepend=0)
    return (x & 0xFFFF).astype("<u2").tobytes()


def content_hash(key: int, channels: list[tuple]) -> bytes:
    """Identity of decoded channels (record, data)."""
    parts = [struct.pack("<QH", key, len(channels))]
    for c, data in channels:
        parts.append(struct.pack("<HHBBBBHHIIII", c.channel_id, c.version, c.element, c.components, c.predictor, 0, c.width, c.height, c.flags, len(data), 0, c.parameter1) + data)
    return sha("LTDB_TILE_CONTENT_V1", *parts)


def check_provenance(data: bytes, palette_count: int, primary: int, **where) -> None:
    p = PROVENANCE.read(data)
    require(p.version == 1 and p.palette_count == palette_count > 0 and not (p.reserved0 or p.reserved1) and p.flags & ~1 == 0, "invalid_format", "provenance header", **where)
    palette = [PALETTE.read(data, PROVENANCE.size + i * PALETTE.size) for i in range(p.palette_count)]
    increasing([e.dataset_id for e in palette], "palette ids", **where)
    require(all(e.flags == 0 and 0 <= e.fraction <= 1 and math.isfinite(e.resolution) and e.resolution > 0 for e in palette), "invalid_format", "palette entry", **where)
    require(abs(sum(e.fraction for e in palette) - 1) <= 1e-6, "invalid_format", "contribution fractions", **where)
    require(primary in {e.dataset_id for e in palette}, "invalid_format", "primary dataset", **where)
    at = PROVENANCE.size + p.palette_count * PALETTE.size
    require(bool(p.flags & 1) == (p.index_width in (1, 2)) and len(data) - at == p.width * p.height * p.index_width, "invalid_format", "provenance map", **where)
    if p.flags & 1:
        require(int(np.frombuffer(data, f"<u{p.index_width}", offset=at).max(initial=0)) < p.palette_count, "invalid_format", "map index", **where)


def decode_tile(payload: bytes, entry, path: str = "") -> tuple:
    """Header and channels (record, decoded bytes) of a payload; checked against its index entry."""
    where = {"path": path, "tile_key": f"{entry.key:016x}"}
    h = TILE_HEADER.read(payload)
    require(h.magic == b"LTIL" and h.header_bytes == TILE_HEADER.size, "invalid_format", "tile header", **where)
    require(h.version == 1, "unsupported_version", "tile version", **where)
    require(h.flags & ~3 == 0 and h.profile == 1, "unsupported_feature", "tile flags or encoding", **where)
    require(h.key == entry.key and h.flags == entry.flags and h.channel_count == entry.channel_count and h.primary_dataset == entry.primary_dataset, "invalid_format", "tile header and index disagree", **where)
    require((h.cells, h.core, h.apron) == (256, 257, 1) and h.reserved0 == 0 and not any(h.reserved1), "invalid_format", "tile shape", **where)
    require(h.directory == TILE_HEADER.size and h.directory_bytes == h.channel_count * CHANNEL.size and h.data == align(h.directory + h.directory_bytes) and h.data + h.data_bytes == len(payload), "invalid_format", "tile layout", **where)
    require(h.content_prefix == entry.content_prefix and h.dependency_prefix[:8] == entry.dependency_prefix, "hash_mismatch", "tile identities", **where)
    records = [CHANNEL.read(payload, h.directory + i * CHANNEL.size) for i in range(h.channel_count)]
    increasing([c.channel_id for c in records], "channel ids", **where)
    apart([(c.offset, c.offset + c.stored_bytes) for c in records], "channels", **where)
    out, known = [], True
    for c in records:
        at = where | {"channel": c.channel_id}
        require(c.flags & ~1 == 0 and c.version == 1, "unsupported_feature", "channel flags or version", **at)
        require(c.offset % 8 == 0 and c.offset >= h.data and c.offset + c.stored_bytes <= len(payload), "truncated_data", "channel range", **at)
        stored = payload[c.offset : c.offset + c.stored_bytes]
        require(crc32c(stored) == c.crc32c, "checksum_mismatch", "channel", **at)
        if c.channel_id not in (ELEV, PRVN, QUAL):
            require(not c.flags & 1, "unsupported_feature", "unknown required channel", **at)
            known = False
            continue
        require(c.codec <= 1 and c.element in ELEMENT_BYTES, "unsupported_feature", "codec or element", **at)
        require(c.codec == 1 or c.stored_bytes == c.logical_bytes, "invalid_format", "stored and logical bytes", **at)
        data = inflate(stored, c.logical_bytes, **at) if c.codec else stored
        if c.channel_id == ELEV:
            require((c.element, c.components, c.predictor) == (2, 1, 1) and c.parameter1 == 1 and len(data) == 2 * c.width * c.height, "invalid_format", "elevation channel", **at)
            data = undelta(data, c.width, c.height)
        elif c.channel_id == PRVN:
            require(c.predictor == 0 and c.element == 255, "invalid_format", "provenance channel", **at)
            check_provenance(data, h.palette_count, h.primary_dataset, **at)
        else:
            require(c.predictor == 0 and c.element == 1 and len(data) == c.width * c.height and not any(b & 0xE0 for b in data), "invalid_format", "quality channel", **at)
        out.append((c, data))
    ids = {c.channel_id for c, _ in out}
    require(ELEV in ids and (PRVN in ids) == bool(h.flags & 1) and (QUAL in ids) == bool(h.flags & 2), "invalid_format", "channels and flags disagree", **where)
    require(sum(c.logical_bytes for c in records) == entry.logical_bytes, "invalid_format", "logical bytes", **where)
    if known:
        require(content_hash(h.key, out)[:16] == h.content_prefix, "hash_mismatch", "tile content", **where)
    codes = np.frombuffer(next(d for c, d in out if c.channel_id == ELEV), "<u2")
    require((int(codes.min()), int(codes.max())) == (entry.min_code, entry.max_code), "invalid_format", "elevation range", **where)
    lo, hi = (np.float32(-16384.0 + 0.5 * x) for x in (entry.min_code, entry.max_code))
    require(lo == np.float32(h.min_elevation) and hi == np.float32(h.max_elevation), "invalid_format", "elevation summary", **where)
    for metres, mm in ((h.resolution, entry.resolution_mm), (h.error, entry.error_mm)):
        require(math.isfinite(metres) and math.floor(metres * 1000 + 0.5) == mm, "invalid_format", "resolution or error", **where)
    return h, out


def check_pack(data: bytes, pack, entries: list, path: str = "") -> None:
    """Header, hash, layout and checksums of a whole pack against its registry row and its tiles' entries."""
    h = PACK_HEADER.read(data)
    require(h.magic == b"LTPK" and h.header_bytes == PACK_HEADER.size and h.endian == ENDIAN, "invalid_format", "pack header", path=path)
    require(h.major == 1, "unsupported_version", "pack version", path=path)
    require(h.flags == 0, "unsupported_feature", "pack flags", path=path)
    require((h.pack_id, h.tile_count, h.region, h.file_bytes) == (pack.pack_id, pack.tile_count, PACK_HEADER.size, pack.file_bytes) and len(data) == pack.file_bytes, "invalid_format", "pack header and registry disagree", path=path)
    digest = hashlib.sha256(data[:48])
    digest.update(bytes(16))
    digest.update(data[64:])
    digest = digest.digest()
    require(digest == pack.sha256 and digest[:16] == h.sha256_prefix, "hash_mismatch", "pack", path=path)
    end = PACK_HEADER.size
    for e in entries:
        require(e.payload_offset == align(end) and not any(data[end : e.payload_offset]), "invalid_format", "payload layout", path=path, tile_key=f"{e.key:016x}")
        end = e.payload_offset + e.stored_bytes
        require(crc32c(data[e.payload_offset : end]) == e.payload_crc32c, "checksum_mismatch", "payload", path=path, tile_key=f"{e.key:016x}")
    require(end == len(data), "invalid_format", "bytes after the last payload", path=path)


class Database:
    """An open container: its registries as DataFrames, and its tiles."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        file = spark.read.format("binaryFile").load(path).select("content", "path").take(1)
        require(bool(file), "io_error", "cannot read", path=path)
        self.manifest = Manifest(bytes(file[0][0]), path)
        self.header = self.manifest.header
        self.folder = file[0][1].rsplit("/", 1)[0]

    def table(self, name: str) -> DataFrame:
        """chunks, strings, datasets, packs or tiles."""
        m = self.manifest
        hexed = "{:016x}".format
        rows = {
            "chunks": lambda: [(c.tag.decode(), c.version, c.flags, c.offset, c.stored_bytes, c.logical_bytes, c.crc32c) for c in m.chunks],
            "strings": lambda: list(m.strings.items()),
            "datasets": lambda: [(d["id"], d["flags"], *d["strings"], *d["doubles"], d["bundle_bytes"], d["bundle_hash"], d["meta"].decode(), d["quality"]) for d in m.datasets],
            "packs": lambda: [(p.pack_id, m.strings[p.path_id], p.codec, p.tile_count, p.file_bytes, hexed(p.first_key), hexed(p.last_key), p.sha256) for p in m.packs],
        }
        return self._index(m.tiles) if name == "tiles" else self.spark.createDataFrame(rows[name](), SCHEMAS[name])

    def _index(self, tiles: np.ndarray) -> DataFrame:
        """Entries as rows, handed over as Arrow columns."""
        columns = dict(zip(("face", "level", "morton"), key_parts(tiles["key"]), strict=True)) | {"key_hex": tiles["key"]}
        columns |= {n: tiles[n] for n in ENTRY.names if n not in ("key", "reserved")}
        arrow = {}
        for n, x in columns.items():
            if x.dtype.kind == "V":
                fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(x.dtype.itemsize), len(x), [None, pa.py_buffer(x.tobytes())])
                arrow[n] = fixed.cast(pa.binary())
            else:
                arrow[n] = pa.array(x.astype(np.int64))
        types = dict(c.split() for c in SCHEMAS["tiles"].split(", "))
        hexed = F.lpad(F.lower(F.hex("key_hex")), 16, "0")
        made = [(hexed if n == "key_hex" else F.col(n).cast(kind)).alias(n) for n, kind in types.items()]
        return self.spark.createDataFrame(pa.table(arrow)).select(*made)

    def tile(self, face: int, level: int, morton: int) -> DataFrame:
        """The row of one key; none if the tile is not there."""
        return self._index(self.manifest.below(face, level, morton, level, level))

    def find(self, face: int, level: int, morton: int) -> Row | None:
        return self.tile(face, level, morton).first()

    def channels(self, tiles: DataFrame | None = None) -> DataFrame:
        """Decoded channels of tiles (key_hex), or of all: a row for each, or one with error where a check failed.

        Every pack that holds one is read and checked once. What is no key of a tile, nulls included, is passed over.
        """
        m = self.manifest
        keep = np.ones(len(m.tiles), bool)
        if tiles is not None:
            wanted = tiles.select("key_hex").filter(F.col("key_hex").rlike("^[0-9a-f]{16}$")).distinct().collect()
            keep = np.isin(m.tiles["key"], np.array([int(r[0], 16) for r in wanted], np.uint64))
        scans, size = [], SCAN_BYTES
        for p, own in zip(m.packs, m.of_pack, strict=True):
            if keep[own].any():
                size += len(own) * TILE.size
                if size > SCAN_BYTES:
                    scans.append({})
                    size = len(own) * TILE.size
                scans[-1][m.strings[p.path_id]] = (tuple(p), m.tiles[own].tobytes(), keep[own].tobytes())
        if not scans:
            return self.spark.createDataFrame([], CHANNELS)
        return reduce(DataFrame.unionByName, [self._decoded(packs) for packs in scans])

    def _decoded(self, packs: dict[str, tuple]) -> DataFrame:
        """Channels of packs by path, each as its record, its entries and a mark for each of them that is wanted."""
        folder = self.folder
        files = self.spark.read.format("binaryFile").load([f"{folder}/{f}" for f in packs]).select("path", "content")
        schema = pa.schema([("key_hex", pa.string()), *[(n, pa.int32()) for n in ("channel_id", "element", "codec", "predictor", "width", "height")], ("flags", pa.int64()), ("parameter1", pa.int64()), ("data", pa.binary()), ("error", pa.string())])

        def rows(path: str, content: memoryview) -> Iterator[tuple]:
            pack, own, keep = packs[path[len(folder) + 1 :]]
            own = entries(own)
            try:
                check_pack(content, PACK.type(*pack), own, path)
                failed = None
            except Error as e:
                failed = str(e)
            for e, wanted in zip(own, keep, strict=True):
                if not wanted:
                    continue
                name = f"{e.key:016x}"
                try:
                    if failed:
                        raise ValueError(failed)
                    _, channels = decode_tile(bytes(content[e.payload_offset : e.payload_offset + e.stored_bytes]), e, path)
                    yield from [(name, c.channel_id, c.element, c.codec, c.predictor, c.width, c.height, c.flags, c.parameter1, d, None) for c, d in channels]
                except (Error, ValueError) as x:
                    yield (name, *[None] * 9, str(x))

        def batch_of(held: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], f.type) for i, f in enumerate(schema)], schema=schema)

        def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            for batch in batches:
                for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    for row in rows(path, memoryview(content.as_buffer())):
                        held.append(row)
                        size += len(row[9] or b"")
                        if size > BATCH_BYTES:
                            yield batch_of(held)
                            held, size = [], 0
            if held:
                yield batch_of(held)

        return files.mapInArrow(decode, CHANNELS)

    def read_tile(self, face: int, level: int, morton: int) -> dict[int, bytes]:
        """Decoded channels of one tile by id; not_found without it, and the first failed check raises."""
        if not len(self.manifest.below(face, level, morton, level, level)):
            raise Error("not_found", f"no tile {face}/{level}/{morton}", path=self.path)
        rows = self.channels(self.tile(face, level, morton)).collect()
        for r in rows:
            if r["error"]:
                code, _, message = r["error"].partition(": ")
                raise Error(code, message, path=self.path)
        return {r["channel_id"]: bytes(r["data"]) for r in rows}

    def provenance(self, tiles: DataFrame | None = None) -> DataFrame:
        """Palettes and maps of provenance channels: face, level, morton, palette, map (null without one)."""
        own = self.channels(tiles).filter(f"channel_id = {PRVN}").select("key_hex", "data")

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            entry = pa.struct([("dataset_id", pa.int64()), ("fraction", pa.float32()), ("resolution_m", pa.float32())])
            schema = pa.schema([("face", pa.int32()), ("level", pa.int32()), ("morton", pa.int64()), ("palette", pa.list_(entry)), ("map", pa.list_(pa.int32()))])
            for batch in batches:
                rows = []
                for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    p = PROVENANCE.read(data)
                    palette = [PALETTE.read(data, PROVENANCE.size + i * PALETTE.size) for i in range(p.palette_count)]
                    at = PROVENANCE.size + p.palette_count * PALETTE.size
                    places = np.frombuffer(data, f"<u{p.index_width}", offset=at).tolist() if p.flags & 1 else None
                    rows.append((*key_parts(int(name, 16)), [(e.dataset_id, e.fraction, e.resolution) for e in palette], places))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

        return own.mapInArrow(read, "face int, level int, morton long, palette array<struct<dataset_id:long,fraction:float,resolution_m:float>>, map array<int>")

    def samples(self, tiles: DataFrame | None = None) -> DataFrame:
        """Elevation codes in long form: face, level, morton, y, x, code."""
        elev = self.channels(tiles).filter(f"channel_id = {ELEV}").select("key_hex", "width", "height", "data")

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for name, w, h, data in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                    face, level, m = key_parts(int(name, 16))
                    y, x = np.divmod(np.arange(w * h, dtype=np.int32), w)
                    n = w * h
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, face, np.int32)), pa.array(np.full(n, level, np.int32)), pa.array(np.full(n, m, np.int64)), pa.array(y), pa.array(x), pa.array(np.frombuffer(data, "<u2").astype(np.int32))], ["face", "level", "morton", "y", "x", "code"])

        return elev.mapInArrow(spread, "face int, level int, morton long, y int, x int, code int")

    def subtree(self, face: int, level: int, morton: int) -> DataFrame:
        return self._index(self.manifest.below(face, level, morton, level, keys.MAX_LEVEL)).orderBy("face", "level", "morton")

    def children(self, face: int, level: int, morton: int) -> DataFrame:
        return self._index(self.manifest.below(face, level, morton, level + 1, level + 1)).orderBy("morton")

    def leaves(self, face: int, level: int, morton: int, computed: bool = False) -> DataFrame:
        """Leaves of a subtree by the stored child masks, trusted as they are, or by the tiles themselves."""
        return index.leaves(self.subtree(face, level, morton), None if computed else "child_mask")
