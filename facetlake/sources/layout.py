"""Byte layout of the container, version 1.

Fixed values, as the format states them: record layouts in struct notation with the
names of their fields, tags, and domains of hashes.
"""

from __future__ import annotations

import hashlib
import struct
from collections import namedtuple


class Error(Exception):
    """A failed check: code, message and where (path, offset, tile_key, channel)."""

    def __init__(self, code: str, message: str, **where):
        super().__init__(f"{code}: {message}" + "".join(f", {k}={v}" for k, v in where.items()))
        self.code, self.message, self.where = code, message, where


class Record:
    def __init__(self, name: str, layout: str, fields: str):
        self.struct, self.type = struct.Struct("<" + layout), namedtuple(name, fields)
        self.size = self.struct.size
        self._of = (name, layout, fields)

    def __reduce__(self):
        return Record, self._of

    def read(self, data: bytes, at: int = 0):
        if at < 0 or at + self.size > len(data):
            raise Error("truncated_data", f"{self.type.__name__} needs {self.size} bytes", offset=at)
        return self.type(*self.struct.unpack_from(data, at))

    def write(self, *values, **named) -> bytes:
        return self.struct.pack(*self.type(*values, **named))


HEADER = Record("Header", "4sHHIIIIQ16sdddHHBBBBQII32s32s32s32s32s", "magic major minor header_bytes endian flags chunk_count directory database_id radius origin step cells core apron max_level projection quantization tile_count dataset_count pack_count builder_hash registry_hash index_hash content_hash reserved")
CHUNK = Record("Chunk", "4sHHQQQII", "tag version flags offset stored_bytes logical_bytes crc32c reserved")
DATASET = Record("Dataset", "II8IddddQ32sIIII", "dataset_id flags s0 s1 s2 s3 s4 s5 s6 s7 resolution h_accuracy v_accuracy no_data bundle_bytes bundle_hash meta_offset meta_bytes quality_schema reserved")
PACK = Record("Pack", "IIIHHQQQQ32s", "pack_id flags path_id codec reserved tile_count file_bytes first_key last_key sha256")
TILE = Record("Tile", "QIIQIIHHIIIBBHI16s8s", "key pack_id flags payload_offset stored_bytes logical_bytes min_code max_code primary_dataset resolution_mm error_mm child_mask channel_count reserved payload_crc32c content_prefix dependency_prefix")
PACK_HEADER = Record("PackHeader", "4sHHIIIIQQQ16s", "magic major minor header_bytes endian pack_id flags tile_count region file_bytes sha256_prefix")
TILE_HEADER = Record("TileHeader", "4sHHQIHHHBBffffIHHIIII16s16s28s", "magic version header_bytes key flags channel_count cells core apron profile resolution error min_elevation max_elevation primary_dataset palette_count reserved0 directory directory_bytes data data_bytes dependency_prefix content_prefix reserved1")
CHANNEL = Record("Channel", "HHBBBBHHIIIIIII", "channel_id version element components codec predictor width height flags offset stored_bytes logical_bytes crc32c parameter0 parameter1")
PROVENANCE = Record("Provenance", "HHHHBBHI", "version palette_count width height index_width reserved0 flags reserved1")
PALETTE = Record("Palette", "IIff", "dataset_id flags fraction resolution")

ENDIAN, UNKNOWN = 0x01020304, 0x7FF8000000000000
MANDATORY = (b"DSET", b"META", b"PACK", b"STRS", b"TIDX")
ELEV, PRVN, QUAL = 1, 2, 3
#: Element types and the bytes of one.
ELEMENT_BYTES = {1: 1, 2: 2, 3: 2, 4: 4, 5: 4, 6: 8, 7: 4, 255: 1}


def align(n: int, to: int = 8) -> int:
    return -(-n // to) * to


def sha(domain: str, *parts: bytes) -> bytes:
    """SHA-256 over a domain, a zero byte, and parts."""
    return hashlib.sha256(domain.encode() + b"\0" + b"".join(parts)).digest()


def framed(domain: str, data: bytes) -> bytes:
    return sha(domain, struct.pack("<Q", len(data)), data)


def require(condition: bool, code: str, message: str, **where) -> None:
    if not condition:
        raise Error(code, message, **where)
