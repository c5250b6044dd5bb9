"""Build configuration: typed TOML, its canonical JSON, and the identities hashed from it."""

from __future__ import annotations

import json
import math
import re
import struct
import tomllib
from dataclasses import dataclass
from pathlib import Path

from facetlake.sources.layout import UNKNOWN, Error, framed, require, sha

#: Tables, keys and defaults of a configuration.
DEFAULTS = {
    "database": {"name": str, "output_directory": ".", "format_major": 1, "format_minor": 0},
    "datum": {"reference_radius_m": 1737400.0, "elevation_origin_m": -16384.0, "elevation_step_m": 0.5},
    "projection": {"type": "qsc", "version": 1},
    "tiles": {"cells": 256, "apron": 1, "max_level": 0},
    "packaging": {"target_pack_bytes": 1073741824, "codec": "zstd", "codec_level": 3},
    "synthetic": {"stable_key": "synthetic.p0.v1", "source_uri": "synthetic://analytic-v1", "amplitude_meters": 2048},
    "local": {"threads": 1, "cache_directory": ".ltbuild"},
}
#: Tables whose values one format version allows.
FROZEN = ("datum", "projection", "tiles")
RESOLUTION = 10000


@dataclass(frozen=True)
class Config:
    name: str
    output: Path
    cache: Path
    target_pack_bytes: int
    stable_key: str
    source_uri: str
    amplitude: int
    threads: int
    producer: str = "facetlake"
    crs: str = "QSC_v1"


def load(path: str | Path) -> Config:
    """The configuration in a TOML file; unknown keys, wrong types and unsupported values are errors."""
    path = Path(path)
    try:
        root = tomllib.loads(path.read_text())
    except OSError as e:
        raise Error("io_error", str(e), path=str(path)) from e
    except (tomllib.TOMLDecodeError, UnicodeDecodeError) as e:
        raise Error("parse_error", str(e), path=str(path)) from e
    for t, values in root.items():
        require(t in DEFAULTS and isinstance(values, dict), "invalid_argument", f"unknown table {t!r}", path=str(path))
        for k in values:
            require(k in DEFAULTS[t], "invalid_argument", f"unknown key '{t}.{k}'", path=str(path))
    got: dict[str, dict] = {}
    for t, defaults in DEFAULTS.items():
        got[t] = {}
        for k, default in defaults.items():
            value, kind = root.get(t, {}).get(k, default), default if isinstance(default, type) else type(default)
            require(value is not default or not isinstance(default, type), "invalid_argument", f"'{t}.{k}' is required", path=str(path))
            if kind is float and type(value) is int:
                value = float(value)
            require(type(value) is kind, "invalid_argument", f"'{t}.{k}' must be a {kind.__name__}", path=str(path))
            got[t][k] = value
    d, p, s, o = got["database"], got["packaging"], got["synthetic"], got["local"]
    checks = [(re.fullmatch(r"[A-Za-z0-9._-]+", d["name"]) and d["name"] not in (".", ".."), "database.name must be a portable name"), ((d["format_major"], d["format_minor"]) == (1, 0), "only format 1.0 is written")]
    checks += [(got[t] == DEFAULTS[t], f"[{t}] has values that format 1 does not allow") for t in FROZEN]
    checks += [
        (p["target_pack_bytes"] > 0, "packaging.target_pack_bytes must be positive"),
        ((p["codec"], p["codec_level"]) == ("zstd", 3), "packaging is Zstandard level 3"),
        (re.fullmatch("[a-z0-9._-]+", s["stable_key"]), "synthetic.stable_key has other characters than a-z, 0-9, '.', '_', '-'"),
        (s["source_uri"] and "\0" not in s["source_uri"], "synthetic.source_uri must be non-empty without NUL"),
        (0 <= s["amplitude_meters"] <= 8000, "synthetic.amplitude_meters must be 0 to 8000"),
        (0 < o["threads"] < 1 << 32, "local.threads is out of range"),
    ]
    for good, message in checks:
        require(bool(good), "invalid_argument", message, path=str(path))
    return Config(d["name"], (path.parent / d["output_directory"]).resolve(), (path.parent / o["cache_directory"]).resolve(), p["target_pack_bytes"], s["stable_key"], s["source_uri"], s["amplitude_meters"], o["threads"])


def canonical(value) -> str:
    """JSON with sorted keys and no white space; whole floats print as integers."""

    def plain(x):
        if isinstance(x, dict):
            return {k: plain(v) for k, v in x.items()}
        if isinstance(x, list | tuple):
            return [plain(v) for v in x]
        if isinstance(x, float):
            require(math.isfinite(x), "invalid_argument", "JSON has no NaN or infinity")
            return int(x) if x == int(x) else x
        return x

    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def semantic_json(c: Config) -> str:
    """What changes sampled values."""
    return canonical({
        "algorithm_version": 1,
        "datasets": [{"amplitude_meters": c.amplitude, "source_uri": c.source_uri, "stable_key": c.stable_key}],
        "datum": {"elevation_origin_m": -16384, "elevation_step_m": 0.5, "reference_radius_m": 1737400},
        "fusion": {"algorithm": "synthetic_analytic_v1", "version": 1},
        "projection": {"id": 1, "version": 1},
        "quantization": {"id": 1},
        "tiles": {"apron": 1, "cells": 256, "maximum_level": 0},
    })


def builder_json(c: Config) -> str:
    """What changes bytes of the package as well."""
    package = {"codec": "zstd", "codec_level": 3, "format_major": 1, "format_minor": 0, "name": c.name, "pack_naming_policy": "database_id_v1", "target_pack_bytes": c.target_pack_bytes}
    return '{"package":' + canonical(package) + ',"semantic":' + semantic_json(c) + "}"


def dataset_id(stable_key: str) -> int:
    return struct.unpack_from("<I", framed("LTDB_DATASET_V1", stable_key.encode()))[0]


@dataclass(frozen=True)
class Identity:
    builder_hash: bytes
    semantic_hash: bytes
    dataset_id: int


def identify(c: Config) -> Identity:
    return Identity(framed("LTDB_BUILDER_CONFIG_V1", builder_json(c).encode()), framed("LTDB_SEMANTIC_CONFIG_V1", semantic_json(c).encode()), dataset_id(c.stable_key))


def bundle_hash(members: list[tuple[str, int, bytes]]) -> bytes:
    """Hash of an ordered bundle of (name, bytes, SHA-256)."""
    parts = [struct.pack("<I", len(members))]
    for name, size, digest in sorted(members, key=lambda m: m[0].encode()):
        parts.append(struct.pack("<I", len(name.encode())) + name.encode() + struct.pack("<Q", size) + digest)
    return sha("LTDB_ARTIFACT_BUNDLE_V1", *parts)


def registry_hash(datasets: list[dict]) -> bytes:
    """Identity of datasets (id, flags, strings, doubles, bundle_bytes, bundle_hash, meta, quality) in order of id."""
    parts = [struct.pack("<I", len(datasets))]
    for d in sorted(datasets, key=lambda d: d["id"]):
        parts.append(struct.pack("<II", d["id"], d["flags"]))
        parts += [struct.pack("<Q", len(s.encode())) + s.encode() for s in d["strings"]]
        parts += [struct.pack("<Q", UNKNOWN) if x is None else struct.pack("<d", x) for x in d["doubles"]]
        parts.append(struct.pack("<Q", d["bundle_bytes"]) + d["bundle_hash"] + struct.pack("<Q", len(d["meta"])) + d["meta"] + struct.pack("<I", d["quality"]))
    return sha("LTDB_DATASET_REGISTRY_V1", *parts)
