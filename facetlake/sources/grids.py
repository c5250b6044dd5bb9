"""Elevation sources: text grids with a header of cell size and corner, as rows, as a catalogue, and sampled.

A file has lines `ncols`, `nrows`, `xllcorner` or `xllcenter`, `yllcorner` or `yllcenter`, `cellsize` and perhaps
`nodata_value`, then one line for each row from north to south. Angles are degrees. Files are read by the executors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOG = "source string, rows int, cols int, west double, south double, cell double, no_data double, bytes long, sha256 string"
VALUES = "source string, row int, col int, value double"


def parse(data: bytes) -> tuple[dict, np.ndarray]:
    """Header (rows, cols, centre of the south-west cell, cell, no_data) and values, not a number where there is no data."""
    lines, head = data.decode("ascii").split("\n"), {}
    while lines and lines[0].split() and lines[0].split()[0][0].isalpha():
        name, value = lines.pop(0).split()
        head[name.lower()] = float(value)
    missing = [n for n in ("ncols", "nrows", "cellsize") if n not in head]
    if missing or head["cellsize"] <= 0:
        raise ValueError(f"grid without {missing or 'a positive cellsize'}")
    rows, cols, cell = int(head["nrows"]), int(head["ncols"]), head["cellsize"]
    values = np.array(" ".join(lines).split(), np.float64)
    if len(values) != rows * cols:
        raise ValueError(f"grid of {rows} x {cols} has {len(values)} values")
    no_data = head.get("nodata_value")
    if no_data is not None:
        values[values == no_data] = np.nan
    corner = {a: head[f"{k}llcenter"] if f"{k}llcenter" in head else head[f"{k}llcorner"] + cell / 2 for a, k in (("west", "x"), ("south", "y"))}
    return {"rows": rows, "cols": cols, "cell": cell, "no_data": no_data, **corner}, values.reshape(rows, cols)


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """A row for each file: its size, place, no-data value and identity."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                h, _ = parse(data)
                row = (name, h["rows"], h["cols"], h["west"], h["south"], h["cell"], h["no_data"], len(data), hashlib.sha256(data).hexdigest())
                kinds = (pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], [c.split()[0] for c in CATALOG.split(", ")])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(read, CATALOG)


def values(spark: SparkSession, path: str) -> DataFrame:
    """A row for each cell with data, rows counted from the south."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                _, x = parse(data)
                row, col = np.nonzero(~np.isnan(x[::-1]))
                for a in range(0, len(row), 1 << 16):
                    r, c = row[a : a + (1 << 16)], col[a : a + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(r)), pa.array(r.astype(np.int32)), pa.array(c.astype(np.int32)), pa.array(x[::-1][r, c])], ["source", "row", "col", "value"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(read, VALUES)


def sample(points: DataFrame, sources: DataFrame, cells: DataFrame, most_sources: int = 10_000) -> DataFrame:
    """points (id, lat, lon, in degrees, ids distinct) with a row for each source that covers them: source, value, bilinear.

    A point whose four cells are not all there has no row for that source. The catalogue is broadcast if it has no more
    than most_sources rows; a larger one meets the points by whole degrees of latitude.
    """
    north, east = F.col("south") + (F.col("rows") - 1) * F.col("cell"), F.col("west") + (F.col("cols") - 1) * F.col("cell")
    inside = F.col("lat").between(F.col("south"), north) & F.col("lon").between(F.col("west"), east)
    if sources.count() <= most_sources:
        at = points.join(F.broadcast(sources), inside)
    else:
        bands = sources.withColumn("_band", F.explode(F.sequence(F.floor("south"), F.floor(north))))
        at = points.withColumn("_band", F.floor("lat")).join(bands, "_band").filter(inside).drop("_band")
    for n, origin, size in (("lat", "south", "rows"), ("lon", "west", "cols")):
        place = (F.col(n) - F.col(origin)) / F.col("cell")
        low = F.greatest(F.lit(0), F.least(F.floor(place), F.col(size) - 2)).cast("int")
        at = at.withColumns({f"_{n}0": low, f"_{n}f": place - low})
    weight = lambda f, k: F.col(f) if k else 1 - F.col(f)
    corners = [F.struct((F.col("_lat0") + i).alias("row"), (F.col("_lon0") + j).alias("col"), (weight("_latf", i) * weight("_lonf", j)).alias("w")) for i in (0, 1) for j in (0, 1)]
    asked = at.select("id", "source", F.explode(F.array(*corners)).alias("c")).select("id", "source", "c.*").filter("w > 0")
    found = asked.join(cells, ["source", "row", "col"]).groupBy("id", "source").agg(F.sum(F.col("w") * F.col("value")).alias("value"), F.sum("w").alias("w"))
    return points.join(found.filter("w > 1 - 1e-9").drop("w"), "id")
