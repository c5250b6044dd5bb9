"""Source catalogue: rules that a source must meet before it is read, and its coverage of tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetlake.functions import checks


def rules(radius: float = 1737400.0) -> list[tuple[str, Column]]:
    """Name and condition of each violation, over a catalogue (datum, projection, sample_kind, pixel_scale, no_data, nodata_declared, radius_m)."""
    c = F.col
    return [
        ("unknown_datum", F.coalesce(c("datum") == "", F.lit(True)) | ~checks.positive(c("radius_m")) | (c("radius_m") != radius)),
        ("missing_projection", F.coalesce(c("projection") == "", F.lit(True))),
        ("ambiguous_samples", ~F.coalesce(c("sample_kind").isin("radius", "elevation"), F.lit(False))),
        ("bad_pixel_scale", ~checks.positive(c("pixel_scale"))),
        ("undeclared_no_data", F.coalesce(c("nodata_declared"), F.lit(False)) & c("no_data").isNull()),
    ]


def violations(catalog: DataFrame, id_: str = "dataset") -> DataFrame:
    """A row (id, rule) for each rule that a source breaks; nulls break the rules that need a value."""
    broken = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules()]))
    return catalog.select(id_, F.explode(broken).alias("rule"))


def palette_entries(palettes: DataFrame, palette: str = "palette") -> DataFrame:
    """A row for each entry of each palette: its place (pos) and its fields."""
    keep = [c for c in palettes.columns if c != palette]
    return palettes.select(*keep, F.posexplode(palette).alias("pos", "_e")).select(*keep, "pos", "_e.*")


def map_entries(tiles: DataFrame, map_: str = "map", palette: str = "palette") -> DataFrame:
    """A row for each place of a provenance map: pos and the dataset its index names; null for one beyond the palette."""
    keep = [c for c in tiles.columns if c not in (map_, palette)]
    out = tiles.select(*keep, palette, F.posexplode(map_).alias("pos", "_i"))
    return out.select(*keep, "pos", F.get(F.transform(palette, lambda p: p["dataset_id"]), F.col("_i")).alias("dataset_id"))
