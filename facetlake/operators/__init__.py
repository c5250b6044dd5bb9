"""DataFrame operators: tile index, rasters, registries, validation, fusion."""
