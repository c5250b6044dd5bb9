"""Fusion of elevation sources on common samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetlake.functions import elevation
from facetlake.operators import raster


def replace(values: DataFrame, by: list[str], value: str, dataset: str, priority: str) -> DataFrame:
    """Per sample, the value of highest priority; then of the smallest dataset, then the smallest. An aggregate, not a sort."""
    best = values.groupBy(*by).agg(F.min(F.struct((-F.col(priority)).alias("p"), F.col(dataset).alias("d"), F.col(value).alias("v"))).alias("b"))
    return best.select(*by, F.col("b.v").alias(value), F.col("b.d").alias(dataset), (-F.col("b.p")).alias(priority))


def canonical(candidates: DataFrame, by: list[str], radius: float = 1737400.0) -> DataFrame:
    """Per place, what the sources (dataset, priority, weight, value, flags) say of it: elevation, primary, contributions, quality.

    A value whose flags have bit 0 is a radius. Null and non-finite values, and weights not above 0, do not count. The
    primary source is that of highest priority, then of the smallest dataset; elevation is the mean over the sources of
    its priority, weighed; contributions are their datasets with their shares, ascending; quality joins their flags,
    less bit 0, with bit 2 for several. A place without a source has no row; repeated rows count as often as they stand.
    """
    own = candidates.withColumn("_h", elevation.to_elevation(F.col("value"), F.col("flags"), radius))
    own = own.filter(F.col("_h").isNotNull() & ~F.isnan("_h") & (F.abs("_h") < float("inf")) & (F.col("weight") > 0))
    each = own.groupBy(*by, "priority", "dataset").agg(F.sum(F.col("weight") * F.col("_h")).alias("h"), F.sum("weight").alias("w"), F.bit_or(F.col("flags").bitwiseAND(F.lit(~1))).alias("q"))
    level = each.groupBy(*by, "priority").agg(F.sum("h").alias("h"), F.sum("w").alias("w"), F.min("dataset").alias("primary"), F.bit_or("q").alias("q"), F.array_sort(F.collect_list(F.struct("dataset", F.col("w").alias("w")))).alias("c"))
    best = level.groupBy(*by).agg(F.max_by(F.struct("h", "w", "primary", "q", "c"), "priority").alias("b"))
    shares = F.transform("b.c", lambda x: F.struct(x["dataset"].alias("dataset"), (x["w"] / F.col("b.w")).alias("fraction")))
    several = F.when(F.size("b.c") > 1, 4).otherwise(0)
    return best.select(*by, (F.col("b.h") / F.col("b.w")).alias("elevation"), F.col("b.primary").alias("primary"), shares.alias("contributions"), F.col("b.q").bitwiseOR(several).alias("quality"))


def bias_corrected(samples: DataFrame, by: list[str], fine: str, coarse: str) -> DataFrame:
    """h: the fine value less its mean difference from the coarse one in its group."""
    bias = samples.groupBy(*by).agg((F.sum(F.col(fine) - F.col(coarse)).cast("double") / F.count("*")).alias("_b"))
    return samples.join(bias, by).withColumn("h", F.col(fine) - F.col("_b")).drop("_b")


def residual(samples: DataFrame, coarse: str, fine: str, distance: Column, width: int = 32) -> DataFrame:
    """h: the coarse value plus the fine one's detail above its low pass, faded in over `width` samples."""
    out = raster.low_pass(samples, fine)
    return out.withColumn("h", F.col(coarse) + raster.smoothstep(distance, width) * (F.col(fine) - F.col("smooth"))).drop("smooth")
