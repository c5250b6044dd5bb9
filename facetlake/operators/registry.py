"""Rules over registries: order, uniqueness, intervals, strings, references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetlake.functions.hashing import align


def not_increasing(rows: DataFrame, order: str, value: str, *by: str) -> DataFrame:
    """Rows whose value is not greater than the one before them in a list; `by` separates lists."""
    w = Window.partitionBy(*by).orderBy(order)
    return rows.withColumn("prev", F.lag(value).over(w)).filter(F.col(value) <= F.col("prev"))


def overlapping(rows: DataFrame, start: str, end: str, *by: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """Rows that start before an earlier interval of their list ends, with that end as reach.

    Nulls come last, as in SQL. Of equal intervals the first in the order of `ties` counts as the earlier one;
    where `ties` does not tell them apart, which of them that is stays open.
    """
    order = [F.asc_nulls_last(c) for c in (start, end, *ties)]
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("reach", F.max(end).over(w)).filter(F.col(start) < F.col("reach"))


def gaps(rows: DataFrame, start: str, end: str, *by: str) -> DataFrame:
    """Rows that start after the one before them ends, with the gap's size."""
    w = Window.partitionBy(*by).orderBy(start, end)
    return rows.withColumn("gap", F.col(start) - F.lag(end).over(w)).filter("gap > 0")


def offsets(rows: DataFrame, order: str, size: Column, *by: str, base: int = 0, to: int = 1) -> DataFrame:
    """offset of each row of a list when sizes, rounded up to `to`, are laid out from base."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("offset", F.lit(base).cast("long") + F.coalesce(F.sum(align(size.cast("long"), to)).over(w), F.lit(0).cast("long")))


def string_table(texts: DataFrame, text: str = "text") -> DataFrame:
    """Distinct non-empty texts in byte order: text, string_id (where its record of length and padded bytes starts), bytes.

    The order is that of the whole table, so ids come from one window; a table of strings has the size of a
    registry, not of data. Record 0 is the empty text.
    """
    own = texts.select(F.col(text).alias("text")).filter("text is not null and text <> ''").distinct()
    own = own.withColumn("bytes", F.octet_length("text").cast("long"))
    out = offsets(own, "text", F.col("bytes") + 4, base=4, to=4)
    return out.select("text", F.col("offset").alias("string_id"), "bytes")


def missing(rows: DataFrame, key: str, known: DataFrame, id_: str) -> DataFrame:
    """Rows whose key is not among the known ids."""
    return rows.join(known.select(F.col(id_).alias("_id")), F.col(key) == F.col("_id"), "left_anti")


def group_summary(rows: DataFrame, by: str, key: str) -> DataFrame:
    """Per group: rows, first and last key."""
    return rows.groupBy(by).agg(F.count("*").alias("n"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))


def ordered_digest(rows: DataFrame, by: str, order: str, item: Column, separator: str = "|") -> DataFrame:
    """Per group: SHA-256 of its items in order, joined. For groups of the size of a registry, as each is put together at once."""
    own = rows.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), item.alias("i")))).alias("items"))
    return own.select(by, F.sha2(F.array_join(F.transform("items", lambda x: x["i"]), separator), 256).alias("digest"))


def dominant(shares: DataFrame, by: list[str], id_: str, share: str) -> DataFrame:
    """Per group: the id of the largest share; of equal ones, the smallest."""
    return shares.groupBy(*by).agg(F.max_by(id_, F.struct(F.col(share), -F.col(id_))).alias("dominant"), F.max(share).alias("share"))


def contribution_errors(palettes: DataFrame, palette: str = "palette") -> DataFrame:
    """Rows whose palette's fractions do not sum to 1 within 1e-6, added in double precision in their order."""
    total = F.aggregate(palette, F.lit(0.0), lambda a, p: a + p["fraction"].cast("double"))
    return palettes.withColumn("total", total).filter(F.abs(F.col("total") - 1.0) > 1e-6)
