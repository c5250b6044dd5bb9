"""Predicates over headers, flags, names and values. Null counts as a failed check."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sure(x: Column) -> Column:
    return F.coalesce(x, F.lit(False))


def only_flags(flags: Column, known: int) -> Column:
    """No bit beyond the known ones."""
    return _sure(flags.bitwiseAND(F.lit(~known)) == 0)


def feature_error(known: Column, flags: Column) -> Column:
    """'unsupported_feature' for an unknown record that is required (bit 0), else null."""
    return F.when(~known & (flags.bitwiseAND(F.lit(1)) == 1), "unsupported_feature")


def range_fits(offset: Column, size: Column, total: Column) -> Column:
    """offset + size <= total, without the sum that could overflow."""
    return _sure((offset >= 0) & (size >= 0) & (offset <= total) & (size <= total - offset))


def all_zero(data: Column) -> Column:
    return _sure(F.hex(data).rlike("^0*$"))


def has_magic(data: Column, magic: str) -> Column:
    return _sure(F.substring(data, 1, len(magic)) == F.lit(magic.encode()))


def finite(x: Column) -> Column:
    return _sure(~F.isnan(x) & (F.abs(x) < float("inf")))


def positive(x: Column) -> Column:
    return finite(x) & _sure(x > 0)


def plain_text(data: Column) -> Column:
    """Valid UTF-8 without NUL."""
    return _sure(F.is_valid_utf8(data.cast("string")) & ~F.hex(data).rlike("^(..)*00"))


def portable_path(path: Column) -> Column:
    """Relative, with '/' only, no drive, and no empty, '.' or '..' segment."""
    return _sure(~path.rlike(r"[\\:\x00]") & path.rlike(r"^[^/]+(/[^/]+)*$") & ~path.rlike(r"(^|/)\.{1,2}(/|$)"))


def portable_name(name: Column) -> Column:
    return _sure(name.rlike("^[A-Za-z0-9._-]+$") & ~name.isin(".", ".."))


def stable_key(key: Column) -> Column:
    return _sure(key.rlike("^[a-z0-9._-]+$"))


def json_object(text: Column) -> Column:
    return _sure(F.try_parse_json(text).isNotNull() & text.startswith("{") & text.endswith("}"))


def quality_bits(samples: Column) -> Column:
    """No sample of an array has one of the reserved bits 5 to 7."""
    return _sure(F.forall(samples, lambda x: x.bitwiseAND(F.lit(224)) == 0))


def digest_prefix(digest: Column, prefix: Column) -> Column:
    """Whether a hexadecimal digest begins with a prefix of it, in either case."""
    return _sure(F.lower(digest).startswith(F.lower(prefix)))


def is_digest(text: Column) -> Column:
    return _sure(text.rlike("^[0-9a-fA-F]{64}$"))


#: The first number that 64 bits without a sign do not hold.
TOP = 1 << 64


def checked(op: str, a: Column, b: Column) -> Column:
    """Struct (value, error) of a sum ('add') or product ('multiply') of numbers without a sign: 'arithmetic_overflow', and no value, beyond 64 bits."""
    x, y, top = a.cast("decimal(20,0)"), b.cast("decimal(20,0)"), F.lit(str(TOP)).cast("decimal(38,0)")
    out = x + y if op == "add" else F.try_multiply(x, y)
    fits = F.coalesce(out < top, F.lit(False))
    known = a.isNotNull() & b.isNotNull()
    return F.struct(F.when(fits, out).cast("decimal(20,0)").alias("value"), F.when(known & ~fits, "arithmetic_overflow").alias("error"))


#: Names of the error codes, from 0.
ERRORS = (
    "none invalid_argument invalid_tile_key parse_error io_error truncated_data arithmetic_overflow invalid_format "
    "unsupported_version unsupported_feature checksum_mismatch hash_mismatch decompression_failed not_found internal_error"
).split()


def error_name(code: Column) -> Column:
    names = F.array(*map(F.lit, ERRORS))
    return F.when(code.between(0, len(ERRORS) - 1), F.element_at(names, code + 1)).otherwise("unknown")
