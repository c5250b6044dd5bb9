"""Tile keys: face, level and Morton code, and the 64-bit value 3 + 5 + 56 bits wide.

The value of faces 4 and 5 is negative as a long, so keys are ordered by
(face, level, morton), or by their hexadecimal text, never by the long itself.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_LEVEL = 28
#: The even places of a long, and the bits of a coordinate.
EVEN, COORDINATE = 0x5555555555555555, (1 << 28) - 1
_MORTON = (1 << 56) - 1


def left(x: Column, n: Column | int) -> Column:
    return F.call_function("shiftleft", x, n if isinstance(n, Column) else F.lit(n))


def right(x: Column, n: Column | int) -> Column:
    """Shift to the right that brings in zeros."""
    return F.call_function("shiftrightunsigned", x, n if isinstance(n, Column) else F.lit(n))


def spread(x: Column) -> Column:
    """The low 28 bits of x at the even places of a long: its binary digits, read in base 4."""
    return F.conv(F.bin(x.cast("long").bitwiseAND(F.lit(COORDINATE))), 4, 10).cast("long")


def gather(m: Column) -> Column:
    """The even bits of m, side by side: its digits in base 4, read in base 2."""
    return F.conv(F.conv(m.bitwiseAND(F.lit(EVEN)).cast("string"), 10, 4), 2, 10).cast("long")


def morton(x: Column, y: Column) -> Column:
    return spread(x).bitwiseOR(left(spread(y), 1))


def x_of(m: Column) -> Column:
    return gather(m)


def y_of(m: Column) -> Column:
    return gather(right(m, 1))


def encode(face: Column, level: Column, m: Column) -> Column:
    """The 64-bit key as a long of the same bits."""
    return left(face.cast("long"), 61).bitwiseOR(left(level.cast("long"), 56)).bitwiseOR(m)


def key_hex(face: Column, level: Column, m: Column) -> Column:
    """Sixteen lower-case digits; sorts as the key does."""
    return F.lpad(F.lower(F.hex(encode(face, level, m))), 16, "0")


def face_of(key: Column) -> Column:
    return right(key, 61).cast("int")


def level_of(key: Column) -> Column:
    return right(key, 56).bitwiseAND(F.lit(31)).cast("int")


def morton_of(key: Column) -> Column:
    return key.bitwiseAND(F.lit(_MORTON))


def from_hex(text: Column) -> Column:
    """The long of sixteen hexadecimal digits."""
    high, low = F.conv(F.substring(text, 1, 8), 16, 10).cast("long"), F.conv(F.substring(text, 9, 8), 16, 10).cast("long")
    return left(high, 32).bitwiseOR(low)


def axis(level: Column) -> Column:
    """Tiles along an edge of a face."""
    return left(F.lit(1).cast("long"), level)


def valid(face: Column, level: Column, x: Column, y: Column) -> Column:
    """Whether face, level and coordinates are in range; null counts as out of it."""
    shape = face.between(0, 5) & level.between(0, MAX_LEVEL)
    inside = (x >= 0) & (y >= 0) & (x < axis(F.when(level.between(0, MAX_LEVEL), level).otherwise(0))) & (y < axis(F.when(level.between(0, MAX_LEVEL), level).otherwise(0)))
    return F.coalesce(shape & inside, F.lit(False))


def valid_key(key: Column) -> Column:
    """Whether a 64-bit key has a face, a level, and no bit beyond the level's."""
    level = level_of(key)
    fits = right(morton_of(key), 2 * F.when(level <= MAX_LEVEL, level).otherwise(0)) == 0
    return F.coalesce((face_of(key) <= 5) & (level <= MAX_LEVEL) & fits, F.lit(False))


def text(face: Column, level: Column, x: Column, y: Column) -> Column:
    """Canonical text: QSC/Ff/Lll/xxxx/yyyy, coordinates of four digits or more."""
    return F.format_string("QSC/F%d/L%02d/%04d/%04d", face.cast("int"), level.cast("int"), x.cast("long"), y.cast("long"))


def parse(value: Column) -> Column:
    """Struct (face, level, x, y) of a canonical text; null if it is not one, or out of range."""
    pattern = "^QSC/F([0-9])/L([0-9]{2})/([0-9]{4,9})/([0-9]{4,9})$"
    part = [F.regexp_extract(value, pattern, i + 1) for i in range(4)]
    face, level, x, y = (F.when(p != "", p).cast(t) for p, t in zip(part, ("int", "int", "long", "long"), strict=True))
    good = valid(face, level, x, y) & (text(face, level, x, y) == value)
    return F.when(good, F.struct(face.alias("face"), level.alias("level"), x.alias("x"), y.alias("y")))


def parent(level: Column, m: Column) -> tuple[Column, Column]:
    """Level and Morton code of the parent; null at level 0."""
    return F.when(level > 0, level - 1), F.when(level > 0, right(m, 2))


def quadrant(m: Column) -> Column:
    return m.bitwiseAND(F.lit(3)).cast("int")


def children(level: Column, m: Column) -> Column:
    """Array of the four (level, morton) below; null at the deepest level."""
    below = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda q: F.struct((level + 1).alias("level"), left(m, 2).bitwiseOR(q.cast("long")).alias("morton")))
    return F.when(level < MAX_LEVEL, below)


def ancestors(level: Column, m: Column) -> Column:
    """Array of (level, morton) of the tile and all above it."""
    return F.transform(F.sequence(F.lit(0), level), lambda up: F.struct((level - up).alias("level"), right(m, 2 * up).alias("morton")))


def in_subtree(face: Column, level: Column, m: Column, root_face: Column, root_level: Column, root_m: Column) -> Column:
    """Whether a tile is a root or lies below it."""
    down = F.greatest(level - root_level, F.lit(0))
    return (face == root_face) & (level >= root_level) & (right(m, 2 * down) == root_m)
