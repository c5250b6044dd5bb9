"""Framed SHA-256 identities, byte layout of integers, and CRC-32C."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: the reflected Castagnoli polynomial.
CASTAGNOLI = 0x82F63B78


def le(value: Column, size: int) -> Column:
    """An integer as `size` bytes, least first."""
    digits = F.lpad(F.hex(value.cast("long")), 16, "0")
    return F.unhex(F.concat(*[F.substring(digits, 15 - 2 * i, 2) for i in range(size)]))


def _digits(data: Column, start: int, size: int) -> Column:
    digits = F.hex(F.substring(data, start + 1, size))
    return F.when(F.octet_length(data) >= start + size, F.concat(*[F.substring(digits, 2 * (size - 1 - i) + 1, 2) for i in range(size)]))


def from_le(data: Column, start: int, size: int) -> Column:
    """The integer of `size` bytes, least first, at `start` of a binary; null beyond its end.

    A long for up to 7 bytes; a decimal(20, 0), without a sign, for 8.
    """
    value = F.conv(_digits(data, start, size), 16, 10)
    return value.cast("long") if size < 8 else value.cast("decimal(20,0)")


def float_from_le(data: Column, start: int, size: int) -> Column:
    """The IEEE number of 4 or 8 bytes, least first, at `start` of a binary, as a double; null beyond its end."""
    digits, (fraction, bias) = _digits(data, start, size), {4: (23, 127), 8: (52, 1023)}[size]
    high = F.conv(F.substring(digits, 1, 4), 16, 10).cast("int")  # sign, exponent and the first bits of the fraction
    shift = fraction % 16
    top = (1 << shift) - 1
    exponent = F.call_function("shiftrightunsigned", high.bitwiseAND(F.lit(0x7FFF)), F.lit(shift))
    rest = F.conv(F.substring(digits, 5, 2 * size - 4), 16, 10).cast("long")
    bits = high.bitwiseAND(F.lit(top)).cast("double") * float(1 << (fraction - shift)) + rest
    sign = F.when(high.bitwiseAND(F.lit(0x8000)) != 0, -1.0).otherwise(1.0)
    whole = (bits + float(1 << fraction)) * F.pow(F.lit(2.0), (exponent - (bias + fraction)).cast("double"))
    small = bits * F.lit(2.0 ** (1 - bias - fraction))
    special = F.when(bits == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    return sign * F.when(exponent == 2 * bias + 1, special).when(exponent == 0, small).otherwise(whole)


def framed(domain: str, data: Column) -> Column:
    """SHA-256, in hexadecimal, of the domain, a zero byte, the length as 8 bytes, and the bytes."""
    data = data.cast("binary")
    return F.sha2(F.concat(F.lit(domain.encode() + b"\0"), le(F.octet_length(data), 8), data), 256)


def dataset_id(stable_key: Column) -> Column:
    """The first four bytes of the key's framed hash, least first."""
    digest = F.substring(framed("LTDB_DATASET_V1", stable_key), 1, 8)
    return F.conv(F.concat(*[F.substring(digest, 7 - 2 * i, 2) for i in range(4)]), 16, 10).cast("long")


def database_id(builder_hash: Column, registry_hash: Column) -> Column:
    """The first 16 bytes, in hexadecimal, of the hash over both identities."""
    return F.substring(F.sha2(F.concat(F.lit(b"LTDB_DATABASE_ID_V1\0"), F.unhex(builder_hash), F.unhex(registry_hash)), 256), 1, 32)


def zeroed_hash(data: Column, start: int, size: int) -> Column:
    """SHA-256 of a binary in which `size` bytes from `start` count as zero."""
    return F.sha2(F.concat(F.substring(data, 1, start), F.lit(bytes(size)), F.substring(data, F.lit(start + size + 1), F.length(data))), 256)


def align(n: Column, to: int) -> Column:
    return (n + (to - 1)).bitwiseAND(F.lit(-to))


def _castagnoli() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(CASTAGNOLI), table >> 1)
    return table


_TABLE = _castagnoli()
#: Bytes of a lane; a text of fewer is one lane.
LANE = 1024


def _pairs() -> np.ndarray:
    """What two bytes at a time do to a state's low 16 bits."""
    state = np.arange(1 << 16, dtype=np.uint32)
    for _ in range(2):
        state = _TABLE[state & 0xFF] ^ (state >> 8)
    return state


_PAIRS = _pairs()


class Zeros:
    """Operators, by powers of two, that a run of zero bytes is to a state."""

    def __init__(self):
        bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
        self.tables = [self._table(_TABLE[bits & 0xFF] ^ (bits >> 8))]

    @staticmethod
    def _table(images: np.ndarray) -> np.ndarray:
        """Results for each value of each of the four bytes, from those for each of the 32 bits."""
        out = np.zeros((4, 256), np.uint32)
        value = np.arange(256)
        for bit in range(32):
            out[bit // 8] ^= np.where(value >> bit % 8 & 1, images[bit], np.uint32(0))
        return out

    @staticmethod
    def apply(table: np.ndarray, state: np.ndarray) -> np.ndarray:
        return table[0][state & 0xFF] ^ table[1][state >> 8 & 0xFF] ^ table[2][state >> 16 & 0xFF] ^ table[3][state >> 24]

    def run(self, state: np.ndarray, n: int) -> np.ndarray:
        """The states after n zero bytes."""
        k = 0
        while n >> k:
            if k == len(self.tables):
                bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
                self.tables.append(self._table(self.apply(self.tables[-1], self.apply(self.tables[-1], bits))))
            if n >> k & 1:
                state = self.apply(self.tables[k], state)
            k += 1
        return state


_ZEROS = Zeros()


def crc32c(data: bytes) -> int:
    """CRC-32C: lanes of equal length are read side by side, two bytes at a time, and combined by what their zeros do."""
    raw = np.frombuffer(data, np.uint8)
    n = len(raw)
    lanes = max(1, n // LANE)
    size = n // lanes & ~1
    pairs = raw[: lanes * size].view("<u2").reshape(lanes, size // 2) if size else np.zeros((lanes, 0), np.uint16)
    state = np.zeros(lanes, np.uint32)
    for column in np.ascontiguousarray(pairs.T):
        state = _PAIRS[(state ^ column) & 0xFFFF] ^ (state >> 16)
    # A lane's state is led over the lanes behind it; neighbours first, so that half are left each time.
    while len(state) > 1:
        odd = state[:1] if len(state) % 2 else state[:0]
        rest = state[len(odd) :]
        state = np.concatenate([odd, _ZEROS.run(rest[::2], size) ^ rest[1::2]])
        size *= 2
    whole = _ZEROS.run(np.array([0xFFFFFFFF], np.uint32), lanes * (n // lanes & ~1)) ^ state
    crc = int(whole[0])
    for b in raw[lanes * (n // lanes & ~1) :].tolist():
        crc = int(_TABLE[(crc ^ b) & 0xFF]) ^ (crc >> 8)
    return crc ^ 0xFFFFFFFF


def with_crc32c(df: DataFrame, data: str, name: str = "crc32c") -> DataFrame:
    """df with the CRC-32C of a binary or text column; JVM functions have the IEEE polynomial only."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    at = df.columns.index(data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [None if x is None else crc32c(x.encode() if isinstance(x, str) else x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.int64())], [*batch.schema.names, name])

    return df.mapInArrow(run, f"{fields}, `{name}` long")
