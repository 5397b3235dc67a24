"""Big-endian reads and writes on BINARY columns, as built-in JVM expressions.

Spark has no byte-to-integer cast, so a read is ``conv(hex(substring(...)))``. Callers that need several
neighbouring fields read one word of up to eight bytes and cut it with shifts and masks: one conversion
then serves the whole word.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

U32 = 1 << 32


def col_of(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def span(buf: Column, pos, length) -> Column:
    """``length`` bytes from zero-based ``pos``; shorter or empty when the buffer ends earlier."""
    start = F.lit(pos + 1) if isinstance(pos, int) else pos + F.lit(1)
    return F.substring(buf, start, col_of(length))


def uint_of(raw: Column) -> Column:
    """Unsigned value of at most seven bytes; empty bytes and null are 0."""
    return F.coalesce(F.conv(F.hex(raw), 16, 10).cast("bigint"), F.lit(0).cast("bigint"))


def uint(buf: Column, pos, length: int) -> Column:
    return uint_of(span(buf, pos, length))


def bits64_of(raw: Column) -> Column:
    """The bit pattern of up to eight bytes as BIGINT (values from 2^63 come out negative)."""
    return F.coalesce(F.conv(F.hex(raw), 16, -10).cast("bigint"), F.lit(0).cast("bigint"))


def bits64(buf: Column, pos) -> Column:
    return bits64_of(span(buf, pos, 8))


def bitfield(word: Column, shift: int, width: int) -> Column:
    """``width`` bits of a word, ``shift`` bits up from its low end."""
    moved = F.shiftrightunsigned(word, shift) if shift else word
    return moved.bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))


def unsigned(bits: Column) -> Column:
    """Exact DECIMAL(20,0) value of an unsigned 64-bit field kept as a BIGINT bit pattern."""
    exact = bits.cast("decimal(20,0)")
    return F.when(bits < 0, exact + F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(
        exact).cast("decimal(20,0)")


def udiv(bits: Column, divisor: Column | int) -> Column:
    """Unsigned 64-bit division of a bit pattern by a positive whole number."""
    d = col_of(divisor).cast("bigint")
    wide = F.floor(unsigned(bits) / d.cast("decimal(20,0)")).cast("bigint")
    return F.when(d == 1, bits).when(bits >= 0, F.floor(_int_div(bits, d))).otherwise(wide)


def _int_div(a: Column, b) -> Column:
    return F.call_function("div", a, col_of(b).cast("bigint"))


def int_div(a: Column, b) -> Column:
    """Whole-number division, as SQL ``a div b``."""
    return _int_div(a, b)


def wrap32(value: Column) -> Column:
    """Value modulo 2^32, as unsigned 32-bit arithmetic leaves it."""
    return value.bitwiseAND(F.lit(U32 - 1).cast("bigint"))


def uptime_to_epoch(base: Column, uptime: Column, tick: Column) -> Column:
    """Epoch second of an uptime tick: header second minus the age of the tick, with 32-bit wrap."""
    return wrap32(base - int_div(wrap32(uptime - tick), 1000))


def be_hex(value: Column | int, size: int) -> Column:
    """``size`` bytes of a non-negative number, big-endian, as hex digits (for encoders)."""
    return F.lpad(F.hex(col_of(value).cast("bigint")), 2 * size, "0")


def from_hex(*parts: Column) -> Column:
    return F.unhex(F.concat(*parts))
