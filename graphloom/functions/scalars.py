"""Decoders of single values. Integers wrap and doubles saturate when narrowed; nothing else is coerced."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from graphloom.functions.cells import Cell
from graphloom.functions.decoder import Decoder, from_match
from graphloom.model import DURATION_DDL, POINT_DDL

INT_MAX, LONG_MAX = 2**31 - 1, 2**63 - 1
TWO_POW_63 = 9.223372036854775807e18
TWO_POW_64 = "18446744073709551616"


def wrap(value: Column, bits: int) -> Column:
    """The low bits of a long, sign-extended."""
    name = {8: "tinyint", 16: "smallint", 32: "int"}[bits]
    return F.shiftright(F.shiftleft(value.cast("bigint"), 64 - bits), 64 - bits).cast(name)


def saturate_int(value: Column) -> Column:
    """Truncate a double to an int; out of range goes to the nearest bound, NaN to 0."""
    v = value.cast("double")
    return (
        F.when(F.isnan(v), F.lit(0))
        .when(v >= INT_MAX, F.lit(INT_MAX))
        .when(v <= -INT_MAX - 1, F.lit(-INT_MAX - 1))
        .otherwise(v.cast("int"))
    )


def saturate_long(value: Column) -> Column:
    v = value.cast("double")
    return (
        F.when(F.isnan(v), F.lit(0).cast("bigint"))
        .when(v >= TWO_POW_63, F.lit(LONG_MAX))
        .when(v <= -TWO_POW_63, F.lit(-LONG_MAX - 1))
        .otherwise(v.cast("bigint"))
    )


def signed_from_bytes(col: Column) -> tuple[Column, Column]:
    """Big-endian two's complement bytes as decimal(38,0), and a message where it does not fit.

    Up to 8 bytes are read as one signed number, the last 16 as a signed high and an unsigned low half; bytes before
    them may only repeat the sign. These are short expressions that compile.
    """
    size = F.length(col)
    last = F.substring(col, F.greatest(size - 15, F.lit(1)), F.lit(16))
    low = F.conv(F.hex(F.substring(col, size - 7, F.lit(8))), 16, 10).cast("decimal(20,0)")
    high = _signed(F.substring(last, F.lit(1), F.length(last) - 8)).cast("decimal(20,0)")
    # a product is tried only at the very bound: an overflow that is tried is an exception, and slow
    times = F.lit(TWO_POW_64).cast("decimal(20,0)")
    bound = F.lit(str((10**38 - 1) // 2**64)).cast("decimal(20,0)")
    safe = F.when(F.abs(high) < bound, high).otherwise(0).cast("decimal(20,0)")
    halves = F.when(F.abs(high) < bound, (safe * times).cast("decimal(38,0)") + low).when(
        F.abs(high) == bound, F.try_add(F.try_multiply(high, times), low)
    ).cast("decimal(38,0)")
    before = F.hex(F.substring(col, F.lit(1), size - 16))
    sign = _sign(F.hex(F.substring(last, 1, 1)))
    value = (
        F.when(size == 0, F.lit(None).cast("decimal(38,0)"))
        .when(size <= 8, _signed(col).cast("decimal(38,0)"))
        .when(size <= 16, halves)
        .when(F.replace(before, sign, F.lit("")) == "", halves)
    )
    return value, F.lit("The integer needs more than 38 digits")


def _signed(col: Column) -> Column:
    """Up to 8 bytes as the text of a signed number."""
    digits = F.hex(col)
    return F.conv(F.lpad(digits, 16, _sign(digits)), 16, -10)


def _sign(digits: Column) -> Column:
    return F.when(digits >= "8", "F").otherwise("0")


def _parsed_integer(cell: Cell) -> tuple[Column, Column]:
    value = F.when(cell.col.rlike("^[+-]?[0-9]+$"), cell.col.try_cast("decimal(38,0)"))
    return value, F.concat(F.lit("Couldn't create a BigInt from "), cell.col)


#: Texts that decimal(38,18) holds whatever their digits; all others are looked at more closely.
_SHORT_DECIMAL = "^[+-]?([0-9]{1,20}([.][0-9]{0,18})?|[.][0-9]{1,18})$"
_ANY_DECIMAL = "^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _parsed_decimal(cell: Cell) -> tuple[Column, Column]:
    cast = cell.col.try_cast("decimal(38,18)")
    value = F.when(cell.col.rlike(_SHORT_DECIMAL), cast).when(cell.col.rlike(_ANY_DECIMAL) & _fits_scale(cell.col), cast)
    return value, F.concat(F.lit("Couldn't create a BigDecimal from "), cell.col)


def _fits_scale(text: Column) -> Column:
    """Whether a number's text has no digit but zero beyond 18 decimals."""
    fraction = F.regexp_extract(text, "[.]([0-9]*)", 1)
    digits = F.regexp_replace(F.regexp_extract(text, "^[+-]?([0-9.]*)", 1), "[.]", "")
    exponent = F.coalesce(F.regexp_extract(text, "[eE]([+-]?[0-9]+)$", 1).try_cast("bigint"), F.lit(0))
    zeros = F.length(digits) - F.length(F.rtrim(digits, F.lit("0")))
    return (F.rtrim(digits, F.lit("0")) == "") | (F.length(fraction) - exponent - zeros <= 18)


def _parsed_uuid(cell: Cell) -> tuple[Column, Column]:
    widths = (8, 4, 4, 4, 12)
    pattern = "^" + "-".join(f"([0-9a-fA-F]{{1,{w}}})" for w in widths) + "$"
    groups = [F.lpad(F.regexp_extract(cell.col, pattern, i), w, "0") for i, w in enumerate(widths, 1)]
    value = F.when(cell.col.rlike(pattern), F.lower(F.concat_ws("-", *groups)))
    return value, F.concat(F.lit("Couldn't create an UUID from "), cell.col)


def uuid_of_bytes(col: Column) -> Column:
    """The name-based UUID (version 3) of some bytes."""
    h = F.md5(col)
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("3"), F.substring(h, 14, 3)),
        F.concat(variant, F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    )


def _as_is(cell: Cell) -> Column:
    return cell.col


def from_numeric(type_name: str, ddl: str, of_integer, of_decimal) -> Decoder:
    """A decoder limited to numbers."""
    return from_match(
        type_name, ddl, [("integer", lambda c: of_integer(c.col)), ("decimal", lambda c: of_decimal(c.col))]
    )


integer = from_numeric("int", "int", lambda v: wrap(v, 32), saturate_int)
short = from_numeric("short", "smallint", lambda v: wrap(v, 16), lambda v: wrap(saturate_int(v), 16))
byte = from_numeric("byte", "tinyint", lambda v: wrap(v, 8), lambda v: wrap(saturate_int(v), 8))
long = from_numeric("long", "bigint", lambda v: v, saturate_long)
single = from_numeric("float", "float", lambda v: v.cast("float"), lambda v: v.cast("float"))
double = from_numeric("double", "double", lambda v: v.cast("double"), lambda v: v.cast("double"))

big_integer = from_match(
    "BigInt",
    "decimal(38,0)",
    [
        ("integer", _as_is),
        ("string", _parsed_integer),
        ("bytes", lambda c: signed_from_bytes(c.col)),
    ],
)


def _bounded_decimal(col: Column) -> tuple[Column, Column]:
    return col.try_cast("decimal(38,18)"), F.concat(F.lit("Couldn't create a BigDecimal from "), col.cast("string"))


def _decimal_of_double(col: Column) -> tuple[Column, Column]:
    """The shortest text of a double names it alone, so a value that leads back to the double has lost no digit."""
    value, message = _bounded_decimal(col.cast("string"))
    return F.when(value.cast("double") == col, value), message


def _decimal_of_bytes(cell: Cell) -> tuple[Column, Column]:
    value, message = signed_from_bytes(cell.col)
    return value.try_cast("decimal(38,18)"), message


big_decimal = from_match(
    "BigDecimal",
    "decimal(38,18)",
    [
        ("integer", lambda c: _bounded_decimal(c.col)),
        # The text of a double is its shortest exact form, so 0.1 stays 0.1.
        ("decimal", lambda c: _decimal_of_double(c.col.cast("double"))),
        ("string", _parsed_decimal),
        ("bytes", _decimal_of_bytes),
    ],
)

boolean = from_match("boolean", "boolean", [("boolean", _as_is)])
string = from_match("String", "string", [("string", _as_is)])
binary = from_match("ArraySeq", "binary", [("bytes", _as_is)])
uuid = from_match("UUID", "string", [("string", _parsed_uuid), ("bytes", lambda c: uuid_of_bytes(c.col))])
point = from_match("Point", POINT_DDL, [("point", _as_is)])
iso_duration = from_match("IsoDuration", DURATION_DDL, [("duration", _as_is)])
