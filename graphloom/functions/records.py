"""Decoders of records: fields by name or by position, into named structs."""

from __future__ import annotations

import dataclasses
import datetime as dt
import decimal as dec
import typing
import uuid as uuid_module
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.functions import collections as coll
from graphloom.functions import scalars, temporal
from graphloom.functions.cells import MISSING, Cell, Record
from graphloom.functions.decoder import (
    FOR_FIELD,
    NOT_FOUND,
    Decoded,
    Decoder,
    choose_first,
    could_not_decode,
    error,
    merge,
    no_errors,
    unpack,
)


def structural(kinds: tuple[str, ...], type_name: str) -> Decoder:
    """A decoder that takes exactly some structural kinds and leaves the value unchanged."""

    def run(cell: Cell) -> Decoded:
        sole = cell.sole()
        tries = ([sole] if sole else []) + [(F.lit(True), cell)]
        found = []
        for guard, c in tries:
            for kind in kinds:
                if c.kind == kind or (c.is_variant and kind == "map"):
                    found.append((guard & c.holds(kind), c.read(kind).col, no_errors()))
        fail = could_not_decode(cell, type_name)
        if not found:
            return Decoded(F.lit(None), fail)
        return choose_first(found, F.when(F.lit(False), found[0][1]), fail)

    return Decoder(run, kinds)


node = structural(("node",), "Node")
relationship = structural(("relationship",), "Relationship")
path = structural(("path",), "Path")
any_object = structural(("node", "relationship", "map"), "Object")


def objects_of(cell: Cell) -> list[tuple[Column, Cell]]:
    """Ways to read a cell as an object with named members, each with its row condition."""
    sole = cell.sole()
    ways = [(sole[0] & test, obj) for test, obj in _objects(sole[1])] if sole else []
    return ways + _objects(cell)


def _objects(cell: Cell) -> list[tuple[Column, Cell]]:
    if cell.kind in ("node", "relationship"):
        return [(cell.holds(cell.kind), cell.field("properties"))]
    if cell.is_variant or cell.kind == "map":
        return [(cell.holds("map"), cell)]
    return []


def from_object(run: Callable[[Cell], Decoded]) -> Decoder:
    def decode(cell: Cell) -> Decoded:
        outcomes = [(test, run(obj)) for test, obj in objects_of(cell)]
        fail = could_not_decode(cell, "Object")
        if not outcomes:
            return Decoded(F.lit(None), fail)
        if isinstance(cell, Record) and len(outcomes) == 1:
            # A row is always an object, so the failure text, which shows every column, is not needed.
            return outcomes[0][1]
        return _first(outcomes, fail)

    return Decoder(decode, ("map",))


def _first(outcomes: list[tuple[Column, Decoded]], fail: Column) -> Decoded:
    nothing = F.when(F.lit(False), outcomes[0][1].value)
    return choose_first([(t, d.value, d.errors) for t, d in outcomes], nothing, fail)


def get_as(obj: Cell, key: str, decoder: Decoder) -> Decoded:
    """A typed read. A missing key decodes as null; if that fails, both errors are reported."""
    present = obj.has_field(key)
    found = decoder(obj.field(key))
    if found.packed is None:
        found = Decoded(found.value, _for_field(found.errors, key))
    else:
        # Held by a lambda variable, since naming the field looks at the errors several times.
        named_errors = F.transform(
            F.array(found.packed),
            lambda r: F.struct(r["value"].alias("value"), _for_field(r["errors"], key).alias("errors")),
        )
        found = unpack(F.get(named_errors, F.lit(0)))
    if present is True:
        return found
    absent = decoder(MISSING)
    not_there = error("property_not_found", F.lit(NOT_FOUND.format(key)), key)
    absent = Decoded(
        absent.value, F.when(absent.ok, absent.errors).otherwise(F.concat(absent.errors, not_there))
    )
    if present is False:
        return absent
    return Decoded(
        F.when(present, found.value).otherwise(absent.value),
        F.when(present, found.errors).otherwise(absent.errors),
    )


def _for_field(errors: Column, key: str) -> Column:
    """Name the field in a single coercion error; other errors stay as they are."""
    only = F.size(errors) == 1
    first = F.get(errors, F.lit(0))
    named = error("incoercible", F.concat(first["message"], F.lit(FOR_FIELD.format(key))), key)
    return F.when(only & (first["kind"] == "incoercible"), named).otherwise(errors)


def field(key: str, decoder: Decoder) -> Decoder:
    """One named field of an object."""
    return from_object(lambda obj: get_as(obj, key, decoder))


Fields = dict[str, "Decoder | tuple[str, Decoder]"]


def named(fields: Fields, into: Callable[..., Column] | None = None) -> Decoder:
    """Fields by name into a struct, or into a function of them. ``target: (source, decoder)`` renames."""

    def run(obj: Cell) -> Decoded:
        parts = {}
        for target, spec in fields.items():
            source, decoder = spec if isinstance(spec, tuple) else (target, spec)
            parts[target] = get_as(obj, source, decoder)
        return merge(parts, into)

    return from_object(run)


def positional(fields: dict[str, Decoder], into: Callable[..., Column] | None = None) -> Decoder:
    """The first values in order into a struct; missing ones read as null, further ones are ignored."""
    names, decoders = list(fields), list(fields.values())

    def run(values: coll.Values) -> Decoded:
        return merge({n: d(values.at(i)) for i, (n, d) in enumerate(zip(names, decoders))}, into)

    return coll.from_values(run)


def tuple_of(*decoders: Decoder) -> Decoder:
    return positional({f"_{i + 1}": d for i, d in enumerate(decoders)})


tuple_named = named
product = positional
product_named = named
from_function_named = named
from_function = positional


def with_default(decoder: Decoder, default: Column) -> Decoder:
    """The default where the field is absent or null."""
    return coll.option(decoder).map(lambda v: F.coalesce(v, default))


# -- derivation ------------------------------------------------------------------------------
_BY_TYPE = {
    T.ByteType: scalars.byte,
    T.ShortType: scalars.short,
    T.IntegerType: scalars.integer,
    T.LongType: scalars.long,
    T.FloatType: scalars.single,
    T.DoubleType: scalars.double,
    T.DecimalType: scalars.big_decimal,
    T.StringType: scalars.string,
    T.BooleanType: scalars.boolean,
    T.BinaryType: scalars.binary,
    T.DateType: temporal.date,
    T.TimestampNTZType: temporal.datetime,
}

_BY_CLASS = {
    bool: scalars.boolean,
    int: scalars.long,
    float: scalars.double,
    str: scalars.string,
    bytes: scalars.binary,
    dec.Decimal: scalars.big_decimal,
    dt.date: temporal.date,
    dt.time: temporal.time,
    dt.datetime: temporal.datetime,
    uuid_module.UUID: scalars.uuid,
}


def derive(target) -> Decoder:
    """A decoder from a Spark type or a Python type; records go by exact field name.

    A nullable Spark field and an ``X | None`` annotation decode as options.
    """
    if isinstance(target, T.StructType):
        fields = {}
        for f in target.fields:
            decoder = derive(f.dataType)
            fields[f.name] = coll.option(decoder) if f.nullable else decoder
        return named(fields)
    if isinstance(target, T.ArrayType):
        return coll.list_of(derive(target.elementType))
    if isinstance(target, T.MapType):
        return coll.object_map(derive(target.valueType)).map(coll.as_map)
    if isinstance(target, T.DataType):
        return _BY_TYPE[type(target)]
    if dataclasses.is_dataclass(target):
        hints = typing.get_type_hints(target)
        return named({f.name: derive(hints[f.name]) for f in dataclasses.fields(target)})
    origin, args = typing.get_origin(target), typing.get_args(target)
    if origin is list:
        return coll.list_of(derive(args[0]))
    if origin is dict:
        return coll.object_map(derive(args[1])).map(coll.as_map)
    if origin is not None and type(None) in args:
        return coll.option(derive(next(a for a in args if a is not type(None))))
    if origin is not None and len(args) == 2:
        return coll.either(derive(args[0]), derive(args[1]))
    return _BY_CLASS[target]
