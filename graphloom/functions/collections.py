"""Decoders of lists, sets, pairs and maps. The first element that fails decides the error."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.functions.cells import MISSING, Cell, Record
from graphloom.functions.decoder import (
    KEY_ERROR,
    NOT_FOUND,
    Decoded,
    Decoder,
    choose_first,
    could_not_decode,
    error,
    merge,
    no_errors,
)
from graphloom.functions.params import as_variant


# Kinds a VARIANT can hold.
ALL_KINDS = (
    "null", "integer", "decimal", "string", "boolean", "bytes", "date", "local_datetime", "map", "list", "unknown"
)


@dataclass(frozen=True)
class Values:
    """The values of a cell in order: cells known by position, or an array read per row."""

    cells: list[Cell] | None = None
    array: Cell | None = None

    def at(self, index: int) -> Cell:
        if self.cells is not None:
            return self.cells[index] if index < len(self.cells) else MISSING
        return Cell(F.get(self.array.col, F.lit(index)), self.array.dtype.elementType)

    def count(self) -> Column:
        return F.lit(len(self.cells)) if self.cells is not None else F.size(self.array.col)

    def decode_each(self, element: Decoder) -> tuple[Column, Column]:
        """An array of decoded values, and the errors of the first failure."""
        if self.cells is not None:
            parts = [element(c) for c in self.cells]
            values = F.array(*[p.value for p in parts])
            failures = [F.when(~p.ok, p.errors) for p in parts]
            return values, F.coalesce(*failures, no_errors())
        dtype = self.array.dtype.elementType
        steps = F.transform(self.array.col, lambda x: element(Cell(x, dtype)).column())
        values = F.transform(steps, lambda s: s["value"])
        failures = F.filter(F.transform(steps, lambda s: s["errors"]), lambda e: F.size(e) > 0)
        return values, F.coalesce(F.get(failures, F.lit(0)), no_errors())


def values_of(cell: Cell) -> list[tuple[Column, Values]]:
    """Ways to read a cell as values, each with its row condition: list, object values, property list."""
    ways: list[tuple[Column, Values]] = []
    sole = cell.sole()
    if sole:
        guard, inner = sole
        ways += [(guard & test, v) for test, v in _direct(inner)]
    return ways + _direct(cell)


def _direct(cell: Cell) -> list[tuple[Column, Values]]:
    if cell.is_variant:
        as_list, as_map = cell.read("list"), cell.read("map")
        return [(cell.holds("list"), Values(array=as_list)), (cell.holds("map"), Values(array=_map_values(as_map)))]
    if cell.kind == "list":
        return [(cell.holds("list"), Values(array=cell))]
    if isinstance(cell.dtype, T.MapType):
        return [(cell.holds("map"), Values(array=_map_values(cell)))]
    if cell.kind in ("node", "relationship"):
        return [(cell.holds(cell.kind) & test, v) for test, v in _direct(cell.field("properties"))]
    if cell.kind == "map":
        return [(cell.holds("map"), Values(cells=cell.members()))]
    return []


def _map_values(cell: Cell) -> Cell:
    return Cell(F.map_values(cell.col), T.ArrayType(cell.dtype.valueType))


def from_values(run: Callable[[Values], Decoded], type_name: str = "List") -> Decoder:
    """A decoder over the values of a cell."""

    def decode(cell: Cell) -> Decoded:
        outcomes = [(test, run(v)) for test, v in values_of(cell)]
        if isinstance(cell, Record) and len(outcomes) == 1:
            # A row always has values, so the failure text, which shows every column, is not needed.
            return outcomes[0][1]
        fail = could_not_decode(cell, type_name)
        if not outcomes:
            return Decoded(F.lit(None), fail)
        first_value = outcomes[0][1].value
        branches = [(test, d.value, d.errors) for test, d in outcomes]
        nothing = F.when(F.lit(False), first_value)
        return choose_first(branches, nothing, fail)

    return Decoder(decode, ("list", "map"))


def take(n: int, decoders: list[Decoder] | None = None) -> Decoder:
    """The first n values, padded with null; with decoders given, a struct of the decoded ones."""

    def run(v: Values) -> Decoded:
        cells = [v.at(i) for i in range(n)]
        if decoders is None:
            return Decoded(_mixed_array(cells), no_errors())
        return merge({f"_{i + 1}": d(c) for i, (d, c) in enumerate(zip(decoders, cells))})

    return from_values(run)


def _mixed_array(cells: list[Cell]) -> Column:
    """One array of the cells; VARIANT elements when their types differ."""
    types = {c.dtype for c in cells if c.kind != "null"}
    return F.array(*[c.col if len(types) <= 1 else as_variant(c.col) for c in cells])


# All values in order, elements of any kinds.
values = from_values(
    lambda v: Decoded(_mixed_array(v.cells) if v.cells is not None else v.array.col, no_errors())
)


def element_at(index: int, element: Decoder) -> Decoder:
    """The value at an index; out of bounds is an error."""

    def run(v: Values) -> Decoded:
        d = element(v.at(index))
        outside = error("property_not_found", F.lit(NOT_FOUND.format(f"index-{index}")), f"index-{index}")
        return Decoded(d.value, F.when(v.count() > index, d.errors).otherwise(outside))

    return from_values(run)


def lone_element(element: Decoder) -> Decoder:
    """The first value; further ones are ignored."""

    def run(v: Values) -> Decoded:
        d = element(v.at(0))
        empty = error("incoercible", F.lit("Values was empty"))
        return Decoded(d.value, F.when(v.count() > 0, d.errors).otherwise(empty))

    return from_values(run)


def list_of(element: Decoder) -> Decoder:
    return from_values(lambda v: Decoded(*v.decode_each(element)))


vector_of = list_of


def set_of(element: Decoder) -> Decoder:
    return list_of(element).map(F.array_distinct)


def sorted_set_of(element: Decoder) -> Decoder:
    return list_of(element).map(lambda xs: F.sort_array(F.array_distinct(xs)))


def option(inner: Decoder) -> Decoder:
    """Null decodes as absent. A one-key map is always unwrapped first."""

    def run(cell: Cell) -> Decoded:
        sole = cell.sole()
        if sole is None:
            return _nullable(inner, cell)
        guard, only = sole
        unwrapped = _nullable(inner, only)
        if isinstance(cell.dtype, T.StructType):
            return unwrapped
        whole = _nullable(inner, cell)
        return choose_first([(guard, unwrapped.value, unwrapped.errors)], whole.value, whole.errors)

    return Decoder(run, ALL_KINDS)


def _nullable(inner: Decoder, cell: Cell) -> Decoded:
    absent = cell.holds("null")
    d = inner(cell)
    return Decoded(F.when(~absent, d.value), F.when(absent, no_errors()).otherwise(d.errors))


def either(left: Decoder, right: Decoder) -> Decoder:
    """Left where it decodes, else right, else both errors."""

    def run(cell: Cell) -> Decoded:
        a, b = left(cell), right(cell)
        value = F.struct(F.when(a.ok, a.value).alias("left"), F.when(~a.ok, b.value).alias("right"))
        return Decoded(value, F.when(a.ok | b.ok, no_errors()).otherwise(F.concat(a.errors, b.errors)))

    return Decoder(run)


def last_entry_wins(entries: Column) -> Column:
    """Entries sorted by key, keeping the last one given for each key; needs no session setting.

    Only keys and positions are sorted. Everything an inner function looks at is held by a lambda
    variable, so it is computed once per list and not once per element.
    """

    def once(value: Column, use) -> Column:
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def is_last(order: Column):
        def test(e: Column, i: Column) -> Column:
            return F.coalesce(F.get(order, i + 1)["key"] != e["key"], F.lit(True))

        return test

    def keep(held: Column) -> Column:
        numbered = F.transform(held, lambda e, i: F.struct(e["key"].alias("key"), i.alias("seq")))
        last = once(F.sort_array(numbered), lambda order: F.filter(order, is_last(order)))
        return F.transform(
            last, lambda e: F.struct(e["key"].alias("key"), F.get(held, e["seq"])["value"].alias("value"))
        )

    return once(entries, keep)


def pairs_map(key: Decoder, value: Decoder) -> Decoder:
    """A list of pairs as sorted map entries; a later key wins."""
    pair = take(2, [key, value]).map(lambda p: F.struct(p["_1"].alias("key"), p["_2"].alias("value")))
    return list_of(pair).map(last_entry_wins)


def as_map(entries: Column) -> Column:
    return F.map_from_entries(entries)


@dataclass(frozen=True)
class KeyDecoder:
    """Two-way conversion of map keys; ``accepts`` is the row test for a key that decodes."""

    decode: Callable[[Column], Column] = lambda k: k
    encode: Callable[[Column], Column] = lambda k: k
    accepts: Callable[[Column], Column] | None = None

    def run(self, key: Column) -> Decoded:
        if self.accepts is None:
            return Decoded(self.decode(key), no_errors())
        before, after = KEY_ERROR.split("{}")
        bad = error("key", F.concat(F.lit(before), key, F.lit(after)))
        good = F.coalesce(self.accepts(key), F.lit(False))
        return Decoded(F.when(good, self.decode(key)), F.when(good, no_errors()).otherwise(bad))

    def imap(self, encode, decode, accepts=None) -> "KeyDecoder":
        """Convert further, with a test on the key as decoded so far."""
        tests = [t for t in (self.accepts, accepts and (lambda k: accepts(self.decode(k)))) if t]
        both = (lambda k: tests[0](k) & tests[1](k)) if len(tests) == 2 else (tests[0] if tests else None)
        return KeyDecoder(lambda k: decode(self.decode(k)), lambda v: self.encode(encode(v)), both)


STRING_KEY = KeyDecoder()


def object_map(value: Decoder, key: KeyDecoder = STRING_KEY) -> Decoder:
    """An object as map entries; key and value errors of an entry are merged, the first bad entry decides."""

    def run(cell: Cell) -> Decoded:
        outcomes = []
        sole = cell.sole()
        if sole:
            outcomes += [(sole[0] & test, d) for test, d in _entries(sole[1], key, value)]
        outcomes += _entries(cell, key, value)
        fail = could_not_decode(cell, "Object")
        if not outcomes:
            return Decoded(F.lit(None), fail)
        nothing = F.when(F.lit(False), outcomes[0][1].value)
        return choose_first([(t, d.value, d.errors) for t, d in outcomes], nothing, fail)

    return Decoder(run, ("map",))


def _entries(cell: Cell, key: KeyDecoder, value: Decoder) -> list[tuple[Column, Decoded]]:
    if cell.kind in ("node", "relationship"):
        return [(cell.holds(cell.kind) & t, d) for t, d in _entries(cell.field("properties"), key, value)]
    if cell.kind == "map" and isinstance(cell.dtype, T.StructType):
        parts = []
        for name in cell.dtype.fieldNames():
            k, v = key.run(F.lit(name)), value(cell.field(name))
            parts.append(merge({"key": k, "value": v}))
        entries = F.array(*[p.value for p in parts])
        errors = F.coalesce(*[F.when(~p.ok, p.errors) for p in parts], no_errors())
        return [(cell.holds("map"), Decoded(entries, errors))]
    if cell.is_variant or isinstance(cell.dtype, T.MapType):
        as_map_cell = cell.read("map")
        dtype = as_map_cell.dtype.valueType

        def entry(e: Column) -> Column:
            return merge({"key": key.run(e["key"]), "value": value(Cell(e["value"], dtype))}).column()

        steps = F.transform(F.map_entries(as_map_cell.col), entry)
        entries = F.transform(steps, lambda s: s["value"])
        failures = F.filter(F.transform(steps, lambda s: s["errors"]), lambda e: F.size(e) > 0)
        return [(cell.holds("map"), Decoded(entries, F.coalesce(F.get(failures, F.lit(0)), no_errors())))]
    return []


def sorted_entries(entries: Column) -> Column:
    return F.sort_array(entries)
