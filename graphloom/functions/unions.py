"""Decoders that choose a record type per row: by node label, relationship type or a field.

The value is a struct with the chosen case's name and one member per case, filled for that case only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from graphloom.functions import records, scalars
from graphloom.functions.cells import Cell
from graphloom.functions.decoder import Decoded, Decoder, constant, error

Options = dict[str, Decoder]


def _choose(cell: Cell, tests: list[tuple[str, Column]], options: Options, unexpected: Column) -> Decoded:
    """The first case whose test holds decodes the cell."""
    case = F.lit(None).cast("string")
    for name, test in reversed(tests):
        case = F.when(test, F.lit(name)).otherwise(case)
    decoded = {name: options[name](cell) for name, _ in tests}
    errors = error("incoercible", unexpected)
    for name, _ in tests:
        errors = F.when(case == name, decoded[name].errors).otherwise(errors)
    members = [F.when(case == name, d.value).alias(name) for name, d in decoded.items()]
    return Decoded(F.struct(case.alias("case"), *members), errors)


def by_label(options: Options) -> Decoder:
    """By the first option whose label the node has; labels are compared without case."""

    def run(cell: Cell) -> Decoded:
        first = records.node(cell)
        labels = first.value["labels"]
        tests = [(name, F.array_contains(labels, name.lower())) for name in options]
        shown = F.concat(F.lit("Unexpected node labels: Set("), F.array_join(labels, ", "), F.lit(")"))
        return _after(first, _choose(cell, tests, options, shown))

    return Decoder(run)


def by_type(options: Options) -> Decoder:
    """By relationship type, without case."""

    def run(cell: Cell) -> Decoded:
        first = records.relationship(cell)
        rel_type = first.value["rel_type"]
        tests = [(name, F.lower(rel_type) == name.lower()) for name in options]
        shown = F.concat(F.lit("Unexpected relationship type: "), rel_type)
        return _after(first, _choose(cell, tests, options, shown))

    return Decoder(run)


def by_field(key: str, options: Options, decoder: Decoder = scalars.string) -> Decoder:
    """By equality with a decoded field; case matters."""

    def run(cell: Cell) -> Decoded:
        first = records.field(key, decoder)(cell)
        tests = [(name, first.value == F.lit(name)) for name in options]
        shown = F.concat(F.lit("Unexpected field label: "), first.value.cast("string"))
        return _after(first, _choose(cell, tests, options, shown))

    return Decoder(run)


def _after(first: Decoded, then: Decoded) -> Decoded:
    return Decoded(then.value, F.when(first.ok, then.errors).otherwise(first.errors))


def derive_union(cases: dict[str, object]) -> Decoder:
    """By a field ``type`` that names the case; a case given as None carries no data."""
    options = {
        name: constant(F.lit(name)) if target is None else records.derive(target) for name, target in cases.items()
    }
    return by_field("type", options)
