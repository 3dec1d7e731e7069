"""Validated types: ranges, enumerations, keys and non-empty collections."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from graphloom.functions import collections as coll
from graphloom.functions import scalars
from graphloom.functions.decoder import KEY_ERROR, Decoder


def refine(decoder: Decoder, test: Callable[[Column], Column], message: Callable[[Column], Column]) -> Decoder:
    """The decoded value must satisfy a predicate."""
    return decoder.ensure(test, message)


def closed_interval(decoder: Decoder, low: float, high: float) -> Decoder:
    """The decoded number must lie in [low, high]."""

    def message(v: Column) -> Column:
        shown = v.cast("string")
        too_low = F.concat(F.lit("Left predicate of (!("), shown, F.lit(f" < {low}) && !("), shown, F.lit(
            f" > {high})) failed: Predicate ("), shown, F.lit(f" < {low}) did not fail."))
        too_high = F.concat(F.lit("Right predicate of (!("), shown, F.lit(f" < {low}) && !("), shown, F.lit(
            f" > {high})) failed: Predicate ("), shown, F.lit(f" > {high}) did not fail."))
        return F.when(v < low, too_low).otherwise(too_high)

    return refine(decoder, lambda v: v.between(low, high), message)


def enum_by_name(names: Sequence[str]) -> Decoder:
    """The value must be an entry name; a failure is a key error."""
    before, after = KEY_ERROR.split("{}")
    return scalars.string.ensure(
        lambda v: v.isin(*names), lambda v: F.concat(F.lit(before), v, F.lit(after)), kind="key"
    )


def enum_by_value(enum: str, entries: dict, decoder: Decoder) -> Decoder:
    """The value must be the code of an entry; the result is the entry's name."""

    def run(v: Column) -> tuple[Column, Column]:
        name = F.lit(None).cast("string")
        for value, entry in entries.items():
            name = F.when(v == F.lit(value), F.lit(entry)).otherwise(name)
        bad = F.concat(F.lit("Couldn't decode "), v.cast("string"), F.lit(f" as {enum}"))
        return name, F.when(name.isNull(), bad)

    return decoder.emap(run)


def enum_keys(names: Sequence[str]) -> coll.KeyDecoder:
    """Map keys that must be entry names."""
    return coll.KeyDecoder(accepts=lambda k: k.isin(*names))


def _non_empty(decoder: Decoder, message: str) -> Decoder:
    return decoder.ensure(lambda xs: F.size(xs) > 0, lambda xs: F.lit(message))


def non_empty_list(element: Decoder) -> Decoder:
    return _non_empty(coll.list_of(element), "NonEmptyList from an empty List")


def non_empty_vector(element: Decoder) -> Decoder:
    return _non_empty(coll.list_of(element), "NonEmptyVector from an empty Vector")


def non_empty_chain(element: Decoder) -> Decoder:
    return _non_empty(coll.list_of(element), "NonEmptyChain from an empty Chain")


def non_empty_set(element: Decoder) -> Decoder:
    return _non_empty(coll.sorted_set_of(element), "NonEmptySet from an empty Set")


def non_empty_pairs_map(key: Decoder, value: Decoder) -> Decoder:
    return _non_empty(coll.pairs_map(key, value), "NonEmptyMap from an empty Map")


def non_empty_object_map(value: Decoder, key: coll.KeyDecoder = coll.STRING_KEY) -> Decoder:
    return _non_empty(coll.object_map(value, key).map(coll.sorted_entries), "NonEmptyMap from an empty Map")
