"""Parameters and reusable query fragments for ``spark.sql(text, args=...)``.

Parameters of a fragment are named p1, p2, ... in order; those of the i-th nested fragment get the
prefix ``q{i}_``, at every level, so fragments can be reused without clashes.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions import temporal


@dataclass(frozen=True)
class Param:
    value: Any


@dataclass(frozen=True)
class Name:
    """A table or column name given at run time."""

    value: str


class Fragment:
    """Text, parameters, names and other fragments, in order."""

    def __init__(self, *parts: "str | Param | Name | Fragment"):
        self.parts = parts

    def __add__(self, other: "Fragment | str") -> "Fragment":
        return Fragment(*self.parts, *(other.parts if isinstance(other, Fragment) else (other,)))

    def __and__(self, other: "Fragment") -> "Fragment":
        return Fragment("(", self, ") AND (", other, ")")

    def __or__(self, other: "Fragment") -> "Fragment":
        return Fragment("(", self, ") OR (", other, ")")

    def build(self, prefix: str = "") -> tuple[str, dict[str, Any]]:
        text, args, params, nested = [], {}, 0, 0
        for part in self.parts:
            if isinstance(part, Fragment):
                nested += 1
                sub_text, sub_args = part.build(f"{prefix}q{nested}_")
                text.append(sub_text)
                args.update(sub_args)
            elif isinstance(part, Param):
                params += 1
                name = f"{prefix}p{params}"
                text.append(f":{name}")
                args[name] = encode_arg(part.value)
            elif isinstance(part, Name):
                text.append("`" + part.value.replace("`", "``") + "`")
            else:
                text.append(part)
        return "".join(text), args


@dataclass(frozen=True)
class Query:
    """A query text with named parameters."""

    text: str
    params: Mapping[str, Any]

    def with_params(self, **more: Any) -> "Query":
        """Later values override earlier ones."""
        return Query(self.text, {**self.params, **more})

    def run(self, spark: SparkSession, **tables: DataFrame) -> DataFrame:
        return spark.sql(self.text, args={k: encode_arg(v) for k, v in self.params.items()}, **tables)


def query(fragment: Fragment | str) -> Query:
    if isinstance(fragment, str):
        return Query(fragment, {})
    return Query(*fragment.build())


def record_params(record: Mapping[str, Any]) -> Fragment:
    """The fields of a record as ``value AS name`` items in declaration order. Nested records are refused."""
    if not record:
        raise ValueError("a record needs at least one field")
    parts: list[Any] = []
    for i, (name, value) in enumerate(record.items()):
        if isinstance(value, Mapping):
            raise TypeError(f"a record used as parameters cannot hold a record: {name}")
        parts += ([", "] if i else []) + [Param(value), " AS ", Name(name)]
    return Fragment(*parts)


def encode_arg(value: Any) -> Any:
    """A Python value as an argument of ``spark.sql``; anything without a literal becomes a column."""
    if value is None or isinstance(value, (bool, int, float, str, bytes, Column, dt.date)):
        return value
    return encode(value)


def encode(value: Any) -> Column:
    """A Python value as a literal column in the types of the graph model."""
    if isinstance(value, Column):
        return value
    if value is None:
        return F.lit(None)
    if isinstance(value, uuid.UUID):
        return F.lit(str(value))
    if isinstance(value, dt.datetime):
        if value.tzinfo is None:
            return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
        utc = value.astimezone(dt.timezone.utc).isoformat(sep=" ")
        zone = getattr(value.tzinfo, "key", None) or value.strftime("%:z")
        return temporal.zoned_datetime(F.lit(utc).cast("timestamp"), F.lit(zone))
    if isinstance(value, dt.time):
        nanos = ((value.hour * 60 + value.minute) * 60 + value.second) * 10**9 + value.microsecond * 1000
        if value.tzinfo is None:
            return temporal.local_time(F.lit(nanos))
        return temporal.zoned_time(F.lit(nanos), F.lit(int(value.utcoffset().total_seconds())))
    if isinstance(value, dt.timedelta):
        seconds, micros = divmod(value // dt.timedelta(microseconds=1), 10**6)
        return temporal.duration(seconds=seconds, nanos=micros * 1000)
    if isinstance(value, tuple) and len(value) == 2:
        return mixed_list(value)
    if isinstance(value, Mapping):
        entries = [x for k, v in value.items() for x in (F.lit(str(k)), encode(v))]
        return F.create_map(*entries)
    if isinstance(value, Iterable) and not isinstance(value, (str, bytes, bytearray)):
        return F.array(*[encode(v) for v in value])
    return F.lit(bytes(value) if isinstance(value, bytearray) else value)


def as_variant(col: Column) -> Column:
    """Any column, null included, as one element of a mixed list or map."""
    wrapped = F.to_variant_object(F.struct(col.alias("v")))
    return F.variant_get(wrapped, "$.v", "variant")


def _element(value: Any) -> Column:
    return F.parse_json(F.lit("null")) if value is None else as_variant(encode(value))


def mixed_list(values: Iterable[Any]) -> Column:
    """Values of different kinds in one list."""
    return F.array(*[_element(v) for v in values])


def mixed_map(entries: Mapping[str, Any]) -> Column:
    """Values of different kinds in one map."""
    flat = [x for k, v in entries.items() for x in (F.lit(k), _element(v))]
    return F.create_map(*flat)
