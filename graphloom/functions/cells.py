"""A cell: a column together with what is known about its type when the plan is built.

Decoders ask a cell which kinds it may hold. A typed column answers at planning time, so a
decoder over typed columns becomes a short native expression. A VARIANT column answers per row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.model import KIND_LABELS, kind_of

# Spark type read out of a VARIANT for each kind it can hold.
_VARIANT_READ = {
    "integer": T.LongType(),
    "decimal": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "bytes": T.BinaryType(),
    "date": T.DateType(),
    "local_datetime": T.TimestampNTZType(),
    "list": T.ArrayType(T.VariantType()),
    "map": T.MapType(T.StringType(), T.VariantType()),
}


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


# First word of a VARIANT's schema text for each kind.
_VARIANT_KINDS = {
    "VOID": "null",
    "BIGINT": "integer",
    "DOUBLE": "decimal",
    "FLOAT": "decimal",
    "DECIMAL": "decimal",
    "STRING": "string",
    "BOOLEAN": "boolean",
    "BINARY": "bytes",
    "DATE": "date",
    "TIMESTAMP_NTZ": "local_datetime",
    "OBJECT": "map",
    "ARRAY": "list",
}


def variant_kind(col: Column) -> Column:
    """The kind held by a VARIANT value, per row. The column is used once, so it is computed once."""
    names = F.create_map(*[F.lit(x) for pair in _VARIANT_KINDS.items() for x in pair])
    word = F.regexp_extract(F.coalesce(F.schema_of_variant(col), F.lit("VOID")), "^[A-Z_]+", 0)
    return F.coalesce(F.try_element_at(names, word), F.lit("unknown"))


@dataclass(frozen=True)
class Cell:
    col: Column
    dtype: T.DataType

    @property
    def kind(self) -> str:
        return kind_of(self.dtype)

    @property
    def is_variant(self) -> bool:
        return self.kind == "variant"

    def may_be(self, kind: str) -> bool:
        if self.is_variant:
            return kind in _VARIANT_READ or kind == "null"
        return kind in (self.kind, "null")

    def variant_kind(self) -> Column:
        return variant_kind(self.col)

    def holds(self, kind: str) -> Column:
        """Whether this row's value is of the kind."""
        if self.is_variant:
            return self.variant_kind() == kind
        if kind == "null":
            return F.lit(True) if self.kind == "null" else self.col.isNull()
        return self.col.isNotNull()

    def read(self, kind: str) -> "Cell":
        """The value as a typed cell, valid on rows where ``holds(kind)``."""
        if not self.is_variant:
            return self
        if kind == "null":
            return MISSING
        dtype = _VARIANT_READ[kind]
        return Cell(F.try_variant_get(self.col, "$", dtype.simpleString()), dtype)

    # -- objects -------------------------------------------------------------------------
    def field(self, name: str) -> "Cell":
        """A named member; a name that is not there reads as null."""
        if isinstance(self.dtype, T.StructType):
            if name in self.dtype.fieldNames():
                return Cell(self.col.getField(name), self.dtype[name].dataType)
            return MISSING
        if isinstance(self.dtype, T.MapType):
            return Cell(F.try_element_at(self.col, F.lit(name)), self.dtype.valueType)
        if self.is_variant:
            return Cell(F.try_variant_get(self.col, _variant_path(name), "variant"), self.dtype)
        return MISSING

    def has_field(self, name: str) -> Column | bool:
        if isinstance(self.dtype, T.StructType):
            return name in self.dtype.fieldNames()
        if isinstance(self.dtype, T.MapType):
            return F.coalesce(F.map_contains_key(self.col, F.lit(name)), F.lit(False))
        if self.is_variant:
            # A member that is there but null is a VARIANT null, which is not an SQL null.
            return self.field(name).col.isNotNull()
        return False

    def members(self) -> list["Cell"]:
        """Members of a struct in declaration order."""
        return [self.field(n) for n in self.dtype.fieldNames()]

    def sole(self) -> tuple[Column, "Cell"] | None:
        """The only value of a one-key map, with the row condition for there being just one.

        A VARIANT is unwrapped when it is bound, see ``Bound``.
        """
        if isinstance(self.dtype, T.StructType):
            if self.kind == "map" and len(self.dtype) == 1:
                return F.lit(True), self.members()[0]
            return None
        if isinstance(self.dtype, T.MapType):
            only = F.coalesce(F.size(self.col) == 1, F.lit(False))
            return only, Cell(F.get(F.map_values(self.col), F.lit(0)), self.dtype.valueType)
        return None


def _variant_path(name: str) -> str:
    return "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"


class Bound(Cell):
    """A VARIANT value and its kind, both already computed and held by a lambda variable."""

    def __init__(self, held: Column):
        super().__init__(held["v"], T.VariantType())
        object.__setattr__(self, "_kind", held["kind"])

    def variant_kind(self) -> Column:
        return self._kind


def with_variant(col: Column, accepts: tuple[str, ...], fn) -> Column:
    """``fn`` of a bound cell, evaluated once per row.

    A one-key object whose only value is of an accepted kind is replaced by that value first.
    """

    def unwrapped(h: Column) -> Column:
        members = F.map_values(F.try_variant_get(h["v"], "$", "map<string,variant>"))
        only = F.when((h["kind"] == "map") & (F.size(members) == 1), F.get(members, F.lit(0)))
        inner = _hold(only)
        return F.when(only.isNotNull() & inner["kind"].isin(*accepts), inner).otherwise(h)

    def once(value: Column, use) -> Column:
        return F.get(F.transform(F.array(value), use), F.lit(0))

    return once(_hold(col), lambda h: once(unwrapped(h), lambda t: fn(Bound(t))))


def _hold(col: Column) -> Column:
    return F.struct(col.alias("v"), variant_kind(col).alias("kind"))


class Record(Cell):
    """A whole row as a named, ordered record. Members stay plain columns, so unused ones are pruned."""

    def __init__(self, schema: T.StructType):
        super().__init__(F.struct(*[quoted(n) for n in schema.fieldNames()]), schema)

    @property
    def kind(self) -> str:
        return "map"

    def field(self, name: str) -> Cell:
        if name in self.dtype.fieldNames():
            return Cell(quoted(name), self.dtype[name].dataType)
        return MISSING

    def holds(self, kind: str) -> Column:
        return F.lit(kind == "map")


class _Missing(Cell):
    """A member that is not there. Its column is made on use, when a session exists."""

    def __init__(self):
        object.__setattr__(self, "dtype", T.NullType())

    @property
    def col(self) -> Column:
        return F.lit(None)


MISSING = _Missing()


def record_of(df: DataFrame) -> Record:
    return Record(df.schema)


def column_of(df: DataFrame, name: str) -> Cell:
    return Cell(quoted(name), df.schema[name].dataType)


# -- error text ------------------------------------------------------------------------------
def show(cell: Cell) -> Column:
    """The value as an error text shows it."""
    if cell.is_variant:
        kind = cell.variant_kind()
        text = (
            F.when(kind.isin("map", "list", "unknown"), F.to_json(cell.col))
            .when(kind == "decimal", F.try_variant_get(cell.col, "$", "double").cast("string"))
            .otherwise(F.try_variant_get(cell.col, "$", "string"))
        )
        labels = F.create_map(*[F.lit(x) for pair in KIND_LABELS.items() for x in pair])
        return F.when(kind == "null", "NullValue").otherwise(
            F.concat(F.coalesce(F.try_element_at(labels, kind), kind), F.lit("("), text, F.lit(")"))
        )
    if cell.kind == "null":
        return F.lit("NullValue")
    if cell.kind == "list":
        items = F.transform(cell.col, lambda x: show(Cell(x, cell.dtype.elementType)))
        body = F.array_join(items, ", ")
    elif isinstance(cell.dtype, T.MapType):
        entries = F.transform(
            F.map_entries(cell.col),
            lambda e: F.concat(e["key"], F.lit(" -> "), show(Cell(e["value"], cell.dtype.valueType))),
        )
        body = F.array_join(entries, ", ")
    elif cell.kind == "map":
        parts = [F.concat(F.lit(f"{n} -> "), show(cell.field(n))) for n in cell.dtype.fieldNames()]
        body = F.concat_ws(", ", *parts)
    elif cell.kind == "bytes":
        body = F.concat(F.lit("0x"), F.hex(cell.col))
    elif isinstance(cell.dtype, T.StructType):
        body = F.to_json(cell.col)
    elif cell.kind == "local_datetime":
        body = F.regexp_replace(cell.col.cast("string"), " ", "T")
    elif cell.kind == "decimal":
        body = cell.col.cast("double").cast("string")
    else:
        body = cell.col.cast("string")
    return F.when(cell.col.isNull(), "NullValue").otherwise(_tagged(cell.kind, body))


def _tagged(kind: str, body: Column) -> Column:
    return F.concat(F.lit(KIND_LABELS[kind] + "("), body, F.lit(")"))
