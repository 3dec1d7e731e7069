"""Shapes of graph values as Spark types, and the kind each type stands for."""

from __future__ import annotations

from pyspark.sql import types as T

ERROR = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)
ERRORS_DDL = "array<struct<kind:string,field:string,message:string>>"

POINT_DDL = "struct<srid:int,x:double,y:double,z:double>"
DURATION_DDL = "struct<months:bigint,days:bigint,seconds:bigint,nanos:int>"
LOCAL_TIME_DDL = "struct<nano_of_day:bigint>"
ZONED_TIME_DDL = "struct<nanos:bigint,offset_s:int>"
ZONED_DATETIME_DDL = "struct<ts:timestamp,zone:string>"

# A struct whose field names are exactly one of these sets is that kind; any other struct is a map.
_STRUCT_KINDS = {
    ("element_id", "labels", "properties"): "node",
    ("element_id", "rel_type", "properties", "src", "dst"): "relationship",
    ("start", "segments"): "path",
    ("srid", "x", "y", "z"): "point",
    ("months", "days", "seconds", "nanos"): "duration",
    ("nano_of_day",): "local_time",
    ("nanos", "offset_s"): "zoned_time",
    ("ts", "zone"): "zoned_datetime",
}

_SCALAR_KINDS = {
    T.ByteType: "integer",
    T.ShortType: "integer",
    T.IntegerType: "integer",
    T.LongType: "integer",
    T.FloatType: "decimal",
    T.DoubleType: "decimal",
    T.DecimalType: "decimal",
    T.StringType: "string",
    T.BooleanType: "boolean",
    T.BinaryType: "bytes",
    T.DateType: "date",
    T.TimestampNTZType: "local_datetime",
    T.ArrayType: "list",
    T.MapType: "map",
    T.NullType: "null",
    T.VariantType: "variant",
}

# Name a value of each kind carries in an error text (fixed values).
KIND_LABELS = {
    "integer": "Integer",
    "decimal": "Decimal",
    "string": "Str",
    "boolean": "Bool",
    "bytes": "Bytes",
    "point": "Point",
    "duration": "Duration",
    "date": "LocalDate",
    "local_time": "LocalTime",
    "local_datetime": "LocalDateTime",
    "zoned_time": "ZonedTime",
    "zoned_datetime": "ZonedDateTime",
    "list": "List",
    "map": "Map",
    "node": "Node",
    "relationship": "Relationship",
    "path": "Path",
}


def kind_of(dtype: T.DataType) -> str:
    if isinstance(dtype, T.StructType):
        return _STRUCT_KINDS.get(tuple(dtype.fieldNames()), "map")
    if isinstance(dtype, T.TimestampType):
        raise TypeError("store instants as struct<ts,zone>: a bare timestamp does not keep its zone")
    return _SCALAR_KINDS[type(dtype)]
