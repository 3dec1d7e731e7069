"""Temporal values: builders for the struct forms, parsing, and decoders between them.

Local times are nanoseconds of the day, so nothing below a microsecond is lost; timestamps have
Spark's microsecond precision.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from graphloom.functions.cells import Cell
from graphloom.functions.decoder import Decoder, from_match
from graphloom.functions.scalars import iso_duration
from graphloom.model import LOCAL_TIME_DDL, ZONED_DATETIME_DDL, ZONED_TIME_DDL

NANOS_PER_SECOND = 1_000_000_000
SECONDS_PER_DAY = 86_400
BAD_TEMPORAL = "Error while parsing date value: "


# -- builders --------------------------------------------------------------------------------
def duration(months=0, days=0, seconds=0, nanos=0) -> Column:
    as_col = lambda v, t: (v if isinstance(v, Column) else F.lit(v)).cast(t)
    return F.struct(
        as_col(months, "bigint").alias("months"),
        as_col(days, "bigint").alias("days"),
        as_col(seconds, "bigint").alias("seconds"),
        as_col(nanos, "int").alias("nanos"),
    )


def point(x: Column, y: Column, z: Column | None = None, srid: int | None = None) -> Column:
    """A cartesian point; srid 7203 is two-dimensional, 9157 three-dimensional."""
    srid = srid if srid is not None else (7203 if z is None else 9157)
    depth = F.lit(None) if z is None else z
    return F.struct(
        F.lit(srid).alias("srid"),
        x.cast("double").alias("x"),
        y.cast("double").alias("y"),
        depth.cast("double").alias("z"),
    )


def local_time(nano_of_day: Column) -> Column:
    return F.struct(nano_of_day.cast("bigint").alias("nano_of_day"))


def zoned_time(nanos: Column, offset_s: Column) -> Column:
    return F.struct(nanos.cast("bigint").alias("nanos"), offset_s.cast("int").alias("offset_s"))


def zoned_datetime(instant: Column, zone: Column) -> Column:
    return F.struct(instant.cast("timestamp").alias("ts"), zone.alias("zone"))


def zoned_from_wall(wall: Column, zone: Column) -> Column:
    """A zoned datetime from a wall clock reading and the zone it was read in."""
    in_session = F.convert_timezone(zone, F.current_timezone(), wall)
    return zoned_datetime(in_session.cast("timestamp"), zone)


def wall_clock(zoned: Column) -> Column:
    """The wall clock of a zoned datetime in its own zone."""
    return F.convert_timezone(F.current_timezone(), zoned["zone"], zoned["ts"].cast("timestamp_ntz"))


def nanos_of_day(wall: Column) -> Column:
    micros = (
        F.hour(wall).cast("bigint") * F.lit(3_600_000_000)
        + F.minute(wall).cast("bigint") * F.lit(60_000_000)
        + (F.extract(F.lit("SECOND"), wall) * F.lit(1_000_000)).cast("bigint")
    )
    return micros * F.lit(1000)


def offset_seconds(zoned: Column) -> Column:
    """Seconds the zone is ahead of UTC at that instant."""
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), zoned["ts"].cast("timestamp_ntz"))
    return F.timestamp_diff("SECOND", utc, wall_clock(zoned)).cast("int")


# -- parsing ---------------------------------------------------------------------------------
def parse_local_time(text: Column) -> Column:
    """``HH:MM[:SS[.fraction]]`` as a local time; null when out of range."""
    pattern = "^([01][0-9]|2[0-3]):([0-5][0-9])(?::([0-5][0-9])(?:[.]([0-9]{1,9}))?)?$"
    part = lambda i: F.regexp_extract(text, pattern, i)
    whole = lambda i: F.coalesce(F.nullif(part(i), F.lit("")), F.lit("0")).cast("bigint")
    fraction = F.rpad(part(4), 9, "0").cast("bigint")
    seconds = whole(1) * 3600 + whole(2) * 60 + whole(3)
    return F.when(text.rlike(pattern), local_time(seconds * F.lit(NANOS_PER_SECOND) + fraction))


def parse_zoned_time(text: Column) -> Column:
    """``HH:MM:SS`` followed by ``Z`` or an offset; a bare time is at UTC."""
    pattern = "^(.*?)(Z|[+-][0-9]{2}:?[0-9]{2})?$"
    clock = parse_local_time(F.regexp_extract(text, pattern, 1))
    zone = F.regexp_extract(text, pattern, 2)
    sign = F.when(zone.startswith("-"), -1).otherwise(1)
    digits = F.regexp_replace(zone, "[^0-9]", "")
    offset = F.when(digits == "", 0).otherwise(
        F.substring(digits, 1, 2).cast("int") * 3600 + F.substring(digits, 3, 2).cast("int") * 60
    )
    return F.when(clock.isNotNull(), zoned_time(clock["nano_of_day"], sign * offset))


def checked(parsed: Column, source: Column) -> tuple[Column, Column]:
    """For ``emap``: a value that did not parse becomes an error instead of a crash."""
    return parsed, F.when(parsed.isNull(), F.concat(F.lit(BAD_TEMPORAL), source))


# -- decoders --------------------------------------------------------------------------------
def from_temporal(type_name: str, ddl: str, cases) -> Decoder:
    """A decoder limited to temporal instants."""
    return from_match(type_name, ddl, cases)


def _as_is(cell: Cell) -> Column:
    return cell.col


date = from_temporal(
    "LocalDate",
    "date",
    [
        ("date", _as_is),
        ("local_datetime", lambda c: F.to_date(c.col)),
        ("zoned_datetime", lambda c: F.to_date(wall_clock(c.col))),
    ],
)

time = from_temporal(
    "LocalTime",
    LOCAL_TIME_DDL,
    [
        ("local_time", _as_is),
        ("local_datetime", lambda c: local_time(nanos_of_day(c.col))),
        ("zoned_time", lambda c: local_time(c.col["nanos"])),
        ("zoned_datetime", lambda c: local_time(nanos_of_day(wall_clock(c.col)))),
    ],
)

datetime = from_temporal(
    "LocalDateTime",
    "timestamp_ntz",
    [("local_datetime", _as_is), ("zoned_datetime", lambda c: wall_clock(c.col))],
)

offset_time = from_temporal(
    "OffsetTime",
    ZONED_TIME_DDL,
    [
        ("zoned_time", _as_is),
        ("zoned_datetime", lambda c: zoned_time(nanos_of_day(wall_clock(c.col)), offset_seconds(c.col))),
    ],
)

zoned = from_temporal("ZonedDateTime", ZONED_DATETIME_DDL, [("zoned_datetime", _as_is)])


def _total_nanos(d: Column) -> Column:
    seconds = d["days"] * F.lit(SECONDS_PER_DAY) + d["seconds"]
    return seconds * F.lit(NANOS_PER_SECOND) + d["nanos"]


# Days, seconds and nanos of a duration; months are dropped.
duration_time = iso_duration.map(
    lambda d: F.struct(
        (d["days"] * F.lit(SECONDS_PER_DAY) + d["seconds"]).alias("seconds"), d["nanos"].alias("nanos")
    )
)
# Months and days of a duration; seconds and nanos are dropped.
duration_period = iso_duration.map(lambda d: F.struct(d["months"].alias("months"), d["days"].alias("days")))
# The same length as duration_time in nanoseconds; overflow raises.
duration_nanos = iso_duration.map(_total_nanos)
