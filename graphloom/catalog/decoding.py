"""Typed decoding over whole columns and rows."""

from __future__ import annotations

import dataclasses

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.catalog.registry import query
from graphloom.functions import collections as coll
from graphloom.functions import numbers, records, scalars, temporal, unions
from graphloom.functions.cells import column_of, record_of, variant_kind
from graphloom.functions.decoder import combine, constant, decode, error_text
from graphloom.operators.patterns import hop, node_value, rel_value
from graphloom.operators import paths
from graphloom.sources.graph import order_graph
from graphloom.sources.tables import table

LINE = ["l_orderkey", "l_linenumber", "l_partkey"]
_WIDE = "(l_partkey * 3000000019 + l_orderkey)"
_DBL = "((l_extendedprice - 50000) * 100000.0)"


def order_lines(spark, d, **columns):
    """Order lines with some computed columns to decode."""
    lines = table(spark, d, "lineitem")
    return lines.select(*LINE, *[c.alias(n) for n, c in columns.items()])


def decode_columns(df, keys, **decoders):
    """Decode columns: ``name=(column, decoder)`` gives the value, ``name_error`` its error text where asked."""
    out, shown = [], []
    for name, (column, decoder, *wants_error) in decoders.items():
        got = decoder(column_of(df, column))
        if wants_error:
            out.append(got.errors.alias(name))
            shown.append(error_text(F.col(name)).alias(name))
        else:
            out.append(got.settled.alias(name))
            shown.append(F.col(name))
    return df.select(*keys, *out).select(*keys, *shown)


def _wide_and_double(spark, d):
    return order_lines(
        spark, d,
        wide=F.col("l_partkey") * F.lit(3000000019) + F.col("l_orderkey"),
        dbl=(F.col("l_extendedprice") - 50000) * F.lit(100000.0),
        flag=F.col("l_returnflag"),
    )


def _wrapped(bits: int, value: str = _WIDE) -> str:
    half, whole = 2 ** (bits - 1), 2**bits
    return f"(((({value}) + {half}) % {whole} + {whole}) % {whole}) - {half}"


_SAT = f"""CASE WHEN {_DBL} >= 2147483647 THEN 2147483647 WHEN {_DBL} <= -2147483648 THEN -2147483648
           ELSE trunc({_DBL})::BIGINT END"""


@query(
    "decode_int",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, ({_wrapped(32)})::INTEGER AS of_integer,
               ({_SAT})::INTEGER AS of_double,
               'Couldn''t decode Str(' || l_returnflag || ') into a int' AS of_string FROM lineitem""",
)
def decode_int(spark, d):
    return decode_columns(
        _wide_and_double(spark, d), LINE, of_integer=("wide", scalars.integer), of_double=("dbl", scalars.integer),
        of_string=("flag", scalars.integer, True),
    )


@query(
    "decode_short",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, ({_wrapped(16)})::INTEGER AS of_integer,
               ({_wrapped(16, _SAT)})::INTEGER AS of_double FROM lineitem""",
)
def decode_short(spark, d):
    got = decode_columns(_wide_and_double(spark, d), LINE, of_integer=("wide", scalars.short), of_double=("dbl", scalars.short))
    return got.select(*LINE, F.col("of_integer").cast("int").alias("of_integer"),
                      F.col("of_double").cast("int").alias("of_double"))


@query(
    "decode_byte",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, ({_wrapped(8)})::INTEGER AS of_integer,
               ({_wrapped(8, _SAT)})::INTEGER AS of_double FROM lineitem""",
)
def decode_byte(spark, d):
    got = decode_columns(_wide_and_double(spark, d), LINE, of_integer=("wide", scalars.byte), of_double=("dbl", scalars.byte))
    return got.select(*LINE, F.col("of_integer").cast("int").alias("of_integer"),
                      F.col("of_double").cast("int").alias("of_double"))


@query(
    "decode_long",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {_WIDE} AS of_integer,
               CASE WHEN {_DBL} * 1e10 >= 9223372036854775807 THEN 9223372036854775807
                    WHEN {_DBL} * 1e10 <= -9223372036854775808 THEN -9223372036854775808
                    ELSE trunc({_DBL} * 1e10)::HUGEINT::BIGINT END AS of_double FROM lineitem""",
)
def decode_long(spark, d):
    lines = _wide_and_double(spark, d).withColumn("dbl", F.col("dbl") * F.lit(1e10))
    return decode_columns(lines, LINE, of_integer=("wide", scalars.long), of_double=("dbl", scalars.long))


@query(
    "decode_float",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {_WIDE}::FLOAT AS of_integer, {_DBL}::FLOAT AS of_double
        FROM lineitem""",
)
def decode_float(spark, d):
    return decode_columns(_wide_and_double(spark, d), LINE, of_integer=("wide", scalars.single), of_double=("dbl", scalars.single))


@query(
    "decode_double",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {_WIDE}::DOUBLE AS of_integer, {_DBL} AS of_double,
               'Couldn''t decode Str(' || l_returnflag || ') into a double' AS of_string FROM lineitem""",
)
def decode_double(spark, d):
    return decode_columns(
        _wide_and_double(spark, d), LINE, of_integer=("wide", scalars.double), of_double=("dbl", scalars.double),
        of_string=("flag", scalars.double, True),
    )


@query(
    "decode_bigint",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, ({_WIDE})::VARCHAR AS of_integer, (-{_WIDE})::VARCHAR AS of_text,
               (-{_WIDE})::VARCHAR AS of_bytes, ((-{_WIDE})::HUGEINT * 18446744073709551616)::VARCHAR AS of_long_bytes,
               ((-{_WIDE})::HUGEINT * 18446744073709551616)::VARCHAR AS of_longer_bytes,
               'The integer needs more than 38 digits' AS too_wide,
               'Couldn''t decode Decimal(' || l_quantity::VARCHAR || ') into a BigInt' AS of_double,
               'Couldn''t create a BigInt from ' || l_returnflag AS bad_text FROM lineitem""",
)
def decode_bigint(spark, d):
    wide = F.col("l_partkey") * F.lit(3000000019) + F.col("l_orderkey")
    digits = F.lpad(F.hex(-wide), 16, "F")
    lines = order_lines(
        spark, d, wide=wide, text=(-wide).cast("string"), raw=F.unhex(digits),
        raw_long=F.unhex(F.concat(digits, F.lit("0" * 16))), raw_longer=F.unhex(F.concat(F.lit("FF"), digits, F.lit("0" * 16))),
        raw_wide=F.unhex(F.concat(F.lit("7F"), F.right(digits, F.lit(14)), F.lit("0" * 16))), dbl=F.col("l_quantity"), flag=F.col("l_returnflag"),
    )
    big = scalars.big_integer
    got = decode_columns(
        lines, LINE, of_integer=("wide", big), of_text=("text", big), of_bytes=("raw", big),
        of_long_bytes=("raw_long", big), of_longer_bytes=("raw_longer", big), too_wide=("raw_wide", big, True), of_double=("dbl", big, True), bad_text=("flag", big, True),
    )
    return got.select(*[F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.DecimalType) else f.name for f in got.schema])


@query(
    "decode_number",
    f"""WITH lines AS (SELECT l_orderkey, l_linenumber, l_partkey, {_WIDE}::HUGEINT AS a FROM lineitem),
             -- a * 2^64 in groups of 18 digits, times 2^64 once more
             groups AS (SELECT *, a * 18446744073709551616 // 1000000000000000000 AS q,
                               a * 18446744073709551616 % 1000000000000000000 AS r FROM lines),
             product AS (SELECT *, q * 18446744073709551616 + r * 18446744073709551616 // 1000000000000000000 AS hi,
                                r * 18446744073709551616 % 1000000000000000000 AS lo FROM groups)
        SELECT l_orderkey, l_linenumber, l_partkey, '-' || hi || lpad(lo::VARCHAR, 18, '0') AS of_bytes,
               a || repeat('7', 120) AS of_text, '0.' || repeat('0', 60) || rtrim(a::VARCHAR, '0') AS of_small,
               rank() OVER (PARTITION BY l_orderkey ORDER BY a) AS place FROM product""",
)
def decode_number(spark, d):
    """Integers of 24 bytes and of more than 120 digits, a fraction of more than 60, and ranks by such a number."""
    wide = F.col("l_partkey") * F.lit(3000000019) + F.col("l_orderkey")
    lines = order_lines(
        spark, d, raw=F.unhex(F.concat(F.lpad(F.hex(-wide), 16, "F"), F.lit("0" * 32))),
        text=F.concat(wide.cast("string"), F.lit("7" * 120)), small=F.concat(wide.cast("string"), F.lit("e-"), (F.length(wide.cast("string")) + 60).cast("string")),
    )
    got = {n: numbers.big_decimal(column_of(lines, n)).value for n in ("raw", "text", "small")}
    held = lines.select(*LINE, *[v.alias(n) for n, v in got.items()])
    rank = F.rank().over(Window.partitionBy("l_orderkey").orderBy("text"))
    return held.select(
        *LINE, numbers.to_text(F.col("raw")).alias("of_bytes"), numbers.to_text(F.col("text")).alias("of_text"),
        numbers.to_text(F.col("small")).alias("of_small"), rank.cast("long").alias("place"),
    )


@query(
    "decode_bigdecimal",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_orderkey::DECIMAL(38, 18)::VARCHAR AS of_integer,
              l_extendedprice::VARCHAR::DECIMAL(38, 18)::VARCHAR AS of_double,
              ('-' || l_orderkey || '.25')::DECIMAL(38, 18)::VARCHAR AS of_text,
              l_partkey::DECIMAL(38, 18)::VARCHAR AS of_bytes,
              'Couldn''t create a BigDecimal from ' || l_returnflag AS bad_text FROM lineitem""",
)
def decode_bigdecimal(spark, d):
    lines = order_lines(
        spark, d, whole=F.col("l_orderkey"), dbl=F.col("l_extendedprice"),
        text=F.concat(F.lit("-"), F.col("l_orderkey"), F.lit(".25")),
        raw=F.unhex(F.lpad(F.hex("l_partkey"), 16, "0")), flag=F.col("l_returnflag"),
    )
    # A decimal's plain digits: zero would otherwise be shown as 0E-18.
    plain = lambda v: F.when(v == 0, F.lit("0.000000000000000000")).otherwise(v.cast("string"))
    big = scalars.big_decimal
    got = decode_columns(
        lines, LINE, of_integer=("whole", big), of_double=("dbl", big), of_text=("text", big), of_bytes=("raw", big),
        bad_text=("flag", big, True),
    )
    return got.select(*[plain(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.DecimalType) else f.name for f in got.schema])


@query(
    "decode_boolean",
    """SELECT event_id, user_id > 50 AS ok,
              'Couldn''t decode Str(' || event_type || ') into a boolean' AS of_string FROM events""",
)
def decode_boolean(spark, d):
    events = table(spark, d, "events").select("event_id", (F.col("user_id") > 50).alias("flag"), "event_type")
    return decode_columns(events, ["event_id"], ok=("flag", scalars.boolean), of_string=("event_type", scalars.boolean, True))


@query(
    "decode_string",
    """SELECT event_id, event_type AS ok, 'Couldn''t decode Integer(' || user_id || ') into a String' AS of_integer
       FROM events""",
)
def decode_string(spark, d):
    return decode_columns(table(spark, d, "events"), ["event_id"], ok=("event_type", scalars.string),
                  of_integer=("user_id", scalars.string, True))


@query(
    "decode_bytes",
    """SELECT event_id, upper(hex(encode(event_type))) AS ok,
              'Couldn''t decode Str(' || event_type || ') into a ArraySeq' AS of_string FROM events""",
)
def decode_bytes(spark, d):
    events = table(spark, d, "events").select("event_id", F.encode("event_type", "utf-8").alias("raw"), "event_type")
    return decode_columns(events, ["event_id"], ok=("raw", scalars.binary.map(F.hex)),
                  of_string=("event_type", scalars.binary, True))


_H = "md5(c_name)"
_DASHED = f"""substr({_H},1,8) || '-' || substr({_H},9,4) || '-' || substr({_H},13,4) || '-' ||
              substr({_H},17,4) || '-' || substr({_H},21,12)"""


@query(
    "decode_uuid",
    f"""SELECT c_custkey, {_DASHED} AS of_text,
              substr({_H},1,8) || '-' || substr({_H},9,4) || '-3' || substr({_H},14,3) || '-' ||
              substr('89ab89ab89ab89ab', strpos('0123456789abcdef', substr({_H},17,1))::INTEGER, 1) ||
              substr({_H},18,3) || '-' || substr({_H},21,12) AS of_bytes,
              'Couldn''t create an UUID from ' || c_mktsegment AS bad_text FROM customer""",
)
def decode_uuid(spark, d):
    h = F.md5("c_name")
    dashed = F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    customers = table(spark, d, "customer").select(
        "c_custkey", F.upper(dashed).alias("text"), F.encode("c_name", "utf-8").alias("raw"), "c_mktsegment"
    )
    return decode_columns(customers, ["c_custkey"], of_text=("text", scalars.uuid), of_bytes=("raw", scalars.uuid),
                  bad_text=("c_mktsegment", scalars.uuid, True))


def _customer_hop(spark, d):
    """A node, a relationship and a path as columns."""
    g = order_graph(spark, d)
    customers, nations, rel = g.nodes("customer"), g.nodes("nation"), g.rels("in_nation")
    a, b = node_value("a", customers.schema), node_value("b", nations.schema)
    r = rel_value("r", rel.schema, F.col("a.element_id"), F.col("b.element_id"))
    return hop(customers, rel, nations).select(
        "a.c_custkey", a.alias("n"), r.alias("r"), paths.path_value(a, [(r, b)]).alias("p")
    )


@query(
    "decode_hop",
    """SELECT c_name AS buyer, c_acctbal AS balance, o_orderkey AS order_key, o_totalprice AS price,
              'c:' || c_custkey AS src, o_orderdate::DATE AS placed_on,
              'Couldn''t decode Str(' || c_name || ') into a int for field ''c_name''' AS problem
       FROM customer JOIN orders ON o_custkey = c_custkey""",
)
def decode_hop(spark, d):
    """Both ends of a matched hop and the relationship between them, decoded into records."""
    g = order_graph(spark, d)
    customers, orders, placed = g.nodes("customer"), g.nodes("order"), g.rels("placed")
    ends = F.col("a.element_id"), F.col("b.element_id")
    matched = hop(customers, placed, orders).select(
        node_value("a", customers.schema, typed=True).alias("a"), rel_value("r", placed.schema, *ends, typed=True).alias("r"),
        node_value("b", orders.schema, typed=True).alias("b"),
        F.col("a.element_id").alias("src"),
    )
    buyer = records.named({"name": ("c_name", scalars.string), "balance": ("c_acctbal", scalars.double)})
    order = records.named({"key": ("o_orderkey", scalars.long), "price": ("o_totalprice", scalars.double)})
    date = records.named({"date": ("o_orderdate", temporal.date)})
    wrong = records.named({"name": ("c_name", scalars.integer)})
    got = decode_columns(
        matched, ["src"], buyer=("a", buyer), order=("b", order), placed=("r", date), problem=("a", wrong, True)
    )
    return got.select(
        F.col("buyer.name").alias("buyer"), "buyer.balance", F.col("order.key").alias("order_key"), "order.price", "src",
        F.col("placed.date").alias("placed_on"), "problem",
    )


# A customer, its nation, the relationship between them and the path over it as an error text shows them.
_NODE_TEXT = r"""'{"element_id":"c:' || c_custkey || '","labels":["customer"],"properties":"{\"c_custkey\":' || c_custkey
    || ',\"c_name\":\"' || c_name || '\",\"c_nationkey\":' || c_nationkey || ',\"c_acctbal\":' || c_acctbal
    || ',\"c_mktsegment\":\"' || c_mktsegment || '\"}"}'"""
_NATION_TEXT = r"""'{"element_id":"n:' || n_nationkey || '","labels":["nation"],"properties":"{\"n_nationkey\":' || n_nationkey
    || ',\"n_name\":\"' || n_name || '\",\"n_regionkey\":' || n_regionkey || '}"}'"""
_REL_TEXT = """'{"element_id":"in_nation:c:' || c_custkey || '","rel_type":"in_nation","properties":"{}","src":"c:' || c_custkey
    || '","dst":"n:' || n_nationkey || '"}'"""
_PATH_TEXT = f"""'{{"start":' || {_NODE_TEXT} || ',"segments":[{{"start":' || {_NODE_TEXT} || ',"relationship":' || {_REL_TEXT}
    || ',"end":' || {_NATION_TEXT} || '}}]}}'"""


def _refused(label: str, text: str, into: str) -> str:
    return f"'Couldn''t decode {label}(' || {text} || ') into a {into}'"


@query(
    "decode_node",
    f"""SELECT c_custkey, 'c:' || c_custkey AS element_id, 'customer' AS labels, {_refused("Relationship", _REL_TEXT, "Node")} AS wrong_kind
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def decode_node(spark, d):
    got = decode_columns(_customer_hop(spark, d), ["c_custkey"], n=("n", records.node), wrong=("r", records.node, True))
    return got.select("c_custkey", "n.element_id", F.array_join("n.labels", ",").alias("labels"), F.col("wrong").alias("wrong_kind"))


@query(
    "decode_rel",
    f"""SELECT c_custkey, 'in_nation' AS rel_type, 'c:' || c_custkey AS src, 'n:' || n_nationkey AS dst,
               {_refused("Node", _NODE_TEXT, "Relationship")} AS wrong_kind FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def decode_rel(spark, d):
    got = decode_columns(_customer_hop(spark, d), ["c_custkey"], r=("r", records.relationship),
                 wrong=("n", records.relationship, True))
    return got.select("c_custkey", "r.rel_type", "r.src", "r.dst", F.col("wrong").alias("wrong_kind"))


@query(
    "decode_path",
    f"""SELECT c_custkey, 'c:' || c_custkey AS first, 'n:' || n_nationkey AS last, 1 AS length,
               {_refused("Node", _NODE_TEXT, "Path")} AS wrong_kind FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def decode_path(spark, d):
    got = decode_columns(_customer_hop(spark, d), ["c_custkey"], p=("p", records.path), wrong=("n", records.path, True))
    p = F.col("p")
    return got.select("c_custkey", p["start"]["element_id"].alias("first"),
                      paths.path_end(p)["element_id"].alias("last"), F.size("p.segments").alias("length"),
                      F.col("wrong").alias("wrong_kind"))


@query(
    "decode_point",
    """SELECT p_partkey, 7203 AS srid, p_size::DOUBLE AS x, p_retailprice AS y,
              'Couldn''t decode Str(' || p_brand || ') into a Point' AS wrong FROM part""",
)
def decode_point(spark, d):
    parts = table(spark, d, "part").select(
        "p_partkey", temporal.point(F.col("p_size"), F.col("p_retailprice")).alias("pt"), "p_brand"
    )
    got = decode_columns(parts, ["p_partkey"], pt=("pt", scalars.point), wrong=("p_brand", scalars.point, True))
    return got.select("p_partkey", "pt.srid", "pt.x", "pt.y", "wrong")


def _durations(spark, d):
    made = temporal.duration(F.col("l_linenumber"), F.col("l_linenumber") * 2, F.col("l_quantity") * 1000, 5)
    return order_lines(spark, d, dur=made, flag=F.col("l_returnflag"))


@query(
    "decode_duration",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_linenumber::BIGINT AS months, (l_linenumber * 2)::BIGINT AS days,
              (l_quantity * 1000)::BIGINT AS seconds, 5 AS nanos,
              'Couldn''t decode Str(' || l_returnflag || ') into a IsoDuration' AS wrong FROM lineitem""",
)
def decode_duration(spark, d):
    got = decode_columns(_durations(spark, d), LINE, dur=("dur", scalars.iso_duration),
                 wrong=("flag", scalars.iso_duration, True))
    return got.select(*LINE, "dur.*", "wrong")


@query(
    "duration_to_time",
    """SELECT l_orderkey, l_linenumber, l_partkey, (l_linenumber * 2 * 86400 + l_quantity * 1000)::BIGINT AS seconds,
              5 AS nanos FROM lineitem""",
)
def duration_to_time(spark, d):
    return decode_columns(_durations(spark, d), LINE, dur=("dur", temporal.duration_time)).select(*LINE, "dur.*")


@query(
    "duration_to_period",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_linenumber::BIGINT AS months, (l_linenumber * 2)::BIGINT AS days
       FROM lineitem""",
)
def duration_to_period(spark, d):
    return decode_columns(_durations(spark, d), LINE, dur=("dur", temporal.duration_period)).select(*LINE, "dur.*")


@query(
    "duration_to_finite",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              (l_linenumber * 2 * 86400 + l_quantity * 1000)::BIGINT * 1000000000 + 5 AS nanos FROM lineitem""",
)
def duration_to_finite(spark, d):
    return decode_columns(_durations(spark, d), LINE, nanos=("dur", temporal.duration_nanos))


_OFFSET = "(CASE WHEN event_type = 'click' THEN 19800 ELSE -28800 END)"
_WALL = f"(ts + to_seconds({_OFFSET}))"
_NANOS = """(date_part('hour', {0}) * 3600000000 + date_part('minute', {0}) * 60000000
            + date_part('microseconds', {0}))::BIGINT * 1000"""


def event_instants(spark, d):
    """Every event's time as the temporal kinds; the zoned ones are five and a half hours ahead or eight behind."""
    zone = F.when(F.col("event_type") == "click", "+05:30").otherwise("-08:00")
    offset = F.when(F.col("event_type") == "click", 19800).otherwise(-28800)
    instant = temporal.zoned_from_wall(F.col("ts"), F.lit("UTC"))["ts"]
    return table(spark, d, "events").select(
        "event_id", "event_type", F.to_date("ts").alias("day"), F.col("ts").alias("local"),
        temporal.zoned_datetime(instant, zone).alias("zoned"),
        temporal.local_time(temporal.nanos_of_day(F.col("ts"))).alias("clock"),
        temporal.zoned_time(temporal.nanos_of_day(F.col("ts")), offset).alias("zoned_clock"),
    )


@query(
    "decode_date",
    f"""SELECT event_id, strftime(ts, '%Y-%m-%d') AS of_date, strftime(ts, '%Y-%m-%d') AS of_local,
               strftime({_WALL}, '%Y-%m-%d') AS of_zoned,
               'Couldn''t decode Str(' || event_type || ') into a LocalDate' AS wrong FROM events""",
)
def decode_date(spark, d):
    as_text = temporal.date.map(lambda v: v.cast("string"))
    return decode_columns(event_instants(spark, d), ["event_id"], of_date=("day", as_text), of_local=("local", as_text),
                  of_zoned=("zoned", as_text), wrong=("event_type", as_text, True))


@query(
    "decode_localtime",
    f"""SELECT event_id, {_NANOS.format('ts')} AS of_local, {_NANOS.format(_WALL)} AS of_zoned,
               {_NANOS.format('ts')} AS of_time, {_NANOS.format('ts')} AS of_zoned_time FROM events""",
)
def decode_localtime(spark, d):
    nanos = temporal.time.map(lambda v: v["nano_of_day"])
    return decode_columns(event_instants(spark, d), ["event_id"], of_local=("local", nanos), of_zoned=("zoned", nanos),
                  of_time=("clock", nanos), of_zoned_time=("zoned_clock", nanos))


@query(
    "decode_localdatetime",
    f"""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS of_local,
               strftime({_WALL}, '%Y-%m-%d %H:%M:%S.%f') AS of_zoned FROM events""",
)
def decode_localdatetime(spark, d):
    as_text = temporal.datetime.map(lambda v: F.date_format(v, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return decode_columns(event_instants(spark, d), ["event_id"], of_local=("local", as_text), of_zoned=("zoned", as_text))


@query(
    "decode_offsettime",
    f"""SELECT event_id, {_NANOS.format('ts')} AS time_nanos, {_OFFSET} AS time_offset,
               {_NANOS.format(_WALL)} AS zoned_nanos, {_OFFSET} AS zoned_offset FROM events""",
)
def decode_offsettime(spark, d):
    got = decode_columns(event_instants(spark, d), ["event_id"], t=("zoned_clock", temporal.offset_time),
                 z=("zoned", temporal.offset_time))
    return got.select("event_id", F.col("t.nanos").alias("time_nanos"), F.col("t.offset_s").alias("time_offset"),
                      F.col("z.nanos").alias("zoned_nanos"), F.col("z.offset_s").alias("zoned_offset"))


@query(
    "decode_zoned",
    """SELECT event_id, epoch_us(ts) AS instant_us,
              CASE WHEN event_type = 'click' THEN '+05:30' ELSE '-08:00' END AS zone,
              'Couldn''t decode LocalDate(' || strftime(ts, '%Y-%m-%d') || ') into a ZonedDateTime' AS wrong
       FROM events""",
)
def decode_zoned(spark, d):
    got = decode_columns(event_instants(spark, d), ["event_id"], z=("zoned", temporal.zoned), wrong=("day", temporal.zoned, True))
    return got.select("event_id", F.unix_micros("z.ts").alias("instant_us"), "z.zone", "wrong")


@query(
    "temporal_parse_errors",
    """SELECT event_id, CASE WHEN user_id < 24 THEN user_id * 3600 + 1800 END AS seconds,
              CASE WHEN user_id >= 24 THEN 'Error while parsing date value: ' || user_id || ':30:00' END AS problem
       FROM events""",
)
def temporal_parse_errors(spark, d):
    """The user id taken as an hour: out of range for most, an error for each of those rows."""
    user = F.col("user_id").cast("string")
    text = F.concat(F.when(F.length(user) < 2, F.lpad(user, 2, "0")).otherwise(user), F.lit(":30:00"))
    events = table(spark, d, "events").select("event_id", text.alias("t"))
    parsed = scalars.string.emap(lambda v: temporal.checked(temporal.parse_local_time(v), v))
    got = decode(events, parsed, ["event_id"], column_of(events, "t"))
    return got.select("event_id", F.expr("value.nano_of_day div 1000000000").alias("seconds"),
                      error_text(F.col("errors")).alias("problem"))


@query(
    "decode_object",
    f"""SELECT c_custkey, 'c:' || c_custkey AS of_node, 'in_nation' AS of_rel, c_custkey AS of_map,
               {_refused("Path", _PATH_TEXT, "Object")} AS wrong_kind FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def decode_object(spark, d):
    held = _customer_hop(spark, d).withColumn("m", F.struct("c_custkey", F.lit(1).alias("one")))
    got = decode_columns(held, ["c_custkey"], n=("n", records.any_object), r=("r", records.any_object),
                 m=("m", records.any_object), wrong=("p", records.any_object, True))
    return got.select("c_custkey", F.col("n.element_id").alias("of_node"), F.col("r.rel_type").alias("of_rel"),
                      F.col("m.c_custkey").alias("of_map"), F.col("wrong").alias("wrong_kind"))


@query(
    "decode_values",
    """SELECT l_orderkey, l_linenumber, l_partkey, 'integer,string,decimal' AS of_object, 2 AS of_list, 2 AS of_map
       FROM lineitem""",
)
def decode_values(spark, d):
    lines = order_lines(
        spark, d, o=F.struct("l_linenumber", "l_returnflag", "l_quantity"),
        xs=F.array("l_quantity", "l_discount"), m=F.create_map(F.lit("a"), "l_tax", F.lit("b"), "l_discount"),
    )
    kinds = coll.values.map(lambda xs: F.array_join(F.transform(xs, variant_kind), ","))
    count = coll.values.map(F.size)
    return decode_columns(lines, LINE, of_object=("o", kinds), of_list=("xs", count), of_map=("m", count))


@query(
    "decode_option",
    """SELECT d.doc_id, quality, quality IS NULL AS absent FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def decode_option(spark, d):
    joined = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    got = decode_columns(joined, ["doc_id"], quality=("quality", coll.option(scalars.integer)))
    return got.select("doc_id", "quality", F.col("quality").isNull().alias("absent"))


@query(
    "decode_either",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN json_extract(props, '$.k')::INTEGER END AS lefts,
              CASE WHEN event_type = 'error' THEN event_type END AS rights FROM events""",
)
def decode_either(spark, d):
    number = F.try_variant_get(F.parse_json("props"), "$.k", "variant")
    text = F.variant_get(F.to_variant_object(F.struct(F.col("event_type").alias("t"))), "$.t", "variant")
    mixed = table(spark, d, "events").select(
        "event_id", F.when(F.col("event_type") == "error", text).otherwise(number).alias("v")
    )
    got = decode_columns(mixed, ["event_id"], e=("v", coll.either(scalars.integer, scalars.string)))
    return got.select("event_id", F.col("e.left").alias("lefts"), F.col("e.right").alias("rights"))


_HUNDRED = "list_transform(embedding, lambda x: trunc((x * 100)::DOUBLE)::BIGINT)"


def hundredths(spark, d):
    scaled = F.transform("embedding", lambda x: (x * F.lit(100).cast("float")).cast("double"))
    return table(spark, d, "embeddings").select("vec_id", scaled.alias("xs"))


def _total(xs):
    return F.aggregate(xs, F.lit(0).cast("bigint"), lambda a, x: a + x)


@query(
    "decode_list",
    f"""SELECT vec_id, list_sum({_HUNDRED})::BIGINT AS total, len(embedding)::INTEGER AS n,
               'Couldn''t decode Integer(' || vec_id || ') into a List' AS wrong FROM embeddings""",
)
def decode_list(spark, d):
    got = decode_columns(hundredths(spark, d).withColumn("id", F.col("vec_id")), ["vec_id"],
                 xs=("xs", coll.list_of(scalars.integer)), wrong=("id", coll.list_of(scalars.integer), True))
    return got.select("vec_id", _total(F.col("xs")).alias("total"), F.size("xs").alias("n"), "wrong")


@query(
    "decode_vector",
    f"SELECT vec_id, array_to_string({_HUNDRED}, ',') AS items FROM embeddings",
)
def decode_vector(spark, d):
    got = decode_columns(hundredths(spark, d), ["vec_id"], xs=("xs", coll.vector_of(scalars.long)))
    return got.select("vec_id", F.array_join(F.col("xs").cast("array<string>"), ",").alias("items"))


@query(
    "decode_set",
    f"""SELECT vec_id, len(list_distinct({_HUNDRED}))::INTEGER AS n, list_sum(list_distinct({_HUNDRED}))::BIGINT AS total
        FROM embeddings""",
)
def decode_set(spark, d):
    got = decode_columns(hundredths(spark, d), ["vec_id"], xs=("xs", coll.set_of(scalars.long)))
    return got.select("vec_id", F.size("xs").alias("n"), _total(F.col("xs")).alias("total"))


_WORD_ROWS = """(SELECT doc_id, words[i] AS word, i - 1 AS pos FROM
                 (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM
                  (SELECT doc_id, string_split(text, ' ') AS words FROM documents)))"""


@query(
    "decode_pairs_map",
    f"""SELECT doc_id, string_agg(word || '=' || last, ' ' ORDER BY word) AS entries
        FROM (SELECT doc_id, word, max(pos) AS last FROM {_WORD_ROWS} GROUP BY doc_id, word) GROUP BY doc_id""",
)
def decode_pairs_map(spark, d):
    """(word, position) pairs of every text; the last position of a word wins."""
    pairs = F.transform(F.split("text", " ", -1), lambda w, i: F.struct(w.alias("k"), i.alias("v")))
    docs = table(spark, d, "documents").select("doc_id", pairs.alias("pairs"))
    got = decode_columns(docs, ["doc_id"], entries=("pairs", coll.pairs_map(scalars.string, scalars.integer)))
    shown = F.transform("entries", lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return got.select("doc_id", F.array_join(shown, " ").alias("entries"))


@query(
    "decode_object_map",
    """SELECT s_suppkey, 'S_NATIONKEY=' || s_nationkey || ',S_SUPPKEY=' || s_suppkey AS of_object,
              'FOO=' || s_nationkey AS of_map,
              'Error decoding key: ''foo''' AS bad_key FROM supplier""",
)
def decode_object_map(spark, d):
    held = table(spark, d, "supplier").select(
        "s_suppkey", F.struct("s_nationkey", F.col("s_suppkey")).alias("o"),
        F.create_map(F.lit("foo"), "s_nationkey").alias("m"),
    )
    upper = coll.KeyDecoder().imap(F.lower, F.upper)
    strange = coll.KeyDecoder(accepts=lambda k: k == "bar")
    text = lambda es: F.array_join(
        F.transform(coll.sorted_entries(es), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ","
    )
    return decode_columns(
        held, ["s_suppkey"], of_object=("o", coll.object_map(scalars.long, upper).map(text)),
        of_map=("m", coll.object_map(scalars.integer, upper).map(text)),
        bad_key=("m", coll.object_map(scalars.integer, strange), True),
    )


@query("decode_field", "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events")
def decode_field(spark, d):
    events = table(spark, d, "events").select("event_id", F.from_json("props", "k bigint").alias("p"))
    return decode_columns(events, ["event_id"], k=("p", records.field("k", scalars.long)))


@query(
    "decode_at",
    f"SELECT vec_id, {_HUNDRED}[64] AS last, 'Field ''index-64'' not found' AS beyond FROM embeddings",
)
def decode_at(spark, d):
    return decode_columns(hundredths(spark, d), ["vec_id"], last=("xs", coll.element_at(63, scalars.long)),
                  beyond=("xs", coll.element_at(64, scalars.long), True))


@query(
    "decode_lone",
    """SELECT vec_id, round(list_filter(embedding, lambda x: x > 0.2::FLOAT)[1]::DOUBLE, 6) AS first,
              CASE WHEN len(list_filter(embedding, lambda x: x > 0.2::FLOAT)) = 0 THEN 'Values was empty' END AS problem
       FROM embeddings""",
)
def decode_lone(spark, d):
    high = F.filter("embedding", lambda x: x > F.lit(0.2).cast("float"))
    vectors = table(spark, d, "embeddings").select("vec_id", high.alias("xs"))
    lone = coll.lone_element(scalars.double)
    got = decode_columns(vectors, ["vec_id"], first=("xs", lone), problem=("xs", lone, True))
    return got.select("vec_id", F.round("first", 6).alias("first"), "problem")


@query("decode_tuple", "SELECT s_suppkey AS _1, s_name AS _2, s_nationkey AS _3 FROM supplier")
def decode_tuple(spark, d):
    shape = records.tuple_of(scalars.long, scalars.string, scalars.integer)
    return decode(table(spark, d, "supplier"), shape).select("value.*")


@query("decode_tuple_named", "SELECT s_acctbal, s_name FROM supplier")
def decode_tuple_named(spark, d):
    shape = records.tuple_named({"s_acctbal": scalars.double, "s_name": scalars.string})
    return decode(table(spark, d, "supplier"), shape).select("value.*")


@query(
    "decode_product",
    "SELECT r_regionkey AS id, r_name AS name, NULL::VARCHAR AS note FROM region",
)
def decode_product(spark, d):
    """By position; the third value is not there and reads as null."""
    shape = records.product({"id": scalars.long, "name": scalars.string, "note": coll.option(scalars.string)})
    return decode(table(spark, d, "region"), shape).select(
        "value.id", "value.name", F.col("value.note").cast("string").alias("note")
    )


_LABELLED = "documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"


def _labelled(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return docs.join(table(spark, d, "labels"), "doc_id", "left")


@query(
    "decode_product_named",
    f"""SELECT d.doc_id, lang AS language, quality,
               CASE WHEN toxic IS NULL THEN 'Couldn''t decode NullValue into a int for field ''toxic''' END AS problem
        FROM {_LABELLED}""",
)
def decode_product_named(spark, d):
    """A document without labels lacks a required field; its errors are kept beside the good rows."""
    joined = _labelled(spark, d)
    shape = records.product_named({"language": ("lang", scalars.string), "quality": coll.option(scalars.integer)})
    strict_shape = records.product_named({"toxic": scalars.integer, "lang": scalars.string})
    got = joined.select("doc_id", shape(record_of(joined)).value.alias("v"),
                        strict_shape(record_of(joined)).errors.alias("e"))
    return got.select("doc_id", "v.language", "v.quality", error_text(F.col("e")).alias("problem"))


@dataclasses.dataclass
class Part:
    p_partkey: int
    p_name: str
    p_retailprice: float
    p_origin: str | None


@query(
    "decode_derive_record",
    "SELECT p_partkey, p_name, p_retailprice, NULL::VARCHAR AS p_origin FROM part",
)
def decode_derive_record(spark, d):
    """A shape taken from a record class; a field that is not in the table is absent."""
    return decode(table(spark, d, "part"), records.derive(Part)).select(
        "value.p_partkey", "value.p_name", "value.p_retailprice",
        F.col("value.p_origin").cast("string").alias("p_origin"),
    )


@query(
    "decode_nested",
    """SELECT o_orderkey, o_orderstatus, o_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def decode_nested(spark, d):
    """Two records from one flat row."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    flat = orders.join(table(spark, d, "customer").select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
    shape = combine({
        "bought": records.named({"o_orderkey": scalars.long, "o_orderstatus": scalars.string}),
        "buyer": records.named({"o_custkey": scalars.long, "c_name": scalars.string}),
    })
    return decode(flat, shape).select("value.bought.*", "value.buyer.*")


@query("decode_split", "SELECT p_partkey, p_brand AS text, p_size AS number FROM part")
def decode_split(spark, d):
    """One field that holds a pair becomes two."""
    parts = table(spark, d, "part").select("p_partkey", F.struct("p_brand", "p_size").alias("data"))
    shape = records.named({"p_partkey": scalars.long, "data": records.tuple_of(scalars.string, scalars.integer)})
    return decode(parts, shape).select("value.p_partkey", F.col("value.data._1").alias("text"),
                                       F.col("value.data._2").alias("number"))


@query("decode_merge", "SELECT p_partkey, p_brand || '/' || p_size AS data FROM part")
def decode_merge(spark, d):
    """Two fields become one."""
    shape = records.named(
        {"p_partkey": scalars.long, "p_brand": scalars.string, "p_size": scalars.integer},
        lambda key, brand, size: F.struct(key.alias("p_partkey"),
                                          F.concat_ws("/", brand, size.cast("string")).alias("data")),
    )
    return decode(table(spark, d, "part"), shape).select("value.*")


@query(
    "decode_defaults",
    f"SELECT d.doc_id, coalesce(quality, -1) AS quality, 0 AS revision FROM {_LABELLED}",
)
def decode_defaults(spark, d):
    shape = records.named({
        "doc_id": scalars.long,
        "quality": records.with_default(scalars.integer, F.lit(-1)),
        "revision": records.with_default(scalars.integer, F.lit(0)),
    })
    return decode(_labelled(spark, d), shape).select("value.*")


def _as_node(df, *props):
    return df.select(
        F.struct(F.col("element_id"), F.col("labels"), F.to_variant_object(F.struct(*props)).alias("properties")).alias("n")
    )


@query(
    "decode_union_by_label",
    """SELECT 'c:' || c_custkey AS element_id, 'Customer' AS kind, c_name AS name, c_acctbal AS balance,
              NULL AS problem FROM customer
       UNION ALL SELECT 's:' || s_suppkey, 'Supplier', s_name, NULL, NULL FROM supplier
       UNION ALL SELECT 'n:' || n_nationkey, NULL, NULL, NULL, 'Unexpected node labels: Set(nation)' FROM nation""",
)
def decode_union_by_label(spark, d):
    g = order_graph(spark, d)
    nodes = (
        _as_node(g.nodes("customer"), "c_name", "c_acctbal")
        .unionAll(_as_node(g.nodes("supplier"), "s_name", "s_nationkey"))
        .unionAll(_as_node(g.nodes("nation"), "n_name"))
    )
    union = unions.by_label({
        "Customer": records.named({"name": ("c_name", scalars.string), "balance": ("c_acctbal", scalars.double)}),
        "Supplier": records.named({"name": ("s_name", scalars.string)}),
    })
    got = decode(nodes, union, ["n"], column_of(nodes, "n"))
    return got.select(
        "n.element_id", F.col("value.case").alias("kind"),
        F.coalesce("value.Customer.name", "value.Supplier.name").alias("name"),
        F.col("value.Customer.balance").alias("balance"), error_text(F.col("errors")).alias("problem"),
    )


@query(
    "decode_union_by_type",
    """SELECT 'placed:' || o_orderkey AS element_id, 'PLACED' AS kind, o_totalprice AS price, NULL AS problem FROM orders
       UNION ALL SELECT 'in_region:' || n_nationkey, NULL, NULL, 'Unexpected relationship type: in_region' FROM nation""",
)
def decode_union_by_type(spark, d):
    g = order_graph(spark, d)

    def as_rel(df, *props):
        body = F.struct(*props) if props else F.struct(F.lit(None).cast("int").alias("none"))
        return df.select(F.struct(
            "element_id", "rel_type", F.to_variant_object(body).alias("properties"),
            F.col("src").cast("string").alias("src"), F.col("dst").cast("string").alias("dst")).alias("r"))

    rels = as_rel(g.rels("placed"), "o_totalprice").unionAll(as_rel(g.rels("in_region")))
    union = unions.by_type({
        "PLACED": records.named({"price": ("o_totalprice", scalars.double)}),
        "RETURNED": constant(F.lit(True)),
    })
    got = decode(rels, union, ["r"], column_of(rels, "r"))
    return got.select("r.element_id", F.col("value.case").alias("kind"),
                      F.col("value.PLACED.price").alias("price"), error_text(F.col("errors")).alias("problem"))


@query(
    "decode_union_by_field",
    """SELECT event_id, CASE WHEN event_type IN ('click', 'purchase') THEN event_type END AS kind,
              CASE WHEN event_type = 'click' THEN user_id END AS user_id,
              CASE WHEN event_type = 'purchase' THEN value END AS value,
              CASE WHEN event_type NOT IN ('click', 'purchase') THEN 'Unexpected field label: ' || event_type END AS problem
       FROM events""",
)
def decode_union_by_field(spark, d):
    union = unions.by_field("event_type", {
        "click": records.named({"user_id": scalars.long}),
        "purchase": records.named({"value": scalars.double}),
        "View": constant(F.lit(1)),  # case matters: no event is chosen by this
    })
    got = decode(table(spark, d, "events"), union, ["event_id"])
    return got.select(
        "event_id", F.col("value.case").alias("kind"), F.col("value.click.user_id").alias("user_id"),
        F.col("value.purchase.value").alias("value"), error_text(F.col("errors")).alias("problem"),
    )


@dataclasses.dataclass
class Click:
    user_id: int


@dataclasses.dataclass
class Purchase:
    user_id: int
    value: float


@query(
    "decode_derive_union",
    """SELECT event_id, event_type AS kind, CASE WHEN event_type = 'click' THEN user_id END AS clicked_by,
              CASE WHEN event_type = 'purchase' THEN value END AS paid FROM events
       WHERE event_type IN ('click', 'purchase', 'view', 'signup', 'error')""",
)
def decode_derive_union(spark, d):
    events = table(spark, d, "events").withColumnRenamed("event_type", "type")
    union = unions.derive_union({"click": Click, "purchase": Purchase, "view": None, "signup": None, "error": None})
    got = decode(events, union, ["event_id"])
    return got.select("event_id", F.col("value.case").alias("kind"),
                      F.col("value.click.user_id").alias("clicked_by"), F.col("value.purchase.value").alias("paid"))
