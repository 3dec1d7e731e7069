"""Values and records encoded as stored properties. Every query writes whole tables and reads them back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from graphloom.catalog.decoding import LINE
from graphloom.catalog.registry import query
from graphloom.catalog.scans import written_back
from graphloom.functions import collections as coll
from graphloom.functions import params, records, scalars, temporal
from graphloom.functions.cells import column_of, record_of, variant_kind
from graphloom.functions.decoder import decode
from graphloom.functions.params import encode, record_params
from graphloom.functions.params import query as deferred
from graphloom.operators import writes
from graphloom.sources.graph import element_id
from graphloom.sources.tables import table


@query(
    "encode_scalar",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_discount > 0.05 AS flag, l_tax::FLOAT AS small, l_quantity AS wide,
              upper(hex(encode(l_returnflag))) AS raw, 7 AS const_int, 2.5::DOUBLE AS const_double, true AS const_bool,
              'text' AS const_text, '010305' AS const_raw FROM lineitem""",
)
def encode_scalar(spark, d):
    made = table(spark, d, "lineitem").select(
        *LINE, (F.col("l_discount") > 0.05).alias("flag"), F.col("l_tax").cast("float").alias("small"),
        F.col("l_quantity").alias("wide"), F.encode("l_returnflag", "utf-8").alias("raw"),
        encode(7).alias("const_int"), encode(2.5).alias("const_double"), encode(True).alias("const_bool"),
        encode("text").alias("const_text"), encode(bytes([1, 3, 5])).alias("const_raw"),
    )
    return written_back(spark, made, "scalar").withColumns({"raw": F.hex("raw"), "const_raw": F.hex("const_raw")})


@query(
    "encode_uuid",
    """SELECT c_custkey, substr(h,1,8) || '-' || substr(h,9,4) || '-' || substr(h,13,4) || '-' || substr(h,17,4) || '-' ||
              substr(h,21,12) AS id, 'd18e9810-87ad-444c-871e-7e41e0e4623c' AS const_id
       FROM (SELECT c_custkey, md5(c_name) AS h FROM customer)""",
)
def encode_uuid(spark, d):
    h = F.md5("c_name")
    dashed = F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    customer = table(spark, d, "customer").select("c_custkey", dashed.alias("id"))
    ids = scalars.uuid(column_of(customer, "id")).value
    const = encode(uuid.UUID("d18e9810-87ad-444c-871e-7e41e0e4623c"))
    return written_back(spark, customer.select("c_custkey", ids.alias("id"), const.alias("const_id")), "uuid")


@query(
    "encode_temporal",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS wall,
              (o_orderkey % 86400) * 1000000000 AS clock, epoch_us(o_orderdate) AS instant_us, '+02:00' AS zone,
              o_custkey AS days, 35::BIGINT AS const_seconds, 48600000000000 AS const_clock, 7200 AS const_offset
       FROM orders""",
)
def encode_temporal(spark, d):
    """Dates, times, zoned values and durations as columns, beside encoded constants."""
    instant = temporal.zoned_from_wall(F.col("o_orderdate"), F.lit("UTC"))["ts"]
    zone = dt.timezone(dt.timedelta(hours=2))
    made = table(spark, d, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"), F.col("o_orderdate").alias("wall"),
        temporal.local_time((F.col("o_orderkey") % 86400) * F.lit(10**9)).alias("clock"),
        temporal.zoned_datetime(instant, F.lit("+02:00")).alias("zoned"),
        temporal.duration(days=F.col("o_custkey")).alias("duration"),
        encode(dt.timedelta(seconds=35)).alias("const_duration"),
        encode(dt.time(13, 30)).alias("const_time"), encode(dt.time(13, 30, tzinfo=zone)).alias("const_zoned"),
    )
    return written_back(spark, made, "temporal").select(
        "o_orderkey", F.col("day").cast("string").alias("day"),
        F.date_format("wall", "yyyy-MM-dd HH:mm:ss").alias("wall"), F.col("clock.nano_of_day").alias("clock"),
        F.unix_micros("zoned.ts").alias("instant_us"), F.col("zoned.zone").alias("zone"),
        F.col("duration.days").alias("days"), F.col("const_duration.seconds").alias("const_seconds"),
        F.col("const_time.nano_of_day").alias("const_clock"), F.col("const_zoned.offset_s").alias("const_offset"),
    )


@query(
    "encode_list",
    """SELECT vec_id, array_to_string(list_transform(embedding, lambda x: round(x::DOUBLE * 1000000)::BIGINT), ',') AS items,
              '5,10' AS const_list FROM embeddings""",
)
def encode_list(spark, d):
    made = table(spark, d, "embeddings").select("vec_id", "embedding", encode([5, 10]).alias("const_list"))
    return written_back(spark, made, "list").select(
        "vec_id",
        F.array_join(F.transform("embedding", lambda x: F.round(x.cast("double") * 1000000).cast("bigint").cast("string")), ",")
        .alias("items"),
        F.array_join(F.col("const_list").cast("array<string>"), ",").alias("const_list"),
    )


@query(
    "encode_map",
    """SELECT p_partkey, 'KEY-size=' || p_size || ',KEY-type=' || length(p_type) AS entries, 3 AS p1, 5 AS p2 FROM part""",
)
def encode_map(spark, d):
    """A map whose keys are converted on the way in."""
    keys = coll.KeyDecoder().imap(lambda k: F.concat(F.lit("KEY-"), k), lambda k: F.substr(k, F.lit(5)))
    pairs = F.array(
        F.struct(F.lit("size").alias("k"), F.col("p_size").alias("v")),
        F.struct(F.lit("type").alias("k"), F.length("p_type").alias("v")),
    )
    entries = F.transform(pairs, lambda e: F.struct(keys.encode(e["k"]).alias("key"), e["v"].alias("value")))
    made = table(spark, d, "part").select(
        "p_partkey", coll.as_map(entries).alias("m"), encode({"p1": 3, "p2": 5}).alias("const_map")
    )
    shown = F.transform(
        F.sort_array(F.map_entries("m")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))
    )
    return written_back(spark, made, "map").select(
        "p_partkey", F.array_join(shown, ",").alias("entries"), F.col("const_map")["p1"].alias("p1"),
        F.col("const_map")["p2"].alias("p2"),
    )


@query(
    "encode_option",
    """SELECT d.doc_id, quality, toxic, 5 AS const_some, true AS const_none_is_null FROM documents d
       LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def encode_option(spark, d):
    """An absent value is stored as null and decodes as absent."""
    joined = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    made = joined.select("*", encode(5).alias("const_some"), encode(None).cast("int").alias("const_none"))
    stored = written_back(spark, made, "option")
    shape = records.named({
        "quality": coll.option(scalars.integer), "toxic": coll.option(scalars.integer),
        "const_some": coll.option(scalars.integer), "const_none": coll.option(scalars.integer),
    })
    return decode(stored, shape, ["doc_id"]).select(
        "doc_id", "value.quality", "value.toxic", "value.const_some",
        F.col("value.const_none").isNull().alias("const_none_is_null"),
    )


@query(
    "encode_pair",
    """SELECT s_suppkey, s_name AS first, s_nationkey AS second, 'string,integer' AS kinds, 'a:1' AS const_pair FROM supplier""",
)
def encode_pair(spark, d):
    """A pair is a mixed list of two."""
    made = table(spark, d, "supplier").select(
        "s_suppkey", params.mixed_list([F.col("s_name"), F.col("s_nationkey")]).alias("pair"),
        encode(("a", 1)).alias("const_pair"),
    )
    stored = written_back(spark, made, "pair")
    pair = records.tuple_of(scalars.string, scalars.integer)
    got, const = pair(column_of(stored, "pair")), pair(column_of(stored, "const_pair"))
    return stored.select(
        "s_suppkey", got.value["_1"].alias("first"), got.value["_2"].alias("second"),
        F.array_join(F.transform("pair", variant_kind), ",").alias("kinds"),
        F.concat_ws(":", const.value["_1"], const.value["_2"].cast("string")).alias("const_pair"),
    )


@query(
    "encode_mixed",
    """SELECT event_id, 'integer,string,decimal,map,null' AS list_kinds, event_type AS list_text,
              'boolean' AS map_kind, json_extract(props, '$.k')::INTEGER AS nested FROM events""",
)
def encode_mixed(spark, d):
    """Lists and maps whose elements differ in kind."""
    props = F.parse_json("props")
    made = table(spark, d, "events").select(
        "event_id",
        params.mixed_list([F.col("user_id"), F.col("event_type"), F.col("value"), props, None]).alias("xs"),
        params.mixed_map({"big": F.col("user_id") > 50, "props": props}).alias("m"),
    )
    stored = written_back(spark, made, "mixed")
    cell = column_of(stored, "m")
    nested = records.field("props", records.field("k", scalars.integer))(cell)
    return stored.select(
        "event_id", F.array_join(F.transform("xs", variant_kind), ",").alias("list_kinds"),
        F.variant_get(F.get("xs", F.lit(1)), "$", "string").alias("list_text"),
        variant_kind(cell.field("big").col).alias("map_kind"), nested.value.alias("nested"),
    )


@query("encode_null", "SELECT n_nationkey, true AS np, true AS op FROM nation")
def encode_null(spark, d):
    made = table(spark, d, "nation").select(
        "n_nationkey", encode(None).cast("string").alias("np"), F.when(F.col("n_nationkey") < 0, "x").alias("op")
    )
    return written_back(spark, made, "null").select(
        "n_nationkey", F.col("np").isNull().alias("np"), F.col("op").isNull().alias("op")
    )


@query(
    "encode_record",
    "SELECT 'o:' || o_orderkey AS element_id, o_totalprice, o_orderstatus, 'John' AS name, 33 AS age FROM orders",
)
def encode_record(spark, d):
    """A record column and a record of parameters both become properties in declaration order."""
    fragment = params.Fragment(
        "SELECT o_orderkey, struct(o_totalprice, o_orderstatus) AS rec, ", record_params({"name": "John", "age": 33}),
        " FROM {orders}",
    )
    rows = deferred(fragment).run(spark, orders=table(spark, d, "orders"))
    nodes = writes.create_from_record(rows, "rec", "Order", element_id("order", "o_orderkey"), "name", "age")
    return written_back(spark, nodes.drop("labels"), "record")


@query(
    "roundtrip_types",
    """SELECT event_id, event_type AS string, user_id AS int, NULL::INTEGER AS opt1, 5 AS opt2,
              upper(hex(encode(event_type))) AS bytes, user_id || ',' || event_id AS list, '333' AS vector, '100' AS sett,
              '200,404' AS bit_set, strftime(ts, '%Y-%m-%d') AS local_date,
              strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS local_date_time, epoch_us(ts) % 86400000000 * 1000 AS local_time,
              3600 AS offset_time, epoch_us(ts) AS zoned_date_time, 35::BIGINT AS duration, 3::BIGINT AS period,
              'd18e9810-87ad-444c-871e-7e41e0e4623c' AS uuid, '1,2,3,4' AS iso_duration, value AS point FROM events""",
)
def roundtrip_types(spark, d):
    """Nineteen properties of different types, stored and decoded to equal values."""
    ts = F.col("ts")
    instant = temporal.zoned_from_wall(ts, F.lit("UTC"))["ts"]
    made = table(spark, d, "events").select(
        "event_id", F.col("event_type").alias("string"), F.col("user_id").alias("int"),
        encode(None).cast("int").alias("opt1"), encode(5).alias("opt2"),
        F.encode("event_type", "utf-8").alias("bytes"), F.array("user_id", "event_id").alias("list"),
        encode([333]).alias("vector"), encode([100, 100]).alias("sett"), encode([404, 200]).alias("bit_set"),
        F.to_date(ts).alias("local_date"), ts.alias("local_date_time"),
        temporal.local_time(temporal.nanos_of_day(ts)).alias("local_time"),
        temporal.zoned_time(temporal.nanos_of_day(ts), F.lit(3600)).alias("offset_time"),
        temporal.zoned_datetime(instant, F.lit("Z")).alias("zoned_date_time"),
        encode(dt.timedelta(seconds=35)).alias("duration"), temporal.duration(months=3).alias("period"),
        encode(uuid.UUID("d18e9810-87ad-444c-871e-7e41e0e4623c")).alias("uuid"),
        temporal.duration(1, 2, 3, 4).alias("iso_duration"),
        temporal.point(F.col("value"), F.lit(5.3)).alias("point"),
    )
    stored = written_back(spark, made, "types")
    joined = lambda xs: F.array_join(xs.cast("array<string>"), ",")
    shape = records.named({
        "string": scalars.string, "int": scalars.long, "opt1": coll.option(scalars.integer),
        "opt2": coll.option(scalars.integer), "bytes": scalars.binary.map(F.hex),
        "list": coll.list_of(scalars.long).map(joined), "vector": coll.vector_of(scalars.integer).map(joined),
        "sett": coll.set_of(scalars.integer).map(joined), "bit_set": coll.sorted_set_of(scalars.integer).map(joined),
        "local_date": temporal.date.map(lambda v: v.cast("string")),
        "local_date_time": temporal.datetime.map(lambda v: F.date_format(v, "yyyy-MM-dd HH:mm:ss.SSSSSS")),
        "local_time": temporal.time.map(lambda v: v["nano_of_day"]),
        "offset_time": temporal.offset_time.map(lambda v: v["offset_s"]),
        "zoned_date_time": temporal.zoned.map(lambda v: F.unix_micros(v["ts"])),
        "duration": temporal.duration_time.map(lambda v: v["seconds"]),
        "period": temporal.duration_period.map(lambda v: v["months"]), "uuid": scalars.uuid,
        "iso_duration": scalars.iso_duration.map(
            lambda v: F.concat_ws(",", *[v[x].cast("string") for x in ("months", "days", "seconds", "nanos")])
        ),
        "point": scalars.point.map(lambda v: v["x"]),
    })
    return decode(stored, shape, ["event_id"], record_of(stored)).select("event_id", "value.*")
