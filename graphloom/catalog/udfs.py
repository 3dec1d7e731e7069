"""User functions over decoded values."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.catalog.decoding import LINE, decode_columns, event_instants, order_lines
from graphloom.catalog.registry import query
from graphloom.functions import records, scalars, temporal
from graphloom.functions.cells import record_of
from graphloom.functions.decoder import Decoded, combine, decode, error_text, failed, from_match, no_errors
from graphloom.sources.tables import table


@query(
    "udf_map",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice * 1.1::DOUBLE AS gross FROM lineitem",
)
def udf_map(spark, d):
    gross = scalars.double.map(lambda v: v * 1.1)
    return decode_columns(order_lines(spark, d, price=F.col("l_extendedprice")), LINE, gross=("price", gross))


@query(
    "udf_emap",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity <> 7 THEN 100.0::DOUBLE / (l_quantity - 7) END AS x,
              CASE WHEN l_quantity = 7 THEN 'seven has no inverse' END AS problem FROM lineitem""",
)
def udf_emap(spark, d):
    def inverse(v):
        is_seven = v == 7
        return F.try_divide(F.lit(100.0), v - 7), F.when(is_seven, F.lit("seven has no inverse"))

    made = scalars.double.emap(inverse)
    return decode_columns(order_lines(spark, d, q=F.col("l_quantity")), LINE, x=("q", made), problem=("q", made, True))


@query(
    "udf_transform",
    """SELECT event_id, CASE WHEN event_type = 'click' THEN event_type ELSE 'recovered: Couldn''t decode Integer(' ||
              user_id || ') into a String' END AS outcome FROM events""",
)
def udf_transform(spark, d):
    """A failure seen and turned into a value."""
    recover = scalars.string.transform(
        lambda got: Decoded(
            F.when(got.ok, got.value).otherwise(F.concat(F.lit("recovered: "), error_text(got.errors))), no_errors()
        )
    )
    text = F.variant_get(F.to_variant_object(F.struct(F.col("event_type").alias("v"))), "$.v", "variant")
    number = F.variant_get(F.to_variant_object(F.struct(F.col("user_id").alias("v"))), "$.v", "variant")
    events = table(spark, d, "events").select(
        "event_id", F.when(F.col("event_type") == "click", text).otherwise(number).alias("v")
    )
    return decode_columns(events, ["event_id"], outcome=("v", recover))


@query(
    "udf_flatmap",
    """SELECT event_id, CASE event_type WHEN 'purchase' THEN value WHEN 'click' THEN user_id::DOUBLE END AS amount,
              CASE WHEN event_type NOT IN ('purchase', 'click') THEN 'no amount' END AS problem FROM events""",
)
def udf_flatmap(spark, d):
    """The event type decides which field is decoded next."""
    amount = records.field("event_type", scalars.string).flat_map(
        lambda kind: [
            (kind == "purchase", records.field("value", scalars.double)),
            (kind == "click", records.field("user_id", scalars.double)),
        ],
        otherwise=failed("no amount", ddl="double"),
    )
    got = decode(table(spark, d, "events"), amount, ["event_id"])
    return got.select("event_id", F.col("value").alias("amount"), error_text(F.col("errors")).alias("problem"))


@query(
    "udf_and",
    """SELECT s_suppkey, s_nationkey AS number, s_acctbal AS amount,
              'Multiple decoding errors:' || chr(10) || 'Couldn''t decode Str(' || s_name || ') into a int for field ''s_name''' || chr(10) ||
              'Couldn''t decode Str(' || s_name || ') into a boolean for field ''s_name''' || chr(10) AS both_bad FROM supplier""",
)
def udf_and(spark, d):
    good = records.field("s_nationkey", scalars.integer).and_(records.field("s_acctbal", scalars.double))
    bad = records.field("s_name", scalars.integer).and_(records.field("s_name", scalars.boolean))
    supplier = table(spark, d, "supplier")
    pair, failure = good(record_of(supplier)), bad(record_of(supplier))
    got = supplier.select("s_suppkey", pair.value.alias("v"), failure.errors.alias("e"))
    return got.select("s_suppkey", F.col("v.left").alias("number"), F.col("v.right").alias("amount"),
                      error_text(F.col("e")).alias("both_bad"))


@query(
    "udf_or",
    """SELECT event_id, user_id::VARCHAR AS text, 'Multiple decoding errors:' || chr(10) ||
              'Couldn''t decode Integer(' || user_id || ') into a boolean' || chr(10) ||
              'Couldn''t decode Integer(' || user_id || ') into a UUID' || chr(10) AS both_bad FROM events""",
)
def udf_or(spark, d):
    number_as_text = scalars.long.map(lambda v: v.cast("string"))
    return decode_columns(
        table(spark, d, "events").select("event_id", "user_id"), ["event_id"],
        text=("user_id", scalars.string.or_(number_as_text)),
        both_bad=("user_id", scalars.boolean.map(lambda v: v.cast("string")).or_(scalars.uuid), True),
    )


@query(
    "udf_combine",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge FROM lineitem""",
)
def udf_combine(spark, d):
    """Three decoders on the same row, into one function."""
    charge = combine(
        {
            "price": records.field("l_extendedprice", scalars.double),
            "discount": records.field("l_discount", scalars.double),
            "tax": records.field("l_tax", scalars.double),
        },
        lambda price, discount, tax: price * (1 - discount) * (1 + tax),
    )
    return decode(table(spark, d, "lineitem"), charge, LINE).select(*LINE, F.col("value").alias("charge"))


@query(
    "udf_from_function",
    "SELECT c_custkey, c_name || '@' || c_nationkey AS address FROM customer",
)
def udf_from_function(spark, d):
    """A function of the first fields of a row, by position."""
    address = records.from_function(
        {"name": scalars.string, "nation": scalars.integer},
        lambda name, nation: F.concat_ws("@", name, nation.cast("string")),
    )
    held = table(spark, d, "customer").select(
        "c_custkey", F.struct("c_name", "c_nationkey", "c_mktsegment").alias("row")
    )
    return decode_columns(held, ["c_custkey"], address=("row", address))


@query(
    "udf_from_function_named",
    "SELECT c_custkey, c_mktsegment || '/' || c_name AS tag FROM customer",
)
def udf_from_function_named(spark, d):
    tag = records.from_function_named(
        {"c_mktsegment": scalars.string, "c_name": scalars.string}, lambda segment, name: F.concat_ws("/", segment, name)
    )
    got = decode(table(spark, d, "customer"), tag, ["c_custkey"])
    return got.select("c_custkey", F.col("value").alias("tag"))


@query(
    "udf_from_match",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'text error' ELSE 'number ' || json_extract(props, '$.k') END AS of_mixed,
              'Couldn''t decode Decimal(' || value::VARCHAR || ') into a Label' AS of_double FROM events""",
)
def udf_from_match(spark, d):
    """Cases by kind; a one-key object is unwrapped first, anything else fails."""
    label = from_match("Label", "string", [
        ("string", lambda c: F.concat(F.lit("text "), c.col)),
        ("integer", lambda c: F.concat(F.lit("number "), c.col.cast("string"))),
    ])
    text = F.variant_get(F.to_variant_object(F.struct(F.col("event_type").alias("v"))), "$.v", "variant")
    events = table(spark, d, "events").select(
        "event_id", F.when(F.col("event_type") == "error", text).otherwise(F.parse_json("props")).alias("v"), "value"
    )
    return decode_columns(events, ["event_id"], of_mixed=("v", label), of_double=("value", label, True))


@query(
    "udf_numeric",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_linenumber * 2 AS of_integer, floor(l_quantity / 2)::BIGINT AS of_double,
              'Couldn''t decode Str(' || l_returnflag || ') into a Score' AS of_string FROM lineitem""",
)
def udf_numeric(spark, d):
    score = scalars.from_numeric("Score", "bigint", lambda v: v * 2, lambda v: F.floor(v / 2))
    got = decode_columns(
        order_lines(spark, d, n=F.col("l_linenumber"), q=F.col("l_quantity"), f=F.col("l_returnflag")), LINE,
        of_integer=("n", score), of_double=("q", score), of_string=("f", score, True),
    )
    return got.withColumn("of_integer", F.col("of_integer").cast("int"))


@query(
    "udf_temporal",
    """SELECT event_id, date_part('year', ts)::INTEGER AS of_date, date_part('year', ts)::INTEGER AS of_local,
              'Couldn''t decode Str(' || event_type || ') into a Year' AS of_string FROM events""",
)
def udf_temporal(spark, d):
    year = temporal.from_temporal("Year", "int", [
        ("date", lambda c: F.year(c.col)), ("local_datetime", lambda c: F.year(c.col)),
    ])
    return decode_columns(event_instants(spark, d), ["event_id"], of_date=("day", year), of_local=("local", year),
                  of_string=("event_type", year, True))
