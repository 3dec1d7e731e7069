"""Scalar functions used in queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.catalog.registry import query
from graphloom.functions import temporal
from graphloom.sources.tables import table


@query("fn_lower", "SELECT doc_id, lower(text) AS text FROM documents")
def fn_lower(spark, d):
    return table(spark, d, "documents").select("doc_id", F.lower("text").alias("text"))


@query("fn_contains", "SELECT page_id, contains(html, '<article>') AS has_article FROM pages")
def fn_contains(spark, d):
    return table(spark, d, "pages").select("page_id", F.col("html").contains("<article>").alias("has_article"))


@query(
    "fn_round",
    "SELECT l_orderkey, l_linenumber, l_partkey, round(100 * l_discount) AS pct, round(l_quantity / 4) AS q FROM lineitem",
)
def fn_round(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(100 * F.col("l_discount")).alias("pct"),
        F.round(F.col("l_quantity") / 4).alias("q"),
    )


@query(
    "fn_temporal",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day,
              (date_part('hour', ts) * 3600000000 + date_part('minute', ts) * 60000000
               + date_part('microseconds', ts))::BIGINT * 1000 AS nanos,
              epoch_us(ts) AS instant_us, 0 AS offset_s
       FROM events""",
)
def fn_temporal(spark, d):
    """Date, time and datetime parsed from text."""
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    events = table(spark, d, "events").select("event_id", text.alias("t"))
    zoned = temporal.zoned_datetime(F.to_timestamp(F.concat("t", F.lit("Z"))), F.lit("Z"))
    clock = temporal.parse_zoned_time(F.substring("t", 12, 15))
    return events.select(
        "event_id",
        F.to_date(F.substring("t", 1, 10)).cast("string").alias("day"),
        clock["nanos"].alias("nanos"),
        F.unix_micros(zoned["ts"]).alias("instant_us"),
        clock["offset_s"].alias("offset_s"),
    )


@query(
    "fn_duration",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_linenumber::BIGINT AS days, l_quantity::BIGINT AS seconds,
              0::BIGINT AS months, 7 AS nanos FROM lineitem""",
)
def fn_duration(spark, d):
    made = temporal.duration(days=F.col("l_linenumber"), seconds=F.col("l_quantity"), nanos=7)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", made.alias("d")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "d.days", "d.seconds", "d.months", "d.nanos"
    )


@query(
    "fn_point",
    """SELECT p_partkey, 9157 AS srid, p_size::DOUBLE AS x, p_retailprice AS y, 5.0::DOUBLE AS z FROM part""",
)
def fn_point(spark, d):
    made = temporal.point(F.col("p_size"), F.col("p_retailprice"), F.lit(5))
    return table(spark, d, "part").select("p_partkey", made.alias("p")).select("p_partkey", "p.*")


@query(
    "fn_unwind",
    """SELECT doc_id, (i - 1)::INTEGER AS pos, words[i] AS word
       FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i
             FROM (SELECT doc_id, string_split(text, ' ') AS words FROM documents))""",
)
def fn_unwind(spark, d):
    return table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", " ", -1)).alias("pos", "word"))


@query(
    "fn_head_tail",
    """SELECT p_partkey, w[1] AS head, w[2] AS second, w[3] AS third, len(w)::INTEGER - 1 AS tail_size
       FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)""",
)
def fn_head_tail(spark, d):
    parts = table(spark, d, "part").select("p_partkey", F.split("p_name", " ", -1).alias("w"))
    tail = F.slice("w", 2, F.size("w"))
    return parts.select(
        "p_partkey", F.get("w", F.lit(0)).alias("head"), F.get(tail, F.lit(0)).alias("second"),
        F.get("w", F.lit(2)).alias("third"), F.size(tail).alias("tail_size"),
    )


@query(
    "fn_list_map",
    "SELECT doc_id, length(replace(text, ' ', ''))::BIGINT AS letters FROM documents",
)
def fn_list_map(spark, d):
    lengths = F.transform(F.split("text", " ", -1), lambda w: F.length(w).cast("bigint"))
    total = F.aggregate(lengths, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return table(spark, d, "documents").select("doc_id", total.alias("letters"))


@query(
    "fn_map_literal",
    "SELECT s_suppkey, s_nationkey AS nation, s_name AS name, 2 AS n_keys FROM supplier",
)
def fn_map_literal(spark, d):
    made = F.struct(
        F.create_map(F.lit("foo"), "s_nationkey", F.lit("bar"), F.lit(5)).alias("m"),
        F.struct(F.col("s_name").alias("name")).alias("inner"),
    )
    return table(spark, d, "supplier").select("s_suppkey", made.alias("x")).select(
        "s_suppkey", F.col("x.m")["foo"].alias("nation"), "x.inner.name", F.size("x.m").alias("n_keys")
    )


@query(
    "fn_nested_list",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS inner_second,
              l_orderkey || ',' || l_partkey || ',' || l_linenumber || ',' || l_suppkey AS flat FROM lineitem""",
)
def fn_nested_list(spark, d):
    whole = lambda c: F.col(c).cast("bigint")
    nested = F.array(F.array(whole("l_orderkey"), whole("l_partkey")), F.array(whole("l_linenumber"), whole("l_suppkey")))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", nested.alias("x")).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("x")[1][1].alias("inner_second"),
        F.array_join(F.flatten("x"), ",").alias("flat"),
    )
