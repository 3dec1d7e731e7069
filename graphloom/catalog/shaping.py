"""Aggregates, result shapes, order and limits, concatenation."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.catalog.registry import query
from graphloom.functions import collections as coll
from graphloom.functions import records, scalars
from graphloom.functions.cells import column_of
from graphloom.functions.decoder import decode, settle, strict
from graphloom.operators import results
from graphloom.sources.graph import order_graph
from graphloom.sources.tables import table


@query(
    "count_nodes",
    """SELECT label, n FROM (
         SELECT 'region' AS label, count(*) AS n FROM region UNION ALL SELECT 'nation', count(*) FROM nation
         UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier
         UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'order', count(*) FROM orders)""",
)
def count_nodes(spark, d):
    nodes = order_graph(spark, d).all_nodes()
    return nodes.groupBy(F.col("labels")[0].alias("label")).agg(F.count("*").alias("n"))


@query(
    "collect_group",
    """SELECT o_custkey, string_agg(p_type || ':' || n, ',' ORDER BY p_type) AS types
       FROM (SELECT o_custkey, p_type, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey
             JOIN part ON l_partkey = p_partkey GROUP BY o_custkey, p_type) GROUP BY o_custkey""",
)
def collect_group(spark, d):
    """Types of the parts each customer bought, with counts; a list is no longer than the number of types."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    parts = table(spark, d, "part").select("p_partkey", "p_type")
    bought = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    grouped = results.collect_groups(bought, ["o_custkey"], "p_type", "types")
    shown = F.transform("types", lambda e: F.concat_ws(":", e["value"], e["n"].cast("string")))
    return grouped.select("o_custkey", F.array_join(shown, ",").alias("types"))


@query("result_single", "SELECT count(*) AS n, max(o_totalprice) AS top FROM orders")
def result_single(spark, d):
    one = table(spark, d, "orders").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"))
    return results.single(one)


@query("result_list", "SELECT c_name AS name, c_acctbal::BIGINT AS whole FROM (SELECT c_name, trunc(c_acctbal) AS c_acctbal FROM customer)")
def result_list(spark, d):
    decoder = records.named({"name": ("c_name", scalars.string), "whole": ("c_acctbal", scalars.long)})
    return strict(decode(table(spark, d, "customer"), decoder)).select("value.*")


@query("result_vector", "SELECT s_suppkey AS key, s_name AS name FROM supplier")
def result_vector(spark, d):
    """Decoded by position: the first two columns of the row."""
    decoder = records.positional({"key": scalars.long, "name": scalars.string})
    return strict(decode(table(spark, d, "supplier"), decoder)).select("value.*")


@query("result_set", "SELECT DISTINCT o_orderstatus AS status, o_orderpriority AS priority FROM orders")
def result_set(spark, d):
    decoder = records.named(
        {"status": ("o_orderstatus", scalars.string), "priority": ("o_orderpriority", scalars.string)}
    )
    return results.as_set(strict(decode(table(spark, d, "orders"), decoder)).select("value.*"))


_LAST_ORDER = """SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
                        arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice
                 FROM orders GROUP BY o_custkey"""


@query("result_map", _LAST_ORDER)
def result_map(spark, d):
    """Each customer's last order; the later row of a key wins."""
    return results.as_map(
        table(spark, d, "orders"), "o_custkey", ["o_orderkey", "o_totalprice"], ["o_orderdate", "o_orderkey"]
    )


@query("result_collect_as", _LAST_ORDER)
def result_collect_as(spark, d):
    """The same map as a sorted collection."""
    return results.as_sorted_map(
        table(spark, d, "orders"), "o_custkey", ["o_orderkey", "o_totalprice"], ["o_orderdate", "o_orderkey"]
    )


@query(
    "traverse",
    """SELECT event_id, json_extract(props, '$.k')::INTEGER AS k, 'good' AS state FROM events
       WHERE event_type <> 'error'
       UNION ALL SELECT event_id, NULL, 'Couldn''t decode Str(error) into a int for field ''k''' FROM events
       WHERE event_type = 'error'""",
)
def traverse(spark, d):
    """Rows that decode and rows in quarantine; for error events the decoded field holds text."""
    events = table(spark, d, "events")
    number = F.try_variant_get(F.parse_json("props"), "$.k", "variant")
    text = F.variant_get(F.to_variant_object(F.struct(F.col("event_type").alias("t"))), "$.t", "variant")
    mixed = events.select("event_id", F.when(F.col("event_type") == "error", text).otherwise(number).alias("k"))
    settled = settle(decode(mixed, records.field("k", scalars.integer), ["event_id"]))  # one pass for both
    good = F.size("errors") == 0
    return settled.select(
        "event_id", F.when(good, F.col("value")).alias("k"),
        F.when(good, "good").otherwise(F.get("errors", F.lit(0))["message"]).alias("state"),
    )


@query(
    "order_by",
    """SELECT s_nationkey, s_acctbal, s_name FROM supplier ORDER BY s_nationkey DESC, s_acctbal DESC, s_name""",
)
def order_by(spark, d):
    return table(spark, d, "supplier").select("s_nationkey", "s_acctbal", "s_name").orderBy(
        F.desc_nulls_first("s_nationkey"), F.desc_nulls_first("s_acctbal"), F.asc_nulls_last("s_name")
    )


@query(
    "top_k",
    "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 5",
)
def top_k(spark, d):
    return table(spark, d, "customer").select("c_custkey", "c_acctbal").orderBy(
        F.desc("c_acctbal"), "c_custkey"
    ).limit(5)


@query("limit_rows", "SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 10")
def limit_rows(spark, d):
    return table(spark, d, "part").select("p_partkey", "p_name").orderBy("p_partkey").limit(10)


@query(
    "take_pad",
    """SELECT vec_id, array_to_string(list_transform(embedding, lambda x: round(x::DOUBLE * 1000000)::BIGINT), ',') ||
                ',null,null' AS padded,
              array_to_string(list_transform(embedding[1:3], lambda x: round(x::DOUBLE * 1000000)::BIGINT), ',') AS short
       FROM embeddings""",
)
def take_pad(spark, d):
    vectors = table(spark, d, "embeddings")
    cell = column_of(vectors, "embedding")
    padded, short = coll.take(66)(cell).value, coll.take(3)(cell).value
    millionths = lambda x: F.round(x.cast("double") * 1000000).cast("bigint").cast("string")
    shown = lambda xs: F.array_join(F.transform(xs, millionths), ",", "null")
    return vectors.select("vec_id", padded.alias("p"), short.alias("s")).select(
        "vec_id", shown("p").alias("padded"), shown("s").alias("short")
    )


@query(
    "sorted_collection",
    """SELECT doc_id, array_to_string(list_sort(list_distinct(string_split(lower(text), ' '))), ' ') AS words
       FROM documents""",
)
def sorted_collection(spark, d):
    """The sorted set of words of every whole text."""
    docs = table(spark, d, "documents").select("doc_id", F.split(F.lower("text"), " ", -1).alias("words"))
    words = coll.sorted_set_of(scalars.string)(column_of(docs, "words"))
    return docs.select("doc_id", F.array_join(words.value, " ").alias("words"))


@query(
    "append",
    """SELECT 'left' AS side, c_custkey AS seq, c_name AS name, c_acctbal AS acctbal FROM customer
       UNION ALL SELECT 'right', s_suppkey, s_name, s_acctbal FROM supplier""",
)
def append(spark, d):
    g = order_graph(spark, d)
    left = g.nodes("customer").select("c_custkey", F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"))
    right = g.nodes("supplier").select("s_suppkey", F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal"))
    both = results.append(left, right, F.col("c_custkey"), F.col("s_suppkey"))
    return both.select("side", "seq", "name", "acctbal").orderBy("side", "seq")
