"""Hops, paths and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.catalog.registry import query
from graphloom.operators import paths
from graphloom.operators.patterns import (
    attach_metric,
    hop,
    ids_to_props,
    lookup_pairs,
    node_value,
    rel_value,
)
from graphloom.plans.projection import degrees
from graphloom.sources.graph import order_graph
from graphloom.sources.tables import table


@query(
    "hop_any",
    """SELECT 'c:' || c_custkey AS a, 'placed' AS rel_type, 'o:' || o_orderkey AS b
       FROM customer JOIN orders ON o_custkey = c_custkey
       UNION ALL SELECT 'c:' || c_custkey, 'in_nation', 'n:' || n_nationkey
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def hop_any(spark, d):
    g = order_graph(spark, d)
    reached = g.all_nodes(g.labels_from("customer"))
    return hop(g.nodes("customer"), g.all_rels("customer"), reached).select(
        F.col("a.element_id").alias("a"), "r.rel_type", F.col("b.element_id").alias("b")
    )


@query(
    "hop_typed",
    "SELECT c_name, o_orderkey, o_totalprice FROM customer JOIN orders ON o_custkey = c_custkey",
)
def hop_typed(spark, d):
    g = order_graph(spark, d)
    return hop(g.nodes("customer"), g.rels("placed"), g.nodes("order")).select(
        "a.c_name", "b.o_orderkey", "b.o_totalprice"
    )


@query(
    "hop_path",
    """SELECT 's:' || s_suppkey AS start_id, 'in_nation' AS rel_type, 's:' || s_suppkey AS rel_src,
              'n:' || n_nationkey AS rel_dst, 'n:' || n_nationkey AS end_id,
              '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}'
              AS end_props
       FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def hop_path(spark, d):
    g = order_graph(spark, d)
    suppliers, nations, rel = g.nodes("supplier"), g.nodes("nation"), g.rels("in_nation")
    p = paths.path_value(
        node_value("a", suppliers.schema),
        [(rel_value("r", rel.schema, F.col("a.element_id"), F.col("b.element_id")), node_value("b", nations.schema))],
    )
    segment = F.col("path.segments")[0]
    return hop(suppliers, rel, nations).select(p.alias("path")).select(
        F.col("path.start.element_id").alias("start_id"),
        segment["relationship"]["rel_type"].alias("rel_type"),
        segment["relationship"]["src"].alias("rel_src"),
        segment["relationship"]["dst"].alias("rel_dst"),
        paths.path_end(F.col("path"))["element_id"].alias("end_id"),
        paths.path_end(F.col("path"))["properties"].alias("end_props"),
    )


@query(
    "path_assemble",
    """WITH p AS (SELECT *, lead(turn) OVER w AS next_turn, lead(role) OVER w AS next_role,
                         count(*) OVER (PARTITION BY conv_id) AS n
                  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
       SELECT conv_id, turn AS pos, role AS start_role, next_turn AS end_turn, next_role AS end_role
       FROM p WHERE next_turn IS NOT NULL OR n = 1""",
)
def path_assemble(spark, d):
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role")
    return paths.segments_of(turns, "conv_id", "turn").select(
        "conv_id", "pos", F.col("start.role").alias("start_role"), F.col("end.turn").alias("end_turn"),
        F.col("end.role").alias("end_role"),
    )


@query(
    "path_summary",
    """SELECT conv_id, arg_min(role, turn) AS first_role, arg_max(text, turn) AS last_text,
              count(*) - 1 AS length, count(*) FILTER (role = 'system') AS system_turns
       FROM conversations GROUP BY conv_id""",
)
def path_summary(spark, d):
    """Accessors of paths of any length: start, end, length and membership, without building the path."""
    turns = table(spark, d, "conversations")
    segments = paths.segments_of(turns, "conv_id", "turn")
    ends = paths.summarise(segments, "conv_id")
    system = paths.nodes_in_order(segments, "conv_id").groupBy("conv_id").agg(
        F.count_if(F.col("node.role") == "system").alias("system_turns")
    )
    return ends.join(system, "conv_id").select(
        "conv_id", F.col("start.role").alias("first_role"), F.col("end.text").alias("last_text"), "length",
        "system_turns",
    )


@query(
    "pair_lookup",
    """WITH pairs AS (SELECT DISTINCT c_nationkey AS k1, s_nationkey AS k2 FROM lineitem
                      JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
                      JOIN supplier ON l_suppkey = s_suppkey)
       SELECT a.n_name AS name1, b.n_name AS name2, a.n_regionkey = b.n_regionkey AS same_region
       FROM pairs JOIN nation a ON k1 = a.n_nationkey JOIN nation b ON k2 = b.n_nationkey""",
)
def pair_lookup(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("k1"))
    supplier = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("k2"))
    pairs = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("k1", "k2").distinct()
    )
    return lookup_pairs(pairs, table(spark, d, "nation"), "n_nationkey").select(
        F.col("n1.n_name").alias("name1"), F.col("n2.n_name").alias("name2"),
        (F.col("n1.n_regionkey") == F.col("n2.n_regionkey")).alias("same_region"),
    )


@query(
    "id_to_prop",
    """SELECT l_partkey, string_agg(n_name, ',' ORDER BY n_nationkey) AS names
       FROM (SELECT DISTINCT l_partkey, n_nationkey, n_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
             JOIN nation ON s_nationkey = n_nationkey) GROUP BY l_partkey""",
)
def id_to_prop(spark, d):
    """Lists of nation ids, replaced by names. A list holds distinct nations, so it is no longer than their table."""
    supplier = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    lists = (
        table(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("l_partkey").agg(F.sort_array(F.collect_set("s_nationkey")).alias("ids"))
    )
    named = ids_to_props(lists, "l_partkey", "ids", table(spark, d, "nation"), "n_nationkey", "n_name")
    return named.select("l_partkey", F.array_join("n_names", ",").alias("names"))


@query(
    "attach_metric",
    """SELECT 'p:' || p_partkey AS element_id, p_name, n AS degree FROM part LEFT JOIN
       (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey) ON l_partkey = p_partkey""",
)
def attach_metric_query(spark, d):
    g = order_graph(spark, d)
    metric = degrees(g.rels("contains").select("src", "dst"), "dst")
    return attach_metric(g.nodes("part"), metric, "vid", "id", "degree").select("element_id", "p_name", "degree")
