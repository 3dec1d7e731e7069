"""Projections, filters, predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.catalog.registry import query
from graphloom.functions import records, scalars
from graphloom.functions.cells import column_of
from graphloom.functions.decoder import decode, error_text
from graphloom.functions.params import Fragment, Name, Param, as_variant
from graphloom.functions.params import query as deferred
from graphloom.operators import paths
from graphloom.operators.patterns import extend, has_label, has_type, hop, node_value, prop, rel_value, where_props
from graphloom.sources.graph import order_graph
from graphloom.sources.tables import table


@query(
    "prop_eq_filter",
    "SELECT 'c:' || c_custkey AS element_id, c_name FROM customer WHERE c_mktsegment = 'BUILDING'",
)
def prop_eq_filter(spark, d):
    customers = order_graph(spark, d).nodes("customer")
    return where_props(customers, c_mktsegment="BUILDING").select("element_id", "c_name")


@query("contains_filter", "SELECT doc_id, lang FROM documents WHERE contains(lower(text), 'the')")
def contains_filter(spark, d):
    return table(spark, d, "documents").where(F.lower("text").contains("the")).select("doc_id", "lang")


@query(
    "fragment_compose",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE (o_totalprice > 100000 AND o_orderstatus = 'F') OR (o_orderpriority = '1-URGENT')""",
)
def fragment_compose(spark, d):
    dear = Fragment("o_totalprice > ", Param(100000.0)) & Fragment("o_orderstatus = ", Param("F"))
    urgent = Fragment("o_orderpriority = ", Param("1-URGENT"))
    q = deferred(Fragment("SELECT o_orderkey, o_totalprice FROM {orders} WHERE ", dear | urgent))
    return q.run(spark, orders=table(spark, d, "orders"))


@query(
    "bind_params",
    """SELECT o_orderkey, o_orderpriority FROM orders
       WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice < 50000""",
)
def bind_params(spark, d):
    q = deferred(
        "SELECT o_orderkey, o_orderpriority FROM {orders} "
        "WHERE array_contains(:priorities, o_orderpriority) AND o_totalprice < :top"
    ).with_params(priorities=["1-URGENT", "2-HIGH"], top=1.0)
    return q.with_params(top=50000.0).run(spark, orders=table(spark, d, "orders"))


@query("dynamic_ident", "SELECT p_brand AS value, count(*) AS n FROM part GROUP BY p_brand")
def dynamic_ident(spark, d):
    column = Name("p_brand")
    q = deferred(Fragment("SELECT ", column, " AS value, count(*) AS n FROM {part} GROUP BY ", column))
    return q.run(spark, part=table(spark, d, "part"))


@query("project_props", "SELECT s_name, s_acctbal FROM supplier")
def project_props(spark, d):
    return order_graph(spark, d).nodes("supplier").select("s_name", "s_acctbal")


@query(
    "rename_fields",
    "SELECT c_name AS person_name, c_nationkey AS home FROM customer",
)
def rename_fields(spark, d):
    decoder = records.named({"person_name": ("c_name", scalars.string), "home": ("c_nationkey", scalars.integer)})
    return decode(table(spark, d, "customer"), decoder).select("value.*")


@query("element_id", "SELECT 'o:' || o_orderkey AS element_id, o_totalprice FROM orders")
def element_id(spark, d):
    return order_graph(spark, d).nodes("order").select("element_id", "o_totalprice")


@query(
    "prop_get",
    "SELECT c_custkey, c_name AS name, NULL::VARCHAR AS missing, NULL::VARCHAR AS no_column FROM customer",
)
def prop_get(spark, d):
    customer = table(spark, d, "customer")
    props = F.create_map(F.lit("name"), "c_name", F.lit("segment"), "c_mktsegment").alias("props")
    held = customer.select("c_custkey", props)
    cell = column_of(held, "props")
    return held.select(
        "c_custkey",
        cell.field("name").col.alias("name"),
        cell.field("missing").col.alias("missing"),
        prop(customer, "c_phone").alias("no_column"),
    )


@query(
    "prop_get_as",
    """SELECT event_id, json_extract(props, '$.k')::INTEGER AS k,
              'Couldn''t decode Integer(' || json_extract(props, '$.k') || ') into a String for field ''k''' AS bad_kind,
              'Multiple decoding errors:' || chr(10) || 'Couldn''t decode NullValue into a int' || chr(10) ||
              'Field ''z'' not found' || chr(10) AS absent
       FROM events""",
)
def prop_get_as(spark, d):
    events = table(spark, d, "events").select("event_id", F.parse_json("props").alias("v"))
    props = column_of(events, "v")
    k = records.field("k", scalars.integer)(props)
    text = records.field("k", scalars.string)(props)
    z = records.field("z", scalars.integer)(props)
    read = events.select("event_id", k.value.alias("k"), text.errors.alias("text"), z.errors.alias("z"))
    return read.select(
        "event_id", "k", error_text(F.col("text")).alias("bad_kind"), error_text(F.col("z")).alias("absent")
    )


@query("prop_keys", "SELECT s_suppkey, 's_acctbal,s_name,s_nationkey' AS keys FROM supplier")
def prop_keys(spark, d):
    held = _supplier_props(spark, d)
    return held.select("s_suppkey", F.array_join(F.sort_array(F.map_keys("props")), ",").alias("keys"))


@query(
    "prop_values",
    "SELECT s_suppkey, s_name || ',' || s_nationkey || ',' || s_acctbal AS vals FROM supplier",
)
def prop_values(spark, d):
    held = _supplier_props(spark, d)
    texts = F.transform(F.map_values("props"), lambda v: F.variant_get(v, "$", "string"))
    return held.select("s_suppkey", F.array_join(texts, ",").alias("vals"))


def _supplier_props(spark, d):
    supplier = table(spark, d, "supplier")
    entries = [x for c in ("s_name", "s_nationkey", "s_acctbal") for x in (F.lit(c), as_variant(F.col(c)))]
    return supplier.select("s_suppkey", F.create_map(*entries).alias("props"))


@query(
    "has_label",
    """SELECT 'c:' || c_custkey AS element_id, true AS customer, false AS untrimmed, false AS part FROM customer
       UNION ALL SELECT 's:' || s_suppkey, false, false, false FROM supplier
       UNION ALL SELECT 'p:' || p_partkey, false, false, true FROM part
       UNION ALL SELECT 'o:' || o_orderkey, false, false, false FROM orders
       UNION ALL SELECT 'n:' || n_nationkey, false, false, false FROM nation
       UNION ALL SELECT 'r:' || r_regionkey, false, false, false FROM region""",
)
def has_label_query(spark, d):
    labels = F.col("labels")
    return order_graph(spark, d).all_nodes().select(
        "element_id",
        has_label(labels, "Customer").alias("customer"),
        has_label(labels, " customer").alias("untrimmed"),
        has_label(labels, "PART").alias("part"),
    )


@query(
    "has_type",
    """SELECT 'placed' AS rel_type, true AS placed, count(*) AS n FROM orders
       UNION ALL SELECT 'contains', false, count(*) FROM lineitem
       UNION ALL SELECT 'supplied_by', false, count(*) FROM lineitem
       UNION ALL SELECT 'filled_by', false, count(*) FROM lineitem
       UNION ALL SELECT 'in_nation', false, (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier)
       UNION ALL SELECT 'in_region', false, count(*) FROM nation""",
)
def has_type_query(spark, d):
    rels = order_graph(spark, d).all_rels()
    return rels.groupBy("rel_type", has_type(F.col("rel_type"), "Placed").alias("placed")).agg(
        F.count("*").alias("n")
    )


def _order_paths(spark, d):
    """customer -placed-> order -contains-> part: the matches, and their paths as an expression."""
    g = order_graph(spark, d)
    customers, orders, parts = g.nodes("customer"), g.nodes("order"), g.nodes("part")
    placed, contains = g.rels("placed"), g.rels("contains")
    pattern = extend(hop(customers, placed, orders, ("c", "r1", "o")), "o", contains, parts, ("r2", "p"))
    c, o, p = (node_value(a, n.schema) for a, n in (("c", customers), ("o", orders), ("p", parts)))
    r1 = rel_value("r1", placed.schema, F.col("c.element_id"), F.col("o.element_id"))
    r2 = rel_value("r2", contains.schema, F.col("o.element_id"), F.col("p.element_id"))
    return pattern, paths.path_value(c, [(r1, o), (r2, p)])


@query(
    "path_accessors",
    """SELECT 'c:' || o_custkey AS start_id, 'p:' || l_partkey AS end_id, 'o:' || o_orderkey AS middle_id,
              3 AS n_nodes, 'placed,contains' AS rel_types, 2 AS n_segments
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN part ON l_partkey = p_partkey""",
)
def path_accessors(spark, d):
    pattern, p = _order_paths(spark, d)
    nodes = paths.path_nodes(p, "element_id")
    return pattern.select(
        paths.path_start(p)["element_id"].alias("start_id"),
        paths.path_end(p, "element_id").alias("end_id"),
        nodes[1].alias("middle_id"),
        F.size(nodes).alias("n_nodes"),
        F.array_join(paths.path_relationships(p, "rel_type"), ",").alias("rel_types"),
        paths.path_length(p).alias("n_segments"),
    )


@query(
    "path_contains",
    """SELECT c_custkey, r_name = 'ASIA' AS has_asia, false AS has_other_asia, n_nationkey = 7 AS has_rel
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def path_contains(spark, d):
    """Membership is by value: a node with the same id and other properties is not in the path."""
    g = order_graph(spark, d)
    customers, nations, regions = g.nodes("customer"), g.nodes("nation"), g.nodes("region")
    lives, within = g.rels("in_nation"), g.rels("in_region")
    pattern = extend(hop(customers, lives, nations, ("c", "r1", "n")), "n", within, regions, ("r2", "r"))
    c, n, r = (node_value(a, t.schema) for a, t in (("c", customers), ("n", nations), ("r", regions)))
    r1 = rel_value("r1", lives.schema, F.col("c.element_id"), F.col("n.element_id"))
    r2 = rel_value("r2", within.schema, F.col("n.element_id"), F.col("r.element_id"))
    path = paths.path_value(c, [(r1, n), (r2, r)])

    def region(props: str):
        return F.struct(F.lit("r:2").alias("element_id"), F.array(F.lit("region")).alias("labels"),
                        F.lit(props).alias("properties"))

    wanted = F.struct(F.lit("in_region:7").alias("element_id"), F.lit("in_region").alias("rel_type"),
                      F.lit("{}").alias("properties"), F.lit("n:7").alias("src"),
                      F.concat(F.lit("r:"), F.col("region_key")).alias("dst"))
    return pattern.select(F.col("c.c_custkey").alias("c_custkey"), path.alias("path"),
                          F.col("n.n_regionkey").alias("region_key")).select(
        "c_custkey",
        paths.path_contains_node(F.col("path"), region('{"r_regionkey":2,"r_name":"ASIA"}')).alias("has_asia"),
        paths.path_contains_node(F.col("path"), region('{"r_regionkey":2,"r_name":"Asia"}')).alias("has_other_asia"),
        paths.path_contains_rel(F.col("path"), wanted).alias("has_rel"),
    )


@query(
    "collect_pf",
    "SELECT event_id, value * 2 AS doubled FROM events WHERE event_type = 'purchase'",
)
def collect_pf(spark, d):
    return table(spark, d, "events").where("event_type = 'purchase'").select(
        "event_id", (F.col("value") * 2).alias("doubled")
    )


@query(
    "literal_rows",
    """SELECT n_nationkey, 5 AS i, true AS b, 0 AS l0, 10 AS l1, 3.5::DOUBLE AS f, NULL::INTEGER AS nothing,
              3 AS foo FROM nation""",
)
def literal_rows(spark, d):
    row = [F.lit(5).alias("i"), F.lit(True).alias("b"), F.array(F.lit(0), F.lit(10)).alias("l"),
           F.lit(3.5).alias("f"), F.lit(None).cast("int").alias("nothing"),
           F.create_map(F.lit("foo"), F.lit(3), F.lit("bar"), F.lit(5)).alias("m")]
    return table(spark, d, "nation").select("n_nationkey", *row).select(
        "n_nationkey", "i", "b", F.col("l")[0].alias("l0"), F.col("l")[1].alias("l1"), "f", "nothing",
        F.col("m")["foo"].alias("foo"),
    )
