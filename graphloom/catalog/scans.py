"""Scans, sources, sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.catalog.registry import query
from graphloom.functions.cells import variant_kind
from graphloom.functions.params import as_variant, mixed_list
from graphloom.operators import results, writes
from graphloom.operators.patterns import hop
from graphloom.operators.store import Conflict, Store
from graphloom.session import scratch_path
from graphloom.sources.graph import element_id, order_graph
from graphloom.sources.tables import table


@query(
    "scan_nodes",
    "SELECT 'c:' || c_custkey AS element_id, 'customer' AS label, c_name, c_mktsegment FROM customer",
)
def scan_nodes(spark, d):
    return order_graph(spark, d).nodes("Customer").select(
        "element_id", F.col("labels")[0].alias("label"), "c_name", "c_mktsegment"
    )


@query(
    "scan_rels",
    """SELECT 'placed:' || o_orderkey AS element_id, 'placed' AS rel_type,
              o_custkey * 8 + 2 AS src, o_orderkey * 8 + 5 AS dst FROM orders""",
)
def scan_rels(spark, d):
    return order_graph(spark, d).rels("PLACED").select("element_id", "rel_type", "src", "dst")


@query(
    "record_to_map",
    """SELECT s_suppkey, 0 AS pos, 's_suppkey' AS key, 'integer' AS kind, s_suppkey::VARCHAR AS value FROM supplier
       UNION ALL SELECT s_suppkey, 1, 's_name', 'string', s_name FROM supplier
       UNION ALL SELECT s_suppkey, 2, 's_nationkey', 'integer', s_nationkey::VARCHAR FROM supplier
       UNION ALL SELECT s_suppkey, 3, 's_acctbal', 'decimal', s_acctbal::VARCHAR FROM supplier""",
)
def record_to_map(spark, d):
    supplier = table(spark, d, "supplier")
    entries = [x for c in supplier.columns for x in (F.lit(c), as_variant(F.col(c)))]
    record = supplier.select("s_suppkey", F.create_map(*entries).alias("record"))
    return record.select("s_suppkey", F.posexplode(F.map_entries("record")).alias("pos", "e")).select(
        "s_suppkey",
        "pos",
        F.col("e.key").alias("key"),
        variant_kind(F.col("e.value")).alias("kind"),
        F.variant_get("e.value", "$", "string").alias("value"),
    )


@query(
    "parse_value",
    """WITH k AS (
         SELECT CASE json_type(props) WHEN 'OBJECT' THEN 'map' ELSE '?' END AS k0,
                CASE json_type(props, '$.k') WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer'
                     ELSE 'null' END AS k1,
                CASE WHEN value IS NULL THEN 'null' ELSE 'decimal' END AS k2,
                CASE WHEN event_type IS NULL THEN 'null' ELSE 'string' END AS k3,
                CASE WHEN user_id IS NULL THEN 'null' ELSE 'boolean' END AS k4,
                CASE json_type(props, '$.z') WHEN 'UBIGINT' THEN 'integer' ELSE 'null' END AS k5,
                CASE WHEN ts IS NULL THEN 'null' ELSE 'local_datetime' END AS k6
         FROM events),
       u AS (SELECT 0 AS pos, k0 AS kind FROM k UNION ALL SELECT 1, k1 FROM k UNION ALL SELECT 2, k2 FROM k
             UNION ALL SELECT 3, k3 FROM k UNION ALL SELECT 4, k4 FROM k UNION ALL SELECT 5, k5 FROM k
             UNION ALL SELECT 6, k6 FROM k UNION ALL SELECT 7, 'list' FROM k)
       SELECT pos, kind, count(*) AS n FROM u GROUP BY pos, kind""",
)
def parse_value(spark, d):
    """Kinds of a heterogeneous list built from every event."""
    events = table(spark, d, "events").withColumn("v", F.parse_json("props"))
    values = mixed_list(
        [
            F.col("v"),
            F.try_variant_get("v", "$.k", "variant"),
            F.col("value"),
            F.col("event_type"),
            F.col("user_id") > 50,
            F.try_variant_get("v", "$.z", "variant"),
            F.col("ts"),
            F.array("user_id", "event_id"),
        ]
    )
    each = events.select(F.posexplode(values).alias("pos", "x"))
    return each.groupBy("pos", variant_kind(F.col("x")).alias("kind")).agg(F.count("*").alias("n"))


def written_back(spark, df: DataFrame, name: str) -> DataFrame:
    """Write and read back."""
    path = scratch_path(spark, name)
    df.write.mode("append").parquet(path)
    return spark.read.parquet(path)


@query(
    "bulk_create_nodes",
    """SELECT 'e:' || vec_id || ':' || (i - 1) AS element_id, 'node' AS label, vec_id, (i - 1)::INTEGER AS pos,
              round(embedding[i]::DOUBLE, 6) AS data
       FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""",
)
def bulk_create_nodes(spark, d):
    nodes = writes.create_from_list(
        table(spark, d, "embeddings"), "embedding", "Node", "data",
        lambda key, pos: F.concat(F.lit("e:"), key, F.lit(":"), pos), "vec_id",
    )
    return written_back(spark, nodes, "bulk").select(
        "element_id", F.col("labels")[0].alias("label"), "vec_id", "pos",
        F.round(F.col("data").cast("double"), 6).alias("data"),
    )


@query(
    "create_from_map",
    """SELECT 'd:' || c_custkey AS element_id, 'data' AS label, c_name AS name, c_mktsegment AS segment,
              NULL::VARCHAR AS absent FROM customer""",
)
def create_from_map(spark, d):
    props = F.create_map(F.lit("name"), "c_name", F.lit("segment"), "c_mktsegment").alias("props")
    nodes = writes.create_from_map(
        table(spark, d, "customer").select("c_custkey", props), "props", ["name", "segment", "absent"], "Data",
        F.concat(F.lit("d:"), F.col("c_custkey")),
    )
    return written_back(spark, nodes, "from-map").select(
        "element_id", F.col("labels")[0].alias("label"), "name", "segment", "absent"
    )


@query(
    "create_from_record",
    "SELECT 'p:' || p_partkey AS element_id, 'part' AS label, p_name, p_size, p_retailprice FROM part",
)
def create_from_record(spark, d):
    rec = F.struct("p_name", "p_size", "p_retailprice").alias("rec")
    nodes = writes.create_from_record(
        table(spark, d, "part").select("p_partkey", rec), "rec", " Part ", element_id("part", "p_partkey")
    )
    return written_back(spark, nodes, "from-record").select(
        "element_id", F.col("labels")[0].alias("label"), "p_name", "p_size", "p_retailprice"
    )


@query(
    "create_rels",
    """SELECT 'lives_in:' || c_custkey AS element_id, 'lives_in' AS rel_type, 'c:' || c_custkey AS src,
              'n:' || n_nationkey AS dst, c_mktsegment
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def create_rels(spark, d):
    g = order_graph(spark, d)
    rels = writes.create_rels(
        table(spark, d, "customer"), "LIVES_IN", g.nodes("customer"), g.nodes("nation"),
        ("c_custkey", "c_custkey"), ("c_nationkey", "n_nationkey"),
        F.concat(F.lit("lives_in:"), F.col("c_custkey")), "c_mktsegment",
    )
    return written_back(spark, rels, "rels")


@query(
    "detach_delete",
    """WITH gone AS (SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey
                     WHERE n_name = 'NATION_3')
       SELECT 'node' AS what, 'c:' || c_custkey AS element_id FROM customer c
       WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.c_custkey = c.c_custkey)
       UNION ALL
       SELECT 'relationship', 'placed:' || o_orderkey FROM orders o
       WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.c_custkey = o.o_custkey)""",
)
def detach_delete(spark, d):
    g = order_graph(spark, d)
    customers = g.nodes("customer")
    nation = g.nodes("nation").where("n_name = 'NATION_3'")
    doomed = customers.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(customers["vid"])
    nodes, rels = writes.detach_delete(customers, g.rels("placed"), doomed)
    return nodes.select(F.lit("node").alias("what"), "element_id").unionAll(
        rels.select(F.lit("relationship").alias("what"), "element_id")
    )


@query(
    "execute_void",
    "SELECT count(*) AS n, max(p_partkey) AS last_key, max(p_brand) AS last_brand FROM part",
)
def execute_void(spark, d):
    """Nothing comes back from the run itself; what it went through is observed in it."""
    parts = table(spark, d, "part")
    nodes = writes.create_nodes(parts, "Part", element_id("part", "p_partkey"), "p_partkey", "p_brand")
    rows, seen = results.with_summary(
        nodes, "void", n=F.count(F.lit(1)), last_key=F.max("p_partkey"), last_brand=F.max("p_brand")
    )
    results.void(rows)
    got = seen.get
    return spark.createDataFrame(
        [(got["n"], got["last_key"], got["last_brand"])], "n bigint, last_key bigint, last_brand string"
    )


@query(
    "write_summary",
    "SELECT 'CREATE (: Order)' AS query, count(*) AS nodes_created FROM orders",
)
def write_summary(spark, d):
    nodes = writes.create_nodes(table(spark, d, "orders"), "Order", element_id("order", "o_orderkey"), "o_totalprice")
    summary = writes.write_with_summary(nodes, scratch_path(spark, "summary"), "CREATE (: Order)")
    return spark.createDataFrame([(summary.query, summary.counters["nodes_created"])],
                                 "query string, nodes_created bigint")


@query(
    "result_with_summary",
    """SELECT event_type, count(*) AS n, (SELECT count(*) FROM events) AS records,
              (SELECT max(event_id) FROM events) AS last_id
       FROM events GROUP BY event_type""",
)
def result_with_summary(spark, d):
    """Rows and their summary from one pass; both are put side by side here."""
    rows, summary = results.with_summary(
        table(spark, d, "events").select("event_id", "event_type"), "records",
        records=F.count(F.lit(1)), last_id=F.max("event_id"),
    )
    path = scratch_path(spark, "with-summary")
    rows.write.parquet(path)
    seen = summary.get
    return spark.read.parquet(path).groupBy("event_type").agg(
        F.count("*").alias("n"), F.lit(seen["records"]).alias("records"), F.lit(seen["last_id"]).alias("last_id")
    )


@query(
    "atomic_publish",
    """SELECT 'customer' AS name, c_custkey AS key FROM customer
       UNION ALL SELECT 'supplier', s_suppkey FROM supplier""",
)
def atomic_publish(spark, d):
    """Two tables become visible together; a later unit that fails half way changes nothing."""
    root = scratch_path(spark, "publish")
    customer, supplier = table(spark, d, "customer"), table(spark, d, "supplier")
    with writes.transact(spark, root) as unit:
        unit.write("customer", customer)
        unit.write("supplier", supplier)
    try:
        with writes.transact(spark, root) as unit:
            unit.write("customer", customer.withColumn("c_custkey", -F.col("c_custkey")))
            raise RuntimeError("stopped before the second table")
    except RuntimeError:
        pass
    tables = writes.snapshot(spark, root)
    return reduce(
        DataFrame.unionAll,
        [
            tables["customer"].select(F.lit("customer").alias("name"), F.col("c_custkey").alias("key")),
            tables["supplier"].select(F.lit("supplier").alias("name"), F.col("s_suppkey").alias("key")),
        ],
    )


@query(
    "graph_reopen",
    """SELECT s_name, 's:' || s_suppkey AS element_id, n_name AS nation FROM supplier JOIN nation ON s_nationkey = n_nationkey
       WHERE s_acctbal > 0""",
)
def graph_reopen(spark, d):
    """Create, publish, open again and match: suppliers in credit have a second label."""
    root = scratch_path(spark, "graph")
    supplier, nation = table(spark, d, "supplier"), table(spark, d, "nation")
    suppliers = writes.create_nodes(supplier, "Supplier", element_id("supplier", "s_suppkey"), "s_suppkey", "s_name", "s_acctbal")
    both = F.concat("labels", F.array(F.lit(" Creditor ")))
    suppliers = suppliers.withColumn("labels", F.when(F.col("s_acctbal") > 0, both).otherwise(F.col("labels")))
    nations = writes.create_nodes(nation, "Nation", element_id("nation", "n_nationkey"), "n_nationkey", "n_name")
    lives = writes.create_rels(
        supplier, "IN_NATION", suppliers, nations, ("s_suppkey", "s_suppkey"), ("s_nationkey", "n_nationkey"),
        F.concat(F.lit("in_nation:"), F.col("s_suppkey").cast("string")),
    )
    writes.publish_graph(spark, root, {"suppliers": suppliers, "nations": nations}, {"IN_NATION": lives})
    g = writes.open_graph(spark, root)
    if g.all_nodes().count() != suppliers.count() + nations.count():
        raise AssertionError("a node of two labels is there twice")
    matched = hop(g.nodes("creditor"), g.rels("in_nation"), g.nodes("NATION"))
    return matched.select("a.s_name", "a.element_id", F.col("b.n_name").alias("nation"))


def _published_orders(spark, d, name):
    """Customers (those in credit have a second label), nations and orders' relationships in a new store."""
    store = Store(spark, scratch_path(spark, name))
    customer, nation = table(spark, d, "customer"), table(spark, d, "nation")
    people = writes.create_nodes(customer, "Customer", element_id("customer", "c_custkey"), "c_custkey", "c_name", "c_nationkey", "c_acctbal")
    credit = F.concat("labels", F.array(F.lit(" Creditor ")))
    people = people.withColumn("labels", F.when(F.col("c_acctbal") > 0, credit).otherwise(F.col("labels")))
    nations = writes.create_nodes(nation, "Nation", element_id("nation", "n_nationkey"), "n_nationkey", "n_name")
    orders = table(spark, d, "orders")
    orders_of = writes.create_nodes(orders, "Order", element_id("order", "o_orderkey"), "o_orderkey")
    placed = orders.select(
        F.concat(F.lit("placed:"), F.col("o_orderkey")).alias("element_id"), F.lit("PLACED").alias("rel_type"),
        element_id("customer", "o_custkey").alias("src"), element_id("order", "o_orderkey").alias("dst"),
    )
    with store.unit() as unit:
        for nodes in (people, nations, orders_of):
            unit.add_nodes(nodes)
        unit.add_rels(placed)
    return store


@query(
    "scan_published_label",
    """SELECT 'c:' || c_custkey AS element_id, c_name, '&creditor&customer&' AS label_set FROM customer WHERE c_acctbal > 0""",
)
def scan_published_label(spark, d):
    """Nodes of one label of a published graph: the partitions of the label sets that hold it."""
    return _published_orders(spark, d, "labels").snapshot().nodes("CREDITOR").select("element_id", "c_name", "label_set")


@query(
    "detach_delete_published",
    """WITH gone AS (SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name = 'NATION_3'),
            placed AS (SELECT 'placed:' || o_orderkey AS element_id, o_custkey IN (SELECT c_custkey FROM gone) AS cut FROM orders),
            nodes AS (SELECT 'c:' || c_custkey AS element_id, c_custkey IN (SELECT c_custkey FROM gone) AS cut FROM customer)
       SELECT 1 AS version, 'node' AS what, element_id FROM nodes UNION ALL SELECT 2, 'node', element_id FROM nodes WHERE NOT cut
       UNION ALL SELECT 1, 'relationship', element_id FROM placed
       UNION ALL SELECT 2, 'relationship', element_id FROM placed WHERE NOT cut""",
)
def detach_delete_published(spark, d):
    """Customers of a nation are deleted: the next version lacks them and their orders' edges, the older has them."""
    store = _published_orders(spark, d, "deletes")
    with store.unit() as unit:
        g = unit.read()
        nation = g.nodes("nation").where("n_name = 'NATION_3'").select(F.col("n_nationkey").alias("k"))
        unit.delete(g.nodes("customer").join(nation, F.col("c_nationkey") == F.col("k")).select("element_id"))
    parts = []
    for number in (1, 2):
        g = store.snapshot(number)
        for what, rows in (("node", g.nodes("customer")), ("relationship", g.rels("placed"))):
            parts.append(rows.select(F.lit(number).alias("version"), F.lit(what).alias("what"), "element_id"))
    return reduce(DataFrame.unionAll, parts)


@query(
    "publish_conflict",
    """WITH kept AS (SELECT 'c:' || c_custkey AS element_id FROM customer WHERE c_nationkey <> 3
                     UNION ALL SELECT 'n:' || n_nationkey FROM nation UNION ALL SELECT 'o:' || o_orderkey FROM orders
                     UNION ALL SELECT 's:' || s_suppkey FROM supplier UNION ALL SELECT 'p:' || p_partkey FROM part)
       SELECT element_id, 4 AS versions, 'second' AS gave_up FROM kept""",
)
def publish_conflict(spark, d):
    """Two units delete customers, each unseen by the other: the one that publishes second gives up and is not seen.

    Two units that only add nodes meet as well: both are published, one after the other.
    """
    store, gave_up = _published_orders(spark, d, "conflict"), "none"
    try:
        with store.unit() as second:
            second.delete(second.read().nodes("customer").where("c_nationkey = 4"))
            with store.unit() as first:
                first.delete(first.read().nodes("customer").where("c_nationkey = 3"))
    except Conflict:
        gave_up = "second"
    suppliers = writes.create_nodes(table(spark, d, "supplier"), "Supplier", element_id("supplier", "s_suppkey"), "s_name")
    parts = writes.create_nodes(table(spark, d, "part"), "Part", element_id("part", "p_partkey"), "p_name")
    with store.unit() as slow:
        slow.add_nodes(suppliers)
        with store.unit() as fast:
            fast.add_nodes(parts)
    rows = store.snapshot().every_node().select("element_id")
    return rows.select("element_id", F.lit(len(store.versions())).alias("versions"), F.lit(gave_up).alias("gave_up"))
