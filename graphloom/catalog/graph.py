"""Graph projections and algorithms on the order graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.catalog.registry import query
from graphloom.plans import colour_triangles, delta_stepping, residual_rank
from graphloom.plans.article_rank import article_rank
from graphloom.plans.projection import both_directions, project
from graphloom.plans.shortest_path import distances, path_to
from graphloom.plans.similarity import adamic_adar, jaccard
from graphloom.plans.triangles import global_triangles, local_clustering, triangle_count
from graphloom.session import written
from graphloom.sources.graph import order_graph, vertex_id
from graphloom.sources.tables import table

# Part-supplier pairs, both ways; a vertex id is key * 8 + 4 for a part and key * 8 + 3 for a supplier.
_SUPPLY = """pairs AS MATERIALIZED (SELECT l_partkey * 8 + 4 AS p, l_suppkey * 8 + 3 AS s,
                    min(l_quantity) AS weight FROM lineitem GROUP BY 1, 2),
     e AS MATERIALIZED (SELECT p AS src, s AS dst, weight FROM pairs UNION ALL SELECT s, p, weight FROM pairs),
     v AS MATERIALIZED (SELECT p_partkey * 8 + 4 AS id FROM part UNION ALL SELECT s_suppkey * 8 + 3 FROM supplier)"""


def _supply(spark, d, weight=None):
    return project(order_graph(spark, d), ["part", "supplier"], ["supplied_by"], "undirected", weight)


@query("project_graph", f"WITH {_SUPPLY} SELECT src, dst, weight FROM e")
def project_graph(spark, d):
    return _supply(spark, d, "l_quantity").edges


@query(
    "project_natural",
    """SELECT DISTINCT o_custkey * 8 + 2 AS src, o_orderkey * 8 + 5 AS dst FROM orders
       UNION ALL SELECT DISTINCT l_orderkey * 8 + 5, l_partkey * 8 + 4 FROM lineitem""",
)
def project_natural(spark, d):
    """Directed edges of two types, each pair once."""
    return project(order_graph(spark, d), ["customer", "order", "part"], ["placed", "contains"]).edges


def _rank_sql(rounds: int, tail: str) -> str:
    ctes = [
        f"WITH {_SUPPLY}",
        """o AS MATERIALIZED (SELECT v.id, count(e.src) AS out_deg,
             (SELECT count(*) FROM e) * 1.0 / (SELECT count(*) FROM v) AS avg_out
             FROM v LEFT JOIN e ON e.src = v.id GROUP BY v.id)""",
        "r0 AS MATERIALIZED (SELECT id, 0.15::DOUBLE AS r FROM v)",
    ]
    for i in range(1, rounds + 1):
        ctes.append(
            f"""r{i} AS MATERIALIZED (SELECT v.id, 0.15 + 0.85 * coalesce(sum(q.r / (o.out_deg + o.avg_out)), 0) AS r
                 FROM v LEFT JOIN e ON e.dst = v.id LEFT JOIN r{i - 1} q ON q.id = e.src LEFT JOIN o ON o.id = e.src
                 GROUP BY v.id)"""
        )
    ctes.append(f"s AS MATERIALIZED (SELECT id, r / (SELECT sum(r) FROM r{rounds}) AS score FROM r{rounds})")
    return ", ".join(ctes[:1]) + ", " + ", ".join(ctes[1:]) + " " + tail


@query("article_rank", _rank_sql(20, "SELECT id, round(score, 9) AS score FROM s"))
def article_rank_all(spark, d):
    """Every vertex after exactly 20 rounds."""
    ranks = article_rank(_supply(spark, d), max_iterations=20, tolerance=0.0)
    return ranks.select("id", F.round("score", 9).alias("score"))


@query(
    "article_rank_top",
    _rank_sql(
        20,
        """SELECT CASE id % 8 WHEN 4 THEN 'p:' ELSE 's:' END || (id // 8) AS element_id,
                  round(100000 * score)::BIGINT AS score FROM s ORDER BY round(s.score, 12) DESC, id LIMIT 5""",
    ),
)
def article_rank_top(spark, d):
    """The five highest ranked, stopping as soon as no rank moves by 1e-7.

    Scores that differ only by the order of summation are ties, and the lower id goes first.
    """
    ranks = article_rank(_supply(spark, d), 20, 0.85, 1e-7, "L1Norm")
    return (
        ranks.orderBy(F.desc(F.round("score", 12)), "id").limit(5)
        .select(_element(F.col("id")).alias("element_id"), F.round(F.col("score") * 100000).cast("bigint").alias("score"))
    )


@query("article_rank_push", _rank_sql(24, "SELECT id, round(score, 7) AS score FROM s"))
def article_rank_push(spark, d):
    """Every vertex, converged: after 24 rounds the SQL's scores have settled in the digits shown."""
    ranks = residual_rank.article_rank(_supply(spark, d), tolerance=1e-8)
    return ranks.select("id", F.round("score", 7).alias("score"))


def _element(vid):
    prefix = F.when(F.pmod(vid, F.lit(8)) == 4, "p:").otherwise("s:")
    return F.concat(prefix, F.shiftright(vid, 3).cast("string"))


# Orders, parts and suppliers: every triangle has one of each.
_TRADE = """op AS MATERIALIZED (SELECT DISTINCT l_orderkey * 8 + 5 AS o, l_partkey * 8 + 4 AS p FROM lineitem),
     os AS MATERIALIZED (SELECT DISTINCT l_orderkey * 8 + 5 AS o, l_suppkey * 8 + 3 AS s FROM lineitem),
     ps AS MATERIALIZED (SELECT DISTINCT l_partkey * 8 + 4 AS p, l_suppkey * 8 + 3 AS s FROM lineitem),
     v AS MATERIALIZED (SELECT o_orderkey * 8 + 5 AS id FROM orders UNION ALL SELECT p_partkey * 8 + 4 FROM part
           UNION ALL SELECT s_suppkey * 8 + 3 FROM supplier),
     t AS MATERIALIZED (SELECT op.o, op.p, os.s FROM op JOIN os ON op.o = os.o JOIN ps ON ps.p = op.p AND ps.s = os.s),
     c AS MATERIALIZED (SELECT id, count(*) AS n FROM (SELECT o AS id FROM t UNION ALL SELECT p FROM t
           UNION ALL SELECT s FROM t) GROUP BY id),
     deg AS MATERIALIZED (SELECT id, count(*) AS n FROM (
           SELECT o AS id FROM op UNION ALL SELECT p FROM op UNION ALL SELECT o FROM os UNION ALL SELECT s FROM os
           UNION ALL SELECT p FROM ps UNION ALL SELECT s FROM ps) GROUP BY id)"""


def _trade(spark, d):
    return project(
        order_graph(spark, d), ["order", "part", "supplier"], ["contains", "supplied_by", "filled_by"], "undirected"
    )


@query(
    "triangle_count",
    f"WITH {_TRADE} SELECT v.id, coalesce(c.n, 0) AS triangles FROM v LEFT JOIN c ON c.id = v.id",
)
def triangle_count_all(spark, d):
    return triangle_count(_trade(spark, d))


@query(
    "triangle_count_colours",
    f"WITH {_TRADE} SELECT v.id, coalesce(c.n, 0) AS triangles FROM v LEFT JOIN c ON c.id = v.id",
)
def triangle_count_colours(spark, d):
    """The same by colours of vertices: edges are dealt to tasks as pairs of numbers, no list of neighbours moves."""
    return colour_triangles.triangle_count(_trade(spark, d))


@query("global_sum_metric", f"WITH {_TRADE} SELECT count(*) AS triangles FROM t")
def global_sum_metric(spark, d):
    """The sum over the vertices, a third of it; edges move packed as for ``triangle_count``."""
    return global_triangles(triangle_count(_trade(spark, d)))


@query(
    "local_clustering",
    f"""WITH {_TRADE} SELECT v.id, coalesce(c.n, 0) AS triangles, coalesce(deg.n, 0) AS degree,
           CASE WHEN coalesce(deg.n, 0) < 2 THEN 0 ELSE round(2.0 * coalesce(c.n, 0) / (deg.n * (deg.n - 1)), 9) END
             AS coefficient
         FROM v LEFT JOIN c ON c.id = v.id LEFT JOIN deg ON deg.id = v.id""",
)
def local_clustering_all(spark, d):
    """Triangles and degrees of the same packed edges, which are made once."""
    got = local_clustering(_trade(spark, d))
    return got.select("id", "triangles", "degree", F.round("coefficient", 9).alias("coefficient"))


# Customers and the parts they bought, suppliers and the parts they supply, and who traded with whom.
_TASTE = """cp AS MATERIALIZED (SELECT DISTINCT o_custkey * 8 + 2 AS c, l_partkey * 8 + 4 AS p
              FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
     sp AS MATERIALIZED (SELECT DISTINCT l_suppkey * 8 + 3 AS s, l_partkey * 8 + 4 AS p FROM lineitem),
     pairs AS MATERIALIZED (SELECT DISTINCT o_custkey * 8 + 2 AS a, l_suppkey * 8 + 3 AS b
              FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""


def _taste(spark, d):
    """Undirected customer-part and supplier-part edges, and the pairs of customers and suppliers that traded."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    customer, part, supplier = vertex_id("customer", "o_custkey"), vertex_id("part", "l_partkey"), vertex_id(
        "supplier", "l_suppkey")
    sold = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    sold = written(sold.select(customer.alias("customer"), part.alias("part"), supplier.alias("supplier")), "sold")
    bought = sold.select(F.col("customer").alias("src"), F.col("part").alias("dst")).distinct()
    supplied = lines.select(supplier.alias("src"), part.alias("dst")).distinct()
    edges = both_directions(written(bought.unionAll(supplied), "tastes"))
    return sold.select(F.col("customer").alias("a"), F.col("supplier").alias("b")), edges


@query(
    "adamic_adar",
    f"""WITH {_TASTE}, deg AS MATERIALIZED (SELECT p, count(*) AS n FROM (SELECT p FROM cp UNION ALL SELECT p FROM sp) GROUP BY p)
        SELECT a, b, round(coalesce(sum(1 / ln(deg.n)), 0), 6) AS score
        FROM pairs LEFT JOIN cp ON cp.c = a LEFT JOIN sp ON sp.s = b AND sp.p = cp.p LEFT JOIN deg ON deg.p = sp.p
        GROUP BY a, b""",
)
def adamic_adar_pairs(spark, d):
    pairs, edges = _taste(spark, d)
    return adamic_adar(pairs, edges).select("a", "b", F.round("score", 6).alias("score"))


@query(
    "jaccard",
    f"""WITH {_TASTE}, dc AS (SELECT c, count(*) AS n FROM cp GROUP BY c), ds AS (SELECT s, count(*) AS n FROM sp GROUP BY s),
          common AS (SELECT a, b, count(sp.p) AS n FROM pairs JOIN cp ON cp.c = a
                     LEFT JOIN sp ON sp.s = b AND sp.p = cp.p GROUP BY a, b)
        SELECT a, b, round(common.n * 1.0 / (dc.n + ds.n - common.n), 9) AS score
        FROM common JOIN dc ON dc.c = a JOIN ds ON ds.s = b""",
)
def jaccard_pairs(spark, d):
    pairs, edges = _taste(spark, d)
    return jaccard(pairs, edges).select("a", "b", F.round("score", 9).alias("score"))


# Width of a bucket of costs: half the range of quantities.
_BUCKET = 25
# More rounds than the longest best path has hops at any of the supplied sizes.
_ROUNDS = 30


def _distance_ctes() -> str:
    ctes = [f"WITH {_SUPPLY}", "d0 AS MATERIALIZED (SELECT 3::BIGINT AS id, 0::DOUBLE AS cost, 0::BIGINT AS hops)"]
    for i in range(1, _ROUNDS + 1):
        ctes.append(
            f"""d{i} AS MATERIALIZED (SELECT id, min(cost) AS cost, arg_min(hops, (cost, hops)) AS hops FROM (
                  SELECT id, cost, hops FROM d{i - 1} UNION ALL
                  SELECT e.dst, d.cost + e.weight, d.hops + 1 FROM d{i - 1} d JOIN e ON e.src = d.id) GROUP BY id)"""
        )
    return ", ".join(ctes)


@query("shortest_path", _distance_ctes() + f" SELECT id, cost, hops FROM d{_ROUNDS}")
def shortest_path_all(spark, d):
    """From the supplier with key 0 to every part and supplier; an edge costs its smallest quantity."""
    graph = _supply(spark, d, "l_quantity")
    start = order_graph(spark, d).nodes("supplier").where("s_suppkey = 0").select(F.col("vid").alias("id"))
    return distances(graph, start).select("id", "cost", "hops")


@query("shortest_path_buckets", _distance_ctes() + f" SELECT id, cost, hops FROM d{_ROUNDS}")
def shortest_path_buckets(spark, d):
    """The same by delta-stepping: a round shuffles one bucket of costs, settled vertices not again."""
    graph = _supply(spark, d, "l_quantity")
    start = order_graph(spark, d).nodes("supplier").where("s_suppkey = 0").select(F.col("vid").alias("id"))
    return delta_stepping.distances(graph, start, delta=float(_BUCKET)).select("id", "cost", "hops")


def _route_sql() -> str:
    ctes = [_distance_ctes(), f"w0 AS MATERIALIZED (SELECT id, cost, hops FROM d{_ROUNDS} WHERE id = (SELECT max(p_partkey) * 8 + 4 FROM part))"]
    for i in range(1, _ROUNDS + 1):
        ctes.append(
            f"""w{i} AS MATERIALIZED (SELECT d.id, d.cost, d.hops FROM w{i - 1} w JOIN e ON e.dst = w.id
                 JOIN d{_ROUNDS} d ON d.id = e.src AND d.cost + e.weight = w.cost AND d.hops = w.hops - 1
                 ORDER BY d.id LIMIT 1)"""
        )
    steps = " UNION ALL ".join(f"SELECT * FROM w{i}" for i in range(_ROUNDS + 1))
    return ", ".join(ctes) + f""" SELECT (SELECT cost FROM w0) AS total_cost,
        string_agg(CASE id % 8 WHEN 4 THEN 'p:' ELSE 's:' END || (id // 8), ',' ORDER BY hops) AS nodes FROM ({steps})"""


@query("shortest_path_route", _route_sql())
def shortest_path_route(spark, d):
    """The route itself, to the part with the highest key; the lowest id goes first among equals."""
    g = order_graph(spark, d)
    graph = _supply(spark, d, "l_quantity")
    start = g.nodes("supplier").where("s_suppkey = 0").select(F.col("vid").alias("id"))
    target = g.nodes("part").agg(F.max("vid")).first()[0]
    route = path_to(distances(graph, start, target), target)
    return route.select("total_cost", F.array_join(F.transform("node_ids", _element), ",").alias("nodes"))
