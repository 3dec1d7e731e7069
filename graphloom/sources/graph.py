"""Property graphs: one wide table per node label and per relationship type.

Properties stay typed columns, so filters and column pruning reach the Parquet scan. Every node
table has ``vid`` (a 64-bit join key), ``element_id`` (the public string id) and ``labels``; every
relationship table has ``rel_type``, ``src`` and ``dst``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.sources.tables import table

NODE_KEYS = ("vid", "element_id", "labels")
REL_KEYS = ("element_id", "rel_type", "src", "dst")


def normalised(name: Column) -> Column:
    """Labels and types are stored trimmed and in lower case."""
    return F.lower(F.trim(name))


@dataclass
class PropertyGraph:
    """Tables by label and by type, each opened when it is asked for."""

    node_tables: dict[str, Callable[[], DataFrame]] = field(default_factory=dict)
    rel_tables: dict[str, Callable[[], DataFrame]] = field(default_factory=dict)
    # Labels that relationships of a type start and end at, where they are known.
    rel_ends: dict[str, tuple[set[str], set[str]]] = field(default_factory=dict)
    # Whether a vertex id belongs to one of some labels, where the id itself tells.
    id_has_label: Callable[[Column, list[str]], Column] | None = None

    def nodes(self, label: str) -> DataFrame:
        """Nodes with a label; the label is matched without case, and an unknown one matches nothing."""
        opened = self.node_tables.get(label.lower())
        return opened() if opened else self.all_nodes().limit(0)

    def rels(self, rel_type: str) -> DataFrame:
        opened = self.rel_tables.get(rel_type.lower())
        return opened() if opened else self.all_rels().limit(0)

    def all_nodes(self, labels: set[str] | None = None) -> DataFrame:
        """Keys of every node, whatever its label, or of the nodes of some labels."""
        opened = [t for name, t in self.node_tables.items() if labels is None or name in labels]
        return reduce(DataFrame.unionByName, (t().select(*NODE_KEYS) for t in opened))

    def all_rels(self, start: str | None = None) -> DataFrame:
        """Endpoints and type of every relationship, or of those types that may start at a label."""
        opened = (self.rel_tables[t]().select("rel_type", "src", "dst") for t in self.types_from(start))
        return reduce(DataFrame.unionByName, opened)

    def types_from(self, start: str | None) -> list[str]:
        """Types that may start at nodes of a label. Types of unknown ends may start anywhere."""
        ends = self.rel_ends
        return [t for t in self.rel_tables if start is None or t not in ends or start.lower() in ends[t][0]]

    def labels_from(self, start: str) -> set[str]:
        """Labels that one hop from a label may end at."""
        types = self.types_from(start)
        return set().union(*(self.rel_ends[t][1] if t in self.rel_ends else set(self.node_tables) for t in types))


class StoredGraph(PropertyGraph):
    """Node tables by any name; which labels a node has is said by its row, so it may have several."""

    def nodes(self, label: str) -> DataFrame:
        """Nodes that have a label, with the properties of all the tables they come from."""
        every = reduce(
            lambda a, b: a.unionByName(b, allowMissingColumns=True), (opened() for opened in self.node_tables.values())
        )
        labels = F.transform("labels", normalised)
        return every.where(F.array_contains(labels, normalised(F.lit(label))))


# Code of each label within a vertex id: vid = key * 8 + code, one to one and kept in 64 bits.
LABEL_CODES = {"region": 0, "nation": 1, "customer": 2, "supplier": 3, "part": 4, "order": 5}
PREFIXES = {"region": "r", "nation": "n", "customer": "c", "supplier": "s", "part": "p", "order": "o"}
_NODE_SOURCES = {
    "region": ("region", "r_regionkey"),
    "nation": ("nation", "n_nationkey"),
    "customer": ("customer", "c_custkey"),
    "supplier": ("supplier", "s_suppkey"),
    "part": ("part", "p_partkey"),
    "order": ("orders", "o_orderkey"),
}


def vertex_id(label: str, key: Column | str) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return key.cast("bigint") * F.lit(8) + F.lit(LABEL_CODES[label])


def element_id(label: str, key: Column | str) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit(PREFIXES[label] + ":"), key.cast("string"))


def as_nodes(df: DataFrame, label: str, vid: Column, eid: Column) -> DataFrame:
    return df.select(
        vid.alias("vid"), eid.alias("element_id"), F.array(normalised(F.lit(label))).alias("labels"), "*"
    )


def as_rels(df: DataFrame, rel_type: str, src: Column, dst: Column, eid: Column) -> DataFrame:
    return df.select(
        eid.alias("element_id"), normalised(F.lit(rel_type)).alias("rel_type"), src.alias("src"), dst.alias("dst"), "*"
    )


def order_graph(spark: SparkSession, folder: str) -> PropertyGraph:
    """The order tables as a graph.

    customer -placed-> order -contains-> part -supplied_by-> supplier, order -filled_by-> supplier,
    customer and supplier -in_nation-> nation -in_region-> region.
    """
    def nodes(label: str) -> DataFrame:
        name, key = _NODE_SOURCES[label]
        return as_nodes(table(spark, folder, name), label, vertex_id(label, key), element_id(label, key))

    def link(df, rel_type, src_label, src_key, dst_label, dst_key, eid) -> DataFrame:
        return as_rels(df, rel_type, vertex_id(src_label, src_key), vertex_id(dst_label, dst_key), eid)

    def keyed(rel_type: str, key: str) -> Column:
        return F.concat(F.lit(f"{rel_type}:"), F.col(key))

    def line_id(rel_type: str, lines: DataFrame) -> Column:
        # Lines have no key of their own: an exact copy of a line shares its id.
        return F.concat(F.lit(f"{rel_type}:"), F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in lines.columns])))

    def placed() -> DataFrame:
        orders = table(spark, folder, "orders")
        return link(orders, "placed", "customer", "o_custkey", "order", "o_orderkey", keyed("placed", "o_orderkey"))

    def contains() -> DataFrame:
        lines = table(spark, folder, "lineitem")
        return link(lines, "contains", "order", "l_orderkey", "part", "l_partkey", line_id("contains", lines))

    def supplied_by() -> DataFrame:
        lines = table(spark, folder, "lineitem")
        return link(lines, "supplied_by", "part", "l_partkey", "supplier", "l_suppkey", line_id("supplied_by", lines))

    def filled_by() -> DataFrame:
        lines = table(spark, folder, "lineitem")
        return link(lines, "filled_by", "order", "l_orderkey", "supplier", "l_suppkey", line_id("filled_by", lines))

    def in_nation() -> DataFrame:
        customer, supplier = table(spark, folder, "customer"), table(spark, folder, "supplier")
        of_customers = link(customer, "in_nation", "customer", "c_custkey", "nation", "c_nationkey",
                            keyed("in_nation:c", "c_custkey"))
        of_suppliers = link(supplier, "in_nation", "supplier", "s_suppkey", "nation", "s_nationkey",
                            keyed("in_nation:s", "s_suppkey"))
        return of_customers.select(*REL_KEYS).unionByName(of_suppliers.select(*REL_KEYS))

    def in_region() -> DataFrame:
        nation = table(spark, folder, "nation")
        return link(nation, "in_region", "nation", "n_nationkey", "region", "n_regionkey",
                    keyed("in_region", "n_nationkey")).select(*REL_KEYS)

    return PropertyGraph(
        {label: (lambda name=label: nodes(name)) for label in _NODE_SOURCES},
        {
            "placed": placed,
            "contains": contains,
            "supplied_by": supplied_by,
            "filled_by": filled_by,
            "in_nation": in_nation,
            "in_region": in_region,
        },
        {
            "placed": ({"customer"}, {"order"}),
            "contains": ({"order"}, {"part"}),
            "supplied_by": ({"part"}, {"supplier"}),
            "filled_by": ({"order"}, {"supplier"}),
            "in_nation": ({"customer", "supplier"}, {"nation"}),
            "in_region": ({"nation"}, {"region"}),
        },
        lambda vid, labels: F.pmod(vid, F.lit(8)).isin(*[LABEL_CODES[name.lower()] for name in labels]),
    )
