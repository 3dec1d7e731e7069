"""Matching: label, type and property tests, and hops along relationships."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def has_label(labels: Column, label: str | Column) -> Column:
    """The argument is matched without case but is not trimmed."""
    return F.array_contains(labels, F.lower(label if isinstance(label, Column) else F.lit(label)))


def has_type(rel_type: Column, name: str) -> Column:
    return F.lower(rel_type) == name.lower()


def where_props(df: DataFrame, **props) -> DataFrame:
    """Inline property equality; a null argument matches nothing."""
    return df.where(reduce(Column.__and__, (F.col(k) == F.lit(v) for k, v in props.items()), F.lit(True)))


def hop(start: DataFrame, rel: DataFrame, end: DataFrame, names: tuple[str, str, str] = ("a", "r", "b")) -> DataFrame:
    """One directed hop; columns are read as ``a.<prop>``, ``r.<prop>``, ``b.<prop>``."""
    a, r, b = names
    return (
        start.alias(a)
        .join(rel.alias(r), F.col(f"{a}.vid") == F.col(f"{r}.src"))
        .join(end.alias(b), F.col(f"{r}.dst") == F.col(f"{b}.vid"))
    )


def extend(pattern: DataFrame, last: str, rel: DataFrame, end: DataFrame, names: tuple[str, str]) -> DataFrame:
    """One more hop from the node called ``last`` in a pattern."""
    r, b = names
    return pattern.join(rel.alias(r), F.col(f"{last}.vid") == F.col(f"{r}.src")).join(
        end.alias(b), F.col(f"{r}.dst") == F.col(f"{b}.vid")
    )


def lookup_pairs(pairs: DataFrame, nodes: DataFrame, key: str, ends: tuple[str, str] = ("k1", "k2")) -> DataFrame:
    """Two filtered matches at once: each requested pair of key values with both nodes.

    The two matches are equi-joins on the requested keys, so no product of the sides is built.
    """
    first, second = ends
    return (
        pairs.alias("pair")
        .join(nodes.alias("n1"), F.col(f"pair.{first}") == F.col(f"n1.{key}"))
        .join(nodes.alias("n2"), F.col(f"pair.{second}") == F.col(f"n2.{key}"))
    )


def prop(df: DataFrame, name: str, ddl: str = "string") -> Column:
    """A property by name; null where the table has no such column."""
    return F.col(name) if name in df.columns else F.lit(None).cast(ddl)


def ids_to_props(df: DataFrame, row_key: str, ids: str, nodes: DataFrame, node_key: str, name: str) -> DataFrame:
    """Replace a list of node ids by a property of each, keeping list order.

    A row's list is taken apart, joined and put together again, so the regrouped size is that of the
    row it came from. Lists that are empty or null stay in the result.
    """
    parts = df.select(row_key, F.posexplode_outer(ids).alias("pos", "id"))
    named = parts.join(nodes.select(F.col(node_key).alias("id"), F.col(name).alias("value")), "id", "left")
    entry = F.when(F.col("pos").isNotNull(), F.struct("pos", "value"))
    return named.groupBy(row_key).agg(
        F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["value"]).alias(name + "s")
    )


def attach_metric(nodes: DataFrame, metric: DataFrame, node_key: str, metric_key: str, name: str) -> DataFrame:
    """Add a computed property to nodes; null where there is none."""
    m = metric.select(F.col(metric_key).alias("_metric_key"), F.col(name))
    return nodes.join(m, F.col(node_key) == F.col("_metric_key"), "left").drop("_metric_key")


def node_value(
    df_alias: str, schema: T.StructType, keys: tuple[str, ...] = ("vid", "element_id", "labels"), typed: bool = False
) -> Column:
    """A node as one value.

    ``typed`` properties are a struct, which record decoders read. Otherwise they are JSON text, so nodes of any label
    share a type, as the nodes of one path must, and compare equal.
    """
    props = [F.col(f"{df_alias}.{f.name}") for f in schema.fields if f.name not in keys]
    return F.struct(
        F.col(f"{df_alias}.element_id").alias("element_id"),
        F.col(f"{df_alias}.labels").alias("labels"),
        _properties(props, typed).alias("properties"),
    )


def _properties(props: list[Column], typed: bool) -> Column:
    if typed:
        return F.struct(*props)
    return F.to_json(F.struct(*props)) if props else F.lit("{}")


def rel_value(df_alias: str, schema: T.StructType, src: Column, dst: Column, typed: bool = False) -> Column:
    """A relationship as one value, with the element ids of its ends."""
    keys = ("element_id", "rel_type", "src", "dst")
    props = [F.col(f"{df_alias}.{f.name}") for f in schema.fields if f.name not in keys]
    return F.struct(
        F.col(f"{df_alias}.element_id").alias("element_id"),
        F.col(f"{df_alias}.rel_type").alias("rel_type"),
        _properties(props, typed).alias("properties"),
        src.alias("src"),
        dst.alias("dst"),
    )
