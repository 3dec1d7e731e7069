"""Creating and deleting graph elements, and publishing several tables as one unit."""

from __future__ import annotations

import contextlib
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.sources.graph import PropertyGraph, StoredGraph, normalised


def create_nodes(df: DataFrame, label: str, element_id: Column, *props: Column | str) -> DataFrame:
    """One node per row."""
    return df.select(element_id.alias("element_id"), F.array(normalised(F.lit(label))).alias("labels"), *props)


def create_from_list(df: DataFrame, items: str, label: str, name: str, element_id: Callable[[Column, Column], Column],
                     key: str) -> DataFrame:
    """One node per element of a list column; the id is made from the row's key and the position."""
    each = df.select(key, F.posexplode(items).alias("pos", name))
    return create_nodes(each, label, element_id(F.col(key), F.col("pos")), key, "pos", name)


def create_from_map(df: DataFrame, props: str, names: list[str], label: str, element_id: Column) -> DataFrame:
    """A map column becomes the node's properties; names that are absent read as null."""
    return create_nodes(df, label, element_id, *[F.try_element_at(F.col(props), F.lit(n)).alias(n) for n in names])


def create_from_record(df: DataFrame, record: str, label: str, element_id: Column, *props: Column | str) -> DataFrame:
    """A record column becomes properties in declaration order, before other ones. Nested records are refused."""
    dtype = df.schema[record].dataType
    nested = [f.name for f in dtype.fields if isinstance(f.dataType, T.StructType)]
    if nested:
        raise TypeError(f"a record used as properties cannot hold records: {nested}")
    return create_nodes(df, label, element_id, f"{record}.*", *props)


def create_rels(df: DataFrame, rel_type: str, start: DataFrame, end: DataFrame, start_key: tuple[str, str],
                end_key: tuple[str, str], element_id: Column, *props: str) -> DataFrame:
    """Relationships between nodes found by business keys, ``(column of df, column of the nodes)``."""
    s = start.select(F.col(start_key[1]).alias("_s"), F.col("element_id").alias("src"))
    e = end.select(F.col(end_key[1]).alias("_e"), F.col("element_id").alias("dst"))
    joined = df.join(s, F.col(start_key[0]) == F.col("_s")).join(e, F.col(end_key[0]) == F.col("_e"))
    return joined.select(
        element_id.alias("element_id"), normalised(F.lit(rel_type)).alias("rel_type"), "src", "dst", *props
    )


def detach_delete(nodes: DataFrame, rels: DataFrame, doomed: DataFrame, key: str = "vid") -> tuple[DataFrame, DataFrame]:
    """Remaining nodes, and remaining relationships: those that touch no deleted node."""
    gone = doomed.select(F.col(key).alias("_gone")).distinct()
    kept_nodes = nodes.join(gone, F.col(key) == F.col("_gone"), "left_anti")
    kept_rels = rels.join(gone, F.col("src") == F.col("_gone"), "left_anti").join(
        gone, F.col("dst") == F.col("_gone"), "left_anti"
    )
    return kept_nodes, kept_rels


@dataclass
class Summary:
    """What a write did."""

    query: str
    counters: dict[str, int]


def write_with_summary(df: DataFrame, path: str, query: str, counter: str = "nodes_created") -> Summary:
    """Write rows and count them in the same pass."""
    seen = Observation("write")
    df.observe(seen, F.count(F.lit(1)).alias(counter)).write.mode("append").parquet(path)
    return Summary(query, dict(seen.get))


@dataclass
class UnitOfWork:
    """Tables staged under one new version; nobody sees them before the manifest row."""

    spark: SparkSession
    root: str
    version: str = field(default_factory=lambda: f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}")
    staged: list[str] = field(default_factory=list)

    def write(self, name: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/tables/{name}/v={self.version}")
        self.staged.append(name)

    def discard(self) -> None:
        """Remove the staged tables of this version, wherever the root is stored."""
        jvm = self.spark.sparkContext._jvm
        for name in self.staged:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/tables/{name}/v={self.version}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self.staged.clear()

    def commit(self) -> None:
        """One small file names all tables of the version. Spark moves it into place last."""
        rows = [(self.version, name) for name in self.staged]
        manifest = self.spark.createDataFrame(rows, "version string, name string")
        manifest.coalesce(1).write.mode("overwrite").json(f"{self.root}/manifest/v={self.version}")


@contextlib.contextmanager
def transact(spark: SparkSession, root: str) -> Iterator[UnitOfWork]:
    """Commit when the block ends; publish nothing and remove what was staged when it raises.

    One writer per root is assumed. A driver that dies inside the block leaves its staged files; no manifest names them.
    """
    unit = UnitOfWork(spark, root)
    try:
        yield unit
    except BaseException:
        unit.discard()
        raise
    unit.commit()


def snapshot(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Every published table at its newest version, all resolved from one look at the manifest."""
    try:
        manifest = spark.read.schema("version string, name string").json(f"{root}/manifest/*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    newest = manifest.groupBy("name").agg(F.max("version").alias("version"))
    return {r["name"]: spark.read.parquet(f"{root}/tables/{r['name']}/v={r['version']}") for r in newest.collect()}


def publish_graph(spark: SparkSession, root: str, nodes: dict[str, DataFrame], rels: dict[str, DataFrame]) -> None:
    """Publish node tables and relationship tables as one unit. A node belongs in one table, whatever its labels."""
    with transact(spark, root) as unit:
        for name, df in nodes.items():
            unit.write(f"nodes.{name}", df)
        for name, df in rels.items():
            unit.write(f"rels.{normal_name(name)}", df)


def normal_name(name: str) -> str:
    return name.strip().lower()


def open_graph(spark: SparkSession, root: str) -> PropertyGraph:
    """The graph published under ``root``, to be matched like any other. Nodes are joined by their element ids."""
    tables = snapshot(spark, root)

    def opened(kind: str) -> dict[str, Callable[[], DataFrame]]:
        found = {n.partition(".")[2]: t for n, t in tables.items() if n.startswith(f"{kind}.")}
        if kind == "nodes":
            found = {n: t.withColumn("vid", F.col("element_id")) for n, t in found.items()}
        return {n: (lambda t=t: t) for n, t in found.items()}

    return StoredGraph(opened("nodes"), opened("rels"))
