"""Published graphs that several writers change: numbered versions, label-set partitions, and deletes as rows.

A version is one manifest file that names the folders its tables consist of. A writer stages folders, then creates the
manifest of the next number, which only one can; who comes second looks at what was published since it began, and
either goes on with the next number or, if its own tables changed, gives up. Rows are never rewritten: a delete is a
small table of ids, merged when a snapshot is read, until ``compact`` writes what is left.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.sources.graph import NODE_KEYS, PropertyGraph, normalised

NODES, RELS = "nodes", "rels"
#: The column that nodes, and the one that relationships, are partitioned by.
PARTITIONED = {NODES: "label_set", RELS: "rel_type"}


class Conflict(RuntimeError):
    """Another writer published a table that this one had read or changed."""


def label_set(labels: Column) -> Column:
    """The name of a set of labels: normalised, sorted, each once; no two sets share a name."""
    named = F.array_sort(F.array_distinct(F.transform(labels, normalised)))
    escaped = F.transform(named, lambda x: F.replace(F.replace(x, F.lit("%"), F.lit("%25")), F.lit("&"), F.lit("%26")))
    return F.concat(F.lit("&"), F.array_join(escaped, "&"), F.lit("&"))


def _of_label(label: str) -> Column:
    """Whether a label set holds a label: a test of the partition's name, so files without it are not opened."""
    name = label.strip().lower().replace("%", "%25").replace("&", "%26")
    return F.contains(F.col("label_set"), F.lit(f"&{name}&"))


@dataclass
class Version:
    """What a manifest says: per table its columns, and the folders of rows and of deletes with their version."""

    number: int = 0
    wrote: list[str] = field(default_factory=list)
    schemas: dict[str, str] = field(default_factory=dict)
    rows: dict[str, dict[str, int]] = field(default_factory=dict)
    deletes: dict[str, dict[str, int]] = field(default_factory=dict)


class Files:
    """The few small files of a store, by Hadoop's file systems, so that every root Spark reads will do."""

    def __init__(self, spark: SparkSession, root: str):
        self.root, jvm = root, spark.sparkContext._jvm
        self._path, self._rename = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.hadoop.fs.Options.Rename
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.system = self._path(root).getFileSystem(conf)
        self.context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.system.getUri(), conf)
        self._array = lambda: spark.sparkContext._gateway.new_array(self._rename, 0)

    def names(self, folder: str) -> list[str]:
        path = self._path(f"{self.root}/{folder}")
        return [s.getPath().getName() for s in self.system.listStatus(path)] if self.system.exists(path) else []

    def read(self, name: str) -> str:
        stream = self.system.open(self._path(f"{self.root}/{name}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Put a whole file into place unless it is there; False if it is."""
        staged, final = self._path(f"{self.root}/staged/{uuid.uuid4().hex}"), self._path(f"{self.root}/{name}")
        stream = self.system.create(staged, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        self.system.mkdirs(final.getParent())
        try:
            self.context.rename(staged, final, self._array())  # never over a file that is there
            return True
        except Exception:
            if not self.system.exists(final):
                raise
            self.system.delete(staged, False)
            return False

    def remove(self, folder: str) -> None:
        self.system.delete(self._path(f"{self.root}/{folder}"), True)


class Store:
    """A published graph under a root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark, root.rstrip("/"))

    def versions(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in self.files.names("manifest") if n.endswith(".json") and not n.startswith("."))

    def version(self, number: int | None = None) -> Version:
        """A version, by default the newest; version 0 is empty."""
        known = self.versions()
        number = (known[-1] if known else 0) if number is None else number
        return Version(**json.loads(self.files.read(f"manifest/{number:020d}.json"))) if number else Version()

    def table(self, name: str, version: Version) -> DataFrame:
        """The rows of a table at a version, without those that were deleted since they were written."""
        schema = T.StructType.fromJson(json.loads(version.schemas[name])).add("folder", "string")
        base, folders = f"{self.root}/{name}", version.rows[name]
        if not folders:
            return self.spark.createDataFrame([], schema).drop("folder")
        rows = self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/folder={f}" for f in folders])
        gone = self._gone(version)
        if gone is None:
            return rows.drop("folder")
        since = F.element_at(F.create_map(*[F.lit(x) for pair in folders.items() for x in pair]), F.col("folder"))
        rows = rows.withColumn("_since", since)
        for key in ("element_id",) if name == NODES else ("element_id", "src", "dst"):
            kind = RELS if name == RELS and key == "element_id" else NODES
            hidden = gone.where(F.col("_kind") == kind).select("_gone", "_at")
            rows = rows.join(hidden, (F.col(key) == F.col("_gone")) & (F.col("_since") < F.col("_at")), "left_anti")
        return rows.drop("folder", "_since")

    def _gone(self, version: Version) -> DataFrame | None:
        """(_kind, _gone, _at): deleted ids and the last version that deleted them."""
        parts = [
            self.spark.read.schema("element_id string").parquet(f"{self.root}/deleted_{name}/folder={f}").select(
                F.lit(name).alias("_kind"), F.col("element_id").alias("_gone"), F.lit(at).alias("_at")
            )
            for name, folders in version.deletes.items() for f, at in folders.items()
        ]
        return reduce(DataFrame.unionByName, parts).groupBy("_kind", "_gone").agg(F.max("_at").alias("_at")) if parts else None

    def snapshot(self, number: int | None = None) -> "Snapshot":
        return Snapshot(self, self.version(number))

    @contextmanager
    def unit(self) -> Iterator["Unit"]:
        """A unit of work: published when the block ends, removed when it raises or meets a conflict."""
        unit = Unit(self, self.version())
        try:
            yield unit
            unit.commit()
        except BaseException:
            unit.discard()
            raise

    def compact(self) -> int:
        """Write the rows that are left of tables with deletes or several folders anew; older versions stay as they are."""
        with self.unit() as unit:
            for name in list(unit.base.rows):
                if unit.base.deletes or len(unit.base.rows[name]) > 1:
                    unit.replace(name, self.table(name, unit.base))
            if unit.base.deletes:
                unit.forgets_deletes = True
        return unit.number


class Snapshot(PropertyGraph):
    """One version of a store, to be matched like any graph. A node of several labels is stored, and read, once."""

    def __init__(self, store: Store, version: Version):
        super().__init__()
        self.store, self.version = store, version

    def _rows(self, name: str, keys: str) -> DataFrame:
        if name in self.version.schemas:
            return self.store.table(name, self.version)
        return self.store.spark.createDataFrame([], keys)

    def nodes(self, label: str) -> DataFrame:
        return self.every_node().where(_of_label(label))

    def rels(self, rel_type: str) -> DataFrame:
        return self.every_rel().where(F.col("rel_type") == rel_type.strip().lower())

    def every_node(self) -> DataFrame:
        rows = self._rows(NODES, "element_id string, labels array<string>, label_set string")
        return rows.withColumn("vid", F.col("element_id"))

    def every_rel(self) -> DataFrame:
        return self._rows(RELS, "element_id string, src string, dst string, rel_type string")

    def all_nodes(self, labels: set[str] | None = None) -> DataFrame:
        rows = self.every_node()
        if labels is not None:
            rows = rows.where(reduce(lambda a, b: a | b, (_of_label(x) for x in labels), F.lit(False)))
        return rows.select(*NODE_KEYS)

    def all_rels(self, start: str | None = None) -> DataFrame:
        return self.every_rel().select("rel_type", "src", "dst")


class Unit:
    """Staged changes of one writer. What it reads and changes must not have been published by others meanwhile."""

    def __init__(self, store: Store, base: Version):
        self.store, self.base, self.number = store, base, base.number
        self.reads: set[str] = set()
        self.added: list[tuple[str, str]] = []
        self.deleted: list[tuple[str, str]] = []
        self.replaced: set[str] = set()
        self.schemas: dict[str, T.StructType] = {}
        self.forgets_deletes = False

    def read(self) -> Snapshot:
        """The graph as it was when the unit began; both tables count as read."""
        self.reads |= {NODES, RELS}
        return Snapshot(self.store, self.base)

    def add_nodes(self, nodes: DataFrame) -> None:
        """Nodes (element_id, labels, properties). Of each set of labels there is one partition."""
        self._add(NODES, nodes.drop("vid").withColumn("label_set", label_set(F.col("labels"))))

    def add_rels(self, rels: DataFrame) -> None:
        """Relationships (element_id, rel_type, src, dst, properties)."""
        self._add(RELS, rels.withColumn("rel_type", normalised(F.col("rel_type"))))

    def replace(self, name: str, rows: DataFrame) -> None:
        self.replaced.add(name)
        self._add(name, rows)

    def _add(self, name: str, rows: DataFrame) -> None:
        folder, by = uuid.uuid4().hex, PARTITIONED[name]
        self.added.append((name, folder))
        # one task per partition would make a hot label one file; each task writes the partitions it meets
        rows.write.partitionBy(by).parquet(f"{self.store.root}/{name}/folder={folder}")
        fields = [f for f in rows.schema if f.name != by]
        before = self.schemas.get(name)
        self.schemas[name] = T.StructType([*fields, T.StructField(by, T.StringType())])
        if before is not None:
            self.schemas[name] = _merged(before, self.schemas[name], by)

    def delete(self, ids: DataFrame, table: str = NODES) -> None:
        """Delete elements by ``element_id``. Relationships of a deleted node go with it. Their files stay as they are."""
        folder = uuid.uuid4().hex
        self.deleted.append((table, folder))
        ids.select(F.col("element_id").cast("string")).distinct().write.parquet(f"{self.store.root}/deleted_{table}/folder={folder}")

    def touched(self) -> set[str]:
        names = {n for n, _ in self.added} | {n for n, _ in self.deleted}
        return names | ({RELS} if NODES in {n for n, _ in self.deleted} else set())

    def commit(self, before_create: Callable[[], None] | None = None) -> int:
        """Publish as the next version. ``before_create`` is called before each try, for tests.

        A unit that only adds rows does not depend on other additions; one that reads, replaces or deletes does.
        """
        state = self.base
        while True:
            new = self._applied(state)
            if before_create:
                before_create()
            if self.store.files.create(f"manifest/{new.number:020d}.json", json.dumps(new.__dict__)):
                self.number = new.number
                return new.number
            state = self._newer(new.number)

    def _newer(self, taken: int) -> Version:
        """The newest version, if none since this unit began conflicts with it."""
        newest = self.store.version()
        blind = not (self.reads or self.replaced or self.deleted)
        for number in range(self.base.number + 1, newest.number + 1):
            other = set(self.store.version(number).wrote)
            exclusive = {n[1:] for n in other if n.startswith("!")}
            mine = self.touched() | self.reads
            if exclusive & mine or (not blind and {n.lstrip("!") for n in other} & mine):
                raise Conflict(f"version {number} changed {sorted(n.lstrip('!') for n in other)}; this unit began at {self.base.number}")
        return newest

    def _applied(self, state: Version) -> Version:
        number = state.number + 1
        schemas, rows, deletes = dict(state.schemas), {k: dict(v) for k, v in state.rows.items()}, {k: dict(v) for k, v in state.deletes.items()}
        for name in self.replaced:
            rows[name] = {}
        for name, folder in self.added:
            rows.setdefault(name, {})[folder] = number
            before = T.StructType.fromJson(json.loads(schemas[name])) if name in schemas else None
            merged = self.schemas[name] if before is None else _merged(before, self.schemas[name], PARTITIONED[name])
            schemas[name] = merged.json()
        for name, folder in self.deleted:
            deletes.setdefault(name, {})[folder] = number
        changed = self.touched()
        # a deletion or a replacement excludes every other change of its tables, an addition only those
        exclusive = self.replaced | ({n for n, _ in self.deleted} and changed)
        wrote = sorted(f"!{n}" if n in exclusive else n for n in changed)
        return Version(number, wrote, schemas, rows, {} if self.forgets_deletes else deletes)

    def discard(self) -> None:
        for name, folder in self.added:
            self.store.files.remove(f"{name}/folder={folder}")
        for name, folder in self.deleted:
            self.store.files.remove(f"deleted_{name}/folder={folder}")


def _merged(a: T.StructType, b: T.StructType, last: str) -> T.StructType:
    """The columns of both; a column must have one type."""
    fields = {f.name: f for f in a if f.name != last}
    for f in b:
        if f.name == last:
            continue
        if f.name in fields and fields[f.name].dataType != f.dataType:
            raise TypeError(f"column {f.name} is {fields[f.name].dataType.simpleString()} and {f.dataType.simpleString()}")
        fields.setdefault(f.name, T.StructField(f.name, f.dataType))
    return T.StructType([*fields.values(), T.StructField(last, T.StringType())])
