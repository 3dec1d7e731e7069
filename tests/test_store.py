"""Published graphs: label partitions, deletes by version, and writers that meet."""

import random

import pytest
from pyspark.sql import functions as F

from graphloom.operators.patterns import hop
from graphloom.operators.store import NODES, Conflict, Store, label_set


def _nodes(spark, rows):
    return spark.createDataFrame(rows, "element_id string, labels array<string>, name string")


def _rels(spark, rows):
    return spark.createDataFrame(rows, "element_id string, rel_type string, src string, dst string, w int")


@pytest.fixture
def store(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/graph")
    with store.unit() as unit:
        unit.add_nodes(_nodes(spark, [("a", ["Person"], "Ann"), ("b", ["person", " Poet "], "Bob"), ("c", ["City"], "Rom"), ("d", [], "none")]))
        unit.add_rels(_rels(spark, [("1", "KNOWS", "a", "b", 1), ("2", "LIVES", "a", "c", 2), ("3", "LIVES", "b", "c", 3)]))
    return store


def names(df):
    return sorted(r.name for r in df.collect())


def test_a_label_is_a_list_of_partitions(spark, store):
    g = store.snapshot()
    assert names(g.nodes("PERSON")) == ["Ann", "Bob"] and names(g.nodes(" poet")) == ["Bob"] and names(g.nodes("pers")) == []
    assert names(g.every_node()) == ["Ann", "Bob", "Rom", "none"]
    plan = g.nodes("poet")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(label_set" in plan and "Contains(label_set" in plan.replace("contains", "Contains")
    scanned = g.nodes("poet").select(F.input_file_name().alias("f")).distinct().collect()
    assert len(scanned) == 1 and "%26person%26poet%26" in scanned[0].f.replace("&", "%26")
    met = hop(g.nodes("poet"), g.rels("lives"), g.nodes("city")).select("a.name", F.col("b.name").alias("city"))
    assert [tuple(r) for r in met.collect()] == [("Bob", "Rom")]


def test_label_sets_do_not_clash(spark):
    rows = [(["a", "b"],), (["B ", "A", "a"],), (["a&b"],), (["a%26b"],), ([],)]
    got = [r[0] for r in spark.createDataFrame(rows, "l array<string>").select(label_set(F.col("l"))).collect()]
    assert got[0] == got[1] and len(set(got)) == 4


def test_deletes_hide_nodes_and_their_edges_from_then_on(spark, store, tmp_path):
    before = {str(p): p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    with store.unit() as unit:
        unit.delete(unit.read().nodes("poet"))
    new, old = store.snapshot(), store.snapshot(1)
    assert names(new.nodes("person")) == ["Ann"] and names(old.nodes("person")) == ["Ann", "Bob"]
    assert sorted(r.element_id for r in new.every_rel().collect()) == ["2"] and old.every_rel().count() == 3
    after = {str(p): p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    assert before.items() <= after.items()
    with store.unit() as unit:  # the same id again is a new node, its old edges stay away
        unit.add_nodes(_nodes(spark, [("b", ["Person"], "Bea")]))
    assert names(store.snapshot().nodes("person")) == ["Ann", "Bea"] and store.snapshot().every_rel().count() == 1
    with store.unit() as unit:
        unit.delete(spark.createDataFrame([("2",)], "element_id string"), "rels")
    assert store.snapshot().every_rel().count() == 0
    store.compact()
    assert store.version().deletes == {} and names(store.snapshot().every_node()) == ["Ann", "Bea", "Rom", "none"]
    assert store.snapshot().every_rel().count() == 0 and names(store.snapshot(1).nodes("poet")) == ["Bob"]


def test_of_two_units_on_one_table_one_wins(spark, store):
    with pytest.raises(Conflict):
        with store.unit() as slow:
            slow.delete(slow.read().nodes("poet"))
            with store.unit() as fast:
                fast.delete(fast.read().nodes("city"))
    assert names(store.snapshot().every_node()) == ["Ann", "Bob", "none"] and store.versions() == [1, 2]
    assert len(store.files.names("deleted_nodes")) == 1  # what the loser staged is gone


def test_additions_do_not_disturb_each_other(spark, store):
    with store.unit() as slow:
        slow.add_nodes(_nodes(spark, [("x", ["Person"], "Xan")]))
        with store.unit() as fast:
            fast.add_nodes(spark.createDataFrame([("y", ["Person"], 3)], "element_id string, labels array<string>, age int"))
    rows = {r.element_id: (r.name, r.age) for r in store.snapshot().nodes("person").collect()}
    assert rows == {"a": ("Ann", None), "b": ("Bob", None), "x": ("Xan", None), "y": (None, 3)} and store.versions() == [1, 2, 3]


@pytest.mark.parametrize("first", ["add", "delete"])
def test_addition_against_deletion(spark, store, first):
    """Whoever publishes second and depends on the table gives up; an addition yields to a deletion it did not see."""
    def act(unit, what):
        if what == "add":
            unit.add_nodes(_nodes(spark, [("x", ["Person"], "Xan")]))
        else:
            unit.delete(unit.read().nodes("poet"))

    with pytest.raises(Conflict):
        with store.unit() as slow:
            act(slow, "delete" if first == "add" else "add")
            with store.unit() as fast:
                act(fast, first)
    assert store.versions() == [1, 2]


def test_many_interleavings(spark, store):
    """Units that begin and publish in any order: the versions are those of some serial order without lost changes."""
    rng = random.Random(7)
    open_units, won = [], set()
    for i in range(12):
        unit = store.unit()
        u = unit.__enter__()
        u.add_nodes(_nodes(spark, [(f"n{i}", ["New"], f"n{i}")]))
        open_units.append((f"n{i}", unit))
        while open_units and rng.random() < 0.6:
            name, other = open_units.pop(rng.randrange(len(open_units)))
            other.__exit__(None, None, None)
            won.add(name)
    for name, other in open_units:
        other.__exit__(None, None, None)
        won.add(name)
    assert {r.name for r in store.snapshot().nodes("new").collect()} == won and store.versions() == list(range(1, 14))


def test_a_unit_that_fails_leaves_nothing(spark, store):
    with pytest.raises(ZeroDivisionError):
        with store.unit() as unit:
            unit.add_nodes(_nodes(spark, [("x", ["Person"], "Xan")]))
            raise ZeroDivisionError
    assert store.versions() == [1] and len(store.files.names(NODES)) == 1


def test_empty_store_and_types(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/empty")
    assert store.snapshot().nodes("x").count() == 0 and store.snapshot().all_rels().count() == 0 and store.versions() == []
    with store.unit() as unit:
        unit.add_nodes(_nodes(spark, []))
    assert store.snapshot().nodes("x").count() == 0
    with pytest.raises(TypeError):
        with store.unit() as unit:
            unit.add_nodes(spark.createDataFrame([("y", ["P"], 3)], "element_id string, labels array<string>, name int"))
