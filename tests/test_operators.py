"""Patterns, paths, result shapes, writes, parameters and streams."""

import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F

from graphloom.catalog import QUERIES
from graphloom.functions import collections as coll
from graphloom.functions import records, scalars
from graphloom.functions.cells import column_of
from graphloom.functions.decoder import decode
from graphloom.functions.params import Fragment, Name, Param, encode, mixed_list, mixed_map, query, record_params
from graphloom.operators import paths, results, writes
from graphloom.operators.patterns import has_label, has_type, hop, ids_to_props, lookup_pairs, prop, where_props
from graphloom.session import scratch_path
from graphloom.sources.graph import order_graph
from graphloom.streaming import streams


def test_labels_and_types(spark):
    row = spark.sql("SELECT array('node') AS labels, 'rel' AS t").select(
        has_label(F.col("labels"), "NODE").alias("a"), has_label(F.col("labels"), " node").alias("b"),
        has_type(F.col("t"), "Rel").alias("c"),
    ).first()
    assert tuple(row) == (True, False, True)


def test_property_filters_reach_the_scan(spark, folder):
    buyers = order_graph(spark, folder).nodes("customer").where("c_mktsegment = 'BUILDING'").select("c_name")
    plan = buyers._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(c_mktsegment,BUILDING)" in plan
    assert "ReadSchema: struct<c_name:string,c_mktsegment:string>" in plan


def test_missing_property(spark):
    assert spark.range(1).select(prop(spark.range(1), "nope").alias("x")).first()["x"] is None


def test_ids_to_props_keeps_order_and_empty_lists(spark):
    rows = spark.sql("SELECT * FROM VALUES (1, array(3, 1, 3)), (2, array()), (3, array(9)) AS t(k, ids)")
    names = spark.sql("SELECT * FROM VALUES (1, 'a'), (3, 'c') AS t(id, name)")
    got = {r["k"]: r["names"] for r in ids_to_props(rows, "k", "ids", names, "id", "name").collect()}
    assert got == {1: ["c", "a", "c"], 2: [], 3: [None]}


def test_lookup_pairs(spark):
    nodes = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b') AS t(id, name)")
    pairs = spark.sql("SELECT * FROM VALUES ('a', 'b'), ('a', 'x') AS t(k1, k2)")
    got = lookup_pairs(pairs, nodes, "name").select("n1.id", F.col("n2.id").alias("other")).collect()
    assert [tuple(r) for r in got] == [(1, 2)]


def test_path_values(spark):
    node = lambda i: F.struct(F.lit(i).alias("element_id"))
    rel = lambda i: F.struct(F.lit(i).cast("string").alias("element_id"))
    empty = paths.path_value(node("a"), [])
    two = paths.path_value(node("a"), [(rel("r"), node("b")), (rel("s"), node("c"))])
    part = paths.path_value(node("a"), [(rel("r"), node("b")), (rel(None), node("c"))], optional=True)
    row = spark.range(1).select(
        paths.path_end(two)["element_id"].alias("end"), F.size(paths.path_nodes(two)).alias("n"),
        paths.path_end(part)["element_id"].alias("part_end"), F.size(empty["segments"]).alias("none"),
        paths.path_contains_node(two, node("b")).alias("has_b"), paths.path_contains_node(two, node("z")).alias("has_z"),
        paths.path_contains_rel(two, rel("s")).alias("has_s"),
    ).first()
    assert tuple(row) == ("c", 3, "b", 0, True, False, True)


def test_paths_as_rows(spark):
    points = spark.sql("SELECT * FROM VALUES (1, 0, 'x'), (1, 1, 'y'), (1, 2, 'z'), (2, 5, 'w') AS t(p, i, name)")
    segments = paths.segments_of(points, "p", "i")
    assert segments.count() == 3
    ends = {r["p"]: (r["start"]["name"], r["end"]["name"], r["length"]) for r in paths.summarise(segments, "p").collect()}
    assert ends == {1: ("x", "z", 2), 2: ("w", "w", 0)}
    nodes = paths.nodes_in_order(segments, "p").orderBy("p", "pos").collect()
    assert [(r["p"], r["pos"], r["node"]["name"]) for r in nodes] == [(1, 0, "x"), (1, 1, "y"), (1, 2, "z"), (2, 5, "w")]


def test_paths_with_gaps(spark):
    """Consecutive is by order; a long path crosses the ranges it is sorted over."""
    rows = [(1, i * i, f"n{i}") for i in range(200)] + [(2, 7, "alone"), (3, -5, "a"), (3, 90, "b")]
    segments = paths.segments_of(spark.createDataFrame(rows, "p int, i int, name string"), "p", "i")
    found = sorted((r["p"], r["pos"], r["start"]["name"], r["end"] and r["end"]["name"]) for r in segments.collect())
    expected = [(1, i * i, f"n{i}", f"n{i + 1}") for i in range(199)] + [(2, 7, "alone", None), (3, -5, "a", "b")]
    assert found == expected
    nodes = paths.nodes_in_order(segments, "p").where("p = 1").orderBy("pos").collect()
    assert [r["node"]["name"] for r in nodes] == [f"n{i}" for i in range(200)]


def test_no_properties_match_everything(spark):
    assert where_props(spark.range(3)).count() == 3


def test_unknown_names_match_nothing(spark, folder):
    g = order_graph(spark, folder)
    assert g.nodes("planet").count() == 0 and g.rels("orbits").count() == 0


def test_hop_leaves_out_types_that_cannot_match(spark, folder):
    g = order_graph(spark, folder)
    plan = hop(g.nodes("customer"), g.all_rels("customer"), g.all_nodes(g.labels_from("customer")))
    assert "lineitem" not in "".join(plan.inputFiles())


def test_failed_unit_removes_its_files(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(RuntimeError):
        with writes.transact(spark, root) as unit:
            unit.write("t", spark.range(3))
            raise RuntimeError("stopped")
    assert not list(tmp_path.glob("tables/t/v=*")) and writes.snapshot(spark, root) == {}


def test_single(spark):
    assert results.single(spark.range(1)).first()["id"] == 0
    assert results.single(spark.range(5).orderBy("id"), lenient=True).first()["id"] == 0
    for bad in (spark.range(0), spark.range(2)):
        with pytest.raises(Exception, match="A record was expected but none was received"):
            results.single(bad).collect()
    with pytest.raises(Exception, match="A record was expected but none was received"):
        results.single(spark.range(0), lenient=True).collect()


def test_map_last_wins_and_groups(spark):
    rows = spark.sql("SELECT * FROM VALUES ('a', 1, 10), ('b', 2, 20), ('a', 3, 30), ('a', 4, null) AS t(k, seq, v)")
    assert [tuple(r) for r in results.as_sorted_map(rows, "k", ["v"], ["seq"]).collect()] == [("a", None), ("b", 20)]
    grouped = results.collect_groups(rows.unionAll(rows), ["k"], "v", "vs").orderBy("k").collect()
    assert [[tuple(e) for e in r["vs"]] for r in grouped] == [[(10, 2), (30, 2)], [(20, 2)]]


def test_fragments():
    inner = Fragment("user.id = ", Param(1), " AND ", Param(False))
    outer = Fragment("user.name = ", Param("foo"), " AND ", inner)
    other = Fragment("user.name = ", Param("bar"))
    text, args = Fragment("WHERE (", outer, ") OR (", other, ") AND ", Param(None)).build()
    assert text == "WHERE (user.name = :q1_p1 AND user.id = :q1_q1_p1 AND :q1_q1_p2) OR (user.name = :q2_p1) AND :p1"
    assert args == {"q1_p1": "foo", "q1_q1_p1": 1, "q1_q1_p2": False, "q2_p1": "bar", "p1": None}
    assert (Fragment("a = ", Param(1)) + " AND " + Fragment("b = ", Param(2))).build() == (
        "a = :p1 AND b = :p2", {"p1": 1, "p2": 2},
    )
    assert Fragment("SELECT ", Name("a`b")).build()[0] == "SELECT `a``b`"
    assert record_params({"name": "x", "age": 3}).build() == (":p1 AS `name`, :p2 AS `age`", {"p1": "x", "p2": 3})
    with pytest.raises(TypeError):
        record_params({"inner": {"a": 1}})
    with pytest.raises(ValueError):
        record_params({})


def test_query_parameters(spark):
    q = query(Fragment("SELECT ", Param(1), " AS a, ", Param(uuid.UUID(int=5)), " AS u, ", Param([1, 2]), " AS xs"))
    row = q.with_params(p1=9).run(spark).first()
    assert (row["a"], row["u"], row["xs"]) == (9, str(uuid.UUID(int=5)), [1, 2])


def test_encode(spark):
    zone = dt.timezone(dt.timedelta(hours=-3))
    row = spark.range(1).select(
        encode(dt.date(2023, 1, 2)).alias("day"), encode(dt.datetime(2023, 1, 2, 13, 30)).cast("string").alias("wall"),
        encode(dt.datetime(2023, 1, 2, 13, 30, tzinfo=zone)).alias("zoned"),
        encode(dt.time(13, 30)).alias("clock"), encode(dt.timedelta(days=1, milliseconds=-1)).alias("span"),
        encode({"a": 1}).alias("m"), encode(None).alias("nothing"),
    ).select("*", F.unix_seconds("zoned.ts").alias("instant")).first()
    assert str(row["day"]) == "2023-01-02" and row["wall"] == "2023-01-02 13:30:00"
    assert row["zoned"]["zone"] == "-03:00" and row["instant"] == 1672677000
    assert row["clock"][0] == 48600 * 10**9
    assert tuple(row["span"]) == (0, 0, 86399, 999_000_000)
    assert row["m"] == {"a": 1} and row["nothing"] is None


def test_mixed_values_roundtrip(spark):
    path = scratch_path(spark, "test-mixed")
    spark.range(1).select(
        mixed_list([1, "balmung", True, None, 2.5]).alias("xs"), mixed_map({"a": 1, "b": [1, "x"][1]}).alias("m"),
    ).write.parquet(path)
    stored = spark.read.parquet(path)
    shape = records.tuple_of(scalars.integer, scalars.string, scalars.boolean, coll.option(scalars.long), scalars.double)
    assert tuple(decode(stored, shape, cell=column_of(stored, "xs")).first()["value"]) == (1, "balmung", True, None, 2.5)
    assert decode(stored, records.field("b", scalars.string), cell=column_of(stored, "m")).first()["value"] == "x"


def test_create_and_delete(spark):
    people = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "name string, n long")
    nodes = writes.create_nodes(people, " Person ", F.concat(F.lit("p:"), F.col("n")), "name", F.col("n").alias("vid"))
    assert nodes.first()["labels"] == ["person"]
    wanted = spark.createDataFrame([("a", "b", 5), ("b", "c", 6), ("a", "nobody", 7)], "x string, y string, w long")
    rels = writes.create_rels(wanted, "KNOWS", nodes, nodes, ("x", "name"), ("y", "name"), F.concat("x", "y"), "w")
    assert sorted((r["src"], r["dst"], r["rel_type"], r["w"]) for r in rels.collect()) == [
        ("p:1", "p:2", "knows", 5), ("p:2", "p:3", "knows", 6),
    ]
    kept, rest = writes.detach_delete(nodes, rels, nodes.where("name = 'c'"), key="element_id")
    assert sorted(r["name"] for r in kept.collect()) == ["a", "b"] and rest.count() == 1
    nested = spark.sql("SELECT named_struct('a', named_struct('b', 1)) AS rec")
    with pytest.raises(TypeError):
        writes.create_from_record(nested, "rec", "X", F.lit("x"))


def test_units_of_work(spark):
    root = scratch_path(spark, "test-unit")
    assert writes.snapshot(spark, root) == {}
    with writes.transact(spark, root) as unit:
        unit.write("people", spark.range(3))
        unit.write("cats", spark.range(1))
        assert writes.snapshot(spark, root) == {}
    with pytest.raises(RuntimeError):
        with writes.transact(spark, root) as unit:
            unit.write("people", spark.range(100))
            raise RuntimeError("cancelled")
    assert {k: v.count() for k, v in writes.snapshot(spark, root).items()} == {"people": 3, "cats": 1}
    with writes.transact(spark, root) as unit:
        unit.write("people", spark.range(5))
    assert {k: v.count() for k, v in writes.snapshot(spark, root).items()} == {"people": 5, "cats": 1}


def test_summaries(spark):
    rows, summary = results.with_summary(spark.range(7), "s", n=F.count(F.lit(1)), top=F.max("id"))
    results.void(rows)
    assert summary.get == {"n": 7, "top": 6}
    done = writes.write_with_summary(spark.range(4), scratch_path(spark, "test-summary"), "CREATE")
    assert (done.query, done.counters) == ("CREATE", {"nodes_created": 4})


def test_stream_publishes_each_batch_once(spark):
    source, root = scratch_path(spark, "test-source"), scratch_path(spark, "test-stream")
    streams.chunked(spark.range(0, 1000, 1, 1), source, rows_per_file=256)
    stream = streams.records(spark, source, spark.range(1).schema, files_per_batch=1)

    def stop_at_third(batch_id):
        if batch_id == 2:
            raise RuntimeError("cancelled")

    with pytest.raises(Exception, match="cancelled"):
        streams.publish(stream, root, "ids", f"{root}-checkpoint", before_commit=stop_at_third)
    seen = streams.published_batches(spark, root, "ids").count()
    assert 0 < seen < 1000
    streams.publish(stream, root, "ids", f"{root}-checkpoint")
    ids = streams.published_batches(spark, root, "ids")
    assert (ids.count(), ids.distinct().count()) == (1000, 1000)


def test_stream_decode_equals_batch(spark, folder):
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    shape = records.named({"user": ("user_id", scalars.long)})
    stream = streams.decoded(streams.records(spark, folder, schema, "events.parquet"), shape, ["event_id"])
    path = scratch_path(spark, "test-decode")
    streams.collect_into(stream, path, f"{path}-checkpoint")
    batch = decode(spark.read.parquet(f"{folder}/events.parquet"), shape, ["event_id"])
    landed = spark.read.parquet(path)
    assert landed.exceptAll(batch).count() == 0 and landed.count() == batch.count()


def test_fields_of_paths(spark):
    node = lambda i: F.struct(F.lit(i).alias("element_id"), F.lit(i).cast("string").alias("name"))
    rel = lambda i: F.struct(F.lit(i).alias("element_id"), F.lit(i).alias("rel_type"))
    two = paths.path_value(node("a"), [(rel("r"), node("b")), (rel("s"), node(None))])
    part = paths.path_value(node("a"), [(rel("r"), node("b")), (rel(None), node("c"))], optional=True)
    none = paths.path_value(node("a"), [(rel(None), node("b"))], optional=True)
    for path, whole in ((two, ["a", "b", None]), (part, ["a", "b"]), (none, ["a"])):
        row = spark.range(1).select(
            paths.path_nodes(path, "name").alias("nodes"), paths.path_end(path, "name").alias("end"),
            paths.path_relationships(path, "rel_type").alias("types"), paths.path_length(path).alias("n"),
            paths.path_nodes(path).alias("all"), paths.path_end(path)["name"].alias("last"),
        ).first()
        assert row.nodes == whole == [x.name for x in row["all"]] and row.end == whole[-1] == row["last"]
        assert row.types == ["r", "s"][: len(whole) - 1] and row.n == len(whole) - 1


def test_path_accessors_read_keys_alone(spark, folder):
    plan = QUERIES["path_accessors"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    read = {c.split(":")[0] for schema in re.findall(r"ReadSchema: struct<(\S*)>", plan) for c in schema.split(",")}
    assert read == {"c_custkey", "o_orderkey", "o_custkey", "l_orderkey", "l_partkey", "p_partkey"}
