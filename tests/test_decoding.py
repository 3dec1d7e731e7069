"""Decoding of single rows: values, exact error texts, and the rules behind them."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from graphloom.functions import collections as coll
from graphloom.functions import records, scalars, temporal, unions, validate
from graphloom.functions.cells import column_of
from graphloom.functions.decoder import combine, constant, decode, error_text, split, strict


def run(spark, sql, decoder, column=None):
    df = spark.sql(sql)
    cell = column_of(df, column) if column else None
    row = decode(df, decoder, cell=cell).withColumn("text", error_text(F.col("errors"))).first()
    return row["value"], row["text"]


def plain(value):
    """Rows as tuples, lists kept."""
    if isinstance(value, tuple) and hasattr(value, "asDict"):
        return tuple(plain(v) for v in value)
    if isinstance(value, list):
        return [plain(v) for v in value]
    return value


@pytest.mark.parametrize(
    "sql, decoder, expected",
    [
        ("SELECT 3", scalars.integer, 3),
        ("SELECT 3", scalars.short, 3),
        ("SELECT 3", scalars.byte, 3),
        ("SELECT 3", scalars.long, 3),
        ("SELECT 3.0D", scalars.single, 3.0),
        ("SELECT 3.0D", scalars.double, 3.0),
        ("SELECT 3000000000", scalars.integer, 3000000000 - 2**32),
        ("SELECT 70000", scalars.short, 4464),
        ("SELECT 200", scalars.byte, -56),
        ("SELECT 1e20D", scalars.integer, 2**31 - 1),
        ("SELECT -1e20D", scalars.integer, -(2**31)),
        ("SELECT 1e20D", scalars.short, -1),
        ("SELECT -2.9D", scalars.integer, -2),
        ("SELECT double('NaN')", scalars.integer, 0),
        ("SELECT 1e30D", scalars.long, 2**63 - 1),
        ("SELECT true", scalars.boolean, True),
        ("SELECT 'foo'", scalars.string, "foo"),
        ("SELECT X'010305'", scalars.binary, bytearray([1, 3, 5])),
        ("SELECT 'D18E9810-87ad-444c-871e-7e41e0e4623c'", scalars.uuid, "d18e9810-87ad-444c-871e-7e41e0e4623c"),
        ("SELECT X'010203'", scalars.uuid, "5289df73-7df5-3326-bcdd-22597afb1fac"),
    ],
)
def test_scalars(spark, sql, decoder, expected):
    value, text = run(spark, sql, decoder)
    assert text is None and value == expected


@pytest.mark.parametrize(
    "raw", [b"\xff", b"\x00\xff", b"\x80" + bytes(7), b"\x7f" + b"\xff" * 7, b"\x01" + bytes(8), b"\xff" + bytes(8),
            b"\x00" * 18 + b"\x05", b"\xff" * 20 + b"\x85", b"\x12" * 15, b"\xed" * 15]
)
def test_big_integer_from_bytes(spark, raw):
    value, text = run(spark, f"SELECT X'{raw.hex()}'", scalars.big_integer)
    assert text is None and int(value) == int.from_bytes(raw, "big", signed=True)


@pytest.mark.parametrize("raw", ["7F" + "FF" * 15, "0080" + "00" * 15, "01" + "00" * 18, ""])
def test_big_integer_too_wide(spark, raw):
    assert run(spark, f"SELECT X'{raw}'", scalars.big_integer) == (None, "The integer needs more than 38 digits")


def test_big_numbers(spark):
    assert str(run(spark, "SELECT '-12'", scalars.big_integer)[0]) == "-12"
    assert run(spark, "SELECT '1.5'", scalars.big_integer)[1] == "Couldn't create a BigInt from 1.5"
    assert run(spark, "SELECT 1.5D", scalars.big_integer, "1.5")[1] == "Couldn't decode Decimal(1.5) into a BigInt"
    assert float(run(spark, "SELECT 0.1D", scalars.big_decimal)[0]) == 0.1
    assert run(spark, "SELECT 'x'", scalars.big_decimal)[1] == "Couldn't create a BigDecimal from x"
    for text in ("'1.0000000000000000009'", "'1e-20'", "'12345678901234567890123'", "1e-20D", "1.2345678901234567e-5D"):
        assert "Couldn't create a BigDecimal" in run(spark, f"SELECT {text}", scalars.big_decimal)[1]
    for text in ("'1.500000000000000000000000'", "'0e-40'", "'200e-20'", "'1e3'", "'-.5'"):
        assert run(spark, f"SELECT {text}", scalars.big_decimal)[1] is None


def test_rejections_name_the_value(spark):
    assert run(spark, "SELECT 'foo' AS x", scalars.integer, "x")[1] == "Couldn't decode Str(foo) into a int"
    assert run(spark, "SELECT 5 AS x", scalars.string, "x")[1] == "Couldn't decode Integer(5) into a String"
    assert run(spark, "SELECT CAST(NULL AS INT) AS x", scalars.integer, "x")[1] == (
        "Couldn't decode NullValue into a int"
    )
    assert run(spark, "SELECT 'a' AS x, 2 AS y", scalars.integer)[1] == (
        "Couldn't decode Map(x -> Str(a), y -> Integer(2)) into a int"
    )


def test_missing_key_reports_both_errors(spark):
    _, text = run(spark, "SELECT 1 AS a", records.named({"a": scalars.integer, "z": scalars.string}))
    assert text == "Multiple decoding errors:\nCouldn't decode NullValue into a String\nField 'z' not found\n"


def test_field_name_is_added_once_per_level(spark):
    bad_name = "Couldn't decode Str(Charlize Theron) into a int for field 'name'"
    assert run(spark, "SELECT named_struct('name', 'Charlize Theron') AS r", records.field("name", scalars.integer))[1] == bad_name
    assert run(spark, "SELECT parse_json('{\"name\": \"Charlize Theron\"}') AS r", records.field("name", scalars.integer))[1] == bad_name
    nested = records.field("r", records.field("name", scalars.integer))
    _, text = run(spark, "SELECT named_struct('name', 'x', 'age', 1) AS r, 1 AS other", nested)
    assert text == "Couldn't decode Str(x) into a int for field 'name' for field 'r'"


def test_custom_check_names_the_field(spark):
    identity = scalars.integer.ensure(
        lambda v: v >= 0, lambda v: F.concat(v.cast("string"), F.lit(" is not a valid ID because is negative"))
    )
    shape = records.named({"id": identity, "data": scalars.string})
    assert run(spark, "SELECT 1 AS id, 'foo' AS data", shape) == ((1, "foo"), None)
    assert run(spark, "SELECT -1 AS id, 'foo' AS data", shape)[1] == (
        "-1 is not a valid ID because is negative for field 'id'"
    )


def test_tuples_and_records(spark):
    assert run(spark, "SELECT 25, 'Luis'", records.tuple_of(scalars.integer, scalars.string))[0] == (25, "Luis")
    five = records.tuple_of(
        scalars.integer, scalars.boolean, coll.list_of(scalars.integer), scalars.double,
        coll.option(coll.set_of(scalars.long)),
    )
    assert plain(run(spark, "SELECT 5, true, array(0, 10), 3.5D, null", five)[0]) == (5, True, [0, 10], 3.5, None)
    user = {"name": scalars.string, "age": scalars.integer}
    assert run(spark, "SELECT 25 AS age, 'Luis' AS name", records.product_named(user))[0] == ("Luis", 25)
    assert run(spark, "SELECT 'Luis', 25", records.product(user))[0] == ("Luis", 25)
    optional = {"a": scalars.integer, "b": coll.option(scalars.string)}
    assert run(spark, "SELECT 1 AS a", records.product_named(optional))[0] == (1, None)
    assert run(spark, "SELECT 1", records.product(optional))[0] == (1, None)
    renamed = records.named({"name": ("personName", scalars.string), "age": ("personAge", scalars.integer)})
    assert run(spark, "SELECT 'Luis' AS personName, 25 AS personAge", renamed)[0] == ("Luis", 25)


def test_split_merge_default_nest(spark):
    divided = records.named({"id": scalars.integer, "data": records.tuple_of(scalars.string, scalars.integer)})
    assert plain(run(spark, "SELECT 1 AS id, parse_json('[\"foo\", 5]') AS data", divided)[0]) == (1, ("foo", 5))
    defaults = records.named({"id": scalars.integer, "n": records.with_default(scalars.integer, F.lit(0))})
    assert run(spark, "SELECT 1 AS id", defaults)[0] == (1, 0)
    nested = combine({
        "foo": records.named({"a": scalars.integer, "b": scalars.string}),
        "bar": records.named({"c": scalars.integer, "d": scalars.string}),
    })
    assert plain(run(spark, "SELECT 3 AS a, 'foo' AS b, 5 AS c, 'bar' AS d", nested)[0]) == ((3, "foo"), (5, "bar"))


def test_option_and_either(spark):
    assert run(spark, "SELECT 10", coll.option(scalars.integer)) == (10, None)
    assert run(spark, "SELECT null", coll.option(scalars.integer)) == (None, None)
    assert run(spark, "SELECT 'x'", coll.option(scalars.integer), "x")[1] == "Couldn't decode Str(x) into a int"
    assert run(spark, "SELECT parse_json('null') AS x", coll.option(scalars.integer), "x") == (None, None)
    both = coll.either(scalars.integer, scalars.string)
    assert run(spark, "SELECT 5", both)[0] == (5, None)
    assert run(spark, "SELECT 'Luis'", both)[0] == (None, "Luis")
    assert run(spark, "SELECT true AS x", both, "x")[1] == (
        "Multiple decoding errors:\nCouldn't decode Bool(true) into a int\nCouldn't decode Bool(true) into a String\n"
    )


def test_lists(spark):
    assert run(spark, "SELECT array(1, 2, 3)", coll.list_of(scalars.integer))[0] == [1, 2, 3]
    assert run(spark, "SELECT array(array(1, 2), array(3, 4))", coll.list_of(coll.list_of(scalars.integer)))[0] == [
        [1, 2], [3, 4],
    ]
    assert run(spark, "SELECT named_struct('foo', 1, 'bar', 3, 'baz', 5) AS m", coll.list_of(scalars.integer))[0] == [1, 3, 5]
    # The first failing element decides; fields of a record would add up.
    _, text = run(spark, "SELECT parse_json('[1, \"a\", true]') AS x", coll.list_of(scalars.integer), "x")
    assert text == "Couldn't decode Str(a) into a int"
    assert run(spark, "SELECT array(1) AS x", coll.element_at(3, scalars.integer), "x")[1] == "Field 'index-3' not found"
    assert run(spark, "SELECT CAST(array() AS array<int>) AS x", coll.lone_element(scalars.integer), "x")[1] == (
        "Values was empty"
    )
    assert run(spark, "SELECT array(7, 8)", coll.lone_element(scalars.integer))[0] == 7
    assert run(spark, "SELECT array(3, 1, 3)", coll.sorted_set_of(scalars.integer))[0] == [1, 3]


def test_maps(spark):
    pairs = coll.pairs_map(scalars.integer, scalars.string)
    value, _ = run(spark, "SELECT parse_json('[[3, \"c\"], [1, \"a\"], [2, \"b\"], [1, \"z\"]]') AS v", pairs)
    assert plain(value) == [(1, "z"), (2, "b"), (3, "c")]
    objects = coll.object_map(coll.object_map(scalars.integer))
    value, _ = run(spark, "SELECT parse_json('{\"foo\": {\"bar\": 1, \"baz\": 3}, \"quax\": {\"haux\": 5}, \"faux\": {}}') AS v", objects)
    assert dict((k, dict(plain(v))) for k, v in plain(value)) == {
        "foo": {"bar": 1, "baz": 3}, "quax": {"haux": 5}, "faux": {},
    }
    strict_keys = coll.object_map(scalars.integer, validate.enum_keys(["foo"]))
    _, text = run(spark, "SELECT map('bar', 'x') AS m", strict_keys, "m")
    # A bad key and a bad value of the same entry are both reported. The sole entry is no object itself.
    assert text == "Multiple decoding errors:\nError decoding key: 'bar'\nCouldn't decode Str(x) into a int\n"
    custom = coll.KeyDecoder().imap(F.lower, F.upper, accepts=lambda k: F.upper(k).isin("FOO", "BAR"))
    assert plain(run(spark, "SELECT map('foo', 3, 'bar', 5) AS m", coll.object_map(scalars.integer, custom))[0]) == [
        ("FOO", 3), ("BAR", 5),
    ]


def test_one_key_records_are_unwrapped_once(spark):
    assert run(spark, "SELECT map('only', 5) AS m", scalars.integer, "m") == (5, None)
    assert run(spark, "SELECT parse_json('{\"only\": 5}') AS m", scalars.integer, "m") == (5, None)
    assert run(spark, "SELECT parse_json('{\"a\": {\"b\": 5}}') AS m", scalars.integer, "m")[1].startswith(
        "Couldn't decode Map("
    )


def test_unions(spark):
    node = """SELECT named_struct('element_id', 'n', 'labels', array('node', 'error'), 'properties',
                                  named_struct('msg', 'foo', 'code', 1)) AS n"""
    by_label = unions.by_label({
        "Unknown": constant(F.lit(True)), "Error": records.named({"msg": scalars.string}),
        "node": constant(F.lit(0)),
    })
    value, _ = run(spark, node, by_label, "n")
    assert value["case"] == "Error" and value["Error"]["msg"] == "foo"
    assert run(spark, node, unions.by_label({"x": constant(F.lit(1))}), "n")[1] == (
        "Unexpected node labels: Set(node, error)"
    )
    rel = """SELECT named_struct('element_id', 'r', 'rel_type', 'warning', 'properties', named_struct('msg', 'bar'),
                                 'src', 'a', 'dst', 'b') AS r"""
    value, _ = run(spark, rel, unions.by_type({"WARNING": records.field("msg", scalars.string)}), "r")
    assert (value["case"], value["WARNING"]) == ("WARNING", "bar")
    by_field = unions.derive_union({"Error": None, "Unknown": None})
    assert run(spark, "SELECT named_struct('type', 'Unknown', 'data', 10) AS r", by_field, "r")[0]["case"] == "Unknown"
    assert run(spark, "SELECT named_struct('type', 'unknown', 'data', 10) AS r", by_field, "r")[1] == (
        "Unexpected field label: unknown"
    )


@dataclasses.dataclass
class Inner:
    a: int


@dataclasses.dataclass
class Outer:
    name: str
    opt: int | None
    either: int | str
    items: list[int]
    by_name: dict[str, int]
    inner: Inner


def test_derivation(spark):
    value, text = run(
        spark, """SELECT 'x' AS name, 'right' AS either, array(1L, 2L) AS items, map('k', 3) AS by_name,
                         named_struct('a', 1, 'b', 2) AS inner""", records.derive(Outer),
    )
    assert text is None
    assert plain(value)[:4] == ("x", None, (None, "right"), [1, 2])
    assert value["by_name"] == {"k": 3} and value["inner"]["a"] == 1
    schema = spark.sql("SELECT 1 AS a, 'x' AS b").schema
    assert run(spark, "SELECT 1L AS a, 'x' AS b", records.derive(schema))[0] == (1, "x")


def test_temporal(spark):
    local = "SELECT timestamp_ntz'2023-01-02 13:30:00.5' AS x"
    assert str(run(spark, local, temporal.date)[0]) == "2023-01-02"
    assert run(spark, local, temporal.time)[0]["nano_of_day"] == 48600500000000
    assert run(spark, local, temporal.zoned, "x")[1] == (
        "Couldn't decode LocalDateTime(2023-01-02T13:30:00.5) into a ZonedDateTime"
    )
    zoned = spark.sql("SELECT timestamp_ntz'2023-07-02 23:30:00' AS w").select(
        temporal.zoned_from_wall(F.col("w"), F.lit("Europe/Paris")).alias("z")
    )
    got = zoned.select(
        temporal.datetime(column_of(zoned, "z")).value.cast("string").alias("wall"),
        temporal.date(column_of(zoned, "z")).value.cast("string").alias("day"),
        temporal.offset_time(column_of(zoned, "z")).value.alias("offset"),
        F.unix_seconds(F.col("z.ts")).alias("instant"),
    ).first()
    assert (got["wall"], got["day"]) == ("2023-07-02 23:30:00", "2023-07-02")
    assert plain(got["offset"]) == (84600 * 10**9, 7200)
    assert got["instant"] == 1688333400
    parsed = spark.range(1).select(
        temporal.parse_local_time(F.lit("13:30")).alias("a"), temporal.parse_local_time(F.lit("24:00:00")).alias("b"),
        temporal.parse_zoned_time(F.lit("13:30:00.000000001-01:30")).alias("c"),
    ).first()
    assert parsed["a"][0] == 48600 * 10**9 and parsed["b"] is None
    assert plain(parsed["c"]) == (48600 * 10**9 + 1, -5400)


def test_durations(spark):
    sql = "SELECT named_struct('months', 1L, 'days', 2L, 'seconds', 3L, 'nanos', 4) AS d"
    assert plain(run(spark, sql, temporal.duration_time)[0]) == (172803, 4)
    assert plain(run(spark, sql, temporal.duration_period)[0]) == (1, 2)
    assert run(spark, sql, temporal.duration_nanos)[0] == 172803 * 10**9 + 4


def test_combinators(spark):
    recover = scalars.integer.transform(lambda d: type(d)(F.coalesce(F.when(d.ok, d.value), F.lit(-1)), F.array().cast(
        "array<struct<kind:string,field:string,message:string>>")))
    assert run(spark, "SELECT 'x' AS v", recover, "v") == (-1, None)
    both = scalars.integer.and_(scalars.string)
    assert run(spark, "SELECT true AS v", both, "v")[1].count("\n") == 3
    chosen = records.field("kind", scalars.string).flat_map(
        lambda k: [(k == "n", records.field("v", scalars.integer))], otherwise=scalars.integer
    )
    assert run(spark, "SELECT 'n' AS kind, 4 AS v", chosen) == (4, None)


def test_strict_stops_and_split_separates(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b'), (-3, 'c') AS t(id, data)")
    positive = scalars.integer.ensure(lambda v: v > 0, lambda v: F.concat(v.cast("string"), F.lit(" is too low")))
    decoded = decode(df, records.named({"id": positive, "data": scalars.string}))
    good, quarantine = split(decoded)
    assert sorted(r["value"]["id"] for r in good.collect()) == [1, 2]
    assert [r["errors"][0]["message"] for r in quarantine.collect()] == ["-3 is too low for field 'id'"]
    with pytest.raises(Exception, match="-3 is too low for field 'id'"):
        strict(decoded).collect()
    optional = records.named({"id": positive.map(lambda v: v)})
    nothing = decode(spark.sql("SELECT CAST(NULL AS INT) AS id"), optional)
    assert nothing.first()["errors"]  # a predicate that is null does not hold
    kept = decode(spark.sql("SELECT CAST(NULL AS STRING) AS s"), records.named({"s": scalars.string.transform(
        lambda d: type(d)(d.value, F.slice(d.errors, 1, 0))).ensure(lambda v: v > "", lambda v: F.concat(v, F.lit("!")))}))
    assert kept.first()["errors"][0]["message"] == "The predicate does not hold for null for field 's'"


def test_validated_types(spark):
    level = validate.closed_interval(scalars.integer, 1, 99)
    assert run(spark, "SELECT 5", level) == (5, None)
    assert run(spark, "SELECT 0", level)[1] == (
        "Left predicate of (!(0 < 1) && !(0 > 99)) failed: Predicate (0 < 1) did not fail."
    )
    assert run(spark, "SELECT 'Quax'", validate.enum_by_name(["Foo", "Bar", "Baz"]))[1] == "Error decoding key: 'Quax'"
    assert run(spark, "SELECT 10", validate.enum_by_value("E", {1: "A", 3: "B"}, scalars.integer))[1] == (
        "Couldn't decode 10 as E"
    )
    empty = "SELECT CAST(array() AS array<int>) AS x"
    assert run(spark, empty, validate.non_empty_list(scalars.integer))[1] == "NonEmptyList from an empty List"
    assert run(spark, empty, validate.non_empty_set(scalars.integer))[1] == "NonEmptySet from an empty Set"
    assert run(spark, "SELECT array(5, 1, 5)", validate.non_empty_set(scalars.integer))[0] == [1, 5]


def test_unused_columns_are_not_read(spark, folder):
    """Decoding two fields of a wide table reads two columns."""
    df = spark.read.parquet(f"{folder}/lineitem.parquet")
    decoded = decode(df, records.named({"l_tax": scalars.double, "l_returnflag": scalars.string}))
    plan = decoded._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_tax:double,l_returnflag:string>" in plan
