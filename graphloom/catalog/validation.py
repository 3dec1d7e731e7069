"""Validated types."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.catalog.decoding import LINE, decode_columns, hundredths, order_lines
from graphloom.catalog.registry import query
from graphloom.functions import collections as coll
from graphloom.functions import decoder as dec
from graphloom.functions import records, scalars, validate
from graphloom.functions.cells import column_of
from graphloom.functions.decoder import decode, error_text
from graphloom.sources.tables import table


@query(
    "refine",
    """SELECT p_partkey, CASE WHEN p_size <= 25 THEN p_size END AS size,
              CASE WHEN p_size > 25 THEN 'Right predicate of (!(' || p_size || ' < 1) && !(' || p_size ||
                ' > 25)) failed: Predicate (' || p_size || ' > 25) did not fail.' END AS problem FROM part""",
)
def refine(spark, d):
    size = validate.closed_interval(scalars.integer, 1, 25)
    return decode_columns(table(spark, d, "part"), ["p_partkey"], size=("p_size", size), problem=("p_size", size, True))


@query(
    "validate_emap",
    """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance,
              CASE WHEN c_acctbal < 0 THEN c_acctbal::VARCHAR || ' is in debt for field ''c_acctbal''' END AS problem
       FROM customer""",
)
def validate_emap(spark, d):
    solvent = scalars.double.ensure(lambda v: v >= 0, lambda v: F.concat(v.cast("string"), F.lit(" is in debt")))
    got = decode(table(spark, d, "customer"), records.named({"balance": ("c_acctbal", solvent)}), ["c_custkey"])
    return got.select("c_custkey", "value.balance", error_text(F.col("errors")).alias("problem"))


@query("enum_by_name", """SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN event_type END AS entry,
       CASE WHEN event_type NOT IN ('click', 'view') THEN 'key' END AS kind,
       CASE WHEN event_type NOT IN ('click', 'view') THEN 'Error decoding key: ''' || event_type || '''' END AS problem
       FROM events""")
def enum_by_name(spark, d):
    events = table(spark, d, "events")
    got = decode(events, validate.enum_by_name(["click", "view"]), ["event_id"], column_of(events, "event_type"))
    return got.select("event_id", F.col("value").alias("entry"), F.get("errors", F.lit(0))["kind"].alias("kind"),
                      error_text(F.col("errors")).alias("problem"))


@query(
    "enum_by_value",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              CASE l_linenumber WHEN 1 THEN 'First' WHEN 3 THEN 'Third' WHEN 5 THEN 'Fifth' END AS entry,
              CASE WHEN l_linenumber NOT IN (1, 3, 5) THEN 'Couldn''t decode ' || l_linenumber || ' as Line' END AS problem,
              CASE l_returnflag WHEN 'R' THEN 'Returned' WHEN 'A' THEN 'Accepted' WHEN 'N' THEN 'None' END AS flag
       FROM lineitem""",
)
def enum_by_value(spark, d):
    line = validate.enum_by_value("Line", {1: "First", 3: "Third", 5: "Fifth"}, scalars.integer)
    flag = validate.enum_by_value("Flag", {"R": "Returned", "A": "Accepted", "N": "None"}, scalars.string)
    lines = order_lines(spark, d, line=F.col("l_linenumber"), flag=F.col("l_returnflag"))
    got = decode_columns(lines, LINE, entry=("line", line), problem=("line", line, True), flags=("flag", flag))
    return got.withColumnRenamed("flags", "flag")


@query(
    "enum_keys",
    """SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN event_type || '=' || user_id END AS entries,
              CASE WHEN event_type NOT IN ('click', 'view') THEN 'Error decoding key: ''' || event_type || '''' END AS problem
       FROM events""",
)
def enum_keys(spark, d):
    events = table(spark, d, "events").select("event_id", F.create_map("event_type", "user_id").alias("m"))
    mapped = coll.object_map(scalars.long, validate.enum_keys(["click", "view"]))
    shown = mapped.map(lambda es: F.concat_ws("=", es[0]["key"], es[0]["value"].cast("string")))
    return decode_columns(events, ["event_id"], entries=("m", shown), problem=("m", mapped, True))


@query(
    "custom_keys",
    """SELECT s_suppkey, 'KEY-' || upper(s_name || repeat('-x', 80)) || '=' || s_name AS decoded,
              lower(s_name || repeat('-x', 80)) AS encoded FROM supplier""",
)
def custom_keys(spark, d):
    """Keys converted on the way in, and back again on the way out."""
    keys = coll.KeyDecoder().imap(
        lambda k: F.lower(F.substr(k, F.lit(5))), lambda k: F.concat(F.lit("KEY-"), F.upper(k))
    )
    long_key = F.concat("s_name", F.lit("-x" * 80))
    held = table(spark, d, "supplier").select("s_suppkey", F.create_map(long_key, "s_name").alias("m"))
    entry = F.col("es")[0]
    return decode_columns(held, ["s_suppkey"], es=("m", coll.object_map(scalars.string, keys))).select(
        "s_suppkey", F.concat_ws("=", entry["key"], entry["value"]).alias("decoded"),
        keys.encode(entry["key"]).alias("encoded"),
    )


_HIGH = "list_filter(embedding, lambda x: x > 0.3::FLOAT)"


def _high(spark, d):
    high = F.filter("embedding", lambda x: x > F.lit(0.3).cast("float"))
    return table(spark, d, "embeddings").select("vec_id", high.alias("xs"))


def _non_empty(name, text, make):
    @query(
        name,
        f"""SELECT vec_id, CASE WHEN len({_HIGH}) > 0 THEN len({_HIGH})::INTEGER END AS n,
                   CASE WHEN len({_HIGH}) = 0 THEN '{text}' END AS problem FROM embeddings""",
    )
    def run(spark, d):
        kept = make(scalars.double)
        return decode_columns(_high(spark, d), ["vec_id"], n=("xs", kept.map(F.size)), problem=("xs", kept, True))

    return run


non_empty_list = _non_empty("non_empty_list", "NonEmptyList from an empty List", validate.non_empty_list)
non_empty_vector = _non_empty("non_empty_vector", "NonEmptyVector from an empty Vector", validate.non_empty_vector)
non_empty_chain = _non_empty("non_empty_chain", "NonEmptyChain from an empty Chain", validate.non_empty_chain)


@query(
    "non_empty_set",
    """WITH s AS (SELECT vec_id, list_sort(list_distinct(list_filter(
                    list_transform(embedding, lambda x: trunc((x * 100)::DOUBLE)::BIGINT), lambda y: y > 24))) AS xs
                  FROM embeddings)
       SELECT vec_id, CASE WHEN len(xs) > 0 THEN array_to_string(xs, ',') END AS items,
              CASE WHEN len(xs) = 0 THEN 'NonEmptySet from an empty Set' END AS problem FROM s""",
)
def non_empty_set(spark, d):
    high = hundredths(spark, d).select("vec_id", F.filter("xs", lambda x: x >= 25).alias("xs"))
    kept = validate.non_empty_set(scalars.long)
    return decode_columns(high, ["vec_id"], items=("xs", kept.map(lambda xs: F.array_join(xs, ","))), problem=("xs", kept, True))


_LAST_WORDS = """SELECT doc_id, word, max(i) - 1 AS last FROM (
                   SELECT doc_id, words[i] AS word, i FROM (
                     SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM (
                       SELECT doc_id, string_split(text, ' ') AS words
                       FROM documents))) GROUP BY doc_id, word"""


@query(
    "non_empty_pairs_map",
    f"""SELECT d.doc_id, entries, CASE WHEN entries IS NULL THEN 'NonEmptyMap from an empty Map' END AS problem
        FROM (SELECT doc_id FROM documents UNION ALL SELECT -1) d LEFT JOIN (
          SELECT doc_id, string_agg(word || '=' || last, ' ' ORDER BY word) AS entries FROM ({_LAST_WORDS})
          GROUP BY doc_id) w ON d.doc_id = w.doc_id""",
)
def non_empty_pairs_map(spark, d):
    """Every word with its last place; a row without words is added."""
    pairs = F.transform(F.split("text", " ", -1), lambda w, i: F.struct(w.alias("k"), i.alias("v")))
    docs = table(spark, d, "documents").select("doc_id", pairs.alias("pairs"))
    docs = docs.unionByName(spark.range(1).select(F.lit(-1).alias("doc_id"), F.slice(F.array(F.struct(
        F.lit("").alias("k"), F.lit(0).alias("v"))), 1, 0).alias("pairs")))
    kept = validate.non_empty_pairs_map(scalars.string, scalars.integer)
    text = kept.map(lambda es: F.array_join(
        F.transform(es, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), " "))
    return decode_columns(docs, ["doc_id"], entries=("pairs", text), problem=("pairs", kept, True))


@query(
    "non_empty_object_map",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN 'type=' || length(event_type) || ',user=' || user_id END AS entries,
              CASE WHEN event_type = 'error' THEN 'NonEmptyMap from an empty Map' END AS problem FROM events""",
)
def non_empty_object_map(spark, d):
    full = F.create_map(F.lit("user"), "user_id", F.lit("type"), F.length("event_type").cast("bigint"))
    empty = F.map_filter(full, lambda k, v: F.lit(False))
    events = table(spark, d, "events").select(
        "event_id", F.when(F.col("event_type") == "error", empty).otherwise(full).alias("m")
    )
    kept = validate.non_empty_object_map(scalars.long)
    text = kept.map(lambda es: F.array_join(
        F.transform(es, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ","))
    return decode_columns(events, ["event_id"], entries=("m", text), problem=("m", kept, True))


@query(
    "error_report",
    """SELECT kind, field, message, count(*) AS n FROM (
         SELECT 'incoercible' AS kind, 'discount' AS field,
                l_discount::VARCHAR || ' is too high for field ''discount''' AS message
         FROM lineitem WHERE l_discount > 0.05
         UNION ALL SELECT 'key', NULL, 'Error decoding key: ''' || l_returnflag || '''' FROM lineitem WHERE l_returnflag <> 'N'
         UNION ALL SELECT 'incoercible', NULL, 'Couldn''t decode NullValue into a int' FROM lineitem
         UNION ALL SELECT 'property_not_found', 'origin', 'Field ''origin'' not found' FROM lineitem)
       GROUP BY kind, field, message""",
)
def error_report(spark, d):
    """Every kind of error met while decoding the lines, counted; errors of the fields of a row add up."""
    discount = validate.refine(
        scalars.double, lambda v: v.between(0, 0.05), lambda v: F.concat(v.cast("string"), F.lit(" is too high"))
    )
    shape = records.named({
        "discount": discount, "l_returnflag": validate.enum_by_name(["N"]), "origin": scalars.integer,
    })
    lines = table(spark, d, "lineitem").select(F.col("l_discount").alias("discount"), "l_returnflag")
    return dec.error_report(decode(lines, shape))
