"""File streams over the events and documents tables, each run until all present files are read."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.catalog.registry import query
from graphloom.functions import records, scalars
from graphloom.functions.decoder import decode, error_text, strict
from graphloom.operators import results, writes
from graphloom.session import scratch_path
from graphloom.sources.tables import table
from graphloom.streaming import streams


def _stream(spark, d, name):
    return streams.records(spark, d, table(spark, d, name).schema, f"{name}.parquet")


def _landed(spark, stream, name):
    """The rows of a stream after it has run."""
    path = scratch_path(spark, name)
    streams.collect_into(stream, path, f"{path}-checkpoint")
    return spark.read.schema(stream.schema).parquet(path)


def _event_shape():
    return records.named({
        "user": ("user_id", scalars.long), "type": ("event_type", scalars.string), "amount": ("value", scalars.double),
    })


@query(
    "stream_decode",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS user,
              CASE WHEN event_type <> 'error' THEN event_type END AS type,
              CASE WHEN event_type <> 'error' THEN value END AS amount,
              CASE WHEN event_type = 'error' THEN 'error is not expected for field ''event_type''' END AS problem
       FROM events""",
)
def stream_decode(spark, d):
    """Rows that do not decode land with their errors."""
    fine = scalars.string.ensure(lambda v: v != "error", lambda v: F.concat(v, F.lit(" is not expected")))
    shape = records.named({
        "user": ("user_id", scalars.long), "type": ("event_type", fine), "amount": ("value", scalars.double),
    })
    decoded = streams.decoded(_stream(spark, d, "events"), shape, ["event_id"])
    landed = _landed(spark, decoded, "stream-decode")
    fields = [F.when(F.size("errors") == 0, F.col(f"value.{f}")).alias(f) for f in ("user", "type", "amount")]
    return landed.select("event_id", *fields, error_text(F.col("errors")).alias("problem"))


@query(
    "stream_chunks",
    "SELECT event_type, count(*) AS n, max(event_id) AS last_id, 4 AS batches FROM events GROUP BY event_type",
)
def stream_chunks(spark, d):
    """Eight files, two per pull."""
    source = scratch_path(spark, "chunks")
    events = table(spark, d, "events").select("event_id", "event_type")
    events.repartition(8, "event_id").write.parquet(source)
    stream = streams.records(spark, source, events.schema, files_per_batch=2)
    root = scratch_path(spark, "chunks-out")
    streams.publish(stream, root, "events", f"{root}-checkpoint")
    batches = spark.read.json(f"{root}/manifest/*").select("version").distinct().count()
    return streams.published_batches(spark, root, "events").groupBy("event_type").agg(
        F.count("*").alias("n"), F.max("event_id").alias("last_id"), F.lit(batches).alias("batches")
    )


@query(
    "stream_with_summary",
    """SELECT event_type, count(*) AS n, 'events' AS name, (SELECT count(*) FROM events) AS records
       FROM events GROUP BY event_type""",
)
def stream_with_summary(spark, d):
    path = scratch_path(spark, "stream-summary")
    stream = _stream(spark, d, "events").select("event_id", "event_type")
    rows, summary = streams.run_with_summary(stream, "events", "records", path, f"{path}-checkpoint")
    told = summary.first()
    return rows.groupBy("event_type").agg(
        F.count("*").alias("n"), F.lit(told["name"]).alias("name"), F.lit(told["records"]).alias("records")
    )


@query("stream_map", "SELECT event_id, upper(event_type) AS type FROM events")
def stream_map(spark, d):
    mapped = _stream(spark, d, "events").select("event_id", F.upper("event_type").alias("type"))
    return _landed(spark, mapped, "stream-map")


@query("stream_eval_map", "SELECT event_id, user_id AS user, value AS amount FROM events")
def stream_eval_map(spark, d):
    """A step that may fail: a row that does not decode stops the stream."""
    checked = strict(decode(_stream(spark, d, "events"), _event_shape(), ["event_id"]))
    return _landed(spark, checked, "stream-eval").select("event_id", "value.user", "value.amount")


@query(
    "stream_flat_map",
    "SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents",
)
def stream_flat_map(spark, d):
    words = _stream(spark, d, "documents").select("doc_id", F.explode(F.split("text", " ", -1)).alias("word"))
    return _landed(spark, words, "stream-flat-map")


@query("stream_collect", "SELECT event_id, value FROM events WHERE event_type = 'purchase' AND value > 10")
def stream_collect(spark, d):
    kept = _stream(spark, d, "events").where("event_type = 'purchase' AND value > 10").select("event_id", "value")
    return _landed(spark, kept, "stream-collect")


@query(
    "stream_append",
    """SELECT 'left' AS side, c_custkey AS key, c_name AS name FROM customer
       UNION ALL SELECT 'right', s_suppkey, s_name FROM supplier""",
)
def stream_append(spark, d):
    """Two streams as one; the side tag tells them apart, since Spark keeps no order between them."""
    left = _stream(spark, d, "customer").select(F.lit("left").alias("side"), F.col("c_custkey").alias("key"),
                                                 F.col("c_name").alias("name"))
    right = _stream(spark, d, "supplier").select(F.lit("right").alias("side"), F.col("s_suppkey").alias("key"),
                                                  F.col("s_name").alias("name"))
    return _landed(spark, left.union(right), "stream-append")


@query("stream_collect_as", "SELECT DISTINCT user_id, event_type FROM events")
def stream_collect_as(spark, d):
    """A stream collected into a set: batches land as rows, copies are dropped when the set is read."""
    pairs = _stream(spark, d, "events").select("user_id", "event_type")
    return results.as_set(_landed(spark, pairs, "stream-set"))


@query("stream_void", "SELECT count(*) AS records, max(event_id) AS last_id FROM events")
def stream_void(spark, d):
    """Run for effect; what the dropped rows were is observed in the run itself."""
    counters = F.count(F.lit(1)).alias("records"), F.max("event_id").alias("last_id")
    seen = streams.void(_stream(spark, d, "events"), scratch_path(spark, "stream-void"), *counters)
    return spark.createDataFrame(seen, "records bigint, last_id bigint").agg(
        F.sum("records").alias("records"), F.max("last_id").alias("last_id")
    )


@query("stream_single", "SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 1")
def stream_single(spark, d):
    """The first record; a stream takes one even where there are more."""
    rows = _landed(spark, _stream(spark, d, "events").select("event_id", "event_type"), "stream-single")
    return results.single(rows.orderBy("event_id"), lenient=True)


@query("stream_guarantee", "SELECT event_id, event_type FROM events")
def stream_guarantee(spark, d):
    """A run that fails before its commit shows nothing; run again, every row is there once."""
    root = scratch_path(spark, "guarantee")
    stream = _stream(spark, d, "events").select("event_id", "event_type")

    def fail(batch_id):
        raise RuntimeError("stopped before commit")

    try:
        streams.publish(stream, root, "events", f"{root}-checkpoint", before_commit=fail)
    except Exception as e:
        if "stopped before commit" not in str(e):
            raise
    if writes.snapshot(spark, root):
        raise AssertionError("rows of a failed batch are visible")
    streams.publish(stream, root, "events", f"{root}-checkpoint")
    return streams.published_batches(spark, root, "events")
