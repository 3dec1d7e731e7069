"""Tables in the shared folder, sized broadcasts, words, and connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.session import checkpointed, scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: ASCII characters that are no part of a word once A-Z are lower case, and once a-z are upper case.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
BREAKS_UPPER = r"[\x00-\x2F\x3A-\x40\x5B-\x7F]"
#: Bytes of UTF-8 as they stand in a word: A-Z in lower case, a space for what is no part of a word.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
#: Rows of a few numbers that may be broadcast: some 32 MB at most.
BROADCAST_ROWS = 500_000
#: Rows of a few words to a file, where a table's rows are counted before it is written.
FILE_ROWS = 50_000
#: MB of a batch of rows on its way between the JVM and a Python worker; either holds several copies of it.
BATCH_MB = 2


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` written as a table in the shared folder and read again, so that a lost executor costs no recomputation.

    Where ``rows``, at least the number of rows, is given, a small table is laid into as few files as it needs instead
    of one for each shuffle partition.
    """
    path = scratch_path(df.sparkSession, name)
    if rows is not None:
        most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartition(min(1 + rows // FILE_ROWS, most))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """From now on the session hands Python workers batches of about ``BATCH_MB`` at most; a smaller bound stays.

    Spark's own bound is 10,000 rows or 64 MB, and what its copies took stays with the worker and the JVM's buffers.
    The rows and their order are the same.
    """
    bound = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    if _in_bytes(bound) > BATCH_MB << 20:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_MB}m")


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run``, whose task gives back what it has freed when it ends.

    A worker waits for its next task beside whatever else the executor does, and by itself keeps the most it ever had.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.pythonapi, "malloc_trim", None)  # glibc has it
            if trim:
                trim(0)

    return task


def _in_bytes(size: str) -> int:
    """A size as Spark's settings have it: 67108864, 64m, 64mb."""
    number = size.lower().removesuffix("b").rstrip("kmgtp")
    return int(number) << 10 * ("kmgtp".find(size.lower().removesuffix("b")[-1]) + 1)


def sized_broadcast(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df``, marked for broadcast if it was counted to have few rows; else joins shuffle it."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= BROADCAST_ROWS else df


def words(text: Column) -> Column:
    """Words of a text with A-Z in lower case; null has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower()), BREAKS), "")


def word_list(text: str | None) -> list[bytes]:
    """The same words as UTF-8, inside a task."""
    return (text or "").encode().translate(_WORD_BYTES).split()


def folded_words(text: Column) -> Column:
    """The same words, position by position, in upper case: equal words stay equal, and this is cheaper.

    Upper case is taken without regard to neighbours and never makes or removes a break.
    """
    return F.array_remove(F.split(F.upper(F.coalesce(text, F.lit(""))), BREAKS_UPPER), "")


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, or one like it that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def kept_rows(docs: DataFrame, judged: DataFrame, key: Column) -> DataFrame:
    """The rows of ``docs`` without those that ``judged`` (doc_id, key, kept) says are not kept, with all their columns.

    ``key`` is an expression over ``docs`` that names the text. Of kept rows that repeat doc_id and key one stays.
    """
    of, who, text, kept, n = (fresh_name(docs, x) for x in ("_of", "_id", "_text", "_kept", "_n"))
    judged = judged.groupBy(F.col("doc_id").alias(who), F.col("key").alias(text)).agg(
        F.max("kept").alias(kept), F.count(F.lit(1)).alias(n)
    )
    judged = stored(judged.where(~F.col(kept) | (F.col(n) > 1)), "judged")
    gone = judged.where(~F.col(kept)).select(who, text)
    again = judged.where(F.col(kept)).select(who, text)
    same = F.col("doc_id").eqNullSafe(F.col(who)) & (F.col(of) == F.col(text))
    rest = docs.withColumn(of, key).join(sized_broadcast(gone), same, "left_anti")
    several = again.count()
    if several:
        once = rest.join(sized_broadcast(again, several), same, "left_semi").dropDuplicates(["doc_id", of])
        rest = rest.join(sized_broadcast(again, several), same, "left_anti").unionByName(once)
    return rest.select(*docs.columns)


def components(links: DataFrame) -> DataFrame:
    """(v, c): the smallest vertex of the connected component, for each end of the links (a, b).

    Labels go along links and then jump to the label of the label, so rounds grow with the logarithm of a chain's
    length. The driver sees the number of changed labels only.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    label = stored(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("a"), F.min("b")).alias("c")), "labels")
    while True:
        told = both.join(label, both.b == label.v).groupBy("a").agg(F.min("c").alias("near"))
        lower = label.join(told, label.v == told.a, "left").select(
            "v", F.col("c").alias("was"), F.least("c", "near").alias("c")
        )
        jump = label.select(F.col("v").alias("at"), F.col("c").alias("far"))
        new = checkpointed(
            lower.join(jump, lower.c == jump["at"], "left").select("v", "was", F.least("c", "far").alias("c"))
        )
        label = new.select("v", "c")
        if new.where("c <> was").isEmpty():
            return label
