"""Exact duplicates through an extendible-hash index on shared files.

The index has one head per hash key, with the number of rows that carry the key. Buckets own ranges of keys. The
directory starts with as many slots as the heads need on average and doubles while a bucket holds more heads than its
capacity; a bucket that is not overfull is pointed at by several slots after a doubling. A key is looked up by the
slot its first bits name, in the bucket the directory gives for it, and nowhere else. Rows of one key cannot be
split by more bits, so they are chained: the chain of a key has one link per different text, found by comparing the
texts themselves. Everything here is DataFrame functions.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import kept_rows, sized_broadcast, stored

#: Heads that a bucket may hold before it is split.
CAPACITY = 16_384
#: Bits of the key that the directory can use.
MAX_DEPTH = 40


def hash_key(text: Column) -> Column:
    return F.xxhash64(text)


def _slot(key: Column, depth: int) -> Column:
    """The first ``depth`` bits of the key."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def grow_directory(heads: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """The directory (slot, bucket, local_depth) of the heads and its depth. The driver sees counts only.

    Keys that agree in their first ``MAX_DEPTH`` bits stay in one bucket whatever its size.
    """
    depth = max(0, math.ceil(math.log2(max(1, heads.count()) / capacity)))
    rest, leaves = heads.select("key"), None
    while True:
        sizes = rest.groupBy(_slot(F.col("key"), depth).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
        sizes = stored(sizes, "bucket_sizes")
        over = sizes.where((F.col("n") > capacity) & F.lit(depth < MAX_DEPTH)).select("slot")
        full = sizes.join(over, "slot", "left_anti").select("slot", F.lit(depth).alias("local_depth"))
        leaves = full if leaves is None else leaves.union(full)
        n = over.count()
        if not n:
            break
        rest = rest.withColumn("slot", _slot(F.col("key"), depth)).join(sized_broadcast(over, n), "slot").select("key")
        depth += 1  # the directory doubles
    shift = F.lit(depth) - F.col("local_depth")
    first = F.expr(f"shiftleft(slot, {depth} - local_depth)")
    directory = leaves.select(
        F.explode(F.sequence(first, first + F.expr(f"shiftleft(1L, {depth} - local_depth)") - 1)).alias("slot"),
        first.alias("bucket"),
        (F.lit(depth) - shift).alias("local_depth"),
    )
    return stored(directory, "directory"), depth


@dataclass(frozen=True)
class Index:
    """The stored index: the directory (slot, bucket, local_depth), its depth, and the heads (bucket, key, n)."""

    directory: DataFrame
    depth: int
    heads: DataFrame

    def addressed(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with key) and the bucket that the slot of their key points at."""
        at = self.directory.select(F.col("slot").alias("_slot"), "bucket")
        return rows.join(sized_broadcast(at), _slot(F.col("key"), self.depth) == F.col("_slot"), "left").drop("_slot")


def build_index(docs: DataFrame, key: Callable[[Column], Column] = hash_key, capacity: int = CAPACITY) -> Index:
    """The stored index of ``docs`` (doc_id, text); its heads have bucket, key and n, the rows of the key.

    Heads are reduced before they are shuffled, so a text that fills a third of the table is one head. The task that
    writes a range of buckets owns them; within it heads are in the order of their keys.
    """
    heads = docs.groupBy(key(F.col("text")).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    heads = stored(heads, "heads")
    directory, depth = grow_directory(heads, capacity)
    index = Index(directory, depth, heads)
    owned = index.addressed(heads).select("bucket", "key", "n")
    owned = owned.repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key")
    return Index(directory, depth, stored(owned, "index"))


def chains(docs: DataFrame, index: Index, key: Callable[[Column], Column] = hash_key) -> DataFrame:
    """The links of each key that several rows carry: bucket, key, text, keep_id, size and links, the chain's length.

    A row looks its key up in its bucket. The links of a bucket are made where it is owned: grouping by bucket, key
    and text compares the bytes of the texts. It is begun before the shuffle, so of a text that many rows share each
    task sends one copy.
    """
    repeated = sized_broadcast(index.heads.where("n > 1").select(F.col("bucket").alias("b"), F.col("key").alias("k")))
    rows = index.addressed(docs.withColumn("key", key(F.col("text"))))
    rows = rows.join(repeated, (F.col("bucket") == F.col("b")) & (F.col("key") == F.col("k")), "left_semi")
    chain = rows.groupBy("bucket", "key", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("size"))
    chain = stored(chain, "chains")
    collided = chain.groupBy("bucket", "key").agg(F.count(F.lit(1)).alias("links")).where("links > 1")
    return chain.join(collided, ["bucket", "key"], "left").select(
        "bucket", "key", "text", "keep_id", "size", F.coalesce("links", F.lit(1)).alias("links")
    )


def exact_duplicates(
    docs: DataFrame, key: Callable[[Column], Column] = hash_key, capacity: int = CAPACITY
) -> DataFrame:
    """Each row of ``docs`` with the row of the same text that stays.

    Reads doc_id and text; other columns are ignored. A null text counts as empty, and empty texts are equal to each
    other. The largest doc_id stays; a null doc_id is smaller than all, and where all are null the rows carry a null
    keep_id and are kept. Rows that repeat both doc_id and text are one document and get the same answer. An empty
    table gives an empty result. Returns doc_id, keep_id, group_size, kept, text_sha256.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return answered(docs, build_index(docs, key, capacity), key)


def answered(docs: DataFrame, index: Index, key: Callable[[Column], Column] = hash_key) -> DataFrame:
    """What the index says of each row of ``docs`` (doc_id, text): a key that its bucket does not hold is alone."""
    chain = chains(docs, index, key)
    here = (F.col("bucket") == F.col("b")) & (F.col("key") == F.col("k"))
    alone = chain.where("links = 1").select(F.col("bucket").alias("b"), F.col("key").alias("k"), "keep_id", "size")
    rows = docs.select("doc_id", key(F.col("text")).alias("key"), F.sha2("text", 256).alias("text_sha256"))
    joined = index.addressed(rows).join(sized_broadcast(alone), here, "left").drop("b", "k", "bucket")
    clashing = stored(chain.where("links > 1").select(F.col("key").alias("k"), "text", "keep_id", "size"), "collisions")
    if not clashing.isEmpty():  # different texts under one key: the text decides
        link = clashing.select("k", F.col("text").alias("t"), "keep_id", "size")
        both = docs.withColumn("key", key(F.col("text"))).join(
            link, (F.col("key") == F.col("k")) & (F.col("text") == F.col("t"))
        )
        joined = joined.join(clashing.select("k").distinct(), F.col("key") == F.col("k"), "left_anti").unionByName(
            both.select("doc_id", "key", F.sha2("text", 256).alias("text_sha256"), "keep_id", "size")
        )
    lone = F.col("size").isNull()
    keep_id = F.when(lone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("doc_id") == keep_id, F.col("doc_id").isNull() & keep_id.isNull()).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one per different text, with all their columns.

    Of rows that repeat both doc_id and text, any one stays.
    """
    found = exact_duplicates(docs).where("group_size > 1").select("doc_id", F.col("text_sha256").alias("key"), "kept")
    return kept_rows(docs, found, F.sha2(F.coalesce("text", F.lit("")), 256))
