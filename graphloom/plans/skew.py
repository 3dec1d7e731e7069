"""Joins where one key may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one key that a task should hold at most; a key with more is hot and is dealt into so many salts.
ROWS_PER_TASK = 200_000
# No key below this share of the rows is hot, so there are at most a million hot keys in any data.
LEAST_SHARE = 1e-6


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Hot keys with the number of their ``salts``: a bounded list, whatever the data.

    Rows are counted per key before the shuffle, so finding hot keys is itself not skewed.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("_n"))
    limit = df.agg(F.greatest(F.lit(rows_per_task), F.count("*") * F.lit(LEAST_SHARE)).alias("_limit"))
    salts = F.ceil(F.col("_n") / F.lit(rows_per_task)).cast("int").alias("salts")
    return counts.where(F.col("_n") > limit.scalar()).select(key, salts)


def salted_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, hot: DataFrame) -> DataFrame:
    """Inner join that spreads the left rows of hot keys over several tasks.

    Left rows of a hot key get a salt made from the whole row; right rows of a hot key are repeated
    once per salt of the key. Other rows join as usual. ``hot`` comes from ``hot_keys`` and has a fixed
    bound on its size, which is why it may be broadcast.
    """
    tag = F.broadcast(hot.select(F.col(hot.columns[0]).alias("_hot_key"), F.col("salts").alias("_salts")))
    row = F.xxhash64(*left.columns)
    l = left.join(tag, F.col(left_key) == F.col("_hot_key"), "left").withColumn(
        "_salt", F.when(F.col("_hot_key").isNotNull(), F.pmod(row, F.col("_salts")).cast("int")).otherwise(0)
    ).drop("_hot_key", "_salts")
    salts = F.when(F.col("_hot_key").isNotNull(), F.sequence(F.lit(0), F.col("_salts") - 1)).otherwise(F.array(F.lit(0)))
    r = (
        right.join(tag, F.col(right_key) == F.col("_hot_key"), "left")
        .withColumn("_rsalt", F.explode(salts))
        .drop("_hot_key", "_salts")
    )
    return l.join(r, (F.col(left_key) == F.col(right_key)) & (F.col("_salt") == F.col("_rsalt"))).drop(
        "_salt", "_rsalt"
    )
