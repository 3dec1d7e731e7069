"""Shapes of a result: one record, rows, a set, a map, other collections, and its summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from graphloom.functions.decoder import MISSING_RECORD


def single(df: DataFrame, lenient: bool = False) -> DataFrame:
    """Exactly one record. None is an error; more than one is an error too unless ``lenient``."""
    few = df.limit(1 if lenient else 2)
    counted = few.agg(F.count("*").alias("n"), F.first(F.struct(*few.columns)).alias("record"))
    record = F.when(F.col("n") == 1, F.col("record")).otherwise(F.raise_error(F.lit(MISSING_RECORD)))
    return counted.select(record.alias("record")).select("record.*")


def as_set(df: DataFrame) -> DataFrame:
    return df.distinct()


def as_map(df: DataFrame, key: str, value: list[str], order: list[str]) -> DataFrame:
    """One row per key; the row that is last in ``order`` wins. Rows of a key are reduced before the shuffle."""
    last = F.max_by(F.struct(*value), F.struct(*order)).alias("last")
    return df.groupBy(key).agg(last).select(key, *[F.col(f"last.{v}").alias(v) for v in value])


def as_sorted_set(df: DataFrame, *by: str) -> DataFrame:
    return df.distinct().orderBy(*by)


def as_sorted_map(df: DataFrame, key: str, value: list[str], order: list[str]) -> DataFrame:
    return as_map(df, key, value, order).orderBy(key)


def collect_groups(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Collect a value per group as sorted (value, count) entries.

    Copies are counted before they are collected, so a group is as large as its distinct values,
    however many rows it has. Nulls are skipped. Where the distinct values of a group have no bound,
    keep the counted rows (``count_members``) instead.
    """
    counted = count_members(df, keys, value)
    entry = F.struct(F.col(value).alias("value"), F.col("n").alias("n"))
    return counted.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias(name))


def count_members(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The members of every group as rows, each with how often it occurs."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))


def append(left: DataFrame, right: DataFrame, seq_left: Column, seq_right: Column) -> DataFrame:
    """Left rows, then right rows; ``side`` and ``seq`` give the order to sort by."""
    a = left.select(F.lit("left").alias("side"), seq_left.alias("seq"), "*")
    b = right.select(F.lit("right").alias("side"), seq_right.alias("seq"), "*")
    return a.unionByName(b, allowMissingColumns=True)


def with_summary(df: DataFrame, name: str, **counters: Column) -> tuple[DataFrame, Observation]:
    """The rows and a summary of the same run; read ``summary.get`` after an action on the rows."""
    summary = Observation(name)
    wanted = counters or {"records": F.count(F.lit(1))}
    return df.observe(summary, *[c.alias(k) for k, c in wanted.items()]), summary


def void(df: DataFrame) -> None:
    """Run for effect; rows are dropped where they are made."""
    df.write.format("noop").mode("overwrite").save()
