"""Arrays, maps and JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows_of_parallel_arrays(df: DataFrame, keep: list[str], arrays: list[str]) -> DataFrame:
    """One row per position of arrays that belong together; shorter and missing ones give nulls there, pos counts from 0."""
    types = dict(df.dtypes)
    whole = df.select(*keep, *[F.coalesce(F.col(a), F.array().cast(types[a])).alias(a) for a in arrays])
    x = whole.select(*keep, F.posexplode(F.arrays_zip(*arrays)).alias("pos", "z"))
    return x.select(*keep, "pos", *[F.col(f"z.{a}").alias(a) for a in arrays])


def merge_sum_maps(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """(keys, column): maps of counts of a group merged by adding. Null and empty maps add nothing.

    The entries are summed with partial aggregation, so a group of any size is never one list.
    """
    entries = df.select(*keys, F.explode(column).alias("k", "v")).groupBy(*keys, "k").agg(F.sum("v").alias("v"))
    return entries.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias(column))


def map_text(m: Column) -> Column:
    """A map as text with its keys in order, for comparison."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(m), lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"].cast("string")))), ",")


def inverted_index(df: DataFrame, key: str, values: str) -> DataFrame:
    """(value, n, keys): by value of an array column the keys that have it, in order; repeated values of a row count once."""
    x = df.select(F.col(key), F.explode(F.array_distinct(values)).alias("value"))
    return x.groupBy("value").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set(key)).alias("keys"))


def json_first(column: Column, *paths: str) -> Column:
    """The first of several JSON paths that holds something."""
    return F.coalesce(*[F.nullif(F.get_json_object(column, p), F.lit("")) for p in paths])


def lookup(m: Column, key: Column, default: object) -> Column:
    return F.coalesce(F.try_element_at(m, key), F.lit(default))
