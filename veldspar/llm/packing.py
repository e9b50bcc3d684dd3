"""Filling fixed-capacity containers: first-fit decreasing over a tournament tree, in random groups."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import table
from .lines import WS

CAPACITY = 2048
#: Items of a group: large enough that its one badly filled container is lost among thousands.
GROUP_ITEMS = 40_000


def count_tokens(text: Column) -> Column:
    """Matches of [A-Za-z0-9_]+|[^\\sA-Za-z0-9_] in text, \\s being Unicode white space; null has none.

    Each run of word characters shrinks to one letter and white space goes, so the length is the count.
    """
    runs = F.regexp_replace(F.coalesce(text, F.lit("")), "[A-Za-z0-9_]+", "a")
    return F.length(F.regexp_replace(runs, f"[{WS}]+", "")).cast("long")


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each size, sizes falling. A tournament tree holds the largest room below each node."""
    leaves = 1
    while leaves < max(1, len(sizes)):
        leaves *= 2
    room = [capacity] * (2 * leaves)
    out = []
    for size in sizes:
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        out.append(node - leaves)
        room[node] -= size
        node //= 2
        while node:
            a, b = room[2 * node], room[2 * node + 1]
            best = a if a > b else b
            if room[node] == best:
                break
            room[node] = best
            node //= 2
    return out


def pack(items: DataFrame, key: str, size: str, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS, seed: int = 11) -> DataFrame:
    """(key, size, container_id, oversize): every item in one container of the capacity.

    Items go to groups by a hash of their key, so any source or bucket, however large,
    spreads over all groups. An item above the capacity has a container alone and is marked oversize.
    Null and negative sizes count as 0. Rows that share a key are packed each for itself. An empty table gives none.
    """
    x = items.select(F.col(key), F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("long").alias(size))
    n = x.count()
    groups = max(1, round(n / group_items))
    x = x.withColumn("_salt", F.xxhash64(F.lit(seed), F.col(key))).withColumn("_g", F.pmod("_salt", F.lit(groups)).cast("int"))
    schema = f"{key} {dict(x.dtypes)[key]}, {size} long, container_id string, oversize boolean"

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        g = int(pdf["_g"].iat[0])
        pdf = pdf.sort_values([size, "_salt"], ascending=[False, True], kind="stable")
        big = (pdf[size] > capacity).to_numpy()
        bins = first_fit_decreasing(pdf.loc[~big, size].tolist(), capacity)
        names = [f"{g}-x{i}" for i in range(int(big.sum()))] + [f"{g}-{b}" for b in bins]
        return pd.DataFrame({key: pdf[key].to_numpy(), size: pdf[size].to_numpy(), "container_id": names, "oversize": big})

    return x.groupBy("_g").applyInPandas(fill, schema)


def p8_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens): the stored count where there is one, else the count of the text."""
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce("n_tokens", count_tokens(F.col("text"))).alias("n_tokens"))


def p8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(p8_sizes(spark, sf_dir), "doc_id", "n_tokens")


def p8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", count_tokens(F.col("text")).alias("n_tokens"))


P8_TOKENS_SQL = r"""SELECT doc_id, CAST(len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^\s\x{0B}\x{1c}-\x{1f}\x{85}\p{Z}A-Za-z0-9_]')) AS BIGINT) AS n_tokens FROM documents"""
