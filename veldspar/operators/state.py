"""Tables as state: seen lookups, upserts, versions, queues and receipts, all as snapshot rewrites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCEPTED = ("saved", "partial", "duplicate")


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key by the given order."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rn).filter("_rn = 1").drop("_rn")


def seen_lookup(batch: DataFrame, state: DataFrame, key: str, fallback: str, status: str = "status", seen_at: str = "last_seen_at", accepted: tuple[str, ...] = ACCEPTED) -> DataFrame:
    """batch with matched_by and is_seen. The key's latest row decides if there is one, else the fallback's; seen if its status is accepted."""
    one = latest(state.filter(F.col(key).isNotNull()), [key], F.col(seen_at).desc(), F.col(status)).select(F.col(key).alias("_k"), F.col(status).alias("_s1"))
    two = latest(state.filter(F.col(fallback).isNotNull()), [fallback], F.col(seen_at).desc(), F.col(status)).select(F.col(fallback).alias("_f"), F.col(status).alias("_s2"))
    x = batch.join(one, batch[key] == F.col("_k"), "left").join(two, batch[fallback] == F.col("_f"), "left")
    by = F.when(F.col("_k").isNotNull(), key).when(F.col("_f").isNotNull(), fallback)
    status_ = F.when(F.col("_k").isNotNull(), F.col("_s1")).otherwise(F.col("_s2"))
    return x.withColumn("matched_by", by).withColumn("is_seen", F.coalesce(status_.isin(*accepted), F.lit(False))).drop("_k", "_f", "_s1", "_s2")


def upsert(state: DataFrame, batch: DataFrame, key: str, columns: list[str], retry: str | None = None, status: str = "status") -> DataFrame:
    """The state after the batch: matched keys take the batch's columns, others are added.

    batch has one row per key. retry counts up on rows whose former status was 'failed'; new rows have 0.
    """
    s = state.select([F.col(c).alias(f"_s_{c}") for c in state.columns])
    b = batch.select(F.col(key).alias("_b_key"), *[F.col(c).alias(f"_b_{c}") for c in columns])
    x = s.join(b, F.col(f"_s_{key}") == F.col("_b_key"), "full_outer")
    hit = F.col("_b_key").isNotNull()
    out = []
    for c in state.columns:
        old = F.col(f"_s_{c}")
        if c == key:
            out.append(F.coalesce(old, F.col("_b_key")).alias(c))
        elif c == retry:
            again = F.when(hit & (F.col(f"_s_{status}") == "failed"), 1).otherwise(0)
            out.append((F.coalesce(old, F.lit(0)) + again).alias(c))
        elif c in columns:
            out.append(F.when(hit, F.col(f"_b_{c}")).otherwise(old).alias(c))
        else:
            out.append(old.alias(c))
    return x.select(*out)


def versions(batch: DataFrame, current: DataFrame | None, key: str, content: str, order: str) -> DataFrame:
    """batch with action: insert for a key's first row, new_version where the content differs from the one before, else duplicate.

    current holds each key's content so far. A batch may hold a key many times; each row is held against its predecessor.
    """
    w = Window.partitionBy(key).orderBy(order)
    x = batch
    before = F.lag(content).over(w)
    first = F.row_number().over(w) == 1
    if current is not None:
        now = current.select(F.col(key).alias("_k"), F.col(content).alias("_c"))
        x = x.join(now, x[key] == F.col("_k"), "left")
        known = F.when(first, F.col("_k").isNotNull()).otherwise(F.lit(True))
        before = F.when(first, F.col("_c")).otherwise(before)
    else:
        known = ~first
    action = F.when(~known, "insert").when(before.eqNullSafe(F.col(content)), "duplicate").otherwise("new_version")
    x = x.withColumn("_action", action)
    return x.select(*batch.columns, F.col("_action").alias("action"))


def rewrite_queue(queue: DataFrame, retried: DataFrame, failed_again: DataFrame, key: str) -> DataFrame:
    """The queue without what was retried, and what failed again with it."""
    return queue.join(retried.select(key).distinct(), key, "left_anti").unionByName(failed_again, allowMissingColumns=True)


def unconsumed(items: DataFrame, receipts: DataFrame, key: str, consumer: str, limit: int | None = None, order: list[str] | None = None) -> DataFrame:
    """Items without any receipt of a consumer. A limit is taken before receipts are looked at, by the given order."""
    x = items.orderBy(*order).limit(limit) if limit else items
    return x.join(receipts.filter(F.col("consumer") == consumer).select(key).distinct(), key, "left_anti")


def cached_calls(requests: DataFrame, cache: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(hits with the cached columns, misses): an exact-key cache as a join."""
    return requests.join(cache, key), requests.join(cache.select(key), key, "left_anti")
