"""Counts, latest rows, counters over logs and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def closed_domain_counts(df: DataFrame, column: str, values: list[str], other: str = "unknown") -> DataFrame:
    """(column, n) for every value of the domain and the other, with zeros; values outside it and nulls count as other."""
    folded = F.when(F.col(column).isin(*values), F.col(column)).otherwise(F.lit(other))
    n = df.groupBy(folded.alias(column)).agg(F.count(F.lit(1)).alias("n"))
    domain = df.sparkSession.createDataFrame([(v,) for v in [*values, other]], f"{column} string")
    return domain.join(n, column, "left").select(column, F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def two_level_counts(df: DataFrame, group: str, column: str) -> DataFrame:
    """(group, column, n): counts by group and value, and by value over all groups (group null)."""
    one = df.groupBy(group, column).agg(F.count(F.lit(1)).alias("n"))
    return one.unionByName(one.groupBy(column).agg(F.sum("n").alias("n")).withColumn(group, F.lit(None).cast(dict(df.dtypes)[group])))


def latest_first_wins(df: DataFrame, keys: list[str], time: Column, position: str) -> DataFrame:
    """The row of each key with the greatest time; of equal ones the first by position. Unreadable times are the earliest, rows without a key go."""
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(time.desc_nulls_last(), F.col(position).asc()))
    return df.withColumn("_rn", rn).filter("_rn = 1").drop("_rn")


def latest_last_wins(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """The last row of each key by position."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(position).desc()))
    return df.withColumn("_rn", rn).filter("_rn = 1").drop("_rn")


def last_n(df: DataFrame, keys: list[str], time: str, position: str, n: int) -> DataFrame:
    """The last n rows of each key by time and position, with back counting from 1."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(time).desc(), F.col(position).desc()))
    return df.withColumn("back", rn).filter(F.col("back") <= n)


def consecutive(df: DataFrame, keys: list[str], order: list[str], counts: Column, resets: Column, name: str = "streak") -> DataFrame:
    """df with the running count of rows that count since the last row that resets; rows that do neither carry it on."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    x = df.withColumn("_island", F.sum(F.when(resets, 1).otherwise(0)).over(w))
    v = Window.partitionBy(*keys, "_island").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return x.withColumn(name, F.sum(F.when(counts, 1).otherwise(0)).over(v)).drop("_island")


def carried(df: DataFrame, keys: list[str], order: list[str], when: Column, value: Column, name: str) -> DataFrame:
    """df with the latest value of a row that satisfies `when`, up to and with the row itself."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(F.when(when, value), ignorenulls=True).over(w))


def success_summary(latest: DataFrame, status: str, ok: list[str], transient: list[str]) -> DataFrame:
    """One row: totals, success rate and overall health of the latest rows.

    failed with failures and a rate under 0.7; degraded with transient ones or a rate from 0.7 to 0.9;
    healthy from 0.9; else failed.
    """
    s = F.col(status)
    x = latest.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(s.isin(*ok)).alias("success"), F.count_if(s.isin(*transient)).alias("transient"), F.count_if(~s.isin(*ok, *transient) | s.isNull()).alias("failed"),
    )
    rate = F.when(F.col("total") > 0, F.col("success") / F.col("total")).otherwise(0.0)
    x = x.withColumn("success_rate", F.round(rate, 6))
    r = F.col("success_rate")
    health = F.when((F.col("failed") > 0) & (r < 0.7), "failed").when((F.col("transient") > 0) | ((r >= 0.7) & (r < 0.9)), "degraded").when(r >= 0.9, "healthy").otherwise("failed")
    return x.withColumn("health", health)


def weighted_rank(df: DataFrame, first: str, first_weights: dict[str, int], second: str, second_weights: dict[str, int], position: str, n: int) -> DataFrame:
    """The n best rows by two weighted keys, then position; unknown keys weigh 99. The limit is the feature."""
    w = lambda c, m: F.coalesce(F.create_map(*[F.lit(v) for kv in m.items() for v in kv])[F.col(c)], F.lit(99))
    x = df.withColumn("_w1", w(first, first_weights)).withColumn("_w2", w(second, second_weights))
    return x.orderBy("_w1", "_w2", position).limit(n).drop("_w1", "_w2")


def best_attempt(df: DataFrame, keys: list[str], preference: Column, score: str, position: str) -> DataFrame:
    """The row of each key of the lowest preference class, then the highest score, then the last position."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(preference, F.col(score).desc_nulls_last(), F.col(position).desc()))
    return df.withColumn("_rn", rn).filter("_rn = 1").drop("_rn")


def multi_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(dimension, value, n): counts of each column's values in one pass; nulls are left out."""
    pairs = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("p")).select("p.*").filter("value is not null").groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("n"))


def day_rollup(df: DataFrame, keys: list[str], day: Column, measures: dict[str, Column], flags: dict[str, Column]) -> DataFrame:
    """One row per key and day: the greatest of each measure, whether any row has each flag, and the number of rows."""
    aggs = [F.max(c).alias(n) for n, c in measures.items()] + [F.coalesce(F.bool_or(c), F.lit(False)).alias(n) for n, c in flags.items()]
    return df.groupBy(*keys, day.alias("day")).agg(F.count(F.lit(1)).alias("runs"), *aggs)


def zero_filled(groups: DataFrame, key: str, df: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """(key, counts): conditional counts for every configured group, with zeros for those without a row."""
    n = df.groupBy(F.col(key).alias("_k")).agg(*[F.count_if(c).alias(name) for name, c in counts.items()])
    g = groups.select(key).distinct()
    return g.join(n, F.col(key) == F.col("_k"), "left").select(key, *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in counts])


def average(df: DataFrame, value: Column, name: str = "average") -> DataFrame:
    """One row: the mean, 0.0 for no rows; nulls don't count."""
    return df.agg(F.coalesce(F.avg(value), F.lit(0.0)).alias(name))


def latest_overall(df: DataFrame, field: str, position: str) -> DataFrame:
    """The one row of the greatest field as text, null as empty; of equal ones the first by position."""
    return df.orderBy(F.coalesce(F.col(field).cast("string"), F.lit("")).desc(), F.col(position).asc()).limit(1)


def last_rows_summary(df: DataFrame, position: str, status: str, values: list[str], key: str, n: int = 8) -> DataFrame:
    """One row: how many of the last n rows have each status, the number of distinct keys of all rows, and the last position."""
    last = df.orderBy(F.col(position).desc()).limit(n).agg(*[F.count_if(F.col(status) == v).alias(f"{v}_count") for v in values])
    whole = df.agg(F.count_distinct(key).alias("keys"), F.max(position).alias("last_position"))
    return last.join(whole, F.lit(True))


def yield_metrics(fetched: DataFrame, key: str, unique: Column, extracted: Column) -> DataFrame:
    """(key, total_fetched, total_after_dedupe, total_extracted, yield_rate, status) by source: failed with nothing extracted, partial with less than was unique."""
    x = fetched.groupBy(key).agg(F.count(F.lit(1)).alias("total_fetched"), F.count_if(unique).alias("total_after_dedupe"), F.count_if(unique & extracted).alias("total_extracted"))
    rate = F.round(F.col("total_extracted") / F.col("total_fetched"), 6)
    status = F.when(F.col("total_extracted") == 0, "failed").when(F.col("total_extracted") < F.col("total_after_dedupe"), "partial").otherwise("success")
    return x.withColumn("yield_rate", rate).withColumn("status", status)


def provider_summary(providers: DataFrame) -> DataFrame:
    """One row of (name, priority, available): how many there are, are available and are missing, and the available one of the lowest priority."""
    return providers.agg(F.count(F.lit(1)).alias("total"), F.count_if("available").alias("available"), F.count_if(~F.col("available")).alias("missing"), F.min_by(F.when(F.col("available"), F.col("name")), F.when(F.col("available"), F.col("priority"))).alias("preferred"))


def state_rollup(df: DataFrame, state: str, values: list[str], flags: dict[str, Column], used: Column) -> DataFrame:
    """One row: total, count and percent (one decimal) of each state, count of each flag, used and unused."""
    total = F.count(F.lit(1))
    counts = [c for v in values for n in [F.count_if(F.col(state) == v)] for c in (n.alias(f"{v}_count"), F.when(total > 0, F.round(n / total * 100, 1)).otherwise(0.0).alias(f"{v}_pct"))]
    return df.agg(total.alias("total"), *counts, *[F.count_if(c).alias(f"{name}_count") for name, c in flags.items()], F.count_if(used).alias("used_count"), F.count_if(~used).alias("unused_count"))


def day_report(log: DataFrame, time: Column, status: str, queue: DataFrame, queue_time: Column, day: str, missing: str = "saved") -> DataFrame:
    """(status, n) of the log's rows of one day, a missing status counting as `missing`, and of the queue's rows of the day as 'queued'."""
    on = lambda t: F.substring(t.cast("string"), 1, 10) == day
    rows = log.filter(on(time)).groupBy(F.coalesce(F.nullif(F.col(status), F.lit("")), F.lit(missing)).alias("status")).agg(F.count(F.lit(1)).alias("n"))
    return rows.unionByName(queue.filter(on(queue_time)).agg(F.lit("queued").alias("status"), F.count(F.lit(1)).alias("n")))
