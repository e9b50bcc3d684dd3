"""Joins by their relational meaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rollup import latest_last_wins


def left_join_last(left: DataFrame, right: DataFrame, key: str, position: str, columns: list[str]) -> DataFrame:
    """left with the columns of right's last row of the key; nulls where there is none."""
    r = latest_last_wins(right, [key], position).select(F.col(key).alias("_k"), *columns)
    return left.join(r, left[key] == F.col("_k"), "left").drop("_k")


def differences(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side): keys that only one side has."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("right")))


def containment(df: DataFrame, group: str, value: str, required: list[str]) -> DataFrame:
    """(group, missing, complete): which of the required values a group lacks."""
    have = df.filter(F.col(value).isin(*required)).groupBy(group).agg(F.collect_set(value).alias("h"))
    x = df.select(group).distinct().join(have, group, "left")
    missing = F.array_sort(F.array_except(F.array(*map(F.lit, required)), F.coalesce("h", F.array().cast("array<string>"))))
    return x.select(group, F.array_join(missing, ",").alias("missing"), (F.size(missing) == 0).alias("complete"))


def coalesce_join(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """left with each column taken from right where right has something, else from left; empty counts as nothing."""
    r = right.select(F.col(key).alias("_k"), *[F.nullif(F.col(c), F.lit("")).alias(f"_r_{c}") for c in columns])
    x = left.join(r, left[key] == F.col("_k"), "left")
    return x.select(*[F.coalesce(F.col(f"_r_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in left.columns])


def used_and_unused(catalog: DataFrame, key: str, usages: DataFrame, usage_key: str) -> DataFrame:
    """(key, state): unused catalog entries and unknown references of usages."""
    u = usages.select(F.col(usage_key).alias(key)).distinct()
    c = catalog.select(key).distinct()
    return c.join(u, key, "left_anti").withColumn("state", F.lit("unused")).unionByName(u.join(c, key, "left_anti").withColumn("state", F.lit("unknown")))


def first_available(requests: DataFrame, providers: DataFrame) -> DataFrame:
    """requests with the provider named, or else the available one of the lowest priority; error where there is none.

    requests have (provider or null); providers (name, priority, available) are a table of a few rows.
    """
    ok = providers.filter("available")
    best = ok.agg(F.min_by("name", "priority").alias("_best"))
    x = requests.join(F.broadcast(ok.select(F.col("name").alias("_p"))), F.col("provider") == F.col("_p"), "left").join(F.broadcast(best), F.lit(True), "left")
    chosen = F.when(F.col("provider").isNull(), F.col("_best")).otherwise(F.col("_p"))
    out = x.withColumn("chosen", chosen)
    return out.withColumn("error", F.when(F.col("chosen").isNull(), "no_provider")).drop("_p", "_best")


def audited(inventory: DataFrame, audits: DataFrame, key: str, position: str, columns: dict[str, str], operational: DataFrame) -> DataFrame:
    """inventory with is_operational, scope and the columns of each entry's last audit, by position.

    Only operational entries have an audit; columns gives what stands in place of one that is missing.
    """
    last = latest_last_wins(audits, [key], position).select(F.col(key).alias("_k"), *[F.col(c).alias(f"_a_{c}") for c in columns])
    ops = operational.select(F.col(key).alias("_o")).distinct()
    x = inventory.join(ops, inventory[key] == F.col("_o"), "left").join(last, (inventory[key] == F.col("_k")) & F.col("_o").isNotNull(), "left")
    values = [F.coalesce(F.col(f"_a_{c}"), F.lit(v)).alias(c) for c, v in columns.items()]
    scope = F.when(F.col("_o").isNull(), "inventory").when(F.col("_k").isNull(), "pending").otherwise("deep")
    return x.select(*[F.col(c) for c in inventory.columns], F.col("_o").isNotNull().alias("is_operational"), scope.alias("scope"), *values)


def bound_records(bindings: DataFrame, records: DataFrame, record: str) -> DataFrame:
    """(capability_id, record, binds_all): the records of each binding (capability_id, file_extensions, source_types, source_ids: arrays).

    Extensions bind strictly: none that fits means no record. Else types narrow all records, and ids what is left, but each
    only where it leaves any. A binding that is narrowed by neither has all records: it has one row with a null
    record and binds_all, so pairs with every record are never made. records: (record, extension, source_type, source_id).
    """
    b = bindings.select("capability_id", *[F.coalesce(c, F.array().cast("array<string>")).alias(c) for c in ("file_extensions", "source_types", "source_ids")])
    hard, soft = b.filter(F.size("file_extensions") > 0), b.filter(F.size("file_extensions") == 0)
    by_extension = hard.select("capability_id", F.explode("file_extensions").alias("extension")).join(records, "extension").select("capability_id", record).distinct()
    typed = soft.select("capability_id", F.explode("source_types").alias("source_type")).join(records, "source_type").select("capability_id", record, "source_id").distinct()
    plain = soft.select("capability_id").join(typed.select("capability_id").distinct(), "capability_id", "left_anti")
    ids = soft.select("capability_id", F.explode("source_ids").alias("source_id")).distinct()
    narrowed = typed.join(ids, ["capability_id", "source_id"], "left_semi").select("capability_id", record)
    wide = typed.select("capability_id", record).join(narrowed.select("capability_id").distinct(), "capability_id", "left_anti").distinct()
    by_id = plain.join(ids, "capability_id").join(records.select(record, "source_id"), "source_id").select("capability_id", record).distinct()
    every = plain.join(by_id.select("capability_id").distinct(), "capability_id", "left_anti").select("capability_id", F.lit(None).cast(dict(records.dtypes)[record]).alias(record))
    some = by_extension.unionByName(narrowed.distinct()).unionByName(wide).unionByName(by_id).withColumn("binds_all", F.lit(False))
    return some.unionByName(every.withColumn("binds_all", F.lit(True)))
