"""Distinct rows with stated survivors: first wins by an order, null keys are unique."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize

#: Rounds after which a rest of at most so many keys is settled by a loop on the driver.
ROUNDS, ON_DRIVER = 8, 100_000


def mark_first(df: DataFrame, key: Column, order: list[str], flag: str = "is_first") -> DataFrame:
    """df with a flag: true on the first row of each key by order, and on every row without a key.

    The first of a key is found with partial aggregation and joined back by order and key, so a key of any number of rows
    is never one task's; of rows that are equal in both one is the first. df is read twice: it should be a table or cheap.
    """
    x = df.withColumn("_mk", key.cast("string")).select("*", *[F.col(c).alias(f"_mo{i}") for i, c in enumerate(order)])
    place = [f"_mo{i}" for i in range(len(order))]
    firsts = x.filter(F.col("_mk").isNotNull()).groupBy("_mk").agg(F.min(F.struct(*place)).alias("_m"))
    firsts = firsts.select(F.col("_mk").alias("_fk"), *[F.col(f"_m.{c}").alias(f"_f{c}") for c in place], F.lit(True).alias("_hit"))
    same = F.col("_mk") == F.col("_fk")
    for c in place:
        same = same & F.col(c).eqNullSafe(F.col(f"_f{c}"))
    # Rows of one key part by their order values; only those that tie meet.
    rn = F.row_number().over(Window.partitionBy("_mk", *place).orderBy(F.lit(1)))
    x = x.join(firsts, same, "left").withColumn("_rn", F.when(F.col("_hit"), rn))
    return x.select(*df.columns, (F.col("_mk").isNull() | F.coalesce(F.col("_rn") == 1, F.lit(False))).alias(flag))


def first_wins(df: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """The first row of each key by order and all rows without a key."""
    return mark_first(df, key, order, "_first").filter("_first").drop("_first")


def split_first(df: DataFrame, key: Column, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(unique rows, duplicate rows)."""
    x = mark_first(df, key, order, "_first")
    return x.filter("_first").drop("_first"), x.filter("not _first").drop("_first")


def two_phase(df: DataFrame, first_key: Column, second_key: Column, order: list[str]) -> DataFrame:
    """df with duplicate_of_phase: 1 for repeats of the first key, 2 for repeats of the second among the rest, 0 for survivors."""
    x = mark_first(df, first_key, order, "_a")
    # Only survivors of the first phase compete in the second.
    y = mark_first(x.withColumn("_k2", F.when(F.col("_a"), second_key)), F.col("_k2"), order, "_b")
    phase = F.when(~F.col("_a"), 1).when(~F.col("_b"), 2).otherwise(0)
    return y.withColumn("duplicate_of_phase", phase).drop("_a", "_b", "_k2")


def _loop(look: list, marks: list) -> list[tuple]:
    """one_by_one() of rows (_o, k) as a plain loop."""
    mine: dict = {}
    for o, k in marks:
        mine.setdefault(o, []).append(k)
    asked: dict = {}
    for o, k in look:
        asked.setdefault(o, []).append(k)
    taken: set = set()
    out = []
    for o in sorted(asked):
        if taken.isdisjoint(asked[o]):
            out.append((o,))
            taken.update(mine.get(o, ()))
    return out


def one_by_one(look: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """(_o) of the rows that a loop in order of _o would accept: no earlier accepted row marks a key that they look up.

    look, marks: (_o, k), the keys that a row looks up and those it marks once accepted; without marks they
    are the same. Each round settles the rows that no open earlier row can block, and those blocked by
    them, at least the earliest. A long chain settles few rows a round, so once at most ON_DRIVER keys are
    open after ROUNDS rounds the driver runs the loop over them; nothing is left unsettled.
    """
    open_ = materialize(look, "greedy")
    mine = open_ if marks is None else materialize(marks, "greedy")
    accepted = open_.select("_o").limit(0)
    rounds = 0
    while (left := open_.limit(ON_DRIVER + 1).count()) > 0:
        if rounds >= ROUNDS and left <= ON_DRIVER:
            rest = _loop(open_.select("_o", "k").collect(), mine.select("_o", "k").collect())
            return accepted.unionByName(open_.sparkSession.createDataFrame(rest, open_.select("_o").schema))
        first = mine.groupBy("k").agg(F.min("_o").alias("m"))
        free = F.min(F.col("m").isNull() | (F.col("_o") <= F.col("m")))
        wins = materialize(open_.join(first, "k", "left").groupBy("_o").agg(free.alias("w")).filter("w").select("_o"), "greedy")
        taken = mine.join(wins, "_o", "left_semi").groupBy("k").agg(F.min("_o").alias("m"))
        lost = open_.join(taken, "k").filter("_o > m").select("_o")
        settled = materialize(lost.unionByName(wins).distinct(), "greedy")
        accepted = accepted.unionByName(wins)
        rounds += 1
        if rounds % 20 == 0:
            accepted = materialize(accepted, "greedy")
        open_ = materialize(open_.join(settled, "_o", "left_anti"), "greedy")
        mine = open_ if marks is None else materialize(mine.join(settled, "_o", "left_anti"), "greedy")
    return accepted


def greedy_new(df: DataFrame, keys: list[str], order: str, history: DataFrame | None = None) -> DataFrame:
    """The rows that are new in order: none of their keys is in the history or on an earlier new row.

    A row that isn't new passes no key on, so this is neither distinct by one key after the other nor by
    connected rows. history has a column k of keys, each as 'name=value'. Null keys bind nothing; order
    must be unique.
    """
    tagged = F.array_compact(F.array(*[F.when(F.col(k).isNotNull(), F.concat(F.lit(k + "="), F.col(k).cast("string"))) for k in keys]))
    open_ = df.select(F.col(order).alias("_o"), F.explode_outer(tagged).alias("k"))
    if history is not None:
        known = open_.join(history.select("k").distinct(), "k", "left_semi").select("_o").distinct()
        open_ = open_.join(known, "_o", "left_anti")
    accepted = materialize(open_.filter("k is null").select("_o"), "greedy").unionByName(one_by_one(open_.filter("k is not null")))
    return df.join(accepted.withColumnRenamed("_o", order), order, "left_semi")


def seen_keys(df: DataFrame, **columns: str) -> DataFrame:
    """(k): a table's keys as greedy_new() takes them; name=column pairs."""
    tagged = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.concat(F.lit(n + "="), F.col(c).cast("string"))) for n, c in columns.items()]))
    return df.select(F.explode(tagged).alias("k")).distinct()


def duplicates_by_host(df: DataFrame, key: str, hosts: Column) -> DataFrame:
    """(key, n, duplicates): how many of an array's entries repeat an earlier one."""
    return df.select(key, F.size(hosts).alias("n"), (F.size(hosts) - F.size(F.array_distinct(hosts))).alias("duplicates"))


def known_files(files: DataFrame, source: str, content: Column, order: str, index: DataFrame | None = None) -> DataFrame:
    """files with file_key (source::SHA-256 of the bytes) and is_duplicate: in the index (file_key) or earlier by order."""
    x = mark_first(files.withColumn("file_key", F.concat_ws("::", source, F.sha2(content, 256))), F.col("file_key"), [order], "_first")
    if index is None:
        return x.withColumn("is_duplicate", ~F.col("_first")).drop("_first")
    old = index.select(F.col("file_key").alias("_old")).distinct()
    return x.join(old, F.col("file_key") == F.col("_old"), "left").withColumn("is_duplicate", ~F.col("_first") | F.col("_old").isNotNull()).drop("_first", "_old")
