"""Filters, predicates and rule tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import trim_u


def prefix_range(value: Column, low: str | None, high: str | None) -> Column:
    """Whether value, cut to each bound's length, lies between the bounds, both included; null fails if there is any bound."""
    ok = F.lit(True)
    if low:
        ok = ok & (F.substring(value, 1, len(low)) >= low)
    if high:
        ok = ok & (F.substring(value, 1, len(high)) <= high)
    return F.coalesce(ok, F.lit(False))


def tags_overlap(tags: Column, wanted: list[str]) -> Column:
    return F.coalesce(F.arrays_overlap(tags, F.array(*map(F.lit, wanted))), F.lit(False))


def soft_filter(df: DataFrame, predicate: Column, by: list[str]) -> DataFrame:
    """Rows that satisfy the predicate; of a group where none does, all rows."""
    p = F.coalesce(predicate, F.lit(False))
    any_ = df.groupBy(*by).agg(F.max(p.cast("int")).alias("_any"))
    # The groups' verdicts are joined, so no group has to meet in one task.
    cond = reduce(lambda a, b: a & b, [F.col(f"_k{i}").eqNullSafe(df[c]) for i, c in enumerate(by)])
    verdict = any_.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], "_any")
    return df.join(verdict, cond).filter(p | (F.col("_any") == 0)).select(df.columns)


def quality_gate(text: Column, least: int = 30) -> Column:
    """Whether the trimmed text has so many code points."""
    return F.coalesce(F.length(trim_u(text)) >= least, F.lit(False))


def matching(df: DataFrame, status: str | None = None, tag: str | None = None, captured: tuple[str | None, str | None] = (None, None), published: tuple[str | None, str | None] = (None, None), equal: dict[str, object] | None = None) -> DataFrame:
    """Rows that satisfy every predicate given; those not given exclude nothing."""
    if status is not None:
        df = df.filter(F.col("status") == status)
    if tag is not None:
        df = df.filter(F.array_contains("tags", tag))
    for name, (low, high) in (("captured_at", captured), ("published_at", published)):
        if low or high:
            df = df.filter(prefix_range(F.col(name), low, high))
    for c, v in (equal or {}).items():
        df = df.filter(F.col(c) == F.lit(v))
    return df


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """df with nulls of the named columns replaced by the defaults."""
    return df.select(*[F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c) for c in df.columns])


def violations(df: DataFrame, key: str, rules: dict[str, tuple[str, Column]]) -> DataFrame:
    """(rule, level, key): one row per rule and row that breaks it. A rule is (level, what must hold); null doesn't hold."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.struct(F.lit(name).alias("rule"), F.lit(level).alias("level"))) for name, (level, ok) in rules.items()]))
    return df.select(F.col(key).cast("string").alias("key"), F.explode(broken).alias("b")).select("b.rule", "b.level", "key")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """(key, n): keys of more than one row."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows of child whose reference is set and not in parent."""
    p = parent.select(F.col(parent_key).alias(column)).distinct()
    return child.filter(F.col(column).isNotNull()).join(p, column, "left_anti")


def prefix_limit(df: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """The first n rows of each group; the limit is the feature."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("_rn") <= n).drop("_rn")


def keyword_hits(text: Column, keywords: list[str]) -> Column:
    """array<string>: the keywords that occur in the text, letter case aside, in the order of the list; null has none."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.filter(F.array(*map(F.lit, keywords)), lambda k: F.contains(low, F.lower(k)))


def only_listed(df: DataFrame, key: str, allowed: DataFrame, allowed_key: str) -> DataFrame:
    """Rows whose key is on a list; null keys are not. Repeats on the list repeat no row."""
    return df.join(allowed.select(F.col(allowed_key).alias(key)).distinct(), key, "left_semi")


def records_of_kind(df: DataFrame, column: str, kind: str, time: Column, prefix: str) -> DataFrame:
    """Rows of a log of one kind whose time, as text, begins with the prefix."""
    return df.filter((F.col(column) == kind) & F.coalesce(time.cast("string").startswith(prefix), F.lit(False)))


def by_status(df: DataFrame, column: str, order: list[str], wanted: str | None = None) -> DataFrame:
    """df with position: rows of a status, letter case aside, or of all, ranked by the fixed order of statuses; others come last (null and unknown: 99)."""
    low = F.lower(F.col(column))
    x = df.filter(low == wanted.lower()) if wanted else df
    place = F.create_map(*[F.lit(v) for i, k in enumerate(order) for v in (k.lower(), i)])[low]
    return x.withColumn("position", F.coalesce(place, F.lit(99)))


def missing_references(df: DataFrame, key: str, references: str, known: DataFrame, known_key: str) -> DataFrame:
    """(key, reference): what an array column names that the listing of known names lacks; empty and null names are none."""
    x = df.select(key, F.explode(F.array_distinct(references)).alias("reference")).filter("reference <> ''")
    return x.join(known.select(F.col(known_key).alias("reference")).distinct(), "reference", "left_anti").select(key, "reference")


def prefix_then_distinct(df: DataFrame, by: list[str], order: list[str], n: int, key: str) -> DataFrame:
    """The first n rows of each group and, of these, the first of each key in it: repeats use up the limit, which is the feature."""
    x = prefix_limit(df, by, order, n)
    rn = F.row_number().over(Window.partitionBy(*by, key).orderBy(*order))
    return x.withColumn("_rn", rn).filter("_rn = 1").drop("_rn")
