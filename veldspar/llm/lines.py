"""Lines repeated across one site's documents.

Each document becomes an array of line hashes; forms are counted per source and outside it, tested
by log-likelihood ratio with Benjamini-Hochberg control, held against the stated share, and the
lines that stay are put together again by position.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import bounded_broadcast, materialize, only_first, table

# White space of Unicode, as a character class body of Java's regular expressions.
WS = r"\s\x0B\x1c-\x1f\x85\p{Z}"
MIN_SHARE, MIN_DOCS, FDR = 0.1, 3, 0.05


def line_form(line: Column) -> Column:
    """The line without digits 0-9, in lower case, trimmed, runs of white space as one space."""
    x = F.regexp_replace(F.translate(F.lower(line), "0123456789", ""), f"[{WS}]+", " ")
    return F.trim(x)


#: White space that parts no lines.
_INLINE = r"[\t\x0B\f\r\x1c-\x1f\x85\p{Z}]+"


def form_hashes(text: Column) -> Column:
    """array<struct<no, h1, h2>>: number and 128-bit hash of the form of each line that has a letter; line_form() of all lines at once."""
    whole = F.regexp_replace(F.translate(F.lower(text), "0123456789", ""), _INLINE, " ")
    forms = F.transform(F.split(whole, "\n", -1), lambda line, i: F.struct((i + 1).cast("int").alias("no"), F.trim(line).alias("f")))
    kept = F.filter(forms, lambda x: x["f"].rlike(r"\p{L}"))
    return F.transform(kept, lambda x: F.struct(x["no"].alias("no"), F.xxhash64(x["f"]).alias("h1"), F.xxhash64(F.lit(7), x["f"]).alias("h2")))


def line_hashes(docs: DataFrame, key: str, group: str, text: str, order: str | None = None) -> DataFrame:
    """(key, grp, lines): one row per key, by the lowest order value or else the least text; texts of keys of one row cross no shuffle."""
    rows = only_first(docs.select(*dict.fromkeys([key, group, text, order or key])), key, order or text)
    return materialize(rows.select(F.col(key), F.col(group).alias("grp"), form_hashes(F.coalesce(F.col(text), F.lit(""))).alias("lines")), "lines")


def _xlogx(x: Column) -> Column:
    return F.when(x > 0, x * F.log(x)).otherwise(0.0)


def repeated_forms(hashed: DataFrame, min_share: float = MIN_SHARE, min_docs: int = MIN_DOCS, fdr: float = FDR) -> DataFrame:
    """(grp, h1, h2, n, n_docs, n_out, llr, reason): forms in enough documents of a group.

    n counts distinct documents of the group with the form, n_out those outside, single ones too. reason 'excess':
    the excess over the outside is real at the false-discovery rate fdr, tested over all forms that come in
    two or more documents of a group. reason 'share': the form is as frequent outside, which is no excess, but
    it is repeated within the group all the same; this clause adds what the test alone would leave.
    """
    docs = hashed.groupBy("grp").agg(F.count(F.lit(1)).alias("n_docs"))
    uniq = F.array_distinct(F.transform("lines", lambda x: F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"))))
    one = hashed.filter("grp is not null").select("grp", F.explode(uniq).alias("f")).select("grp", "f.h1", "f.h2")
    # Partial aggregation sends one row per form, task and group: a form of a third of all rows is no hot key.
    counts = materialize(one.groupBy("h1", "h2", "grp").agg(F.count(F.lit(1)).alias("n")), "forms")
    docs = materialize(docs, "docs")
    total = docs.agg(F.sum("n_docs")).first()[0] or 0
    every = counts.groupBy("h1", "h2").agg(F.sum("n").alias("n_all"))
    x = counts.filter("n >= 2").join(every.filter("n_all >= 2"), ["h1", "h2"]).join(bounded_broadcast(docs), "grp").withColumn("all_docs", F.lit(total))
    a, b = F.col("n").cast("double"), (F.col("n_all") - F.col("n")).cast("double")
    na, nb = F.col("n_docs").cast("double"), (F.col("all_docs") - F.col("n_docs")).cast("double")
    k = a + b
    rate = k / (na + nb)
    ll = _xlogx(a) - a * F.log(na) + _xlogx(na - a) - (na - a) * F.log(na) + F.when(nb > 0, _xlogx(b) + _xlogx(nb - b) - nb * F.log(F.greatest(nb, F.lit(1.0)))).otherwise(0.0)
    l0 = k * F.log(rate) + F.when(rate < 1, (na + nb - k) * F.log(1 - rate)).otherwise(0.0)
    excess = (nb == 0) | (a / na > b / F.greatest(nb, F.lit(1.0)))
    x = x.withColumn("llr", F.when(excess, F.greatest(F.lit(0.0), 2 * (ll - l0))).otherwise(0.0))
    # Benjamini-Hochberg without a global sort: p falls in llr, so rank and cut need only counts per rounded llr.
    x = x.withColumn("bin", F.round("llr", 1)).withColumn("n_out", F.col("n_all") - F.col("n")).drop("n_all", "all_docs")
    x = materialize(x, "llr")
    bins = x.groupBy("bin").agg(F.count(F.lit(1)).alias("c")).filter("bin <= 60")
    above = x.filter("bin > 60").count()
    rows = sorted(((r["bin"], r["c"]) for r in bins.collect()), reverse=True)  # at most 601 bins
    cut, seen, tests = 60.1, above, above + sum(c for _, c in rows)
    for bin_, c in rows:
        seen += c
        if math.erfc(math.sqrt(max(bin_, 0.0) / 2)) <= fdr * seen / max(tests, 1):
            cut = bin_
    enough = (F.col("n") >= min_docs) & (F.col("n") >= F.col("n_docs") * F.lit(min_share))
    return x.filter(enough).withColumn("reason", F.when(F.col("bin") >= F.lit(float(cut)), "excess").otherwise("share")).drop("bin")


def repeated_lines(hashed: DataFrame, key: str, **rule) -> DataFrame:
    """(key, line_no, reason): every line of every document whose form is repeated in its group.

    Forms that are kept number at most 1/min_share lines per document and group, so their table is
    joined as a broadcast while it is small and by key with runtime skew handling beyond.
    """
    forms = bounded_broadcast(materialize(repeated_forms(hashed, **rule).select("grp", "h1", "h2", "reason"), "kept"))
    lines = hashed.filter("grp is not null").select(key, "grp", F.explode("lines").alias("l")).select(key, "grp", "l.no", "l.h1", "l.h2")
    return lines.join(forms, ["grp", "h1", "h2"]).select(key, F.col("no").cast("long").alias("line_no"), "reason")


def remove_repeated_lines(docs: DataFrame, key: str, group: str, text: str, **rule) -> DataFrame:
    """docs with the text freed of lines repeated within its group, the rest joined in order.

    A null text stays null; a null group is a group of no lines; rows that share a key are treated
    alike, by the first of them.
    """
    hashed = line_hashes(docs, key, group, text)
    bad = repeated_lines(hashed, key, **rule).groupBy(key).agg(F.collect_set("line_no").alias("_bad"))
    x = docs.join(bad, key, "left")
    parts = F.filter(F.split(F.col(text), "\n", -1), lambda line, i: ~F.coalesce(F.array_contains("_bad", (i + 1).cast("long")), F.lit(False)))
    return x.withColumn(text, F.array_join(parts, "\n")).drop("_bad")


def p3_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_hashes(table(spark, sf_dir, "raw_signal"), "signal_id", "source_id", "raw_text", "ingest_seq")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_lines(p3_hashes(spark, sf_dir), "signal_id").select("signal_id", "line_no")


P3_SQL = r"""
WITH s AS (SELECT signal_id, arg_min(source_id, ingest_seq) AS source_id, arg_min(raw_text, ingest_seq) AS raw_text FROM raw_signal GROUP BY signal_id),
l AS (SELECT signal_id, source_id, unnest(string_split(raw_text, chr(10))) AS line, generate_subscripts(string_split(raw_text, chr(10)), 1) AS line_no FROM s),
f AS (SELECT signal_id, source_id, line_no, trim(regexp_replace(regexp_replace(lower(line), '[0-9]', '', 'g'), '[\s\x{0B}\x{1c}-\x{1f}\x{85}\p{Z}]+', ' ', 'g')) AS form FROM l),
g AS (SELECT * FROM f WHERE regexp_matches(form, '\p{L}')),
d AS (SELECT source_id, count(*) AS n_docs FROM s GROUP BY source_id),
k AS (SELECT source_id, form FROM g JOIN d USING (source_id) GROUP BY source_id, form, n_docs HAVING count(DISTINCT signal_id) >= 3 AND count(DISTINCT signal_id) >= n_docs * CAST(0.1 AS DOUBLE))
SELECT signal_id, CAST(line_no AS BIGINT) AS line_no FROM g JOIN k USING (source_id, form)
"""
