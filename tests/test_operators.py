import random

from pyspark.sql import functions as F

from veldspar.operators import dedupe, filters, joins, rollup, state


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_first_wins_keeps_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (4, None), (5, "b")], "pos int, k string")
    assert rows(dedupe.first_wins(df, F.col("k"), ["pos"]), "pos") == [(1,), (2,), (4,), (5,)]
    unique, again = dedupe.split_first(df, F.col("k"), ["pos"])
    assert (unique.count(), rows(again, "pos")) == (4, [(3,)])
    assert dedupe.first_wins(df.limit(0), F.col("k"), ["pos"]).count() == 0


def test_two_phase_is_not_greedy(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "b", "y")], "pos int, u string, c string")
    assert rows(dedupe.two_phase(df, F.col("u"), F.col("c"), ["pos"]), "pos", "duplicate_of_phase") == [(1, 0), (2, 2), (3, 1)]
    assert rows(dedupe.greedy_new(df, ["u", "c"], "pos"), "pos") == [(1,), (3,)]


def test_greedy_new_equals_a_loop(spark):
    rng = random.Random(3)
    data = [(i, rng.choice([None, *range(9)]), rng.choice([None, *range(9)])) for i in range(60)]
    seen = {("u", 1), ("c", 2)}
    want, keys = [], set(seen)
    for i, u, c in data:
        mine = {k for k in (("u", u), ("c", c)) if k[1] is not None}
        if not mine & keys:
            want.append((i,))
            keys |= mine
    df = spark.createDataFrame(data, "i int, u int, c int")
    history = spark.createDataFrame([("u=1",), ("c=2",)], "k string")
    assert rows(dedupe.greedy_new(df, ["u", "c"], "i", history), "i") == sorted(want, key=str)


def chain(spark, n):
    """Row i shares its address with the row before and its title with the row after, or the other way round."""
    return spark.createDataFrame([(i, (i + 1) // 2, i // 2) for i in range(n)], "i int, u int, c int")


def test_greedy_new_settles_long_chains(spark, monkeypatch):
    assert rows(dedupe.greedy_new(chain(spark, 450), ["u", "c"], "i"), "i") == sorted([(i,) for i in range(0, 450, 2)], key=str)
    monkeypatch.setattr(dedupe, "ON_DRIVER", 0)
    assert rows(dedupe.greedy_new(chain(spark, 46), ["u", "c"], "i"), "i") == sorted([(i,) for i in range(0, 46, 2)], key=str)


def test_seen_lookup_masks_the_fallback(spark):
    st = spark.createDataFrame([("u1", "t1", "failed", 1), ("u2", "t1", "saved", 2), ("u3", None, "partial", 1), ("u3", None, "failed", 0)], "u string, t string, status string, at int")
    b = spark.createDataFrame([(1, "u1", "t1"), (2, "zz", "t1"), (3, "u3", None), (4, None, None)], "i int, u string, t string")
    got = rows(state.seen_lookup(b, st, "u", "t", seen_at="at"), "i", "matched_by", "is_seen")
    assert got == [(1, "u", False), (2, "t", True), (3, "u", True), (4, None, False)]


def test_upsert_counts_retries(spark):
    st = spark.createDataFrame([("a", "failed", 2), ("b", "saved", 0)], "k string, status string, retry_count int")
    b = spark.createDataFrame([("a", "failed"), ("c", "saved")], "k string, status string")
    assert rows(state.upsert(st, b, "k", ["status"], retry="retry_count"), "k", "status", "retry_count") == [("a", "failed", 3), ("b", "saved", 0), ("c", "saved", 0)]


def test_versions_chain_within_a_batch(spark):
    b = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "a", "y"), (4, "b", "q"), (5, "a", "x")], "p int, k string, c string")
    assert rows(state.versions(b, None, "k", "c", "p"), "p", "action") == [(1, "insert"), (2, "duplicate"), (3, "new_version"), (4, "insert"), (5, "new_version")]
    cur = spark.createDataFrame([("b", "q"), ("a", "z")], "k string, c string")
    assert rows(state.versions(b, cur, "k", "c", "p"), "p", "action")[0:4:3] == [(1, "new_version"), (4, "duplicate")]


def test_queue_and_receipts(spark):
    q = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    out = state.rewrite_queue(q, q.filter("k = 'a'"), spark.createDataFrame([("a", 9)], "k string, n int"), "k")
    assert rows(out, "k", "n") == [("a", 9), ("b", 2)]
    receipts = spark.createDataFrame([("a", "me"), ("b", "you")], "k string, consumer string")
    assert rows(state.unconsumed(q, receipts, "k", "me"), "k") == [("b",)]
    assert rows(state.unconsumed(q, receipts, "k", "me", limit=1, order=["n"]), "k") == []


def test_filters(spark):
    df = spark.createDataFrame([("g", 1), ("g", 2), ("h", 1), (None, 1)], "g string, v int")
    assert rows(filters.soft_filter(df, F.col("v") == 2, ["g"]), "g", "v") == [("g", 2), ("h", 1), (None, 1)] or rows(filters.soft_filter(df, F.col("v") == 2, ["g"]), "g", "v") == sorted([("g", 2), ("h", 1), (None, 1)], key=str)
    d = spark.createDataFrame([("2024-01-15T00",), ("2024-02",), (None,)], "d string")
    assert rows(d.filter(filters.prefix_range(F.col("d"), "2024-01", "2024-01-31")), "d") == [("2024-01-15T00",)]
    assert d.filter(filters.prefix_range(F.col("d"), None, None)).count() == 3
    v = filters.violations(df, "v", {"has_g": ("error", F.col("g").isNotNull())})
    assert rows(v, "rule", "level", "key") == [("has_g", "error", "1")]


def test_rollups(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("b", 3, 1), (None, 4, 9)], "k string, pos int, t int")
    assert rows(rollup.latest_first_wins(df, ["k"], F.col("t"), "pos"), "k", "pos") == [("a", 1), ("b", 3)]
    assert rows(rollup.latest_last_wins(df, ["k"], "pos"), "k", "pos") == sorted([("a", 2), ("b", 3), (None, 4)], key=str)
    assert rows(rollup.closed_domain_counts(df, "k", ["a", "z"]), "k", "n") == [("a", 2), ("unknown", 2), ("z", 0)]
    log = spark.createDataFrame([("s", i, x) for i, x in enumerate("FFSFNFS")], "k string, i int, x string")
    got = rollup.consecutive(log, ["k"], ["i"], F.col("x") == "F", F.col("x") == "S")
    assert [r["streak"] for r in got.orderBy("i").collect()] == [1, 2, 0, 1, 1, 2, 0]
    got = rollup.carried(log, ["k"], ["i"], F.col("x") == "S", F.col("i"), "last")
    assert [r["last"] for r in got.orderBy("i").collect()] == [None, None, 2, 2, 2, 2, 6]


def test_joins(spark):
    a = spark.createDataFrame([("x",), ("y",)], "k string")
    b = spark.createDataFrame([("y", 1, "p"), ("y", 2, ""), ("z", 1, "q")], "k string, pos int, v string")
    assert rows(joins.left_join_last(a, b, "k", "pos", ["v"]), "k", "v") == [("x", None), ("y", "")]
    assert rows(joins.differences(a, b, "k"), "k", "side") == [("x", "left"), ("z", "right")]
    assert rows(joins.containment(b, "k", "v", ["p", "q"]), "k", "missing", "complete") == [("y", "q", False), ("z", "p", False)]
