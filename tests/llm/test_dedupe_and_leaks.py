import hashlib
import os
import random
import shutil
import time

import numpy as np
import pytest
from pyspark import SparkContext
from pyspark.sql import functions as F

from veldspar.llm import incremental as inc
from veldspar.llm import leakage as lk


def words(rng, n):
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 8))) for _ in range(n)]


def test_winnowing_finds_every_long_shared_span():
    rng = np.random.default_rng(1)
    for _ in range(40):
        shared = rng.integers(97, 105, lk.GRAM + lk.WINDOW - 1).astype(np.uint8)
        a = np.concatenate([rng.integers(97, 123, rng.integers(0, 60)).astype(np.uint8), shared, rng.integers(97, 123, 50).astype(np.uint8)])
        b = np.concatenate([rng.integers(65, 91, rng.integers(0, 60)).astype(np.uint8), shared, rng.integers(65, 91, 50).astype(np.uint8)])
        ha, hb = (lk.gram_hashes(x, lk.GRAM) for x in (a, b))
        assert set(ha[lk.winnow(ha)]) & set(hb[lk.winnow(hb)])


def test_gram_hashes_equal_for_equal_grams_only():
    b = np.frombuffer(b"abcabcabcxyzabcabc", np.uint8)
    h = lk.gram_hashes(b, 3)
    assert h[0] == h[3] == h[12] and h[0] != h[1]
    assert len(lk.gram_hashes(b[:2], 3)) == 0


PASSAGE = "The lender in Quilstad raised its forecast by 41.7 points on Monday. Two buyers of Velmor Freight told R. Oskban that chip demand would slow down. Copper stocks near Tovhaven grew for the third month in a row. The auditor of Brizan Mutual left after the holiday."


@pytest.fixture(params=["broadcast index", "shuffled join", "join without filter"])
def way(request, monkeypatch):
    """Each way the fingerprints are joined must give the same."""
    if request.param != "broadcast index":
        monkeypatch.setattr(lk, "INDEX_BYTES", -1)
    if request.param == "join without filter":
        monkeypatch.setattr(lk, "FILTER_HASHES", 3)


def leaks(spark, texts, items):
    """The items that each text leaks."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = lk.leaked_items(docs, "doc_id", "text", spark.createDataFrame(items, "item_id long, passage string"), "item_id", "passage").collect()
    assert len(got) == len(set(got))
    return [{r["item_id"] for r in got if r["doc_id"] == i} for i in range(len(texts))]


def test_leaks_and_near_misses(spark, way):
    s = lk.sentences(PASSAGE)
    assert len(s) == 4
    yes = ["Intro. " + PASSAGE + " Outro.", "x " + s[1] + s[2], "x " + s[1].upper() + " An extra sentence is put in between them here. " + s[2].replace("month", "mоnth"), s[1].replace("buyers", "also buyers") + s[2].replace("third", "fourth")]
    no = ["x " + s[1], s[0] + "and then a lot of text. " * 60 + s[1], s[0] + s[2], "", "short"]
    items = [(1, PASSAGE), (2, "Nothing here is shared with anything else at all. It has two sentences of its own making.")]
    assert leaks(spark, yes + no, items) == [{1}] * len(yes) + [set()] * len(no)


def test_leaked_items_table(spark, way):
    docs = spark.createDataFrame([(1, PASSAGE), (2, None), (3, ""), (4, "word " * 60_000 + PASSAGE), (1, PASSAGE)], "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    items = spark.createDataFrame([(7, PASSAGE), (8, None), (9, ""), (7, PASSAGE)], "item_id long, passage string")
    got = sorted(tuple(r) for r in lk.leaked_items(docs.select("doc_id", "text"), "doc_id", "text", items, "item_id", "passage").collect())
    assert got == [(1, 7), (4, 7)]
    assert lk.leaked_items(docs.limit(0), "doc_id", "text", items, "item_id", "passage").count() == 0
    assert lk.leaked_items(docs, "doc_id", "text", items.limit(0), "item_id", "passage").count() == 0


@pytest.mark.parametrize("n", [1, 4, 50, 1000])
def test_passages_that_many_items_share_leak_all_of_them(spark, way, n):
    other = "A wholly different opening stands before it in this one of the suites. "
    data = [*[(i, PASSAGE) for i in range(n)], *[(n, PASSAGE)] * 5, *[(i, other + PASSAGE) for i in range(n + 1, n + 6)], (n + 6, lk.sentences(PASSAGE)[1])]
    texts = ["Intro. " + PASSAGE, "Nothing of it. " * 9]
    want = [set(range(n + 7)), set()]
    assert leaks(spark, texts, data) == want


def test_the_ways_agree_on_the_tables(spark, small, monkeypatch):
    want = {tuple(r) for r in lk.p9_found(spark, small).collect()}
    monkeypatch.setattr(lk, "INDEX_BYTES", -1)
    assert {tuple(r) for r in lk.p9_found(spark, small).collect()} == want != set()


def test_a_stock_phrase_of_many_items_is_no_leak(spark, way):
    stock = "Choose the one answer that fits the text above best. "
    items = [(i, stock + w + " grew for a third month in a row near the old harbour. " + w[::-1] + " fell again on the day after.") for i, w in enumerate(("Copperstocks", "Wheatprices", "Steelorders", "Chipdemand", "Shipfreights"))]
    assert leaks(spark, ["Intro words. " + stock + "And then something else that no test has ever said follows here.", "Intro words. " + items[2][1]], items) == [set(), {2}]


def like(a, b):
    return len(a & b) / max(len(a), len(b), 1) >= inc.UNCHANGED


def narrow_texts(rng):
    """Texts of a narrow vocabulary and edited ones of them: rare words differ and edits are scattered, so no rare pairs and few shingles are left."""
    stock = words(rng, 400)
    docs = [[f"{w}" for w in rng.sample(stock, 60)] + words(rng, rng.randrange(0, 9)) for _ in range(40)] + [words(rng, k) for k in (1, 2, 3, 5, 8)]
    docs += [[("n" + w if k % 10 in (0, 3, 6) or k >= 60 else w) for k, w in enumerate(d)] for d in docs[:45]]
    docs += [[("n" + w if k % 10 in (0, 3, 6, 8) else w) for k, w in enumerate(d)] for d in docs[:45]]
    return docs


def test_overlapping_equals_the_full_join_on_a_narrow_vocabulary(spark, monkeypatch):
    docs = narrow_texts(random.Random(5))
    data = [(i, sorted({inc._word_hash(w) for w in d})) for i, d in enumerate(docs)]
    sets = [set(w) for _, w in data]
    want = {(i, j) for i in range(45, len(docs)) for j in range(i) if like(sets[i], sets[j])}
    df = spark.createDataFrame(data, "seq long, w array<int>")
    freq = {r["x"]: r["n"] for r in inc.word_frequencies(df, "w").collect()}
    assert freq == {x: sum(x in s for s in sets) for x in set().union(*sets)}
    ordered = inc.WordOrder(np.array(list(freq)), np.array(list(freq.values()))).apply(df.selectExpr("'' AS signal_id", "seq", "0L AS copy", "w")).select("seq", "w")
    for chunk in (inc.CHUNK_WORDS, 2_000):
        monkeypatch.setattr(inc, "CHUNK_WORDS", chunk)
        got = inc.overlapping(ordered, ordered.filter("seq >= 45")).collect()
        assert {(r["seq"], r["other"]) for r in got} == want and len(got) == len(want) >= 40


def test_distinct_words_take_about_as_long_as_sorting_them():
    rng = np.random.default_rng(7)
    size, words = np.full(3_000, 280), rng.integers(-(2**31), 2**31, 3_000 * 280)
    pairs = (np.repeat(np.arange(len(size)), size) << 32) | (words & 0xFFFFFFFF)

    def seconds(f, *args):
        began = time.thread_time()
        f(*args)
        return time.thread_time() - began

    assert inc._row_words(words, size).tolist() == sorted(set(pairs.tolist())) and inc._row_words(words[:0], size[:0]).tolist() == []
    assert min(seconds(inc._row_words, words, size) for _ in range(5)) < 12 * min(seconds(np.sort, pairs) for _ in range(5))


@pytest.mark.parametrize("dense,together", [(0, 1), (5, 10_000), (inc.DENSE, 10_000)])
def test_the_search_is_exact_whichever_lists_are_marks(monkeypatch, dense, together):
    monkeypatch.setattr(inc, "DENSE", dense)
    monkeypatch.setattr(inc, "TOGETHER", together)
    monkeypatch.setattr(inc, "ASKED", 7 if dense == 5 else inc.ASKED)
    rng = np.random.default_rng(8)
    sets = [set(rng.choice(2**32, n, replace=False).tolist()) for n in (1, 2, 3, 7, 40, 90, 1_500, 1_900)]
    # More than 255 common words in a prefix, and many texts with the same words.
    sets += [{w for w in sets[k] if rng.random() < share} | {int(2**31 + k)} for k in range(len(sets)) for share in (1, 0.9, 0.7, 0.6) for _ in range(3)]
    words, size = np.concatenate([sorted(s) for s in sets]), np.array([len(s) for s in sets])
    seq = rng.permutation(len(sets))
    want = {(int(seq[i]), int(seq[j])) for i, a in enumerate(sets) for j, b in enumerate(sets) if seq[j] < seq[i] and like(a, b)}
    got = inc.OverlapIndex(seq, words, size).alike(seq, words, size)
    assert {(i, j) for i, j, _ in got} == want and len(got) == len(want) > 100
    empty = np.empty(0, np.int64)
    assert inc.OverlapIndex(empty, empty, empty).alike(seq, words, size) == inc.OverlapIndex(seq, words, size).alike(empty, empty, empty) == []


def test_main_words_of_many_texts_are_those_of_each(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("veldspar.llm.incremental.MIN_DOCS", 2)
    head = "Weekly notice\nPage 7 of the register\n"
    texts = ["It rose by 5.1 in all of the markets that were open. ", "A short line without an end", "Weekly notice", "", "\n\n", None, "Copper fell again. And so did tin in the last week\nother words here"]
    rows = [(f"s{i}", i, (None, "a", "b", "c")[i % 4], t if t is None or i % 3 else head + t) for i, t in enumerate(texts * 8)]
    index = inc.TextIndex(spark, str(tmp_path / "index"))
    lines = lines_of_texts(spark, rows)
    index.fold(lines, probe=False)
    templates = {r["grp"]: np.array(r["tm"]) for r in index.templates().collect()}
    got = {r["signal_id"]: [x & 0xFFFFFFFF for x in r["w"]] for r in index._words(lines, None).collect()}
    want = {s: [int(x) & 0xFFFFFFFF for x in inc.main_words(*(np.array(x, t) for x, t in zip(inc.text_lines(text), (np.int64, bool, np.int64, np.int64), strict=True)), templates.get(g))] for s, _, g, text in rows}
    assert got == {s: w for s, w in want.items() if w} and templates and len({len(w) for w in got.values()}) > 3


def test_content_keys(spark):
    texts = ["A  b\u00a0c", " a b c ", "a\tb\n\nc", "a b c", "\u2003a\x1cb c\x85", "   ", "\n", "", "a bc", "ａ ｂ"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(inc.content_key(F.col("t"))).collect()]
    assert got == [hashlib.sha256(" ".join(t.lower().split()).encode()).hexdigest()[:16] for t in texts]


def test_the_driver_holds_one_chunk_of_texts_at_a_time(spark, monkeypatch):
    made, broadcast = [], SparkContext.broadcast

    def noted(sc, value):
        assert not any(os.path.exists(b._path) for b in made)
        made.append(broadcast(sc, value))
        return made[-1]

    monkeypatch.setattr(SparkContext, "broadcast", noted)
    monkeypatch.setattr(inc, "CHUNK_WORDS", 20)
    df = spark.createDataFrame([(k, list(range(10))) for k in range(12)], "seq long, w array<int>")
    assert {(r["seq"], r["other"]) for r in inc.overlapping(df, df).collect()} == {(i, j) for i in range(12) for j in range(i)}
    assert len(made) == 6 and not any(os.path.exists(b._path) for b in made)


def test_p2_leaves_no_plan_of_all_its_steps_to_the_driver(spark, small):
    plan = inc.p2_found(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" in plan and not any(step in plan for step in ("Join", "BroadcastExchange", "MapInArrow", "Window"))


def lines_of_texts(spark, rows):
    return inc.read_lines(spark.createDataFrame(rows, "signal_id string, seq long, grp string, raw_text string"), "raw_text")


def test_batches_are_folded_into_a_kept_index_without_reading_history(spark, tmp_path):
    docs = [(f"s{i}", i, f"g{i % 3}", f"Notice of g{i % 3}\n" + " ".join(d) + ". It is a paragraph of some length that ends so.") for i, d in enumerate(narrow_texts(random.Random(5)))]
    docs += [("c1", 200, "g1", docs[7][3]), ("c2", 201, "g2", docs[7][3]), ("n1", 202, "g1", None), ("n2", 203, None, ""), ("c3", 204, None, docs[130][3])]
    lines_of_texts(spark, docs[:45]).write.parquet(str(tmp_path / "history"))
    inc.TextIndex(spark, str(tmp_path / "index")).fold(spark.read.parquet(str(tmp_path / "history")), probe=False)
    shutil.rmtree(tmp_path / "history")
    got = []
    for a, b in ((45, 90), (90, len(docs))):
        # A new process finds the index by its path; nothing but the batch and the index is there to read.
        found = inc.TextIndex(spark, str(tmp_path / "index")).fold(lines_of_texts(spark, docs[a:b]))
        got += [(r["signal_id"], r["other"]) for r in found.collect()]
    sets = {s: {inc._word_hash(w) for w in inc._WORD.findall((t or "").split("\n")[-1].lower())} for s, _, _, t in docs}
    firsts, want = {}, set()
    for s, n, _, t in docs:
        if not sets[s]:
            continue
        key = t.split("\n")[-1]
        if key in firsts and n >= 45:
            want.add((s, firsts[key]))
        elif key not in firsts:
            if n >= 45:
                want |= {(s, m) for k, m in firsts.items() if like(sets[s], {inc._word_hash(w) for w in inc._WORD.findall(k.lower())})}
            firsts[key] = n
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 40
    empty = inc.TextIndex(spark, str(tmp_path / "empty"))
    assert empty.fold(lines_of_texts(spark, docs[:1]).limit(0)).count() == 0
    assert empty.fold(lines_of_texts(spark, docs[:2])).count() == 0


def test_lines_of_texts():
    forms, prose, size, w = inc.text_lines("Call 55 now\n\n  call  66 NOW \n---\nA first sentence ends here. And another one follows it")
    assert forms[0] == forms[1] != 0 and forms[2] == 0 and prose == [False, False, False, True] and sum(size) == len(w) and size[2] == 0
    assert inc.text_lines(None) == inc.text_lines("") == ([], [], [], [])
    a = [np.array(x) for x in (forms, prose, size, w)]
    assert len(inc.main_words(*a, None)) == size[3] and len(inc.main_words(*a, np.array([forms[3]]))) == size[0] + size[1]


@pytest.mark.parametrize("a,b,same", [
    ("Why copper rose 5.1% at Zan Group", "[PDF] why  copper rose 5.1% at Zan Group - Velmor Desk", True), ("Why copper rose 5.1% at Zan Group", "Update: Why coper rose 5.1% at Zan Group…", True),
    ("Why copper rose 5.1% at Zan Group", "Why copper rose 5.2% at Zan Group", False), ("Why copper rose 5.1% at Zan Group", "Why copper rose 5.1% at Bextul Group", False),
    ("恒岚市观察：订单量为何低迷（466）", "【独家】恒岚市观察：订单量为何低迷（466）", True), ("恒岚市观察：订单量为何低迷（466）", "恒岚市观察：订单量为何低迷（467）", False),
])
def test_titles(spark, a, b, same):
    df = spark.createDataFrame([("d", -1, False, "s", a, "Velmor Desk"), ("i", 5, True, "s", b, "Velmor Desk"), ("o", 6, True, "other", b, None), ("n", 7, True, "s", None, None), ("e", 8, True, "s", "", None)], "item_id string, seq long, is_new boolean, source string, title string, source_name string")
    assert [r[0] for r in inc.similar_titles(df).collect()] == (["i"] if same else [])


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def slipped_titles(rng):
    """Titles of all lengths from 1, of one script and of two, each with one that is two edits away, and titles of one form with other numbers."""
    out = ["rise of 5.1", "rise of 51", "ryse off 5.1", "ryse off 51", "rise of 5.1 or more", "a😀b", "😀b"]
    for k in range(150):
        pool = ("abcdefgh", "恒岚市观察订单量", "abcd恒岚市观")[k % 3]
        t = "".join(rng.choice(pool) for _ in range(1 + k // 4))
        out.append(t)
        for _ in range(2):
            i, how = rng.randrange(len(t) + 1), rng.randrange(3)
            t = t[:i] + rng.choice(pool) * (how < 2) + t[i + (how > 0) :] or "h"
        out.append(t)
    return out


def test_similar_titles_equal_the_full_join(spark):
    rng = random.Random(4)
    rows = [(f"i{k}", k - 1 if k else -1, k > 0, f"s{rng.randrange(2)}" if k > 6 else "s0", t, None) for k, t in enumerate(slipped_titles(rng))]
    rows += [("d", -1, False, "s0", rows[k][4], None) for k in range(20, len(rows), 20)]
    form = {t: inc.title_form(t, None) for *_, t, _ in rows}
    numbers = {t: inc._NUMBER.findall(t) for t in form}

    def same(a, b):
        return form[a] == form[b] or numbers[a] == numbers[b] and abs(len(form[a]) - len(form[b])) <= inc.SLIPS and edits(form[a], form[b]) <= inc.SLIPS

    want = {r[0] for r in rows if r[2] and any(o[1] < r[1] and o[3] == r[3] and same(r[4], o[4]) for o in rows)}
    df = spark.createDataFrame(rows, "item_id string, seq long, is_new boolean, source string, title string, source_name string")
    got = [r[0] for r in inc.similar_titles(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want and 100 < len(want) < len(rows) - 20
    assert inc.similar_titles(df.limit(0)).count() == 0


def test_spans_of_unlike_titles_and_of_other_places_do_not_meet():
    rng = random.Random(6)
    titles = ["".join(rng.choice("abcdefghijklmnop") for _ in range(k)) for k in range(24, 90) for _ in range(9)]
    own, asked, n = inc.title_spans(titles, np.arange(len(titles)) % 2)
    assert n.tolist() == [12] * len(titles) and len(np.unique(own)) == own.size
    owner = {int(h): k for k, hashes in enumerate(own) for h in hashes}
    assert all(owner.get(int(h), k) == k for h, k in zip(asked, np.repeat(np.arange(len(titles)), n), strict=True))
    assert not set(own.ravel()) & set(inc.title_spans(titles, np.arange(len(titles)) % 2 + 2)[0].ravel())


def test_addresses(spark):
    u = ["https://WWW.x.example/a/?utm_source=q#top", "http://x.example/a", "https://x.example/a?b=1&a=2", "https://x.example/a/?a=2&ref=z&b=1", "https://x.example/A", None, "", "nothing"]
    rows = inc.with_url_keys(spark.createDataFrame([(x,) for x in u], "u string"), "u").collect()
    got = [r["a"] for r in rows]
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()[:16]
    assert (rows[0]["u1"], rows[0]["u2"]) == (sha("https://www.x.example/a/?utm_source=q"), sha("https://www.x.example/a"))
    assert (rows[1]["u1"], rows[1]["u2"]) == (sha("http://x.example/a"), None)
    assert got[0] == got[1] and got[2] == got[3] and got[4] != got[0] and got[5:] == [None, None, None]


def test_p2_on_small_tables(spark, small):
    got = inc.p2_found(spark, small)
    assert got.columns == ["item_table", "item_id"] and got.count() == got.distinct().count() > 0
