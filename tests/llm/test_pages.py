import math
import random
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from veldspar.llm import boilerplate as bp
from veldspar.llm import lines as ln
from veldspar.llm import mojibake as mj
from veldspar.llm import packing as pk
from veldspar.llm import residue as rs


def test_repeated_lines_against_brute_force(spark):
    rng = random.Random(1)
    docs = []
    for i in range(60):
        src = "ab"[i % 3 == 0]
        body = [rng.choice(["Notice %d of law" % rng.randrange(99), "Share this", "", "  share   THIS ", "unique %s" % i, "42", "Rare line"]) for _ in range(6)]
        docs.append((i, src, "\n".join(body)))
    docs += [(100, "a", None), (101, None, "Share this"), (102, "a", ""), (103, "c", "Share this")]
    df = spark.createDataFrame(docs, "id int, src string, t string").withColumn("grp", F.lit("clash"))
    form = lambda s: " ".join("".join(c for c in s.lower() if not c.isdigit()).split())
    n, have = Counter(s for _, s, _ in docs), Counter()
    for _, s, t in docs:
        have.update({(s, form(x)) for x in (t or "").split("\n")})
    want = {(i, k + 1) for i, s, t in docs if s for k, x in enumerate((t or "").split("\n")) if any(c.isalpha() for c in form(x)) and have[s, form(x)] >= max(3, 0.1 * n[s])}
    got = {(r[0], r[1]) for r in ln.repeated_lines(ln.line_hashes(df, "id", "src", "t"), "id").select("id", "line_no").collect()}
    assert got == want
    left = {r["id"]: r["t"] for r in ln.remove_repeated_lines(df, "id", "src", "t").collect()}
    for i, s, t in docs:
        if t is not None:
            assert left[i] == "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k + 1) not in want)
    assert ln.repeated_lines(ln.line_hashes(df.limit(0), "id", "src", "t"), "id").count() == 0


def test_likelihood_ratio_is_the_usual_one(spark):
    docs = [(i, "a" if i < 40 else "b", "x line" if i < 20 or i == 50 else "own %s" % chr(97 + i % 26) * (i + 1)) for i in range(100)]
    df = spark.createDataFrame(docs, "id int, s string, t string")
    r = [r for r in ln.repeated_forms(ln.line_hashes(df, "id", "s", "t")).collect() if r["n"] == 20][0]
    ll = lambda k, n, p: k * math.log(p) + (n - k) * math.log(1 - p)
    want = 2 * (ll(20, 40, 0.5) + ll(1, 60, 1 / 60) - ll(20, 40, 0.21) - ll(1, 60, 0.21))
    assert r["reason"] == "excess" and r["n_out"] == 1 and abs(r["llr"] - want) < 1e-9


def test_a_line_of_all_sources_is_kept_for_its_share(spark):
    docs = [(i, "abcdefghij"[i % 10], f"All rights reserved\nown {chr(97 + i % 26) * (i + 1)}") for i in range(100)]
    hashed = ln.line_hashes(spark.createDataFrame(docs, "id int, s string, t string"), "id", "s", "t")
    got = [r.asDict() for r in ln.repeated_forms(hashed).collect()]
    assert len(got) == 10 and {r["reason"] for r in got} == {"share"} and {(r["n"], r["n_out"]) for r in got} == {(10, 90)}
    assert ln.repeated_lines(hashed, "id").filter("line_no = 1").count() == 100


def test_a_form_once_in_each_of_many_sources_counts_outside(spark):
    docs = [(i, f"s{i}", "One form") for i in range(35)] + [(100 + i, "z", "One form") for i in range(4)]
    got = [r.asDict() for r in ln.repeated_forms(ln.line_hashes(spark.createDataFrame(docs, "id int, s string, t string"), "id", "s", "t")).collect()]
    assert [(r["grp"], r["n"], r["n_out"], r["reason"]) for r in got] == [("z", 4, 35, "share")]


def test_packing_equals_naive_first_fit(spark):
    rng = random.Random(4)
    sizes = sorted((rng.randrange(1, 2048) for _ in range(400)), reverse=True)
    bins, naive = [], []
    for s in sizes:
        k = next((i for i, room in enumerate(bins) if room >= s), len(bins))
        if k == len(bins):
            bins.append(2048)
        bins[k] -= s
        naive.append(k)
    assert pk.first_fit_decreasing(sizes, 2048) == naive
    assert pk.first_fit_decreasing([], 10) == []
    rows = [(i, s) for i, s in enumerate(sizes)] + [(900, None), (901, 0), (902, 5000), (903, 2048), (903, 2048)]
    out = pk.pack(spark.createDataFrame(rows, "id int, n int").withColumn("container_id", F.lit("clash")), "id", "n").toPandas()
    assert len(out) == len(rows) and (out[~out.oversize].groupby("container_id").n.sum() <= 2048).all()
    assert out[out.oversize].id.tolist() == [902] and (out.container_id == out[out.oversize].container_id.iloc[0]).sum() == 1
    assert pk.pack(spark.createDataFrame([], "id int, n int"), "id", "n").count() == 0


def test_token_count(spark):
    t = ["Hello, world_1!", "漢字 kana", "", None, "a b\t\n--", "word " * 50_000]
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(t)], "i int, t string").orderBy("i").select(pk.count_tokens(F.col("t"))).collect()]
    assert got == [4, 3, 0, 0, 4, 50_000]


def site(rng, host, i):
    nav = " | ".join(["Home", "Markets", "Search", "Help"])
    art = [f"{rng.choice(['Copper', 'Freight', 'Retail'])} brief {i}: {rng.random():.4f} at {host} works"]
    for _ in range(3):
        art.append(" ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(24)) + ".")
    if i % 20 == 0:  # rarer than TEMPLATE_SHARE
        art.insert(2, "Background")
    foot = ["Related articles", *[f"Teaser number {rng.random():.5f} about {rng.choice('xyz')}" for _ in range(3)], f"© 2024 {host}. All rights reserved."]
    return ["This site uses cookies.", nav, *art, *foot], {1, 2, *range(len(art) + 3, len(art) + 8)}


def test_boilerplate_of_synthetic_sites(spark):
    rng = random.Random(9)
    rows, want = [], set()
    for host in ("alpha", "beta", "gamma"):
        for i in range(40):
            ls, bad = site(rng, host, i)
            rows.append((f"{host}{i}", host, ls[2], "\n".join(ls)))
            want |= {(f"{host}{i}", n) for n in bad}
    rows += [("nul", "alpha", None, None), ("emp", "alpha", None, ""), ("nohost", None, None, "One line\nAnother line."), ("long", "alpha", None, "w " * 50_000)]
    df = spark.createDataFrame(rows, "id string, host string, title string, text string").withColumn("lines", F.lit("clash"))
    got = {tuple(r) for r in bp.boilerplate_lines(df, ["id"], "host", "title", "text").collect()}
    assert len(got & want) >= 0.98 * len(want) and len(got - want) <= 0.01 * len(want)
    assert not {i for i, _ in got} & {"nul", "emp", "nohost", "long"}
    assert bp.boilerplate_lines(df.limit(0), ["id"], "host", "title", "text").count() == 0


def test_navigation_rows_need_a_count(spark):
    body = "A paragraph of the article that is long enough to be one, with many words in it, and it ends here as it should do."
    once = ("x", "solo", None, f"Rye | Oats | Barley\n{body}")
    rows = [(f"p{i}", "host", None, f"Home | Markets | Search | part {i}\n{body.replace('many', 'm' * (i + 2))}") for i in range(4)] + [once]
    df = spark.createDataFrame(rows, "id string, host string, title string, text string")
    assert {tuple(r) for r in bp.boilerplate_lines(df, ["id"], "host", "title", "text").collect()} == {(f"p{i}", 1) for i in range(4)}


def test_single_occurrences_count_over_hosts(spark):
    body = "A paragraph number {} of the article that is long enough to be one, with many words in it, and it ends here as it should do."
    word = lambda i: "".join(chr(97 + int(c)) for c in str(i)) * 3
    rows = [(f"{h}{i}", h, None, ("Weekly letter\n" if i == 0 else "") + body.format(word(h + str(i) if False else 97 * i + ord(h)))) for h in "abcde" for i in range(5)]
    df = spark.createDataFrame(rows, "id string, host string, title string, text string")
    # One page of five on each host: 20 percent on the host and over all hosts.
    assert {tuple(r) for r in bp.boilerplate_lines(df, ["id"], "host", "title", "text").collect()} == {(f"{h}0", 1) for h in "abcde"}


RESIDUE = ["Please enable JavaScript to view this page.", "PAGE NOT FOUND. The page you were looking for may have moved.", "Real text of the firm {{ company }} goes on here.", "价格${price}上升。", "Lorem ipsum dolor sit amet elit magna.", "xxxxx xxxx xxxxxx xxx", "Veuillez activer JavaScript pour afficher cette page.", "请开启JavaScript后重新加载页面。", "502 Bad Gateway nginx/1.2", "Growth was NaN percent for the firm."]
REAL = ["Form 500 and form 403 are due at Norpim Capital by Friday.", "The set {a, b, c} in the method note holds the largest lenders.", "The price target of [10.3] in brackets is the old one.", "“Not found on any map,” joked the manager about the office, where staff now work.", "The hotel is under construction and will not open before spring.", "", None, "   "]


def test_residue(spark):
    rows = [(i, t) for i, t in enumerate(RESIDUE + REAL)] + [(99, "A normal sentence about freight and copper. " * 4000)]
    df = spark.createDataFrame(rows, "i int, t string").withColumn("n", F.lit(1))
    known = rs.exemplars(spark)
    index = rs.exemplar_index(df, "t", known)
    got = sorted(r[0] for r in rs.residue_rows(df, ["i"], "t", index).collect())
    assert got == list(range(len(RESIDUE)))
    assert rs.residue_rows(df.limit(0), ["i"], "t", rs.exemplar_index(df.limit(0), "t", known)).count() == 0
    own = known.unionByName(spark.createDataFrame([("en", "own", "Kindly supply your story in this box.")], "lang string, kind string, text string"))
    extra = spark.createDataFrame([(1, "Kindly supply your story in this box")], "i int, t string")
    assert rs.residue_rows(extra, ["i"], "t", rs.exemplar_index(df, "t", known)).count() == 0
    assert rs.residue_rows(extra, ["i"], "t", rs.exemplar_index(df, "t", own)).count() == 1
    assert index.containment(rs.tokens("Error establishing a database connection This content is not available in your region")) > 0.9


def test_error_pages_that_a_host_serves_often_are_residue(spark):
    story = "The lender {} in the old harbour raised its forecast for the year number {} after a long meeting of all of its owners on the day before.\nTwo buyers of freight {} told the desk {} that demand for copper would slow down in the months that follow."
    notice = "Please enable JavaScript to view this page."
    wall = [(i, "h", "Story", "Please enable JavaScript to view this page. Turn on JavaScript and reload.") for i in range(10)]
    real = [(i, "h", f"Title {i}", story.format(*[f"{w}{'abcdefghijklmnopqrst'[i - 10]}x" for w in ("one", "two", "three", "four")]) + "\n" + notice) for i in range(10, 30)]
    odd = [(30, "g", "{{ headline }}", "{{ headline }}"), (31, "g", "Page not found", "Page not found"), (32, "g", "Copper rises", "Copper rises")]
    pages = spark.createDataFrame(wall + real + odd, "i int, host string, title string, text string")
    records = rs.bodies(bp.page_lines(pages, ["i"], "host", "title", "text", ["text"]), ["i"], "text")
    assert records.filter("i < 10 and body <> ''").count() == 0
    got = sorted(r[0] for r in rs.residue_rows(records, ["i"], "body", rs.exemplar_index(records, "body", rs.exemplars(spark)), None, "aside").collect())
    assert got == [*range(10), 30, 31]


def test_found_queries_on_small_tables(spark, small):
    p5, p6 = rs.p5_found(spark, small), rs.p6_found(spark, small)
    assert p5.columns == ["item_table", "item_id"] and p6.columns == ["item_table", "item_id", "line_no"]
    cases = {r[1] for r in p5.collect()}
    lines = [tuple(r) for r in p6.collect()]
    assert lines and len(lines) == len(set(lines)) and not cases & {x[1] for x in lines if x[0] == "extracted_page"}


ODD = [*"aAzZ09 ?.,-“”…¿éÉßñÃÂâ€™œ†°½漢鑱銆字かナｱ、。！’приЄіΩ\u200b\u00a0\ufffd\x07\t\r&%\\\x7f\U0001f600ŠžﬁㄱA[]/#:", "&eacute;", "http/1.1 ", "https://", "abcdef12", "decade", ".com", ".py", "[10]", "\\u00e9", "%C3%A9", "Ã©", "â€œ", "aaaaa", "\n", "\n"]


def odd_texts(n):
    rng = random.Random(6)
    return ["".join(rng.choice(ODD) for _ in range(rng.randrange(1, 24))) for _ in range(n)]


def test_lines_of_a_page_are_restored_as_one_by_one():
    for t in ["", "\n", "a\x7fb", "Il a dÃ©jÃ  dit\nQuiet line", "鑱\n漢漢漢鑱", *odd_texts(1500)]:
        assert mj.restored_lines(t) == [mj.restore(x) for x in t.split("\n")]


def test_plain_lines_of_a_page_are_not_searched(monkeypatch):
    text = "“Quoted words” of the desk rose by 5 %\nCafé & Größe — Straße\nрусский текст\n这是一个句子。\nIl a dÃ©jÃ  dit"
    seen = []
    plain = mj.looks_plain
    monkeypatch.setattr(mj, "looks_plain", lambda x: seen.append(x) or plain(x))
    assert [r[0] for r in bp.parse_page(text, None)] == [1, 2, 3, 4, 5]
    assert "Il a dÃ©jÃ  dit" in seen and not {*text.split("\n")[:1], *text.split("\n")[2:4]} & {*seen}


def test_noise_is_taken_from_the_pieces_that_have_it(monkeypatch):
    whole = lambda t: rs._NOISE.sub(" ", re.sub(r"\b[0-9a-f]{6,}\b", " ", t.lower()))
    for t in odd_texts(3000):
        assert rs._clean(t) == whole(t)

    class Never:
        def search(self, *_):
            raise AssertionError

        sub = search

    monkeypatch.setattr(rs, "_NOISE", Never())
    assert rs._clean("A plain sentence, with no codes. 这是一个句子。 5 of 7") == "a plain sentence, with no codes. 这是一个句子。   of  "


def test_rows_of_pages_from_columns():
    lists = [[[1, 2], None, [], [3]]] * len(bp.COLUMNS)
    b = pa.RecordBatch.from_arrays([pa.array(["h", "h", None, "g"]), *[pa.array(x, pa.list_(pa.int64())) for x in lists], pa.array([[7], [7], None, None], pa.list_(pa.int64())), pa.array([[True], [True], None, None], pa.list_(pa.bool_()))], ["host", *bp.COLUMNS, "te", "tl"])
    for part, want in ((b, [[(1,) * 7, (2,) * 7], [], [], [(3,) * 7]]), (b.slice(1), [[], [], [(3,) * 7]])):
        got = list(bp.page_rows(part))
        assert [rows for _, rows in got] == want and got[0][0].leads == {7: True} and got[-1][0].leads == {}
