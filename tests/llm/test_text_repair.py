import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from veldspar.llm import confusables as c
from veldspar.llm import mojibake as m

SENTENCES = [
    "Müller verlängert den Mietvertrag für „Körner“ im zweiten Quartal.", "L’épargne a progressé de 7,5 % à Besançon, note François.", "¿Por qué subió el precio del año pasado? José apunta a España.",
    "A produção não caiu; São Paulo manteve o preço do aço.", "По данным «Остотульнор», прирост вкладов отстал на 89.5%.", "研究员表示，货运量扩大至638点，监管部门认为前景温和。",
    "倉庫を開設したという。エネルギー価格は増えた。", "Bexfir Mutual’s “record” margin — up €3.5 million.",
]
WAYS = [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "mac_roman"), ("utf-8", "gbk"), ("utf-8", "cp1251"), ("utf-8", "cp437")]


def test_round_trip_of_wrong_encodings():
    done = tried = 0
    for s in SENTENCES:
        for enc, dec in WAYS:
            try:
                bad = s.encode(enc).decode(dec)
            except UnicodeDecodeError:
                continue
            tried += 1
            done += m.restore(bad) == s
    assert tried >= 20 and done >= 0.85 * tried
    assert m.restore("研究员长期跟踪物流".encode("gbk").decode("latin-1")) == "研究员长期跟踪物流"
    assert m.restore("Редакция сообщает".encode("cp1251").decode("latin-1")) == "Редакция сообщает"
    double = SENTENCES[1].encode().decode("cp1252").encode().decode("cp1252", "ignore")
    assert "épargne" in m.restore(double)


@pytest.mark.parametrize("s", [*SENTENCES, "NAÇÃO NÃO VÊ AÇÃO", "ÉLDOVVEL ÑANDULURD ØRJALDRA", "© 2024 · 5 m² ½ €3", "", "plain", "ÀÉÎ Œuvre cœur", "恒衡集团（海外）"])
def test_genuine_text_stays(s):
    assert m.restore(s) == s and not m.is_garbled(s)


@pytest.mark.parametrize("given,want", [
    ("J&uuml;rgen", "Jürgen"), ("K&ouml;ln &amp;amp; Co", "Köln &amp; Co"), ("caf\\u00e9 bar", "café bar"), ("\\ud83d\\ude00 ok", "😀 ok"), ("caf%C3%A9 bar", "café bar"), ("Caf&Atilde;&copy;", "Café"), ("%C3%83%C2%A9tat", "état"),
    ("el grupo verlŠngert den Mietvertrag", "el grupo verlängert den Mietvertrag"), ("Y. LÂvaxwim wrote", "Y. Låvaxwim wrote"), ("34777 comments ‚Äì join", "34777 comments – join"), ("deposit ¬£growth", "deposit £growth"), ("order ΓÇÿintakeΓÇÖ in", "order ‘intake’ in"),
])
def test_escapes_and_single_characters(spark, given, want):
    assert m.restore(given) == want
    df = spark.createDataFrame([(1, given), (2, want)], "k int, t string")
    assert [(r[0], r[2]) for r in m.garbled_fields(df, "k", ["t"]).collect()] == [(1, want)]


@pytest.mark.parametrize("s", ["Q&A and R&D; fine", "Q&amp;A", "see https://x.org/caf%C3%A9", "100%", "%20 off", "C:\\users", "a\\nb", "¥57 and £9"])
def test_escapes_in_earnest_stay(s):
    assert m.restore(s) == s


def test_lines_of_the_tables_come_back(spark, small):
    texts = [t for r in spark.read.parquet(f"{small}/raw_signal.parquet").select("title", "raw_text").collect() for t in r if t]
    lines = sorted({x for t in texts for x in t.split("\n") if not x.isascii() and len(x) > 12 and m.looks_plain(x)})
    for (enc, dec), least in {("utf-8", "cp1252"): 0.95, ("utf-8", "latin-1"): 0.97, ("utf-8", "mac_roman"): 0.95, ("utf-8", "koi8-r"): 0.95, ("utf-8", "gbk"): 0.85, ("cp932", "latin-1"): 0.85}.items():
        done = tried = 0
        for s in lines:
            try:
                bad = s.encode(enc).decode(dec)
            except UnicodeError:
                continue
            if bad != s:
                tried += 1
                done += m.restore(bad) == s
        assert tried >= 15 and done >= least * tried, (enc, dec, done, tried)


def test_garbled_fields_and_defined_cases(spark):
    rows = [(1, "MenÃ¼ fÃ¼r alle", "fine"), (2, None, ""), (3, "ok", "a line\nKÃ¶ln liegt am Rhein\nend"), (4, "lost �ndulurd", "x" * 200_000), (5, "ok", None)]
    df = spark.createDataFrame(rows, "k int, title string, body string").withColumn("restored", F.lit("clash")).withColumn("field_name", F.lit("clash"))
    got = {(r[0], r[1]): r[2] for r in m.garbled_fields(df, "k", ["title", "body"]).collect()}
    assert set(got) == {(1, "title"), (3, "body"), (4, "title")}
    assert got[1, "title"] == "Menü für alle" and got[3, "body"] == "a line\nKöln liegt am Rhein\nend"
    assert m.garbled_fields(df.limit(0), "k", ["title"]).count() == 0


VARIANTS = [
    ("ra­il tonnage", "rail tonnage"), ("in Pels", "in Pels"), ("ｔｈｅ note", "the note"), ("reﬁnery", "refinery"), ("Go\u0308tting", "Götting"), ("thе nоte", "the note"),
    ("Вау is near", "Bay is near"), ("Οrder of the day", "Order of the day"), ("⼯厂开工", "工厂开工"), ("ﾊﾞｯﾃﾘｰ生産は", "バッテリー生産は"), ("ждyт перeмен", "ждут перемен"), ("订单量８.５点", "订单量8.5点"),
    ("hellո", "helln"), ("Ꭺpple", "Apple"), ("ʟabs", "Labs"), ("ɡood", "good"), ("ⅼine", "line"), ("ⓐⓑⓒ", "abc"), ("co‐op", "co-op"), ("1⁄2 cup", "1/2 cup"), ("汽⻋上牌量", "汽车上牌量"), ("Аpple 公司的净出口上升了这么多个点", "Apple 公司的净出口上升了这么多个点"), ("ԁone the work", "done the work"),
]
PLAIN = ["Chapter Ⅷ begins", "①第一", "Yıldız", "Հայաստան", "ОАО рост", "Team 👩‍💻 met", "coefficient α stood at 0.4 and β at 1.2", "model put ΔQ near ½", "1200 m² – café", "listed as 恒衡集团（海外） there", "сказал Velmora Group в городе", "the Вельдра Жилинск desk", "点。（详见附注：第二节）！", "Öl für 3 €", "", "L’œuvre coûte"]


@pytest.mark.parametrize("given,want", VARIANTS)
def test_variants_become_plain(given, want):
    assert c.plain_form(given) == want and c.skeleton(given) == c.skeleton(want)
    assert c.plain_form(want) == want
    assert c.is_variant(given) and not c.is_variant(want)


@pytest.mark.parametrize("text", PLAIN)
def test_text_in_earnest_stays(text):
    assert c.plain_form(text) == text


def test_skeleton_groups(spark):
    rows = [(1, "the note"), (2, "thе note"), (3, "ｔｈｅ note"), (4, "another"), (5, None), (6, ""), (7, "the note")]
    df = spark.createDataFrame(rows, "k int, t string").withColumn("plain", F.lit(1)).withColumn("sk", F.lit(1))
    got = {r["k"]: (r["class_id"], r["class_size"], r["plain"]) for r in c.skeleton_groups(df, "k", "t").collect()}
    assert got == {1: (1, 4, True), 2: (1, 4, False), 3: (1, 4, False), 7: (1, 4, True), 4: (4, 1, True), 6: (6, 1, True)}
    assert sorted(r["k"] for r in c.confusable_rows(df, "t").collect()) == [2, 3]
    assert c.skeleton_groups(df.limit(0), "k", "t").count() == 0


BASES = ["The note from Velmor links résumé costs to 45.7 points in Münster.", "По данным «Остотульнор», прирост вкладов отстал на 89.5%.", "研究员表示，货运量扩大至638点，监管部门认为前景温和。", "倉庫を開設したという。エネルギー価格は増えた。"]


def test_injected_variants_go_and_nothing_else_does():
    """Texts of one script with characters put in at random come back as they were; a plain form stays."""
    rng = random.Random(5)
    for _ in range(400):
        base = rng.choice(BASES)
        out = []
        for ch in base:
            r = rng.random()
            if r < 0.05:
                out.append(chr(rng.choice([0x200B, 0x2060, 0xAD, 0xFEFF])))
            if ch == " " and r > 0.6:
                ch = chr(rng.choice([0xA0, 0x2009, 0x2003, 0x202F]))
            elif ch.isdigit() and r > 0.5:
                ch = chr(ord(ch) + 0xFEE0)
            elif ch.isalpha() and r > 0.7:
                ch = unicodedata.normalize("NFD", ch)
            out.append(ch)
        assert c.plain_form("".join(out)) == base and c.plain_form(base) == base
