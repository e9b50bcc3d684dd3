import pytest
from pyspark.sql import functions as F

from veldspar.llm import language as lg


@pytest.fixture(scope="module")
def model(spark, small):
    d = spark.read.parquet(f"{small.replace('0.001', '0.01')}/documents.parquet")
    return lg.fit_languages(d, "text", "lang")


def test_held_out_accuracy(model):
    right, n = model.held_out
    assert n > 200 and right >= 0.98


def test_no_sentence_is_both_trained_on_and_held_out(monkeypatch):
    rows = [(f"The number {chr(97 + i % 26)}{chr(97 + i // 26)} of them rose.", "en") for i in range(60)] + [(f"Die Zahl {chr(97 + i % 26)}{chr(97 + i // 26)} davon stieg.", "de") for i in range(60)]
    seen = []
    real = lg.gram_ids
    monkeypatch.setattr(lg, "gram_ids", lambda t: seen.append(t) or real(t))
    m = lg.LanguageModel.fit(rows * 3, [8] * 360)
    assert len(seen) == len(set(seen)) == 120 and m.held_out[1] == 24


def test_same_rows_give_the_same_model():
    rows = [("The cat sat on the mat today.", "en"), ("Der Hund lief in das Haus hinein.", "de")] * 20
    a, b = lg.LanguageModel.fit(rows), lg.LanguageModel.fit(list(reversed(rows)))
    assert (a.scores == b.scores).all()


@pytest.mark.parametrize("label,want", [("EN", "en"), ("en_GB", "en"), ("zh_Hans", "zh"), ("German", "de"), ("pt-BR", "pt"), (None, None), ("", None), ("und", None), ("mul", None), ("n/a", None), ("Klingon", "other"), (" fr ", "fr")])
def test_labels(spark, label, want):
    assert lg.label_code(label) == want
    assert spark.createDataFrame([(label,)], "l string").select(lg.label_column(F.col("l"))).first()[0] == want


def test_segments():
    s = lg.segments("Menu\nThe board told J. Smith that margins rose 4.5 points. Nobody else was asked about it.\n研究员表示货运量扩大。\n\nOk.")
    assert s == ["The board told J. Smith that margins rose 4.5 points.", "Nobody else was asked about it.", "研究员表示货运量扩大。"]
    assert lg.segments("") == []


def test_segment_languages(spark, model):
    en = "The finance team told the board that copper supply would stay steady through the winter."
    de = "Mehrere Käufer erklärten gegenüber dem Vorstand, dass der Umsatz im Quartal gestiegen sei."
    rows = [(1, en), (2, en + "\n" + de), (3, None), (4, ""), (5, "Menu\nHome"), (6, (en + " ") * 400), (7, de.encode().decode("cp1252", "ignore"))]
    df = spark.createDataFrame(rows, "k int, t string").withColumn("lang_code", F.lit("clash"))
    got = {}
    for r in lg.segment_languages(df, ["k"], "t", model).collect():
        assert 0.5 < r["confidence"] <= 1
        got.setdefault(r["k"], set()).add(r["lang_code"])
    assert got == {1: {"en"}, 2: {"en", "de"}, 6: {"en"}, 7: {"de"}}
    by_segment = [tuple(r)[:2] + (r["lang_code"],) for r in lg.segment_rows(df, ["k"], "t", model).filter("k < 6").collect()]
    assert sorted(by_segment) == [(1, 1, "en"), (2, 1, "en"), (2, 2, "de")]
    unsure = lg.LanguageModel(model.scores, model.temperature, 1.1)
    rejected = [tuple(r) for r in lg.segment_languages(df.filter("k in (2, 3, 5)"), ["k"], "t", unsure).collect()]
    assert [(r[0], r[1], r[2]) for r in rejected] == [(2, None, 2)]
    assert lg.segment_languages(df.limit(0), ["k"], "t", model).count() == 0


def test_no_labels_reject_everything(spark):
    m = lg.fit_languages(spark.createDataFrame([], "t string, l string"), "t", "l")
    assert m.classify(["The finance team told the board."]) [0][0] is None
