"""Every labelled language is learned, however small its share."""
import random

from clickforge.llm import language


def test_a_language_of_a_thousandth_is_learned(spark):
    rnd = random.Random(4)
    english = "the river runs by old houses and is not far from that small town with its market for fish".split()
    finnish = "talo on vanha ja joki virtaa hitaasti kylän läpi missä ihmiset ostavat kalaa torilta talvella".split()
    rows = [(k, " ".join(rnd.choice(english) for _ in range(40)), "en") for k in range(2997)]
    rows += [(k + 5000, " ".join(rnd.choice(finnish) for _ in range(40)), "fi") for k in range(3)]
    model = language.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["en", "fi"]
    assert [x["lang_pred"] for x in language.identify(model, ["vanha talo kylän läpi", "old houses by the river"])] == ["fi", "en"]


def test_scores_do_not_depend_on_slices(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language.fit_languages(docs)
    texts = [r.text for r in docs.limit(50).collect()]
    whole = language.identify(model, texts)
    monkeypatch.setattr(language, "LOOKUPS", 4000)
    assert language.identify(model, texts) == whole
