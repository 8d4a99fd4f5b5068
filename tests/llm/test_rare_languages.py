"""Languages of a small share of the documents."""
import random

from clickforge.llm import language
from clickforge.llm.quality import quality_rules

HINDI = "नमस्ते दुनिया कैसे हो हिन्दी में लिखा हुआ पाठ जिसे पढ़ना चाहिए और समझना भी आवश्यक है क्योंकि यह परीक्षण है".split()
ENGLISH = "the river runs by old houses and is not far from that small town with its market for fish to eat in winter".split()


def text(words, seed, n=80):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(words) for _ in range(n))


def test_quality_has_a_reference_for_every_language(spark):
    rows = [(k, text(ENGLISH, k), "en") for k in range(300)] + [(1000, text(HINDI, 0), "hi"), (1001, text(HINDI, 1), "hi")]
    rows.append((2000, "".join(f" AB{i}!!%%{i}#" for i in range(90)), "en"))
    got = {r.doc_id: r.quality for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert len(got) == len(rows) and got[1000].kept and got[1001].kept and got[5].kept and not got[2000].kept


def test_quality_without_a_common_language(spark):
    rows = [(k, text(ENGLISH, k), f"l{k}") for k in range(150)] + [(900, text(ENGLISH, 900), None)]
    got = {r.doc_id: r.quality for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[k].kept and got[k].char_distance is not None for k in range(150))
    assert got[900].kept and got[900].char_distance is None
