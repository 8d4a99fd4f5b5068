"""Licence sentences that a line break, blanks or a comment leader interrupts."""
from clickforge.llm import licenses

WRAPPED = {1: ("This work is dedicated to the public\ndomain.", "public-domain"), 2: ("# All rights\n# reserved.", "rights-reserved"),
           3: ("Text under CC\nBY 4.0", "cc-by-4"), 4: ("// CC\n//  BY-SA   4.0", "cc-by-sa-4"), 5: ("All  rights \t reserved", "rights-reserved"),
           6: ("neither the name of Acme\n# may be used to endorse or promote products", "bsd-endorse")}


def test_wrapped_sentences_are_scanned(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _) in WRAPPED.items()] + [(9, "access to the account")], "doc_id long, text string")
    got = {r.doc_id: list(r.licence.sentences) for r in licenses.scan_licenses(df).collect()}
    assert got == {k: [x] for k, (_, x) in WRAPPED.items()} | {9: []}


def test_every_known_sentence_holds_a_stem():
    plain = [p.replace("licen[sc]e", "license").replace("licen[sc]ed", "licensed") for _, p in licenses.SENTENCES]
    assert all(any(x in p for x in licenses.STEMS) or p.startswith("cc ") for p in plain)
