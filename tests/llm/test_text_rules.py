"""Quality rules, line dedup, personal data and licences."""
import hashlib
import random
import re
from collections import Counter, defaultdict

from clickforge.llm import licenses, pii
from clickforge.llm.line_dedup import drop_repeated_lines, repeated_lines
from clickforge.llm.quality import fit_quality, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(text):
    w = WORD.findall(text or "")
    c = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if c[tuple(w[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_quality_counts(docs):
    for r in quality_rules(docs).select("text", "quality.*").collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_counts(r.text)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_quality_keeps_good_documents(spark, sf, docs):
    good = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1")
    rows = quality_rules(docs).join(good.select("doc_id"), "doc_id").select("quality.*").collect()
    assert all(r.kept for r in rows if not r.base_failed)


def test_quality_rejects_odd_characters(spark, docs):
    refs = fit_quality(docs)
    shout = " ".join(f"AB{i}!!%% | {i}#" for i in range(300))
    row = quality_rules(spark.createDataFrame([(1, shout)], "doc_id long, text string").selectExpr("*", "'en' lang"), refs).first()
    assert not row.quality.base_failed and not row.quality.kept


def test_quality_odd_input(odd, nothing):
    rows = quality_rules(odd).select("text", "quality.*").collect()
    assert len(rows) == 12
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_counts(r.text)
    assert quality_rules(nothing).count() == 0


def brute_lines(rows):
    key = lambda x: re.sub("[A-Z]", lambda m: m.group().lower(), x.strip("\x20\t\n\v\f\r"))
    holders = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if i is not None and len(key(x)) >= 10:
                holders[key(x)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(key(x)) < 10 or min(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


def lines_of(df, **kw):
    return Counter((r.doc_id, r.lines.n_lines, r.lines.n_dropped, hashlib.sha256((r.text or "").encode()).hexdigest())
                   for r in drop_repeated_lines(df, **kw).collect())


def test_lines_against_brute_force(docs, odd, nothing):
    assert lines_of(docs) == brute_lines([(r.doc_id, r.text) for r in docs.collect()])
    assert lines_of(odd) == brute_lines([(r.doc_id, r.text) for r in odd.collect()])
    assert lines_of(nothing) == Counter()


def test_a_full_filter_loses_no_repeat(docs):
    small = repeated_lines(docs, filter_bits=1 << 12)
    assert {tuple(r) for r in small.collect()} == {tuple(r) for r in repeated_lines(docs).collect()}


def plain_spans(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        s = sum(int(c) if k % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) for k, c in enumerate(reversed(d)))
        if 13 <= len(d) <= 19 and s % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_spans_against_plain_patterns(docs):
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("a1@.+- ()5_0é2") for _ in range(rnd.randrange(70))) for _ in range(20000)]
    for t in texts + [r.text for r in docs.collect()]:
        assert list(pii.base_spans(t)) == plain_spans(t)


def test_checksums_and_context():
    found = pii.find_personal_data("IBAN DE89 3704 0044 0532 0130 00, call (629) 555-0812, card 4111 1111 1111 1111")
    assert [s["kind"] for s in found] == ["card", "iban", "local_phone"]
    assert found[1]["score"] > pii.START_SCORE["iban"] and found[2]["score"] > pii.START_SCORE["local_phone"]
    assert pii.find_personal_data("DE89 3704 0044 0532 0130 01") == []
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod_97("GB82WEST12345698765432")


def test_personal_data_odd_input(odd, nothing):
    rows = pii.personal_data(odd).collect()
    assert len(rows) == 12 and {r.doc_id: len(r.spans) for r in rows}[10] == 1
    assert all(r.spans == [] for r in rows if not r.text)
    assert pii.personal_data(nothing).count() == 0


def test_licence_rules(spark, odd, nothing):
    mit = ("# Permission is hereby granted, free of charge, to any person\n# obtaining a copy of this. "
           "The above copyright notice and this permission notice shall be included in all copies. "
           "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND.")
    texts = {1: "Some prose. Licensed under the Apache License, Version 2.0.\nMore prose.", 2: mit, 3: None, 4: "no terms here",
             5: "This work is licensed under the GNU General Public License, version 3.", 6: "Licensed under CC BY-NC 4.0.",
             7: "token cc0a1 abc.", 8: "Released under the MIT License. All rights reserved. Licensed under some other terms."}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.licence for r in licenses.scan_licenses(df).collect()}
    assert got[1].names == ["Apache-2.0"] and got[2].names == ["MIT"] and got[2].sentences == ["mit-grant", "mit-notice", "as-is-warranty"]
    assert got[3].names == got[4].names == got[7].names == [] and got[5].names == ["GPL-3.0"] and got[6].names == ["CC-BY-NC-4.0"]
    assert got[8].names == ["MIT", "proprietary"] and got[8].unmatched == 1
    assert licenses.scan_licenses(odd).where("size(licence.names) = 0").count() == 12
    assert licenses.scan_licenses(nothing).count() == 0
