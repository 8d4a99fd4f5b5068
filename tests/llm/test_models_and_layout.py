"""Decontamination, language, toxicity, sharding, packing and the pipeline."""
import random
import zlib
from collections import defaultdict
from itertools import product

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from clickforge.llm import decontam, language, packing, toxicity
from clickforge.llm.queries import QUERIES
from clickforge.llm.sharding import schedule, shard_documents

PATH = public_tokenizers.path("word_bpe_49k.json")


def edits(a, b):
    """Least edits of the whole of ``a`` against any part of ``b``."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_edited_windows_are_found_exactly_when_within_budget(spark, sf):
    items = [(r.item_id, decontam.fold(r.text.strip())[0]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rnd, text = random.Random(5), spark.read.parquet(f"{sf}/documents.parquet").where("length(text) > 900").first().text
    for trial in range(60):
        item, code = rnd.choice(items)
        index = decontam.Index([(item, code)])
        s = list("".join(map(chr, code)))
        for _ in range(rnd.randrange(0, 22)):
            k = rnd.randrange(len(s))
            s[k:k + 1] = rnd.choice([["q"], [], [s[k], "z"]])
        host = text[:400] + " " + "".join(s) + " " + text[500:800]
        folded = "".join(map(chr, decontam.fold(host)[0]))
        want = any(edits("".join(map(chr, p)), folded) <= e for p, e in zip(index.pattern, index.edits))
        assert bool(list(index.regions(["unrelated", host, ""]))) == want


def test_leaks_of_whole_passages(spark, sf, docs):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    items = {r.item_id: r.text for r in bench.collect()}
    rows = decontam.find_leaks(docs, bench).collect()
    exact = {(r.doc_id, i) for r in rows for i, t in items.items() if t in r.text}
    found = {(r.doc_id, x.item_id) for r in rows for x in r.leaks}
    assert exact <= found
    for r in rows:
        for x in r.leaks:
            assert 0 <= x.start < x.end <= len(r.text) and x.edits <= 12
            assert items[x.item_id].strip().rstrip(".") in r.text[x.start - 1:x.end + 1] or (r.doc_id, x.item_id) not in exact
    assert decontam.without_leaks(docs, bench).count() == sum(not r.leaks for r in rows)


def test_leaks_do_not_depend_on_blocks(spark, sf, docs, odd, nothing, monkeypatch):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    whole = {(r.doc_id, x.item_id) for r in decontam.find_leaks(docs, bench).collect() for x in r.leaks}
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 3000)
    assert {(r.doc_id, x.item_id) for r in decontam.find_leaks(docs, bench).collect() for x in r.leaks} == whole
    assert decontam.find_leaks(odd, bench).where("size(leaks) = 0").count() == 12
    assert decontam.find_leaks(nothing, bench).count() == 0
    none = spark.createDataFrame([(1, None), (None, "short")], "item_id long, text string")
    assert decontam.without_leaks(odd, none).count() == 12


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(3)
    for _ in range(80):
        n = int(rng.integers(1, 7))
        scores = rng.integers(-6, 6, (n, 3)).astype(float)

        def value(p):
            return sum(scores[i, p[i]] for i in range(n)) - 2 * sum(p[i] != p[i - 1] for i in range(1, n))

        assert value(language.viterbi(scores.copy(), np.zeros(n, int), 2.0)) == max(map(value, product(range(3), repeat=n)))


def test_language_held_out_and_spans(spark, sf, odd, nothing):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = QUERIES["op7_language"](spark, sf).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 20 and sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    model = language.fit_languages(docs)
    text = {r.lang: r.text for r in docs.where("length(text) between 1000 and 3000").collect()}
    found = language.identify(model, [text["en"] + " " + text["de"]])[0]
    assert {"en", "de"} <= {s["lang"] for s in found["spans"]} and found["score"] < 1
    got = {r.doc_id: r.language for r in language.label_languages(odd, model).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == "und" and got[1].score == 0
    assert language.label_languages(nothing, model).count() == 0
    assert {r.language.lang_pred for r in language.label_languages(odd, language.fit_languages(nothing)).collect()} == {"und"}


def test_scripts_narrow_the_candidates(spark):
    rows = [(i, "привет мир как дела друг", "ru") for i in range(5)] + [(i + 9, "hello world how are you friend", "en") for i in range(5)]
    model = language.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert [x["lang_pred"] for x in language.identify(model, ["неизвестно", "unknown", "123 !"])] == ["ru", "en", "und"]


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op10_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    toxic, clean = [r for r in rows if r.toxic], [r for r in rows if not r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.8 * len(toxic) and sum(r.predicted for r in clean) <= 0.01 * len(clean)
    assert all(0 <= r.score <= 1 for r in rows)


def test_machine_learns_a_pair():
    """Two terms that only together mean the label: no linear weights can do that with these counts."""
    rng = np.random.default_rng(0)
    lists = [[0] * int(a) + [1] * int(b) for a, b in rng.integers(0, 2, (2000, 2))]
    y = np.array([float(x == [0, 1]) for x in lists])
    m = toxicity.fit_machine(lists, y, [5, 6], 0.0)
    score = m.scores(np.array([0, 1, 2, 2]), np.array([0, 1, 0, 1]), 4)
    assert score[2] > 0.9 and max(score[[0, 1, 3]]) < 0.1


def test_toxicity_odd_input(spark, odd, nothing):
    labels = spark.createDataFrame([(4, 0), (5, 1), (7, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.fit_toxicity(odd, labels.where("toxic = 1")) is None
    assert toxicity.fit_toxicity(nothing, labels) is None
    rows = toxicity.score_toxicity(odd, toxicity.fit_toxicity(odd, labels)).collect()
    assert len(rows) == 12 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score_toxicity(odd, None).where("score = 0").count() == 12


def test_schedule_is_longest_first():
    assert schedule([(5, "a"), (4, "b"), (3, "c"), (3, "d"), (1, "e")], 2) == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}


def test_shards(docs, odd, nothing):
    for df in (docs, odd):
        rows = shard_documents(df).collect()
        text = [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
        assert sorted(((r.doc_id or 0), r.size, r.text_crc32) for r in rows) == sorted(
            ((i or 0), len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in text)
        slots, of_text = defaultdict(list), defaultdict(set)
        for r in rows:
            slots[r.shard].append(r.slot)
            of_text[r.text_crc32].add(r.shard)
        assert all(sorted(x) == list(range(len(x))) for x in slots.values())
        assert all(len(x) == 1 for x in of_text.values())
    load = defaultdict(int)
    for r in shard_documents(docs).collect():
        load[r.shard] += r.size
    biggest = max(sum(len(t.encode()) + 1 for _, t in text) / 16, 1)
    assert len(load) == 16 and biggest > 0
    assert max(load.values()) - min(load.values()) <= 35_000  # one group of equal texts at most
    assert shard_documents(nothing).count() == 0


def check_pieces(rows, texts):
    tok = Tokenizer.from_file(PATH)
    docs, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
    for i, t in texts.items():
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(docs[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert bytes(r.ids) == np.array(ids[at:at + r.length], "<u4").tobytes()
            at += r.length
        assert at == len(ids)
    for x in seqs.values():
        at = 0
        for r in sorted(x, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    return len(seqs), sum(r.length for r in rows)


def test_packing_is_a_partition_of_all_ids(docs):
    sub = docs.dropDuplicates(["doc_id"])
    rows = packing.pack_documents(sub, PATH).collect()
    n, ids = check_pieces(rows, {r.doc_id: r.text for r in sub.collect()})
    assert n * 2048 <= ids + 2048 * sub.rdd.getNumPartitions()


def test_packing_odd_input(odd, nothing):
    one = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    check_pieces(packing.pack_documents(one, PATH).collect(), {r.doc_id: r.text for r in one.collect()})
    assert packing.pack_documents(odd, PATH).where("start = 0").count() == 12
    assert packing.pack_documents(nothing, PATH).count() == 0


def test_encoder_equals_the_tokenizer():
    enc = packing.PieceEncoder(PATH)
    for t in ["<|endoftext|>x y<|startoftext|>", "a\x1cb c\x85d\xa0e", "ΣΑΣ ΟΔΟΣ", "İstanbul I'M don't we'LL 3½²", "é café ́x", "", " ",
              "日本語テキスト です", "ß ŒUVRE ǅ", "a'S b'tx", "x<|y|>z", "ªº µ ÿ Ÿ × ÷ 10²³", "''ss 're're"]:
        assert enc.batch([t])[0] == enc.direct(t)


def test_a_placement_minimises_the_sum_of_squares():
    rnd = random.Random(6)
    packer = packing.SumOfSquares(lambda pieces: None, window=16, max_open=10 ** 6)
    for step in range(400):
        size = rnd.randrange(1, 16)

        def total(level):
            n = packer.count.copy()
            n[level] -= bool(level)
            if level + size < 16:
                n[level + size] += 1
            return int((n ** 2).sum())

        options = [0] + [h for h in range(1, 17 - size) if packer.count[h]]
        assert total(packer.level_for(size)) == min(map(total, options))
        packer.add(step, bytes(4 * size))


def test_pipeline_stages(spark, sf, docs):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]
    kept = {r.doc_id for r in QUERIES["op5_quality_rules"](spark, sf).where("kept").collect()}
    out = stages["quality"](spark, docs, sf)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == kept
    lines = stages["line_dedup"](spark, docs, sf)
    assert lines.columns == docs.columns and lines.count() == docs.count() and all(r.n_chars == len(r.text) for r in lines.collect())
    near = {r.doc_id for r in QUERIES["op2_near_duplicates"](spark, sf).where("kept").collect()}
    assert {r.doc_id for r in stages["near_dedup"](spark, docs, sf).collect()} == near
    leaked = {r.doc_id for r in QUERIES["op4_decontamination"](spark, sf).collect()}
    assert {r.doc_id for r in stages["decontamination"](spark, docs, sf).collect()} == {r.doc_id for r in docs.collect()} - leaked


def test_pipeline_run(spark, sf):
    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and max(r.offset + r.length for r in rows) <= 2048


def test_known_pieces_do_not_turn_the_cache_over(monkeypatch):
    import public_tokenizers
    from clickforge.llm import packing
    monkeypatch.setattr(packing, "CACHE", 8)
    encoder = packing.PieceEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["one two three four five", "five four three two one six", "seven eight nine ten", ""]
    want = [encoder.direct(t) for t in texts]
    assert encoder.batch(texts[:2]) == want[:2] and len(encoder.new) == 6
    assert encoder.batch(texts[:2]) == want[:2] and not encoder.old  # nothing new: nothing forgotten
    assert encoder.batch(texts) == want and encoder.batch(texts[::-1]) == want[::-1]
