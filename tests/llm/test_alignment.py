"""Tokenizer alignment against brute force over every pair of tokens."""
import hashlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from clickforge.llm import alignment

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(rows):
    """{place of the row: its digest}, from the tokenizers' own outputs and all pairs of tokens."""
    tok, sp = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    tok.encode_special_tokens = True
    alphabet = alignment.byte_of_char()
    names = {i: t for t, i in tok.get_vocab().items()}

    def spans(ids, spelled):
        at, out = 0, []
        for i in ids:
            out.append((i, at, at + len(spelled(i))))
            at = out[-1][2]
        return out

    def a_bytes(i):
        return bytes(alphabet[c] for c in names[i])

    def b_bytes(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    links, groups = {}, {}
    for k, text in enumerate(rows):
        links[k], groups[k] = [], []
        if not text:
            continue
        a, b, raw = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text), (" " + text).encode()
        if b"".join(map(a_bytes, a)) != raw or b"".join(map(b_bytes, b)) != raw:
            continue
        a, b = spans(a, a_bytes), spans(b, b_bytes)
        if len(a) < 3000:
            links[k] = [(x, y) for x, s, e in a for y, t, f in b if max(s, t) < min(e, f)]
        else:  # the same by a walk
            j = 0
            for x, s, e in a:
                while b[j][2] <= s:
                    j += 1
                i = j
                while i < len(b) and b[i][1] < e:
                    links[k].append((x, b[i][0]))
                    i += 1
        cuts, at = sorted({e for _, _, e in a} & {f for _, _, f in b}), 0
        for c in cuts:
            groups[k].append(([x for x, s, e in a if at < e <= c] if len(a) < 3000 else None, [y for y, t, f in b if at < f <= c] if len(a) < 3000 else None))
            at = c
        if len(a) >= 3000:
            groups[k] = [([], []) for _ in cuts]
            place = {}
            n = 0
            for e in range(1, cuts[-1] + 1):
                place[e] = n
                n += e == cuts[n]
            for x, s, e in a:
                groups[k][place[e]][0].append(x)
            for y, t, f in b:
                groups[k][place[f]][1].append(y)
        links[k] = (links[k], len(a), len(b))
    texts = defaultdict(set)
    for k, v in links.items():
        for p in v[0] if v else ():
            texts[p].add(k)
    most = defaultdict(int)
    for (x, _), s in texts.items():
        most[x] = max(most[x], len(s))
    out = {}
    for k, v in links.items():
        own, n_a, n_b = v or ([], 0, 0)
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups[k])
        out[k] = (n_a, n_b, len(groups[k]), len(own), sum(len(texts[p]) == most[p[0]] for p in own), sum(len(texts[p]) for p in own),
                  hashlib.sha256(said.encode()).hexdigest() if said else "")
    return out


def digest(r):
    return r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256


ODD_TEXTS = ["<|endoftext|> and <s> </s> <unk> <0x41>", "a ▁ b", "\x00\x01 tab\there", "日本語テキスト です 🙂👍🏽", "don't 3½² we'LL", " lead and trail ", "\n\n\n   x",
             "é café ́x ﬁ", "<s>", "　wide", "x" * 5000, None, "", "\r\n"]


@pytest.mark.parametrize("limit", [alignment.COUNT_BYTES, 0])
def test_digests_against_brute_force(spark, sf, docs, limit):
    text = [r.text for r in docs.where("doc_id < 60").collect()] + ODD_TEXTS + ODD_TEXTS[:3]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(text)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: digest(r) for r in alignment.align_tokenizers(df, BYTE, PIECE, count_bytes=limit).collect()}
    assert got == brute(text)


def test_odd_input(spark, odd, nothing):
    rows = odd.select("doc_id", "text").collect()
    want = sorted(((r.doc_id or 0), d) for r, d in zip(rows, brute([r.text for r in rows]).values()))
    assert sorted(((r.doc_id or 0), digest(r)) for r in alignment.align_tokenizers(odd, BYTE, PIECE).collect()) == want
    for limit in (alignment.COUNT_BYTES, 0):
        assert alignment.align_tokenizers(nothing, BYTE, PIECE, count_bytes=limit).count() == 0


def test_pointers_reach_the_last_token_of_a_chain():
    """Tokens of A at odd and of B at even bytes: one chain over all of them."""
    n = 500
    size = np.array([0, 1, 2])
    a, b = np.array([2] * n), np.array([1] + [2] * (n - 1) + [1])
    run = alignment.Aligned(a, b, np.zeros(n, int), np.zeros(n + 1, int), size, size)
    assert set(run.group_a) == set(run.group_b) == {n - 1} and len(run.links()[0]) == 2 * n
