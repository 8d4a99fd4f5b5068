"""Spelling variants against brute force over all pairs of words."""
import random
import re
import zlib
from collections import Counter

from clickforge.llm import spelling


def near(a, b):
    """Exactly one inserted, deleted or replaced character apart."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    gone = {}
    for w in n:  # candidates share a word without one character, or are one
        for d in {w} | {w[:i] + w[i + 1:] for i in range(len(w))} if len(w) < 500 else {w}:
            gone.setdefault(d, []).append(w)
    mates = {w: set() for w in n}
    for group in gone.values():
        for a in group:
            mates[a].update(b for b in group if b != a and near(a, b))
    form = {}
    for w, m in mates.items():
        best = min(m, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted((w, k, len(mates[w]), form[w], form[w] and n[form[w]], root(w)) for w, k in n.items())


def found(df, **more):
    return sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.spelling_variants(df, **more).collect())


def test_documents_against_brute_force(spark, docs):
    assert found(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_few_letters_and_long_chains(spark):
    """Words over two letters: runs, many near words, shared beginnings and ends across ranges; and forms of forms."""
    rnd = random.Random(4)
    words = ["".join(rnd.choices("ab", k=rnd.randrange(7, 10))) for _ in range(1500)] + ["a" * k for k in range(7, 80)] * 2
    words += ["zzzzzzzz"] * 8000 + ["zzzzzzzy"] * 588 + ["zzzzzzxy"] * 42 + ["zzzzzwxy"] * 3 + ["ÀÀÀÀÀÀÀ", "àààààààà"] * 9
    rnd.shuffle(words)
    rows = [(i, " ".join(words[k: k + 50])) for i, k in enumerate(range(0, len(words), 50))]
    got = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute(rows)
    assert {r[5] for r in got if r[0] == "zzzzzwxy"} == {"zzzzzzzz"}


def test_node_numbers_are_one_to_one():
    """A beginning has one number, whatever the cut into ranges."""
    rnd = random.Random(2)
    words = sorted({"".join(rnd.choices("abc", k=rnd.randrange(1, 7))) for _ in range(300)})
    for parts in (1, 3, 40):
        cut = {w: k * parts // len(words) for k, w in enumerate(words)}
        firsts = {p: min(w for w in words if cut[w] == p) for p in set(cut.values())}
        number, places = {}, []
        for part in rnd.sample(sorted(firsts), len(firsts)):
            trie = spelling.Trie(firsts)
            for w in words:
                if cut[w] == part:
                    place, path = trie.add(part, w)
                    places.append((place, w))
                    for d, node in enumerate(path):
                        assert number.setdefault(w[:d], node) == node
        assert len(set(number.values())) == len(number) and [w for _, w in sorted(places)] == words


def test_odd_input(spark, odd, nothing):
    assert found(odd) == brute([(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()])
    assert found(nothing) == []
