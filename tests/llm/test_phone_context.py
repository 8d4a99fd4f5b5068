"""Context decides national phone numbers; added spans never touch base spans, at any number of them."""
import random
import time

from clickforge.llm import pii


def found(text):
    return [(s["kind"], text[s["start"]:s["end"]]) for s in pii.find_personal_data(text)]


def test_context_decides():
    for number in ("123 456 7890", "123-456-7890", "123.456.7890"):
        assert found(f"part no {number}") == []
        assert found(f"phone {number}") == [("local_phone", number)] == found(f"{number} (mobile)")
        assert found(f"phone {'x ' * 30} {number}") == []  # too far away
    assert found("part no (123) 456-7890") == [("local_phone", "(123) 456-7890")]  # an area code in brackets
    score = {s["score"] for t in ("tel (123) 456-7890", "x (123) 456-7890", "tel 123 456 7890") for s in pii.find_personal_data(t)}
    assert score == {0.55, 0.4, 0.45}


def test_added_spans_against_all_pairs():
    rnd = random.Random(4)
    for _ in range(300):
        taken = [("x", a, a + rnd.randrange(1, 9)) for a in (rnd.randrange(60) for _ in range(rnd.randrange(8)))]
        free = pii.free_of(taken)
        for _ in range(20):
            start = rnd.randrange(60)
            end = start + rnd.randrange(1, 9)
            assert free(start, end) == all(end <= a or b <= start for _, a, b in taken)


def test_many_spans_take_no_square():
    text = " ".join(f"a{k}@b.co call (629) 555-{k % 10000:04d}" for k in range(8000))
    start = time.time()
    assert len(pii.find_personal_data(text)) == 16000
    assert time.time() - start < 3
