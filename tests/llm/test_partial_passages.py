"""Parts of benchmark items, at every offset, against brute force."""
import numpy as np

from clickforge.llm import decontam


def test_every_run_of_the_least_length_is_found_at_every_offset(spark, sf):
    items = [decontam.fold(r.text.strip())[0] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    items = sorted((x for x in items if len(x) > decontam.MIN_RUN), key=len)
    rnd = np.random.default_rng(1)
    host = ["".join(rnd.choice(list("qxzjkv "), 150)) for _ in range(2)]
    for code in (items[0], items[len(items) // 2], items[-1]):
        index = decontam.Index([(7, code)])
        whole = "".join(map(chr, code))
        for size in (decontam.MIN_RUN, 110):
            for start in range(max(0, len(whole) - size) + 1):
                text = host[0] + whole[start:start + size] + host[1]
                assert list(index.regions([text])), (len(whole), size, start)
        assert not list(index.regions([host[0] + whole[:40] + host[1]]))


def test_bands_against_counting_every_window(spark, sf):
    """Every window within its budget gets a band, as by comparing it with every place of the text."""
    items = [(r.item_id, decontam.fold(r.text.strip())[0]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").limit(12).collect()]
    index = decontam.Index(items)
    text = "".join(map(chr, np.concatenate([np.append(c[10:], 32) for _, c in items])))
    code, _ = decontam.fold(text)
    window, _ = index.bands(code)
    folded = "".join(map(chr, code))
    want = {w for w, p in enumerate(index.pattern) if "".join(map(chr, p)) in folded}
    assert want and want <= set(window.tolist())
