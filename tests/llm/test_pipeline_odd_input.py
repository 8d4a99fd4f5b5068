"""Every stage of the pipeline on nulls, empty and long texts, repeated rows, empty tables and clashing column names."""
import corpus_pipeline
import pytest

STAGES = dict(corpus_pipeline.STAGES)


@pytest.mark.parametrize("name", ["quality", "line_dedup", "near_dedup", "decontamination"])
def test_stage_on_odd_rows(spark, sf, odd, nothing, name):
    out = STAGES[name](spark, odd, sf)
    assert out.columns == odd.columns and [f.dataType for f in out.schema] == [f.dataType for f in odd.schema]
    rows = out.collect()
    given = sorted((r.doc_id or 0, r.text or "", r.lang or "") for r in odd.collect())
    got = sorted((r.doc_id or 0, r.text or "", r.lang or "") for r in rows)
    if name == "line_dedup":
        assert len(got) == 12 and {i for i, _, _ in got} == {i for i, _, _ in given}
    else:
        assert set(got) <= set(given)
    if name == "quality":
        assert got and all(len(t.split()) >= 10 for _, t, _ in got)
    if name == "near_dedup":  # ids 5, 6 and 6 share a text; null and empty texts and the row without an id stay
        assert len(got) == 10 and sorted(i for i, _, _ in got) == [0, 1, 2, 3, 4, 5, 7, 8, 9, 10]
    if name == "decontamination":
        assert got == given
    assert all((r.leaks, r.quality, r.node) == (given.leaks, given.quality, given.node) for r in rows for given in [odd.first()])
    assert STAGES[name](spark, nothing, sf).count() == 0


def test_packing_on_odd_rows(spark, sf, odd, nothing):
    rows = corpus_pipeline.packing(spark, odd, sf).collect()
    assert sum(r.start == 0 for r in rows) == 12 and sum(r.doc_tokens == 1 for r in rows) >= 3
    assert corpus_pipeline.packing(spark, nothing, sf).count() == 0
