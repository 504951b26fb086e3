"""Every stage on real, odd and empty documents."""

import pytest

import corpus_pipeline
from tidewatch.session import stored

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("table", ["documents", "odd", "none"])
def test_stages(request, prepared, table):
    docs = request.getfixturevalue("documents" if table == "none" else table)
    docs = docs.limit(0) if table == "none" else docs
    names = docs.columns
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        result = stored(stage(prepared, docs, FOLDER), "stage")
        if number < len(corpus_pipeline.STAGES) - 1:
            assert result.columns == names
            if number < 3:
                assert result.count() <= docs.count()
            docs = result
    assert {"doc_id", "sequence_id", "offset"} <= set(result.columns)
    if table == "documents":
        assert result.count() > 0
