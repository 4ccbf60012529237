"""Packing (7): groups of rows whose ids repeat or are null."""

from __future__ import annotations

import public_tokenizers
import pytest

from credlake.llm import packing


@pytest.mark.parametrize("one", [None, 7])
def test_rows_of_one_id_are_spread_over_groups(make_docs, one):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = make_docs(["the same few words"] * 400, [one] * 400)
    sizes = [r["count"] for r in packing.grouped(docs, path, group=50).groupBy("grp").count().collect()]
    assert sum(sizes) == 400 and len(sizes) == 8 and max(sizes) <= 100
    rows = packing.pack(docs, path, group=50).collect()
    assert len(rows) == 400 and {(r.doc_id, r.start) for r in rows} == {(one, 0)}
    places = {(r.sequence_id, r.offset) for r in rows}
    assert len(places) == 400  # no two pieces share a place
