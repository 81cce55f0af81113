"""Rows that a search sends on follow queries and parts, not blocks."""

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import neighbours


@pytest.mark.parametrize("held", [1 << 19, 10])
def test_blocks_of_a_part_are_brought_down_to_the_nearest(monkeypatch, held):
    if hasattr(neighbours, "HELD"):
        monkeypatch.setattr(neighbours, "HELD", held)
    rng = np.random.default_rng(5)
    x, queries = rng.standard_normal((120, 4)), np.arange(0, 120, 30, dtype="<i8")
    x[7] = x[100]  # equal scores in two blocks
    blocks = [(part, np.arange(a, a + 20, dtype="<i8")) for part, a in ((0, 0), (0, 20), (0, 40), (0, 60), (1, 80), (1, 100))]
    rows = [{"part": part, "ids": ids.tobytes(), "vectors": x[ids].tobytes(), "query_ids": queries.tobytes(), "query_vectors": x[queries].tobytes()} for part, ids in blocks]
    found = [r for b in neighbours._search(3)([pa.RecordBatch.from_pylist(rows[:3]), pa.RecordBatch.from_pylist(rows[3:])]) for r in b.to_pylist()]
    if held > 10:
        assert len(found) == len(queries) * 2 * 3
    for q in queries.tolist():
        cosine = neighbours.cosines(np.repeat(x[q:q + 1], 120, 0), x)
        want = sorted((-cosine[d], d) for d in range(120) if d != q)[:3]
        assert sorted((-r["score"], r["vec_id"]) for r in found if r["query_id"] == q)[:3] == want
