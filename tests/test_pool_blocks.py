"""Pooling with a vector table that is too large for the tasks."""

import numpy as np
import pytest

from fernwick.operators import vectors as V


@pytest.mark.parametrize("local", [0, 5, 40])
def test_pool_by_blocks_equals_plain_pooling(spark, monkeypatch, local):
    monkeypatch.setattr(V, "POOL_DOCS", 16)
    rng = np.random.default_rng(4)
    table = {f"t{k}": rng.normal(size=3).tolist() for k in range(50)}
    # Ids repeat and are null; lists are null, empty, without a known token, and hold null tokens.
    docs = [(None if k == 3 else k // 2, [None if z == 59 else f"t{z}" for z in (60 * rng.random(rng.integers(1, 90)) ** 2).astype(int)]) for k in range(100)]
    docs += [(200, None), (201, []), (202, ["other"]), (203, [None])]
    want = []
    for i, w in docs:
        v = np.array([table[x] for x in w or [] if x in table])
        if len(v):
            want.append((str(i), *np.round(np.concatenate([v.mean(0), v.max(0), v[-1]]), 9)))
    df = spark.createDataFrame(docs, "doc_id int, w array<string>").repartition(5)
    vectors = spark.createDataFrame(list(table.items()), "token string, vec array<double>")
    out = V.pool(df, "w", vectors, "doc_id", local_cells=3 * local)
    # Vectors of tokens that are not at hand are joined once a block, not once a token of a document.
    assert "Summarizer" not in out._jdf.queryExecution().toString()
    assert sorted((str(r.doc_id), *np.round(r.mean + r.max + r.last, 9)) for r in out.collect()) == sorted(want)
