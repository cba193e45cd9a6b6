"""Inputs on which the operators of the llm folder once did less than the whole job."""

import numpy as np
import pytest

from fernwick.llm import collision_ann, common


@pytest.mark.parametrize("norms", ["one long", "lognormal"])
def test_neighbours_of_vectors_of_uneven_norms(spark, norms):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((20, 64))
    x = centres[rng.integers(20, size=4000)] + 0.7 * rng.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if norms == "one long":
        x[7] *= 10
    else:
        x *= np.exp(0.5 * rng.standard_normal((4000, 1)))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = common.store(collision_ann.usable_rows(df, "vec_id", "embedding"), "vectors")
    found = {}
    for r in collision_ann.nearest(rows, rows.filter("_id % 100 = 0"), k=20).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    recall = []
    for i in range(0, 4000, 100):
        score = x @ x[i]
        score[i] = -np.inf
        recall.append(len(set(np.argsort(-score)[:20].tolist()) & found[i]) / 20)
    assert np.mean(recall) >= 0.9 and min(recall) >= 0.75
