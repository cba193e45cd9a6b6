"""The cell index finds what brute force finds, and leaves out cells that cannot matter."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fernwick.operators import cells as C
from fernwick.operators import vectors as V


def points(seed, groups=12, each=40, dim=5, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    m = np.concatenate([c + spread * rng.normal(size=(each, dim)) for c in centres])
    return [(f"v{k:04d}", v.tolist()) for k, v in enumerate(m)]


def plain(table, queries, k, metric):
    out = []
    ids = np.array([i for i, _ in table])
    d = V._distances(np.array([v for _, v in queries]), np.array([v for _, v in table]), metric)
    for (q, _), row in zip(queries, d):
        order = np.lexsort((ids, row))[:k]
        out += [(q, ids[o], row[o], p + 1) for p, o in enumerate(order)]
    return sorted(out)


def rows(hits):
    return sorted((r.query_id, r.id, r.distance, r.place) for r in hits.collect())


@pytest.mark.parametrize("metric", ["cosine", "angular", "euclidean"])
def test_exact_search_equals_brute_force(spark, metric):
    # Copies tie by id; one cell holds a third of all rows; vectors of length zero have no direction.
    table = points(1) + [(f"copy{k:03d}", points(1)[0][1]) for k in range(250)] + [("zero1", [0.0] * 5), ("zero2", [0.0] * 5)]
    queries = [(k, v) for k, (_, v) in enumerate(points(2, each=4) + table[::25])] + [(1000, [0.0] * 5)]
    df = spark.createDataFrame(table, "id string, vec array<double>").withColumns({"cell": F.lit(1), "n": F.lit(1)})
    ask = spark.createDataFrame(queries, "query_id int, query_vec array<double>")
    index = C.build_index(df, "id", "vec", metric=metric, cells=20, block_rows=64)
    again = C.open_index(spark, index.path)
    for k, block_rows in ((7, 16), (300, 8192)):
        found = C.search(again, ask, k, block_rows=block_rows)
        assert rows(found.hits) == plain(table, queries, k, metric)
        assert found.pairs == len(table) * len(queries)
    assert C.search(index, ask, 3).compared < 0.7 * found.pairs


def test_pairs_are_skipped(spark):
    table, queries = points(3, groups=30, each=60, dim=3, spread=0.01), points(3, groups=30, each=4, dim=3, spread=0.01)
    df = spark.createDataFrame(table, "id string, vec array<double>")
    ask = spark.createDataFrame(queries, "query_id string, query_vec array<double>")
    found = C.search(C.build_index(df, "id", "vec", metric="euclidean"), ask, 5)
    assert rows(found.hits) == plain(table, queries, 5, "euclidean")
    assert found.compared < 0.1 * found.pairs
    big = V.knn(df, ask, 5, "id", "vec", metric="euclidean", local_rows=50, block_rows=100)
    assert rows(big) == plain(table, queries, 5, "euclidean")


def test_probes_give_most_neighbours(spark):
    table, queries = points(4, groups=20, each=100, spread=0.3), points(5, groups=20, each=5, spread=0.3)
    df = spark.createDataFrame(table, "id string, vec array<double>")
    ask = spark.createDataFrame(queries, "query_id string, query_vec array<double>")
    index = C.build_index(df, "id", "vec")
    want = {r[:2] for r in plain(table, queries, 10, "cosine")}
    found = C.search(index, ask, 10, probes=6)
    got = {r[:2] for r in rows(found.hits)}
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)
    assert found.compared < 0.35 * found.pairs


def test_probes_leave_out_cells_that_hold_nothing_nearer(spark):
    table, queries = points(10, groups=30, each=60, dim=3, spread=0.01), points(10, groups=30, each=4, dim=3, spread=0.01)
    df = spark.createDataFrame(table, "id string, vec array<double>")
    ask = spark.createDataFrame(queries, "query_id string, query_vec array<double>")
    found = C.search(C.build_index(df, "id", "vec", metric="euclidean", cells=30), ask, 5, probes=6)
    assert rows(found.hits) == plain(table, queries, 5, "euclidean")
    assert found.compared < 0.12 * found.pairs  # 6 of 30 cells are 0.2


def test_blocks_are_left_out_by_single_queries(monkeypatch):
    # Few queries, far from each other, in a cell of many rows.
    rng = np.random.default_rng(11)
    v, q = rng.random(size=(8000, 3)), rng.random(size=(64, 3))
    made, whole = [], C._lengths
    monkeypatch.setattr(C, "_lengths", lambda a, b: made.append(whole(a, b).size) or whole(a, b))
    a, b, d = (np.concatenate(x) for x in zip(*C._near_blocks(q, np.full(64, np.inf), v, 5, "euclidean")))
    assert sum(made) < 0.25 * len(q) * len(v)
    want = V._distances(q, v, "euclidean")
    for i in range(64):
        mine = np.lexsort((b[a == i], d[a == i]))[:5]
        assert b[a == i][mine].tolist() == np.lexsort((np.arange(8000), want[i]))[:5].tolist()


def test_small_tables(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 2.0])], "id long, vec array<double>")
    ask = spark.createDataFrame([(9, [1.0, 1.0]), (8, None)], "query_id long, query_vec array<double>")
    assert [r[:2] for r in rows(C.search(C.build_index(df, "id", "vec"), ask, 5).hits)] == [(9, 1), (9, 3)]
    assert C.search(C.build_index(df, "id", "vec"), ask.filter("false"), 5).hits.count() == 0
    assert C.search(C.build_index(df.filter("false"), "id", "vec"), ask, 5).hits.count() == 0


def test_search_from_another_space(spark):
    rng = np.random.default_rng(6)
    turn = rng.normal(size=(4, 3))
    x = rng.normal(size=(300, 4))
    y = x @ turn + 0.5
    df = spark.createDataFrame([(k, a.tolist(), b.tolist() if k % 3 else None) for k, (a, b) in enumerate(zip(x, y))], "id long, x array<double>, y array<double>")
    ask = spark.createDataFrame([(k, y[k].tolist()) for k in range(0, 300, 10)], "query_id long, query_vec array<double>")
    space = C.build_space_index(df, "id", "x", "y", metric="euclidean", penalty=1e-9)
    stored = C.open_space_index(spark, space.index.path)
    np.testing.assert_array_equal(stored.weights, space.weights)
    # A row without y is found by what its x maps to.
    assert [r[:2] for r in rows(C.search(stored.index, ask, 1).hits)] == [(k, k) for k in range(0, 300, 10)]


def test_queries_travel_once_per_tile(spark):
    # Uniform directions: each query needs almost every cell, but cells that lie together take it as one row.
    from fernwick.session import scratch

    rng = np.random.default_rng(7)
    table = [(k, v.tolist()) for k, v in enumerate(rng.normal(size=(400, 24)))]
    df = spark.createDataFrame(table, "id long, vec array<double>")
    ask = df.selectExpr("id AS query_id", "vec AS query_vec")
    with scratch(spark) as folder:
        found = C.search(C.build_index(df, "id", "vec", cells=40), ask, 5)
        assert rows(found.hits) == plain(table, table, 5, "cosine")
        assert spark.read.parquet(f"{folder}/cell-pairs-*").count() <= 3 * len(table)


def test_blocks_leave_out_most_pairs(monkeypatch):
    rng = np.random.default_rng(8)
    v = rng.random(size=(4000, 3))
    made, whole = [], V._distances
    monkeypatch.setattr(V, "_distances", lambda q, r, m: made.append(len(q) * len(r)) or whole(q, r, m))
    found = list(C._near_blocks(v, np.full(len(v), np.inf), v, 5, "euclidean"))
    assert sum(made) < 0.25 * len(v) ** 2
    a, b, d = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((b, d, a))
    a, b = a[order], b[order]
    d = whole(v, v, "euclidean")
    for i in range(0, len(v), 97):
        assert b[a == i][:5].tolist() == np.lexsort((np.arange(len(v)), d[i]))[:5].tolist()


def test_vectors_with_a_null_do_not_spoil_the_cells(spark):
    table = points(9, groups=20, each=20, dim=3, spread=0.01)
    df = spark.createDataFrame([*table, ("null", [1.0, None, 1.0])], "id string, vec array<double>")
    ask = spark.createDataFrame(table[::10], "query_id string, query_vec array<double>")
    found = C.search(C.build_index(df, "id", "vec", metric="euclidean", cells=20), ask, 5)
    assert rows(found.hits) == plain(table, table[::10], 5, "euclidean")
    assert found.compared < 0.5 * found.pairs


def test_vectors_of_different_lengths_are_an_error():
    import pyarrow as pa

    # Three numbers a row on the average.
    with pytest.raises(ValueError):
        C._column(pa.array([[1.0, 2.0], [1.0, 2.0, 3.0, 4.0]]))
    assert C._column(pa.array([[1.0, 2.0], [3.0, None]])).shape == (2, 2)
