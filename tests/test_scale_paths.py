"""The ways taken by hot keys and large sides give the same rows as brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fernwick.operators import ordered as O
from fernwick.operators import relational as R
from fernwick.operators import vectors as V
from fernwick.operators.shift import mean_shift, shift
from fernwick.operators import windows as W


@pytest.fixture(scope="module")
def series(spark):
    """One key holds most rows; dates repeat, so ties are decided by the id."""
    rng = random.Random(7)
    rows = [(i, "hot" if rng.random() < 0.7 else f"k{rng.randrange(5)}", rng.randrange(60), rng.random() < 0.1,
             round(rng.random() * 10, 3)) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, key string, day int, flag boolean, value double")
    return rows, df.withColumn("date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("day"))).repartition(5)


def by_key(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        out.setdefault(r[1], []).append(r)
    return out


@pytest.mark.parametrize("limit", [25, 100, 10_000])
def test_days_since_and_until(series, limit):
    rows, df = series
    want_after, want_before = {}, {}
    for group in by_key(rows).values():
        for i, r in enumerate(group):
            past = [x[2] for x in group[: i + 1] if x[3]]
            ahead = [x[2] for x in group[i:] if x[3]]
            want_after[r[0]] = r[2] - max(past) if past else None
            want_before[r[0]] = r[2] - min(ahead) if ahead else None
    a = W.days_since_last(df, F.col("flag"), ["key"], "date", "id", limit=limit)
    b = W.days_until_next(df, F.col("flag"), ["key"], "date", "id", limit=limit)
    assert {r["id"]: r["after"] for r in a.collect()} == want_after
    got = {r["id"]: r["before"] for r in b.collect()}
    assert got == want_before
    assert all(v is None or v <= 0 for v in got.values())


@pytest.mark.parametrize("limit", [25, 100, 10_000])
def test_rolling_sums(series, limit):
    rows, df = series
    back, ahead = {}, {}
    for group in by_key(rows).values():
        for i, r in enumerate(group):
            back[r[0]] = sum(x[4] for x in group[max(0, i - 6): i + 1])
            ahead[r[0]] = sum(x[4] for x in group[i: i + 7])
    order = ["date", "id"]
    a = W.rolling_sum_trailing(df, ["value"], ["key"], order, limit=limit)
    b = W.rolling_sum_leading(df, ["value"], ["key"], order, limit=limit)
    got_a = {r["id"]: r["value_bw"] for r in a.collect()}
    got_b = {r["id"]: r["value_fw"] for r in b.collect()}
    assert got_a.keys() == back.keys() and got_b.keys() == ahead.keys()
    assert all(abs(got_a[k] - v) < 1e-9 for k, v in back.items())
    assert all(abs(got_b[k] - v) < 1e-9 for k, v in ahead.items())


@pytest.mark.parametrize("limit,beta", [(50, 0.5), (10_000, 0.5), (50, 0.98)])
def test_ewma(series, limit, beta):
    rows, df = series
    want = {}
    for group in by_key(rows).values():
        avg = 0.0
        for i, r in enumerate(group, 1):
            avg = avg * beta + r[4] * (1 - beta)
            want[r[0]] = avg / (1 - beta**i)
    got = {r["id"]: r["smoothed"] for r in W.ewma(df, "value", ["key"], ["date", "id"], beta, limit=limit).collect()}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], v, rel_tol=1e-9) for k, v in want.items())


@pytest.mark.parametrize("limit", [25, 10_000])
def test_keyed_position(series, limit):
    rows, df = series
    want = {r[0]: i for g in by_key(rows).values() for i, r in enumerate(g)}
    got = O.keyed_position(df, ["key"], ["date", "id"], limit=limit)
    assert {r["id"]: r["_pos"] for r in got.collect()} == want


def test_global_position_and_totals(series):
    rows, df = series
    order = sorted(rows, key=lambda r: (-r[2], r[0]))
    got = O.global_position(df, [F.desc("day"), F.asc("id")]).collect()
    assert {r["id"]: r["pos"] for r in got} == {r[0]: i for i, r in enumerate(order)}
    totals, run = {}, 0
    for r in order:
        run += r[2]
        totals[r[0]] = run
    got = O.running_totals(df, [F.desc("day"), F.asc("id")], {"t": "day"}).collect()
    assert {r["id"]: r["t"] for r in got} == totals


def test_hash_rank_is_a_permutation(series):
    _, df = series
    ranks = {r["id"]: r["rank"] for r in O.hash_rank(df, "id", 1).collect()}
    assert sorted(ranks.values()) == list(range(1, 901))
    few = {r["id"]: r["rank"] for r in O.hash_rank(df, "id", 1, below=37).collect()}
    assert few == {k: v for k, v in ranks.items() if v <= 37}


def test_percentiles(series):
    rows, df = series
    got = {r["key"]: (r["p50"], r["p90"]) for r in R.percentiles(df, "value", [0.5, 0.9], ["key"]).collect()}
    for key, group in by_key(rows).items():
        v = [r[4] for r in group]
        assert np.allclose(got[key], np.percentile(v, [50, 90]))


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(160, 6))
    m[100:110] = m[0]  # a group of copies: ties are decided by the id
    return m, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id long, vec array<double>").repartition(4)


@pytest.mark.parametrize("metric", ["cosine", "angular", "euclidean"])
@pytest.mark.parametrize("local,block", [(4096, 8192), (50, 8192), (10, 32)])
def test_knn_paths(points, metric, local, block):
    m, table = points
    queries = table.filter("id % 4 = 0").select(F.col("id").alias("query_id"), F.col("vec").alias("query_vec"))
    got = V.knn(table, queries, 7, metric=metric, local_rows=local, block_rows=block).collect()
    have = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["place"])):
        have.setdefault(r["query_id"], []).append(r["id"])
    assert len(have) == 40
    for q, ids in have.items():
        if metric == "euclidean":
            d = np.sqrt(((m - m[q]) ** 2).sum(1))
        else:
            cos = m @ m[q] / np.linalg.norm(m, axis=1) / np.linalg.norm(m[q])
            d = 1 - cos if metric == "cosine" else np.arccos(np.clip(cos, -1, 1))
        # Angles and distances of equal vectors are noisy near zero.
        d = np.round(d, 6)
        assert len(ids) == 7
        assert np.allclose(sorted(d[ids]), np.sort(d)[:7])
    if metric == "cosine":
        assert have[0][:2] == [0, 100]


@pytest.mark.parametrize("block", [32, 8192])
def test_mean_shift(points, block):
    m, table = points
    x = m.copy()
    for _ in range(2):
        w = np.exp(-0.5 * ((x[:, None] - x[None]) ** 2).sum(2) / 2.5**2)
        x = w @ x / w.sum(1, keepdims=True)
    got = mean_shift(table, "id", "vec", 2.5, 2, block_rows=block).collect()
    assert np.allclose(np.stack([r["vec"] for r in sorted(got)]), x)


def test_mean_shift_leaves_far_cells_out(spark):
    rng = np.random.default_rng(3)
    m = np.concatenate([c + rng.normal(size=(30, 2)) for c in rng.uniform(0, 400, size=(20, 2))] + [np.zeros((100, 2))])
    table = spark.createDataFrame([(f"p{k:04d}", v.tolist(), k) for k, v in enumerate(m)], "id string, vec array<double>, cell int")
    x = m.copy()
    for _ in range(5):
        w = np.exp(-0.5 * ((x[:, None] - x[None]) ** 2).sum(2) / 1.5**2)
        x = w @ x / w.sum(1, keepdims=True)
    moved = shift(table, "id", "vec", 1.5, 5, block_rows=64)
    assert np.allclose(np.stack([r["vec"] for r in sorted(moved.points.collect())]), x, rtol=0, atol=1e-9)
    assert moved.pairs == 5 * 700**2 and moved.weighed < 0.3 * moved.pairs


@pytest.mark.parametrize("dim", [1, 2])
def test_mean_shift_of_many_points_in_a_plane(spark, monkeypatch, dim):
    from fernwick.operators import shift as S

    rng = np.random.default_rng(4)
    m = np.concatenate([rng.uniform(0, 12, size=(300, dim)), np.full((150, dim), 3.25), rng.uniform(200, 203, size=(50, dim)), np.full((1, dim), -70.0)])
    x = m.copy()
    for _ in range(3):
        w = np.exp(-0.5 * ((x[:, None] - x[None]) ** 2).sum(2) / 1.5**2)
        x = w @ x / w.sum(1, keepdims=True)
    monkeypatch.setattr(S, "GRID_ROWS", 100)
    # No pair of points is weighed one by one.
    monkeypatch.setattr(S, "fit_centres", None)
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(m)], "id long, vec array<double>").repartition(3)
    moved = shift(table, "id", "vec", 1.5, 3)
    assert np.allclose(np.stack([r["vec"] for r in sorted(moved.points.collect())]), x, rtol=0, atol=1e-11)
    assert moved.pairs == 3 * len(m) ** 2 and 0.5 * moved.pairs < moved.weighed < 0.9 * moved.pairs


def test_mean_shift_in_a_plane_goes_by_cells_where_a_grid_cannot(spark, monkeypatch):
    from fernwick.operators import shift as S

    m = np.random.default_rng(6).uniform(0, 60, size=(300, 2))
    x = m.copy()
    w = np.exp(-0.5 * ((x[:, None] - x[None]) ** 2).sum(2) / 1.5**2)
    x = w @ x / w.sum(1, keepdims=True)
    monkeypatch.setattr(S, "GRID_ROWS", 100)
    monkeypatch.setattr(S, "GRID_NUMBERS", 1000)
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(m)], "id long, vec array<double>")
    assert np.allclose(np.stack([r["vec"] for r in sorted(mean_shift(table, "id", "vec", 1.5, 1).collect())]), x, rtol=0, atol=1e-9)


def test_mean_shift_of_points_that_lie_near_each_other(spark, monkeypatch):
    from fernwick.operators import shift as S

    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 12))
    x = m = x / np.sqrt((x * x).sum(1, keepdims=True)) + 3
    for _ in range(4):
        w = np.exp(-0.5 * ((x[:, None] - x[None]) ** 2).sum(2) / 6.0**2)
        x = w @ x / w.sum(1, keepdims=True)
    made, tiles = [], S._tiles
    monkeypatch.setattr(S, "_tiles", lambda *a: made.append(1) or tiles(*a))
    table = spark.createDataFrame([(f"p{k:03d}", v.tolist()) for k, v in enumerate(m)], "id string, vec array<double>").repartition(3)
    moved = shift(table, "id", "vec", 6.0, 4, block_rows=64)
    assert np.allclose(np.stack([r["vec"] for r in sorted(moved.points.collect())]), x, rtol=0, atol=1e-12)
    assert moved.weighed == moved.pairs == 4 * 400**2
    assert len(made) == 1  # later rounds need no pairs of points


def test_farthest_first_with_string_ids(spark):
    rows = [("b", [0.0]), ("z", [5.0]), ("a", [1.0]), ("y", [-3.0]), ("c", [5.0]), ("d", [2.0])]
    df = spark.createDataFrame(rows, "name string, vec array<double>")
    # From 1: 5 and -3 are equally far, "c" stands before "y" and "z"; then -3, then 2 (3 away, like nothing else).
    assert V.farthest_first(df, "name", "vec", 3).ravel().tolist() == [5.0, -3.0, 1.0]
    assert V.kmeans(df, "name", "vec", 2)[1].count() == 6


def test_kmeans(points):
    m, table = points
    centres, rows = V.kmeans(table, "id", "vec", 4)
    chosen = []
    known = m[:1]
    for _ in range(4):
        far = ((m[:, None] - known[None]) ** 2).sum(2).min(1).round(9).argmax()
        chosen.append(m[far])
        known = np.stack(chosen)
    c = np.stack(chosen)
    for _ in range(10):
        near = ((m[:, None] - c[None]) ** 2).sum(2).round(9).argmin(1)
        moved = np.stack([m[near == k].mean(0) for k in range(4)])
        if np.allclose(moved, c, rtol=0, atol=1e-12):
            break
        c = moved
    assert np.allclose(centres, c)
    near = ((m[:, None] - c[None]) ** 2).sum(2).argmin(1)
    assert {r["id"]: r["cluster"] for r in rows.collect()} == dict(enumerate(near))


def test_space_map(points):
    m, table = points
    df = table.select("id", F.slice("vec", 1, 3).alias("x"), F.slice("vec", 4, 3).alias("y"))
    w = V.fit_space_map(df, "x", "y", 0.5)
    a = np.hstack([m[:, :3], np.ones((160, 1))])
    ridge = np.diag([0.5, 0.5, 0.5, 0])
    want = np.linalg.solve(a.T @ a + ridge, a.T @ m[:, 3:])
    assert np.allclose(w, want)
    got = V.apply_space_map(df, "x", w, "z").collect()
    assert np.allclose(np.stack([r["z"] for r in sorted(got)]), a @ want)


def test_knn_approx_recall(points):
    _, table = points
    queries = table.filter("id % 10 = 0").select(F.col("id").alias("query_id"), F.col("vec").alias("query_vec"))
    exact = {(r["query_id"], r["id"]) for r in V.knn(table, queries, 5).collect()}
    near = {(r["query_id"], r["id"]) for r in V.knn_approx(table, queries, 5).collect()}
    assert len(exact & near) / len(exact) > 0.9


def test_spearman_and_best_split(spark):
    from fernwick.operators import models as M

    rng = random.Random(1)
    rows = [(rng.randrange(9), rng.randrange(30), rng.random() * 5) for _ in range(300)]
    df = spark.createDataFrame(rows, "a int, b int, y double")
    got = {r["feature"]: (r["threshold"], r["score"]) for r in M.best_split(df, ["b", "a"], "y", 5).collect()}
    y = np.array([r[2] for r in rows])
    for i, f in enumerate("ab"):
        x = np.array([r[i] for r in rows])
        best = min((x <= v).sum() * y[x <= v].std() + (x > v).sum() * y[x > v].std()
                   for v in sorted(set(x)) if (x <= v).sum() > 5 and (x > v).sum() > 5)
        assert math.isclose(got[f][1], best, rel_tol=1e-9)
    import pandas as pd

    pdf = pd.DataFrame(rows, columns=["a", "b", "y"])
    want = pdf.rank().corr().round(4)
    for r in M.spearman_matrix(df, ["a", "b", "y"]).collect():
        assert abs(r["rho"] - want.loc[r["a"], r["b"]]) < 2e-4


@pytest.mark.parametrize("cells", [8_000_000, 1])
def test_pool(spark, cells):
    docs = spark.createDataFrame([(1, ["a", "b", "x", "a"]), (2, ["x"]), (3, []), (4, ["b"])], "doc_id int, w array<string>")
    vectors = spark.createDataFrame([("a", [1.0, -2.0]), ("b", [4.0, -5.0])], "token string, vec array<double>")
    got = {r["doc_id"]: (r["mean"], r["max"], r["last"]) for r in V.pool(docs, "w", vectors, "doc_id", local_cells=cells).collect()}
    assert set(got) == {1, 4}
    assert got[1] == ([2.0, -3.0], [4.0, -2.0], [1.0, -2.0]) and got[4] == ([4.0, -5.0],) * 3


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("bound,limit", [(1000, 10), (0, 10), (0, 10_000)])
def test_dictionary_join_of_frequent_keys(spark, monkeypatch, how, bound, limit):
    from fernwick import session

    monkeypatch.setattr(session, "BROADCAST_ROWS", bound)
    r = random.Random(2)
    rows = [(k, r.choice(["the", "the", "the", "of", "x", "y", "missed", None])) for k in range(400)]
    table = {"the": 1, "of": 2, "x": 3, "y": 4, "unused": 5}
    got = O.dictionary_join(spark.createDataFrame(rows, "id long, key string").repartition(4), spark.createDataFrame(list(table.items()), "key string, v int"), "key", how, limit)
    want = [(i, k, table.get(k)) for i, k in rows if how == "left" or k in table]
    assert sorted(map(repr, ((x.id, x.key, x.v) for x in got.collect()))) == sorted(map(repr, want))


@pytest.mark.parametrize("dim,wide", [(2, 60.0), (4, 1.0)])
def test_points_of_a_mean_shift_travel_once_per_tile(spark, monkeypatch, dim, wide):
    from fernwick.operators import shift as S

    rng = np.random.default_rng(5)
    m = rng.uniform(0, wide, size=(600, dim))
    m[:200] = m[0]  # a cell larger than a tile
    sent = []
    tiles = S._tiles
    monkeypatch.setattr(S, "_tiles", lambda met, line, count, rows: sent.append((tiles(met, line, count, rows), met, count)) or sent[-1][0])
    x = m.copy()
    for _ in range(2):
        w = np.exp(-0.5 * ((x[:, None] - x[None]) ** 2).sum(2) / 1.5**2)
        x = w @ x / w.sum(1, keepdims=True)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(m)], "id long, vec array<double>").repartition(4)
    out = shift(df, "id", "vec", 1.5, 2, block_rows=32)
    assert np.allclose(np.stack([r["vec"] for r in sorted(out.points.collect())]), x, rtol=0, atol=1e-9)
    for pieces, met, count in sent:
        cells = int((met.sum(1) * count).sum())  # what a shuffle by cell would send
        assert sum(count[c] / n * len(lefts) for c, n, _, _, lefts, _ in pieces) < 0.5 * cells


def test_ratings_of_a_fit_are_dealt_to_more_blocks_when_there_are_many(spark, monkeypatch):
    from fernwick.operators import models as M

    r = random.Random(5)
    rows = [(u, i, float((u * 3 + i * 5) % 7 + r.random()), u * 40 + i) for u in range(30) for i in range(40) if r.random() < 0.5]
    df = spark.createDataFrame(rows, "u long, i long, rating double, row long").repartition(3)
    seen, real = [], M.ALS
    monkeypatch.setattr(M, "ALS", lambda **k: seen.append(k) or real(**k))
    few = M.CollabModel(df, "u", "i", "rating", "row", factors=8, rounds=6, reg=0.01).predict(df).collect()
    monkeypatch.setattr(M, "BLOCK_RATINGS", 25)
    many = M.CollabModel(df, "u", "i", "rating", "row", factors=8, rounds=6, reg=0.01).predict(df).collect()
    blocks = -(-len(rows) // 25)
    assert [k["numUserBlocks"] for k in seen] == [k["numItemBlocks"] for k in seen] == [10, blocks]
    assert "finalStorageLevel" not in seen[0] and seen[1]["finalStorageLevel"] == "DISK_ONLY"
    for out in (few, many):
        assert len(out) == len(rows)
        assert np.sqrt(np.mean([(x.prediction - x.rating) ** 2 for x in out])) < 0.5 * np.std([x[2] for x in rows])
