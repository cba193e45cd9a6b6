"""Streams, vocabularies and ranks against plain versions."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fernwick.operators import models as M
from fernwick.operators import ordered as O
from fernwick.operators import vocab as V


def documents(seed, n=60):
    r = random.Random(seed)
    return [(k, [r.choice("abcdefgh") * r.randint(1, 3) for _ in range(r.choice([0, 0, 1, 1, 2, 3, 9, 40]))]) for k in range(n)]


@pytest.mark.parametrize("width,step", [(1, 1), (8, 8), (5, 3), (30, 7), (500, 2)])
def test_windows_go_on_through_documents(spark, width, step):
    rows = documents(1) + [(1000, None)]
    stream = [t for _, w in rows for t in (w or [])]
    want = [(j, stream[j:j + width], stream[j + width]) for j in range(0, len(stream) - width, step)]
    df = spark.createDataFrame(rows, "id long, w array<string>").repartition(3)
    got = sorted((r.pos, r["items"], r.next) for r in V.stream_windows(df, "w", "id", width, step).collect())
    assert got == want


@pytest.mark.parametrize("backwards", [False, True])
def test_drawn_lengths(spark, backwards):
    rows = [(k, [100 * k + i for i in range(n)]) for k, n in enumerate([700, 0, 3, 950, 411])]
    df = spark.createDataFrame(rows, "id long, ids array<int>")
    windows = sorted(map(tuple, V.drawn_windows(spark, 2064 // 4, 10).collect()))
    lengths = [n for _, _, n in windows]
    assert windows[0][1:] == (0, 35) and all(n >= 5 for n in lengths[:-1])
    assert all(a[1] + a[2] == b[1] for a, b in zip(windows, windows[1:])) and len(windows) <= 516 // 10 - 1
    assert windows[-1][1] + windows[-1][2] <= 515
    stream = [x for _, ids in rows for x in ids]
    data = np.array(stream[:2064]).reshape(4, -1).T
    data = data[::-1] if backwards else data
    want = sorted((c, s + p, w, p, int(data[s + p, c]), int(data[s + p + 1, c])) for w, s, n in windows for p in range(n) for c in range(4))
    got = sorted(map(tuple, V.lm_stream_drawn(df, "ids", "id", 4, 10, backwards=backwards).collect()))
    assert got == want


def test_drawn_lengths_vary(spark):
    lengths = [r.length for r in V.drawn_windows(spark, 100_000, 40).orderBy("window").collect()][1:-1]
    assert 36 < np.mean(lengths) < 41 and 0.02 < np.mean(np.array(lengths) < 28) < 0.09
    assert V.drawn_windows(spark, 0, 40).count() == 0


@pytest.mark.parametrize("size", [0, 1, 7, 60, 300, 5000])
def test_most_frequent(spark, size):
    r = random.Random(size)
    counts = [(f"t{k:03d}", r.choice([1, 1, 1, 2, 3, 50, 5000, 5010, 9000, 10**7])) for k in range(400)]
    got = {tuple(x) for x in V.most_frequent(spark.createDataFrame(counts, "token string, n long"), size, "token").collect()}
    assert got == set(sorted(counts, key=lambda x: (-x[1], x[0]))[:size])


@pytest.mark.parametrize("size", [1, 5, 40, 400, 10_000])
def test_doc_term_of_the_most_frequent(spark, size):
    r = random.Random(5)
    rows = [(r.choice([k, k, k // 7]), [r.choice(["A", "b", "c", "d", "é", "ee", "f", "gg"]) for _ in range(r.choice([0, 1, 2, 30]))]) for k in range(160)]
    counts = Counter((i, " ".join(w[k:k + n]).lower()) for i, w in rows for n in (1, 2, 3) for k in range(len(w) - n + 1))
    totals = Counter()
    for (_, term), n in counts.items():
        totals[term] += n
    kept = set(sorted(totals, key=lambda t: (-totals[t], t))[:size])
    df = spark.createDataFrame(rows, "id long, w array<string>")
    got = {(x.id, x.term): x.n for x in V.doc_term(df, "w", "id", (1, 3), size).collect()}
    assert got == {k: n for k, n in counts.items() if k[1] in kept}


def test_rare_terms_go_before_the_shuffle(spark):
    rows = [(k, f"common{k % 3}", 5) for k in range(900)] + [(k, f"rare{k}", 1) for k in range(900)]
    df = spark.createDataFrame(rows, "id long, term string, n long")
    left = V._without_rare(df, "id", 3)
    assert left.filter("term like 'common%'").count() == 900 and left.filter("term like 'rare%'").count() < 50


def test_sparse_rows(spark):
    counts = [(1, "b", 2), (1, "a", 1), (1, "d", 5), (2, "c", 7)]
    df = spark.createDataFrame(counts, "id long, term string, n long")
    docs = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    got = {r.id: (r.terms, r.counts, r.length) for r in V.bow_rows(df, "id", 2, docs).collect()}
    assert got == {1: ([2, 4], [2, 5], 2), 2: ([0, 3], [0, 7], 1), 3: ([0, 0], [0, 0], 0)}


def test_average_ranks_of_heavy_values(spark):
    r = random.Random(9)
    rows = [(c, r.choice([0.0, 0.0, 0.0, 1.0, 2.5, float(k)]), k) for c in range(3) for k in range(400)]
    df = spark.createDataFrame(rows, "c int, v double, row long").repartition(7)
    got = {(x.c, x.row): x["rank"] for x in O.average_ranks(df, ["c"], "v", "row").collect()}
    for c in range(3):
        values = [v for k, v, _ in rows if k == c]
        for k, v, row in rows:
            if k == c:
                below = sum(x < v for x in values)
                assert got[c, row] == below + (values.count(v) + 1) / 2


def test_running_totals_begin_anew(spark):
    rows = [(k % 3, k, 0.1 * 10 ** (6 * (k % 3))) for k in range(200)]
    df = spark.createDataFrame(rows, "key int, x int, y double").repartition(5)
    got = {(r.key, r.x): r.s for r in O.running_totals(df, ["x"], {"s": "y"}, ["key"]).collect()}
    for key in range(3):
        total = 0.0
        for k, x, y in rows:
            if k == key:
                total += y
                assert got[k, x] == pytest.approx(total, rel=1e-13)


def test_best_split_keeps_digits(spark):
    """A feature with many rows does not take digits from the next one."""
    rows = [(float(k % 50), float(k % 7), 1e6 + (k % 7 > 3)) for k in range(700)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    got = {r.feature: r.threshold for r in M.best_split(df, ["a", "b"], "y").collect()}
    assert got["b"] == 3.0
