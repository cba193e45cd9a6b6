"""Counts of runs of tokens and the perplexity that they give, on rows of their own."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fernwick.operators import classify as C


def _rows(seed, size=120):
    r = random.Random(seed)
    words = ["a", "b", "ab", "é", "", None, "a b"]
    return [(k, None if k % 11 == 0 else [r.choice(words) for _ in range(r.choice([0, 1, 2, 3, 4, 30]))]) for k in range(size)]


def _plain(rows, width):
    found = Counter()
    for _, w in rows:
        for k in range(len(w or []) - width):
            found[" ".join(x for x in w[k:k + width] if x is not None), w[k + width]] += 1
    return dict(found)


@pytest.mark.parametrize("tokens", [1, 50, 1 << 18])
@pytest.mark.parametrize("width", [1, 2, 3])
def test_context_counts_of_chunks(spark, monkeypatch, width, tokens):
    monkeypatch.setattr(C, "COUNTED_TOKENS", tokens)
    rows = _rows(width)
    df = spark.createDataFrame(rows, "id int, w array<string>").coalesce(2)
    got = [tuple(r) for r in C.context_counts(df, "w", width).collect()]
    assert len(got) == len({r[:2] for r in got}) and {r[:2]: r[2] for r in got} == _plain(rows, width)


def test_context_counts_of_long_contexts(spark):
    # 5,000 words to the seventh power are no 64-bit number.
    r = random.Random(9)
    rows = [(k, [f"w{r.randrange(5000)}" if k % 2 else f"v{i % 40}" for i in range(400)]) for k in range(40)]
    df = spark.createDataFrame(rows, "id int, w array<string>").coalesce(1)
    assert {tuple(x)[:2]: x.n for x in C.context_counts(df, "w", 6).collect()} == _plain(rows, 6)


def test_context_counts_keeps_the_type_of_tokens(spark):
    df = spark.createDataFrame([([1, 2, 3, 1, 2, 3],)], "w array<int>")
    out = C.context_counts(df, "w", 2)
    assert out.schema["next"].dataType.simpleString() == "int"
    assert {tuple(r) for r in out.collect()} == {("1 2", 3, 2), ("2 3", 1, 1), ("3 1", 2, 1)}


def test_runs_are_counted_on_batches(spark):
    df = spark.createDataFrame([(k, ["a", "b", "c"] * 100) for k in range(50)], "id int, w array<string>").coalesce(1)
    plan = C.context_counts(df, "w", 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan


def test_perplexity_stores_sizes_not_pairs(spark, monkeypatch):
    r = random.Random(2)
    pairs = [(f"c{k}", f"n{j}", r.randrange(1, 4)) for k in range(300) for j in range(k % 5 + 1)] + [(None, "n0", 2), ("c0", None, 1)]
    stored = []
    monkeypatch.setattr(C, "cut_lineage", lambda df: stored.append(df.checkpoint()) or stored[-1])
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    got = C.perplexity(spark.createDataFrame(pairs, "context string, next string, n long")).first()[0]
    sizes, kinds = Counter(), len({p[1] for p in pairs})
    for c, _, n in pairs:
        sizes[c] += n
    want = math.exp(sum(-math.log((n + 1) / (sizes[c] + kinds)) * n for c, _, n in pairs) / sum(sizes.values()))
    assert abs(got - want) < 1e-9 * want
    assert sum(df.count() for df in stored) <= len(set(sizes.values())) + 1


def test_perplexity_of_nothing(spark):
    assert C.perplexity(spark.createDataFrame([], "context string, next string, n long")).collect()[0][0] is None
    assert C.context_counts(spark.createDataFrame([(None,), ([],)], "w array<string>"), "w").select(F.sum("n")).first()[0] is None
