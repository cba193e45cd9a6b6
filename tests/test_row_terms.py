"""N-grams counted by the numbers of their tokens, on rows of their own."""

import random
from collections import Counter

import pytest
import pyarrow as pa
import numpy as np

from fernwick.operators import vocab as V


def _plain(rows, lo, hi):
    return {(i, t): n for i, w in rows for t, n in Counter(
        " ".join(w[k:k + size]) for size in range(lo, hi + 1) for k in range(len(w or []) - size + 1)).items()}


@pytest.mark.parametrize("tokens", [1, 40, 1 << 18])
@pytest.mark.parametrize("span", [(1, 1), (1, 3), (2, 3)])
@pytest.mark.parametrize("words", [["a", "b", "é", "cc"], ["a", "a b", "b", "", " "]])
def test_row_terms_of_chunks(spark, monkeypatch, tokens, span, words):
    monkeypatch.setattr(V, "COUNTED_TOKENS", tokens)
    r = random.Random(tokens)
    rows = [(k, None if k % 13 == 0 else [r.choice(words) for _ in range(r.choice([0, 1, 2, 3, 25]))]) for k in range(90)]
    df = spark.createDataFrame(rows, "id long, w array<string>").coalesce(2)
    out = V._row_terms(df, "id", *span).collect()
    assert sorted(x.id for x in out) == list(range(90))
    got = [((x.id, t), n) for x in out for t, n in zip(x.terms, x.counts, strict=True)]
    assert len(got) == len(dict(got)) and dict(got) == _plain(rows, *span)


def test_strings_are_made_once_for_each_ngram(monkeypatch):
    made = []
    join = V.pc.binary_join_element_wise
    monkeypatch.setattr(V.pc, "binary_join_element_wise", lambda *a, **k: made.append(len(a[0])) or join(*a, **k))
    rows, terms, counts = V._counted(pa.array(["a", "b"] * 500), np.array([400, 1000]), 1, 3)
    assert made == [4, 4] and sum(counts) == 1000 + 998 + 996 and len(terms) == 12


def test_many_kinds_of_long_ngrams():
    # 10,000 words to the fifth power are no 64-bit number.
    words = [f"w{k}" for k in range(10_000)]
    rows, terms, counts = V._counted(pa.array(words + words), np.array([10_000, 20_000]), 5, 5)
    assert len(terms) == 2 * 9_996 and set(counts) == {1} and terms[0].as_py() == "w0 w1 w2 w3 w4"


def test_totals_below_the_bound_are_not_stored(spark, monkeypatch):
    rows = [(k, [f"common{k % 3}"] * 5 + [f"rare{k}"]) for k in range(900)]
    stored, real = [], V.most_frequent
    monkeypatch.setattr(V, "most_frequent", lambda counts, *a: stored.append(counts.count()) or real(counts, *a))
    df = spark.createDataFrame(rows, "id long, w array<string>")
    got = V.doc_term(df, "w", "id", (1, 2), 3).groupBy("term").agg({"n": "sum"}).collect()
    totals = Counter(t for _, w in rows for n in (1, 2) for t in (" ".join(w[k:k + n]) for k in range(len(w) - n + 1)))
    assert {tuple(r) for r in got} == set(sorted(totals.items(), key=lambda x: (-x[1], x[0]))[:3])
    assert stored[0] < 10


def test_ngrams_are_counted_that_are_made_of_frequent_ones(spark, monkeypatch):
    # Two words in three are rare: no n-gram that has one of them is shuffled, and no n-gram is stored for a row.
    rows = [(k, [w for j in range(6) for w in ("a", "b", "c", f"rare{k}-{j}", f"other{k}-{j}")]) for k in range(300)]
    df = spark.createDataFrame(rows, "id long, w array<string>")
    made, real = [], V._terms
    monkeypatch.setattr(V, "_terms", lambda *a: made.append(real(*a)) or made[-1])
    got = {(x.id, x.term): x.n for x in V.doc_term(df, "w", "id", (1, 3), 6).collect()}
    totals = Counter(t for _, w in rows for n in (1, 2, 3) for t in (" ".join(w[k:k + n]) for k in range(len(w) - n + 1)))
    top = dict(sorted(totals.items(), key=lambda x: (-x[1], x[0]))[:6])
    assert set(top) == {"a", "b", "c", "a b", "b c", "a b c"}
    assert got == {(i, t): n for (i, t), n in _plain(rows, 1, 3).items() if t in top}
    assert [m.count() for m in made[2:4]] == [600, 300]


def test_a_bound_that_was_guessed_too_high_is_taken_back(spark, monkeypatch):
    rows = [(k, [f"w{k % 5}", f"v{k % 7}", "a"]) for k in range(400)]
    df = spark.createDataFrame(rows, "id long, w array<string>")
    asked, real = [], V._totals
    monkeypatch.setattr(V, "GUESS", 1000)
    monkeypatch.setattr(V, "_totals", lambda *a, **k: asked.append(real(*a, **k)) or asked[-1])
    got = V.doc_term(df, "w", "id", (1, 2), 9).groupBy("term").agg({"n": "sum"}).collect()
    totals = Counter(t for _, w in rows for n in (1, 2) for t in (" ".join(w[k:k + n]) for k in range(len(w) - n + 1)))
    assert {tuple(r) for r in got} == set(sorted(totals.items(), key=lambda x: (-x[1], x[0]))[:9])
    assert len(asked) == 2 and asked[0] is None


@pytest.mark.parametrize("words", [["a", "b", None], ["a", "a b", "b", "x"]])
def test_most_frequent_of_texts_that_several_lengths_make(spark, words):
    r = random.Random(3)
    rows = [(k, [r.choice(words) for _ in range(9)]) for k in range(200)]
    df = spark.createDataFrame(rows, "id long, w array<string>")
    got = {(x.id, x.term): x.n for x in V.doc_term(df, "w", "id", (1, 3), 3).collect()}
    plain = Counter()
    for i, w in rows:
        for n in (1, 2, 3):
            for k in range(len(w) - n + 1):
                plain[i, None if None in w[k:k + n] else " ".join(w[k:k + n])] += 1
    totals = Counter()
    for (_, t), n in plain.items():
        totals[t] += n
    top = [t for t, _ in sorted(totals.items(), key=lambda x: (-x[1], x[0] or ""))[:3]]
    assert got == {(i, t): n for (i, t), n in plain.items() if t in top and t is not None}
