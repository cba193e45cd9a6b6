"""Steps whose tasks must not grow with the table."""

import html
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from fernwick.functions import text as X
from fernwick.llm import collision_ann as A
from fernwick.operators import classify as C
from fernwick.operators import evaluate as E
from fernwick.operators import features as J
from fernwick.operators import models as M
from fernwick.operators import ordered as O


def test_unescape_sends_entities_alone_to_python(spark):
    pieces = ["&amp;", "&copy", "&#65;", "&#x42", "&notit;", "&#xD800;", "&", "&&", "& ", "&nothing;", "&" + "x" * 40 + ";", "é𝄞", "\n", " ", "a;", "&#", "&#0;", "&𝄞;", ";"]
    rng = random.Random(3)
    texts = [None, "", "plain", *["".join(rng.choices(pieces, k=rng.randrange(1, 9))) for _ in range(300)]]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    out = df.select("id", X.html_unescape(F.col("t")).alias("t"))
    assert {r.id: r.t for r in out.collect()} == {k: t if t is None else html.unescape(t) for k, t in enumerate(texts)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract_all" in plan


def test_continuation_counts_contexts_once(spark):
    docs = spark.createDataFrame([("a b c d e f",), ("a b c x",), ("b c d",), (None,)], "t string").select(F.split("t", " ").alias("w"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    best = C.next_tokens(C.context_counts(docs.mapInArrow(count, docs.schema), "w", 2))
    seeds = spark.createDataFrame([(1, ["a", "b"]), (2, ["q", "b"]), (3, ["e"]), (4, None)], "id int, w array<string>")
    out = C.continue_text(seeds, best, "w", 2, 4)
    assert {r.id: r.w for r in out.collect()} == {1: list("abcdef"), 2: ["q", "b"], 3: ["e"], 4: None}
    assert seen.value == 4


def test_bleu_deals_pairs_to_parts(spark, monkeypatch):
    monkeypatch.setattr(E, "BLEU_ROWS", 10)
    rng = random.Random(4)
    rows = [(k // 2, [rng.choice("abc") for _ in range(9)], [rng.choice("abc") for _ in range(8)]) for k in range(100)]
    df = spark.createDataFrame(rows, "id int, r array<string>, h array<string>")
    out = E.corpus_bleu(df, "r", "h", "id")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [id" in plan and ", 10" in plan
    from collections import Counter
    from math import exp, log

    hit, total = Counter(), Counter()
    for i in range(50):
        for n in range(1, 5):
            r, h = (Counter(" ".join(w[s][k:k + n]) for w in rows if w[0] == i for k in range(len(w[s]) - n + 1)) for s in (1, 2))
            hit[n] += sum((r & h).values())
            total[n] += sum(h.values())
    assert abs(out.first()[0] - exp(1 - 9 / 8) * exp(sum(log(hit[n] / total[n]) for n in range(1, 5)) / 4)) < 1e-9


def test_codes_are_sent_to_the_rows(spark):
    df = spark.createDataFrame([(k, "a" if k % 9 else None) for k in range(100)], "id int, v string")
    out = J.apply_cats(df, J.category_dictionary(df, ["v"]), ["v"])
    assert {r.v for r in out.collect()} == {0, None}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan


def test_csv_shards_grow_in_number(spark, tmp_path):
    from fernwick.plans.catalog import QUERIES

    spark.range(40_000).selectExpr("id AS doc_id", "'a \"quoted\"\nline' AS text", "'s' AS source").write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["read_csv_shards"](spark, str(tmp_path))
    assert len(out.inputFiles()) == 5
    assert out.filter(F.col("content") == 'a "quoted"\nline').count() == 40_000


def test_word_vectors_train_in_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(M, "TRAIN_WORDS", 100)
    df = spark.createDataFrame([(k, ["a", "b", "c"] if k else None) for k in range(401)], "id int, w array<string>").filter("id > 0")
    model, rows = M.text_vectors(df, "w", size=4)
    assert model.getNumPartitions() == 12 and rows.count() == 400
    assert M.text_vectors(df.limit(9), "w", size=4)[0].getNumPartitions() == 8


def test_window_search_begins_near_the_last_radius():
    rng = np.random.default_rng(5)
    for count in (128, 300):
        value = rng.standard_normal((count, 700)).round(2)
        order = np.argsort(value, 1, kind="stable")
        arrays = A.SortedArrays(np.take_along_axis(value, order, 1), order.astype("i4"))
        q, seen = rng.standard_normal(count), []
        for radius in (0.4, 1.0, 50.0):
            want = ((value >= (q - radius)[:, None]) & (value <= (q + radius)[:, None])).sum(0)
            assert arrays.collisions(q, radius).tolist() == want.tolist()
        plain = arrays.collisions
        arrays.collisions = lambda at, radius: seen.append(radius) or plain(at, radius)
        for start in (0.1, 0.9, 30.0):
            hit, radius = arrays.window_search(q, 140, round(0.8 * count), start)
            near = radius / A.GROWTH**2
            for guess in (0, 1, 2, 5):
                seen.clear()
                got, at = arrays.window_search(q, 140, round(0.8 * count), near, guess)
                again = arrays.window_search(q, 140, round(0.8 * count), near)
                assert got.tolist() == again[0].tolist() and at == again[1]
            got, at = arrays.window_search(q, 140, round(0.8 * count), start, 3)
            assert got.tolist() == hit.tolist() and at == radius
    ids, score = rng.permutation(500), rng.integers(0, 60, 500) / 7
    for k in (1, 20, 300, 600):
        assert A._best(ids, score, k).tolist() == np.lexsort((ids, -score))[:k].tolist()


def test_ranks_are_made_in_parts_of_bounded_size(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(rng.choice([1.0, 1.0, 1.0, 2.0, 5.0, rng.random()]), rng.randrange(4), rng.random()) for _ in range(2_000)]
    df = spark.createDataFrame(rows, "a double, b int, y double")
    want = pd.DataFrame(rows, columns=["a", "b", "y"]).rank().corr()
    seen, plain = [], O.sorted_blocks

    def blocks(df, order, parts=None):
        seen.append(plain(df, order, parts))
        return seen[-1]

    monkeypatch.setattr(O, "sorted_blocks", blocks)
    monkeypatch.setattr(M, "RANK_ROWS", 300)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        for r in M.spearman_matrix(df, ["a", "b", "y"]).collect():
            assert abs(r["rho"] - want.loc[r["a"], r["b"]]) < 2e-4
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    sizes = [r["count"] for r in seen[0].groupBy("_block").count().collect()]
    assert len(sizes) > 15 and max(sizes) < 1_000


def test_ratings_meet_each_table_once(spark):
    rng = random.Random(9)
    ratings = spark.createDataFrame([(k, rng.randrange(20), rng.randrange(15), rng.random()) for k in range(300)], "row_id long, u int, i int, r double")
    model = M.CollabModel(ratings, "u", "i", "r", "row_id", factors=2, rounds=1)
    plan = model._known(ratings.select("u", "i"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2
    users, items = ({r[0]: (r[1], r[2]) for r in side.collect()} for side in (model.users, model.items))
    first = sorted((min(r.row_id for r in ratings.collect() if r.u == u), u) for u in users)
    assert [users[u][0] for _, u in first] == list(range(len(users)))
    mean = ratings.agg(F.avg("r")).first()[0]
    for r in model._known(ratings.select("u", "i")).collect():
        assert abs(r["_base"] - mean - users[r.u][1] - items[r.i][1]) < 1e-9 and (r["_u"], r["_i"]) == (users[r.u][0], items[r.i][0])
    assert model.predict(ratings.select("u", "i")).filter("prediction IS NOT NULL").count() == 300


def test_ablation_keeps_the_columns_of_its_fits_alone(spark, monkeypatch):
    from fernwick.plans.catalog import QUERIES

    seen = []
    monkeypatch.setattr(M, "drop_column_ablation", lambda train, valid, cols, label, **_: seen.append((train.columns, valid.columns, [*cols, label])))
    QUERIES["drop_column_ablation"](spark, "/root/testdata/sf0.001")
    assert all(set(at) == set(seen[0][2]) for at in seen[0][:2])


def test_tokens_without_apostrophes_are_passed_by_without_a_pattern(spark):
    df = spark.createDataFrame([("CANNOT cannots go\u212a gonna\u0130 don't don\u2019t aint A I'm",), (None,)], "t string")
    out = df.select(X.rule_tokens("t").alias("t"))
    assert out.first()[0] == ["CAN", "NOT", "cannots", "go\u212a", "gonna\u0130", "do", "n't", "do", "n\u2019t", "ai", "nt", "A", "I", "'m"]
    assert "RLIKE ['" not in out._jdf.queryExecution().optimizedPlan().toString()
