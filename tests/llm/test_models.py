"""Toxicity, quality, n-gram join, neighbours and the pipeline against plain versions and held-out rows."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fernwick.llm import collision_ann, common, importance, ngram_join, toxicity
from tests.llm.fixtures import awkward_rows, empty, table, words

ROWS = awkward_rows()


def plain_components(rows, size, num, den):
    sets = []
    for i, t in rows:
        w = words(t)
        sets.append((i, frozenset(tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()))
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (_, x) in enumerate(sets):
        for b in range(a):
            y = sets[b][1]
            if x and y and den * len(x & y) >= num * len(x | y):
                parent[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            low[find(k)] = min(i, low.get(find(k), i))
    return [(i, len(s), low.get(find(k)) if s else i) for k, (i, s) in enumerate(sets)]


@pytest.mark.parametrize("size,num,den", [(3, 90, 100), (5, 80, 100), (2, 50, 100), (1, 100, 100)])
def test_ngram_classes(spark, size, num, den):
    got = ngram_join.ngram_classes(table(spark, ROWS), size=size, threshold=(num, den), sketch_bits=10)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, plain_components(ROWS, size, num, den)))


def test_ngram_classes_in_a_group_of_near_copies(spark):
    r = random.Random(8)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(150):
        own = list(base)
        for _ in range(r.randint(0, 4)):
            own[r.randrange(len(own))] = f"e{r.randrange(400)}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, " ".join(f"v{r.randrange(50)}" for _ in range(40))) for i in range(40)]
    got = ngram_join.ngram_classes(table(spark, rows), size=3, threshold=(90, 100))
    assert sorted(map(tuple, got.collect())) == sorted(plain_components(rows, 3, 90, 100))


def test_ngram_classes_empty(spark):
    assert ngram_join.ngram_classes(empty(spark)).count() == 0
    got = ngram_join.ngram_classes(table(spark, [(1, None), (2, " ")])).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1), (2, 0, 2)]


def test_components(spark):
    links = [(k, k + 1) for k in range(20)] + [(100, 50), (50, 70), (70, 100), (7, 7)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(21)}, 100: 50, 50: 50, 70: 50}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def toxic_rows(n=600):
    r = random.Random(9)
    plain = [f"word{k}" for k in range(200)]
    rows, labels = [], []
    for i in range(n):
        sents = [" ".join(r.choice(plain) for _ in range(8)) for _ in range(r.randint(1, 9))]
        bad = i % 5 == 1
        if bad:
            k = r.randrange(len(sents))
            sents[k] = sents[k] + " scoundrel" + r.choice(["", "s", "ish"])
        rows.append((i, ". ".join(sents)))
        labels.append((i, int(bad), int(not bad)))
    return rows, labels


def test_toxicity_learns_sentences_from_documents(spark):
    rows, labels = toxic_rows()
    known = spark.createDataFrame(labels + [(None, 1, 0), (5_000, None, None)], "doc_id long, toxic int, quality int")
    docs = table(spark, rows + [(900, None), (901, ""), (None, "word1 scoundrel"), (902, "word2 word3. " * 500 + "word4 scoundrel"), (0, rows[0][1])])
    model = toxicity.fit_noisy_or(docs, known)
    out = toxicity.score_toxicity(docs, model).collect()
    assert len(out) == len(rows) + 5
    held = {i: y for i, y, _ in labels if __import__("zlib").crc32(str(i).encode()) % 5 == 0}
    right = [(r.score >= 0.5) == bool(held[r.doc_id]) for r in out if r.doc_id in held]
    assert np.mean(right) > 0.97
    for r in out:
        assert 0 <= r.score <= 1
        for s in r.offending:
            assert "scoundrel" in s["text"] or r.score < 0.9
    by_id = {r.doc_id: r for r in out}
    assert by_id[900].score == by_id[901].score == 0 and by_id[None].score > 0.5 and by_id[902].score > 0.5


def test_toxicity_without_labels(spark):
    rows, labels = toxic_rows(30)
    docs = table(spark, rows)
    for known in ([], [(i, 0) for i, _, _ in labels]):
        model = toxicity.fit_noisy_or(docs, spark.createDataFrame(known, "doc_id long, toxic int"))
        assert {r.score for r in toxicity.score_toxicity(docs, model).collect()} == {0.0}
    assert toxicity.score_toxicity(empty(spark), model).count() == 0


def test_importance_counts_and_top_k(spark):
    r = random.Random(10)
    good = [(i, " ".join(r.choice(["alpha", "beta", "gamma"]) for _ in range(20))) for i in range(80)]
    junk = [(100 + i, " ".join(r.choice(["AA!!", "BB!!", "CC!!"]) for _ in range(20))) for i in range(20)]
    rows = good + junk + [(300, None), (301, ""), (None, "alpha beta")]
    docs = table(spark, rows)
    labels = spark.createDataFrame([(i, 1) for i, _ in good[:40]] + [(i, 0) for i, _ in junk[:10]], "doc_id long, quality int")
    out = importance.resample(docs, labels).collect()
    assert len(out) == len(rows)
    assert sum(x.kept for x in out) == round((40 / 50 + 0.01) * len(rows))
    assert all(x.kept for x in out if x.doc_id is not None and x.doc_id < 80)
    assert {x.place for x in out} == set(range(1, len(rows) + 1))
    assert sorted(out, key=lambda x: -x.sampled_by)[0].place == 1
    # The ratios are those of plain counts.
    ratios = importance.fit_importance(docs, spark.createDataFrame([(i,) for i, _ in good[:40]], "_id long"), buckets=64)
    hashes, raw, aim = common.WordHashes(), Counter(), Counter()
    for i, t in rows:
        got = importance._grams(hashes, (t or "").encode(), 64).tolist()
        raw.update(got)
        if i is not None and i < 40:
            aim.update(got)
    want = [np.log((aim[b] + 1) / (sum(aim.values()) + 64)) - np.log((raw[b] + 1) / (sum(raw.values()) + 64)) for b in range(64)]
    assert np.allclose(ratios, want)


def test_importance_without_labels(spark):
    docs = table(spark, ROWS)
    out = importance.resample(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert out.filter("kept").count() == len(ROWS)
    assert importance.resample(empty(spark), spark.createDataFrame([(1, 1)], "doc_id long, quality int")).count() == 0


def test_gumbel_noise_is_standard(spark):
    got = spark.range(20_000).select(importance.gumbel(F.col("id"), "s").alias("g")).agg(F.avg("g"), F.stddev("g")).first()
    assert abs(got[0] - 0.5772) < 0.05 and abs(got[1] - 1.2825) < 0.05


def test_neighbours(spark):
    rng = np.random.default_rng(11)
    centres = rng.standard_normal((6, 12)) * 3
    data = [(int(i), (centres[i % 6] + rng.standard_normal(12)).tolist()) for i in range(600)]
    data += [(700, data[0][1]), (701, data[0][1]), (20, data[1][1])]
    odd = [(800, None), (801, [0.0] * 12), (802, [1.0, None] + [0.0] * 10), (803, [float("nan")] * 12), (804, [float("inf")] * 12),
           (805, []), (806, [1.0, 2.0])]
    df = spark.createDataFrame(data + odd, "vec_id long, embedding array<double>").withColumns({"rank": F.lit(1), "block": F.lit(2)})
    rows = common.store(collision_ann.usable_rows(df, "vec_id", "embedding"), "vectors")
    got = collision_ann.nearest(rows, rows.filter("_id % 20 = 0"), k=20, block=128).collect()
    by_query = {}
    for r in got:
        by_query.setdefault(r.query_id, []).append(r)
    x = np.array([v for _, v in data])
    recall = []
    for j, (i, v) in enumerate(data):
        if i % 20 or i in (20, 700):
            continue
        score = x @ np.array(v)
        score[j] = -np.inf
        best = sorted(range(len(data)), key=lambda a: (-score[a], data[a][0]))[:20]
        mine = sorted(by_query[i], key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 21))
        assert all(abs(r.score - max(score[a] for a in range(len(data)) if data[a][0] == r.vec_id)) < 1e-9 or r.vec_id == 20 for r in mine)
        assert all((-a.score, a.vec_id) <= (-b.score, b.vec_id) for a, b in zip(mine, mine[1:]))
        recall.append(len({data[a][0] for a in best} & {r.vec_id for r in mine}) / 20)
    assert np.mean(recall) >= 0.9
    none = common.store(collision_ann.usable_rows(df.filter("vec_id >= 800"), "vec_id", "embedding"), "vectors")
    assert collision_ann.nearest(none, none.filter("_id % 20 = 0")).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as p

    rows, labels = toxic_rows(300)
    rows += [(1000 + i, rows[0][1]) for i in range(5)] + [(2000, None), (2001, ""), (None, rows[2][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    before = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in p.STAGES[:-1]:
        after = common.store(stage(spark, before, str(tmp_path)), name)
        assert after.columns == p.COLUMNS and after.exceptAll(before.select(*p.COLUMNS)).count() == 0
        before = after
    assert before.filter("text like '%scoundrel%'").count() < 6
    assert before.filter("doc_id >= 1000 and doc_id < 2000").count() == 0
    packed = p.STAGES[-1][1](spark, before, str(tmp_path))
    assert packed.count() == before.count()


def _documents(spark, path, rows, labels):
    spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long"), "row": F.lit(1)}).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{path}/labels.parquet")
    return spark.read.parquet(f"{path}/documents.parquet")


def test_pipeline_judges_rows_not_ids(spark, tmp_path):
    import corpus_pipeline as p

    rows, labels = toxic_rows(300)
    clean = [t for i, t in rows if "scoundrel" not in t]
    toxic = [t for i, t in rows if "scoundrel" in t]
    odd = [(None, toxic[0]), (None, clean[0] + " of its own"), (7000, toxic[1]), (7000, clean[1] + " and one more"), (None, None), (None, "")]
    docs = _documents(spark, tmp_path, rows + odd, labels)
    kept = [tuple(r) for r in p.toxicity(spark, docs, str(tmp_path)).select("doc_id", "text").collect()]
    assert not set(odd[i] for i in (0, 2)) & set(kept) and all(odd[i] in kept for i in (1, 3, 4, 5))


def test_pipeline_keeps_one_row_of_each_group(spark, tmp_path):
    import corpus_pipeline as p

    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    base = [[word() for _ in range(60)] for _ in range(5)]
    rows = [(1, base[0]), (1, base[0]), (None, base[0]), (None, base[1]), (None, base[1]), (3, base[2]), (3, base[3]), (2, base[2]), (9, base[4] + ["x"]), (8, base[4])]
    rows = [(i, " ".join(w)) for i, w in rows] + [(None, None), (None, None), (5, ""), (5, ""), (5, " ")]
    docs = _documents(spark, tmp_path, rows, [(1, 0, 1)])
    kept = [tuple(r) for r in p.near_duplicates(spark, docs, str(tmp_path)).select("doc_id", "text").collect()]
    # Plain version: groups of linked texts, smallest id first, null ids last; rows without words stay.
    sets = [{tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} for w in ((t or "").split() for _, t in rows)]
    groups = []
    for k, (i, t) in enumerate(rows):
        if not (t or "").split():
            groups.append([k])
            continue
        near = [g for g in groups if any((rows[j][1] or "").split() and len(sets[j] & sets[k]) >= 0.8 * len(sets[j] | sets[k]) for j in g)]
        groups = [g for g in groups if g not in near] + [sum(near, []) + [k]]
    want = [min((rows[k] for k in g), key=lambda x: (x[0] is None, x[0] or 0)) for g in groups]
    assert sorted(map(repr, kept)) == sorted(map(repr, want))
    assert len(kept) == 10


def test_pipeline_of_empty_tables(spark, tmp_path):
    import corpus_pipeline as p

    _documents(spark, tmp_path, [(1, "x")], [(1, 0, 1)])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").filter("false")
    labels = spark.read.parquet(f"{tmp_path}/labels.parquet").filter("false")
    docs.write.parquet(f"{tmp_path}/none/documents.parquet")
    labels.write.parquet(f"{tmp_path}/none/labels.parquet")
    assert p.run(spark, f"{tmp_path}/none").count() == 0
    assert p.run(spark, str(tmp_path)).count() == 1
