"""Published examples of the tabular functions, and properties of splits and samplers."""

import datetime

import pytest
from pyspark.sql import functions as F

from fernwick.functions import dates as D
from fernwick.operators import features as J
from fernwick.operators import sampling as S
from fernwick.operators import vocab as V


def test_add_datepart(spark):
    df = spark.sql("SELECT explode(array(timestamp_ntz'2000-03-11', timestamp_ntz'2000-03-12', timestamp_ntz'2000-03-13')) AS ADate")
    rows = [r.asDict() for r in D.add_datepart(df, "ADate").orderBy("AElapsed").collect()]
    assert [r["AYear"] for r in rows] == [2000] * 3 and [r["AMonth"] for r in rows] == [3] * 3
    assert [r["AWeek"] for r in rows] == [10, 10, 11] and [r["ADayofweek"] for r in rows] == [5, 6, 0]
    assert [r["ADayofyear"] for r in rows] == [71, 72, 73]
    assert [r["AElapsed"] for r in rows] == [952732800, 952819200, 952905600]
    assert "ADate" not in rows[0] and len(rows[0]) == 13


def test_fix_missing(spark):
    df = spark.createDataFrame([(1, 5), (None, 2), (3, 2)], "col1 int, col2 int")
    out, nas = J.fix_missing(df)
    assert [tuple(r) for r in out.collect()] == [(1, 5, False), (2, 2, True), (3, 2, False)]
    assert out.columns == ["col1", "col2", "col1_na"] and nas == {"col1": 2.0}
    out, nas = J.fix_missing(df, na_dict={"col1": 500})
    assert [r["col1"] for r in out.collect()] == [1, 500, 3]


def test_categories(spark):
    train = spark.createDataFrame([("a",), ("b",), ("a",)], "col2 string")
    new = spark.createDataFrame([(1, "b"), (2, "a"), (3, "a"), (4, "z"), (5, None)], "i int, col2 string")
    cats = J.train_cats(train)
    assert [r["col2"] for r in J.apply_cats(new, cats, ["col2"]).orderBy("i").collect()] == [1, 0, 0, None, None]
    assert sorted(r["col2"] for r in J.numericalize(train, cats, ["col2"])[0].collect()) == [1, 1, 2]


def test_proc_df(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "col1 int, col2 string")
    out = J.proc_df(df, "col1")
    assert sorted((r["y"], r["col2"]) for r in out.x.collect()) == [(1, 1), (2, 2), (3, 1)] and out.nas == {}
    again = J.proc_df(spark.createDataFrame([("b", 9)], "col2 string, col1 int"), "col1", categories=out.categories)
    assert again.x.first()["col2"] == 2
    coded = J.proc_df(df, "col2")
    assert sorted(r["y"] for r in coded.x.collect()) == [0, 0, 1]


def test_sample_and_folds(spark):
    df = spark.range(1000).withColumn("v", F.col("id") * 2)
    got = [r["id"] for r in S.get_sample(df, 40, "id").collect()]
    assert len(got) == 40 == len(set(got)) and got == sorted(got)
    folds = [{r["id"] for r in S.cv_fold(df, "id", i).filter("is_val").collect()} for i in range(5)]
    assert [len(f) for f in folds] == [200] * 5 and len(set.union(*folds)) == 1000


def test_grouped_split_keeps_groups_whole(spark):
    df = spark.range(3000).withColumn("repo", F.concat(F.lit("r"), (F.col("id") % 100).cast("string")))
    out = S.grouped_split(df, "repo")
    assert out.count() == 3000
    assert out.groupBy("repo").agg(F.countDistinct("split").alias("n")).filter("n > 1").isEmpty()
    sizes = {r["split"]: r["n"] for r in out.select("repo", "split").distinct().groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert sizes == {"train": 71, "valid": 16, "test": 13}


@pytest.mark.parametrize("bs", [4, 7])
def test_samplers(spark, bs):
    df = spark.range(997).withColumn("len", F.xxhash64("id") % 50 + 50)
    rows = S.sort_batches(df, "len", "id", bs).collect()
    assert len(rows) == 997
    order = sorted(rows, key=lambda r: (r["batch"], -r["len"]))
    assert [r["len"] for r in order] == sorted((r["len"] for r in rows), reverse=True)
    rows = S.sortish_batches(df, "len", "id", bs, chunk_batches=5).collect()
    assert sorted(r["id"] for r in rows) == list(range(997))
    batches = {}
    for r in rows:
        batches.setdefault(r["batch_order"], []).append(r["len"])
    assert sorted(batches) == list(range(len(batches)))
    assert max(batches[0]) == max(r["len"] for r in rows)
    assert all(len(b) <= bs for b in batches.values())


def test_vocab_cuts_before_the_minimum(spark):
    toks = spark.createDataFrame([(t,) for t in "a a a b b c c d".split()], "token string")
    assert [r["token"] for r in V.build_vocab(toks, 2, 1, []).orderBy("id").collect()] == ["a", "b"]
    ids = [r["id"] for r in V.build_vocab(toks, 10, 0).orderBy("id").collect()]
    assert ids == list(range(8))


def test_empty_documents_keep_their_row(spark):
    docs = spark.createDataFrame([(1, ["a", "x"]), (2, []), (3, ["a"])], "doc_id int, w array<string>")
    vocab = V.build_vocab(spark.createDataFrame([("a",)], "token string"), 10)
    got = {r["doc_id"]: r["ids"] for r in V.numericalize_docs(docs, "w", vocab, "doc_id", append=2).collect()}
    assert got == {1: [4, 3, 2], 2: [2], 3: [4, 2]}


@pytest.mark.parametrize("backwards", [False, True])
def test_lm_stream(spark, backwards):
    docs = [(1, [5, 6, 7]), (2, []), (3, [8]), (4, [9, 10, 11, 12, 13, 14]), (5, [15])]
    df = spark.createDataFrame(docs, "doc_id int, ids array<int>")
    flat = [i for _, d in docs for i in d]
    nb = len(flat) // 3
    cols = [flat[c * nb:(c + 1) * nb] for c in range(3)]
    if backwards:
        cols = [c[::-1] for c in cols]
    want = {(c, r, r // 2, cols[c][r], cols[c][r + 1]) for c in range(3) for r in range(nb - 1)}
    assert {tuple(r) for r in V.lm_stream(df, "ids", "doc_id", 3, 2, backwards).collect()} == want


def test_combine_and_week(spark):
    one = spark.range(1).select(
        D.combine_date(F.lit(2015), F.lit(14), F.lit(3), hours=F.lit(25), milliseconds=F.lit(1500)),
        D.iso_week_monday(F.lit(2015), F.lit(53)), D.iso_week_monday(F.lit(2016), F.lit(1))).first()
    assert one[0] == datetime.datetime(2016, 2, 4, 1, 0, 1, 500000)
    assert one[1:] == (datetime.date(2015, 12, 28), datetime.date(2016, 1, 4))


def test_constant_column_scales_to_zero(spark):
    out, fitted = J.scale_vars(spark.createDataFrame([(1.0, 2), (1.0, 4)], "a double, b int"))
    assert sorted(tuple(r) for r in out.collect()) == [(0.0, -1.0), (0.0, 1.0)] and fitted["a"] == (1.0, 0.0)


def test_large_vocabulary_is_joined(spark, monkeypatch):
    docs = spark.createDataFrame([(1, ["a", "x", "b"]), (2, []), (3, ["b"])], "doc_id int, w array<string>")
    vocab = V.build_vocab(spark.createDataFrame([("a",), ("b",), ("b",)], "token string"), 10)
    monkeypatch.setattr(V.session, "BROADCAST_ROWS", 1)
    ids = V.numericalize_docs(docs, "w", vocab, "doc_id")
    assert {r["doc_id"]: r["ids"] for r in ids.collect()} == {1: [5, 3, 4], 2: [], 3: [4]}
    back = V.denumericalize(ids, "ids", vocab, "doc_id")
    assert {r["doc_id"]: r["tokens"] for r in back.collect()} == {1: ["a", "_unk_", "b"], 2: [], 3: ["b"]}
