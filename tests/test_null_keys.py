"""Null keys, repeated keys and size switches: both ways give the same rows."""

import pytest
from pyspark.sql import functions as F

from fernwick import session
from fernwick.operators import classify, features, relational, sampling, vocab, windows


@pytest.fixture()
def series(spark):
    rows = [(k, f"2024-01-{d + 1:02d}", d, d == 0, 1.0) for k in (None, "a") for d in range(20)]
    return spark.createDataFrame(rows, "k string, d string, i int, flag boolean, v double")


def _sorted(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("limit", [5, 100])
def test_days_with_null_keys(series, limit):
    out = windows.days_since_last(series, F.col("flag"), ["k"], "d", "i", limit=limit).collect()
    assert sorted((r.after for r in out if r.k is None)) == list(range(20))
    back = windows.days_until_next(series.withColumn("flag", F.col("i") == 19), F.col("flag"), ["k"], "d", "i", limit=limit).collect()
    assert sorted((r.before for r in back if r.k is None)) == list(range(-19, 1))


def test_rolling_sums_with_null_keys(series):
    one, two = (windows.rolling_sum_trailing(series, ["v"], ["k"], ["d"], 7, limit=n) for n in (8, 100))
    assert _sorted(one) == _sorted(two.select(one.columns))


def test_ewma_with_null_keys(spark):
    rows = [(k, i, 1.0) for k in (None, 1) for i in range(3000)]
    out = windows.ewma(spark.createDataFrame(rows, "k int, i int, v double"), "v", ["k"], ["i"], beta=0.5)
    assert out.filter("abs(smoothed - 1) > 1e-9 or smoothed is null").count() == 0 and out.count() == 6000


def test_percentiles_with_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    assert {r.k: r.median for r in relational.median(df, "v", ["k"]).collect()} == {None: 1.5, "a": 3.0}
    assert relational.percentiles(df, "v", [0.975, 0.98]).columns == ["p97_5", "p98"]


def test_null_groups_are_kept(spark):
    df = spark.createDataFrame([(None, [1]), (None, [1, 2]), (1, [3])], "b int, s array<int>")
    assert features.pad_batch(df, "s", "b", 0).count() == 3
    split = sampling.grouped_split(spark.createDataFrame([(None, 1), (None, 2)], "g string, i int"), "g", train_size=1.0, second_size=1.0)
    assert {r.split for r in split.collect()} == {"train"}


def test_repeated_dictionary_keys_and_row_ids(spark, monkeypatch):
    docs = spark.createDataFrame([(1, ["a", "b", "z"]), (1, ["a"]), (2, []), (3, None)], "doc_id int, w array<string>")
    words = spark.createDataFrame([("a", 7), ("a", 5), ("b", 6)], "token string, id long")
    small = _sorted(vocab.numericalize_docs(docs, "w", words, "doc_id").select("doc_id", F.coalesce("ids", F.array().cast("array<long>"))))
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    large = _sorted(vocab.numericalize_docs(docs, "w", words, "doc_id").select("doc_id", F.coalesce("ids", F.array().cast("array<long>"))))
    assert [x.split("=", 2)[2] for x in small] == [x.split("=", 2)[2] for x in large] and len(small) == 4


def test_a_token_in_every_document(spark):
    docs = spark.createDataFrame([(i, ["the"] * (i % 3 + 1) + [f"w{i % 7}"]) for i in range(300)], "doc_id int, w array<string>")
    every = vocab.doc_term(docs, "w", "doc_id")
    top = vocab.doc_term(docs, "w", "doc_id", max_features=1)
    assert _sorted(top) == _sorted(every.filter("term = 'the'"))


def test_perplexity_against_the_joined_form(spark):
    counts = spark.createDataFrame([("a", "x", 3), ("a", "y", 1), ("b", "x", 2)], "context string, next string, n long")
    sizes = counts.groupBy("context").agg(F.sum("n").alias("c"))
    p = (F.col("n") + 1) / (F.col("c") + 2)
    want = counts.join(sizes, "context").agg(F.exp(F.sum(-F.log(p) * F.col("n")) / F.sum("n"))).first()[0]
    assert abs(classify.perplexity(counts).first()[0] - want) < 1e-12


def test_scratch_tables_go_at_the_end(spark):
    with session.scratch(spark) as folder:
        path = session.scratch_path(spark, "t")
        assert path.startswith(folder)
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    assert not files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(files)


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_name_bounds(spark, monkeypatch):
    df = spark.createDataFrame([(1, ["a"]), (2, ["b"])], "i int, labels array<string>")
    monkeypatch.setattr(features, "MAX_NAMES", 1)
    with pytest.raises(ValueError, match="too many"):
        features.nhot_labels(df, "i", "labels")
