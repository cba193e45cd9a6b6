"""Spark ML models, their inspection, and the split search of a regression tree."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import product

import pandas as pd
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler, Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fernwick.operators.evaluate import rmse
from fernwick.operators.features import dense_index
from fernwick.operators.ordered import average_ranks, running_totals
from fernwick.operators.relational import top_bottom
from fernwick.operators.vectors import attach_metadata, knn
from fernwick.session import cut_lineage


def best_split(df: DataFrame, features: Sequence[str], target: str, min_leaf: int = 5) -> DataFrame:
    """Per feature the threshold with the least ``n_l * std_l + n_r * std_r``.

    Equal feature values are summed first (a threshold cannot separate them); running count, sum
    and sum of squares over the sorted values score all thresholds of all features in one pass.
    """
    y = F.col(target).cast("double")
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x"), y.alias("y"))
        for c in features])))
    groups = long.groupBy("feature", "x").agg(
        F.count("*").alias("_n"), F.sum("y").alias("_s"), F.sum(F.col("y") * F.col("y")).alias("_s2"))
    upto = running_totals(groups, ["x"], {"n": "_n", "s": "_s", "s2": "_s2"}, ["feature"])
    # One row per feature.
    whole = groups.groupBy("feature").agg(*[F.sum(f"_{c}").alias(f"_t_{c}") for c in ("n", "s", "s2")])
    rows = upto.join(F.broadcast(whole), "feature").select(
        "feature", "x", "n", "s", "s2", *[(F.col(f"_t_{c}") - F.col(c)).alias(f"r_{c}") for c in ("n", "s", "s2")])

    def spread(n, s, s2):
        return F.col(n) * F.sqrt(F.greatest(F.col(s2) / F.col(n) - F.pow(F.col(s) / F.col(n), 2), F.lit(0.0)))

    scored = rows.filter((F.col("n") > min_leaf) & (F.col("r_n") > min_leaf)).withColumn(
        "score", spread("n", "s", "s2") + spread("r_n", "r_s", "r_s2"))
    w = Window.partitionBy("feature").orderBy("score", "x")
    return scored.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select(
        "feature", F.col("x").alias("threshold"), "score")


# ---------------------------------------------------------------- forests


def features_column(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def random_forest(df: DataFrame, cols: Sequence[str], label: str, classify: bool = False, trees: int = 10,
                  min_leaf: int = 1, max_features: str | float = "auto", subsample: float = 1.0,
                  max_depth: int = 8, seed: int = 42):
    """Fit a forest on the columns; ``subsample`` is the share of rows drawn per tree."""
    kind = RandomForestClassifier if classify else RandomForestRegressor
    forest = kind(featuresCol="features", labelCol=label, numTrees=trees, minInstancesPerNode=min_leaf,
                  featureSubsetStrategy=str(max_features), subsamplingRate=subsample, maxDepth=max_depth, seed=seed)
    return forest.fit(features_column(df, cols))


def feature_importance(spark: SparkSession, model, cols: Sequence[str], keep: float = 0.0) -> DataFrame:
    """``(cols, imp)`` by falling importance; one row per feature column."""
    rows = [(c, float(v)) for c, v in zip(cols, model.featureImportances.toArray()) if v > keep]
    return spark.createDataFrame(sorted(rows, key=lambda r: (-r[1], r[0])), "cols string, imp double")


def tree_spread(model, df: DataFrame, cols: Sequence[str], out_mean: str = "pred", out_std: str = "pred_std") -> DataFrame:
    """Mean and population deviation over the trees, per row; the trees add columns, not rows."""
    rows = features_column(df, cols)
    names = []
    for i, tree in enumerate(model.trees):
        names.append(f"_tree{i}")
        rows = tree.setPredictionCol(names[-1]).transform(rows)
    preds, n = F.array(*names), float(len(names))
    mean = F.aggregate(preds, F.lit(0.0), lambda a, x: a + x) / n
    rows = rows.withColumn(out_mean, mean).withColumn("_p", preds)
    std = F.sqrt(F.aggregate("_p", F.lit(0.0), lambda a, x: a + (x - F.col(out_mean)) * (x - F.col(out_mean))) / n)
    return rows.withColumn(out_std, std).select(*df.columns, out_mean, out_std)


def holdout_rmse(model, df: DataFrame, cols: Sequence[str], label: str) -> float:
    scored = model.transform(features_column(df, cols))
    return scored.agg(rmse("prediction", label)).first()[0]


def drop_column_ablation(train: DataFrame, valid: DataFrame, cols: Sequence[str], label: str, fit=None, **options) -> DataFrame:
    """``(dropped, rmse)``: the holdout error with all columns and without each of them. ``fit`` takes rows, columns,
    label and ``options``; a forest by default."""
    fit = fit or random_forest
    train, valid = train.persist(), valid.persist()
    try:
        scores = []
        for dropped in (None, *cols):
            kept = [c for c in cols if c != dropped]
            scores.append((dropped or "", holdout_rmse(fit(train, kept, label, **options), valid, kept, label)))
    finally:
        train.unpersist()
        valid.unpersist()
    return train.sparkSession.createDataFrame(scores, "dropped string, rmse double")


def partial_dependence(model, df: DataFrame, cols: Sequence[str], grid: Mapping[str, Sequence[float]]) -> DataFrame:
    """Mean prediction with the features set to each grid point (one feature, a pair, or a group).

    Each row is repeated once per grid point by exploding a literal array; the grid is a parameter.
    """
    points = F.array(*[F.struct(*[F.lit(float(v)).alias(c) for c, v in zip(grid, p)])
                       for p in product(*grid.values())])
    rows = df.select(*[c for c in cols if c not in grid], F.explode(points).alias("_g")).select(
        "*", *[F.col(f"_g.{c}").alias(c) for c in grid]).drop("_g")
    scored = model.transform(features_column(rows, cols))
    return scored.groupBy(*grid).agg(F.avg("prediction").alias("prediction"))


def adversarial_validation(train: DataFrame, valid: DataFrame, cols: Sequence[str], **forest):
    """Forest that tells valid from train rows, and its importances: the columns that drift."""
    both = train.select(*cols).withColumn("is_valid", F.lit(0.0)).unionByName(
        valid.select(*cols).withColumn("is_valid", F.lit(1.0)))
    model = random_forest(both, cols, "is_valid", classify=True, **forest)
    return model, feature_importance(train.sparkSession, model, cols)


# Values that one task ranks or puts together.
RANK_ROWS = 1_000_000


def spearman_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(a, b, rho)``: correlation of average ranks for each pair of columns, over the rows without a null.

    All columns are sorted together as (column, value, row), ranks are made in the sorted blocks, and rows are put
    together again once, by their number. Many rows are dealt to parts of about `RANK_ROWS`.
    """
    cols = list(cols)
    known = cut_lineage(df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna())
    # The checkpoint keeps the numbers as they are.
    long = known.withColumn("_row", F.monotonically_increasing_id()).select("_row", F.inline(F.array(*[
        F.struct(F.lit(i).alias("c"), F.col(c).alias("v")) for i, c in enumerate(cols)])))
    parts = -(-known.count() * len(cols) // RANK_ROWS)
    many = parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranks = average_ranks(long, ["c"], "v", "_row", parts=parts if many else None)
    ranks = ranks.repartition(parts, "_row") if many else ranks
    ranked = ranks.groupBy("_row").agg(*[F.max(F.when(F.col("c") == i, F.col("rank"))).alias(f"_r{i}") for i in range(len(cols))])
    pairs = [(i, j) for i in range(len(cols)) for j in range(len(cols))]
    row = ranked.agg(*[F.corr(f"_r{i}", f"_r{j}").alias(f"_{i}_{j}") for i, j in pairs])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(cols[i]).alias("a"), F.lit(cols[j]).alias("b"), F.round(F.col(f"_{i}_{j}"), 4).alias("rho"))
        for i, j in pairs])))


# ---------------------------------------------------------------- linear models


def linear_regression(df: DataFrame, cols: Sequence[str], label: str):
    return LinearRegression(featuresCol="features", labelCol=label, solver="normal").fit(features_column(df, cols))


def lasso_cv(df: DataFrame, cols: Sequence[str], label: str, penalties: Sequence[float], folds: int = 3, seed: int = 42):
    """Lasso with the penalty chosen by cross validation."""
    lasso = LinearRegression(featuresCol="features", labelCol=label, elasticNetParam=1.0)
    grid = ParamGridBuilder().addGrid(lasso.regParam, list(penalties)).build()
    judge = RegressionEvaluator(labelCol=label, metricName="rmse")
    return CrossValidator(estimator=lasso, estimatorParamMaps=grid, evaluator=judge, numFolds=folds, seed=seed).fit(
        features_column(df, cols)).bestModel


def strong_coefficients(spark: SparkSession, model, cols: Sequence[str], floor: float = 0.01) -> DataFrame:
    """``(column, coef)`` with an absolute value of at least ``floor``."""
    rows = [(c, float(v)) for c, v in zip(cols, model.coefficients) if abs(v) >= floor]
    return spark.createDataFrame(rows, "column string, coef double")


# ---------------------------------------------------------------- ratings


def rating_biases(ratings: DataFrame, user: str, item: str, rating: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Global mean (one row), user biases and item biases.

    A user's bias is the mean distance of their ratings to the global mean; an item's bias is the
    mean of what is then left.
    """
    mean = ratings.agg(F.avg(rating).alias("mean"))
    users = ratings.groupBy(user).agg((F.avg(rating) - mean.scalar()).alias("user_bias"))
    left = ratings.join(users, user)
    items = left.groupBy(item).agg(F.avg(F.col(rating) - mean.scalar() - F.col("user_bias")).alias("item_bias"))
    return mean, users, items


# Blocks of users and of items in a fit, and ratings of a block at most: building it takes some 50 bytes each.
ALS_BLOCKS = 10
BLOCK_RATINGS = 2_500_000


def als_blocks(ratings: int) -> int:
    """Blocks of users, and of items, that so many ratings are dealt to."""
    return max(ALS_BLOCKS, -(-ratings // BLOCK_RATINGS))


class CollabModel:
    """Biases plus factors on the residuals, limited to the range of the ratings."""

    def __init__(self, ratings: DataFrame, user: str, item: str, rating: str, row_id: str, factors: int = 50,
                 reg: float = 0.1, rounds: int = 5, seed: int = 42):
        self.user, self.item = user, item
        self.mean, users, items = rating_biases(ratings, user, item, rating)
        low, high, count = ratings.agg(F.min(rating), F.max(rating), F.count("*")).first()
        self.range = (low, high)
        # Number and bias of a user or item are joined once for the fit and once for every prediction.
        self.users = cut_lineage(dense_index(ratings, user, row_id, "_u").join(users, user, "left"))
        self.items = cut_lineage(dense_index(ratings, item, row_id, "_i").join(items, item, "left"))
        rows = self._known(ratings.select(user, item, rating)).withColumn("_res", F.col(rating) - F.col("_base"))
        # A task of the fit holds all ratings of a block; blocks that are kept for later rounds leave its memory alone.
        blocks = als_blocks(count)
        kept = {"intermediateStorageLevel": "DISK_ONLY", "finalStorageLevel": "DISK_ONLY"} if blocks > ALS_BLOCKS else {}
        self.als = ALS(rank=factors, maxIter=rounds, regParam=reg, userCol="_u", itemCol="_i", ratingCol="_res",
                       seed=seed, numUserBlocks=blocks, numItemBlocks=blocks, **kept).fit(rows.select("_u", "_i", F.col("_res").cast("float")))

    def _known(self, pairs: DataFrame) -> DataFrame:
        rows = pairs.join(self.users, self.user, "left").join(self.items, self.item, "left")
        base = self.mean.scalar() + F.coalesce("user_bias", F.lit(0.0)) + F.coalesce("item_bias", F.lit(0.0))
        return rows.withColumns({"_base": base, "_u": F.col("_u").cast("int"), "_i": F.col("_i").cast("int")})

    def predict(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` with ``prediction``; unknown users or items get the biases that are known."""
        scored = self.als.transform(self._known(pairs))
        value = F.col("_base") + F.when(F.isnan("prediction"), 0.0).otherwise(F.col("prediction"))
        low, high = self.range
        return scored.withColumn("prediction", F.least(F.greatest(value, F.lit(low)), F.lit(high))).select(
            *pairs.columns, "prediction")


def item_bias_ranking(items: DataFrame, item: str, titles: DataFrame, k: int = 15) -> DataFrame:
    """The ``k`` items of highest and of lowest bias with their metadata."""
    ends = top_bottom(items, "item_bias", item, k)
    return titles.join(F.broadcast(ends), item)  # 2 k rows


def batch_score(df: DataFrame, load: Callable[[], Callable[[pd.DataFrame], Sequence[float]]], keep: Sequence[str],
                inputs: Sequence[str], out: str = "prediction") -> DataFrame:
    """``keep`` columns and the prediction of a model that each task loads once."""
    types = {f.name: f for f in df.schema.fields}
    schema = T.StructType([*[types[c] for c in keep], T.StructField(out, T.DoubleType())])
    keep, inputs = list(keep), list(inputs)

    def run(batches):
        score = load()
        for pdf in batches:
            made = pdf[keep].copy()
            made[out] = score(pdf[inputs]) if len(pdf) else []
            yield made

    return df.select(*dict.fromkeys([*keep, *inputs])).mapInPandas(run, schema)


# ---------------------------------------------------------------- text vectors and search


# Words that one task trains on; each task hands on a vector of every word it has met.
TRAIN_WORDS = 4_000_000


def text_vectors(df: DataFrame, tokens: str, size: int = 100, min_count: int = 5, rounds: int = 1, partitions: int = 8,
                 seed: int = 42):
    """Fitted word vectors, and the rows with the mean of their token vectors in ``vector``. The fit has ``partitions``
    tasks, and more if these would get more than `TRAIN_WORDS` words each."""
    words = df.agg(F.sum(F.when(F.col(tokens).isNotNull(), F.size(tokens)))).first()[0] or 0
    parts = max(partitions, -(-words // TRAIN_WORDS))
    model = Word2Vec(vectorSize=size, minCount=min_count, maxIter=rounds, numPartitions=parts, seed=seed,
                     inputCol=tokens, outputCol="_w2v").fit(df)
    return model, embed_texts(model, df)


def embed_texts(model, df: DataFrame) -> DataFrame:
    return model.transform(df).withColumn("vector", vector_to_array("_w2v")).drop("_w2v")


def semantic_search(corpus: DataFrame, texts: DataFrame, embed: Callable[[DataFrame], DataFrame], k: int,
                    id_col: str, query_id: str, meta: DataFrame) -> DataFrame:
    """Text to vector to the ``k`` nearest corpus rows to their metadata.

    ``embed`` is the user's function: a table to the same table with a ``vector`` column. It is
    applied to both sides.
    """
    hits = knn(embed(corpus), embed(texts).select(query_id, F.col("vector").alias("_q")), k, id_col, "vector",
               query_id, "_q")
    return attach_metadata(hits, meta, id_col)
