"""Spark ML models, their inspection, ratings and search."""

from pyspark.sql import functions as F

from fernwick.functions.text import words
from fernwick.operators import models as M
from fernwick.operators import sampling as S
from fernwick.plans.catalog.registry import query
from fernwick.plans.catalog.relational import _RATINGS, ratings
from fernwick.session import cut_lineage, written

_COLS = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "flag"]


def sales(t):
    """Numeric features, the price on a log scale, and a train / valid flag by ship date."""
    flag = F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0)
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", flag.alias("flag"),
                             F.log("l_extendedprice").alias("y"), "l_shipdate")
    return S.date_range_split(rows, "l_shipdate", "2000-01-01", "2100-01-01")


def _sides(t):
    rows = sales(t)
    return rows.filter("split = 'train'"), rows.filter("split = 'valid'")


@query("random_forest")
def _(t):
    train, valid = _sides(t)
    model = M.random_forest(train, _COLS, "y", trees=10, min_leaf=3, max_features=0.5, subsample=0.5)
    scored = model.transform(M.features_column(valid, _COLS))
    return scored.select("l_orderkey", "l_partkey", "y", "prediction")


@query("feature_importance")
def _(t):
    model = M.random_forest(sales(t), _COLS, "y", trees=10)
    return M.feature_importance(t.spark, model, _COLS, keep=0.005)


@query("tree_spread")
def _(t):
    train, valid = _sides(t)
    model = M.random_forest(train, _COLS, "y", trees=10, max_depth=5)
    rows = M.tree_spread(model, valid, _COLS)
    return rows.groupBy("flag").agg(F.avg("pred").alias("pred"), F.avg("pred_std").alias("pred_std"), F.avg("y").alias("y"))


@query("drop_column_ablation")
def _(t):
    # Only what the fits read is kept in memory.
    train, valid = (side.select(*_COLS, "y") for side in _sides(t))
    return M.drop_column_ablation(train, valid, _COLS, "y", trees=5, max_depth=5)


_RANKED = ["l_quantity", "l_extendedprice", "l_discount"]


@query("spearman_matrix", "WITH r AS (SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2 AS {c}" for c in _RANKED) + " FROM lineitem) "
    + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 4) AS rho FROM r" for a in _RANKED for b in _RANKED))
def _(t):
    return M.spearman_matrix(t.lineitem, _RANKED)


@query("partial_dependence")
def _(t):
    model = M.random_forest(sales(t), _COLS, "y", trees=5, max_depth=5)
    return M.partial_dependence(model, sales(t), _COLS, {"l_quantity": [1, 10, 20, 30, 40, 50]})


@query("partial_dependence_pair")
def _(t):
    model = M.random_forest(sales(t), _COLS, "y", trees=5, max_depth=5)
    return M.partial_dependence(model, sales(t), _COLS, {"l_quantity": [1, 25, 50], "flag": [0, 1, 2]})


# Two features: their weights follow from variances and covariances.
_TWO = """
    rows AS (SELECT l_quantity AS a, l_discount AS b, ln(l_extendedprice) AS y, l_shipdate BETWEEN '2000-01-01' AND '2100-01-01' AS late FROM lineitem)"""


def _two_weights(where):
    return f"""SELECT avg(a) AS ma, avg(b) AS mb, avg(y) AS my,
      (covar_pop(a, y) * var_pop(b) - covar_pop(b, y) * covar_pop(a, b)) / (var_pop(a) * var_pop(b) - covar_pop(a, b) ** 2) AS wa,
      (covar_pop(b, y) * var_pop(a) - covar_pop(a, y) * covar_pop(a, b)) / (var_pop(a) * var_pop(b) - covar_pop(a, b) ** 2) AS wb FROM rows {where}"""


@query("partial_dependence_linear", f"""
    WITH {_TWO}, w AS ({_two_weights('')})
    SELECT a::DOUBLE AS l_quantity, b::DOUBLE AS l_discount, round(my + wa * (a - ma) + wb * (b - mb), 6) AS prediction FROM w, (VALUES (1), (25), (50)) x(a), (VALUES (0.0), (0.1)) z(b)
    UNION ALL SELECT a::DOUBLE, NULL, round(my + wa * (a - ma), 6) FROM w, (VALUES (1), (25), (50)) x(a)""")
def _(t):
    cols = ["l_quantity", "l_discount"]
    model = M.linear_regression(sales(t).select(*cols, "y"), cols, "y")
    pair = M.partial_dependence(model, sales(t), cols, {"l_quantity": [1, 25, 50], "l_discount": [0.0, 0.1]})
    one = M.partial_dependence(model, sales(t), cols, {"l_quantity": [1, 25, 50]})
    out = pair.unionByName(one, allowMissingColumns=True)
    return out.select("l_quantity", "l_discount", F.round("prediction", 6).alias("prediction"))


@query("drop_column_linear", f"""
    WITH {_TWO}, w AS ({_two_weights('WHERE NOT late')}),
    o AS (SELECT regr_slope(y, a) AS sa, regr_intercept(y, a) AS ia, regr_slope(y, b) AS sb, regr_intercept(y, b) AS ib FROM rows WHERE NOT late)
    SELECT '' AS dropped, round(sqrt(avg((y - my - wa * (a - ma) - wb * (b - mb)) ** 2)), 6) AS rmse FROM rows, w WHERE late
    UNION ALL SELECT 'l_quantity', round(sqrt(avg((y - ib - sb * b) ** 2)), 6) FROM rows, o WHERE late
    UNION ALL SELECT 'l_discount', round(sqrt(avg((y - ia - sa * a) ** 2)), 6) FROM rows, o WHERE late""")
def _(t):
    train, valid = _sides(t)
    out = M.drop_column_ablation(train, valid, ["l_quantity", "l_discount"], "y", fit=M.linear_regression)
    return out.withColumn("rmse", F.round("rmse", 6))


@query("feature_importance_total", "SELECT 1.0::DOUBLE AS total, 5 AS features, 'l_quantity' AS first")
def _(t):
    """Importances of all features add up to 1; the price follows the quantity most."""
    found = M.feature_importance(t.spark, M.random_forest(sales(t), _COLS, "y", trees=10), _COLS, keep=-1.0)
    return found.agg(F.round(F.sum("imp"), 6).alias("total"), F.count("*").cast("int").alias("features"), F.max_by("cols", "imp").alias("first"))


@query("tree_spread_mean", """
    SELECT l_orderkey, l_partkey, l_linenumber, true AS mean_is_prediction, true AS spread_is_plain FROM lineitem WHERE l_shipdate BETWEEN '2000-01-01' AND '2100-01-01'""")
def _(t):
    """The mean over the trees is what the forest predicts, and no spread is negative."""
    train, valid = _sides(t)
    model = M.random_forest(train, _COLS, "y", trees=10, max_depth=5)
    rows = model.transform(M.features_column(M.tree_spread(model, valid, _COLS), _COLS))
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", (F.abs(F.col("pred") - F.col("prediction")) < 1e-9).alias("mean_is_prediction"),
                       (F.col("pred_std") >= 0).alias("spread_is_plain"))


@query("adversarial_first", "SELECT 'days' AS cols")
def _(t):
    """The column that tells the sides apart, which were cut by it, comes first."""
    train, valid = _sides(t)
    days = F.datediff("l_shipdate", F.lit("1990-01-01").cast("date")).cast("double")
    _, drift = M.adversarial_validation(train.withColumn("days", days), valid.withColumn("days", days), [*_COLS, "days"], trees=5, max_depth=5)
    return drift.agg(F.max_by("cols", "imp").alias("cols"))


@query("adversarial_validation")
def _(t):
    train, valid = _sides(t)
    days = F.datediff("l_shipdate", F.lit("1990-01-01").cast("date")).cast("double")
    _, drift = M.adversarial_validation(train.withColumn("days", days), valid.withColumn("days", days), [*_COLS, "days"], trees=5, max_depth=5)
    return drift


@query("linear_regression", """
    SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem""")
def _(t):
    model = M.linear_regression(t.lineitem.select("l_quantity", "l_extendedprice"), ["l_quantity"], "l_extendedprice")
    return t.spark.createDataFrame([(round(float(model.coefficients[0]), 4), round(float(model.intercept), 4))], "slope double, intercept double")


@query("lasso_cv")
def _(t):
    revenue = F.exp("y") * (1 - F.col("l_discount")) / 1000
    model = M.lasso_cv(sales(t).select(*_COLS, revenue.alias("revenue")), _COLS, "revenue", [0.001, 0.01, 0.1])
    return M.strong_coefficients(t.spark, model, _COLS)


_BIAS = f"""{_RATINGS}, g AS (SELECT avg(rating) AS mu FROM ratings),
    u AS (SELECT user_id, avg(rating) - (SELECT mu FROM g) AS user_bias FROM ratings GROUP BY 1),
    i AS (SELECT item_id, avg(rating - (SELECT mu FROM g) - user_bias) AS item_bias FROM ratings JOIN u USING (user_id) GROUP BY 1)"""


@query("user_biases", f"WITH {_BIAS} SELECT user_id, round(user_bias, 9) AS user_bias FROM u")
def _(t):
    return M.rating_biases(ratings(t), "user_id", "item_id", "rating")[1].withColumn("user_bias", F.round("user_bias", 9))


@query("item_biases", f"WITH {_BIAS} SELECT item_id, round(item_bias, 9) AS item_bias FROM i")
def _(t):
    return M.rating_biases(ratings(t), "user_id", "item_id", "rating")[2].withColumn("item_bias", F.round("item_bias", 9))


@query("item_bias_ranking", f"""
    WITH {_BIAS}, r AS (SELECT item_id, round(item_bias, 9) AS item_bias FROM i),
    e AS ((SELECT *, 'top' AS side FROM r ORDER BY item_bias DESC, item_id LIMIT 15) UNION ALL (SELECT *, 'bottom' FROM r ORDER BY item_bias, item_id LIMIT 15))
    SELECT item_id, item_bias, side, p_name FROM e JOIN part ON p_partkey = item_id""")
def _(t):
    items = M.rating_biases(ratings(t), "user_id", "item_id", "rating")[2].withColumn("item_bias", F.round("item_bias", 9))
    titles = t.part.select(F.col("p_partkey").alias("item_id"), "p_name")
    return M.item_bias_ranking(items, "item_id", titles).select("item_id", "item_bias", "side", "p_name")


@query("collab_filter")
def _(t):
    # Stored, since the model reads its ratings several times.
    rows = ratings(t).select("user_id", "item_id", "rating", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_id"))
    rows = written(rows, "ratings")
    model = M.CollabModel(rows, "user_id", "item_id", "rating", "row_id", factors=10, rounds=3)
    return model.predict(rows.select("user_id", "item_id", "rating"))


def _load_scorer():
    weights = {"l_quantity": 0.5, "l_tax": 2.0}

    def score(pdf):
        return sum(pdf[c] * w for c, w in weights.items())

    return score


@query("batch_score", "SELECT l_orderkey, l_partkey, round(l_quantity * 0.5 + l_tax * 2.0, 6) AS prediction FROM lineitem")
def _(t):
    out = M.batch_score(t.lineitem, _load_scorer, ["l_orderkey", "l_partkey"], ["l_quantity", "l_tax"])
    return out.withColumn("prediction", F.round("prediction", 6))


def _docs(t):
    """Tokens, read by the fit and by the transform."""
    return cut_lineage(t.documents.select("doc_id", words("text").alias("w")))


@query("text_embeddings")
def _(t):
    _, rows = M.text_vectors(_docs(t), "w", size=32, min_count=5)
    return rows.select("doc_id", F.size("vector").alias("dims"), F.array_join(F.transform("vector", lambda x: F.round(x, 6).cast("string")), " ").alias("vector"))


@query("semantic_search")
def _(t):
    docs = _docs(t)
    model, _ = M.text_vectors(docs, "w", size=32, min_count=5)
    texts = t.benchmark.select("item_id", words("text").alias("w"))
    meta = t.documents.select("doc_id", "source", "lang")
    return M.semantic_search(docs, texts, lambda df: M.embed_texts(model, df), 5, "doc_id", "item_id", meta)


_SHAPE = r"[len(text) + 0.0::DOUBLE, len(list_filter(string_split(text, ' '), lambda w: w <> '')) * 5, len(string_split(text, chr(10))) * 40]"


@query("semantic_search_user_function", f"""
    WITH q AS (SELECT item_id, {_SHAPE} AS q FROM benchmark), d AS (SELECT doc_id, lang, {_SHAPE} AS v FROM documents),
    h AS (SELECT item_id, doc_id, lang, round(1 - list_dot_product(q, v) / sqrt(list_dot_product(q, q)) / sqrt(list_dot_product(v, v)), 9) AS distance FROM q, d)
    SELECT item_id, doc_id, lang, round(distance, 6) AS distance, CAST(row_number() OVER (PARTITION BY item_id ORDER BY h.distance, doc_id) AS INTEGER) AS place
    FROM h QUALIFY place <= 3""")
def _(t):
    def shape(df):
        blanks = F.size(F.filter(F.split("text", " "), lambda w: w != ""))
        return df.withColumn("vector", F.array(F.length("text").cast("double"), blanks.cast("double") * 5,
                                               F.size(F.split("text", "\n")).cast("double") * 40))

    out = M.semantic_search(t.documents.select("doc_id", "text"), t.benchmark.select("item_id", "text"), shape, 3, "doc_id", "item_id",
                            t.documents.select("doc_id", "lang"))
    return out.select("item_id", "doc_id", "lang", F.round("distance", 6).alias("distance"), "place")
