"""Metrics on predictions derived from hashed ids."""

from pyspark.sql import functions as F

from fernwick.functions.text import words
from fernwick.operators import evaluate as M
from fernwick.operators import sampling as S
from fernwick.plans.catalog.ordered import PRED, predictions
from fernwick.plans.catalog.registry import query
from fernwick.plans.catalog.relational import WORDS

_HASH = "(CAST('0x' || substr(md5('{s}|' || doc_id), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE)"
_P2 = f"c AS (SELECT doc_id, unnest([{_HASH.format(s='p')}, {_HASH.format(s='q')}]) AS p, unnest([quality, toxic]) AS y FROM labels)"


def cells(t):
    """Two probabilities and two 0/1 targets per document."""
    p = F.array(S.hash_fraction("doc_id", "p"), S.hash_fraction("doc_id", "q"))
    return t.labels.select("doc_id", p.alias("p"), F.array("quality", "toxic").alias("y"))


@query("accuracy", f"WITH {PRED} SELECT round(avg(CASE WHEN pred = y THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM pr")
def _(t):
    return predictions(t).agg(F.round(M.accuracy("pred", "y"), 9).alias("accuracy"))


@query("accuracy_multi", f"WITH {_P2} SELECT round(avg(CASE WHEN (p > 0.4) = (y > 0) THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM c")
def _(t):
    return cells(t).agg(F.round(M.accuracy_multi(F.col("p"), F.col("y"), 0.4), 9).alias("accuracy"))


@query("precision_recall_fbeta", f"""
    WITH {_P2}, s AS (SELECT CAST(count(*) FILTER (p > 0.5 AND y > 0) AS DOUBLE) AS tp, count(*) FILTER (p > 0.5) AS pp, count(*) FILTER (y > 0) AS ap FROM c),
    v AS (SELECT tp / pp AS p, tp / ap AS r FROM s)
    SELECT round(p, 9) AS "precision", round(r, 9) AS recall, round(5 * p * r / (4 * p + r), 9) AS f2, round(2 * p * r / (p + r), 9) AS f1 FROM v""")
def _(t):
    p, y = F.col("p"), F.col("y")
    return cells(t).agg(F.round(M.precision(p, y), 9).alias("precision"), F.round(M.recall(p, y), 9).alias("recall"),
                        F.round(M.fbeta(p, y, 2), 9).alias("f2"), F.round(M.f1(p, y), 9).alias("f1"))


_TH = [round(0.17 + 0.01 * i, 2) for i in range(7)]
_F2 = f"""{_P2}, th AS (SELECT unnest({_TH}::DOUBLE[]) AS threshold),
    s AS (SELECT threshold, doc_id, CAST(count(*) FILTER (p > threshold AND y > 0) AS DOUBLE) AS tp, count(*) FILTER (p > threshold) AS pp, count(*) FILTER (y > 0) AS ap FROM c, th GROUP BY ALL),
    f AS (SELECT threshold, avg(CASE WHEN 4 * ap + pp > 0 THEN 5 * tp / (4 * ap + pp) ELSE 0 END) AS f2 FROM s GROUP BY 1)"""


@query("f2_by_threshold", f"WITH {_F2} SELECT threshold, round(f2, 9) AS f2 FROM f")
def _(t):
    return M.f2_by_threshold(cells(t), "p", "y", _TH).withColumn("f2", F.round("f2", 9))


@query("best_threshold", f"WITH {_F2} SELECT threshold, round(f2, 9) AS f2 FROM f ORDER BY round(f.f2, 9) DESC, threshold LIMIT 1")
def _(t):
    return M.best_threshold(M.f2_by_threshold(cells(t), "p", "y", _TH).withColumn("f2", F.round("f2", 9)))


@query("confusion_matrix", f"""
    WITH {PRED} SELECT y, count(*) FILTER (pred = 0) AS pred_0, count(*) FILTER (pred = 1) AS pred_1 FROM pr GROUP BY 1""")
def _(t):
    return M.confusion_matrix(predictions(t), "y", "pred", [0, 1])


@query("confusion_matrix_normalized", f"""
    WITH {PRED} SELECT y, round(count(*) FILTER (pred = 0) / count(*), 9) AS pred_0, round(count(*) FILTER (pred = 1) / count(*), 9) AS pred_1 FROM pr GROUP BY 1""")
def _(t):
    out = M.confusion_matrix(predictions(t), "y", "pred", [0, 1], normalize=True)
    return out.select("y", F.round("pred_0", 9).alias("pred_0"), F.round("pred_1", 9).alias("pred_1"))


_CURVE = f"""{PRED}, b AS (SELECT p AS threshold, count(*) AS n, sum(y) AS pos FROM pr GROUP BY 1),
    k AS (SELECT threshold, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER w AS BIGINT) AS n_pred, pos / sum(pos) OVER () AS step,
          sum(pos) OVER () AS all_pos FROM b WINDOW w AS (ORDER BY threshold DESC)),
    curve AS (SELECT threshold, tp, n_pred, tp / n_pred AS "precision", tp / all_pos AS recall, step FROM k)"""


@query("pr_curve", f'WITH {_CURVE} SELECT round(threshold, 9) AS threshold, tp, n_pred, round("precision", 9) AS "precision", round(recall, 9) AS recall FROM curve')
def _(t):
    out = M.pr_curve(predictions(t), "p", "y")
    return out.select(F.round("threshold", 9).alias("threshold"), "tp", "n_pred", F.round("precision", 9).alias("precision"),
                      F.round("recall", 9).alias("recall"))


@query("average_precision", f'WITH {_CURVE} SELECT round(sum("precision" * step), 9) AS average_precision FROM curve')
def _(t):
    out = M.average_precision(M.pr_curve(predictions(t), "p", "y"))
    return out.select(F.round("average_precision", 9).alias("average_precision"))


@query("recall_at_precision", f'WITH {_CURVE} SELECT round(max(recall) FILTER ("precision" >= 0.6), 9) AS recall FROM curve')
def _(t):
    out = M.recall_at_precision(M.pr_curve(predictions(t), "p", "y"), 0.6)
    return out.select(F.round("recall", 9).alias("recall"))


@query("log_loss", f"WITH {PRED} SELECT round(avg(-ln(CASE WHEN y = 1 THEN p ELSE 1 - p END)), 9) AS log_loss FROM pr")
def _(t):
    return predictions(t).agg(F.round(M.log_loss(F.expr("CASE WHEN y = 1 THEN p ELSE 1 - p END")), 9).alias("log_loss"))


_REG = """r AS (SELECT o_totalprice / 1000 AS y, o_totalprice / 1000 * 0.8 + 40 * (CAST('0x' || substr(md5('e|' || o_orderkey), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE) AS pred FROM orders)"""


def regression(t):
    y = F.col("o_totalprice") / 1000
    return t.orders.select(y.alias("y"), (y * 0.8 + 40 * S.hash_fraction("o_orderkey", "e")).alias("pred"))


@query("rmse", f"WITH {_REG} SELECT round(sqrt(avg((pred - y) ** 2)), 6) AS rmse, round(avg((pred - y) ** 2), 6) AS mse, round(1 - sum((pred - y) ** 2) / (var_pop(y) * count(y)), 6) AS r2 FROM r")
def _(t):
    return regression(t).agg(F.round(M.rmse("pred", "y"), 6).alias("rmse"), F.round(M.mse("pred", "y"), 6).alias("mse"),
                             F.round(M.r2("pred", "y"), 6).alias("r2"))


@query("exp_rmspe", f"WITH {_REG} SELECT round(sqrt(avg(((exp(ln(y)) - exp(ln(pred))) / exp(ln(y))) ** 2)), 6) AS exp_rmspe FROM r")
def _(t):
    logs = regression(t).select(F.log("y").alias("y"), F.log("pred").alias("pred"))
    return logs.agg(F.round(M.exp_rmspe("pred", "y"), 6).alias("exp_rmspe"))


@query("user_metrics", f"WITH {_REG} SELECT round(max(abs(pred - y)), 6) AS worst, round(avg(abs(pred - y)), 6) AS mae FROM r")
def _(t):
    mine = {"worst": F.max(F.abs(F.col("pred") - F.col("y"))), "mae": F.avg(F.abs(F.col("pred") - F.col("y")))}
    return M.evaluate(regression(t), mine).select(*[F.round(c, 6).alias(c) for c in mine])


_SAID = rf"""s AS (SELECT conv_id, turn, role, {WORDS} AS w FROM conversations),
    pr AS (SELECT row_number() OVER (ORDER BY a.conv_id, a.turn) AS id, a.w AS r, b.w AS h FROM s a JOIN s b ON a.conv_id = b.conv_id AND b.turn = a.turn + 2)"""


@query("corpus_bleu", rf"""
    WITH {_SAID}, k AS (SELECT unnest(range(1, 5)) AS n),
    g AS (SELECT id, n, 0 AS side, array_to_string(r[i:i + n - 1], ' ') AS g FROM (SELECT id, r, n, unnest(range(1, len(r) - n + 2)) AS i FROM pr, k)
          UNION ALL SELECT id, n, 1, array_to_string(h[i:i + n - 1], ' ') FROM (SELECT id, h, n, unnest(range(1, len(h) - n + 2)) AS i FROM pr, k)),
    c AS (SELECT id, n, g, count(*) FILTER (side = 0) AS cr, count(*) FILTER (side = 1) AS ch FROM g GROUP BY ALL),
    p AS (SELECT n, CAST(sum(least(cr, ch)) AS DOUBLE) AS hit, sum(ch) AS total FROM c GROUP BY 1),
    l AS (SELECT CAST(sum(len(r)) AS DOUBLE) AS lr, CAST(sum(len(h)) AS DOUBLE) AS lh FROM pr)
    SELECT round(CASE WHEN (SELECT count(*) FROM p WHERE hit > 0) < 4 THEN 0 ELSE (CASE WHEN lh > lr THEN 1 ELSE exp(1 - lr / lh) END)
        * exp((SELECT sum(ln(CASE WHEN hit > 0 THEN hit ELSE 1 END / total)) / 4 FROM p)) END, 9)::DOUBLE AS bleu FROM l""")
def _(t):
    said = t.conversations.select("conv_id", "turn", words("text").alias("w"))
    later = said.select("conv_id", (F.col("turn") - 2).alias("turn"), F.col("w").alias("h"))
    pairs = said.join(later, ["conv_id", "turn"]).select(F.struct("conv_id", "turn").alias("id"), F.col("w").alias("r"), "h")
    return M.corpus_bleu(pairs, "r", "h", "id").withColumn("bleu", F.round("bleu", 9))


_FOLDS = " UNION ALL ".join(f"SELECT doc_id, {i} AS fold, {_HASH.format(s=f'f{i}')} AS p FROM labels" for i in range(5))


@query("ensemble_mean", f"""
    SELECT doc_id, round(sum(p * CASE WHEN fold = 0 THEN 1 ELSE 1 END) / 5, 9) AS p FROM ({_FOLDS}) GROUP BY 1""")
def _(t):
    folds = [t.labels.select("doc_id", S.hash_fraction("doc_id", f"f{i}").alias("p")) for i in range(5)]
    from fernwick.operators.relational import union_all

    return M.ensemble_mean(union_all(folds), "doc_id", "p").withColumn("p", F.round("p", 9))


@query("augmentation_mean", f"""
    SELECT doc_id, round(sum(p * CASE WHEN fold = 0 THEN 2 ELSE 1 END) / 6, 9) AS p FROM ({_FOLDS}) GROUP BY 1""")
def _(t):
    folds = F.array(*[F.struct(F.lit(i).alias("fold"), S.hash_fraction("doc_id", f"f{i}").alias("p")) for i in range(5)])
    rows = t.labels.select("doc_id", F.inline(folds))
    # Five augmented predictions would repeat the plain one ceil(5 / 4) = 2 times.
    return M.ensemble_mean(rows, "doc_id", "p", F.col("fold") == 0, 5).withColumn("p", F.round("p", 9))
