"""Metrics, error rankings and score curves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fernwick.operators.ordered import running_totals
from fernwick.session import written

# Pairs of texts whose n-grams one task counts, about.
BLEU_ROWS = 2_048


def most_by_correct(df: DataFrame, target: str, pred: str, prob: str, id_col: str, k: int = 4) -> DataFrame:
    """Per class the ``k`` right rows of highest and the ``k`` wrong rows of lowest probability.

    The rank limit is applied inside each task before the shuffle.
    """
    right = F.col(pred) == F.col(target)
    rows = df.withColumn("is_correct", right).withColumn(
        "_s", F.when(right, -F.col(prob)).otherwise(F.col(prob)))
    w = Window.partitionBy(target, "is_correct").orderBy("_s", id_col)
    return rows.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k).drop("_s")


def most_uncertain(df: DataFrame, target: str, prob: str, id_col: str, n_classes: int, k: int = 4) -> DataFrame:
    """Per class the ``k`` rows whose probability is nearest to 1 / n_classes."""
    rows = df.withColumn("_s", F.abs(F.col(prob) - 1.0 / n_classes))
    w = Window.partitionBy(target).orderBy("_s", id_col)
    return rows.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).drop("_s", "_r")


def worst_errors(df: DataFrame, target: str, pred: str, prob: str, id_col: str, k: int) -> DataFrame:
    """``k`` false positives of highest and ``k`` false negatives of lowest score, with ``kind``."""
    fp = df.filter((F.col(pred) == 1) & (F.col(target) == 0)).orderBy(F.desc(prob), id_col).limit(k)
    fn = df.filter((F.col(pred) == 0) & (F.col(target) == 1)).orderBy(F.asc(prob), id_col).limit(k)
    return fp.withColumn("kind", F.lit("false positive")).unionByName(
        fn.withColumn("kind", F.lit("false negative")))


# ---------------------------------------------------------------- metrics as aggregate columns


def accuracy(pred: str, target: str) -> Column:
    return F.avg((F.col(pred) == F.col(target)).cast("double"))


def accuracy_multi(probs: Column, targets: Column, thresh: float = 0.5) -> Column:
    """Share of right cells over all cells of the probability and target arrays."""
    hits = F.aggregate(F.zip_with(probs, targets, lambda p, y: ((p > thresh) == (y > 0)).cast("long")),
                       F.lit(0).cast("long"), lambda a, x: a + x)
    return F.sum(hits) / F.sum(F.size(probs))


def _cells(probs: Column, targets: Column, thresh: float) -> tuple[Column, Column, Column]:
    def total(f):
        return F.sum(F.aggregate(F.zip_with(probs, targets, f), F.lit(0).cast("long"), lambda a, x: a + x))

    tp = total(lambda p, y: ((p > thresh) & (y > 0)).cast("long"))
    pp = total(lambda p, y: (p > thresh).cast("long"))
    ap = total(lambda p, y: (y > 0).cast("long"))
    return tp, pp, ap


def precision(probs: Column, targets: Column, thresh: float = 0.5) -> Column:
    tp, pp, _ = _cells(probs, targets, thresh)
    return tp / pp


def recall(probs: Column, targets: Column, thresh: float = 0.5) -> Column:
    tp, _, ap = _cells(probs, targets, thresh)
    return tp / ap


def fbeta(probs: Column, targets: Column, beta: float, thresh: float = 0.5) -> Column:
    """Weighted harmonic mean of precision and recall, counted over all cells."""
    if beta <= 0:
        raise ValueError(f"beta is {beta}, but must be positive")
    p, r = precision(probs, targets, thresh), recall(probs, targets, thresh)
    return (1 + beta**2) * p * r / (beta**2 * p + r)


def f1(probs: Column, targets: Column, thresh: float = 0.5) -> Column:
    return fbeta(probs, targets, 1, thresh)


def f2_by_threshold(df: DataFrame, probs: str, targets: str, thresholds: Sequence[float]) -> DataFrame:
    """Mean over rows of the per-row F2 at each threshold: ``(threshold, f2)``.

    All thresholds are evaluated in one pass as columns; a row without true and without predicted
    labels counts 0.
    """
    p, y = F.col(probs), F.col(targets)

    def score(th: float) -> Column:
        def total(f):
            return F.aggregate(F.zip_with(p, y, f), F.lit(0.0), lambda a, x: a + x)

        tp = total(lambda a, b: ((a > th) & (b > 0)).cast("double"))
        pp = total(lambda a, b: (a > th).cast("double"))
        ap = total(lambda a, b: (b > 0).cast("double"))
        return F.avg(F.when(4 * ap + pp > 0, 5 * tp / (4 * ap + pp)).otherwise(0.0))

    row = df.agg(*[score(th).alias(f"_{i}") for i, th in enumerate(thresholds)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(float(th)).alias("threshold"), F.col(f"_{i}").alias("f2"))
        for i, th in enumerate(thresholds)])))


def best_threshold(scores: DataFrame) -> DataFrame:
    """The first threshold with the best score."""
    return scores.orderBy(F.desc("f2"), "threshold").limit(1)


def confusion_matrix(df: DataFrame, target: str, pred: str, classes: Sequence[int], normalize: bool = False
                     ) -> DataFrame:
    """Rows are true classes, columns ``pred_<class>`` counts, or shares of the row."""
    wide = df.groupBy(target).pivot(pred, list(classes)).count().na.fill(0)
    counts = [F.col(str(c)) for c in classes]
    total = sum(counts[1:], counts[0])
    return wide.select(target, *[(c / total if normalize else c).alias(f"pred_{k}")
                                 for c, k in zip(counts, classes)])


def pr_curve(df: DataFrame, prob: str, target: str) -> DataFrame:
    """``(threshold, tp, n_pred, precision, recall)`` for each distinct score.

    Rows are counted per score first; running totals over the sorted scores need no single-task
    window.
    """
    by_score = df.groupBy(F.col(prob).alias("threshold")).agg(
        F.count("*").alias("_n"), F.sum((F.col(target) > 0).cast("long")).alias("_p"))
    upto = running_totals(by_score, [F.desc("threshold")], {"n_pred": "_n", "tp": "_p"})
    positives = df.agg(F.sum((F.col(target) > 0).cast("long"))).scalar()
    return upto.select("threshold", "tp", "n_pred", (F.col("tp") / F.col("n_pred")).alias("precision"),
                       (F.col("tp") / positives).alias("recall"), (F.col("_p") / positives).alias("step"))


def average_precision(curve: DataFrame) -> DataFrame:
    """Sum of precision times the gain in recall."""
    return curve.agg(F.sum(F.col("precision") * F.col("step")).alias("average_precision"))


def recall_at_precision(curve: DataFrame, floor: float) -> DataFrame:
    """Largest recall with a precision of at least ``floor``."""
    return curve.agg(F.max(F.when(F.col("precision") >= floor, F.col("recall"))).alias("recall"))


def log_loss(prob_of_target: Column) -> Column:
    return F.avg(-F.log(prob_of_target))


def mse(pred: str, target: str) -> Column:
    d = F.col(pred) - F.col(target)
    return F.avg(d * d)


def rmse(pred: str, target: str) -> Column:
    return F.sqrt(mse(pred, target))


def r2(pred: str, target: str) -> Column:
    """1 - squared error / (n * population variance)."""
    d = F.col(pred) - F.col(target)
    return 1 - F.sum(d * d) / (F.var_pop(target) * F.count(target))


def exp_rmspe(pred: str, target: str) -> Column:
    """Root mean squared share error of log-scale predictions."""
    y = F.exp(target)
    share = (y - F.exp(pred)) / y
    return F.sqrt(F.avg(share * share))


def ensemble_mean(df: DataFrame, id_col: str, value: str, plain: Column | None = None, n_aug: int = 0) -> DataFrame:
    """Mean prediction per id over models, folds or augmentations.

    With ``n_aug`` augmented predictions the plain one (where ``plain`` holds) counts
    ceil(n_aug / 4) times.
    """
    weight = F.lit(1) if plain is None else F.when(plain, -(-n_aug // 4)).otherwise(1)
    rows = df.withColumn("_w", weight)
    return rows.groupBy(id_col).agg((F.sum(F.col(value) * F.col("_w")) / F.sum("_w")).alias(value))


def corpus_bleu(df: DataFrame, ref: str, hyp: str, id_col: str, max_n: int = 4) -> DataFrame:
    """One row: corpus BLEU with clipped n-gram matches, uniform weights and brevity penalty.

    ``ref`` and ``hyp`` are token arrays, one pair per row. N-grams are counted per pair on both
    sides in one grouping, whose groups are single n-grams of a single pair. Pairs are dealt by id to
    parts of about ``BLEU_ROWS``, so the n-grams that a task holds do not grow with the table.
    """
    from fernwick.functions.text import ngrams

    def tagged(col: str, n: int) -> Column:
        return F.transform(ngrams(F.col(col), n), lambda g: F.struct(F.lit(n).alias("n"), g.alias("g")))

    df = written(df.select(id_col, ref, hyp), "pairs")
    dealt = df.repartition(max(1, -(-df.count() // BLEU_ROWS)), id_col)
    sides = F.explode(F.array(F.struct(F.lit(0).alias("_h"), F.col(ref).alias("w")), F.struct(F.lit(1).alias("_h"), F.col(hyp).alias("w")))).alias("_side")
    each = F.flatten(F.array(*[tagged("w", n) for n in range(1, max_n + 1)]))
    grams = dealt.select(id_col, sides).select(id_col, "_side.*").select(id_col, "_h", F.inline(each))
    counted = grams.groupBy(id_col, "n", "g").agg(F.sum(1 - F.col("_h")).alias("_r"), F.sum("_h").alias("_h"))
    per_n = counted.groupBy("n").agg(F.sum(F.least("_r", "_h")).alias("hit"), F.sum("_h").alias("total"))
    lengths = df.agg(F.struct(F.sum(F.size(ref)).alias("r"), F.sum(F.size(hyp)).alias("h"))).scalar()
    log_p = F.sum(F.log(F.col("hit") / F.col("total"))) / max_n
    full = (F.count("*") == max_n) & (F.min("hit") > 0)
    brevity = F.when(F.col("h") > F.col("r"), 1.0).otherwise(F.exp(1 - F.col("r") / F.col("h")))
    return per_n.agg(log_p.alias("lp"), full.alias("ok")).select(
        "lp", "ok", lengths["r"].alias("r"), lengths["h"].alias("h")).select(
        F.when(F.col("ok"), brevity * F.exp("lp")).otherwise(0.0).alias("bleu"))


def evaluate(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """One row of user metrics, given as aggregate expressions on prediction and target."""
    return df.agg(*[c.alias(n) for n, c in metrics.items()])
