"""Term-weight classifiers and next-token counts."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fernwick.operators.ordered import dictionary_join
from fernwick.session import bounded_broadcast, cut_lineage, written


def class_counts(terms: DataFrame, labels: DataFrame, id_col: str, y: str) -> tuple[DataFrame, Column, Column]:
    """``(term, p1, p0)`` sums per class, and the class sizes as scalar columns.

    Counts are joined to their documents' labels by the document id, then summed per term with
    partial aggregation, so frequent terms cost one row per task.
    """
    rows = terms.join(labels.select(id_col, y), id_col)
    sums = rows.groupBy("term").agg(F.sum(F.when(F.col(y) == 1, F.col("n")).otherwise(0)).alias("p1"),
                                    F.sum(F.when(F.col(y) != 1, F.col("n")).otherwise(0)).alias("p0"))
    sizes = labels.agg(F.struct(F.sum((F.col(y) == 1).cast("long")).alias("n1"),
                                F.sum((F.col(y) != 1).cast("long")).alias("n0"))).scalar()
    return sums, sizes["n1"], sizes["n0"]


def log_count_ratio(terms: DataFrame, labels: DataFrame, id_col: str = "doc_id", y: str = "y",
                    smoothing: str = "both") -> DataFrame:
    """``(term, r)``: log ratio of the smoothed class rates.

    ``both`` adds 1 to counts and class sizes; ``counts`` adds 1 to counts only; ``share`` adds 1
    and divides by the class total of all smoothed counts.
    """
    sums, n1, n0 = class_counts(terms, labels, id_col, y)
    a, b = F.col("p1") + 1, F.col("p0") + 1
    if smoothing == "both":
        r = F.log((a / (n1 + 1)) / (b / (n0 + 1)))
    elif smoothing == "counts":
        r = F.log((a / n1) / (b / n0))
    elif smoothing == "share":
        totals = sums.agg(F.struct(F.sum(a).alias("a"), F.sum(b).alias("b"))).scalar()
        r = F.log((a / totals["a"]) / (b / totals["b"]))
    else:
        raise ValueError(smoothing)
    return sums.select("term", r.alias("r"))


def one_vs_rest_ratios(terms: DataFrame, labels: DataFrame, classes: int, id_col: str = "doc_id", y: str = "y"
                       ) -> DataFrame:
    """``(term, class, r)``: log-count ratio of each class against the others on 0/1 counts."""
    rows = terms.join(labels.select(id_col, y), id_col)
    sums = rows.groupBy("term").agg(F.sum(F.signum("n")).alias("_all"), *[
        F.sum(F.when(F.col(y) == k, F.signum("n")).otherwise(0)).alias(f"_p{k}") for k in range(classes)])
    sizes = labels.agg(F.struct(F.count("*").alias("all"), *[
        F.sum((F.col(y) == k).cast("long")).alias(f"n{k}") for k in range(classes)])).scalar()

    def ratio(k: int) -> Column:
        mine, rest = F.col(f"_p{k}") + 1, F.col("_all") - F.col(f"_p{k}") + 1
        return F.log((mine / sizes[f"n{k}"]) / (rest / (sizes["all"] - sizes[f"n{k}"])))

    return sums.select("term", F.inline(F.array(*[
        F.struct(F.lit(k).alias("class"), ratio(k).alias("r")) for k in range(classes)])))


def class_prior(labels: DataFrame, y: str = "y") -> Column:
    """log(n1 / n0) as a scalar column."""
    return labels.agg(F.log(F.sum((F.col(y) == 1).cast("long")) / F.sum((F.col(y) == 0).cast("long")))).scalar()


def naive_bayes_predict(terms: DataFrame, ratios: DataFrame, prior: Column | float, docs: DataFrame,
                        id_col: str = "doc_id") -> DataFrame:
    """``(id, score, pred)`` for every row of ``docs``: sum of n * r plus the prior, above 0."""
    prior = prior if isinstance(prior, Column) else F.lit(float(prior))
    scored = dictionary_join(terms, ratios, "term").groupBy(id_col).agg(F.sum(F.col("n") * F.col("r")).alias("_s"))
    score = F.coalesce("_s", F.lit(0.0)) + prior
    return docs.select(id_col).join(scored, id_col, "left").select(
        id_col, score.alias("score"), (score > 0).cast("int").alias("pred"))


def nb_softmax(terms: DataFrame, ratios: DataFrame, classes: int, id_col: str = "doc_id",
               weights: DataFrame | None = None, w_adj: float = 0.4, r_adj: float = 10.0) -> DataFrame:
    """Class shares per document: softmax over classes of the sum of ``(w + w_adj) * r / r_adj``.

    ``ratios`` is ``(term, class, r)`` and ``weights`` is ``(term, w)``, 0 where absent.
    """
    wide = ratios.groupBy("term").agg(*[
        F.sum(F.when(F.col("class") == k, F.col("r"))).alias(f"r{k}") for k in range(classes)])
    if weights is not None:
        wide = wide.join(weights, "term", "left")
        w = F.coalesce("w", F.lit(0.0))
    else:
        w = F.lit(0.0)
    factor = (w + w_adj) / r_adj
    wide = wide.select("term", *[(factor * F.col(f"r{k}")).alias(f"r{k}") for k in range(classes)])
    sums = dictionary_join(terms, wide, "term").groupBy(id_col).agg(*[F.sum(f"r{k}").alias(f"x{k}") for k in range(classes)])
    top = F.greatest(*[F.col(f"x{k}") for k in range(classes)]) if classes > 1 else F.col("x0")
    exps = [F.exp(F.col(f"x{k}") - top) for k in range(classes)]
    total = sum(exps[1:], exps[0])
    return sums.select(id_col, *[(e / total).alias(f"p{k}") for k, e in enumerate(exps)])


def term_features(df: DataFrame, grams: str, max_features: int, binary: bool = True) -> tuple[CountVectorizerModel, DataFrame]:
    """Sparse ``features`` of the ``max_features`` most frequent terms."""
    model = CountVectorizer(inputCol=grams, outputCol="features", vocabSize=max_features, binary=binary).fit(df)
    return model, model.transform(df)


def logistic_regression(df: DataFrame, label: str, C: float = 0.1, max_iter: int = 50, features: str = "features"):
    """Ridge-penalized logistic regression; ``C`` is the inverse penalty of the summed loss."""
    n = df.count()
    return LogisticRegression(featuresCol=features, labelCol=label, regParam=1.0 / (C * n), elasticNetParam=0.0,
                              maxIter=max_iter, standardization=False).fit(df)


def interpolate_weights(weights: DataFrame, beta: float = 0.25, w: str = "w") -> DataFrame:
    """``(1 - beta) * mean(w) + beta * w``."""
    mean = weights.agg(F.avg(w)).scalar()
    return weights.withColumn(w, (1 - beta) * mean + beta * F.col(w))


# ---------------------------------------------------------------- next tokens

# Tokens of the rows that are counted together: some 20 MB of numbers. A longer row is counted alone.
COUNTED_TOKENS = 1 << 18


def context_counts(df: DataFrame, tokens: str, width: int = 2) -> DataFrame:
    """``(context, next, n)`` counts of each run of ``width`` tokens and the token after it. Null tokens are left out of a
    context, but not of its length.

    Rows of some `COUNTED_TOKENS` together are counted by the numbers of their tokens, so that strings are made once for
    each run that differs from the others there; then the counts are added up.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < len(ends):
                begin = ends[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(ends, begin + COUNTED_TOKENS, "right")))
                flat, last = lists.slice(at, end - at).flatten(), ends[at:end] - begin
                at = end
                # The last ``width`` tokens of a row begin no run.
                starts = np.flatnonzero(np.repeat(last, np.diff(last, prepend=0)) - np.arange(len(flat)) > width)
                if not len(starts):
                    continue
                codes = flat.dictionary_encode(null_encoding="encode").indices.to_numpy().astype(np.int64)
                kinds = span = int(codes.max()) + 1
                key = codes[starts]
                for k in range(1, width + 1):
                    if span * kinds >= 1 << 63:  # runs so far are numbered anew
                        key, span = np.unique(key, return_inverse=True)[1], len(starts)
                    key, span = key * kinds + codes[starts + k], span * kinds
                _, first, n = np.unique(key, return_index=True, return_counts=True)
                *parts, after = [flat.take(pa.array(starts[first] + k)) for k in range(width + 1)]
                # Arrow's join drops a row of nulls alone.
                parts[0] = pc.if_else(reduce(pc.and_, map(pc.is_null, parts)), "", parts[0])
                yield pa.RecordBatch.from_arrays(
                    [pc.binary_join_element_wise(*parts, " ", null_handling="skip"), after, pa.array(n, pa.int64())], names=["context", "next", "n"])

    kind = df.select(tokens).schema[0].dataType.elementType
    rows = df.select(F.col(tokens).cast("array<string>")).mapInArrow(run, "context string, next string, n long")
    return rows.groupBy("context", F.col("next").cast(kind).alias("next")).agg(F.sum("n").alias("n"))


def next_tokens(counts: DataFrame, unk: str | None = None, k: int = 1) -> DataFrame:
    """The ``k`` most frequent next tokens per context; ``unk`` is passed over."""
    rows = counts if unk is None else counts.filter(F.col("next") != unk)
    w = Window.partitionBy("context").orderBy(F.desc("n"), "next")
    return rows.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k)


def continue_text(seeds: DataFrame, best: DataFrame, tokens: str, width: int, steps: int, stop: str = "<eos>"
                  ) -> DataFrame:
    """Greedy continuation: append the best next token ``steps`` times, up to ``stop``.

    ``best`` has one row per context, so every step is one lookup join. It is made once and stored, and a step looks up
    the contexts it asks for: while these are few they go to the stored rows, which are not shuffled.
    """
    lookup = written(best.select("context", F.col("next").alias("_next")), "next-tokens")
    out = seeds
    for step in range(steps):
        ctx = F.array_join(F.slice(tokens, F.greatest(F.size(tokens) - width + 1, F.lit(1)), F.lit(width)), " ")
        done = F.element_at(tokens, -1) == stop
        out = out.withColumn("context", ctx)
        # Each step reads the one before twice.
        out = cut_lineage(out) if step else out
        asked = out.select("context").filter(F.col("context").isNotNull()).distinct()
        found = lookup.join(bounded_broadcast(asked), "context", "left_semi")
        out = out.join(found, "context", "left").withColumn(
            tokens, F.when(done | F.col("_next").isNull(), F.col(tokens)).otherwise(
                F.concat(tokens, F.array("_next")))).drop("context", "_next")
    return out


def perplexity(counts: DataFrame) -> DataFrame:
    """One row: exp of the mean cross entropy of the add-one smoothed next-token counts.

    The sum of ``-n log((n + 1) / (c + v))`` over all pairs is one over contexts of ``c log(c + v)`` less one
    over pairs of ``n log(n + 1)``, so counts and context sizes are never joined. Each pair is read once and counts for its
    context and for its next token; what is stored is how many contexts have each size ``c``, and how many next tokens
    there are (``v``). ``T`` tokens have some ``sqrt(2 T)`` different sizes at most.
    """
    n, none = F.col("n"), F.lit(0).cast(counts.schema["n"].dataType)

    def end(key: str, first: bool, size: Column, own: Column) -> Column:
        return F.struct(F.lit(first).alias("_first"), F.col(key).cast("string").alias("_key"), size.alias("_n"), own.alias("_own"))

    ends = counts.select(F.inline(F.array(end("context", True, n, n * F.log(n + 1)), end("next", False, none, F.lit(0.0)))))
    keys = ends.groupBy("_first", "_key").agg(F.sum("_n").alias("_c"), F.sum("_own").alias("_own"))
    sizes = cut_lineage(keys.groupBy("_first", "_c").agg(F.count("*").alias("_keys"), F.sum("_own").alias("_own")))
    vocab = sizes.filter(~F.col("_first")).agg(F.sum("_keys")).scalar()
    whole = F.col("_c") * F.col("_keys")
    loss = F.sum(whole * F.log(F.col("_c") + vocab) - F.col("_own")) / F.sum(whole)
    return sizes.filter("_first").agg(F.exp(loss).alias("perplexity"))
