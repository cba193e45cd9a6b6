"""Expressions on array vectors. Vectors of different length give null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + v)


def _paired(a: Column, b: Column, f) -> Column:
    terms = F.zip_with(a, b, lambda x, y: f(x.cast("double"), y.cast("double")))
    return F.when(F.size(a) == F.size(b), _sum(terms))


def dot(a: Column, b: Column) -> Column:
    return _paired(a, b, lambda x, y: x * y)


def norm(a: Column) -> Column:
    return F.sqrt(_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def cosine_distance(a: Column, b: Column) -> Column:
    return 1 - dot(a, b) / (norm(a) * norm(b))


def squared_euclidean(a: Column, b: Column) -> Column:
    return _paired(a, b, lambda x, y: (x - y) * (x - y))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(squared_euclidean(a, b))


def _centred(a: Column) -> Column:
    mean = _sum(F.transform(a, lambda x: x.cast("double"))) / F.size(a)
    return F.transform(a, lambda x: x.cast("double") - mean)


def vector_corr(a: Column, b: Column) -> Column:
    """Pearson correlation of two vectors."""
    x, y = _centred(a), _centred(b)
    return dot(x, y) / (norm(x) * norm(y))


def vector_mean(*vectors: Column) -> Column:
    """Element-wise mean of several vectors."""
    total = vectors[0]
    for v in vectors[1:]:
        total = F.zip_with(total, v, lambda x, y: x.cast("double") + y.cast("double"))
    return F.transform(total, lambda x: x.cast("double") / len(vectors))


def scale(a: Column, factor: float) -> Column:
    return F.transform(a, lambda x: x.cast("double") * factor)


def clip_renorm(probs: Column, mx: float) -> Column:
    """Clip to ``[1 - mx, mx]`` and divide by the sum."""
    clipped = F.transform(probs, lambda p: F.least(F.greatest(p.cast("double"), F.lit(1 - mx)), F.lit(mx)))
    return F.transform(clipped, lambda p: p / _sum(clipped))


def argmax(scores: Column) -> Column:
    """0-based place of the first largest item."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def exp_all(log_scores: Column) -> Column:
    return F.transform(log_scores, lambda x: F.exp(x.cast("double")))
