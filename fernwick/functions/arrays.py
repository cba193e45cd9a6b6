"""Sequence and label-vector expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def one_hot(label: Column, c: int) -> Column:
    """Float vector of length ``c`` with a one at ``label``."""
    return F.transform(F.sequence(F.lit(0), F.lit(c - 1)),
                       lambda i: F.when(i == label, 1.0).otherwise(0.0).cast("float"))


def n_hot(ids: Column, c: int) -> Column:
    """Float vector of length ``c`` with ones at ``ids``."""
    return F.transform(F.sequence(F.lit(0), F.lit(c - 1)),
                       lambda i: F.when(F.array_contains(ids, i), 1.0).otherwise(0.0).cast("float"))


def category_position(col: str, order: Sequence[str]) -> Column:
    """0-based code in an explicit category order; null if absent."""
    place = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(col))
    return F.when(place > 0, place - 1).cast("int")


def pad_to(ids: Column, length: Column, pad: int, pre: bool = True) -> Column:
    """Pad with ``pad`` up to ``length``, in front or behind."""
    fill = F.array_repeat(F.lit(pad), (length - F.size(ids)).cast("int"))
    return F.concat(fill, ids) if pre else F.concat(ids, fill)


def bow_pad(ids: Column, max_len: int) -> Column:
    """Ids + 1; short rows get zeros in front, long rows keep their last ``max_len`` ids."""
    up = F.transform(ids, lambda i: i + 1)
    tail = F.slice(up, F.greatest(F.size(up) - max_len + 1, F.lit(1)), F.lit(max_len))
    return F.concat(F.array_repeat(F.lit(0), F.greatest(F.lit(max_len) - F.size(up), F.lit(0))), tail)


def wrap_sequence(x: Column, backwards: bool = False, sos: int | None = None,
                  eos: int | None = None) -> Column:
    """Reverse first, then append the end mark, then put the start mark in front."""
    if backwards:
        x = F.reverse(x)
    if eos is not None:
        x = F.concat(x, F.array(F.lit(eos)))
    if sos is not None:
        x = F.concat(F.array(F.lit(sos)), x)
    return x


def truncate(x: Column, n: int) -> Column:
    return F.slice(x, 1, n)


def shift_target(x: Column) -> tuple[Column, Column]:
    """(input without its last item, target without its first item)."""
    size = F.greatest(F.size(x) - 1, F.lit(0))
    return F.slice(x, F.lit(1), size), F.slice(x, F.lit(2), size)


def windows(x: Column, width: int, step: int) -> Column:
    """Array of ``(start, items, next)``: windows of ``width`` items and the item after each."""
    starts = F.when(F.size(x) > width,
                    F.sequence(F.lit(1), F.size(x) - width, F.lit(step))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda s: F.struct(
        (s - 1).alias("start"), F.slice(x, s, F.lit(width)).alias("items"),
        F.get(x, s + width - 1).alias("next")))


def bb_corners(height: Column, width: Column, x: Column, y: Column) -> list[Column]:
    """Corner columns of a box, with a negative origin moved to 0."""
    x0, y0 = F.greatest(x, F.lit(0.0)), F.greatest(y, F.lit(0.0))
    return [y0.alias("row1"), x0.alias("col1"), (y0 + height).alias("row2"), (x0 + width).alias("col2")]
