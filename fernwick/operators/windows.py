"""Ordered operators per key: days since / until an event, rolling sums, smoothing.

Windows run per key. Keys with more rows than one task should hold are cut into chunks of
positions; what a chunk needs from its neighbours is carried as one summary row or a few halo
rows, so results are the same as over the whole key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fernwick.operators.ordered import HOT_ROWS, hot_keys, keyed_position
from fernwick.session import same_keys_join


def _day(c: str) -> Column:
    return F.col(c).cast("date")


def needs_chunks(df: DataFrame, keys: Sequence[str], limit: int = HOT_ROWS) -> bool:
    """Whether some key has more rows than one task should hold. Callers that apply several
    operators can ask once and pass the answer as ``chunked``."""
    return not hot_keys(df, keys, limit).isEmpty()


def _nearest_flag(df, flag, keys, date, tie, name, forward, limit, chunked):
    keys = list(keys)
    flagged = F.when(flag, _day(date))
    order = [F.col(date), F.col(tie)]
    pick = F.min if forward else F.max
    frame = (Window.currentRow, Window.unboundedFollowing) if forward else (
        Window.unboundedPreceding, Window.currentRow)
    if not (needs_chunks(df, keys, limit) if chunked is None else chunked):
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*frame)
        return df.withColumn(name, F.datediff(_day(date), pick(flagged).over(w)))
    rows = keyed_position(df, keys, order, limit=limit).withColumns(
        {"_chunk": F.expr(f"_pos div {limit}"), "_flag_day": flagged}
    )
    w = Window.partitionBy(*keys, "_chunk").orderBy("_pos").rowsBetween(*frame)
    chunks = rows.groupBy(*keys, "_chunk").agg(pick("_flag_day").alias("_best"))
    outside = (1, Window.unboundedFollowing) if forward else (Window.unboundedPreceding, -1)
    carry = chunks.select(
        *keys, "_chunk",
        pick("_best").over(
            Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(*outside)).alias("_carry"),
    ).filter("_carry is not null")
    inner = rows.withColumn("_in", pick("_flag_day").over(w))
    out = same_keys_join(inner, carry, [*keys, "_chunk"], "left")
    return out.withColumn(name, F.datediff(_day(date), F.coalesce("_in", "_carry"))).drop(
        "_pos", "_chunk", "_flag_day", "_in", "_carry")


def days_since_last(df: DataFrame, flag: Column, keys: Sequence[str], date: str, tie: str,
                    name: str = "after", limit: int = HOT_ROWS, chunked: bool | None = None) -> DataFrame:
    """Days since the last flagged row of the key: 0 on the row itself, null before the first."""
    return _nearest_flag(df, flag, keys, date, tie, name, False, limit, chunked)


def days_until_next(df: DataFrame, flag: Column, keys: Sequence[str], date: str, tie: str,
                    name: str = "before", limit: int = HOT_ROWS, chunked: bool | None = None) -> DataFrame:
    """Days to the next flagged row of the key as a value <= 0; null after the last one."""
    return _nearest_flag(df, flag, keys, date, tie, name, True, limit, chunked)


def _rolling(df, cols, keys, order, rows, suffix, forward, limit, chunked):
    keys = list(keys)
    frame = (0, rows - 1) if forward else (1 - rows, 0)
    if not (needs_chunks(df, keys, limit) if chunked is None else chunked):
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*frame)
        return df.withColumns({f"{c}{suffix}": F.sum(c).over(w) for c in cols})
    if limit < rows:
        raise ValueError("a chunk must hold at least one frame")
    placed = keyed_position(df, keys, order, limit=limit).withColumns(
        {"_chunk": F.expr(f"_pos div {limit}"), "_halo": F.lit(False)})
    edge = F.expr(f"_pos % {limit}")
    if forward:
        halo = placed.filter((edge < rows - 1) & (F.col("_chunk") > 0)).withColumns(
            {"_chunk": F.col("_chunk") - 1, "_halo": F.lit(True)})
    else:
        halo = placed.filter(edge >= limit - (rows - 1)).withColumns(
            {"_chunk": F.col("_chunk") + 1, "_halo": F.lit(True)})
    w = Window.partitionBy(*keys, "_chunk").orderBy("_pos").rowsBetween(*frame)
    both = placed.unionByName(halo)
    out = both.withColumns({f"{c}{suffix}": F.sum(c).over(w) for c in cols})
    return out.filter(~F.col("_halo")).drop("_pos", "_chunk", "_halo")


def rolling_sum_trailing(df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence,
                         rows: int = 7, suffix: str = "_bw", limit: int = HOT_ROWS,
                         chunked: bool | None = None) -> DataFrame:
    """Sum over the row and the ``rows - 1`` rows before it (rows, not days)."""
    return _rolling(df, cols, keys, order, rows, suffix, False, limit, chunked)


def rolling_sum_leading(df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence,
                        rows: int = 7, suffix: str = "_fw", limit: int = HOT_ROWS,
                        chunked: bool | None = None) -> DataFrame:
    """Sum over the row and the ``rows - 1`` rows after it."""
    return _rolling(df, cols, keys, order, rows, suffix, True, limit, chunked)


def ewma(df: DataFrame, value: str, keys: Sequence[str], order: Sequence, beta: float = 0.98,
         name: str = "smoothed", limit: int = HOT_ROWS) -> DataFrame:
    """Bias-corrected exponential average per key.

    The recurrence is a weighted sum, computed per sub-block of ``span`` positions, where
    ``beta ** span`` is below 1e-17: the state at the end of a sub-block is then its own sum plus
    that of the one before, to the last bit of a double.
    """
    keys = list(keys)
    span = math.ceil(40 / -math.log(beta))
    b = F.lit(float(beta))
    rows = keyed_position(df, keys, order, limit=limit).withColumns(
        {"_sub": F.expr(f"_pos div {span}"), "_off": F.expr(f"_pos % {span}")})
    rows = rows.withColumn("_scaled", F.col(value) * F.pow(b, -F.col("_off")))
    w = Window.partitionBy(*keys, "_sub").orderBy("_pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("_local", (1 - b) * F.pow(b, "_off") * F.sum("_scaled").over(w))
    ends = rows.groupBy(*keys, "_sub").agg(
        ((1 - b) * F.pow(b, F.lit(span - 1)) * F.sum("_scaled")).alias("_end"))

    def shifted(by: int) -> DataFrame:
        return ends.select(*keys, (F.col("_sub") + by).alias("_sub"), F.col("_end").alias(f"_e{by}"))

    # Only keys longer than one sub-block have a state to carry over.
    carry = same_keys_join(shifted(1), shifted(2), [*keys, "_sub"], "left").select(
        *keys, "_sub",
        (F.col("_e1") + F.pow(b, F.lit(span)) * F.coalesce("_e2", F.lit(0.0))).alias("_carry"))
    out = same_keys_join(local, carry, [*keys, "_sub"], "left")
    state = F.col("_local") + F.pow(b, F.col("_off") + 1) * F.coalesce("_carry", F.lit(0.0))
    return out.withColumn(name, state / (1 - F.pow(b, F.col("_pos") + 1))).drop(
        "_pos", "_sub", "_off", "_scaled", "_local", "_carry")
