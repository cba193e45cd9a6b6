"""Positions and running totals over a total order, without a single-task sort.

Rows are range-partitioned by the whole sort key (which ends in a unique id, so one heavy value
is spread over several ranges) and written once to the reliable checkpoint. The checkpointed
partitions are stable, hence a block number and a slot inside the block identify each row, and
only one summary row per block is needed to turn slots into global positions.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fernwick import session
from fernwick.session import cut_lineage, fits, same_keys_join

# Rows of one key that a single window task may hold before the key is cut into chunks.
HOT_ROWS = 4_000_000
_SLOT_MASK = (1 << 33) - 1


def sorted_blocks(df: DataFrame, order: Sequence, parts: int | None = None) -> DataFrame:
    """``df`` in total order, with ``_block`` and ``_slot`` giving each row's place; in ``parts`` blocks, else as many as
    the session's shuffles have."""
    stored = cut_lineage(df.orderBy(*order) if parts is None else df.repartitionByRange(parts, *order).sortWithinPartitions(*order))
    return stored.withColumns(
        {
            "_block": F.spark_partition_id(),
            "_slot": F.monotonically_increasing_id().bitwiseAND(F.lit(_SLOT_MASK)),
        }
    )


def _before(summary: DataFrame, column: str, order: str, keys: Sequence[str] = ()) -> Column:
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(w), F.lit(0))


def global_position(df: DataFrame, order: Sequence, name: str = "pos") -> DataFrame:
    """Add the 0-based position of each row in the given total order."""
    blocks = sorted_blocks(df, order)
    # One row per block: at most the number of shuffle partitions.
    sizes = blocks.groupBy("_block").agg(F.count("*").alias("_n"))
    starts = sizes.select("_block", _before(sizes, "_n", "_block").alias("_start"))
    return (
        blocks.join(F.broadcast(starts), "_block")
        .withColumn(name, F.col("_start") + F.col("_slot"))
        .drop("_block", "_slot", "_start")
    )


def running_totals(
    df: DataFrame, order: Sequence, totals: Mapping[str, str], keys: Sequence[str] = ()
) -> DataFrame:
    """Add inclusive running sums ``{new column: summed column}`` in the given total order, which begins anew for each
    of ``keys``; the sums of one key are never part of another's."""
    keys = list(keys)
    blocks = sorted_blocks(df, [*keys, *order])
    sums = blocks.groupBy("_block", *keys).agg(*[F.sum(c).alias(f"_s_{n}") for n, c in totals.items()])
    starts = sums.select(
        "_block", *keys, *[_before(sums, f"_s_{n}", "_block", keys).alias(f"_c_{n}") for n in totals]
    )
    inside = (
        Window.partitionBy("_block", *keys)
        .orderBy("_slot")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # One row per block, and at most one more per key.
    out = same_keys_join(blocks, starts, ["_block", *keys]) if keys else blocks.join(F.broadcast(starts), "_block")
    return out.withColumns(
        {n: F.col(f"_c_{n}") + F.sum(c).over(inside) for n, c in totals.items()}
    ).drop("_block", "_slot", *[f"_c_{n}" for n in totals])


def average_ranks(df: DataFrame, keys: Sequence[str], value: str, row: str, name: str = "rank", parts: int | None = None) -> DataFrame:
    """Add the average rank (from 1) of each row's ``value`` within its key; ``row`` tells rows apart. ``parts`` is the
    number of blocks, as in `sorted_blocks`.

    Rows are range-sorted by key, value and row, so a heavy value is spread over several blocks, and equal values get
    their rank where they lie. Only values at the edge of a block can go on in another one: their places, two values
    a block and key at most, are summed up and sent to all blocks. No row is joined by its value.
    """
    keys = list(keys)
    blocks = sorted_blocks(df.select(*keys, value, row), [*keys, value, row], parts)
    parts = blocks.groupBy("_block", *keys).agg(
        F.count("*").alias("_n"), F.min("_slot").alias("_first"), F.min(value).alias("_low"), F.max(value).alias("_high"))
    parts = cut_lineage(parts)
    starts = parts.select("_block", *keys, (_before(parts, "_n", "_block", keys) - F.col("_first")).alias("_shift"))
    edges = parts.select(*keys, F.explode(F.array("_low", "_high")).alias(value)).distinct()
    placed = blocks.join(F.broadcast(starts), ["_block", *keys]).withColumn("_at", F.col("_slot") + F.col("_shift"))
    wide = placed.join(F.broadcast(edges), [*keys, value]).groupBy(*keys, value).agg(((F.min("_at") + F.max("_at")) / 2 + 1).alias("_wide"))

    schema = T.StructType([*[f for f in placed.schema if f.name in (*keys, value, row)], T.StructField(name, T.DoubleType())])
    names = [f.name for f in schema]

    same = [*keys, value]

    def rank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Of the last value, which may go on in the next batch: its rows' numbers, its first place and its columns.
        held, first, mark = [], 0, None
        for pdf in batches:
            if not len(pdf):
                continue
            at, cols = pdf["_at"].to_numpy(), [pdf[c] for c in same]
            begins = np.zeros(len(pdf), bool)
            begins[0] = mark is None or any(c.iloc[0] != m for c, m in zip(cols, mark))
            for c in cols:
                begins[1:] |= c.to_numpy()[1:] != c.to_numpy()[:-1]
            starts = np.flatnonzero(begins)
            if not len(starts):
                held.append(pdf[row])
                continue
            if starts[0]:
                held.append(pdf[row].iloc[:starts[0]])
            yield from _held(held, first, mark)
            sizes = np.diff(starts)
            whole = pdf.iloc[starts[0]:starts[-1]]
            if len(whole):
                places = np.repeat((at[starts[:-1]] + at[starts[:-1]] + sizes - 1) / 2 + 1, sizes)
                places[whole[same].isna().any(axis=1).to_numpy()] = np.nan
                yield whole.assign(**{name: places})[names]
            held, first, mark = [pdf[row].iloc[starts[-1]:]], at[starts[-1]], [c.iloc[starts[-1]] for c in cols]
        yield from _held(held, first, mark)

    def _held(held: list[pd.Series], first: int, mark: list | None) -> Iterator[pd.DataFrame]:
        place = np.nan if mark is None or any(pd.isna(m) for m in mark) else (first + first + sum(map(len, held)) - 1) / 2 + 1
        for part in held:
            yield pd.DataFrame({**dict(zip(same, mark)), row: part, name: place}, index=part.index)[names]

    ranked = placed.select(*[n for n in names if n != name], "_at").mapInPandas(rank, schema)
    out = ranked.join(F.broadcast(wide), [*keys, value], "left")
    return out.withColumn(name, F.coalesce("_wide", name)).drop("_wide")


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``limit`` rows; there can be no more than rows / limit of them."""
    return df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > limit).select(*keys)


# Parts that the rows of a frequent key are dealt to when they look something up.
SALTS = 64


def dictionary_join(
    rows: DataFrame, table: DataFrame, key: str, how: str = "inner", limit: int = HOT_ROWS
) -> DataFrame:
    """Join ``rows`` to a table of unique keys. A small table is broadcast. Otherwise the rows of keys that more than
    ``limit`` rows have are dealt to `SALTS` parts, and the table's row of such a key is sent to each of them.
    """
    if fits(table, session.BROADCAST_ROWS):
        return rows.join(F.broadcast(cut_lineage(table)), key, how)
    hot = hot_keys(rows.filter(F.col(key).isNotNull()), [key], limit)
    if hot.isEmpty():
        return rows.join(table, key, how)
    # At most one key for every ``limit`` rows.
    hot = cut_lineage(hot.select(F.col(key).alias("_hot")))
    parts = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").withColumn(
        "_salt", F.when(F.col("_hot").isNull(), 0).otherwise(F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))).cast("int"))
    spread = table.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    return parts.drop("_hot").join(spread.drop("_hot"), [key, "_salt"], how).drop("_salt")


def keyed_position(
    df: DataFrame, keys: Sequence[str], order: Sequence, name: str = "_pos", limit: int = HOT_ROWS
) -> DataFrame:
    """Add the 0-based position of each row inside its key; no task holds a whole hot key.

    Keys up to ``limit`` rows are numbered by one window. Larger ones are range-sorted together
    and numbered from block summaries.
    """
    keys = list(keys)

    def by_window(part: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order)
        return part.withColumn(name, F.row_number().over(w).cast("long") - 1)

    hot = hot_keys(df, keys, limit)
    if hot.isEmpty():
        return by_window(df)
    hot = cut_lineage(hot)
    cold_rows = by_window(same_keys_join(df, hot, keys, "left_anti"))
    blocks = sorted_blocks(same_keys_join(df, hot, keys, "left_semi"), [*keys, *order])
    # At most one row per block and one per hot key.
    parts = blocks.groupBy("_block", *keys).agg(
        F.count("*").alias("_n"), F.min("_slot").alias("_first")
    )
    starts = parts.select(
        "_block", *keys, (_before(parts, "_n", "_block", keys) - F.col("_first")).alias("_shift")
    )
    hot_rows = same_keys_join(blocks, starts, ["_block", *keys]).withColumn(
        name, F.col("_slot") + F.col("_shift")
    )
    return cold_rows.unionByName(hot_rows.drop("_block", "_slot", "_shift"))


def hash_key(id_col: str | Column, seed: str | int) -> Column:
    """Seeded hash that SQL can recompute: md5 of ``seed|id``; null hashes like an empty id, so no row is lost."""
    value = (F.col(id_col) if isinstance(id_col, str) else id_col).cast("string")
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(value, F.lit(""))))


def hash_rank(
    df: DataFrame, id_col: str, seed: str | int, name: str = "rank", below: int | None = None
) -> DataFrame:
    """1-based rank of each row in the order of its seeded hash (a random permutation).

    Hash prefixes make 65,536 even buckets; ranks are bucket start + rank inside the bucket.
    With ``below`` only the rows with a rank up to it are kept, and later buckets are dropped
    before the shuffle.
    """
    hashed = df.withColumn("_h", hash_key(id_col, seed)).withColumn("_b", F.substring("_h", 1, 4))
    # At most 65,536 rows, whatever the size of the table.
    sizes = hashed.groupBy("_b").agg(F.count("*").alias("_n"))
    starts = sizes.select("_b", _before(sizes, "_n", "_b").alias("_start"))
    if below is not None:
        starts = starts.filter(F.col("_start") < below)
    w = Window.partitionBy("_b").orderBy("_h", id_col)
    ranked = hashed.join(F.broadcast(starts), "_b").withColumn(
        name, F.col("_start") + F.row_number().over(w)
    )
    if below is not None:
        ranked = ranked.filter(F.col(name) <= below)
    return ranked.drop("_h", "_b", "_start")
