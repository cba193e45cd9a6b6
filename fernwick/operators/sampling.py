"""Reproducible samples, splits and batch orders.

Every random choice is the rank or value of ``md5(seed|id)``: it does not depend on how rows are
partitioned, and a task that is run again makes the same choice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fernwick.operators.ordered import global_position, hash_key, hash_rank
from fernwick.session import cut_lineage, same_keys_join


def hash_fraction(id_col: str, seed: str | int) -> Column:
    """Uniform number in [0, 1) from the first 8 hex digits of the seeded hash."""
    return F.conv(F.substring(hash_key(id_col, seed), 1, 8), 16, 10).cast("long") / F.lit(2.0**32)


def get_sample(df: DataFrame, n: int, id_col: str, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows without replacement, in id order."""
    return hash_rank(df, id_col, seed, "_rank", below=n).drop("_rank").orderBy(id_col)


def bernoulli_sample(df: DataFrame, p: float, id_col: str, seed: int = 42) -> DataFrame:
    """Each row with probability ``p``; no shuffle."""
    return df.filter(hash_fraction(id_col, seed) < p)


def cv_fold(df: DataFrame, id_col: str, cv_idx: int = 0, val_pct: float = 0.2, seed: int = 42,
            name: str = "is_val") -> DataFrame:
    """Flag the rows of fold ``cv_idx``: a slice of int(val_pct * n) places of the permutation."""
    n_val = F.floor(F.lit(val_pct) * df.agg(F.count("*")).scalar())
    start = n_val * cv_idx
    place = F.col("_rank") - 1
    return hash_rank(df, id_col, seed, "_rank").withColumn(
        name, (place >= start) & (place < start + n_val)).drop("_rank")


def split_by_idx(df: DataFrame, flag: str = "is_val") -> tuple[DataFrame, DataFrame]:
    """(selected, rest) by a flag column."""
    return df.filter(F.col(flag)).drop(flag), df.filter(~F.col(flag)).drop(flag)


def grouped_split(df: DataFrame, key: str, train_size: float = 0.87, second_size: float = 0.82,
                  seed: int = 8081, name: str = "split") -> DataFrame:
    """Whole groups to train, valid or test.

    Ranks are taken on the table of distinct groups, which is computed once and stored. The first ``train_size`` share of the groups
    is split again by ``second_size`` into train and valid; the others are test. Null is a group like any other.
    """
    groups = cut_lineage(df.select(key).distinct())
    first = hash_rank(groups, key, seed, "_r")
    n_first = F.floor(F.lit(train_size) * groups.agg(F.count("*")).scalar())
    kept = first.filter(F.col("_r") <= n_first).drop("_r")
    second = hash_rank(kept, key, f"{seed}|second", "_r2")
    n_second = F.floor(F.lit(second_size) * n_first)
    side = second.select(key, F.when(F.col("_r2") <= n_second, "train").otherwise("valid").alias(name))
    return same_keys_join(df, side, [key], "left").withColumn(name, F.coalesce(name, F.lit("test")))


def random_split(df: DataFrame, id_col: str, test_size: float = 0.1, seed: int = 42,
                 name: str = "split") -> DataFrame:
    """Row-level split with exactly ceil(test_size * n) test rows."""
    n_test = F.ceil(F.lit(test_size) * df.agg(F.count("*")).scalar())
    return hash_rank(df, id_col, seed, "_rank").withColumn(
        name, F.when(F.col("_rank") <= n_test, "test").otherwise("train")).drop("_rank")


def positional_split(df: DataFrame, order: Sequence, valid_fraction: float = 0.25,
                     name: str = "split") -> DataFrame:
    """The last share of the rows in the given total order is the validation side."""
    total = df.agg(F.count("*")).scalar()
    n_train = total - F.floor(total * F.lit(valid_fraction))
    return global_position(df, order, "_pos").withColumn(
        name, F.when(F.col("_pos") < n_train, "train").otherwise("valid")).drop("_pos")


def date_range_split(df: DataFrame, date: str, start: str, end: str, name: str = "split") -> DataFrame:
    """Rows in the closed interval are the validation side."""
    inside = F.col(date).cast("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return df.withColumn(name, F.when(inside, "valid").otherwise("train"))


def shuffle(df: DataFrame, id_col: str, seed: int = 42, name: str = "place") -> DataFrame:
    """Seeded permutation: the 1-based place of each row."""
    return hash_rank(df, id_col, seed, name)


def sample_by_class(df: DataFrame, keys: Sequence[str], k: int, id_col: str, seed: int = 42) -> DataFrame:
    """``k`` random rows per class; tasks keep at most ``k`` per class before the shuffle."""
    w = Window.partitionBy(*keys).orderBy("_h", id_col)
    ranked = df.withColumn("_h", hash_key(id_col, seed)).withColumn("_r", F.row_number().over(w))
    return ranked.filter(F.col("_r") <= k).drop("_h", "_r")


def sort_batches(df: DataFrame, length: str, id_col: str, batch_size: int) -> DataFrame:
    """Longest first, cut into batches."""
    placed = global_position(df, [F.desc(length), F.asc(id_col)], "_pos")
    return placed.withColumn("batch", F.floor(F.col("_pos") / batch_size)).drop("_pos")


def sortish_batches(df: DataFrame, length: str, id_col: str, batch_size: int, seed: int = 42,
                    chunk_batches: int = 50) -> DataFrame:
    """Random chunks of ``chunk_batches`` batches, longest first inside each, in random batch order.

    ``batch_order`` 0 is the batch that holds the longest row. A window holds one chunk, whose
    size is fixed.
    """
    rows = hash_rank(df, id_col, seed, "_rank").withColumn(
        "_chunk", F.floor((F.col("_rank") - 1) / (batch_size * chunk_batches)))
    w = Window.partitionBy("_chunk").orderBy(F.desc(length), F.asc(id_col))
    rows = rows.withColumn("_in", F.row_number().over(w) - 1).withColumn(
        "batch", F.col("_chunk") * chunk_batches + F.floor(F.col("_in") / batch_size))
    # One row per batch, read three times.
    batches = cut_lineage(rows.groupBy("batch").agg(F.max(length).alias("_longest")))
    first = batches.agg(F.min(F.struct((-F.col("_longest")).alias("l"), "batch"))).scalar()["batch"]
    others = hash_rank(batches.filter(F.col("batch") != first).select("batch"), "batch",
                       f"{seed}|order", "batch_order")
    return rows.join(others, "batch", "left").withColumn(
        "batch_order", F.coalesce("batch_order", F.lit(0))).drop("_rank", "_chunk", "_in")


def bootstrap_rows(df: DataFrame, id_col: str, draws: int, trees: int, seed: int = 42) -> DataFrame:
    """``draws`` draws with replacement for each tree: ``(tree, draw, id)``.

    Each draw hashes to a place of the seeded permutation, and places are joined to ids.
    """
    total = df.agg(F.count("*")).scalar()
    places = hash_rank(df.select(id_col), id_col, seed, "_rank")
    wanted = df.sparkSession.range(draws * trees).select(
        F.expr(f"id div {draws}").alias("tree"), F.expr(f"id % {draws}").alias("draw"), "id")
    number = F.conv(F.substring(hash_key("id", f"{seed}|draw"), 1, 15), 16, 10).cast("long")
    wanted = wanted.withColumn("_rank", number % total + 1).drop("id")
    return wanted.join(places, "_rank").select("tree", "draw", id_col)
