"""Projections, filters, joins, aggregations and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fernwick.operators.ordered import running_totals
from fernwick.session import cut_lineage, same_keys_join

# ---------------------------------------------------------------- projections and filters


def split_repo_path(df: DataFrame, col: str = "repo_path") -> DataFrame:
    """Item 0 of the whitespace split is ``nwo``, item 1 is ``path``; the source column goes."""
    parts = F.split(F.trim(F.col(col)), r"\s+")
    return df.select(F.get(parts, F.lit(0)).alias("nwo"), F.get(parts, F.lit(1)).alias("path"),
                     *[c for c in df.columns if c != col])


def make_url(base: str, nwo: str = "nwo", path: str = "path", lineno: str = "lineno") -> Column:
    """``base/nwo/blob/master/path#Lline``."""
    return F.format_string(f"{base}/%s/blob/master/%s#L%s", F.col(nwo), F.col(path),
                           F.col(lineno).cast("string"))


def token_count(col: str | Column) -> Column:
    """Whitespace-separated tokens of a string; null counts 0."""
    c = F.col(col) if isinstance(col, str) else col
    words = F.filter(F.split(c, r"\s+"), lambda t: t != "")
    return F.when(c.isNull(), 0).otherwise(F.size(words))


def partition_by_docstring(df: DataFrame, col: str = "docstring_tokens", min_tokens: int = 3
                           ) -> tuple[DataFrame, DataFrame]:
    """Rows with at least ``min_tokens`` docstring tokens, and the others."""
    enough = token_count(col) >= min_tokens
    return df.filter(enough), df.filter(~enough)


def to_flag(col: str, zero: str = "0") -> Column:
    return F.col(col) != F.lit(zero)


def overwrite_where(df: DataFrame, pred: Column, col: str, value) -> DataFrame:
    return df.withColumn(col, F.when(pred, F.lit(value)).otherwise(F.col(col)))


def bucket_and_cap(days: Column, unit: int, cap: int) -> Column:
    """Whole units, not below 0 and not above ``cap``."""
    return F.least(F.greatest(F.floor(days / unit), F.lit(0)), F.lit(cap)).cast("int")


def drop_suffix_cols(df: DataFrame, suffix: str = "_y") -> DataFrame:
    return df.drop(*[c for c in df.columns if c.endswith(suffix)])


def filter_rows(df: DataFrame, pred: Column | str) -> DataFrame:
    return df.filter(pred)


def cast_columns(df: DataFrame, cats: Sequence[str], conts: Sequence[str]) -> DataFrame:
    """Categorical columns to string, continuous ones to 32-bit floats."""
    return df.withColumns({**{c: F.col(c).cast("string") for c in cats},
                           **{c: F.col(c).cast("float") for c in conts}})


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def distinct_counts(df: DataFrame, cols: Sequence[str], approximate: bool = False) -> DataFrame:
    """``(column, n_distinct)`` for each column.

    Exact counts are taken per (column, value) pair, so partial aggregation absorbs repeated
    values and the shuffle is spread over the values of all columns.
    """
    if approximate:
        wide = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
        return wide.unpivot([], list(cols), "column", "n_distinct")
    names = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                      for c in cols])
    pairs = df.select(F.inline(names)).distinct()
    counted = pairs.groupBy("column").agg(F.count("value").alias("n_distinct"))
    return counted


def low_cardinality_cols(df: DataFrame, cols: Sequence[str], divisor: int = 50) -> DataFrame:
    """Columns with fewer distinct values than rows / ``divisor``; the others are continuous."""
    total = df.agg(F.count("*")).scalar()
    return distinct_counts(df, cols).select(
        "column", "n_distinct", (F.col("n_distinct") < total / divisor).alias("is_categorical"))


def keep_short(df: DataFrame, tokens: str | Column, max_len: int = 30) -> DataFrame:
    c = F.col(tokens) if isinstance(tokens, str) else tokens
    return df.filter(F.size(c) < max_len)


def null_fraction(df: DataFrame) -> DataFrame:
    """``(column, fraction)`` of nulls, all columns in one pass."""
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns])
    return wide.unpivot([], list(df.columns), "column", "fraction")


def unmatched_after_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` without a partner: one row with the count."""
    return left.join(right.select(*on), list(on), "left_anti").agg(F.count("*").alias("unmatched"))


def log_target(col: str) -> Column:
    return F.log(F.col(col))


def inv_y(col: str) -> Column:
    return F.exp(F.col(col))


def fill_constant(col: str, value: int) -> Column:
    return F.coalesce(F.col(col), F.lit(value)).cast("int")


# ---------------------------------------------------------------- joins


def join_df(left: DataFrame, right: DataFrame, left_on: Sequence[str] | str,
            right_on: Sequence[str] | str | None = None, suffix: str = "_y") -> DataFrame:
    """Left outer equi-join; right columns whose name exists on the left get ``suffix``.

    No broadcast is forced: Spark broadcasts the right side only where its size allows.
    """
    left_on = [left_on] if isinstance(left_on, str) else list(left_on)
    right_on = left_on if right_on is None else (
        [right_on] if isinstance(right_on, str) else list(right_on))
    shared = [r for lf, r in zip(left_on, right_on) if lf == r]
    taken = set(left.columns)
    names = {c: (f"{c}{suffix}" if c in taken and c not in shared else c) for c in right.columns}
    keyed = right.select(*[F.col(c).alias(f"_k_{c}" if c in shared else n) for c, n in names.items()])
    cond = reduce(lambda a, b: a & b, [
        left[lf] == keyed[f"_k_{r}" if r in shared else names[r]]
        for lf, r in zip(left_on, right_on)])
    return left.join(keyed, cond, "left").drop(*[f"_k_{r}" for r in shared])


def join_special_slice(left: DataFrame, dim: DataFrame, slice_pred: Column, left_on: Sequence[str],
                       right_on: Sequence[str], suffix: str = "_DE") -> DataFrame:
    """Left-join one slice of a dimension under its own suffix."""
    return join_df(left, dim.filter(slice_pred), left_on, right_on, suffix)


def top_groups(df: DataFrame, keys: Sequence[str], k: int, name: str = "n") -> DataFrame:
    """The ``k`` largest groups by row count; ties by key."""
    return df.groupBy(*keys).agg(F.count("*").alias(name)).orderBy(F.desc(name), *keys).limit(k)


def join_top_entities(df: DataFrame, key_a: str, key_b: str, k: int) -> DataFrame:
    """Rows whose ``key_a`` and ``key_b`` are both among the ``k`` most frequent."""
    out = df
    for key in (key_a, key_b):
        out = out.join(F.broadcast(top_groups(df, [key], k).select(key)), key, "left_semi")  # k rows
    return out


def lookup_or_default(df: DataFrame, dictionary: DataFrame, key: str, value: str, default) -> DataFrame:
    """Dictionary value of ``key``; unknown keys get ``default``."""
    return df.join(dictionary, key, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def lookup_ignore_case(df: DataFrame, dictionary: DataFrame, key: str, dict_key: str) -> DataFrame:
    """Inner lookup by lower-cased key; rows without a partner are dropped."""
    return df.join(dictionary, F.lower(df[key]) == F.lower(dictionary[dict_key]))


def keep_known_keys(df: DataFrame, known: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(known.select(*on), list(on), "left_semi")


# ---------------------------------------------------------------- aggregations


def crosstab_sum(df: DataFrame, row: str, col: str, values: Sequence, measure: str) -> DataFrame:
    """Pivot with sum; the pivot values are given, so no extra pass looks for them."""
    return df.groupBy(row).pivot(col, list(values)).sum(measure)


def group_mean(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in cols])


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias(name)).orderBy(F.desc(name), col)


def nunique(df: DataFrame, col: str, name: str = "n_distinct") -> DataFrame:
    return df.agg(F.countDistinct(col).alias(name))


def unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def percentile_name(p: float) -> str:
    """Column of a percentile: p50, p97_5."""
    return f"p{100 * p:g}".replace(".", "_")


def percentiles(df: DataFrame, col: str, fractions: Sequence[float], keys: Sequence[str] = ()
                ) -> DataFrame:
    """Exact percentiles with linear interpolation, per key or over all rows.

    Equal values are counted first; running totals over the sorted (key, value, count) rows then
    tell which value stands at each wanted position, so no task holds all values of a key.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(*keys, F.col(col).alias("_v")).agg(
        F.count("*").alias("_n"))
    return _count_percentiles(counts, fractions, keys)


def _count_percentiles(counts: DataFrame, fractions: Sequence[float], keys: Sequence[str]) -> DataFrame:
    """Percentiles of ``(keys, _v, _n)`` rows."""
    keys = list(keys)
    placed = running_totals(counts, [*keys, "_v"], {"_upto": "_n"})
    sizes = placed.groupBy(*keys).agg(F.min(F.col("_upto") - F.col("_n")).alias("_from"),
                                      F.sum("_n").alias("_total"))
    if keys:
        placed = same_keys_join(placed, sizes, keys)
    else:
        one = sizes.select(F.struct("_from", "_total")).scalar()
        placed = placed.withColumns({"_from": one["_from"], "_total": one["_total"]})
    first = F.col("_upto") - F.col("_n") - F.col("_from")
    past = F.col("_upto") - F.col("_from")
    wanted = []
    for p in fractions:
        rank = F.lit(float(p)) * (F.col("_total") - 1)

        def at(i: Column) -> Column:
            return F.max(F.when((i >= first) & (i < past), F.col("_v").cast("double")))

        lo, hi = at(F.floor(rank)), at(F.ceil(rank))
        share = F.max(rank - F.floor(rank))
        wanted.append((lo + (hi - lo) * share).alias(percentile_name(p)))
    return placed.groupBy(*keys).agg(*wanted)


def median(df: DataFrame, col: str, keys: Sequence[str] = ()) -> DataFrame:
    return percentiles(df, col, [0.5], keys).withColumnRenamed("p50", "median")


def fit_mean_std(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, mean, std)`` with the population standard deviation, in one pass."""
    row = df.agg(*[F.struct(F.avg(F.col(c).cast("double")).alias("mean"),
                            F.stddev_pop(F.col(c).cast("double")).alias("std")).alias(c)
                   for c in cols])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}.mean").alias("mean"),
                 F.col(f"{c}.std").alias("std")) for c in cols])))


def min_max(df: DataFrame, col: str, headroom: float = 1.2) -> DataFrame:
    """Smallest, largest, and the range limit ``headroom * max``."""
    return df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"),
                  (F.max(col) * headroom).alias("limit"))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per numeric column: count, mean, std, min, quartiles, max, distinct, missing, top value."""
    fields = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols]
    long = df.select(F.inline(F.array(*fields)))
    # One pass over the table; everything else is read from the (column, value, count) rows.
    counts = cut_lineage(long.groupBy("column", "value").agg(F.count("*").alias("n")))
    v, n = F.col("value"), F.col("n")
    known = F.when(v.isNotNull(), n)
    basic = counts.groupBy("column").agg(
        F.sum(known).alias("count"), (F.sum(v * n) / F.sum(known)).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.count(v).alias("unique"), F.sum(F.when(v.isNull(), n).otherwise(0)).alias("missing"))
    values = counts.filter(v.isNotNull())
    # One row per column on the right side of these joins.
    spread = values.join(F.broadcast(basic.select("column", "mean", "count")), "column").groupBy("column").agg(
        F.sqrt(F.sum(n * (v - F.col("mean")) * (v - F.col("mean"))) / (F.max("count") - 1)).alias("std"))
    top = largest_by(values, ["column"], n, ["value"]).select("column", v.alias("top"), n.alias("top_freq"))
    quarters = _count_percentiles(values.select("column", v.alias("_v"), n.alias("_n")), [0.25, 0.5, 0.75], ["column"])
    return basic.join(spread, "column").join(quarters, "column").join(top, "column")


def drop_duplicates(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """The row with the smallest id per key combination.

    The smallest id per key digest is found by partial aggregation (a heavy group of copies
    leaves each task as one row), then the rows are picked by their unique ids.
    """
    parts = [F.coalesce(F.concat(F.length(F.col(k)).cast("string"), F.lit(":"), F.col(k).cast("string")),
                        F.lit("-")) for k in keys]
    digest = F.sha2(F.concat_ws("|", *parts), 256)
    keep = df.select(digest.alias("_d"), id_col).groupBy("_d").agg(F.min(id_col).alias(id_col))
    return df.join(keep.select(id_col), id_col, "left_semi")


def removed_duplicates(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """One row: rows before, rows after and rows removed."""
    after = drop_duplicates(df, keys, id_col).select(F.lit(0).alias("b"), F.lit(1).alias("a"))
    both = df.select(F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(after)
    return both.agg(F.sum("b").alias("before_dedup"), F.sum("a").alias("after_dedup"),
                    (F.sum("b") - F.sum("a")).alias("removed"))


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(F.count("*").alias("n"))


def largest_by(df: DataFrame, keys: Sequence[str], measure: Column, tie: Sequence[str]) -> DataFrame:
    """Per key the row with the largest measure; ties by ``tie``.

    A rank limit of 1 is applied inside each task before the shuffle, so a heavy key sends one
    row per task.
    """
    w = Window.partitionBy(*keys).orderBy(F.desc("_m"), *tie)
    ranked = df.withColumn("_m", measure).withColumn("_r", F.row_number().over(w))
    return ranked.filter("_r = 1").drop("_m", "_r")


def unigram_probs(ids: DataFrame, col: str, n: int) -> DataFrame:
    """Share of each id in ``0..n-1``; absent ids get zero."""
    counts = ids.groupBy(col).agg(F.count("*").alias("_c"))
    total = ids.agg(F.count("*")).scalar()
    span = ids.sparkSession.range(n).withColumnRenamed("id", col)
    return span.join(counts, col, "left").select(
        col, (F.coalesce("_c", F.lit(0)) / total).alias("prob"))


def weighted_mean(value: str, weight: str) -> Column:
    return F.sum(F.col(value) * F.col(weight)) / F.sum(weight)


def corpus_counts(df: DataFrame, tokens: Column) -> DataFrame:
    """Rows, tokens and distinct tokens.

    Token counts are aggregated first; distinct tokens are then counted on one row per token.
    """
    toks = df.select(tokens.alias("_t"))
    sizes = toks.agg(F.count("*").alias("n_rows"), F.sum(F.size("_t")).cast("long").alias("n_tokens"))
    vocab = toks.select(F.explode("_t").alias("token")).distinct().agg(F.count("*").alias("n_vocab"))
    return sizes.withColumn("n_vocab", vocab.scalar())


# ---------------------------------------------------------------- sorting and sets


def sort_rows(df: DataFrame, keys: Mapping[str, bool]) -> DataFrame:
    """Sort by ``{column: ascending}``."""
    return df.orderBy(*[F.asc(c) if asc else F.desc(c) for c, asc in keys.items()])


def top_bottom(df: DataFrame, score: str, id_col: str, k: int) -> DataFrame:
    """The ``k`` best and the ``k`` worst rows by score."""
    best = df.orderBy(F.desc(score), id_col).limit(k).withColumn("side", F.lit("top"))
    worst = df.orderBy(F.asc(score), id_col).limit(k).withColumn("side", F.lit("bottom"))
    return best.unionByName(worst)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def union_labels(df: DataFrame, labels: str | Column) -> DataFrame:
    c = F.col(labels) if isinstance(labels, str) else labels
    return df.select(F.explode(c).alias("label")).distinct()


def vocab_overlap(a: DataFrame, b: DataFrame, col: str = "token") -> DataFrame:
    """Each token of ``a`` with whether ``b`` holds it too."""
    known = b.select(col).distinct().withColumn("_hit", F.lit(True))
    return a.select(col).distinct().join(known, col, "left").select(
        col, F.coalesce("_hit", F.lit(False)).alias("found"))


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns; booleans count as numeric."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.BooleanType))]
