"""Missing values, categories, scaling and model tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fernwick.operators.ordered import global_position, keyed_position
from fernwick.operators.relational import fit_mean_std, median, numeric_columns
from fernwick.operators.sampling import get_sample
from fernwick.session import bounded_broadcast, cut_lineage, same_keys_join

# Names that may become columns or places of a vector.
MAX_NAMES = 10_000


def dense_index(df: DataFrame, col: str, row_id: str, name: str = "idx") -> DataFrame:
    """Ids 0..n-1 by first appearance: ``(value, id)``."""
    first = df.groupBy(col).agg(F.min(row_id).alias("_first"))
    return global_position(first, ["_first"], name).select(col, name)


def category_dictionary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, value, code)``: the distinct values of each column in sorted order, from 0."""
    fields = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]
    # The distinct values are stored: they are read to look for long columns, to number them, and per use.
    pairs = cut_lineage(df.select(F.inline(F.array(*fields))).filter(F.col("value").isNotNull()).distinct())
    return keyed_position(pairs, ["column"], ["value"], "code")


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def train_cats(df: DataFrame) -> DataFrame:
    """Dictionary of all string columns."""
    return category_dictionary(df, string_columns(df))


def apply_cats(df: DataFrame, dictionary: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """Replace values by their codes in a dictionary; unseen values and nulls become null.

    One left join per column. Codes are few as a rule: they are sent to the rows, so that the rows of a frequent value are
    not shuffled to one task.
    """
    out = df
    for c in cols:
        codes = dictionary.filter(F.col("column") == c).select(
            F.col("value").alias("_v"), F.col("code").alias("_code"))
        codes = bounded_broadcast(codes)
        out = out.join(codes, F.col(c).cast("string") == F.col("_v"), "left")
        out = out.withColumn(c + suffix, F.col("_code")).drop("_v", "_code")
    return out


def numericalize(df: DataFrame, dictionary: DataFrame, cols: Sequence[str], max_n_cat: int | None = None
                 ) -> tuple[DataFrame, list[str]]:
    """Codes + 1, missing 0; columns with at most ``max_n_cat`` categories are left as they are.

    Returns the table and the columns left as they are.
    """
    keep: list[str] = []
    if max_n_cat is not None and cols:
        sizes = dictionary.groupBy("column").agg(F.max("code").alias("last")).collect()  # one row per column
        n = {r["column"]: r["last"] + 1 for r in sizes}
        keep = [c for c in cols if n.get(c, 0) <= max_n_cat]
    coded = [c for c in cols if c not in keep]
    out = apply_cats(df, dictionary, coded)
    return out.withColumns({c: F.coalesce(F.col(c) + 1, F.lit(0)) for c in coded}), keep


def fix_missing(df: DataFrame, cols: Sequence[str] | None = None, na_dict: Mapping[str, float] | None = None
                ) -> tuple[DataFrame, dict[str, float]]:
    """Fill numeric nulls with the median and add a ``<name>_na`` flag.

    Only columns with nulls, or named in ``na_dict``, are touched; a stored filler is reused.
    Returns the table and the fillers.
    """
    cols = numeric_columns(df) if cols is None else list(cols)
    fillers = dict(na_dict or {})
    if not cols:
        return df, fillers
    missing = df.agg(*[F.max(F.col(c).isNull()).alias(c) for c in cols]).first()
    touched = [c for c in cols if missing[c] or c in fillers]
    unknown = [c for c in touched if c not in fillers]
    if unknown:
        # The medians of all columns in one run: one row per column reaches the driver.
        long = df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in unknown])))
        fillers |= {r["column"]: r["median"] for r in median(long, "value", ["column"]).collect()}
    out = df.withColumns({f"{c}_na": F.col(c).isNull() for c in touched})
    types = dict(df.dtypes)
    return out.withColumns({
        c: F.coalesce(F.col(c), F.lit(fillers[c]).cast(
            "double" if types[c] != "float" and fillers[c] != int(fillers[c]) else types[c]))
        for c in touched}), fillers


def get_dummies(df: DataFrame, dictionary: DataFrame, cols: Sequence[str], dummy_na: bool = True) -> DataFrame:
    """One 0/1 column per category and ``<col>_nan``; categories become columns, so they are few."""
    rows = dictionary.filter(F.col("column").isin(list(cols))).orderBy("column", "code").take(MAX_NAMES + 1) if cols else []
    if len(rows) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} categories: too many for a column each")
    made = {}
    for c in cols:
        for r in rows:
            if r["column"] == c:
                made[f"{c}_{r['value']}"] = F.when(F.col(c) == r["value"], 1).otherwise(0)
        if dummy_na:
            made[f"{c}_nan"] = F.when(F.col(c).isNull(), 1).otherwise(0)
    return df.withColumns(made).drop(*cols) if made else df


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """``{column: (mean, population std)}``: one row per column reaches the driver."""
    return {r["column"]: (r["mean"], r["std"]) for r in fit_mean_std(df, cols).collect()} if cols else {}


def scale_vars(df: DataFrame, mapper: Mapping[str, tuple[float, float]] | None = None
               ) -> tuple[DataFrame, dict[str, tuple[float, float]]]:
    """Standardize the numeric columns, booleans included; a zero deviation divides by 1."""
    flags = {f.name: F.col(f.name).cast("int") for f in df.schema.fields
             if isinstance(f.dataType, T.BooleanType)}
    df = df.withColumns(flags) if flags else df
    mapper = fit_scaler(df, numeric_columns(df)) if mapper is None else dict(mapper)
    return df.withColumns({c: (F.col(c).cast("double") - m) / (s or 1.0) for c, (m, s) in mapper.items()}), mapper


@dataclass
class Processed:
    """Features with the target in column ``y`` (if asked for) and the fitted state."""

    x: DataFrame
    nas: dict[str, float]
    mapper: dict[str, tuple[float, float]] | None
    categories: DataFrame


def proc_df(df: DataFrame, y_fld: str | None = None, skip_flds: Sequence[str] = (),
            ignore_flds: Sequence[str] = (), do_scale: bool = False, na_dict: Mapping[str, float] | None = None,
            preproc_fn: Callable[[DataFrame], DataFrame] | None = None, max_n_cat: int | None = None,
            subset: int | None = None, mapper: Mapping[str, tuple[float, float]] | None = None,
            categories: DataFrame | None = None, id_col: str | None = None) -> Processed:
    """Split off the target and make the table entirely numeric.

    Order of the steps: sample, set ignored fields aside, hook, target (codes without + 1), drop
    skipped fields, missing values, scaling, category codes, dummies, ignored fields back.
    """
    if subset:
        if id_col is None:
            raise ValueError("a subset needs id_col")
        df = get_sample(df, subset, id_col)
    ignored = [c for c in ignore_flds]
    if preproc_fn:
        df = df.transform(preproc_fn)
    texts = [c for c in string_columns(df) if c not in ignored]
    if categories is None:
        categories = category_dictionary(df, texts) if texts else df.sparkSession.createDataFrame(
            [], "column string, value string, code long")
    skip = list(skip_flds)
    if y_fld is not None:
        if y_fld in texts:
            coded = apply_cats(df, categories, [y_fld], "_code")
            df = coded.withColumn("y", F.coalesce(F.col(f"{y_fld}_code"), F.lit(-1))).drop(f"{y_fld}_code")
        else:
            df = df.withColumn("y", F.col(y_fld))
        skip.append(y_fld)
        ignored = ignored + ["y"]
    df = df.drop(*skip)
    texts = [c for c in texts if c not in skip]
    aside = {c: f"_ignored_{c}" for c in ignored}
    df = df.withColumnsRenamed(aside)
    numeric = [c for c in numeric_columns(df) if c not in aside.values()]
    df, nas = fix_missing(df, numeric, na_dict)
    if do_scale:
        if mapper is None:
            scaled, mapper = scale_vars(df.drop(*aside.values()))
        flags = [f.name for f in df.schema.fields
                 if isinstance(f.dataType, T.BooleanType) and f.name not in aside.values()]
        df = df.withColumns({c: F.col(c).cast("int") for c in flags}) if flags else df
        df, mapper = scale_vars(df, mapper)
    df, left = numericalize(df, categories, texts, max_n_cat)
    df = get_dummies(df, categories, left)
    back = {v: k for k, v in aside.items()}
    first = [c for c in ignored if c != "y"]
    df = df.withColumnsRenamed(back)
    return Processed(df.select(*first, *[c for c in df.columns if c not in first]), nas, mapper, categories)


@dataclass
class NetMappers:
    table: DataFrame
    categories: DataFrame
    scaler: dict[str, tuple[float, float]]


def get_nn_mappers(df: DataFrame, cat_vars: Sequence[str], contin_vars: Sequence[str]) -> NetMappers:
    """Fill continuous nulls with max + 100 and categorical nulls with ``#NA#``; fit codes and scaler."""
    top = df.agg(*[F.max(c).alias(c) for c in contin_vars]).first() if contin_vars else {}
    out = df.withColumns({
        **{c: F.coalesce(F.col(c), F.lit(top[c] + 100 if top[c] is not None else None)) for c in contin_vars},
        **{c: F.coalesce(F.col(c).cast("string"), F.lit("#NA#")) for c in cat_vars}})
    return NetMappers(out, category_dictionary(out, cat_vars), fit_scaler(out, contin_vars))


def embedding_sizes(df: DataFrame, cats: Sequence[str]) -> DataFrame:
    """``(column, cardinality, size)``: distinct + 1 and min(50, (cardinality + 1) // 2)."""
    from fernwick.operators.relational import distinct_counts

    return distinct_counts(df, cats).select(
        "column", (F.col("n_distinct") + 1).alias("cardinality"),
        F.least(F.lit(50).cast("long"), F.floor((F.col("n_distinct") + 2) / 2)).alias("size"))


def assemble(df: DataFrame, cats: Sequence[str], conts: Sequence[str], y: str | None = None,
             keep: Sequence[str] = ()) -> DataFrame:
    """Typed arrays ``cats`` (long) and ``conts`` (float) and ``y``; an empty side becomes a zero."""
    cat = F.array(*[F.col(c).cast("long") for c in cats]) if cats else F.array(F.lit(0).cast("long"))
    cont = F.array(*[F.col(c).cast("float") for c in conts]) if conts else F.array(F.lit(0).cast("float"))
    target = F.col(y) if y else F.lit(0)
    return df.select(*keep, cat.alias("cats"), cont.alias("conts"), target.cast("float").alias("y"))


def nhot_labels(df: DataFrame, id_col: str, labels: str, continuous: bool = False) -> tuple[DataFrame, list[str]]:
    """Label sets to vectors ``(id, label_vector)`` and the sorted label names.

    If every row has exactly one label the result is the class index in ``label`` instead. The
    label names become vector positions, so they reach the driver; there are as many as positions.
    """
    from fernwick.functions.arrays import category_position, n_hot

    if continuous:
        return df.select(id_col, F.col(labels).cast("array<float>").alias("label_vector")), []
    found = df.select(F.explode(labels).alias("label")).distinct().orderBy("label").take(MAX_NAMES + 1)
    if len(found) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} label names: too many for vectors with a place for each")
    names = [r["label"] for r in found]
    single = df.agg(F.bool_and(F.size(F.array_distinct(labels)) == 1)).first()[0]
    rows = df.withColumn("_first", F.get(labels, F.lit(0)))
    if single:
        return rows.select(id_col, category_position("_first", names).alias("label")), names
    index = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))])
    ids = F.transform(labels, lambda v: F.element_at(index, v))
    return df.select(id_col, n_hot(ids, len(names)).alias("label_vector")), names


def pad_batch(df: DataFrame, seq: str, batch: str, pad: int, pre: bool = True) -> DataFrame:
    """Pad to the longest sequence of the batch."""
    from fernwick.functions.arrays import pad_to

    longest = df.groupBy(batch).agg(F.max(F.size(seq)).alias("_longest"))
    return same_keys_join(df, longest, [batch]).withColumn(seq, pad_to(F.col(seq), F.col("_longest"), pad, pre)).drop("_longest")


def rebase_labels(df: DataFrame, label: str) -> DataFrame:
    """Subtract the smallest label and add the class count ``n_classes``."""
    span = df.agg(F.struct(F.min(label).alias("lo"), F.max(label).alias("hi"))).scalar()
    return df.withColumns({label: F.col(label) - span["lo"], "n_classes": span["hi"] - span["lo"] + 1})


def fixed_length(df: DataFrame, tokens: str, keep_n: int, fraction: float = 0.7, indicators: bool = True,
                 padding: str = "pre", id_col: str = "doc_id") -> tuple[DataFrame, DataFrame, int]:
    """Vocabulary of ``keep_n`` tokens, and id sequences of one fitted length.

    The length is the ``fraction`` percentile of the token counts. Returns the sequences, the
    vocabulary and the length.
    """
    from fernwick.functions.arrays import pad_to
    from fernwick.operators.relational import percentiles
    from fernwick.operators.vocab import build_vocab, numericalize_docs

    marks = ["_pad_", "_unk_"] + (["_start_", "_end_"] if indicators else [])
    vocab = build_vocab(df.select(F.explode(tokens).alias("token")), keep_n, 0, marks)
    sizes = df.select(F.size(tokens).alias("n"))
    length = int(percentiles(sizes, "n", [fraction]).first()[0])
    ids = numericalize_docs(df.select(id_col, tokens), tokens, vocab, id_col, unk=1)
    seq: Column = F.col("ids")
    if indicators:
        seq = F.concat(F.array(F.lit(2).cast("long")), seq, F.array(F.lit(3).cast("long")))
    cut = F.slice(seq, F.lit(1), F.lit(length)) if padding == "post" else F.slice(
        seq, F.greatest(F.size(seq) - length + 1, F.lit(1)), F.lit(length))
    padded = ids.withColumn("ids", cut)
    return padded.withColumn("ids", pad_to(F.col("ids"), F.lit(length), 0, padding == "pre")), vocab, length
