"""Packing by optimal length buckets: dynamic programming over the global histogram of lengths chooses the
bucket bounds with the least padding; batches of a token budget form inside each bucket."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernwick.llm.bpe import CUT, encoder, read_tokenizer, slices
from fernwick.llm.common import arrow_map, only, store
from fernwick.operators.ordered import global_position

EXACT = 1024
STEPS = 64


def token_lengths(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and ``length`` in tokens. Null and empty texts have length 0."""
    spec = docs.sparkSession.sparkContext.broadcast(read_tokenizer(path))
    docs = only(docs, [id_col, text_col])
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batch):
        enc = encoder(spec.value)
        for part in slices(batch):
            n = [sum(map(len, enc.ids_of(CUT.findall(t)))) // 4 for t in part.column(1).to_pylist()]
            yield {"_id": part.column(0), "length": pa.array(n, pa.int64())}

    src = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return arrow_map(src, f"_id {kind}, length long", run).withColumnRenamed("_id", id_col)


def histogram(lengths: DataFrame, length: str = "length") -> list[tuple[int, int, int]]:
    """(largest length, rows, sum of lengths) of each bin, ascending. Lengths up to ``EXACT`` have bins of their
    own; beyond, each doubling has ``STEPS`` bins, so the table stays small whatever the lengths are."""
    n = F.col(length)
    scale = F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(n, F.lit(1)).cast("double"))) - F.lit(float(np.log2(STEPS))))
    step = F.when(n <= EXACT, n.cast("double")).otherwise(F.ceil(n / scale) * scale)
    rows = lengths.filter(n.isNotNull()).groupBy(step.alias("bin")).agg(
        F.max(n).alias("top"), F.count("*").alias("rows"), F.sum(n).alias("total"))
    return sorted((r["top"], r["rows"], r["total"]) for r in rows.collect())


def best_bounds(bins: list[tuple[int, int, int]], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets over the bins, with the least padding in all. Exact for the
    given bins; ties go to the smaller last bound but one."""
    if not bins:
        return []
    top = np.array([b[0] for b in bins], np.float64)
    rows = np.concatenate([[0], np.cumsum([b[1] for b in bins], dtype=np.float64)])
    # Padding of bins i..j-1 in one bucket: top[j-1] * rows - tokens. The tokens add up to a constant.
    best = np.full(len(bins) + 1, np.inf)
    best[0] = 0
    back = []
    for _ in range(min(buckets, len(bins))):
        took = np.full(len(bins) + 1, np.inf)
        at = np.zeros(len(bins) + 1, np.int64)
        for j in range(1, len(bins) + 1):
            cost = best[:j] + top[j - 1] * (rows[j] - rows[:j])
            at[j] = int(np.argmin(cost))
            took[j] = cost[at[j]]
        back.append(at)
        best = took
    bounds, j = [], len(bins)
    for at in reversed(back):
        bounds.append(int(top[j - 1]))
        j = int(at[j])
    return bounds[::-1]


def pack_by_length(lengths: DataFrame, buckets: int = 16, budget: int = 65_536, id_col: str = "doc_id",
                   length: str = "length") -> DataFrame:
    """Per row: id, ``length``, ``bucket`` (from 0), ``bucket_length``, ``batch`` (unique over all buckets),
    ``slot`` in the batch, and ``padding``.

    A batch of a bucket of length L holds max(1, budget // L) rows; rows longer than the budget are batches of
    their own. Rows are placed by length, then id. Rows of length 0 fill no tokens: they are batched as if
    their length were 1. A null length counts as 0. Repeated rows are packed each.
    """
    rows = only(lengths, [id_col, length]).select(F.col(id_col).alias("_id"), F.coalesce(F.col(length), F.lit(0)).cast("long").alias("_n"))
    rows = store(rows, "lengths")
    bins = histogram(rows, "_n")
    bounds = best_bounds(bins, buckets)
    placed = global_position(rows, ["_n", "_id"], "_pos")
    # Bounds and row counts of at most ``buckets`` buckets become literals.
    top = np.array([b[0] for b in bins])
    counts = np.cumsum([b[1] for b in bins]) if bins else np.zeros(0)
    starts, batches, first = [0], [0], 0
    for bound in bounds:
        upto = int(counts[np.searchsorted(top, bound)])
        starts.append(upto)
        batches.append(batches[-1] + -(-(upto - first) // max(1, budget // max(1, bound))))
        first = upto
    bucket = F.lit(0)
    for bound in bounds[:-1]:
        bucket = bucket + (F.col("_n") > bound).cast("int")

    def of(values):
        return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values or [0]]), F.col("bucket") + 1)

    out = placed.withColumn("bucket", bucket.cast("int"))
    room = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.lit(1), F.col("bucket_length")))).cast("long")
    out = out.withColumns({"bucket_length": of(bounds), "_in": F.col("_pos") - of(starts)}).withColumn("_room", room)
    return out.select(
        F.col("_id").alias(id_col), F.col("_n").alias("length"), "bucket", "bucket_length",
        (of(batches) + F.expr("_in div _room")).alias("batch"), (F.col("_in") % F.col("_room")).alias("slot"),
        (F.col("bucket_length") - F.col("_n")).alias("padding"))
