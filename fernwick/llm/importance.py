"""Quality by importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k.

Two bags of hashed one- and two-grams are counted, over the target texts and over all texts. The log ratio of
their smoothed shares is the weight of an n-gram; a text's log weight is the sum over its n-grams. Adding
independent Gumbel noise and keeping the k largest draws k texts without replacement in proportion to weight.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fernwick.llm.bpe import slices
from fernwick.llm.common import WordHashes, forget_worker_cache, mixed, only, store, summed_arrays, text_bytes
from fernwick.llm.toxicity import labelled_sample
from fernwick.operators.ordered import global_position

BUCKETS = 1 << 16
# Runs of letters and digits, and runs of other signs.
_TOKENS = re.compile(rb"[A-Za-z0-9\x80-\xff]+|[^A-Za-z0-9\x80-\xff\x20\x09-\x0d]+")


def _grams(words: WordHashes, text: bytes, buckets: int) -> np.ndarray:
    one = words.of(_TOKENS.findall(text))
    two = mixed(one[:-1] * np.uint64(3) + one[1:])
    return (np.concatenate([mixed(one), two]) % np.uint64(buckets)).astype(np.int64)


def fit_importance(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   buckets: int = BUCKETS, smooth: float = 1.0) -> np.ndarray:
    """Log ratio of each bucket. ``target`` holds ids (``_id``) of a bounded number of target texts, which is
    sent to all tasks; the raw counts cover all of ``docs``."""
    docs = only(docs, [id_col, text_col])
    target = F.broadcast(target.select("_id").distinct())
    src = docs.join(target, docs[id_col] == target["_id"], "left").select(
        F.col("_id").isNotNull().alias("t"), text_bytes(docs, text_col).alias("text"))

    def count(batches):
        forget_worker_cache()
        words, sums = WordHashes(), np.zeros(2 * buckets, np.int64)
        for batch in batches:
            for hit, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got = np.bincount(_grams(words, text, buckets), minlength=buckets)
                sums[:buckets] += got
                if hit:
                    sums[buckets:] += got
        return sums

    raw, aim = summed_arrays(src, count, 2 * buckets).reshape(2, buckets) + smooth
    return np.log(aim / aim.sum()) - np.log(raw / raw.sum())


def gumbel(id_col: Column, seed: str) -> Column:
    """Gumbel noise from a hash of seed and id: the same for every run and partitioning."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(id_col.cast("string"), F.lit("")))), 1, 13), 16, 10)
    return -F.log(-F.log((bits.cast("double") + 0.5) / F.lit(float(1 << 52))))


def importance_weights(docs: DataFrame, ratios: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
                       row_key: str | None = None) -> DataFrame:
    """Per row: id, ``n_grams`` and ``log_weight``, and ``row_key`` if named. Null, empty and blank texts have no n-gram
    and weight 0."""
    ids = F.struct(docs[id_col].alias(id_col), *([docs[row_key].alias(row_key)] if row_key else []))
    docs = docs.select(ids.alias("_id"), docs[text_col])
    kind = docs.schema["_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches):
        words, table = WordHashes(), sent.value
        for batch in batches:
            for part in slices(batch):
                got = [_grams(words, t, len(table)) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(g) for g in got], pa.int64()),
                     pa.array([float(table[g].sum()) for g in got], pa.float64())], names=["_id", "n_grams", "log_weight"])

    src = docs.select("_id", text_bytes(docs, text_col).alias("text"))
    return src.mapInArrow(run, f"_id {kind}, n_grams long, log_weight double").select("_id.*", "n_grams", "log_weight")


def resample(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
             sample: int = 40_000, keep: float | None = None, spare: float = 0.01, seed: str = "quality",
             row_key: str | None = None) -> DataFrame:
    """Per row of ``docs``: id, ``row_key`` if named, ``n_grams``, ``log_weight``, ``sampled_by`` (weight plus noise), ``place`` (from 1)
    and ``kept``: whether the row is among the k drawn.

    Target texts are those labelled 1 among at most about ``sample`` labelled rows. k is ``keep`` times the
    number of rows; if not given, the share of label 1 in the labelled rows plus ``spare``, so that errors fall
    on the side of keeping. Without labelled rows of both kinds all weights are 0 and every row is kept.
    Ties go to the smaller id; repeated rows have equal noise, and a cut through them keeps some of them.
    """
    docs = only(docs, [id_col, text_col, *([row_key] if row_key else [])])
    known = labelled_sample(docs, labels, label, id_col, sample)
    counts = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    good, all_known = sum(n for y, n in counts.items() if y > 0), sum(counts.values())
    if good and good < all_known:
        ratios = fit_importance(docs, known.filter("_y > 0"), id_col, text_col)
        share = min(1.0, good / all_known + spare) if keep is None else keep
    else:
        ratios, share = np.zeros(BUCKETS), 1.0 if keep is None else keep
    rows = importance_weights(docs, ratios, id_col, text_col, row_key)
    # Stored: the sort below reads its input twice.
    rows = store(rows.withColumn("sampled_by", F.col("log_weight") + gumbel(F.col(id_col), seed)), "weights")
    ranked = global_position(rows, [F.desc("sampled_by"), F.asc(id_col), F.asc("n_grams")], "place")
    k = round(share * ranked.count())
    return ranked.withColumn("place", F.col("place") + 1).withColumn("kept", F.col("place") <= k)
