"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence has probability ``p = sigmoid(bias + sum of weights)`` over its words and their beginnings; a document is toxic if any
of its sentences is: ``P = 1 - product(1 - p)`` (noisy-or). The weights are fitted to document labels alone, and
the sentence probabilities then tell where the offence is.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernwick.llm.bpe import slices
from fernwick.llm.common import WordHashes, arrow_map, forget_worker_cache, hash_fraction, only, store, summed_arrays, text_bytes

BUCKET_BITS = 20
# Sentences end at these bytes; other ASCII punctuation parts words. Text is lower-cased (A-Z) in the same step.
_TABLE = bytes(10 if chr(b) in ".!?\n\r" else b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() or chr(b) in "'-" else 32
               for b in range(256))
LONGEST = 64


def _sentences(text: bytes) -> list[list[bytes]]:
    """Words of each sentence; sentences without words are kept, so that numbers match places in the text."""
    return [s.split() for s in text.translate(_TABLE).split(b"\n")]


def _flat(text: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """All words, the number of words of each piece and the sentence of each piece. Sentences of more than
    ``LONGEST`` words are several pieces, so text without full stops is not one sentence."""
    sents = _sentences(text)
    sizes = np.array([len(s) for s in sents])
    parts = -(-sizes // LONGEST)
    where = np.repeat(np.arange(len(sents)), parts)
    lens = np.full(len(where), LONGEST)
    last = np.cumsum(parts)[parts > 0] - 1
    lens[last] = sizes[parts > 0] - LONGEST * (parts[parts > 0] - 1)
    return list(chain.from_iterable(sents)), lens, where


# A word counts as itself and by its first bytes, which it shares with words of its family.
HEADS = (4, 5, 6)


def _features(words: WordHashes, text: list[bytes]) -> np.ndarray:
    """Hashed features, ``1 + len(HEADS)`` per word."""
    cols = [words.of(text)] + [words.of([b"%d" % k + w[:k] for w in text]) for k in HEADS]
    return (np.stack(cols, 1).reshape(-1) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


class WordWeights(dict):
    """Sum of the weights of a word's features, kept for words seen before."""

    def __init__(self, weights: np.ndarray, limit: int = 300_000):
        super().__init__()
        self.weights, self.limit, self.hashes = weights, limit, WordHashes(20_000)

    def __missing__(self, word: bytes) -> float:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = float(self.weights[_features(self.hashes, [word])].sum())
        return value


class SentenceModel:
    """Weights of the hashed words and the bias; ``None`` weights: nothing could be learnt, all scores are 0."""

    def __init__(self, weights: np.ndarray | None, bias: float = 0.0):
        self.weights, self.bias = weights, bias

    def pieces(self, words: WordWeights, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log-odds of each piece, its sentence, and its number of words."""
        flat, lens, where = _flat(text)
        if not len(lens) or self.weights is None:
            return np.zeros(0), where[:0], lens[:0]
        w = np.fromiter(map(words.__getitem__, flat), np.float64, len(flat))
        return self.bias + np.add.reduceat(w, np.cumsum(lens) - lens), where, lens


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str, rows: int) -> DataFrame:
    """At most about ``rows`` of the labelled ids, the same for every partitioning: those with the smallest
    hashes. The bound makes the sample small enough to be sent to all tasks. A document with several labels
    has the largest one; null labels and labels of other tables' documents do not count."""
    own = only(docs, [id_col]).select(F.col(id_col).alias("_id")).filter("_id is not null").distinct()
    known = (labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_y"))
             .filter("_id is not null and _y is not null").groupBy("_id").agg(F.max("_y").alias("_y")))
    known = store(known.join(own, "_id", "left_semi"), "labelled")
    share = rows / max(1, known.count())
    if share >= 1:
        return known
    cut = int(share * 2**32) - 2**31
    return known.filter(F.hash(F.lit("sample"), "_id") < cut)


def fit_noisy_or(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id",
                 text_col: str = "text", held_out: int | None = 5, sample: int = 20_000, features: int = 65_536,
                 rounds: int = 60, rate: float = 0.1, ridge: float = 1.0) -> SentenceModel:
    """Fit the sentence model to document labels.

    Learns from at most about ``sample`` labelled rows, whole texts; rows whose crc32(id) mod ``held_out`` is 0
    are left out. The ``features`` hashed features of the most sample documents, five at least, get a
    weight; ``ridge`` is half the inverse variance of their prior. Each round is one
    Spark job over the stored features; only gradients of ``features`` numbers reach the driver.
    """
    docs = only(docs, [id_col, text_col])
    known = labels if held_out is None else labels.filter(hash_fraction(labels[id_col], held_out) != 0)
    known = F.broadcast(labelled_sample(docs, known, label, id_col, sample))
    texts = docs.join(known, docs[id_col] == known["_id"]).select("_y", text_bytes(docs, text_col).alias("text"))

    def featured(batch):
        forget_worker_cache()
        words = WordHashes(150_000)
        for part in slices(batch):
            y, grams, lens = [], [], []
            for label_, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                flat, sizes, _ = _flat(text)
                if len(sizes):
                    y.append(label_)
                    grams.append(_features(words, flat).astype("<u4").tobytes())
                    lens.append((sizes * (1 + len(HEADS))).astype("<u2").tobytes())
            yield {"y": pa.array(y, pa.int32()), "grams": pa.array(grams, pa.binary()), "lens": pa.array(lens, pa.binary())}

    stored = store(arrow_map(texts, "y int, grams binary, lens binary", featured), "sentences")
    sizes = {r["y"]: r["n"] for r in stored.groupBy(F.least("y", F.lit(1)).alias("y")).agg(F.count("*").alias("n")).collect()}
    if not sizes.get(1) or not sizes.get(0):
        return SentenceModel(None)

    def spread(batches):
        seen = np.zeros(1 << BUCKET_BITS, np.int64)
        for part in chain.from_iterable(map(slices, batches)):
            for data in part.column(0).to_pylist():
                seen[np.unique(np.frombuffer(data, "<u4"))] += 1
        return seen

    seen = summed_arrays(stored.select("grams"), spread, 1 << BUCKET_BITS)
    chosen = np.lexsort((np.arange(len(seen)), -seen))[:features]
    chosen = chosen[seen[chosen] >= 5]
    place = np.full(1 << BUCKET_BITS, len(chosen), np.int32)
    place[chosen] = np.arange(len(chosen))
    sc = docs.sparkSession.sparkContext
    place_sent = sc.broadcast(place)
    n = sum(sizes.values())

    def packed(batch):
        """The features renumbered, words without a weight dropped from the stored rows of the fit only."""
        for part in slices(batch):
            grams, lens = [], []
            for data, size in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                at, size = place_sent.value[np.frombuffer(data, "<u4")], np.frombuffer(size, "<u2")
                used = at < len(chosen)
                grams.append(at[used].astype("<u4").tobytes())
                lens.append(np.add.reduceat(used, np.cumsum(size, dtype=np.int64) - size).astype("<u2").tobytes())
            yield {"y": part.column(0), "grams": pa.array(grams, pa.binary()), "lens": pa.array(lens, pa.binary())}

    # A sample of bounded size; a few dozen rows of gradients come back in each round.
    rows = store(arrow_map(stored, "y int, grams binary, lens binary", packed).coalesce(max(2, sc.defaultParallelism)), "features")
    weights, bias = np.zeros(len(chosen)), -5.0
    first, second = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for k in range(1, rounds + 1):
        grad = _gradient(rows, weights, bias) / n
        grad[:-1] -= ridge * weights / n
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        step = rate * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.999**k)) + 1e-8)
        step *= min(1.0, 2 * (1 - (k - 1) / rounds))
        weights += step[:-1]
        bias += step[-1]
    out = np.zeros(1 << BUCKET_BITS)
    out[chosen] = weights
    place_sent.destroy()
    return SentenceModel(out, float(bias))


def _gradient(rows: DataFrame, weights: np.ndarray, bias: float) -> np.ndarray:
    """Gradient of the log-likelihood by weights, and by the bias in the last place."""
    sent = rows.sparkSession.sparkContext.broadcast((weights, bias))

    def run(batches):
        w, b = sent.value
        grad = np.zeros(len(w) + 1)
        for part in chain.from_iterable(map(slices, batches)):  # a few numbers per feature: not for whole batches
            y = part.column(0).to_numpy()
            parts = [np.frombuffer(x, "<u2") for x in part.column(2).to_pylist()]
            grams = np.frombuffer(b"".join(part.column(1).to_pylist()), "<u4")
            lens = np.concatenate(parts).astype(np.int64)
            doc = np.repeat(np.arange(len(y)), [len(p) for p in parts])
            piece = np.repeat(np.arange(len(lens)), lens)
            z = b + np.bincount(piece, w[grams], len(lens))
            odds = np.bincount(doc, np.logaddexp(0, z), len(y))  # -log P(clean)
            pull = np.where(y > 0, 1 / np.expm1(np.clip(odds, 1e-9, 500)), -1.0)
            by_piece = pull[doc] / (1 + np.exp(-z))
            grad[:-1] += np.bincount(grams, by_piece[piece], len(w))
            grad[-1] += by_piece.sum()
        yield pa.RecordBatch.from_arrays([pa.array([grad.tobytes()], pa.binary())], names=["grad"])

    total = sum((np.frombuffer(r["grad"]) for r in rows.mapInArrow(run, "grad binary").collect()), np.zeros(len(weights) + 1))
    sent.destroy()
    return total


def score_toxicity(docs: DataFrame, model: SentenceModel, id_col: str = "doc_id", text_col: str = "text",
                   least: float = 0.5) -> DataFrame:
    """Per row: id, ``score`` (noisy-or of all its sentences), ``n_sentences`` and ``offending``, the sentences
    with a probability of ``least`` or more: number, probability and text.

    Null, empty and blank texts have no sentence and score 0. Repeated rows and null ids are scored like others.
    """
    docs = only(docs, [id_col, text_col])
    kind = docs.schema[id_col].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        forget_worker_cache()
        m = sent.value
        words = WordWeights(m.weights)
        for batch in batches:
            for part in slices(batch):
                scores, sizes, found = [], [], []
                for text in part.column(1).to_pylist():
                    z, where, _ = m.pieces(words, text)
                    scores.append(float(-np.expm1(-np.logaddexp(0, z).sum())))
                    sizes.append(len(np.unique(where)))
                    p = 1 / (1 + np.exp(-z))
                    bad = np.flatnonzero(p >= least)
                    raw = text.replace(b".", b"\n").replace(b"!", b"\n").replace(b"?", b"\n").replace(b"\r", b"\n").split(b"\n") if len(bad) else []
                    found.append([{"sentence": int(where[i]), "score": float(p[i]), "text": raw[where[i]].decode("utf-8", "replace").strip()}
                                  for i in bad])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(scores, pa.float64()), pa.array(sizes, pa.int32()),
                     pa.array(found, pa.list_(pa.struct([("sentence", pa.int32()), ("score", pa.float64()), ("text", pa.string())])))],
                    names=["_id", "score", "n_sentences", "offending"])

    src = docs.select(F.col(id_col).alias("_id"), text_bytes(docs, text_col).alias("text"))
    return src.mapInArrow(run, f"_id {kind}, score double, n_sentences int, "
                               "offending array<struct<sentence:int,score:double,text:string>>").withColumnRenamed("_id", id_col)
