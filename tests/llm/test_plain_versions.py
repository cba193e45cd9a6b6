"""Order MinHash and the noisy-or model against plain statements of their rules."""

import random
import re
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fernwick.llm import order_minhash, toxicity
from tests.llm.fixtures import awkward_rows

MASK = (1 << 64) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def h(*values):
    """Spark's hash of strings, 64-bit and 32-bit numbers, one after the other."""
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else struct.pack("<i", v[0]) if isinstance(v, tuple) else struct.pack("<q", signed(v & MASK))
        seed = xxhash.xxh64_intdigest(data, seed=seed)
    return seed


def plain_signature(text, k=3):
    words = [h(w) for w in re.findall(r"[^\x20\x09-\x0D]{1,16}", text)]
    size = max(len(words) - k + 1, 1)
    kmers = words[:size]
    for j in range(1, k):
        kmers = [h(a, words[i + j] if i + j < len(words) else 0) for i, a in enumerate(kmers)]
    low = (1 << order_minhash.PLACE_BITS) - 1
    placed = sorted(signed(x & ~low & MASK | i & low) for i, x in enumerate(kmers))
    elements, number = [], 0
    for i, x in enumerate(placed):
        number = number + 1 if i and placed[i - 1] & ~low == x & ~low else 0
        elements.append(signed(h(x & ~low, (number,)) & ~low & MASK | x & low))
    elements.sort()
    bins = {}
    for x in elements:
        bins.setdefault((x & MASK) >> 64 - order_minhash.BIN_BITS, []).append(x)
    out = []
    for b, xs in bins.items():
        first = sorted(xs[:2], key=lambda x: x & low) if len(xs) > 1 else xs
        hashed = h(*[(x & MASK) >> order_minhash.PLACE_BITS for x in first])
        out.append(signed(b << 64 - order_minhash.BIN_BITS | hashed >> order_minhash.BIN_BITS))
    return out


def test_signature_is_what_the_rules_say(spark):
    r = random.Random(3)
    texts = [t or "" for _, t in awkward_rows()] + ["a b", "x " * 500, "漢" * 70, " ".join(str(r.randint(0, 9)) for _ in range(3000)), "w" * 1_200_000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    got = {x.i: x.sig for x in order_minhash.signature(df, "t", "sig").collect()}
    for i, t in enumerate(texts):
        assert sorted(got[i]) == sorted(plain_signature(t))


def test_likeness_follows_order(spark):
    r = random.Random(4)
    words = [f"w{r.randint(0, 400)}" for _ in range(600)]
    moved = words[300:] + words[:300]
    shuffled = r.sample(words, 600)
    edited = [f"new{k}" if k % 60 == 7 else w for k, w in enumerate(words)]
    texts = [words, words, edited, moved, shuffled]
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(texts)], "i int, t string")
    sig = {x.i: x.sig for x in order_minhash.signature(df, "t", "sig").collect()}
    pairs = spark.createDataFrame([(k, sig[0], sig[k]) for k in range(1, 5)], "k int, a array<long>, b array<long>")
    near = {x.k: x.n for x in pairs.select("k", order_minhash.likeness(F.col("a"), F.col("b")).alias("n")).collect()}
    bins = lambda s: {x & MASK: (x & MASK) >> 58 for x in s}
    for k in range(1, 5):
        filled = set(bins(sig[0]).values()) | set(bins(sig[k]).values())
        assert near[k] == pytest.approx(len(set(sig[0]) & set(sig[k])) / len(filled))
    # Ten of 600 words changed cost little; halves that change places keep the k-mers but turn about half of the tuples.
    assert near[1] == 1 and near[2] > 0.75 and 0.2 < near[3] < 0.8 and near[4] < 0.1


def sentences(r, n):
    rows = []
    for _ in range(n):
        lens = [r.randint(1, 5) for _ in range(r.randint(1, 4))]
        rows.append((r.randint(0, 1), [r.randrange(6) for _ in range(sum(lens))], lens))
    return rows


def plain_log_likelihood(rows, w, b):
    total = 0.0
    for y, grams, lens in rows:
        clean, at = 1.0, 0
        for n in lens:
            clean *= 1 - 1 / (1 + np.exp(-(b + sum(w[g] for g in grams[at:at + n]))))
            at += n
        total += np.log(1 - clean) if y else np.log(clean)
    return total


def test_gradient_of_the_noisy_or(spark):
    r = random.Random(5)
    rows = sentences(r, 60)
    df = spark.createDataFrame([(y, bytearray(np.array(g, "<u4").tobytes()), bytearray(np.array(n, "<u2").tobytes())) for y, g, n in rows],
                               "y int, grams binary, lens binary").repartition(3)
    w, b = np.array([0.5, -1.0, 0.3, 2.0, -0.2, 0.1]), -1.5
    got = toxicity._gradient(df, w, b)
    step = 1e-5
    for k in range(7):
        move = np.zeros(7)
        move[k] = step
        rise = plain_log_likelihood(rows, w + move[:6], b + move[6]) - plain_log_likelihood(rows, w - move[:6], b - move[6])
        assert got[k] == pytest.approx(rise / (2 * step), rel=1e-5, abs=1e-6)


def test_scores_are_noisy_ors(spark):
    rng = np.random.default_rng(6)
    model = toxicity.SentenceModel(rng.normal(0, 0.3, 1 << toxicity.BUCKET_BITS), -2.0)
    texts = ["One two three. Four five!\nSix", "one", "", " . ! ", "word " * 200, "a b? c d. a b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.score for x in toxicity.score_toxicity(df, model).collect()}
    hashes = toxicity.WordHashes()
    for i, t in enumerate(texts):
        clean = 1.0
        for s in re.split(r"[.!?\n\r]", t.lower()):
            words = s.split()
            for at in range(0, len(words), toxicity.LONGEST):
                z = model.bias + sum(model.weights[toxicity._features(hashes, [w.encode()])].sum() for w in words[at:at + toxicity.LONGEST])
                clean *= 1 - 1 / (1 + np.exp(-z))
        assert got[i] == pytest.approx(1 - clean, abs=1e-9)
