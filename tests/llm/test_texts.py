"""Language model, counts, encodings, packing and fingerprints against plain versions."""

import hashlib
import math
import random
import uuid
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fernwick.llm import bpe, brown, edit_counts, keyed_store, order_minhash, packing
from tests.llm.fixtures import BYTE_BPE, WORD_BPE, awkward_rows, empty, table, words

ROWS = awkward_rows()


def same(got, want):
    assert sorted(map(str, got)) == sorted(map(str, want))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


def test_encode_and_decode_equal_the_library(spark, library):
    want = [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in ROWS]
    for leaf, spread in ((2048, 1 << 16), (16, 50)):
        out = bpe.decode_ids(bpe.encode_texts(table(spark, ROWS), BYTE_BPE, leaf=leaf, spread=spread), BYTE_BPE).collect()
        same([(r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in out], want)
        same([r.decoded for r in out], [library.decode(ids, skip_special_tokens=False) for _, ids in want])
    assert bpe.encode_texts(empty(spark), BYTE_BPE).count() == 0


def test_round_trip_digests(spark, library):
    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()

    want = []
    for i, t in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    same(map(tuple, bpe.round_trip_digests(table(spark, ROWS), BYTE_BPE, leaf=16, spread=50).collect()), want)


def test_tree_concatenation_is_exact():
    enc, r = bpe.Encoder(bpe.read_tokenizer(BYTE_BPE), leaf=8), random.Random(3)
    cases = ["".join(r.choice("abtheiné") for _ in range(r.randint(1, 200))) for _ in range(300)]
    for word in cases + ["a" * 500, "ab" * 333, "aaab" * 99]:
        spelt = "".join(enc.chars[b] for b in word.encode())
        assert enc.tree(spelt) == enc.direct(spelt)


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_chunks_equal_whole_texts(path):
    enc, r = bpe.Encoder(bpe.read_tokenizer(path)), random.Random(4)
    for _ in range(1500):
        text = "".join(r.choice(" \n\tabAB1'.,éÉßÿ×÷µ\xadİ你́<|>sΣ\x1c\x85\xa0") for _ in range(r.randint(0, 40)))
        chunks = bpe.CUT.findall(text) if path == BYTE_BPE else text.encode().split()
        got = np.frombuffer(b"".join(enc.ids_of(chunks)), "<u4").tolist()
        assert got == enc.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_edits_keep_counts_exact(library):
    enc, r = bpe.Encoder(bpe.read_tokenizer(BYTE_BPE)), random.Random(5)
    count = edit_counts._counter(enc)
    for _ in range(150):
        text = "".join(r.choice("ab c\n d.,é  1'st\xa0") for _ in range(r.randint(0, 200)))
        leaves = edit_counts._leaves(text, 12)
        tree = edit_counts.SegmentTree(leaves, [count(x) for x in leaves])
        for _ in range(5):
            start, drop = r.randint(0, len(text) + 3), r.randint(0, 30)
            put = "".join(r.choice("ab c\n .") for _ in range(r.randint(0, 8)))
            tree.edit(start, drop, put, count)
            start = min(start, len(text))
            text = text[:start] + put + text[start + drop:]
            assert "".join(tree.leaves) == text
            assert tree.tokens[1] == len(library.encode(text, add_special_tokens=False).ids)


def test_edit_tables(spark, library):
    docs = table(spark, ROWS)
    trees = edit_counts.build_trees(docs, BYTE_BPE, leaf=64)
    same([(r.doc_id, r.n_tokens) for r in trees.collect()],
         [(i, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS])
    edits = [(i, k, (i * 7 + k) % 50, k % 4, f" put{k}") for i in (1, 2, 200, 207, 999) for k in range(5)]
    rows = spark.createDataFrame(edits, "doc_id long, seq int, start int, drop int, put string")
    stamps = rows.withColumn("seq", F.col("seq") * 10**12 - 3 * 10**12)  # as far apart as time stamps
    want = []
    for i, t in ROWS:
        t = t or ""
        for _, _, start, drop, put in [e for e in edits if e[0] == i]:
            start = min(start, len(t))
            t = t[:start] + put + t[start + drop:]
        want.append((i, t, len(library.encode(t, add_special_tokens=False).ids)))
    for at_once in (2, 100):
        out = edit_counts.apply_edit_table(trees, rows, BYTE_BPE, at_once=at_once).collect()
        same([(r.doc_id, "".join(r.leaves), r.n_tokens) for r in out], want)
    out = edit_counts.apply_edit_table(trees, stamps, BYTE_BPE, at_once=3).collect()
    same([(r.doc_id, "".join(r.leaves), r.n_tokens) for r in out], want)
    assert edit_counts.build_trees(empty(spark), BYTE_BPE).count() == 0


def test_long_edits_encode_little(spark):
    text = " ".join(f"word{k}" for k in range(20_000))
    trees = edit_counts.build_trees(spark.createDataFrame([(1, text)], "doc_id long, text string"), BYTE_BPE)
    edits = F.array(F.struct(F.lit(50_000).alias("start"), F.lit(3).alias("drop"), F.lit("new").alias("put")))
    row = edit_counts.apply_edits(trees.withColumn("edits", edits), BYTE_BPE).first()
    assert 0 < row.encoded_chars < 3_000


def test_brown_base_and_counts(spark):
    rows = ROWS * 2
    docs = table(spark, rows)
    train = docs.filter("doc_id % 3 <> 0")
    setup = brown.Setup(classes=8, clustered=20, shapes=8, looked_up=30, sweeps=3)
    got = {}
    for r in brown.score_texts(docs, train, setup=setup).collect():
        got.setdefault(r.doc_id, []).append(r)
    counts = Counter()
    for i, t in rows:
        if i is not None and i % 3:
            counts.update([*words(t), None])
    total, distinct = sum(counts.values()), len(counts)
    for i, t in rows:
        own = [*words(t), None]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        known = sum(counts[w] > 0 for w in own)
        assert any(r.n_tokens == len(own) and r.n_known == known and r.train_tokens == total
                   and abs(r.base_score - base) < 1e-6 and r.score < 0 for r in got[i])
    assert sum(map(len, got.values())) == len(rows)


def test_brown_is_a_distribution(spark):
    """Probabilities of all next words, one unseen word for each class included, add up to 1."""
    text = [(k, t) for k, t in enumerate(["a b c", "a b", "c a", "b c a b"])]
    setup = brown.Setup(classes=3, clustered=4, shapes=1, looked_up=4, sweeps=2)
    docs = spark.createDataFrame(text, "doc_id long, text string")
    asked = spark.createDataFrame([(k, t) for k, t in enumerate(["", "a", "b", "c", "unseen"])], "doc_id long, text string")
    score = {r.doc_id: r.score for r in brown.score_texts(asked, docs, setup=setup).collect()}
    assert all(s < 0 for s in score.values())
    more = brown.score_texts(docs, docs, setup=setup)
    assert more.filter("score > base_score").count() >= 1


def test_brown_without_training(spark):
    out = brown.score_texts(table(spark, ROWS), empty(spark)).collect()
    assert len(out) == len(ROWS) and all(r.n_known == 0 and math.isfinite(r.score) for r in out)
    assert brown.score_texts(empty(spark), table(spark, ROWS)).count() == 0


def test_store_round_trip(spark, tmp_path):
    path, lib = f"{tmp_path}/{uuid.uuid4().hex}", Tokenizer.from_file(WORD_BPE)
    keyed_store.write_store(table(spark, ROWS), WORD_BPE, path, block_ids=100)
    ids = [(i, lib.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in ROWS]
    got = keyed_store.indexed_rows(table(spark, ROWS), path, "doc_id").orderBy("start").collect()
    same([(r.key, r.n_tokens, r.ids_crc32) for r in got], [(i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids])
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    keys = [-1 if r.key is None else r.key for r in got]
    assert keys == sorted(keys)
    asked = spark.createDataFrame([(3,), (100,), (None,), (-77,)], "key long")
    read = {r.key: np.frombuffer(r.ids, "<u4").tolist() for r in keyed_store.read_keys(asked, path).collect()}
    assert set(read) == {3, 100, None} and (100, read[100]) in ids and (None, read[None]) in ids
    assert keyed_store.look_up(asked, path).filter("not found").count() == 1
    some = keyed_store.indexed_rows(asked.filter("key is null or key > 0"), path).collect()
    same([(r.key, r.start, r.n_tokens, r.ids_crc32) for r in some], [(r.key, r.start, r.n_tokens, r.ids_crc32) for r in got if r.key in (3, 100, None)])
    with pytest.raises(Exception, match="misses a key"):
        keyed_store.indexed_rows(asked, path).collect()
    keyed_store.write_store(empty(spark), WORD_BPE, f"{path}-empty")
    assert keyed_store.indexed_rows(empty(spark), f"{path}-empty", "doc_id").count() == 0


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 3000])
def test_perfect_hash(n):
    keys = np.random.default_rng(n).choice(1 << 40, n, replace=False).astype(np.int64)
    seeds, slots = keyed_store.perfect_hash(keys)
    assert sorted(slots) == list(range(n))
    assert (keyed_store.find_slots(keys, seeds, n) == slots).all()


def test_best_bounds_against_all_choices():
    from itertools import combinations

    r = random.Random(6)
    for _ in range(40):
        tops = sorted(r.sample(range(1, 60), r.randint(1, 8)))
        bins = [(t, r.randint(1, 9), 0) for t in tops]

        def padded(bounds):
            return sum(min(b for b in bounds if b >= t) * n for t, n, _ in bins)

        k = r.randint(1, 5)
        best = min(padded([*c, tops[-1]]) for j in range(min(k, len(tops))) for c in combinations(tops[:-1], j))
        bounds = packing.best_bounds(bins, k)
        assert padded(bounds) == best and len(bounds) <= k and bounds[-1] == tops[-1]


def test_packing(spark, library):
    lengths = packing.token_lengths(table(spark, ROWS), BYTE_BPE)
    same([(r.doc_id, r.length) for r in lengths.collect()], [(i, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS])
    out = packing.pack_by_length(lengths, buckets=4, budget=500).collect()
    assert len(out) == len(ROWS)
    batches = {}
    for r in out:
        assert r.padding == r.bucket_length - r.length >= 0
        batches.setdefault(r.batch, []).append(r)
    assert sorted(batches) == list(range(len(batches)))
    for rows in batches.values():
        assert len({r.bucket for r in rows}) == 1 and sorted(r.slot for r in rows) == list(range(len(rows)))
        assert len(rows) == 1 or len(rows) * rows[0].bucket_length <= 500
    assert packing.pack_by_length(lengths.filter("false")).count() == 0
    same(map(tuple, packing.pack_by_length(spark.createDataFrame([(1, None)], "doc_id long, length long")).collect()), [(1, 0, 0, 0, 0, 0, 0)])


def test_edited_texts_and_likeness(spark):
    rows = [r for r in ROWS if r[0] not in (None, 0, 41)]
    out = {r.doc_id: r for r in order_minhash.fingerprint_edits(table(spark, rows)).collect()}
    rows = sorted((i, t or "") for i, t in rows)
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        q = len(t) // 4
        edited = t[:len(t) - q] + after[:q]
        assert out[i].n_chars == len(t) and out[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= out[i].near_next <= 1 and 0 <= out[i].near_edited <= 1
        assert (t != edited) or out[i].near_edited == 1.0
    assert out[100].fingerprint == out[106].fingerprint != out[101].fingerprint
    assert order_minhash.fingerprint_edits(table(spark, ROWS)).count() == len(ROWS)
    assert order_minhash.fingerprint_edits(empty(spark)).count() == 0


def test_signature_against_a_plain_version(spark):
    """Occurrence numbers, bins and text order, with the engine's own hashes looked up from it."""
    texts = ["a b a b a b a b c", "c b a", "x", "", "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3]
    df = order_minhash.signature(spark.createDataFrame([(t,) for t in texts], "t string"), "t", "sig")
    sigs = [r.sig for r in df.collect()]
    mask = (1 << 64) - 1

    def bins(sig):
        return [(x & mask) >> 58 for x in sig]

    assert all(len(set(bins(s))) == len(s) for s in sigs) and sigs[3] == [] and len(sigs[2]) == 1
    moved = order_minhash.signature(spark.createDataFrame([(texts[4],), (" ".join(texts[4].split()[39:] + texts[4].split()[:39]),)], "t string"), "t", "sig")
    a, b = (r.sig for r in moved.collect())
    # The same k-mers but for the seams, in another order: some tuples stay, some change.
    assert set(bins(a)) & set(bins(b)) and set(a) != set(b)
