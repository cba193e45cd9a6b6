"""N-gram Jaccard self-join by adaptive multi-match prefixes, and the classes that its links make.

Two texts link when their sets of word shingles have a Jaccard likeness of at least ``num / den``. All sets
use one global order: rare shingles first by a hashed document frequency, ties by hash. If two sets link, the
first ``|x| - ceil(t |x|) + l`` shingles of either share at least ``l`` of them, for every ``l >= 1``. Each set
takes the ``l`` whose prefix makes the least estimated work (rows to join plus pairs to verify), and a pair is
verified only if it shares the smaller of its two ``l`` in prefixes as long as the sizes of both sets ask for.

Equal sets are one class. Sets are first compared with the one leader they share most with, so large groups of
near copies melt into one component with one comparison each; then every pair of sets of different components
that shares enough prefix shingles is compared. No link between different components is left out, and no
group is expanded into all pairs of its members. Texts are compared next to their hub, the set of a pair that
has more pairs: each text of a pair is moved there once, and hubs with many pairs are dealt to several tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fernwick.llm.common import (
    WordHashes, arrow_map, components, digest_pair, forget_worker_cache, mixed, only, shingle_hashes, split_words, store, summed_arrays,
    text_bytes,
)

SKETCH_BITS = 21
MAX_LEVEL = 8
# Work of verifying one pair, in joined rows.
VERIFY_COST = 16


def _counter(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(hashes ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)).astype(np.int64)


def _set_of(words: WordHashes, text: bytes, size: int) -> np.ndarray:
    return np.unique(shingle_hashes(words.of(split_words(text)), size))


def frequency_sketch(docs: DataFrame, text_col: str, size: int, bits: int = SKETCH_BITS) -> np.ndarray:
    """Hashed document frequencies of all shingles: ``2 ** bits`` counters, whatever the size of the corpus."""
    def count(batches):
        words, sums = WordHashes(), np.zeros(1 << bits, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                # The shingles of one text are distinct, but two of them may share a counter.
                np.add.at(sums, _counter(_set_of(words, text, size), bits), 1)
        return sums

    out = summed_arrays(docs.select(text_bytes(docs, text_col).alias("text")), count, 1 << bits)
    # Frequencies only order the shingles: 32 bits are enough, larger counts tie.
    return np.minimum(out, (1 << 32) - 1).astype(np.uint32)


def _prefixes(docs: DataFrame, id_col: str, text_col: str, size: int, num: int, den: int, sketch, bits: int, row_key: str | None) -> DataFrame:
    """Per document its id, its ``row_key``, its set's size and 128-bit digest, and the first shingles of the longest prefix."""
    def rows(batches):
        forget_worker_cache()
        words, freq = WordHashes(), sketch.value
        for batch in batches:
            n, h1, h2, prefix = [], [], [], []
            for text in batch.column(1).to_pylist():
                got = _set_of(words, text, size)
                n.append(len(got))
                if not len(got):
                    h1.append(None), h2.append(None), prefix.append(None)
                    continue
                a, b = digest_pair(got.tobytes())
                first = len(got) + (-num * len(got)) // den  # |x| - ceil(t |x|)
                order = np.lexsort((got, freq[_counter(got, bits)]))[:first + MAX_LEVEL]
                h1.append(a), h2.append(b), prefix.append(got[order].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                 pa.array(prefix, pa.binary())], names=["_id", "_key", "n", "h1", "h2", "prefix"])

    key = docs[row_key] if row_key else F.lit(None).cast("boolean")
    src = docs.select(docs[id_col].cast("long").alias("_id"), text_bytes(docs, text_col).alias("text"), key.alias("_key"))
    kind = src.schema["_key"].dataType.simpleString()
    return src.mapInArrow(rows, f"_id long, _key {kind}, n long, h1 long, h2 long, prefix binary")


def _postings(classes: DataFrame) -> DataFrame:
    """One row per prefix shingle, with its place in the global order of its set (from 0)."""
    def rows(batch):
        cid, n, token, pos = [], [], [], []
        for c, size, data in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            got = np.frombuffer(data, np.int64)
            cid.append(np.full(len(got), c)), n.append(np.full(len(got), size)), token.append(got)
            pos.append(np.arange(len(got), dtype=np.int32))
        if cid:
            yield {"cid": np.concatenate(cid), "n": np.concatenate(n), "token": np.concatenate(token),
                   "pos": np.concatenate(pos)}

    return arrow_map(classes.select("cid", "n", "prefix"), "cid long, n long, token long, pos int", rows)


def _chosen_levels(shared: DataFrame, num: int, den: int) -> DataFrame:
    """(cid, want, common): the l with the least estimated work, and how common the first shingles are. A longer
    prefix adds rows to join but divides the number of pairs that can reach l matches."""
    first = F.col("n") - F.ceil(F.col("n") * num / den)
    sums = [F.sum(F.when(F.col("pos") < first + k, F.col("df") - 1).otherwise(0)) for k in range(1, MAX_LEVEL + 1)]
    costs = shared.groupBy("cid").agg(F.array(*sums).alias("sums"))
    work = F.transform("sums", lambda x, i: x * (1 + VERIFY_COST / (i + 1)))
    return costs.select("cid", F.col("sums")[0].alias("common"),
                        F.array_position(work, F.array_min(work)).cast("int").alias("want"))


def _leader_pairs(shared: DataFrame, num: int, den: int) -> DataFrame:
    """For each set the leader it shares most with. Leaders are, per shingle and size band, the sets whose first
    shingles are the most common: the middle of a group of near copies rather than its edge."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(den / num)))) if num < den else F.col("n")
    banded = shared.withColumn("band", band)
    leaders = banded.groupBy("token", "band").agg(
        F.max_by("cid", F.struct("common", -F.col("cid"))).alias("leader"), F.count("*").alias("members"))
    led = banded.join(leaders.filter("members > 1"), ["token", "band"]).filter("cid <> leader")
    votes = led.groupBy("cid", "leader").agg(F.count("*").alias("votes"))
    best = votes.groupBy("cid").agg(F.max_by("leader", F.struct("votes", -F.col("leader"))).alias("leader"))
    return best.select(F.col("cid").alias("a"), F.col("leader").alias("b"))


def _cross_pairs(shared: DataFrame, comp: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of sets of different components that share enough prefix shingles and have fitting sizes.

    Sets of one component never meet: a set joins the other components at its shingle first, then their sets.
    """
    placed = shared.join(comp, "cid", "left").withColumn("comp", F.coalesce("root", "cid")).drop("root")
    heads = placed.groupBy("token", "comp").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    mixed_tokens = heads.groupBy("token").agg(F.count("*").alias("comps")).filter("comps > 1").select("token")
    heads = heads.join(mixed_tokens, "token").withColumnRenamed("comp", "other")
    fits = (F.col("most") * den >= F.col("n") * num) & (F.col("least") * num <= F.col("n") * den)
    met = placed.join(heads, "token").filter((F.col("comp") < F.col("other")) & fits)
    left = met.select("token", "other", F.col("cid").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"),
                      F.col("want").alias("wa"))
    right = placed.select("token", F.col("comp").alias("other"), F.col("cid").alias("b"), F.col("n").alias("nb"),
                          F.col("pos").alias("pb"), F.col("want").alias("wb"))
    need = F.least("wa", "wb")
    # Shingles that a linked pair of these sizes has in common, at least.
    common = F.ceil((F.col("na") + F.col("nb")) * num / (num + den))
    pairs = left.join(right, ["token", "other"]).filter(
        (F.least("na", "nb") * den >= F.greatest("na", "nb") * num)
        & (F.col("pa") < F.col("na") - common + need) & (F.col("pb") < F.col("nb") - common + need))
    counted = pairs.groupBy("a", "b").agg(F.count("*").alias("matches"), F.min(need).alias("need"))
    return counted.filter("matches >= need").select("a", "b")


# Pairs of one hub that a task compares before the hub is dealt to another.
HUB_ROWS = 2_000
FILTER_BITS = 20


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, size: int,
              num: int, den: int) -> DataFrame:
    """The pairs whose whole sets reach the threshold. Only texts of classes in some pair are read again."""
    ends = pairs.select(F.col("a").alias("cid")).union(pairs.select(F.col("b").alias("cid")))
    degree = store(ends.groupBy("cid").agg(F.count("*").alias("degree")), "degree")
    one = degree.select(F.col("cid").alias("a"), F.col("degree").alias("da"))
    two = degree.select(F.col("cid").alias("b"), F.col("degree").alias("db"))
    swap = F.struct("da", "a") > F.struct("db", "b")
    turned = pairs.join(one, "a").join(two, "b").select(
        F.when(swap, F.col("a")).otherwise(F.col("b")).alias("hub"), F.when(swap, F.col("b")).otherwise(F.col("a")).alias("cid"),
        F.greatest("da", "db").alias("degree"))
    parts = F.floor(F.col("degree") / HUB_ROWS).cast("int") + 1
    members = turned.select("hub", "cid", F.pmod(F.xxhash64("cid"), parts).cast("int").alias("part"))
    hubs = turned.select("hub", "degree").distinct().select(
        "hub", F.col("hub").alias("cid"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    keys = classes.select("cid", "h1", "h2", F.col("min_doc").alias("_key"))
    wanted = store(members.union(hubs).join(keys, "cid"), "wanted")

    # A filter of at most 2 ** FILTER_BITS hash values, whatever the number of pairs, keeps texts that no pair
    # needs out of the shuffle; the join after it is exact.
    def place(key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(1 << FILTER_BITS))

    places = F.broadcast(wanted.select(place("_key").alias("_place")).distinct())
    src = docs.select(docs[id_col].cast("long").alias("_key"), docs[text_col].cast("string").alias("text"))
    src = src.join(places, place("_key") == F.col("_place"), "left_semi")
    met = src.join(wanted.withColumnRenamed("_key", "_want"), F.col("_key").eqNullSafe(F.col("_want")))
    met = met.select("hub", "part", "cid", "h1", "h2", "text").repartition("hub", "part")
    met = met.sortWithinPartitions("hub", "part", F.col("cid") != F.col("hub"))

    def links(batches):
        words, at, own = WordHashes(), None, None
        for batch in batches:
            a, b = [], []
            for hub, part, cid, h1, h2, text in zip(*[batch.column(k).to_pylist() for k in range(6)]):
                got = _set_of(words, (text or "").encode(), size)
                # Rows of one document id may hold other texts; the digest tells the set that is meant.
                if digest_pair(got.tobytes()) != (h1, h2):
                    continue
                if hub == cid:
                    at, own = (hub, part), got
                elif at == (hub, part):
                    common = len(np.intersect1d(own, got, assume_unique=True))
                    if den * common >= num * (len(own) + len(got) - common):
                        a.append(hub), b.append(cid)
                else:
                    raise RuntimeError("a hub's text is missing")
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return store(met.mapInArrow(links, "a long, b long"), "links")


def ngram_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                  threshold: tuple[int, int] = (80, 100), sketch_bits: int = SKETCH_BITS, row_key: str | None = None) -> DataFrame:
    """Per row of ``docs``: id, ``n_shingles`` and ``component_id``, the smallest id reachable by links; with ``row_key``
    also that column and ``component``, a number of the component (null without shingles).

    Words are runs other than ASCII white space, with A-Z lower-cased. A text of fewer words than ``size`` is
    one shingle. Null, empty and blank texts have no shingles and link with nothing: their component is their
    own id. A null id takes part like any other; it is never the name of a component that has another id.
    Repeated rows are equal texts, hence one class; each row is returned. An empty table gives an empty one.
    """
    num, den = threshold
    if not 0 < num <= den:
        raise ValueError("the threshold must be above 0 and at most 1")
    docs = only(docs, [id_col, text_col, *([row_key] if row_key else [])])
    spark = docs.sparkSession
    sketch = spark.sparkContext.broadcast(frequency_sketch(docs, text_col, size, sketch_bits))
    rows = store(_prefixes(docs, id_col, text_col, size, num, den, sketch, sketch_bits, row_key), "sets")
    grouped = rows.filter("n > 0").groupBy("h1", "h2").agg(
        F.first("n").alias("n"), F.min("_id").alias("min_doc"), F.first("prefix").alias("prefix"))
    classes = store(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")
    names = classes.drop("prefix")

    # Made twice from the stored classes rather than stored: it is the largest table here.
    postings = _postings(classes)
    frequent = postings.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    shared = store(postings.join(frequent, "token"), "shared")
    first = F.col("n") - F.ceil(F.col("n") * num / den)
    shared = shared.join(_chosen_levels(shared, num, den), "cid").filter(F.col("pos") < first + F.col("want"))
    shared = store(shared, "chosen")

    near = _verified(store(_leader_pairs(shared, num, den), "led"), names, docs, id_col, text_col, size, num, den)
    comp = components(near)
    cross = store(_cross_pairs(shared, comp.withColumnRenamed("node", "cid"), num, den), "cross")
    if not cross.isEmpty():
        more = _verified(cross, names, docs, id_col, text_col, size, num, den)
        comp = components(near.unionByName(more))

    comp = store(comp, "components")
    linked = comp.join(names.select(F.col("cid").alias("node"), "min_doc"), "node")
    lowest = linked.groupBy("root").agg(F.min("min_doc").alias("low"))
    placed = comp.join(lowest, "root").select(F.col("node").alias("cid"), "low", "root")
    final = names.join(placed, "cid", "left").select(
        "h1", "h2", F.coalesce("low", "min_doc").alias("component_id"), F.coalesce("root", "cid").alias("component"))
    out = rows.drop("prefix").join(final, ["h1", "h2"], "left")
    more = [F.col("_key").alias(row_key), "component"] if row_key else []
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.coalesce("component_id", "_id").alias("component_id"), *more)
