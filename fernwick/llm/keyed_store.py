"""Token ids on disk with keyed access: a minimal perfect hash index over raw id payloads.

A store is a folder of three tables. ``payload`` holds blocks of raw little-endian 32-bit ids, in ascending
order of the document ids, with a directory of each block. ``shards`` holds the number of ids before each
shard. ``index`` maps keys to places: keys are dealt to buckets by hash, and each bucket has a minimal perfect
hash (seeds per group of keys, found by trying) that gives every key a slot of its own, with a stored
fingerprint that tells foreign keys apart. A look-up reads one bucket, two numbers and one slot.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fernwick.llm.bpe import encoder, read_tokenizer, slices
from fernwick.llm.common import arrow_map, mixed, only, store

BUCKET_KEYS = 1_000
GROUP_KEYS = 4
# Fixed value: stands for a null key inside the index.
NULL_KEY = -(1 << 63)
_TABLES = ("payload", "shards", "index")


def _hashes(keys: np.ndarray, seed: int | np.ndarray) -> np.ndarray:
    return mixed(keys.astype("<i8").view(np.uint64) ^ mixed(np.atleast_1d(np.asarray(seed, np.uint64)) + np.uint64(0x9E3779B97F4A7C15)))


def perfect_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds of the groups, and the slot of each of the distinct keys: all slots 0..n-1, each once.

    Groups are settled from the largest; a group takes the first seed that sends its keys to free slots.
    """
    n = len(keys)
    groups = -(-n // GROUP_KEYS)
    group = (_hashes(keys, 0) % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    bounds = np.searchsorted(group[order], np.arange(groups + 1))
    free = np.ones(n, bool)
    seeds, slots = np.zeros(groups, np.uint32), np.zeros(n, np.int64)
    for g in np.lexsort((np.arange(groups), -np.diff(bounds))):
        own = order[bounds[g]:bounds[g + 1]]
        if not len(own):
            break
        first, found = 1, None
        while found is None:
            tried = np.arange(first, first + 256, dtype=np.uint64)
            to = (_hashes(keys[own][None], tried[:, None]) % np.uint64(n)).astype(np.int64)
            fits = free[to].all(1)
            if len(own) > 1:
                fits &= (np.diff(np.sort(to, 1), axis=1) > 0).all(1)
            if fits.any():
                found = int(np.argmax(fits))
            else:
                first += 256
                if first >= 1 << 32:
                    raise RuntimeError("no seed fits")
        seeds[g] = tried[found]
        slots[own] = to[found]
        free[to[found]] = False
    return seeds, slots


def find_slots(keys: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    group = (_hashes(keys, 0) % np.uint64(len(seeds))).astype(np.int64)
    return (_hashes(keys, seeds[group].astype(np.uint64)) % np.uint64(n)).astype(np.int64)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_hashes(keys, (1 << 40) + 7) >> np.uint64(32)).astype(np.uint32)


def _bucket(key, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("long")


def write_store(docs: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id", text_col: str = "text",
                end_id: int = 2, block_ids: int = 1 << 18) -> None:
    """Encode every whole text, append ``end_id``, and write payload, shard starts and index below ``path``.

    Ids must be whole numbers; null is a key like any other, first in order; the smallest 64-bit number is not
    allowed as an id. Rows of one id are written one after the other, by text, and the index holds the place of
    the first and their number. Null and empty texts consist of the end id. An empty table gives an empty store.
    """
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(read_tokenizer(tokenizer))
    docs = only(docs, [id_col, text_col])
    src = docs.select(docs[id_col].cast("long").alias("key"), F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary").alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The text hash and the row number deal out rows of one id, too; equal rows may take any order.
    tie = [F.xxhash64("text"), F.monotonically_increasing_id()]
    dealt = src.select("key", "text", tie[0].alias("t1"), tie[1].alias("t2")).repartitionByRange(n, "key", "t1", "t2")
    ranged = dealt.sortWithinPartitions("key", "t1", "t2").select("key", "text")
    end = np.array([end_id], "<u4").tobytes()

    def blocks(batches):
        enc = encoder(spec.value)
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        keys, sizes, data, held = [], [], [], 0

        def flush():
            nonlocal block, before, keys, sizes, data, held
            row = [shard, block, before, held, keys, np.array(sizes, "<u4").tobytes(), b"".join(data)]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)
            block, before, keys, sizes, data, held = block + 1, before + held, [], [], [], 0

        for batch in batches:
            for part in slices(batch):
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = b"".join(enc.ids_of(text.split())) + end
                    keys.append(key), sizes.append(len(ids) // 4), data.append(ids)
                    held += len(ids) // 4
                    if held >= block_ids:
                        yield from flush()
        if keys:
            yield from flush()

    names = ["shard", "block", "before", "n_ids", "keys", "sizes", "ids"]
    schema = "shard int, block int, before long, n_ids long, keys array<long>, sizes binary, ids binary"
    ranged.mapInArrow(blocks, schema).write.option("compression", "zstd").parquet(f"{path}/payload")
    payload = spark.read.parquet(f"{path}/payload")
    # One row per shard: as many as there are shuffle partitions.
    sums = payload.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"), F.sum(F.size("keys")).alias("rows"))
    w = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sums.select("shard", F.coalesce(F.sum("n_ids").over(w), F.lit(0)).alias("start"), "n_ids", "rows").write.parquet(f"{path}/shards")
    _write_index(spark, path)


def _directory(spark: SparkSession, path: str) -> DataFrame:
    """Every row of the store: ``key`` (`NULL_KEY` for null), ``shard``, ``block``, ``place`` and ``n_ids``. The ids
    themselves are not read."""
    payload = spark.read.parquet(f"{path}/payload").select("shard", "block", "keys", "sizes")

    def run(batch):
        for shard, block, keys, sizes in zip(*[batch.column(k).to_pylist() for k in range(4)]):
            size = np.frombuffer(sizes, "<u4").astype(np.int64)
            at = np.cumsum(size) - size
            yield {"key": pa.array([NULL_KEY if k is None else k for k in keys], pa.int64()), "shard": np.full(len(keys), shard, np.int32),
                   "block": np.full(len(keys), block, np.int32), "place": at, "n_ids": size}

    return arrow_map(payload, "key long, shard int, block int, place long, n_ids long", run)


def _write_index(spark: SparkSession, path: str) -> None:
    rows = _directory(spark, path)
    first = rows.groupBy("key").agg(F.min(F.struct("shard", "block", "place", "n_ids")).alias("at"), F.count("*").alias("rows"))
    total = spark.read.parquet(f"{path}/shards").agg(F.sum("rows")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_KEYS))

    def build(table: pa.Table) -> pa.Table:
        keys = table["key"].to_numpy()
        seeds, slots = perfect_hash(keys)
        order = np.argsort(slots)
        out = {"bucket": table["bucket"][:1], "seeds": [seeds.astype("<u4").tobytes()],
               "prints": [fingerprints(keys)[order].astype("<u4").tobytes()]}
        for name, kind in (("shard", "<i4"), ("block", "<i4"), ("place", "<i8"), ("n_ids", "<i8"), ("rows", "<i8")):
            out[name] = [table[name].to_numpy()[order].astype(kind).tobytes()]
        return pa.table(out)

    placed = first.select(_bucket(F.col("key"), buckets).alias("bucket"), "key", "at.*", "rows")
    placed.groupBy("bucket").applyInArrow(
        build, "bucket long, seeds binary, prints binary, shard binary, block binary, place binary, n_ids binary, rows binary"
    ).withColumn("buckets", F.lit(buckets)).write.parquet(f"{path}/index")


def look_up(keys: DataFrame, path: str, key_col: str = "key") -> DataFrame:
    """Distinct keys with ``found``, and where their first row lies: ``shard``, ``block``, ``place`` (ids before
    it in the block), ``n_ids``, and ``rows``, the number of rows of the key. A foreign key is taken for a stored
    one with a probability of 2 ** -32."""
    spark = keys.sparkSession
    index = spark.read.parquet(f"{path}/index")
    top = index.select("buckets").first()
    asked = keys.select(F.coalesce(keys[key_col].cast("long"), F.lit(NULL_KEY)).alias("key")).distinct()
    asked = asked.withColumn("bucket", _bucket(F.col("key"), top[0] if top else 1))
    fields = (("shard", "<i4"), ("block", "<i4"), ("place", "<i8"), ("n_ids", "<i8"), ("rows", "<i8"))

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        got = left["key"].to_numpy()
        out = {"key": pa.array(got, mask=got == NULL_KEY)}
        if not len(right) or not len(got):
            return pa.table({**out, "found": np.zeros(len(got), bool), **{f: pa.nulls(len(got), pa.from_numpy_dtype(np.dtype(k))) for f, k in fields}})
        entry = {c: right[c][0].as_py() for c in ("seeds", "prints", *[f for f, _ in fields])}
        prints = np.frombuffer(entry["prints"], "<u4")
        slot = find_slots(got, np.frombuffer(entry["seeds"], "<u4"), len(prints))
        hit = prints[slot] == fingerprints(got)
        return pa.table({**out, "found": hit, **{f: pa.array(np.frombuffer(entry[f], k)[slot], mask=~hit) for f, k in fields}})

    return asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(
        find, "key long, found boolean, shard int, block int, place long, n_ids long, rows long")


def read_keys(keys: DataFrame, path: str, key_col: str = "key") -> DataFrame:
    """Keys that are stored, with the ids (``ids``, little-endian 32-bit) of their first row, sliced from the
    blocks that the index names."""
    spark = keys.sparkSession
    at = look_up(keys, path, key_col).filter("found").select("key", "shard", "block", "place", "n_ids")
    blocks = spark.read.parquet(f"{path}/payload").select("shard", "block", F.col("ids").alias("_ids"))
    cut = F.substring(F.col("_ids"), (F.col("place") * 4 + 1).cast("int"), (F.col("n_ids") * 4).cast("int"))
    return at.join(blocks, ["shard", "block"]).select("key", cut.alias("ids"))


def indexed_rows(keys: DataFrame, path: str, key_col: str = "key") -> DataFrame:
    """Every stored row of the keys: ``key``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids_crc32``, the
    unsigned crc32 of its ids.

    The index names block, place and length of each key's row; the places of one block are gathered, the block is
    read once, and the ids are cut out there. Rows of a key that has several follow its first one; the directory
    tells where. A key that the index does not hold is an error.
    """
    spark = keys.sparkSession
    at = store(look_up(keys, path, key_col), "places")
    held = F.when(F.col("found"), F.col("shard")).otherwise(F.raise_error(F.lit("the index misses a key")).cast("int"))
    key = F.coalesce("key", F.lit(NULL_KEY)).alias("key")
    places = at.filter("rows = 1 or not found").select(key, held.alias("shard"), "block", "place", "n_ids")
    again = at.filter("rows > 1").select(key)
    places = places.unionByName(_directory(spark, path).join(again, "key", "left_semi"))
    # A block holds so many rows at most, whatever the number of rows of one key.
    wanted = places.groupBy("shard", "block").agg(F.collect_list(F.struct("key", "place", "n_ids")).alias("wanted"))
    starts = F.broadcast(spark.read.parquet(f"{path}/shards").select("shard", "start"))  # one row per shard
    blocks = spark.read.parquet(f"{path}/payload").select("shard", "block", "before", "ids")
    met = wanted.join(blocks, ["shard", "block"]).join(starts, "shard").select((F.col("start") + F.col("before")).alias("start"), "wanted", "ids")

    def run(batch):
        for start, wanted, ids in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            found = pa.StructArray.from_arrays(wanted.values.flatten(), ["key", "place", "n_ids"])
            place, size = found.field("place").to_numpy(), found.field("n_ids").to_numpy()
            view = memoryview(ids.as_buffer())
            own = found.field("key").to_numpy()
            yield {"key": pa.array(own, mask=own == NULL_KEY), "start": start + place, "n_tokens": size,
                   "ids_crc32": pa.array([zlib.crc32(view[4 * a:4 * b]) for a, b in zip(place, place + size)], pa.int64())}

    return arrow_map(met, "key long, start long, n_tokens long, ids_crc32 long", run)
