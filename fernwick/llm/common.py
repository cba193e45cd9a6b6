"""Helpers shared by the operators of this folder: stored tables, Arrow maps, word hashes, components."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fernwick.session import scratch_path


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back: lineage ends here, and several
    readers do not compute it again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, text_col: str) -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(df[text_col].cast("string"), F.lit("")).cast("binary")


def arrow_map(df: DataFrame, schema: str, fn: Callable[[pa.RecordBatch], Iterable[dict]]) -> DataFrame:
    """Apply ``fn`` to each batch; it yields dictionaries of columns (arrays of one length)."""
    names = [f.name for f in df.sparkSession.createDataFrame([], schema).schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cols in fn(batch):
                yield pa.RecordBatch.from_arrays([_array(cols[n]) for n in names], names=names)

    return df.mapInArrow(run, schema)


def _array(values) -> pa.Array:
    return values if isinstance(values, (pa.Array, pa.ChunkedArray)) else pa.array(values)


def worker_cache(name: str, make: Callable):
    """One object per Python worker process, kept for the tasks that run in it one after the other. Only for
    things that a task could make again, such as vocabularies and words already encoded."""
    kept = sys.modules.setdefault("_fernwick_worker", types.ModuleType("_fernwick_worker")).__dict__
    if name not in kept:
        forget_worker_cache(name.split()[0])
        kept[name] = make()
    return kept[name]


def forget_worker_cache(kind: str = "") -> None:
    """Free what `worker_cache` has kept in this process under names that begin with ``kind``: before another one of its
    kind, and in tasks that need the memory for other things."""
    kept = sys.modules.setdefault("_fernwick_worker", types.ModuleType("_fernwick_worker")).__dict__
    names = [n for n in kept if not n.startswith("__") and n.startswith(kind)]
    for name in names:
        del kept[name]
    if names:
        gc.collect()  # encoders hold cycles, which stay until they are looked for
    # The C library's call, where it has one: else what earlier tasks have freed stays with the process.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def summed_arrays(df: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int) -> np.ndarray:
    """Add up one whole-number array of fixed ``size`` per task of ``df``.

    Each task counts into one array and hands it on in chunks; these are added up by key in two rounds, so
    that no task adds up what all tasks have counted. Only the ``size`` sums reach the driver.
    """
    width = -(-size // CHUNKS)
    schema = "chunk int, counts binary"

    def rows(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([_pack(s) for s in sums.values()], pa.binary())],
                names=["chunk", "counts"])

    def first(batches):
        sums = np.pad(count(batches), (0, width * CHUNKS - size))
        yield from rows({k: part for k, part in enumerate(np.split(sums, CHUNKS)) if part.any()})

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = _unpack(counts, width)
                sums[chunk] = sums[chunk] + part if chunk in sums else part
        yield from rows(sums)

    parts = df.mapInArrow(first, schema).withColumn("salt", F.spark_partition_id() % 32)
    half = parts.repartition("salt", "chunk").drop("salt").mapInArrow(add, schema)
    out = np.zeros((CHUNKS, width), np.int64)
    for r in half.repartition("chunk").mapInArrow(add, schema).collect():
        out[r["chunk"]] += _unpack(r["counts"], width)
    return out.reshape(-1)[:size]


CHUNKS = 64


def _pack(counts: np.ndarray) -> bytes:
    """Counts in the narrowest width that holds them; the first byte is that width."""
    top = int(counts.max(initial=0))
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def _unpack(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", n, 1).astype(np.int64)


class WordHashes(dict):
    """64-bit hashes of words, kept for words seen before; emptied when it grows beyond ``limit`` words."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def split_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased: just what splitting bytes does."""
    return text.lower().split()


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (finalizer of a multiplicative generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, in text order; a shorter text gives one hash of all its words."""
    if not len(words):
        return words
    width = min(size, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[k:k + n])
    return out


def digest_pair(data: bytes) -> tuple[int, int]:
    """128-bit digest as two signed 64-bit integers."""
    d = xxhash.xxh3_128_digest(data)
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def hash_fraction(col: Column, mod: int) -> Column:
    """crc32 of the value as text, modulo ``mod``; 0 for null."""
    return F.coalesce(F.crc32(col.cast("string")) % mod, F.lit(0))


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components as (``node``, ``root``): root is the smallest node. Only linked nodes appear.

    Alternates two steps until nothing changes: every node links its larger neighbours to its smallest one,
    then its smaller neighbours (large star, small star). Hubs are joined by key, so adaptive execution can
    split them, and minima are aggregated before the shuffle.
    """
    edges = store(_edges(links.select(F.col(a).alias("u"), F.col(b).alias("v"))), "edges")
    last = None
    for _ in range(max_rounds):
        edges = _star(edges, larger=True)
        edges = store(_star(edges, larger=False), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == last:
            break
        last = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _edges(links: DataFrame) -> DataFrame:
    """Each link once, from the larger to the smaller node."""
    return links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """edges: (u, v) with u > v. ``larger``: each node links its larger neighbours to its smallest neighbour;
    else its smaller ones and itself."""
    if larger:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        moved = near.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return _edges(moved)
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _edges(moved.unionByName(low.select("u", F.col("m").alias("v"))))


def only(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns alone, so that extra columns cannot clash with those made here."""
    return df.select(*[df[n] for n in names])
