"""Vectors in cells: a stored index that is fitted once and searched by many query sets.

Centres are fitted on a bounded sample; every vector is stored with its nearest centre's cell. A cell keeps its
radius, so the triangle inequality bounds how near any of its vectors can be to a query. A search meets the cells
in the order of that bound and leaves out those that provably hold nothing nearer than the k-th neighbour known so
far: exact neighbours, and cells that cannot matter are never read or shuffled. With ``probes`` it stops after so
many cells instead.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fernwick.operators import vectors as V
from fernwick.session import scratch_path, spread, written

# Rows that centres are fitted on, about, and the most cells: 4,096 of 500 doubles are 16 MB in every task.
SAMPLE_ROWS = 32_768
MAX_CELLS = 4_096
# Vectors of one tile of cells, and queries to it, that meet in one step: 32,768 of 64 doubles are 16 MB.
BLOCK_ROWS = 32_768
# Rows of a batch of queries on their way to tiles, and rows of a block inside a cell.
SENT_ROWS = 8_192
SMALL_BLOCK = 16
# Bounds are kept this far away from deciding on rounding errors.
SLACK = 1e-6


def _ready(m: np.ndarray, metric: str) -> np.ndarray:
    return m if metric == "euclidean" else V._unit(m)


def _apart(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Distances that obey the triangle inequality: lengths, or angles of unit vectors."""
    if metric == "euclidean":
        return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0))
    return np.arccos(np.clip(a @ b.T, -1.0, 1.0))


def _as_apart(distance: np.ndarray, metric: str) -> np.ndarray:
    """A distance of the metric as length or angle."""
    return np.arccos(np.clip(1 - distance, -1.0, 1.0)) if metric == "cosine" else distance


@dataclass(frozen=True)
class CellIndex:
    """A stored index: rows at ``path`` + ``/rows``, cells at ``path`` + ``/cells``. Vectors of length zero have no
    direction and lie in the last cell, which every search by angle meets."""

    path: str
    id_col: str
    vec: str
    metric: str
    centres: np.ndarray
    radius: np.ndarray
    count: np.ndarray

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/rows")


def fit_centres(df: DataFrame, id_col: str, vec: str, cells: int, metric: str, sample: int = SAMPLE_ROWS, rounds: int = 12,
                seed: int = 1) -> np.ndarray:
    """Centres of k-means on about ``sample`` rows, which a hash of id and vector chooses; copies count once."""
    n = df.count()
    share = min(1.0, sample / max(1, n))
    chosen = df.filter(F.pmod(F.xxhash64(id_col, vec), F.lit(1 << 20)) < math.ceil(share * (1 << 20)))
    m = _ready(V._matrix(chosen.select(F.col(vec).cast("array<double>").alias("v")).limit(2 * sample).toPandas()["v"].tolist()), metric)
    m = m[~np.isnan(m).any(1)] if len(m) else m
    if metric != "euclidean":
        m = m[(m != 0).any(1)] if len(m) else m
    m = np.unique(m, axis=0) if len(m) else m  # in an order that does not depend on tasks
    if not len(m):
        return np.zeros((0, 0))
    centres = m[np.random.default_rng(seed).choice(len(m), min(cells, len(m)), replace=False)]
    for _ in range(rounds):
        nearest = np.concatenate([_apart(m[k:k + 4096], centres, metric).argmin(1) for k in range(0, len(m), 4096)])
        order = np.argsort(nearest, kind="stable")
        held, start = np.unique(nearest[order], return_index=True)
        centres = centres.copy()
        centres[held] = np.add.reduceat(m[order], start) / np.diff(np.append(start, len(m)))[:, None]
        centres = _ready(centres, metric)
    return centres


def build_index(df: DataFrame, id_col: str, vec: str, path: str | None = None, metric: str = "cosine", cells: int | None = None,
                block_rows: int = BLOCK_ROWS) -> CellIndex:
    """Fit the cells, store every row of ``df`` (``id_col``, ``vec``) by its cell, and return the index.

    ``cells`` is about the root of the number of rows by default, ``MAX_CELLS`` at most; a cell of more than
    ``block_rows`` rows is stored in parts. Rows without a vector are left out.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "cell-index")
    rows = df.select(id_col, F.col(vec).cast("array<double>").alias(vec)).filter(F.col(vec).isNotNull())
    cells = min(MAX_CELLS, cells or max(1, math.isqrt(rows.count())))
    centres = fit_centres(rows, id_col, vec, cells, metric)
    schema = T.StructType([rows.schema[id_col], rows.schema[vec], T.StructField("cell", T.IntegerType()), T.StructField("apart", T.DoubleType())])

    own = (centres * centres).sum(1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _column(batch.column(1))
            # A vector with a null or NaN is no neighbour of anything.
            batch, m = batch.filter(pa.array(~np.isnan(m).any(1))), _ready(m[~np.isnan(m).any(1)], metric)
            cell, far = np.full(len(m), len(centres)), np.full(len(m), np.inf)
            here = np.flatnonzero((m != 0).any(1) | (metric == "euclidean"))
            if len(here) and len(centres):
                for k in range(0, len(here), 1024):
                    part = here[k:k + 1024]
                    if metric == "euclidean":
                        cell[part] = (own - 2 * m[part] @ centres.T).argmin(1)
                        far[part] = np.sqrt(((m[part] - centres[cell[part]]) ** 2).sum(1))
                    else:
                        apart = _apart(m[part], centres, metric)
                        cell[part], far[part] = apart.argmin(1), apart.min(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(far)], names=schema.names)

    placed = spread(rows, id_col, vec).mapInArrow(place, schema)
    # Dealt by cell and part, so that a search reads the row groups of its cells alone.
    placed.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(64))).repartition("cell", "_salt").sortWithinPartitions("cell").drop("_salt").write.parquet(f"{path}/rows")
    sizes = spark.read.parquet(f"{path}/rows").groupBy("cell").agg(F.count("*").alias("n"), F.max("apart").alias("radius")).collect()
    first = rows.select(F.size(vec)).first()
    dim = first[0] if first else 0
    centres = np.vstack([centres if len(centres) else np.zeros((0, dim)), np.zeros((1, dim))])
    radius, count = np.zeros(len(centres)), np.zeros(len(centres), np.int64)
    for r in sizes:
        radius[r["cell"]], count[r["cell"]] = r["radius"], r["n"]
    table = [(k, centres[k].tolist(), float(radius[k]), int(count[k])) for k in range(len(centres))]
    described = spark.createDataFrame(table, "cell int, centre array<double>, radius double, n long")
    described.withColumns({"id_col": F.lit(id_col), "vec": F.lit(vec), "metric": F.lit(metric)}).coalesce(1).write.parquet(f"{path}/cells")
    return CellIndex(path, id_col, vec, metric, centres, radius, count)


def open_index(spark: SparkSession, path: str) -> CellIndex:
    """An index that was stored before."""
    rows = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()
    return CellIndex(path, rows[0]["id_col"], rows[0]["vec"], rows[0]["metric"], np.array([r["centre"] for r in rows], np.float64),
                     np.array([r["radius"] for r in rows]), np.array([r["n"] for r in rows]))


@dataclass(frozen=True)
class Found:
    """Hits (query id, id, ``distance``, ``place``), and how many of all pairs of a query and a vector lie in cells that met."""

    hits: DataFrame
    compared: int
    pairs: int


def _tiles(centres: np.ndarray, count: np.ndarray, rows: int) -> np.ndarray:
    """Tile of each cell: cells that lie together, of at most ``rows`` rows unless a single cell has more. The last cell,
    of vectors without direction, is a tile of its own."""
    tile = np.full(len(centres), -1)
    todo, made = [np.arange(len(centres) - 1), np.array([len(centres) - 1])], 0
    while todo:
        at = todo.pop()
        if len(at) > 1 and count[at].sum() > rows:
            side = np.ptp(centres[at], axis=0).argmax()
            at = at[np.argsort(centres[at, side], kind="stable")]
            half = min(len(at) - 1, max(1, int(np.searchsorted(np.cumsum(count[at]), count[at].sum() / 2))))
            todo += [at[half:], at[:half]]
            continue
        tile[at] = made
        made += 1
    return tile


def _first_cells(index: CellIndex, q: np.ndarray, k: int, probes: int | None) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each query the cells that it meets first, the nearest centres until they hold ``k`` rows, and those that follow: the
    rest of ``probes`` cells, if given, or four. Only cells with rows count."""
    held = np.flatnonzero(index.count > 0)
    q = _ready(q, index.metric)
    some = min(len(held), max(probes or 1, 1) + 8)
    first, then = [], []
    for at in range(0, len(q), 1024):
        apart = _apart(q[at:at + 1024], index.centres[held], index.metric)
        near = np.argpartition(apart, some - 1, axis=1)[:, :some] if some < len(held) else np.broadcast_to(np.arange(len(held)), apart.shape)
        near = np.take_along_axis(near, np.take_along_axis(apart, near, 1).argsort(1, kind="stable"), 1)
        for i in range(len(apart)):
            order = near[i]
            n = int(np.searchsorted(np.cumsum(index.count[held[order]]), k)) + 1
            if max(n, probes or 1) + 4 > some and some < len(held):
                order = np.argsort(apart[i], kind="stable")
                n = int(np.searchsorted(np.cumsum(index.count[held[order]]), k)) + 1
            order = held[order]
            first.append(order[:n])
            after = order[n:max(n, probes)] if probes else order[n:n + 4]
            if probes and index.metric != "euclidean" and index.count[-1] and len(index.count) - 1 not in order[:max(n, probes)]:
                after = np.append(after, len(index.count) - 1)
            then.append(after)
    return first, then


def _within(index: CellIndex, q: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Per query and cell, whether the cell can hold a row that is no farther than ``limit``."""
    q = _ready(q, index.metric)
    reach = (limit[:, None] + 2 * SLACK + index.radius) / (1 - SLACK)
    if index.metric == "euclidean":
        own, other = (q * q).sum(1), (index.centres * index.centres).sum(1)
        # What rounding can take from a difference of large numbers.
        return other - 2 * q @ index.centres.T <= reach * reach + ((1e-14 - 1) * own + 1e-14 * other.max())[:, None]
    near = _apart(q, index.centres, index.metric) <= reach
    near[(q == 0).all(1)] = True
    return near


def _column(values: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of vectors of one length as a matrix."""
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    if not len(values):
        return np.zeros((0, 0))
    ends = pc.min_max(pc.list_value_length(values)).as_py()
    if ends["min"] != ends["max"]:
        raise ValueError("all vectors must have the same length")
    return pc.list_flatten(values).to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(values), -1)


def _lists(cells: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, cells)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(cells) if cells else np.zeros(0), pa.int32()))


def _leaves(v: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows of ``v`` in equal blocks of at most ``size`` that lie together (block, place), and which of them count:
    blocks are filled up with rows that stand elsewhere, too. All blocks are halved at once, each along its widest side."""
    blocks = 1 << max(0, math.ceil(math.log2(max(1, len(v)) / size)))
    each = -(-len(v) // blocks)
    fill = np.linspace(0, len(v) - 1, blocks * each - len(v)).astype(np.int64)
    at = np.concatenate([np.arange(len(v)), fill])[None]
    counts = np.arange(blocks * each)[None] < len(v)
    while len(at) < blocks:
        rows = v[at]
        side = np.ptp(rows, axis=1).argmax(1)
        half = at.shape[1] // 2
        order = np.argpartition(np.take_along_axis(rows, side[:, None, None], 2)[:, :, 0], half, axis=1)
        at, counts = (np.take_along_axis(x, order, 1).reshape(-1, half) for x in (at, counts))
    return at, counts


def _gaps(low: np.ndarray, high: np.ndarray, other_low: np.ndarray, other_high: np.ndarray) -> np.ndarray:
    """Distances of boxes, given by their sides in the last axis."""
    total = 0.0
    for k in range(low.shape[-1]):
        gap = np.maximum(np.maximum(other_low[..., k] - high[..., k], low[..., k] - other_high[..., k]), 0)
        total = total + gap * gap
    return np.sqrt(total)


def _lengths(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Distances as `vectors._distances` makes them, of vectors that are paired by broadcasting."""
    return np.round(np.sqrt(sum((q[..., k] - v[..., k]) ** 2 for k in range(q.shape[-1]))), 9)


def _near_blocks(q: np.ndarray, limit: np.ndarray, v: np.ndarray, k: int, metric: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, row, distance) of all rows that can be among the ``k`` nearest of a query and not beyond its limit: vectors
    of few dimensions, in blocks with their sides. A query is compared with the rows of blocks alone that are near enough
    to its own block, and then to itself; blocks are looked at together, in slices of about 16 MB."""
    rows, counts = _leaves(v, SMALL_BLOCK)
    asks, asked = _leaves(q, SMALL_BLOCK)
    points, low, high = v[rows], v[rows].min(1), v[rows].max(1)
    held = counts.sum(1)
    few = min(len(rows), -(-k // max(1, int(held.min()))) + 2)
    step = max(1, min(2_000_000 // len(rows), 2_000_000 // (asks.shape[1] * few * rows.shape[1])))
    for at in range(0, len(asks), step):
        mine, some = asks[at:at + step], q[asks[at:at + step]]
        top = np.where(asked[at:at + step], limit[mine], -math.inf)
        far = _gaps(some.min(1)[:, None], some.max(1)[:, None], low, high)
        if len(v) >= k:
            first = np.argpartition(far, few - 1, axis=1)[:, :few] if few < len(rows) else np.broadcast_to(np.arange(few), (len(far), few))
            d = _lengths(some[:, :, None], points[first].reshape(len(some), 1, -1, q.shape[1]))
            d = np.where(counts[first].reshape(len(some), 1, -1), d, math.inf)
            top = np.minimum(top, np.partition(d, k - 1, axis=2)[:, :, k - 1])
        block, other = np.nonzero(far <= top.max(1)[:, None] + SLACK)
        for lo in range(0, len(block), 65_536):
            own, met = block[lo:lo + 65_536], other[lo:lo + 65_536]
            near = _gaps(some[own], some[own], low[met][:, None], high[met][:, None]) <= top[own] + SLACK
            pair, place = np.nonzero(near)
            for part in range(0, len(pair), 131_072):
                a, b = (own[pair[part:part + 131_072]], place[part:part + 131_072]), met[pair[part:part + 131_072]]
                d = _lengths(some[a][:, None], points[b])
                i, j = np.nonzero((d <= top[a][:, None]) & counts[b])
                yield mine[a][i], rows[b[i], j], d[i, j]


def _near_cell(q: np.ndarray, limit: np.ndarray, v: np.ndarray, k: int, metric: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """As `_near_blocks`, for vectors of any metric and length: all pairs, in slices of about 16 MB."""
    step = max(1, 2_000_000 // max(1, len(v)))
    q, v = _ready(q, metric), _ready(v, metric)
    for i in range(0, len(q), step):
        top = limit[i:i + step]
        loose = np.flatnonzero(~np.isfinite(top))
        if metric == "euclidean":
            far, reach = V._distances(q[i:i + step], v, metric), top.copy()
        else:  # angles are made of the pairs alone that are near enough
            far = -(q[i:i + step] @ v.T)
            reach = 1e-9 - (np.cos(np.minimum(top + 1e-7, math.pi)) if metric == "angular" else 1 - top)
        if len(loose):
            reach[loose] = np.partition(far[loose], k - 1, axis=1)[:, k - 1] + 1e-9 if far.shape[1] > k else np.inf
        a, b = np.nonzero(far <= reach[:, None])
        d = far[a, b]
        if metric != "euclidean":
            cos = np.clip(-d, -1.0, 1.0)
            d = np.round(np.arccos(cos) if metric == "angular" else 1 - cos, 9)
        near = d <= top[a]
        yield a[near] + i, b[near], d[near]


def search(index: CellIndex, queries: DataFrame, k: int, query_id: str = "query_id", query_vec: str = "query_vec",
           probes: int | None = None, block_rows: int = BLOCK_ROWS) -> Found:
    """The ``k`` nearest rows of ``index`` for each query, nearest first, ties by id; exact unless ``probes`` is given.

    Distances and ties are those of ``vectors.knn``. Cells that lie together are a tile of about ``block_rows`` rows; a
    query travels once to each tile that has cells it needs, and meets these alone. A tile asked by many queries and a cell
    of many rows are both split, so no task holds more than ``block_rows`` of either. Every round is a written table: round 0
    takes the nearest centres until they hold k rows, round 1 four more cells (the rest of the nearest ``probes`` cells, if
    given, which end the search), round 2 all others; in rounds 1 and 2 only cells whose bound does not exceed the k-th distance.
    """
    spark = queries.sparkSession
    asked = queries.select(query_id, F.col(query_vec).cast("array<double>").alias(query_vec)).filter(F.col(query_vec).isNotNull())
    # Read several times, and often the end of a longer plan.
    asked = written(asked, "cell-asked")
    kinds = {f.name: f for f in (*asked.schema.fields, *index.rows(spark).schema.fields)}
    hit = T.StructType([kinds[query_id], kinds[index.id_col], T.StructField("distance", T.DoubleType())])
    order = Window.partitionBy(query_id).orderBy("distance", index.id_col)
    best = spark.createDataFrame([], hit)
    compared, sizes = 0, index.count
    if not sizes.sum():
        return Found(best.withColumn("place", F.lit(1)), 0, 0)
    ints = T.ArrayType(T.IntegerType())
    metric, id_col, vec, dim = index.metric, index.id_col, index.vec, index.centres.shape[1]

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _column(batch.column(1))
            # A vector with a null or NaN has no distance to anything.
            batch, q = batch.filter(pa.array(~np.isnan(q).any(1))), q[~np.isnan(q).any(1)]
            if len(q):
                first, then = _first_cells(index, q, k, probes)
                yield pa.RecordBatch.from_arrays([*batch.columns, _lists(first), _lists(then)], names=[query_id, query_vec, "_first", "_then"])

    started = written(spread(asked, query_id, query_vec).mapInArrow(begin, T.StructType([*asked.schema.fields, T.StructField("_first", ints), T.StructField("_then", ints)])), "cell-queries")
    tile = _tiles(index.centres, sizes, block_rows)
    tile_rows = np.bincount(tile, weights=sizes).astype(np.int64)
    tiles = spark.createDataFrame([(c, int(t)) for c, t in enumerate(tile)], "cell int, _tile int")
    sent_kind = T.StructType([kinds[query_id], kinds[query_vec], T.StructField("_kth", T.DoubleType()), T.StructField("_tile", T.IntegerType()),
                              T.StructField("_cells", ints), T.StructField("_rows", T.LongType())])
    for step in range(2 if probes else 3):
        known = best.groupBy(query_id).agg(F.count("*").alias("_n"), F.max("distance").alias("_kth"))
        known = known.select(F.col(query_id).alias("_q"), F.when(F.col("_n") >= k, F.col("_kth")).alias("_kth"))
        todo = started.join(known, F.col(query_id).eqNullSafe(F.col("_q")), "left") if step else started.withColumn("_kth", F.lit(None).cast("double"))
        todo = todo.select(query_id, query_vec, "_first", "_then", "_kth")

        def plan(batches: Iterator[pa.RecordBatch], step: int = step) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    part = batch.slice(at, 1024)
                    kth = pc.fill_null(part.column(4), math.inf).to_numpy(zero_copy_only=False)
                    wanted = np.zeros((part.num_rows, len(sizes)), bool)
                    listed = []
                    for column in (2, 3):
                        lists = part.column(column)
                        listed.append((np.repeat(np.arange(part.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False)), lists.flatten().to_numpy()))
                    if step == 0:
                        wanted[listed[0]] = True
                    else:
                        can = _within(index, _column(part.column(1)), _as_apart(kth, metric) + SLACK) & (sizes > 0)
                        can[listed[0]] = False
                        if step == 1:
                            wanted[listed[1]] = can[listed[1]]
                        else:
                            can[listed[1]] = False
                            wanted = can
                    row, cell = np.nonzero(wanted)
                    by = np.lexsort((cell, tile[cell], row))
                    row, cell = row[by], cell[by]
                    cut = np.flatnonzero(np.append(True, (np.diff(row) != 0) | (np.diff(tile[cell]) != 0))) if len(row) else np.zeros(0, np.int64)
                    ends = np.append(cut, len(row))
                    for lo in range(0, len(cut), SENT_ROWS):
                        own = ends[lo:lo + SENT_ROWS + 1]
                        inside = cell[own[0]:own[-1]]
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0).take(pa.array(row[own[:-1]])), part.column(1).take(pa.array(row[own[:-1]])), pa.array(kth[row[own[:-1]]]),
                             pa.array(tile[cell[own[:-1]]], pa.int32()), pa.ListArray.from_arrays(pa.array(own - own[0], pa.int32()), pa.array(inside, pa.int32())),
                             pa.array(np.add.reduceat(sizes[inside], own[:-1] - own[0]), pa.int64())], names=sent_kind.names)

        pairs = written(todo.mapInArrow(plan, sent_kind), "cell-pairs")
        # One row per tile, so at most MAX_CELLS + 1.
        wanted = {r["_tile"]: (r["n"], r["rows"]) for r in pairs.groupBy("_tile").agg(F.count("*").alias("n"), F.sum("_rows").alias("rows")).collect()}
        compared += sum(rows for _, rows in wanted.values())
        if not wanted:
            break
        # Some 256 meetings of a tile and a chunk of queries, if there are so many queries.
        chunk = min(block_rows, max(4096, sum(n for n, _ in wanted.values()) // 256))
        deals = [(t, math.ceil(int(tile_rows[t]) / block_rows), math.ceil(n / chunk)) for t, (n, _) in wanted.items()]
        dealt = lambda: F.broadcast(spark.createDataFrame(deals, "_tile int, _parts int, _chunks int"))
        rows = index.rows(spark).select("cell", index.id_col, index.vec).join(F.broadcast(tiles), "cell").join(dealt(), "_tile")
        rows = rows.withColumn("_part", F.pmod(F.xxhash64(index.id_col, index.vec), F.col("_parts")).cast("int")).withColumn(
            "_chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
        rows = rows.select("_tile", "_part", "_chunk", index.id_col, index.vec, "cell")
        sent = pairs.join(dealt(), "_tile").withColumn("_chunk", F.pmod(F.xxhash64(query_id, query_vec), F.col("_chunks")).cast("int")).withColumn(
            "_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        sent = sent.select("_tile", "_part", "_chunk", query_id, query_vec, "_kth", "_cells")

        def meet(left: pa.Table, right: pa.Table) -> pa.Table:
            """The nearest rows of a tile's part for a chunk of the queries that ask for its cells."""
            out = {n: pa.array([], right[query_id].type if n == query_id else left[id_col].type if n == id_col else pa.float64()) for n in hit.names}
            if not left.num_rows or not right.num_rows:
                return pa.table(out)
            cell, v, q = left["cell"].to_numpy(), _column(left[vec]), _column(right[query_vec])
            limit, lists = right["_kth"].to_numpy(), right["_cells"].combine_chunks()
            asks, asked_cells = np.repeat(np.arange(len(q)), pc.list_value_length(lists).to_numpy()), lists.flatten().to_numpy()
            near = _near_blocks if metric == "euclidean" and dim <= V.DIRECT_DIMS else _near_cell
            found = []
            for c in np.unique(cell):
                here, mine = np.flatnonzero(cell == c), asks[asked_cells == c]
                if len(mine):
                    found += [(mine[a], here[b], d) for a, b, d in near(q[mine], limit[mine], v[here], k, metric)]
            if not found:
                return pa.table(out)
            a, b, d = (np.concatenate(x) for x in zip(*found))
            rank = np.empty(len(v), np.int64)
            rank[pc.sort_indices(left[id_col]).to_numpy()] = np.arange(len(v))
            by = np.lexsort((rank[b], d, a))
            a, b, d = a[by], b[by], d[by]
            start = np.flatnonzero(np.append(True, np.diff(a) != 0)) if len(a) else np.zeros(0, np.int64)
            keep = np.arange(len(a)) - np.repeat(start, np.diff(np.append(start, len(a)))) < k
            return pa.table({query_id: right[query_id].take(pa.array(a[keep])), id_col: left[id_col].take(pa.array(b[keep])), "distance": d[keep]})

        keys = ["_tile", "_part", "_chunk"]
        near = rows.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(meet, hit)
        merged = best.unionByName(near).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).drop("place")
        best = written(merged, "cell-hits")
    return Found(best.withColumn("place", F.row_number().over(order)), compared, int(sizes.sum()) * asked.count())


@dataclass(frozen=True)
class SpaceIndex:
    """A fitted map from one space to another, and an index of the mapped vectors."""

    weights: np.ndarray
    index: CellIndex


def build_space_index(df: DataFrame, id_col: str, x: str, y: str, path: str | None = None, metric: str = "cosine", penalty: float = 1e-3,
                      table: DataFrame | None = None) -> SpaceIndex:
    """Fit a ridge map from ``x`` to ``y`` on the rows that have both, map the rows of ``table`` (``df`` by default) by
    their ``x`` and index the results. The map is stored beside the index."""
    path = path or scratch_path(df.sparkSession, "space-index")
    weights = V.fit_space_map(df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()), x, y, penalty)
    mapped = V.apply_space_map((df if table is None else table).filter(F.col(x).isNotNull()), x, weights, "_mapped")
    index = build_index(mapped.select(id_col, F.col("_mapped").alias("mapped")), id_col, "mapped", path, metric)
    df.sparkSession.createDataFrame([(k, w.tolist()) for k, w in enumerate(weights)], "i int, weights array<double>").coalesce(1).write.parquet(f"{path}/map")
    return SpaceIndex(weights, index)


def open_space_index(spark: SparkSession, path: str) -> SpaceIndex:
    rows = spark.read.parquet(f"{path}/map").orderBy("i").collect()
    return SpaceIndex(np.array([r["weights"] for r in rows], np.float64), open_index(spark, path))
