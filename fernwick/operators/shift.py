"""Mean shift over cells of points: only cells near enough to weigh anything meet.

Two kinds of rounds need no pairs of points, and take the sums of all weights to double precision from sums per place: many
points of one or two dimensions (`_Grid`), and points that lie so near each other that weights are a short series (`_series`).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fernwick.operators import vectors as V
from fernwick.operators.cells import MAX_CELLS, SLACK, _apart, _column, fit_centres
from fernwick.session import cut_lineage, spread

# All points that a point leaves out weigh less than this together, next to its own weight of 1: below the last
# digit of a double.
NOTHING = 2.0**-60
# Points of a cell, about, while there are fewer than `MAX_CELLS`; points of a tile at most, and their numbers (16 MB).
CELL_ROWS = 1_024
TILE_ROWS = 32_768
TILE_NUMBERS = 2_097_152
# Points from which a grid is used, and its numbers, which go to every task (64 MB).
GRID_ROWS = 131_072
GRID_NUMBERS = 8_000_000
# Nodes to a side of a box that is as wide as the bandwidth: the interpolation of a weight is off by less than 2^-57.
NODES = 18
# Positions of a series are off by less than this part of the bandwidth; its sums have so many numbers at most (16 MB).
DIGITS = 2.0**-53
SERIES_NUMBERS = 2_097_152


@dataclass(frozen=True)
class Shifted:
    """The moved points (id, vector), and how many of all pairs of points were weighed, over all rounds."""

    points: DataFrame
    weighed: int
    pairs: int


def _cells_now(points: DataFrame, vec: str, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, radius and size of each cell, one row per cell."""
    means, radius, count = np.zeros((cells, 0)), np.zeros(cells), np.zeros(cells, np.int64)
    found = points.groupBy("cell").agg(F.count("*").alias("n"), Summarizer.mean(V.dense(vec)).alias("m")).collect()
    if found:
        means = np.zeros((cells, len(found[0]["m"])))
    for r in found:
        means[r["cell"]], count[r["cell"]] = r["m"].toArray(), r["n"]

    def far(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                cell = pdf["cell"].to_numpy()
                apart = np.sqrt(((V._matrix(pdf[vec].tolist()) - means[cell]) ** 2).sum(1))
                yield pd.DataFrame({"cell": cell, "r": apart}).groupby("cell", as_index=False)["r"].max()

    for r in points.select("cell", vec).mapInPandas(far, "cell int, r double").groupBy("cell").agg(F.max("r").alias("r")).collect():
        radius[r["cell"]] = r["r"]
    return means, radius, count


def _in_line(centres: np.ndarray) -> np.ndarray:
    """An order of the centres in which neighbours lie near each other: halves along the widest axis, again and again."""
    if len(centres) < 3:
        return np.arange(len(centres))
    order = np.argsort(centres[:, np.ptp(centres, axis=0).argmax()], kind="stable")
    low, high = order[:len(order) // 2], order[len(order) // 2:]
    return np.concatenate([low[_in_line(centres[low])], high[_in_line(centres[high])]])


def _met(means: np.ndarray, radius: np.ndarray, count: np.ndarray, bandwidth: float) -> np.ndarray:
    """Whether points of cell ``j`` (column) can weigh anything for one of cell ``i`` (row)."""
    met = np.zeros((len(count), len(count)), bool)
    for i in np.flatnonzero(count):
        apart = np.sqrt(((means - means[i]) ** 2).sum(1))
        gap = np.maximum(apart * (1 - SLACK) - radius - radius[i], 0)
        most = count * np.exp(-0.5 * (gap / bandwidth) ** 2) * (1 + apart + radius + radius[i])
        met[i] = (most * max(1, len(count)) >= NOTHING) & (count > 0)
    return met


def _tiles(met: np.ndarray, line: np.ndarray, count: np.ndarray, rows: int) -> list[tuple]:
    """``(cell, parts, part, tile, as left, as right)``: cells, in parts if they are large, are dealt along ``line`` to tiles of
    about ``rows`` points, and each knows the tiles it meets as the side that is moved and as the side that weighs."""
    pieces = [(int(c), max(1, math.ceil(int(count[c]) / rows)), p) for c in line for p in range(max(1, math.ceil(int(count[c]) / rows)))]
    sizes = np.cumsum([count[c] / n for c, n, _ in pieces])
    tile = [int(t) for t in (np.maximum(sizes - 1e-9, 0) // rows)]
    cells = np.array([c for c, _, _ in pieces])
    held = np.zeros((max(tile, default=-1) + 1, len(count)), bool)
    held[tile, cells] = True
    # Cell by tile: whether a tile holds a cell that is met.
    left, right = (met.astype(np.float32) @ held.T.astype(np.float32)) > 0, (met.T.astype(np.float32) @ held.T.astype(np.float32)) > 0
    return [(c, n, p, t, np.flatnonzero(left[c]).tolist(), np.flatnonzero(right[c]).tolist()) for (c, n, p), t in zip(pieces, tile)]


_K = np.arange(NODES)[:, None]
# From values at the nodes to coefficients of Chebyshev polynomials.
_TO_NODES = np.where(_K == 0, 1, 2) / NODES * np.cos(np.pi * _K * (np.arange(NODES)[None, :] + 0.5) / NODES)
_AT = np.cos(np.pi * (np.arange(NODES) + 0.5) / NODES)


def _basis(x: np.ndarray) -> np.ndarray:
    """What each node of a side counts for the places ``x`` from -1 to 1."""
    t = np.ones((len(x), NODES))
    t[:, 1] = x
    for k in range(2, NODES):
        t[:, k] = 2 * x * t[:, k - 1] - t[:, k - 2]
    return t @ _TO_NODES


@dataclass(frozen=True)
class _Grid:
    """Boxes as wide as the bandwidth over a plane. Weights are smooth inside a box, so they are interpolated between its
    nodes on both sides: the points of a box become weights of its nodes, boxes weigh each other node by node, and a point's
    sums are read between the nodes of its box."""

    low: np.ndarray
    side: float

    def boxes(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Box of each point (two numbers in one) and the point seen from the middle of it."""
        at = np.floor((m - self.low) / self.side)
        return (at[:, 0].astype(np.int64) << 31) + at[:, 1].astype(np.int64), m - self.low - (at + 0.5) * self.side

    def groups(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Ids, boxes, points seen from their boxes, what nodes count, and the rows of each box, for many rows at once."""
        held, n = [], 0

        def made() -> tuple:
            m = np.concatenate([_plane(_column(b.column(1))) for b in held])
            box, u = self.boxes(m)
            basis = [_basis(np.clip(2 * u[:, k] / self.side, -1, 1)) for k in (0, 1)]
            order = np.argsort(box, kind="stable")
            start = np.flatnonzero(np.append(True, np.diff(box[order]) != 0))
            return pa.chunked_array([b.column(0) for b in held]).combine_chunks(), box, u, basis, np.split(order, start[1:])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= 131_072:
                yield made()
                held, n = [], 0
        if held:
            yield made()

    def sums(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per box its points, and for each node what they count there: their number and their sums."""
        total: dict[int, np.ndarray] = {}
        count: dict[int, int] = {}
        for _, box, u, (a, b), groups in self.groups(batches):
            for rows in groups:
                key, right = int(box[rows[0]]), b[rows]
                found = np.stack([a[rows].T @ (right if w is None else right * w[rows, None]) for w in (None, u[:, 0], u[:, 1])])
                total[key] = total[key] + found if key in total else found
                count[key] = count.get(key, 0) + len(rows)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(count.values()), pa.int64()), pa.array(
                [t.ravel() for t in total.values()], pa.list_(pa.float64()))], names=["box", "n", "s"])

    def pairs(self, box: np.ndarray, count: np.ndarray, asked: np.ndarray, bandwidth: float) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Offsets of two boxes, and the places (asked box, other box) of those that can weigh anything for each other."""
        i, j = box >> 31, box & ((1 << 31) - 1)
        wide = self.side * (1 + math.hypot(float(np.ptp(i)) + 1, float(np.ptp(j)) + 1))
        reach = math.sqrt(2 * math.log(float(count.sum()) * (1 + wide) * len(box) / NOTHING)) * bandwidth / self.side + 1
        for x in range(-min(math.ceil(reach), int(np.ptp(i))), min(math.ceil(reach), int(np.ptp(i))) + 1):
            for y in range(-min(math.ceil(reach), int(np.ptp(j))), min(math.ceil(reach), int(np.ptp(j))) + 1):
                if math.hypot(max(abs(x) - 1, 0), max(abs(y) - 1, 0)) <= reach - 1:
                    code = ((i[asked] + x) << 31) + j[asked] + y
                    at = np.minimum(np.searchsorted(box, code), len(box) - 1)
                    met = (box[at] == code) & (j[asked] + y >= 0)
                    if met.any():
                        yield x, y, np.flatnonzero(met), at[met]

    def weigh(self, box: np.ndarray, count: np.ndarray, sums: np.ndarray, asked: np.ndarray, bandwidth: float) -> tuple[np.ndarray, int]:
        """The sums at the nodes of the ``asked`` boxes, and how many pairs of points are weighed."""
        out, weighed, made = np.zeros((len(asked), *sums.shape[1:])), 0, {}

        def kernel(offset: int) -> np.ndarray:
            if offset not in made:
                apart = (offset + (_AT[None, :] - _AT[:, None]) / 2) * self.side
                made[offset] = np.exp(-0.5 * (apart / bandwidth) ** 2)
            return made[offset]

        for x, y, mine, other in self.pairs(box, count, asked, bandwidth):
            weighed += int((count[asked[mine]] * count[other]).sum())
            for lo in range(0, len(mine), 1024):
                some = kernel(x) @ sums[other[lo:lo + 1024]] @ kernel(y).T
                # Sums as seen from the asked box.
                some[:, 1] += x * self.side * some[:, 0]
                some[:, 2] += y * self.side * some[:, 0]
                out[mine[lo:lo + 1024]] += some
        return out, weighed

    def moved(self, batches: Iterator[pa.RecordBatch], box: np.ndarray, values: np.ndarray, dim: int, names: list[str]) -> Iterator[pa.RecordBatch]:
        """Each point at the mean that the nodes of its box tell."""
        for ids, own, u, (a, b), groups in self.groups(batches):
            to = np.empty_like(u)
            for rows in groups:
                v = values[np.searchsorted(box, own[rows[0]])]
                w = (a[rows] @ v[0] * b[rows]).sum(1)
                for k in (0, 1):
                    to[rows, k] = (a[rows] @ v[1 + k] * b[rows]).sum(1) / w
            middle = np.stack([own >> 31, own & ((1 << 31) - 1)], 1) + 0.5
            to += middle * self.side + self.low
            yield pa.RecordBatch.from_arrays([ids, _list_column(to[:, :dim])], names=names)


def _plane(m: np.ndarray) -> np.ndarray:
    return m if m.shape[1] == 2 else np.concatenate([m, np.zeros((len(m), 1))], 1)


def _list_column(m: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(np.ascontiguousarray(m).ravel()))


def _on_grid(points: DataFrame, id_col: str, vec: str, bandwidth: float, rounds: int, n: int) -> Shifted | None:
    """All rounds on a `_Grid`, or null where the points have more dimensions, are not finite or need too many boxes."""
    spark = points.sparkSession
    dims = points.agg(F.min(F.size(vec)).alias("a"), F.max(F.size(vec)).alias("b"), F.bool_and(
        F.forall(vec, lambda x: x.isNotNull() & (F.abs(x) < 1e300))).alias("plain")).first()
    if dims["a"] != dims["b"] or dims["a"] not in (1, 2) or not dims["plain"]:
        return None
    dim, names = dims["a"], [id_col, vec]
    points, weighed = cut_lineage(spread(points, id_col)), 0
    for _ in range(rounds):
        ends = points.agg(*[f(F.get(vec, F.lit(k))) for k in range(dim) for f in (F.min, F.max)]).first()
        low, high = np.array([*ends[0::2], 0.0][:2]), np.array([*ends[1::2], 0.0][:2])
        if (high - low).max() / bandwidth > 1 << 30:
            return None
        grid = _Grid(low, bandwidth)
        at = [F.floor((F.get(vec, F.lit(k)) - float(low[k])) / float(bandwidth)).alias(f"b{k}") for k in range(dim)]
        if points.select(*at).distinct().count() * 3 * NODES**2 > GRID_NUMBERS:
            return None
        found = points.select(id_col, vec).mapInArrow(lambda batches, grid=grid: grid.sums(batches), "box long, n long, s array<double>").withColumn(
            "s", V.dense("s")).groupBy("box").agg(F.sum("n").alias("n"), Summarizer.sum(F.col("s")).alias("s")).select(
            "box", "n", vector_to_array("s").alias("s")).toArrow().combine_chunks().sort_by("box")
        box, count = found["box"].to_numpy(), found["n"].to_numpy()
        sums = _column(found["s"]).reshape(-1, 3, NODES, NODES)
        slices = min(len(box), 4 * spark.sparkContext.defaultParallelism)

        def weigh(batches: Iterator[pa.RecordBatch], grid=grid, box=box, count=count, sums=sums, slices=slices) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in batch.column(0).to_pylist():
                    asked = np.arange(k, len(box), slices)
                    out, pairs = grid.weigh(box, count, sums, asked, bandwidth)
                    yield pa.RecordBatch.from_arrays([pa.array(asked, pa.int64()), pa.array([pairs, *[0] * (len(asked) - 1)], pa.int64()), _list_column(
                        out.reshape(len(asked), -1))], names=["place", "pairs", "v"])

        made = spark.range(slices, numPartitions=slices).mapInArrow(weigh, "place long, pairs long, v array<double>").toArrow().combine_chunks().sort_by("place")
        weighed += sum(made["pairs"].to_pylist())
        values = _column(made["v"]).reshape(-1, 3, NODES, NODES)
        points = cut_lineage(points.select(id_col, vec).mapInArrow(
            lambda batches, grid=grid, box=box, values=values: grid.moved(batches, box, values, dim, names), points.select(id_col, vec).schema))
    return Shifted(points, weighed, rounds * n * n)


def _terms(means: np.ndarray, radius: np.ndarray, count: np.ndarray, bandwidth: float) -> tuple[np.ndarray, int | None]:
    """The mean of all points, and up to which power of the product of two points, seen from it, a series tells their weight
    well enough; null if that is more than the second."""
    if not count.sum() or not np.isfinite(means).all():
        return means.sum(0), None
    centre = count @ means / count.sum()
    held = count > 0
    far = float((np.sqrt(((means[held] - centre) ** 2).sum(1)) + radius[held]).max()) * (1 + SLACK)
    for power in (1, 2):
        rest = (far / bandwidth) ** (2 * power + 2) / math.factorial(power + 1)
        if rest < 0.01 and 4 * far * rest <= DIGITS * bandwidth and len(centre) ** (power + 1) <= SERIES_NUMBERS:
            return centre, power
    return centre, None


def _series(points: DataFrame, id_col: str, vec: str, centre: np.ndarray, power: int, bandwidth: float) -> DataFrame:
    """The moved points (id, vector, cell). Seen from the centre, a point z weighs another, u, by exp(-z²/2h²) exp(-u²/2h²)
    exp(zu/h²). The first factor cancels in the mean, and sums of products of u tell the last one as a series."""
    d, schema = len(centre), points.select(id_col, vec, "cell").schema
    ends = np.cumsum([d**k for k in range(power + 2)])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(d**k) for k in range(power + 2)]
        for batch in batches:
            m = _column(batch.column(1))
            for lo in range(0, len(m), 1024):
                u = (m[lo:lo + 1024] - centre) / bandwidth
                g, product = np.exp(-0.5 * (u * u).sum(1)), np.ones((len(u), 1))
                total[0] += g.sum()
                for k in range(power + 1):
                    total[k + 1] += ((product * g[:, None]).T @ u).ravel()
                    product = (product[:, :, None] * u[:, None, :]).reshape(len(u), -1) if k < power else product
        yield pa.RecordBatch.from_arrays([_list_column(np.concatenate(total)[None])], names=["s"])

    found = points.select(id_col, vec).mapInArrow(sums, "s array<double>").agg(Summarizer.sum(V.dense("s"))).first()[0].toArray()
    part = np.split(found, ends[:-1])

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, out = _column(batch.column(1)), []
            for lo in range(0, len(m), 1024):
                z = (m[lo:lo + 1024] - centre) / bandwidth
                product, w, top = np.ones((len(z), 1)), 0.0, 0.0
                for k in range(power + 1):
                    w = w + product @ part[k] / math.factorial(k)
                    top = top + product @ part[k + 1].reshape(-1, d) / math.factorial(k)
                    product = (product[:, :, None] * z[:, None, :]).reshape(len(z), -1) if k < power else product
                out.append(centre + bandwidth * top / w[:, None])
            if out:
                yield pa.RecordBatch.from_arrays([batch.column(0), _list_column(np.concatenate(out)), batch.column(2)], names=schema.names)

    return points.select(id_col, vec, "cell").mapInArrow(move, schema)


def _weights(a: np.ndarray, b: np.ndarray, bandwidth: float, twice: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``a`` the weighted sum of the rows of ``b`` and, behind it, the sum of the weights; if ``twice``, for each
    row of ``b``, too. Weights are made in blocks of 8 MB."""
    # Scaled points whose product, with what stands behind them, is the power of a weight.
    square = [-0.5 * (m * m).sum(1, keepdims=True) / bandwidth**2 for m in (a, b)]
    ones = [np.ones((len(m), 1)) for m in (a, b)]
    mine, its = np.concatenate([a / bandwidth**2, square[0], ones[0]], 1), np.concatenate([b, ones[1], square[1]], 1)
    a, b = np.concatenate([a, ones[0]], 1), np.concatenate([b, ones[1]], 1)
    for_a, for_b = np.zeros_like(a), np.zeros_like(b)
    for i in range(0, len(a), 512):
        for j in range(0, len(b), 2048):
            w = mine[i:i + 512] @ its[j:j + 2048].T
            np.exp(np.minimum(w, 0, out=w), out=w)
            for_a[i:i + 512] += w @ b[j:j + 2048]
            if twice:
                for_b[j:j + 2048] += w.T @ a[i:i + 512]
    return for_a, for_b


def shift(df: DataFrame, id_col: str, vec: str, bandwidth: float = 2.5, rounds: int = 5, block_rows: int = V.BLOCK_ROWS) -> Shifted:
    """Move every point to the Gaussian-weighted mean of all points, ``rounds`` times; all points move together.

    Points are dealt to cells by place. In each round a cell's mean and radius bound how near its points can be to
    those of another cell; a pair of cells is left out if what one weighs for the other is below double precision.
    Cells that lie together are shuffled as tiles of some blocks, so a point is sent once for each tile that it
    meets, not for each cell; a cell larger than a tile meets others in parts. Ids tell points apart and must not
    repeat; points without a vector are left out.
    """
    points = df.select(id_col, F.col(vec).cast("array<double>").alias(vec)).filter(F.col(vec).isNotNull())
    n = points.count()
    if n >= GRID_ROWS:
        moved = _on_grid(points, id_col, vec, bandwidth, rounds, n)
        if moved:
            return moved
    centres = fit_centres(points, id_col, vec, min(MAX_CELLS, max(1, math.ceil(8 * n / block_rows), math.ceil(n / CELL_ROWS))), "euclidean")
    line = _in_line(centres)
    schema = T.StructType([points.schema[id_col], points.schema[vec], T.StructField("cell", T.IntegerType())])

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                m = V._matrix(pdf[vec].tolist())
                yield pdf.assign(cell=np.concatenate([_apart(m[k:k + 256], centres, "euclidean").argmin(1) for k in range(0, len(m), 256)]).astype(np.int32))

    points = cut_lineage(points.mapInPandas(place, schema))
    moved = T.StructType([points.schema[id_col], points.schema["cell"], T.StructField("_w", T.DoubleType()), T.StructField("_s", T.ArrayType(T.DoubleType()))])
    # Some eight tiles at least, so that there are tasks for many cores.
    tile_rows = min(TILE_ROWS, 4 * block_rows, TILE_NUMBERS // max(1, centres.shape[1]) + 1, max(1_024, math.ceil(n / 8)))
    weighed = 0
    for _ in range(rounds):
        means, radius, count = _cells_now(points, vec, max(1, len(centres)))
        met = _met(means, radius, count, bandwidth)
        met |= met.T
        weighed += int(count @ met @ count)
        centre, power = _terms(means, radius, count, bandwidth)
        if power and met[np.ix_(count > 0, count > 0)].all():
            points = cut_lineage(_series(points, id_col, vec, centre, power, bandwidth))
            continue

        def partial(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            """What the points of two tiles weigh for each other; of one tile, for itself."""
            if not len(left) or not len(right):
                return pd.DataFrame({id_col: [], "cell": [], "_w": [], "_s": []})
            twice = left["_l"].iat[0] != left["_r"].iat[0]
            a, b = V._matrix(left[vec].tolist()), V._matrix(right["_v"].tolist())
            own, other = left["cell"].to_numpy(), right["other"].to_numpy()
            here = np.unique(other)
            for_a, for_b = np.zeros((len(a), a.shape[1] + 1)), np.zeros((len(b), a.shape[1] + 1))
            for cell in np.unique(own):
                near, rows = np.flatnonzero(np.isin(other, here[met[cell, here]])), np.flatnonzero(own == cell)
                if len(near):
                    one, two = _weights(a[rows], b[near], bandwidth, twice)
                    for_a[rows] = one
                    if twice:
                        for_b[near] += two
            both = [(left[id_col], own, for_a), (right["_i"], other, for_b)]
            return pd.concat([pd.DataFrame({id_col: ids.to_numpy(), "cell": cell, "_w": sums[:, -1], "_s": list(sums[:, :-1])})[sums[:, -1] > 0]
                              for ids, cell, sums in both[:2 if twice else 1]])

        pieces = _tiles(met, line, count, tile_rows) if len(centres) else []  # one per cell and part

        # Two points weigh the same for each other, so two tiles meet once.
        def side(cell: str, meets: str, into: str, own: str) -> DataFrame:
            table = df.sparkSession.createDataFrame(pieces, "cell int, parts int, part int, tile int, lefts array<int>, rights array<int>")
            named = points.select(F.col("cell").alias(cell), F.col(id_col).alias("_i"), F.col(vec).alias("_v"))
            whole = table.filter("part = 0").select(F.col("cell").alias(cell), F.col("parts").alias("_n"))
            mine = table.select(F.col("cell").alias(cell), F.col("part").alias("_p"), F.col("tile").alias(own), F.col(meets).alias("_meets"))
            parts = named.join(F.broadcast(whole), cell).withColumn("_p", F.pmod(F.xxhash64("_i"), F.col("_n")).cast("int"))
            return parts.join(F.broadcast(mine), [cell, "_p"]).select(
                "_i", "_v", cell, own, F.explode("_meets").alias(into)).filter(F.col("_l") <= F.col("_r"))

        left = side("cell", "lefts", "_r", "_l").withColumnsRenamed({"_i": id_col, "_v": vec})
        right = side("other", "rights", "_l", "_r")
        keys = ["_l", "_r"]
        sums = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(partial, moved)
        total = sums.withColumn("_d", V.dense("_s")).groupBy(id_col, "cell").agg(F.sum("_w").alias("_w"), Summarizer.sum(F.col("_d")).alias("_t"))
        points = cut_lineage(total.select(id_col, F.transform(vector_to_array("_t"), lambda x: x / F.col("_w")).alias(vec), "cell"))
    return Shifted(points.drop("cell"), weighed, rounds * n * n)


def mean_shift(df: DataFrame, id_col: str, vec: str, bandwidth: float = 2.5, rounds: int = 5, block_rows: int = V.BLOCK_ROWS) -> DataFrame:
    """The points (id, vector) after ``rounds`` of `shift`."""
    return shift(df, id_col, vec, bandwidth, rounds, block_rows).points
