"""Nearest neighbours by largest inner product, with collision-counting hashing.

Each hash function is one random projection; its values are kept as a sorted array. Around a query, a window of
every array is widened step by step (virtual rehashing: a window of radius R stands for buckets R times as
wide), and each vector counts the arrays in whose window it lies. Vectors with enough collisions are verified
on the original numbers, until so many are verified that wider windows are not needed.

Inner products become distances first: vectors of norm v get one more component, sqrt(M^2 - v^2) for the
largest norm M of their block, queries are brought to length M and get 0; then the nearest vector is the one with
the largest inner product.

The index consists of blocks of vectors, each with its own sorted arrays; every vector is in one block. Blocks are
ranges of norms, so the added component stays small beside the others, and within a range vectors are dealt out by
hash. Query blocks meet every block of vectors, and only the best k of each block are handed on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fernwick.llm.common import arrow_map, only, store

PROJECTIONS = 128
# Widening of the windows from step to step.
GROWTH = 1.08
BLOCK = 4_096
QUERY_BLOCK = 256
# Norm classes per doubling, and the classes of one range: norms of a block differ by a factor of 1.09 at most.
CLASSES, SPAN = 32, 4
# Sorted arrays whose ranks are compared together: smaller pieces took longer.
ARRAYS = 128
# Ranges with fewer vectors are put together, whatever their norms; blocks below twice that are verified in full.
FEW = 256


def projections(dim: int, count: int, seed: int) -> np.ndarray:
    """Random directions; the last component belongs to the added one."""
    return np.random.default_rng(seed).standard_normal((dim + 1, count))


def usable_rows(vectors: DataFrame, id_col: str, vec: str) -> DataFrame:
    """Rows that take part: (``_row``, ``_id``, ``_v`` doubles, ``_dim``, ``_norm``). Vectors that are null, empty, zero or
    hold null, NaN or infinite components do not."""
    v = F.col("_v")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = vectors.select(F.monotonically_increasing_id().alias("_row"), vectors[id_col].cast("long").alias("_id"),
                          vectors[vec].cast("array<double>").alias("_v"))
    rows = rows.filter(v.isNotNull() & ~odd & F.exists(v, lambda x: x != 0))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    return rows.withColumns({"_dim": F.size(v), "_norm": norm})


def norm_blocks(counts: dict[int, int], block: int = BLOCK) -> dict[int, tuple[int, int]]:
    """For each norm class its first block and the number of blocks it is dealt to, from the vectors per class.

    Classes are taken in ascending order, up to ``SPAN`` neighbouring ones together; ranges with fewer than ``FEW``
    vectors that follow each other share a block until there are that many.
    """
    ranges: list[tuple[list[int], int, bool]] = []
    for c in sorted(counts):
        if ranges and c < ranges[-1][0][0] + SPAN:
            classes, n, _ = ranges[-1]
            classes.append(c)
            ranges[-1] = (classes, n + counts[c], False)
        else:
            ranges.append(([c], counts[c], False))
    merged: list[tuple[list[int], int, bool]] = []
    for classes, n, _ in ranges:
        few = n < FEW
        if few and merged and merged[-1][2] and merged[-1][1] < FEW:
            merged[-1] = (merged[-1][0] + classes, merged[-1][1] + n, True)
        else:
            merged.append((classes, n, few))
    out, first = {}, 0
    for classes, n, few in merged:
        parts = 1 if few else max(1, -(-n // block))
        out |= dict.fromkeys(classes, (first, parts))
        first += parts
    return out


def build_index(rows: DataFrame, count: int = PROJECTIONS, seed: int = 17, block: int = BLOCK) -> DataFrame:
    """One row per block: its largest norm, ids, row numbers, vectors, and per projection the sorted values and their
    order."""
    # Norms that are too small for a logarithm are one class.
    rows = rows.withColumn("_class", F.coalesce(F.floor(F.log2("_norm") * CLASSES), F.lit(-(1 << 30)).cast("long")))
    counts: dict[int, dict[int, int]] = {}
    # One row per class: a few dozen for a factor of 2 between norms.
    for r in rows.groupBy("_dim", "_class").agg(F.count("*").alias("n")).collect():
        counts.setdefault(r["_dim"], {})[r["_class"]] = r["n"]
    plan = [(d, c, *at) for d, of in counts.items() for c, at in norm_blocks(of, block).items()]
    plan = rows.sparkSession.createDataFrame(plan, "_dim int, _class long, _first int, _parts int")
    where = (F.col("_first") + F.pmod(F.xxhash64("_row"), F.col("_parts"))).cast("int")

    def build(table: pa.Table) -> pa.Table:
        dim = table["_dim"][0].as_py()
        data = np.array(table["_v"].to_pylist(), np.float64).reshape(-1, dim)
        norms = np.sqrt((data * data).sum(1))
        top = norms.max()
        rest = np.sqrt(np.maximum((top - norms) * (top + norms), 0))
        value = np.column_stack([data, rest]) @ projections(dim, count, seed)
        order = np.argsort(value, axis=0, kind="stable")
        return pa.table({
            "dim": pa.array([dim], pa.int32()), "block": table["block"][:1], "n": pa.array([len(data)], pa.int32()), "top": [top],
            "ids": [table["_id"].to_numpy().astype("<i8").tobytes()], "rows": [table["_row"].to_numpy().astype("<i8").tobytes()],
            "data": [data.astype("<f8").tobytes()], "values": [np.take_along_axis(value, order, 0).T.astype("<f8").tobytes()],
            "order": [order.T.astype("<i4").tobytes()]})

    dealt = rows.join(F.broadcast(plan), ["_dim", "_class"]).select("_row", "_id", "_v", "_dim", where.alias("block"))
    return dealt.groupBy("_dim", "block").applyInArrow(
        build, "dim int, block int, n int, top double, ids binary, rows binary, data binary, values binary, order binary")


def _query_blocks(queries: DataFrame, size: int) -> DataFrame:
    """Queries in blocks by length; a block is a bounded group."""
    total = {r["_dim"]: r["n"] for r in queries.groupBy("_dim").agg(F.count("*").alias("n")).collect()}
    pick = [F.when(F.col("_dim") == d, F.lit(max(1, -(-n // size)))) for d, n in total.items()]
    where = F.pmod(F.xxhash64("_row", F.lit(1)), F.coalesce(*pick, F.lit(1))).cast("int")

    def pack(table: pa.Table) -> pa.Table:
        data = np.array(table["_v"].to_pylist(), np.float64)
        return pa.table({"dim": pa.array([table["_dim"][0].as_py()], pa.int32()), "qids": [table["_id"].to_numpy().astype("<i8").tobytes()],
                         "qrows": [table["_row"].to_numpy().astype("<i8").tobytes()], "qdata": [data.astype("<f8").tobytes()]})

    return queries.withColumn("part", where).groupBy("_dim", "part").applyInArrow(
        pack, "dim int, qids binary, qrows binary, qdata binary")


class SortedArrays:
    """The sorted arrays of one block, searched together: array i is moved to its own stretch of one long line."""

    def __init__(self, values: np.ndarray, order: np.ndarray):
        count, self.n = values.shape
        self.reach = 2 * float(np.abs(values).max()) + 1
        self.base = 3 * self.reach * np.arange(count)
        self.line = (values + self.base[:, None]).reshape(-1)
        self.first = self.n * np.arange(count)
        self.rank = np.empty(values.shape, np.uint16 if self.n < 1 << 16 else np.uint32)
        np.put_along_axis(self.rank, order.astype(np.int64), np.arange(self.n, dtype=self.rank.dtype)[None], 1)
        part = min(count, ARRAYS)
        self.apart, self.inside = np.empty((part, self.n), self.rank.dtype), np.empty((part, self.n), bool)
        self.count_kind = np.uint8 if count < 1 << 8 else np.uint16

    def collisions(self, q: np.ndarray, radius: float) -> np.ndarray:
        """In how many arrays each vector lies in the query's window: its rank is between the window's ends."""
        edge = min(radius, self.reach)
        q = np.clip(q, -self.reach / 2, self.reach / 2)
        low = np.searchsorted(self.line, q - edge + self.base, "left") - self.first
        high = np.searchsorted(self.line, q + edge + self.base, "right") - self.first
        low, wide = low[:, None].astype(self.rank.dtype), (high - low)[:, None].astype(self.rank.dtype)
        out = np.zeros(self.n, self.count_kind)
        for i in range(0, len(low), len(self.apart)):
            rank = self.rank[i:i + len(self.apart)]
            apart, inside = self.apart[:len(rank)], self.inside[:len(rank)]
            np.subtract(rank, low[i:i + len(rank)], out=apart)
            np.less(apart, wide[i:i + len(rank)], out=inside)
            out += np.add.reduce(inside.view(np.uint8), axis=0, dtype=self.count_kind)
        return out

    def window_search(self, q: np.ndarray, want: int, need: int, radius: float, guess: int = 0) -> tuple[np.ndarray, float]:
        """Vectors with at least ``need`` collisions in the first window that has ``want`` of them, and its radius. Wider
        windows hold more, so the search may begin ``guess`` steps later and go back."""
        steps = [radius]

        def tried(at: int) -> tuple[np.ndarray, bool]:
            while len(steps) <= at:
                steps.append(steps[-1] * GROWTH)
            hit = np.flatnonzero(self.collisions(q, steps[at]) >= need)
            return hit, len(hit) >= want or steps[at] >= self.reach

        at = guess
        hit, enough = tried(at)
        while not enough:
            at += 1
            hit, enough = tried(at)
        if at == guess:
            while at:
                less, enough = tried(at - 1)
                if not enough:
                    break
                hit, at = less, at - 1
        return hit, steps[at]


def _best(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest scores, ties by id."""
    if len(score) > 2 * k and np.isfinite(score).all():
        near = np.flatnonzero(score >= np.partition(score, -k)[-k])
        return near[np.lexsort((ids[near], -score[near]))[:k]]
    return np.lexsort((ids, -score))[:k]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, count: int = PROJECTIONS, share: float = 0.8,
            verify: float = 0.2, seed: int = 17, id_col: str = "vec_id", vec: str = "embedding", block: int = BLOCK) -> DataFrame:
    """For each query its ``k`` nearest rows found: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``.

    ``queries`` is a condition's result over ``vectors``: rows with the column ``_row`` of ``usable_rows``. A query's own
    row is no candidate; another row of the same id is. Ties go to the smaller id. In each block windows widen
    until k plus the share ``verify`` of the block has collided in ``share`` of the projections; all of these are
    verified, so ties and copies lose none of the work; small blocks are verified in full. Fewer candidates than k: all are returned. Vectors of
    other length than the query's are never candidates.
    """
    index = store(build_index(vectors, count, seed, block), "ann-index")
    blocks = _query_blocks(queries, QUERY_BLOCK)
    # A query set against all rows, block by block: the blocks of one length meet by key.
    spots = index.select("dim", "block")
    met = blocks.join(spots, "dim").join(index, ["dim", "block"])
    need = max(1, round(share * count))

    def search(batch):
        for row in batch.to_pylist():
            n, dim = row["n"], row["dim"]
            values = np.frombuffer(row["values"], "<f8").reshape(count, n)
            order = np.frombuffer(row["order"], "<i4").reshape(count, n)
            data = np.frombuffer(row["data"], "<f8").reshape(n, dim)
            ids, own = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["rows"], "<i8")
            qids, qown = np.frombuffer(row["qids"], "<i8"), np.frombuffer(row["qrows"], "<i8")
            asked = np.frombuffer(row["qdata"], "<f8").reshape(len(qids), dim)
            # The order of the inner products does not depend on a query's length, but that of the distances does.
            norms = np.sqrt((asked * asked).sum(1, keepdims=True))
            scaled = asked * (row["top"] / np.where(norms > 0, norms, 1))
            at = np.column_stack([scaled, np.zeros(len(asked))]) @ projections(dim, count, seed)
            arrays = SortedArrays(values, order)
            want = n if n < 2 * FEW or not np.isfinite(row["top"]) else min(n, k + 1 + int(verify * n))
            # Windows of the first query start small; later ones a little below the last radius of this block.
            radius = float(np.median(np.ptp(values, axis=1))) / 16 or 1e-9
            out = [[], [], [], []]
            for j in range(len(qids)):
                if want == n:
                    hit = np.arange(n)
                else:
                    hit, radius = arrays.window_search(at[j], want, need, radius * GROWTH**-2, 2 if j else 0)
                hit = hit[own[hit] != qown[j]]
                score = data[hit] @ asked[j]
                best = _best(ids[hit], score, k)
                for col, got in zip(out, (np.full(len(best), qown[j]), np.full(len(best), qids[j]), ids[hit][best], score[best])):
                    col.append(got)
            yield dict(zip(("_query", "query_id", "vec_id", "score"), map(np.concatenate, out)))

    found = arrow_map(met, "_query long, query_id long, vec_id long, score double", search)
    w = Window.partitionBy("_query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
