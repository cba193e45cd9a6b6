"""Nearest neighbours, pooling, clustering and linear maps of vectors.

Distance work runs as matrix products on Arrow batches inside tasks; only the best ``k`` rows per
query and task are shuffled. Which side is sent to the tasks is decided by checked row counts,
and when neither side is small the table is put into cells, of which each query meets those that can matter.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fernwick.session import cut_lineage, fits, written

# Vectors sent to every task: 4,096 of 500 doubles are 16 MB.
LOCAL_VECTORS = 4096
BLOCK_ROWS = 8192
# Numbers of a vector table that is sent to every task: 64 MB.
LOCAL_CELLS = 8_000_000
# Documents of a block, and vectors added in one step, of a pooling by blocks.
POOL_DOCS = 16_384
# Lengths up to which differences are squared one by one instead of expanding the square.
DIRECT_DIMS = 16


def dense(vec: str | Column) -> Column:
    return array_to_vector(F.col(vec) if isinstance(vec, str) else vec)


def mean_vectors(df: DataFrame, vec: str, keys: Sequence[str] = ()) -> DataFrame:
    """Element-wise mean per key (or over all rows), by partial aggregation of whole vectors."""
    rows = df.select(*keys, dense(F.col(vec).cast("array<double>")).alias("_v"))
    return rows.groupBy(*keys).agg(Summarizer.mean(F.col("_v")).alias("_m")).select(
        *keys, vector_to_array("_m").alias(vec))


def _matrix(values) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in values]) if len(values) else np.zeros((0, 0))


def _unit(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(n == 0, 1.0, n)


def _distances(q: np.ndarray, v: np.ndarray, metric: str) -> np.ndarray:
    """Distances rounded to 9 digits, so that equal vectors tie and the id decides."""
    if metric == "euclidean":
        if q.shape[-1] <= DIRECT_DIMS:  # small distances keep all their digits
            sq = sum((q[:, k, None] - v[None, :, k]) ** 2 for k in range(q.shape[-1])) if len(q) and len(v) else np.zeros((len(q), len(v)))
        else:
            sq = (q * q).sum(1)[:, None] + (v * v).sum(1)[None, :] - 2 * q @ v.T
        return np.round(np.sqrt(np.maximum(sq, 0)), 9)
    cos = np.clip(_unit(q) @ _unit(v).T, -1.0, 1.0)
    return np.round(np.arccos(cos) if metric == "angular" else 1 - cos, 9)


def _best(ids: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(d) > k:
        near = d <= np.partition(d, k - 1)[k - 1]
        ids, d = ids[near], d[near]
    order = np.lexsort((ids, d))[:k]
    return ids[order], d[order]


def _nearest(q: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int, metric: str) -> list:
    """Best ``k`` of ``v`` for each row of ``q``; the distance matrix is made in slices of about 16 MB."""
    step = max(1, 2_000_000 // max(1, len(v)))
    return [_best(ids, d, k) for i in range(0, len(q), step) for d in _distances(q[i:i + step], v, metric)]


def _collect_vectors(df: DataFrame, id_col: str, vec: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids and matrix of a table whose row count was checked before."""
    pdf = df.select(id_col, vec).toPandas()
    return pdf[id_col].to_numpy(), _matrix(pdf[vec].tolist())


def knn(table: DataFrame, queries: DataFrame, k: int, id_col: str = "id", vec: str = "vec",
        query_id: str = "query_id", query_vec: str = "query_vec", metric: str = "cosine",
        local_rows: int = LOCAL_VECTORS, block_rows: int = 4 * BLOCK_ROWS) -> DataFrame:
    """Exact ``k`` nearest rows per query: ``(query_id, id, distance, place)``; ties by id.

    ``metric`` is ``cosine``, ``angular`` or ``euclidean``.
    """
    types = {f.name: f.dataType for f in (*table.schema.fields, *queries.schema.fields)}
    schema = T.StructType([T.StructField(query_id, types[query_id]), T.StructField(id_col, types[id_col]),
                           T.StructField("distance", T.DoubleType())])
    table, queries = table.select(id_col, vec), queries.select(query_id, query_vec)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        parts = [(np.repeat(np.asarray([q]), len(i)), i, d) for q, i, d in rows]
        cols = [np.concatenate(c) for c in zip(*parts)] if parts else [[], [], []]
        return pd.DataFrame(dict(zip((query_id, id_col, "distance"), cols)))

    if fits(table, local_rows):
        ids, matrix = _collect_vectors(table, id_col, vec)

        def per_query(batches):
            for pdf in batches:
                if len(pdf) and len(ids):
                    best = _nearest(_matrix(pdf[query_vec].tolist()), ids, matrix, k, metric)
                    yield frame([(q, *b) for q, b in zip(pdf[query_id], best)])

        near = queries.mapInPandas(per_query, schema)
    elif fits(queries, local_rows):
        qids, qmatrix = _collect_vectors(queries, query_id, query_vec)

        def per_task(batches):
            best = None
            for pdf in batches:
                if not len(pdf):
                    continue
                new = _nearest(qmatrix, pdf[id_col].to_numpy(), _matrix(pdf[vec].tolist()), k, metric)
                best = new if best is None else [
                    _best(np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]), k) for a, b in zip(best, new)]
            if best is not None:
                yield frame([(q, *b) for q, b in zip(qids, best)])

        near = table.mapInPandas(per_task, schema)
    else:
        from fernwick.operators.cells import build_index, search

        # Neither side is small: cells with centre and radius, and only those meet that can matter.
        index = build_index(table, id_col, vec, metric=metric, block_rows=block_rows)
        return search(index, queries, k, query_id, query_vec, block_rows=block_rows).hits.select(query_id, id_col, "distance", "place")
    w = Window.partitionBy(query_id).orderBy("distance", id_col)
    return near.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k)


def attach_metadata(hits: DataFrame, meta: DataFrame, on: str) -> DataFrame:
    """Columns of ``meta`` for each hit; the place of a hit is kept in its own column."""
    return hits.join(meta, on, "left")


def transfer_vectors(new_vocab: DataFrame, vectors: DataFrame, token: str, vec: str) -> DataFrame:
    """Vector by token; tokens without one get the mean of all known vectors."""
    mean = mean_vectors(vectors, vec).scalar()
    known = vectors.select(token, F.col(vec).cast("array<double>").alias(vec))
    return new_vocab.select(token).join(known, token, "left").withColumn(vec, F.coalesce(vec, mean))


def scaled_lookup(vocab: DataFrame, vectors: DataFrame, token: str, vec: str, factor: float = 3.0
                  ) -> tuple[DataFrame, DataFrame]:
    """Scaled vectors of the known tokens, and the tokens that were missed."""
    from fernwick.functions.vectors import scale

    hits = vocab.select(token).join(vectors.select(token, vec), token).withColumn(vec, scale(F.col(vec), factor))
    return hits, vocab.select(token).join(vectors.select(token), token, "left_anti")


def pool(docs: DataFrame, tokens: str, vectors: DataFrame, id_col: str, token: str = "token", vec: str = "vec",
         local_cells: int = LOCAL_CELLS) -> DataFrame:
    """``(id, mean, max, last)`` over the vectors of a document's known tokens.

    A vector table of at most ``local_cells`` numbers goes to the tasks, which pool whole Arrow
    batches in place. Of a larger one the most frequent tokens do, and blocks of documents get the
    others. Documents without a known token are left out.
    """
    vectors = written(vectors.select(token, F.col(vec).cast("array<double>").alias(vec)), "vectors")
    size = vectors.agg(F.count("*"), F.max(F.size(vec))).first()
    if size[0] * (size[1] or 0) <= local_cells:
        names, matrix = _collect_vectors(vectors, token, vec)
        known = pa.array(names)
        out = T.ArrayType(T.DoubleType())

        def pooled(batches):
            for batch in batches:
                lists = batch.column(1)
                place = pc.index_in(lists.flatten(), value_set=known)
                doc = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
                hit = place.is_valid().to_numpy(zero_copy_only=False)
                rows, doc = place.filter(place.is_valid()).to_numpy(), doc[hit]
                at, start = np.unique(doc, return_index=True)
                means, highs, lasts = [], [], []
                for lo, hi in zip(start, [*start[1:], len(doc)]):
                    v = matrix[rows[lo:hi]]
                    means.append(v.mean(0))
                    highs.append(v.max(0))
                    lasts.append(v[-1])
                kind = pa.list_(pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), *[pa.array(x, kind) for x in (means, highs, lasts)]],
                    names=[id_col, "mean", "max", "last"])

        schema = T.StructType([docs.schema[id_col], *[T.StructField(n, out) for n in ("mean", "max", "last")]])
        return docs.select(id_col, tokens).mapInArrow(pooled, schema)
    return _pool_blocks(docs, tokens, vectors, id_col, token, vec, size[1], local_cells // size[1])


class _Sums:
    """Number, sum, largest items and last vector of each of ``n`` documents, over vectors that come in parts."""

    def __init__(self, n: int, dim: int):
        self.n, self.total, self.high = np.zeros(n, np.int64), np.zeros((n, dim)), np.full((n, dim), -np.inf)
        self.at, self.last = np.full(n, -1, np.int32), np.zeros((n, dim))

    def add(self, doc: np.ndarray, v: np.ndarray, pos: np.ndarray) -> None:
        """``v[k]`` stands at place ``pos[k]`` of document ``doc[k]``."""
        if not len(doc):
            return
        order = np.lexsort((pos, doc))
        doc, v, pos = doc[order], v[order], pos[order]
        at, start = np.unique(doc, return_index=True)
        end = np.append(start[1:], len(doc))
        self.n[at] += end - start
        self.total[at] += np.add.reduceat(v, start)
        self.high[at] = np.maximum(self.high[at], np.maximum.reduceat(v, start))
        later = pos[end - 1] > self.at[at]
        self.at[at[later]], self.last[at[later]] = pos[end - 1][later], v[end - 1][later]


def _lists(m: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, max(1, m.shape[1]), dtype=np.int32)[:len(m) + 1]), pa.array(m.ravel()))


def _pool_blocks(docs: DataFrame, tokens: str, vectors: DataFrame, id_col: str, token: str, vec: str, dim: int, local: int) -> DataFrame:
    """`pool` for a vector table of any size.

    Vectors of the ``local`` most frequent tokens go to the tasks. For rarer tokens the documents are dealt to blocks of
    about ``POOL_DOCS``: a block gets the vector of a token once, with the places where it holds the token, and adds
    vectors to its sums as they stream in. No row is made per token with a vector in it.
    """
    from fernwick.operators.vocab import most_frequent

    docs = written(docs.select(id_col, F.col(tokens).alias("_w")).withColumn("_row", F.monotonically_increasing_id()), "pool-docs")
    counts = docs.select(F.explode("_w").alias(token)).groupBy(token).agg(F.count("*").alias("_times"))
    once = vectors.groupBy(token).agg(F.count("*").alias("_rows")).filter("_rows = 1").select(token)
    hot = cut_lineage(most_frequent(counts.join(once, token), local, token, "_times").select(token))  # ``local`` rows
    names, matrix = _collect_vectors(vectors.join(F.broadcast(hot), token), token, vec)
    known, matrix = pa.array(names, pa.string()), matrix.reshape(len(names), dim)
    blocks = max(1, -(-docs.count() // POOL_DOCS))

    def near(batches):
        for batch in batches:
            lists, sums = batch.column(2), _Sums(batch.num_rows, dim)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            flat, doc = lists.flatten(), np.repeat(np.arange(len(sizes)), sizes)
            pos = np.arange(len(doc)) - (np.cumsum(sizes) - sizes)[doc]
            place = pc.fill_null(pc.index_in(flat, value_set=known), -1).to_numpy(zero_copy_only=False)
            hit = np.flatnonzero(place >= 0)
            for k in range(0, len(hit), POOL_DOCS):
                some = hit[k:k + POOL_DOCS]
                sums.add(doc[some], matrix[place[some]], pos[some])
            miss = (place < 0) & flat.is_valid().to_numpy(zero_copy_only=False)
            rest = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc[miss], minlength=len(sizes)))]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sums.n), _lists(sums.total), _lists(sums.high), pa.array(sums.at), _lists(sums.last),
                 pa.ListArray.from_arrays(rest, flat.filter(pa.array(miss))), pa.ListArray.from_arrays(rest, pa.array(pos[miss], pa.int32()))],
                names=[id_col, "_row", "_n", "_sum", "_high", "_at", "_last", "_rest", "_pos"])

    vector = T.ArrayType(T.DoubleType())
    schema = T.StructType([docs.schema[id_col], docs.schema["_row"], T.StructField("_n", T.LongType()), T.StructField("_sum", vector), T.StructField("_high", vector),
                           T.StructField("_at", T.IntegerType()), T.StructField("_last", vector), T.StructField("_rest", T.ArrayType(T.StringType())),
                           T.StructField("_pos", T.ArrayType(T.IntegerType()))])
    parts = docs.select(id_col, "_row", "_w").mapInArrow(near, schema).withColumn("_block", F.pmod(F.xxhash64("_row"), F.lit(blocks)).cast("int"))
    parts = written(parts, "pool-parts")
    occurs = parts.select("_block", "_row", F.inline(F.arrays_zip("_rest", "_pos"))).withColumnRenamed("_rest", token)
    # Dealt by token once, for the grouping and for the join.
    places = occurs.repartition(token).groupBy(token, "_block").agg(F.collect_list(F.struct("_row", "_pos")).alias("_places"))
    far = places.join(vectors, token).select("_block", F.lit(1).alias("_kind"), F.col(vec).alias("_sum"), F.col("_places._row").alias("_rows"), F.col("_places._pos").alias("_places"))
    own = parts.select("_block", F.lit(0).alias("_kind"), "_sum", id_col, "_row", "_n", "_high", "_at", "_last")
    both = own.unionByName(far, allowMissingColumns=True).repartition(blocks, "_block").sortWithinPartitions("_block", "_kind")
    names = both.columns

    def opened(pieces: list[pa.RecordBatch]) -> tuple[pa.Array, np.ndarray, np.ndarray, _Sums]:
        """Ids, sorted rows with their order, and the sums so far of a block's documents."""
        table = pa.Table.from_batches(pieces).combine_chunks()
        sums = _Sums(0, dim)
        sums.n, sums.at = (table[c].to_numpy().copy() for c in ("_n", "_at"))
        sums.total, sums.high, sums.last = (pc.list_flatten(table[c]).to_numpy().reshape(-1, dim).copy() for c in ("_sum", "_high", "_last"))
        row = table["_row"].to_numpy()
        order = np.argsort(row)
        return table[id_col], row[order], order, sums

    def gather(batches):
        """Of each block first its documents, then vectors and where they stand."""
        block, pieces, held = None, [], None

        def closed():
            ids, _, _, sums = held or opened(pieces)
            known = np.flatnonzero(sums.n > 0)
            for k in range(0, len(known), 4096):
                some = known[k:k + 4096]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(some)).combine_chunks(), *[_lists(m) for m in (sums.total[some] / sums.n[some, None], sums.high[some], sums.last[some])]],
                    names=[id_col, "mean", "max", "last"])

        for batch in batches:
            of, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((np.diff(of) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
                if lo == hi:
                    continue
                if of[lo] != block:
                    if pieces:
                        yield from closed()
                    block, pieces, held = of[lo], [], None
                cut = batch.slice(lo, hi - lo)
                if not kind[lo]:
                    pieces.append(cut)
                    continue
                held = held or opened(pieces)
                v = cut.column(names.index("_sum")).flatten().to_numpy().reshape(-1, dim)
                where = cut.column(names.index("_rows"))
                which = np.repeat(np.arange(len(v)), pc.list_value_length(where).to_numpy())
                row, pos = where.flatten().to_numpy(), cut.column(names.index("_places")).flatten().to_numpy()
                for k in range(0, len(which), POOL_DOCS):
                    doc = held[2][np.searchsorted(held[1], row[k:k + POOL_DOCS])]
                    held[3].add(doc, v[which[k:k + POOL_DOCS]], pos[k:k + POOL_DOCS])
        if pieces:
            yield from closed()

    return both.mapInArrow(gather, T.StructType([docs.schema[id_col], *[T.StructField(n, vector) for n in ("mean", "max", "last")]]))


def knn_approx(table: DataFrame, queries: DataFrame, k: int, id_col: str = "id", vec: str = "vec",
               query_id: str = "query_id", query_vec: str = "query_vec", probes: int | None = None) -> DataFrame:
    """Approximate cosine neighbours: a cell index of ``table``, of which each query meets the ``probes`` cells with the
    nearest centres (half of them by default). To search a table several times, build and store the index once."""
    from fernwick.operators.cells import build_index, search

    index = build_index(table, id_col, vec)
    return search(index, queries, k, query_id, query_vec, probes=probes or max(1, len(index.count) // 2)).hits


def pca(df: DataFrame, vec: str, k: int = 3, out: str = "components"):
    """Fitted model and the projected rows; the covariance is summed in the tasks."""
    rows = df.withColumn("_v", dense(F.col(vec).cast("array<double>")))
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(rows)
    return model, model.transform(rows).withColumn(out, vector_to_array("_p")).drop("_v", "_p")


def farthest_first(df: DataFrame, id_col: str, vec: str, k: int) -> np.ndarray:
    """Start centres: the row farthest from a seed row, then always the row farthest from all chosen; ties go to the
    smaller id, of any type.

    The seed (smallest id) itself is no centre. Each row keeps its distance to the nearest centre so far in a stored
    column, so a pass computes one distance per row; only the farthest row of each pass reaches the driver.
    """
    rows = df.select(F.col(id_col).alias("_id"), F.col(vec).cast("array<double>").alias("_v"))
    seed = rows.agg(F.min_by("_v", "_id")).first()[0]
    if seed is None or k < 1:
        return np.zeros((0, 0))
    far = nearest_centre(rows, "_v", np.array([seed])).agg(F.min_by("_v", F.struct(-F.col("_distance"), "_id"))).first()[0]
    centres = [np.asarray(far)]
    rows = cut_lineage(nearest_centre(rows, "_v", np.array(centres)).drop("cluster").withColumnRenamed("_distance", "_near"))
    while len(centres) < k:
        far = rows.agg(F.min_by("_v", F.struct(-F.col("_near"), "_id"))).first()[0]
        centres.append(np.asarray(far))
        if len(centres) < k:
            last = nearest_centre(rows, "_v", np.array(centres[-1:]))
            rows = cut_lineage(last.select("_id", "_v", F.least("_near", "_distance").alias("_near")))
    return np.stack(centres)


def nearest_centre(df: DataFrame, vec: str, centres: np.ndarray) -> DataFrame:
    """Add ``cluster`` and ``_distance`` (squared, 9 digits) of the nearest centre."""

    def assign(v: pd.Series) -> pd.DataFrame:
        m = _matrix(v.tolist())
        if not len(m):
            return pd.DataFrame({"c": np.zeros(0, dtype=np.int32), "d": np.zeros(0)})
        sq = np.stack([((m - c) ** 2).sum(1) for c in centres], axis=1)
        sq = np.round(sq, 9)
        return pd.DataFrame({"c": sq.argmin(1).astype(np.int32), "d": sq.min(1)})

    udf = F.pandas_udf(assign, T.StructType([T.StructField("c", T.IntegerType()), T.StructField("d", T.DoubleType())]))
    out = df.withColumn("_a", udf(F.col(vec)))
    return out.select(*df.columns, F.col("_a.c").alias("cluster"), F.col("_a.d").alias("_distance"))


def kmeans_round(df: DataFrame, vec: str, centres: np.ndarray) -> DataFrame:
    """``(cluster, n, vec)``: new centres as means of the assigned rows."""
    rows = nearest_centre(df, vec, centres).select(
        "cluster", dense(F.col(vec).cast("array<double>")).alias("_v"))
    return rows.groupBy("cluster").agg(F.count("*").alias("n"), Summarizer.mean(F.col("_v")).alias("_m")).select(
        "cluster", "n", vector_to_array("_m").alias(vec))


def kmeans(df: DataFrame, id_col: str, vec: str, k: int, rounds: int = 10) -> tuple[np.ndarray, DataFrame]:
    """Centres and assigned rows; stops when the centres no longer move. ``k`` rows per round reach the driver."""
    centres = farthest_first(df, id_col, vec, k)
    for _ in range(rounds):
        moved = centres.copy()
        for r in kmeans_round(df, vec, centres).collect():
            moved[r["cluster"]] = r[vec]
        if np.allclose(moved, centres, rtol=0, atol=1e-12):
            break
        centres = moved
    return centres, nearest_centre(df, vec, centres).drop("_distance")


def fit_space_map(df: DataFrame, x: str, y: str, penalty: float = 1e-3) -> np.ndarray:
    """Ridge map from space ``x`` (with intercept) to space ``y``.

    Tasks return the Gram matrix of their rows, one row per dimension; the sums have as many rows
    as dimensions, and the small system is solved on the driver.
    """
    schema = "i int, g array<double>"

    def gram(batches):
        total = None
        for pdf in batches:
            if len(pdf):
                a = _matrix(pdf[x].tolist())
                a = np.hstack([a, np.ones((len(a), 1))])
                g = a.T @ np.hstack([a, _matrix(pdf[y].tolist())])
                total = g if total is None else total + g
        if total is not None:
            yield pd.DataFrame({"i": np.arange(len(total), dtype=np.int32), "g": list(total)})

    parts = df.select(x, y).mapInPandas(gram, schema).select("i", dense("g").alias("g"))
    rows = parts.groupBy("i").agg(Summarizer.sum(F.col("g")).alias("g")).orderBy("i").collect()
    g = np.stack([r["g"].toArray() for r in rows])
    d = len(g)
    ridge = np.eye(d) * penalty
    ridge[-1, -1] = 0
    return np.linalg.solve(g[:, :d] + ridge, g[:, d:])


def apply_space_map(df: DataFrame, x: str, weights: np.ndarray, out: str) -> DataFrame:
    def project(v: pd.Series) -> pd.Series:
        m = _matrix(v.tolist())
        return pd.Series(list(m @ weights[:-1] + weights[-1]) if len(m) else [])

    udf = F.pandas_udf(project, T.ArrayType(T.DoubleType()))
    return df.withColumn(out, udf(F.col(x)))
