"""Vector arithmetic, nearest neighbours, clustering and maps."""

from pyspark.sql import functions as F

from fernwick.functions import text as T
from fernwick.functions import vectors as X
from fernwick.operators import vectors as V
from fernwick.operators.shift import mean_shift, shift
from fernwick.plans.catalog.registry import query
from fernwick.plans.catalog.relational import WORDS
from fernwick.session import written

# A vector as text: items in millionths.
def as_text(c):
    return F.array_join(F.transform(c, lambda x: F.round(x.cast("double") * 1e6).cast("long").cast("string")), " ")


def sql_text(c):
    return f"array_to_string(list_transform({c}, lambda z: CAST(round(CAST(z AS DOUBLE) * 1000000) AS BIGINT)), ' ')"


_E = "e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"
_LONG = f"{_E}, x AS (SELECT vec_id, label, unnest(v) AS x, unnest(range(len(v))) AS i FROM e)"
_CENTRES = f"""{_LONG}, c AS (SELECT label, list(m ORDER BY i) AS q FROM (SELECT label, i, avg(x) AS m FROM x GROUP BY ALL) GROUP BY 1)"""


def centres(t):
    """Mean vector of each label."""
    return V.mean_vectors(t.embeddings, "embedding", ["label"])


def _against_centre(t):
    own = centres(t).withColumnRenamed("embedding", "q")
    return t.embeddings.join(own, "label").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("v"), "q")


_PAIR = f"WITH {_CENTRES}, p AS (SELECT vec_id, v, q FROM e JOIN c USING (label))"


@query("cosine_distance", f"{_PAIR} SELECT vec_id, round(list_cosine_distance(v, q), 9) AS distance FROM p")
def _(t):
    return _against_centre(t).select("vec_id", F.round(X.cosine_distance(F.col("v"), F.col("q")), 9).alias("distance"))


@query("euclidean", f"{_PAIR} SELECT vec_id, round(list_distance(v, q), 9) AS distance, round(list_distance(v, q) ** 2, 9) AS squared FROM p")
def _(t):
    v, q = F.col("v"), F.col("q")
    return _against_centre(t).select("vec_id", F.round(X.euclidean(v, q), 9).alias("distance"),
                                     F.round(X.squared_euclidean(v, q), 9).alias("squared"))


@query("vector_corr", f"""
    {_PAIR} SELECT vec_id, round(corr(a, b), 6) AS corr FROM (SELECT vec_id, unnest(v) AS a, unnest(q) AS b FROM p) GROUP BY 1""")
def _(t):
    return _against_centre(t).select("vec_id", F.round(X.vector_corr(F.col("v"), F.col("q")), 6).alias("corr"))


@query("vector_mean", f"WITH {_CENTRES} SELECT label, {sql_text('q')} AS centre FROM c")
def _(t):
    return centres(t).select("label", as_text("embedding").alias("centre"))


@query("transfer_vectors", f"""
    WITH {_LONG}, m AS (SELECT list(m ORDER BY i) AS m FROM (SELECT i, avg(x) AS m FROM x GROUP BY 1))
    SELECT p_partkey AS vec_id, {sql_text('coalesce(v, m)')} AS vec FROM part LEFT JOIN e ON p_partkey = vec_id, m""")
def _(t):
    new = t.part.select(F.col("p_partkey").alias("vec_id"))
    return V.transfer_vectors(new, t.embeddings, "vec_id", "embedding").select("vec_id", as_text("embedding").alias("vec"))


@query("scaled_lookup", f"SELECT p_partkey AS vec_id, {sql_text('list_transform(embedding, lambda y: CAST(y AS DOUBLE) * 3)')} AS vec FROM part JOIN embeddings ON p_partkey = vec_id")
def _(t):
    hits, _ = V.scaled_lookup(t.part.select(F.col("p_partkey").alias("vec_id")), t.embeddings, "vec_id", "embedding")
    return hits.select("vec_id", as_text("embedding").alias("vec"))


@query("scaled_lookup_misses", "SELECT p_partkey AS vec_id FROM part WHERE p_partkey NOT IN (SELECT vec_id FROM embeddings)")
def _(t):
    return V.scaled_lookup(t.part.select(F.col("p_partkey").alias("vec_id")), t.embeddings, "vec_id", "embedding")[1]


# Every token has a vector: the one that its hash names.
@query("pool", rf"""
    WITH tok AS (SELECT doc_id, unnest({WORDS}) AS token, unnest(range(len({WORDS}))) AS pos FROM documents),
    k AS (SELECT token, CAST('0x' || substr(md5(token), 1, 8) AS BIGINT) % (SELECT count(*) FROM embeddings) AS vec_id FROM (SELECT DISTINCT token FROM tok)),
    h AS (SELECT doc_id, pos, CAST(embedding AS DOUBLE[]) AS v FROM tok JOIN k USING (token) JOIN embeddings USING (vec_id)),
    l AS (SELECT doc_id, max_by(v, pos) AS last FROM h GROUP BY 1),
    d AS (SELECT doc_id, i, avg(x) AS a, max(x) AS m FROM (SELECT doc_id, unnest(v) AS x, unnest(range(len(v))) AS i FROM h) GROUP BY ALL),
    g AS (SELECT doc_id, list(a ORDER BY i) AS a, list(m ORDER BY i) AS m FROM d GROUP BY 1)
    SELECT doc_id, {sql_text('a')} AS mean, {sql_text('m')} AS "max", {sql_text('last')} AS last FROM g JOIN l USING (doc_id)""")
def _(t):
    docs = written(t.documents.select("doc_id", T.words("text").alias("w")), "words")
    tokens = docs.select(F.explode("w").alias("token")).distinct()
    number = F.conv(F.substring(F.md5("token"), 1, 8), 16, 10).cast("long") % F.lit(t.embeddings.count())
    vectors = tokens.withColumn("vec_id", number).join(t.embeddings.select("vec_id", "embedding"), "vec_id")
    out = V.pool(docs, "w", vectors, "doc_id", vec="embedding")
    return out.select("doc_id", *[as_text(c).alias(c) for c in ("mean", "max", "last")])


def _hits(sql_queries, k, extra="", dist="list_cosine_distance(v, q)"):
    return f"""h AS (SELECT query_id, vec_id, round({dist}, 9) AS distance FROM {sql_queries}, e),
    r AS (SELECT query_id, vec_id, distance, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS place FROM h QUALIFY place <= {k})"""


def _out(hits, *more):
    return hits.select("query_id", "vec_id", F.round("distance", 6).alias("distance"), "place", *more)


@query("knn", f"""
    WITH {_CENTRES}, {_hits('(SELECT label AS query_id, q FROM c)', 10)}
    SELECT query_id, vec_id, round(distance, 6) AS distance, place FROM r""")
def _(t):
    queries = centres(t).select(F.col("label").alias("query_id"), F.col("embedding").alias("query_vec"))
    return _out(V.knn(t.embeddings, queries, 10, "vec_id", "embedding"))


@query("knn_batch", f"""
    WITH {_E}, {_hits('(SELECT vec_id AS query_id, v AS q FROM e) z', 10, dist='acos(greatest(least(list_cosine_similarity(v, q), 1), -1))')}
    SELECT query_id, vec_id, round(distance, 6) AS distance, place FROM r WHERE query_id <> vec_id""")
def _(t):
    queries = t.embeddings.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    hits = V.knn(t.embeddings, queries, 10, "vec_id", "embedding", metric="angular")
    return _out(hits.filter("query_id <> vec_id"))


@query("knn_approx")
def _(t):
    queries = centres(t).select(F.col("label").alias("query_id"), F.col("embedding").alias("query_vec"))
    return _out(V.knn_approx(t.embeddings, queries, 10, "vec_id", "embedding"))


@query("cross_space_search", f"""
    WITH {_CENTRES}, m AS (SELECT a.label AS query_id, list_transform(list_zip(a.q, b.q), lambda z: (z[1] + z[2]) / 2) AS q FROM c a JOIN c b ON b.label = (a.label + 1) % 10),
    {_hits('m', 5)} SELECT query_id, vec_id, round(distance, 6) AS distance, place FROM r""")
def _(t):
    words = centres(t)
    after = words.select(F.pmod(F.col("label") - 1, F.lit(10)).alias("label"), F.col("embedding").alias("other"))
    queries = words.join(after, "label").select(
        F.col("label").alias("query_id"), X.vector_mean(F.col("embedding"), F.col("other")).alias("query_vec"))
    return _out(V.knn(t.embeddings, queries, 5, "vec_id", "embedding"))


# Orders as points: price in ten thousands, months, customer in hundreds.
def _points(t):
    months = F.datediff("o_orderdate", F.lit("1992-01-01").cast("date")) / 30.0
    return t.orders.select("o_orderkey", F.array(F.col("o_totalprice") / 10000.0, months, F.col("o_custkey") / 100.0).alias("point"))


_POINTS = """p AS (SELECT o_orderkey, [o_totalprice / 10000.0::DOUBLE, date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) / 30.0::DOUBLE, o_custkey / 100.0::DOUBLE] AS point FROM orders)"""


def _near_points(queries, k):
    return f"""f AS (SELECT query_id, min({{'d': round(list_distance(point, q), 9), 'id': o_orderkey}}, {k}) AS best FROM {queries}, p GROUP BY 1),
    h AS (SELECT query_id, unnest(best) AS b, CAST(unnest(range(1, len(best) + 1)) AS INTEGER) AS place FROM f)
    SELECT query_id, b.id AS o_orderkey, round(b.d, 6) AS distance, place FROM h"""


@query("knn_two_large_sides", f"""
    WITH {_POINTS}, q AS (SELECT o_orderkey AS query_id, point AS q FROM p), {_near_points('q', 5)}""")
def _(t):
    points = _points(t)
    queries = points.select(F.col("o_orderkey").alias("query_id"), F.col("point").alias("query_vec"))
    hits = V.knn(points, queries, 5, "o_orderkey", "point", metric="euclidean", local_rows=1000)
    return hits.select("query_id", "o_orderkey", F.round("distance", 6).alias("distance"), "place")


def _customers(t):
    """The mean order of each customer, as a second set of queries."""
    return V.mean_vectors(_points(t).join(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey"), "point", ["o_custkey"]).select(
        F.col("o_custkey").alias("query_id"), F.col("point").alias("query_vec"))


_CUSTOMERS = "q AS (SELECT query_id, list(m ORDER BY i) AS q FROM (SELECT o_custkey AS query_id, i, avg(x) AS m FROM (SELECT o_orderkey, unnest(point) AS x, unnest(range(3)) AS i FROM p) JOIN orders USING (o_orderkey) GROUP BY ALL) GROUP BY 1)"


@query("knn_index", f"WITH {_POINTS}, {_CUSTOMERS}, {_near_points('q', 10)}")
def _(t):
    from fernwick.operators import cells as C

    index = C.open_index(t.spark, C.build_index(_points(t), "o_orderkey", "point", metric="euclidean").path)
    hits = C.search(index, _customers(t), 10).hits
    return hits.select("query_id", "o_orderkey", F.round("distance", 6).alias("distance"), "place")


@query("knn_index_recall", f"""
    WITH {_POINTS} SELECT 'customers' AS queries, 10 * count(DISTINCT o_custkey) AS hits, true AS recall_of_nine_tenths, true AS compared_under_a_tenth, true AS exact_compared_under_a_tenth FROM orders
    UNION ALL SELECT 'orders', 10 * count(*), true, true, true FROM p""")
def _(t):
    from fernwick.operators import cells as C

    index = C.build_index(_points(t), "o_orderkey", "point", metric="euclidean", cells=150)
    orders = _points(t).select(F.col("o_orderkey").alias("query_id"), F.col("point").alias("query_vec"))
    rows = []
    for name, queries in (("customers", _customers(t)), ("orders", orders)):  # one index, several sets of queries
        exact, near = C.search(index, queries, 10), C.search(index, queries, 10, probes=6)
        wanted = exact.hits.count()
        found = near.hits.join(exact.hits, ["query_id", "o_orderkey"], "left_semi").count()
        rows.append((name, wanted, found >= 0.9 * wanted, near.compared < 0.1 * near.pairs, exact.compared < 0.1 * exact.pairs))
    return t.spark.createDataFrame(rows, "queries string, hits long, recall_of_nine_tenths boolean, compared_under_a_tenth boolean, exact_compared_under_a_tenth boolean")


# The map is solved by elimination: one step per unknown turns the rows of the normal equations into the weights.
_MAPPED = f"""{_CENTRES}, a AS (SELECT vec_id, list_concat(v[1:32], [1.0::DOUBLE]) AS a, v[33:64] AS y FROM e),
    u AS (SELECT vec_id, unnest(a) AS x, unnest(range(33)) AS i, list_concat(a, y) AS z FROM a),
    g AS (SELECT i, j, sum(x * zj) AS g FROM (SELECT i, x, unnest(z) AS zj, unnest(range(65)) AS j FROM u) GROUP BY ALL),
    s AS (SELECT 0 AS k, i, list(g + CASE WHEN i = j AND i < 32 THEN 0.001::DOUBLE ELSE 0 END ORDER BY j) AS r FROM g GROUP BY i
      UNION ALL SELECT k + 1, i, CASE WHEN i = k THEN list_transform(r, lambda t: t / r[k + 1]) ELSE list_transform(list_zip(r, p), lambda t: t[1] - r[k + 1] / p[k + 1] * t[2]) END
      FROM (SELECT k, i, r, any_value(r) FILTER (i = k) OVER () AS p FROM s WHERE k < 33)),
    w AS (SELECT i, unnest(r[34:65]) AS w, unnest(range(32)) AS j FROM s WHERE k = 33),
    m AS (SELECT vec_id, list(v ORDER BY j) AS v FROM (SELECT vec_id, j, sum(x * w) AS v FROM u JOIN w USING (i) GROUP BY ALL) GROUP BY 1)"""


@query("cross_space_index", f"""
    WITH RECURSIVE {_MAPPED},
    h AS (SELECT label AS query_id, vec_id, round(list_cosine_distance(m.v, q[33:64]), 9) AS distance FROM m, c),
    r AS (SELECT query_id, vec_id, distance, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS place FROM h QUALIFY place <= 5)
    SELECT query_id, vec_id, round(distance, 6) AS distance, place FROM r""")
def _(t):
    from fernwick.operators import cells as C

    halves = t.embeddings.select("vec_id", F.slice("embedding", 1, 32).alias("x"), F.slice("embedding", 33, 32).alias("y"))
    space = C.open_space_index(t.spark, C.build_space_index(halves, "vec_id", "x", "y").index.path)
    queries = centres(t).select(F.col("label").alias("query_id"), F.slice("embedding", 33, 32).alias("query_vec"))
    return _out(C.search(space.index, queries, 5).hits)


@query("nearest_label", f"""
    WITH {_CENTRES}, h AS (SELECT vec_id, c.label, round(list_cosine_distance(v, q), 9) AS distance FROM e, c),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY distance, label) AS INTEGER) AS place FROM h QUALIFY place <= 3)
    SELECT vec_id, label, place, round(distance, 6) AS distance, n_name AS name FROM r LEFT JOIN nation ON label = n_nationkey""")
def _(t):
    queries = t.embeddings.select("vec_id", F.col("embedding").alias("query_vec"))
    hits = V.knn(centres(t), queries, 3, "label", "embedding", "vec_id")
    names = t.nation.select(F.col("n_nationkey").alias("label"), F.col("n_name").alias("name"))
    return V.attach_metadata(hits, names, "label").select(
        "vec_id", "label", "place", F.round("distance", 6).alias("distance"), "name")


@query("attach_metadata", f"""
    WITH {_CENTRES}, {_hits('(SELECT label AS query_id, q FROM c)', 5)}
    SELECT query_id, vec_id, place, p_name, p_brand FROM r LEFT JOIN part ON p_partkey = vec_id""")
def _(t):
    queries = centres(t).select(F.col("label").alias("query_id"), F.col("embedding").alias("query_vec"))
    hits = V.knn(t.embeddings, queries, 5, "vec_id", "embedding")
    meta = t.part.select(F.col("p_partkey").alias("vec_id"), "p_name", "p_brand")
    return V.attach_metadata(hits, meta, "vec_id").select("query_id", "vec_id", "place", "p_name", "p_brand")


_PR = f"""WITH {_E}, a AS (SELECT vec_id, list_transform(v, lambda z: abs(z)) AS a FROM e),
    p AS (SELECT vec_id, list_transform(a, lambda z: z / list_sum(a)) AS p FROM a)"""


@query("clip_renorm", f"""
    {_PR}, k AS (SELECT vec_id, list_transform(p, lambda z: greatest(least(z, 0.98::DOUBLE), 0.02::DOUBLE)) AS k FROM p)
    SELECT vec_id, {sql_text('list_transform(k, lambda y: y / list_sum(k))')} AS probs FROM k""")
def _(t):
    size = F.transform("embedding", lambda x: F.abs(x.cast("double")))
    rows = t.embeddings.select("vec_id", size.alias("a")).select("vec_id", F.transform(
        "a", lambda x: x / F.aggregate("a", F.lit(0.0), lambda s, y: s + y)).alias("p"))
    return rows.select("vec_id", as_text(X.clip_renorm(F.col("p"), 0.98)).alias("probs"))


@query("argmax", """
    SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS pred,
           round(exp(CAST(list_max(embedding) AS DOUBLE)), 6) AS prob FROM embeddings""")
def _(t):
    rows = t.embeddings.select("vec_id", X.argmax(F.col("embedding")).alias("pred"), "embedding")
    return rows.select("vec_id", "pred", F.round(F.array_max(X.exp_all(F.col("embedding"))), 6).alias("prob"))


@query("pca")
def _(t):
    _, rows = V.pca(t.embeddings, "embedding", 3)
    return rows.select("vec_id", F.posexplode("components").alias("component", "value"))


def _kmeans_sql(k, rounds):
    """Farthest-first starts and ``rounds`` rounds, unrolled: a centre without rows stays."""
    sq = "round(list_distance(v, {}) ** 2, 9)"
    parts = ["f0 AS (SELECT v AS c FROM e ORDER BY vec_id LIMIT 1)"]
    for j in range(1, k + 1):
        known = [f"(SELECT c FROM f{i})" for i in range(1, j)] or ["(SELECT c FROM f0)"]
        near = f"list_min([{', '.join(sq.format(c) for c in known)}])"
        parts.append(f"f{j} AS MATERIALIZED (SELECT v AS c FROM e ORDER BY {near} DESC, vec_id LIMIT 1)")
    parts.append("c0 AS (" + " UNION ALL ".join(f"SELECT {j - 1} AS cluster, c FROM f{j}" for j in range(1, k + 1)) + ")")
    for r in range(rounds + 1):
        parts.append(f"a{r} AS MATERIALIZED (SELECT vec_id, label, v, min({{'d': {sq.format('c')}, 'cluster': cluster}}).cluster AS cluster FROM e, c{r} GROUP BY ALL)")
        if r < rounds:
            parts.append(f"x{r} AS (SELECT cluster, unnest(v) AS x, unnest(range(len(v))) AS i FROM a{r})")
            parts.append(f"m{r} AS (SELECT cluster, list(m ORDER BY i) AS m FROM (SELECT cluster, i, avg(x) AS m FROM x{r} GROUP BY ALL) GROUP BY 1)")
            parts.append(f"c{r + 1} AS MATERIALIZED (SELECT cluster, coalesce(m, c) AS c FROM c{r} LEFT JOIN m{r} USING (cluster))")
    return f"WITH {_E}, " + ", ".join(parts) + f" SELECT CAST(cluster AS INTEGER) AS cluster, label, count(*) AS n FROM a{rounds} GROUP BY ALL"


@query("pca_components", """
    SELECT CAST(a AS INTEGER) AS a, CAST(b AS INTEGER) AS b, CASE WHEN a = b THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS product,
           CASE WHEN a = b THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS corr FROM range(3) x(a), range(3) y(b)""")
def _(t):
    """Components have length 1 and stand square to each other; what they take from the rows is uncorrelated."""
    model, rows = V.pca(t.embeddings, "embedding", 3)
    parts = model.pc.toArray().T
    corr = rows.agg(*[F.corr(F.get("components", F.lit(a)), F.get("components", F.lit(b))).alias(f"{a}{b}") for a in range(3) for b in range(3)]).first()
    clean = lambda x: round(float(x), 6) + 0.0
    found = [(a, b, abs(clean(parts[a] @ parts[b])), abs(clean(corr[f"{a}{b}"]))) for a in range(3) for b in range(3)]
    return t.spark.createDataFrame(found, "a int, b int, product double, corr double")


@query("kmeans", _kmeans_sql(10, 10))
def _(t):
    _, rows = V.kmeans(t.embeddings, "vec_id", "embedding", 10)
    return rows.groupBy("cluster", "label").agg(F.count("*").alias("n"))


@query("kmeans_round", f"""
    WITH {_E}, s AS (SELECT v AS c0 FROM e ORDER BY vec_id LIMIT 1),
    f1 AS (SELECT v AS c1 FROM e, s ORDER BY round(list_distance(v, c0) ** 2, 9) DESC, vec_id LIMIT 1),
    f2 AS (SELECT v AS c2 FROM e, f1 ORDER BY round(list_distance(v, c1) ** 2, 9) DESC, vec_id LIMIT 1),
    d AS (SELECT vec_id, v, list_transform([list_distance(v, c1), list_distance(v, c2)], lambda z: round(z ** 2, 9)) AS d FROM e, f1, f2),
    a AS (SELECT vec_id, v, CAST(list_position(d, list_min(d)) - 1 AS INTEGER) AS cluster FROM d),
    x AS (SELECT cluster, unnest(v) AS x, unnest(range(len(v))) AS i FROM a),
    m AS (SELECT cluster, count(*) AS n, i, avg(x) AS m FROM x GROUP BY cluster, i)
    SELECT cluster, min(n) AS n, {sql_text('list(m ORDER BY i)')} AS centre FROM m GROUP BY cluster""")
def _(t):
    start = V.farthest_first(t.embeddings, "vec_id", "embedding", 2)
    out = V.kmeans_round(t.embeddings, "embedding", start)
    return out.select("cluster", "n", as_text("embedding").alias("centre"))


def _shift_sql(points, bandwidth, rounds):
    """``rounds`` rounds over the points (id, v) of ``points``, unrolled."""
    parts = [points]
    for r in range(rounds):
        parts.append(f"w{r} AS MATERIALIZED (SELECT a.id, b.id AS other, exp(-0.5 * (list_distance(a.v, b.v) / {bandwidth}::DOUBLE) ** 2) AS w FROM p{r} a, p{r} b)")
        parts.append(f"x{r} AS (SELECT id AS other, unnest(v) AS x, unnest(range(len(v))) AS i FROM p{r})")
        parts.append(f"p{r + 1} AS MATERIALIZED (SELECT id, list(m ORDER BY i) AS v FROM (SELECT w.id, i, sum(w * x) / sum(w) AS m FROM w{r} w JOIN x{r} USING (other) GROUP BY ALL) GROUP BY 1)")
    return "WITH " + ", ".join(parts)


_VECTORS = "p0 AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"


@query("mean_shift_round", f"{_shift_sql(_VECTORS, 2.5, 1)} SELECT id AS vec_id, {sql_text('v')} AS point FROM p1")
def _(t):
    out = mean_shift(t.embeddings, "vec_id", "embedding", 2.5, 1)
    return out.select("vec_id", as_text("embedding").alias("point"))


@query("mean_shift", f"{_shift_sql(_VECTORS, 2.5, 5)} SELECT id AS vec_id, {sql_text('v')} AS point FROM p5")
def _(t):
    out = mean_shift(t.embeddings, "vec_id", "embedding", 2.5, 5)
    return out.select("vec_id", as_text("embedding").alias("point"))


# Customers by account balance and nation: most cells are too far apart to weigh anything.
_SPOTS = "p0 AS (SELECT c_custkey AS id, [c_acctbal / 100.0::DOUBLE, c_nationkey * 10.0::DOUBLE] AS v FROM customer)"


@query("mean_shift_cells", f"{_shift_sql(_SPOTS, 1.5, 5)} SELECT id, {sql_text('v')} AS point, true AS few_weighed FROM p5")
def _(t):
    spots = t.customer.select(F.col("c_custkey").alias("id"), F.array(F.col("c_acctbal") / 100.0, F.col("c_nationkey") * 10.0).alias("v"))
    moved = shift(spots, "id", "v", 1.5, 5, block_rows=max(1, spots.count() // 6))  # some fifty cells
    return moved.points.select("id", as_text("v").alias("point"), F.lit(moved.weighed < 0.5 * moved.pairs).alias("few_weighed"))


@query("map_space", f"""
    WITH RECURSIVE {_MAPPED} SELECT vec_id, round(list_cosine_distance(y, m.v), 6) AS distance FROM m JOIN a USING (vec_id)""")
def _(t):
    halves = t.embeddings.select("vec_id", F.slice("embedding", 1, 32).alias("x"), F.slice("embedding", 33, 32).alias("y"))
    weights = V.fit_space_map(halves, "x", "y")
    return V.apply_space_map(halves, "x", weights, "mapped").select(
        "vec_id", F.round(X.cosine_distance(F.col("y"), F.col("mapped")), 6).alias("distance"))


@query("save_and_load_vectors", f"SELECT vec_id, {sql_text('embedding')} AS vec FROM embeddings")
def _(t):
    from fernwick.session import scratch_path
    from fernwick.sources.files import load_vectors, save_vectors

    path = scratch_path(t.spark, "vectors")
    save_vectors(t.embeddings.select("vec_id", "embedding"), path)
    return load_vectors(t.spark, path, "vec_id", "embedding").select("vec_id", as_text("embedding").alias("vec"))
