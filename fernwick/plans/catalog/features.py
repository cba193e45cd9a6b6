"""Categories, missing values, scaling and sequence shapes."""

from pyspark.sql import functions as F

from fernwick.functions import arrays as A
from fernwick.functions.text import words
from fernwick.operators import features as J
from fernwick.plans.catalog.ordered import _events
from fernwick.plans.catalog.registry import query
from fernwick.plans.catalog.relational import _TAGS, WORDS, doc_tags


def _code(col, table, where=""):
    """SQL table of the sorted distinct values of a column with codes from 0."""
    return f"(SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT CAST({col} AS VARCHAR) AS v FROM {table} {where}) WHERE v IS NOT NULL)"


@query("train_cats", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", v AS value, code FROM {_code(c, 'customer')}" for c in ("c_name", "c_mktsegment")))
def _(t):
    return J.train_cats(t.customer)


@query("apply_cats", f"""
    SELECT c_custkey, code AS c_mktsegment FROM customer LEFT JOIN {_code('c_mktsegment', 'customer', "WHERE c_mktsegment <> 'MACHINERY'")} ON c_mktsegment = v""")
def _(t):
    trained = J.train_cats(t.customer.filter("c_mktsegment <> 'MACHINERY'").select("c_mktsegment"))
    return J.apply_cats(t.customer.select("c_custkey", "c_mktsegment"), trained, ["c_mktsegment"])


_ORDER = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH"]


@query("set_category_order", """
    SELECT o_orderkey, CAST(nullif(list_position(['5-LOW', '4-NOT SPECIFIED', '3-MEDIUM', '2-HIGH'], o_orderpriority), 0) - 1 AS INTEGER) AS code FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", A.category_position("o_orderpriority", _ORDER).alias("code"))


_SEG = "CASE WHEN c_nationkey > 3 THEN c_mktsegment END"


@query("numericalize", f"""
    SELECT c_custkey, coalesce(code + 1, 0) AS seg FROM (SELECT c_custkey, {_SEG} AS seg FROM customer) LEFT JOIN {_code(_SEG, 'customer')} ON seg = v""")
def _(t):
    rows = t.customer.select("c_custkey", F.expr(_SEG).alias("seg"))
    return J.numericalize(rows, J.category_dictionary(rows, ["seg"]), ["seg"])[0]


_GAP = "CASE WHEN value >= 10 THEN value END"


@query("fix_missing", f"""
    WITH e AS (SELECT event_id, {_GAP} AS value FROM events)
    SELECT event_id, coalesce(value, (SELECT median(value) FROM e)) AS value, value IS NULL AS value_na FROM e""")
def _(t):
    rows = _events(t).select("event_id", F.expr(_GAP).alias("value"))
    return J.fix_missing(rows)[0]


@query("fix_missing_stored", f"""
    SELECT event_id, coalesce({_GAP}, 500.0) AS value, ({_GAP}) IS NULL AS value_na, false AS event_id_na FROM events""")
def _(t):
    rows = _events(t).select("event_id", F.expr(_GAP).alias("value"))
    return J.fix_missing(rows, na_dict={"value": 500.0, "event_id": 7})[0]


_SEGS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("get_dummies", "SELECT c_custkey, " + ", ".join(
    f"CAST(CASE WHEN {_SEG} = '{s}' THEN 1 ELSE 0 END AS INTEGER) AS \"seg_{s}\"" for s in _SEGS)
    + f", CAST(CASE WHEN {_SEG} IS NULL THEN 1 ELSE 0 END AS INTEGER) AS seg_nan FROM customer")
def _(t):
    rows = t.customer.select("c_custkey", F.expr(_SEG).alias("seg"))
    return J.get_dummies(rows, J.category_dictionary(rows, ["seg"]), ["seg"])


def _z(c):
    return f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6)"


@query("scale_vars", f"""
    WITH l AS (SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, l_quantity, l_discount, CAST(l_quantity > 25 AS INTEGER) AS big FROM lineitem)
    SELECT {_z('l_quantity')} AS l_quantity, {_z('l_discount')} AS l_discount, {_z('big')} AS big FROM l""")
def _(t):
    rows = t.lineitem.select("l_quantity", "l_discount", (F.col("l_quantity") > 25).alias("big"))
    out, _ = J.scale_vars(rows)
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


_RAW = """r AS (SELECT l_orderkey, CASE WHEN l_quantity > 5 THEN l_quantity END AS q, CASE WHEN l_discount > 0 THEN l_discount END AS d, l_tax AS tax,
    CASE WHEN l_linenumber < 7 THEN l_returnflag END AS flag, l_linestatus AS status, l_extendedprice AS price FROM lineitem),
    m AS (SELECT median(q) AS mq, median(d) AS md FROM r)"""
_FILLED = f"""{_RAW}, f AS (SELECT l_orderkey, coalesce(q, mq) AS q, coalesce(d, md) AS d, tax * 2 AS tax, flag, status, price, q IS NULL AS q_na, d IS NULL AS d_na FROM r, m)"""


def sales_rows(t):
    return t.lineitem.select(
        "l_orderkey", F.expr("CASE WHEN l_quantity > 5 THEN l_quantity END").alias("q"),
        F.expr("CASE WHEN l_discount > 0 THEN l_discount END").alias("d"), F.col("l_tax").alias("tax"),
        F.expr("CASE WHEN l_linenumber < 7 THEN l_returnflag END").alias("flag"), F.col("l_linestatus").alias("status"),
        F.col("l_extendedprice").alias("price"))


def _double_tax(df):
    return df.withColumn("tax", F.col("tax") * 2)


@query("proc_df", f"""
    WITH {_FILLED} SELECT l_orderkey, q, d, tax, coalesce(a.code + 1, 0) AS flag, coalesce(b.code + 1, 0) AS status, q_na, d_na, price AS y
    FROM f LEFT JOIN {_code('flag', 'r')} a ON flag = a.v LEFT JOIN {_code('status', 'r')} b ON status = b.v""")
def _(t):
    return J.proc_df(sales_rows(t), "price", ignore_flds=["l_orderkey"], preproc_fn=_double_tax).x


@query("proc_df_scaled", f"""
    WITH {_FILLED}, g AS (SELECT l_orderkey, q, d, tax, flag, status, CAST(q_na AS INTEGER) AS q_na, CAST(d_na AS INTEGER) AS d_na FROM f)
    SELECT l_orderkey, {_z('q')} AS q, {_z('d')} AS d, {_z('tax')} AS tax, {_z('q_na')} AS q_na, {_z('d_na')} AS d_na, b.code AS y,
      CAST(coalesce(flag = 'A', false) AS INTEGER) AS flag_A, CAST(coalesce(flag = 'N', false) AS INTEGER) AS flag_N, CAST(coalesce(flag = 'R', false) AS INTEGER) AS flag_R,
      CAST(flag IS NULL AS INTEGER) AS flag_nan
    FROM g LEFT JOIN {_code('status', 'r')} b ON status = b.v""")
def _(t):
    x = J.proc_df(sales_rows(t).drop("price"), "status", ignore_flds=["l_orderkey"], preproc_fn=_double_tax, do_scale=True, max_n_cat=3).x
    return x.withColumns({c: F.round(c, 6) for c in ("q", "d", "tax", "q_na", "d_na")})


@query("preproc_hook", """
    SELECT l_orderkey, l_tax * 2 AS tax, l_extendedprice AS y FROM lineitem""")
def _(t):
    return J.proc_df(sales_rows(t).select("l_orderkey", "tax", "price"), "price", ignore_flds=["l_orderkey"],
                     preproc_fn=_double_tax).x


@query("get_nn_mappers", f"""
    WITH e AS (SELECT event_id, {_GAP} AS value, CASE WHEN event_type <> 'error' THEN event_type END AS kind FROM events),
    f AS (SELECT event_id, coalesce(value, max(value) OVER () + 100) AS value, coalesce(kind, '#NA#') AS kind FROM e)
    SELECT event_id, {_z('value')} AS value, code AS kind FROM f LEFT JOIN {_code('kind', 'f')} ON kind = v""")
def _(t):
    rows = _events(t).select("event_id", F.expr(_GAP).alias("value"),
                             F.expr("CASE WHEN event_type <> 'error' THEN event_type END").alias("kind"))
    m = J.get_nn_mappers(rows, ["kind"], ["value"])
    out = J.apply_cats(J.scale_vars(m.table, m.scaler)[0], m.categories, ["kind"])
    return out.withColumn("value", F.round("value", 6))


_IDS = f"ids AS (SELECT doc_id, list_transform({WORDS}, lambda w: length(w)) AS x FROM documents)"


def doc_ids(t):
    """Word lengths stand for ids."""
    return t.documents.select("doc_id", F.transform(words("text"), F.length).alias("x"))


def _txt(c):
    return F.array_join(F.col(c).cast("array<string>"), " ")


@query("n_hot", f"""
    WITH {_IDS} SELECT doc_id, array_to_string(list_transform(range(10), lambda i: CAST(list_contains(x, i) AS INTEGER)), ' ') AS hot FROM ids""")
def _(t):
    return doc_ids(t).select("doc_id", A.n_hot(F.col("x"), 10).cast("array<int>").alias("hot")).select("doc_id", _txt("hot").alias("hot"))


@query("one_hot", "SELECT vec_id, array_to_string(list_transform(range(10), lambda i: CAST(i = label AS INTEGER)), ' ') AS hot FROM embeddings")
def _(t):
    return t.embeddings.select("vec_id", A.one_hot(F.col("label"), 10).cast("array<int>").alias("hot")).select(
        "vec_id", _txt("hot").alias("hot"))


@query("nhot_labels", f"""
    WITH d AS (SELECT doc_id, {_TAGS} AS tags FROM documents), n AS (SELECT list(DISTINCT l ORDER BY l) AS names FROM (SELECT unnest(tags) AS l FROM d))
    SELECT doc_id, array_to_string(list_transform(names, lambda l: CAST(list_contains(tags, l) AS INTEGER)), ' ') AS hot FROM d, n""")
def _(t):
    out, _ = J.nhot_labels(doc_tags(t), "doc_id", "tags")
    return out.select("doc_id", F.array_join(F.col("label_vector").cast("array<int>").cast("array<string>"), " ").alias("hot"))


@query("single_label_index", """
    SELECT doc_id, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS label FROM documents""")
def _(t):
    return J.nhot_labels(t.documents.select("doc_id", F.array("lang").alias("tags")), "doc_id", "tags")[0]


@query("embedding_sizes", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) + 1 AS cardinality, least(50, (count(DISTINCT {c}) + 2) // 2) AS size FROM customer"
    for c in ("c_mktsegment", "c_nationkey", "c_name")))
def _(t):
    return J.embedding_sizes(t.customer, ["c_mktsegment", "c_nationkey", "c_name"])


@query("assemble", """
    SELECT l_orderkey, l_linenumber || ' ' || l_suppkey AS cats, CAST(CAST(l_quantity AS FLOAT) AS INTEGER) AS q, CAST(l_discount AS FLOAT) AS d,
           CAST(l_extendedprice AS FLOAT) AS y FROM lineitem""")
def _(t):
    out = J.assemble(t.lineitem, ["l_linenumber", "l_suppkey"], ["l_quantity", "l_discount"], "l_extendedprice", ["l_orderkey"])
    return out.select("l_orderkey", _txt("cats").alias("cats"), F.col("conts")[0].cast("int").alias("q"), F.col("conts")[1].alias("d"), "y")


@query("pad_batch", f"""
    WITH {_IDS}, b AS (SELECT doc_id, x, max(len(x)) OVER (PARTITION BY doc_id // 16) AS m FROM ids)
    SELECT doc_id, array_to_string(list_concat(list_transform(range(m - len(x)), lambda i: 1), x), ' ') AS x FROM b""")
def _(t):
    rows = doc_ids(t).withColumn("batch", F.expr("doc_id div 16"))
    return J.pad_batch(rows, "x", "batch", 1, True).select("doc_id", _txt("x").alias("x"))


@query("bow_pad", f"""
    WITH {_IDS}, u AS (SELECT doc_id, list_transform(x, lambda i: i + 1) AS x FROM ids)
    SELECT doc_id, array_to_string(list_concat(list_transform(range(greatest(100 - len(x), 0)), lambda i: 0), x[greatest(len(x) - 99, 1):]), ' ') AS x FROM u""")
def _(t):
    return doc_ids(t).select("doc_id", A.bow_pad(F.col("x"), 100).alias("x")).select("doc_id", _txt("x").alias("x"))


@query("wrap_sequence", f"""
    WITH {_IDS} SELECT doc_id, array_to_string(list_concat([0], list_append(list_reverse(x), 2)), ' ') AS x FROM ids""")
def _(t):
    return doc_ids(t).select("doc_id", A.wrap_sequence(F.col("x"), True, 0, 2).alias("x")).select("doc_id", _txt("x").alias("x"))


@query("truncate", f"WITH {_IDS} SELECT doc_id, array_to_string(x[:30], ' ') AS x FROM ids")
def _(t):
    return doc_ids(t).select("doc_id", A.truncate(F.col("x"), 30).alias("x")).select("doc_id", _txt("x").alias("x"))


@query("rebase_labels", "SELECT vec_id, label + 3 - min(label + 3) OVER () AS label, max(label) OVER () - min(label) OVER () + 1 AS n_classes FROM embeddings")
def _(t):
    return J.rebase_labels(t.embeddings.select("vec_id", (F.col("label") + 3).alias("label")), "label")


@query("bb_corners", """
    SELECT l_orderkey, greatest(l_tax * 100 - 4, 0) AS row1, greatest(l_discount * 100 - 5, 0) AS col1,
           greatest(l_tax * 100 - 4, 0) + l_quantity AS row2, greatest(l_discount * 100 - 5, 0) + l_linenumber AS col2 FROM lineitem""")
def _(t):
    corners = A.bb_corners(F.col("l_quantity"), F.col("l_linenumber"), F.col("l_discount") * 100 - 5, F.col("l_tax") * 100 - 4)
    return t.lineitem.select("l_orderkey", *corners)


# Size of the vocabulary of fixed-length sequences.
KEPT = 20_000


@query("fixed_length", rf"""
    WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents), n AS (SELECT CAST(floor(quantile_cont(len(w), 0.7)) AS BIGINT) AS n FROM d),
    k AS (SELECT token, row_number() OVER (ORDER BY count(*) DESC, token) + 3 AS id FROM (SELECT unnest(w) AS token FROM d) GROUP BY 1 ORDER BY count(*) DESC, token LIMIT {KEPT}),
    s AS (SELECT doc_id, list_concat([2], list_append(list(coalesce(id, 1) ORDER BY i), 3)) AS s FROM (SELECT doc_id, unnest(w) AS token, unnest(range(len(w))) AS i FROM d) LEFT JOIN k USING (token) GROUP BY 1)
    SELECT doc_id, array_to_string(list_concat(list_transform(range(greatest(n - len(s), 0)), lambda i: 0), s[greatest(len(s) - n + 1, 1):]), ' ') AS ids FROM s, n""")
def _(t):
    docs = t.documents.select("doc_id", words("text").alias("w"))
    out, _, _ = J.fixed_length(docs, "w", KEPT)
    return out.select("doc_id", _txt("ids").alias("ids"))


