"""Projections, joins, aggregations, sorting and sets."""

from pyspark.sql import functions as F

from fernwick.functions.text import words
from fernwick.operators import relational as R
from fernwick.plans.catalog.registry import query
from fernwick.session import bounded_broadcast

WORDS = r"regexp_extract_all(text, '[\p{L}\p{N}_]+')"

# ---------------------------------------------------------------- projections and filters


@query("split_repo_path", """
    SELECT page_id, split_part(url, '/', 3) AS nwo, '/' || array_to_string((string_split(url, '/'))[4:], '/') AS path
    FROM pages""")
def _(t):
    host = F.regexp_extract("url", r"^\w+://([^/]+)", 1)
    path = F.regexp_extract("url", r"^\w+://[^/]+(/.*)$", 1)
    raw = t.pages.select(F.concat(F.lit(" "), host, F.lit("  "), path).alias("repo_path"), "page_id")
    return R.split_repo_path(raw)


@query("make_url", """
    SELECT page_id, 'https://code.example.org/' || split_part(url, '/', 3) || '/blob/master/p' || page_id
        || '.py#L' || length(html) AS link FROM pages""")
def _(t):
    rows = t.pages.select("page_id", F.split_part("url", F.lit("/"), F.lit(3)).alias("nwo"),
                          F.concat(F.lit("p"), F.col("page_id").cast("string"), F.lit(".py")).alias("path"),
                          F.length("html").alias("lineno"))
    return rows.select("page_id", R.make_url("https://code.example.org").alias("link"))


@query("partition_by_docstring", r"""
    SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) >= 3 AS has_docstring
    FROM documents""")
def _(t):
    enough, rest = R.partition_by_docstring(t.documents.select("doc_id", "text"), "text", 3)
    return enough.select("doc_id", F.lit(True).alias("has_docstring")).union(
        rest.select("doc_id", F.lit(False).alias("has_docstring")))


@query("to_flag", "SELECT o_orderkey, o_orderstatus <> 'O' AS closed FROM orders")
def _(t):
    return t.orders.select("o_orderkey", R.to_flag("o_orderstatus", "O").alias("closed"))


@query("overwrite_where", """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN l_quantity < 5 THEN 'small' ELSE l_returnflag END AS l_returnflag FROM lineitem""")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity")
    return R.overwrite_where(rows, F.col("l_quantity") < 5, "l_returnflag", "small").drop("l_quantity")


_OPEN = "date_diff('day', DATE '1998-06-15', CAST(o_orderdate AS DATE))"


@query("bucket_and_cap", f"""
    SELECT o_orderkey, CAST(least(greatest(floor({_OPEN} / 30.0), 0), 24) AS INTEGER) AS months_open,
           CAST(least(greatest(floor({_OPEN} / 7.0), 0), 25) AS INTEGER) AS weeks_open FROM orders""")
def _(t):
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1998-06-15").cast("date"))
    return t.orders.select("o_orderkey", R.bucket_and_cap(days, 30, 24).alias("months_open"),
                           R.bucket_and_cap(days, 7, 25).alias("weeks_open"))


@query("drop_suffix_cols", """
    SELECT n_nationkey, n_name, n_regionkey, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""")
def _(t):
    region = t.region.withColumnRenamed("r_regionkey", "n_regionkey").withColumn("n_name", F.lit("twin"))
    return R.drop_suffix_cols(R.join_df(t.nation, region, "n_regionkey"))


@query("filter_rows", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 30 AND l_discount <> 0")
def _(t):
    return R.filter_rows(t.lineitem, "l_quantity > 30 AND l_discount <> 0").select(
        "l_orderkey", "l_linenumber", "l_quantity")


@query("cast_columns", """
    SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, CAST(l_quantity AS FLOAT) AS l_quantity,
           CAST(l_discount AS FLOAT) AS l_discount FROM lineitem""")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return R.cast_columns(rows, ["l_linenumber"], ["l_quantity", "l_discount"])


@query("select_columns", "SELECT l_orderkey, l_suppkey, l_tax FROM lineitem")
def _(t):
    return R.select_columns(t.lineitem, ["l_orderkey", "l_suppkey", "l_tax"])


_CARD = ["l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"]


@query("low_cardinality_cols", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct, "
    f"count(DISTINCT {c}) < count(*) / 50.0 AS is_categorical FROM lineitem" for c in _CARD))
def _(t):
    return R.low_cardinality_cols(t.lineitem, _CARD)


@query("keep_short", rf"SELECT doc_id, len({WORDS}) AS n FROM documents WHERE len({WORDS}) < 30")
def _(t):
    rows = t.documents.select("doc_id", words("text").alias("tokens"))
    return R.keep_short(rows, "tokens", 30).select("doc_id", F.size("tokens").cast("long").alias("n"))


@query("null_fraction", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN {e} IS NULL THEN 1.0 ELSE 0.0 END), 9) AS fraction FROM events"
    for c, e in (("event_id", "event_id"), ("value", "CASE WHEN value >= 10 THEN value END"),
                 ("props", "CASE WHEN event_type <> 'error' THEN props END"))))
def _(t):
    rows = t.events.select("event_id", F.when(F.col("value") >= 10, F.col("value")).alias("value"),
                           F.when(F.col("event_type") != "error", F.col("props")).alias("props"))
    return R.null_fraction(rows).withColumn("fraction", F.round("fraction", 9))


@query("unmatched_after_join", """
    SELECT count(*) AS unmatched FROM customer WHERE NOT EXISTS (
        SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)""")
def _(t):
    big = t.orders.filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return R.unmatched_after_join(t.customer, big, ["c_custkey"])


@query("log_target", "SELECT o_orderkey, round(ln(o_totalprice), 9) AS y, round(exp(ln(o_totalprice)), 3) AS y_back FROM orders")
def _(t):
    rows = t.orders.select("o_orderkey", R.log_target("o_totalprice").alias("y"))
    return rows.select("o_orderkey", F.round("y", 9).alias("y"), F.round(R.inv_y("y"), 3).alias("y_back"))


@query("derive", """
    SELECT l_orderkey, l_linenumber, l_partkey, year(l_shipdate) - 1990 AS age,
           round(l_extendedprice / l_quantity, 9) AS unit_price FROM lineitem""")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                             (F.year("l_shipdate") - 1990).cast("long").alias("age"),
                             F.round(F.col("l_extendedprice") / F.col("l_quantity"), 9).alias("unit_price"))


@query("fill_constant", """
    SELECT event_id, CAST(coalesce(CASE WHEN value >= 10 THEN trunc(value) END, 1900) AS INTEGER) AS filled FROM events""")
def _(t):
    rows = t.events.select("event_id", F.when(F.col("value") >= 10, F.col("value")).alias("v"))
    return rows.select("event_id", R.fill_constant("v", 1900).alias("filled"))


# ---------------------------------------------------------------- joins


@query("join_df", """
    SELECT o_orderkey, o_custkey, c_name, c_acctbal, o_orderstatus, c_mktsegment AS o_orderstatus_y
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def _(t):
    right = t.customer.select("c_custkey", "c_name", "c_acctbal", F.col("c_mktsegment").alias("o_orderstatus"))
    left = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    return R.join_df(left, right, "o_custkey", "c_custkey").drop("c_custkey")


@query("multi_key_join", """
    WITH daily AS (SELECT o_custkey AS k, year(o_orderdate) AS y, CAST(weekofyear(o_orderdate) AS INTEGER) AS w, count(*) AS n
                   FROM orders GROUP BY ALL)
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(weekofyear(o_orderdate) AS INTEGER) AS w, n
    FROM orders LEFT JOIN daily ON o_custkey = k AND year(o_orderdate) = y AND weekofyear(o_orderdate) = w""")
def _(t):
    rows = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"),
                           F.weekofyear("o_orderdate").alias("w"))
    daily = rows.groupBy("o_custkey", "y", "w").agg(F.count("*").alias("n"))
    return R.join_df(rows, daily, ["o_custkey", "y", "w"]).drop("o_custkey")


@query("join_special_slice", """
    WITH m AS (SELECT n_name, n_regionkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)
    SELECT o_orderkey, o.r_name AS r_name, s.n_name AS n_name_DE
    FROM (SELECT o_orderkey, CAST(o_orderkey % 5 AS INTEGER) AS rk, r_name
          FROM orders LEFT JOIN region ON CAST(o_orderkey % 5 AS INTEGER) = r_regionkey) o
    LEFT JOIN (SELECT * FROM m WHERE n_name = 'NATION_3') s ON rk = s.n_regionkey""")
def _(t):
    rows = t.orders.select("o_orderkey", (F.col("o_orderkey") % 5).cast("int").alias("r_regionkey"))
    left = R.join_df(rows, t.region, "r_regionkey").withColumn("n_name", F.lit(""))
    out = R.join_special_slice(left, t.nation.drop("n_nationkey"), F.col("n_name") == "NATION_3",
                               ["r_regionkey"], ["n_regionkey"])
    return out.select("o_orderkey", "r_name", "n_name_DE")


_RATINGS = """ratings AS (SELECT o_custkey AS user_id, l_partkey AS item_id, l_quantity AS rating, l_orderkey, l_linenumber
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def ratings(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("item_id"),
                              F.col("l_quantity").alias("rating"))
    return lines.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"),
                                      F.col("o_custkey").alias("user_id")), "l_orderkey")


@query("join_top_entities", f"""
    WITH {_RATINGS},
    u AS (SELECT user_id FROM ratings GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 150),
    i AS (SELECT item_id FROM ratings GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 150)
    SELECT user_id, item_id, rating FROM ratings SEMI JOIN u USING (user_id) SEMI JOIN i USING (item_id)""")
def _(t):
    return R.join_top_entities(ratings(t), "user_id", "item_id", 150).select("user_id", "item_id", "rating")


@query("lookup_or_default", rf"""
    WITH tok AS (SELECT doc_id, unnest({WORDS}) AS token FROM documents),
    dict AS (SELECT token, row_number() OVER (ORDER BY count(*) DESC, token) + 3 AS id FROM tok GROUP BY token
             ORDER BY count(*) DESC, token LIMIT 60000)
    SELECT coalesce(id, 3) AS id, count(*) AS n FROM tok LEFT JOIN dict USING (token) GROUP BY 1""")
def _(t):
    from fernwick.operators.vocab import build_vocab

    rows = t.documents.select(F.explode(words("text")).alias("token"))
    vocab = build_vocab(rows, max_vocab=60_000, specials=["_bos_", "_pad_", "_eos_", "_unk_"])
    known = bounded_broadcast(vocab.filter("id > 3").select("token", "id"))
    return R.lookup_or_default(rows, known, "token", "id", 3).groupBy("id").agg(F.count("*").alias("n"))


@query("lookup_ignore_case", """
    SELECT c_custkey, c_mktsegment, p_type FROM customer JOIN (
        SELECT DISTINCT p_type FROM part UNION SELECT DISTINCT lower(c_mktsegment) FROM customer WHERE c_nationkey < 10)
    ON lower(c_mktsegment) = lower(p_type)""")
def _(t):
    names = t.part.select("p_type").union(
        t.customer.filter("c_nationkey < 10").select(F.lower("c_mktsegment"))).distinct()
    return R.lookup_ignore_case(t.customer.select("c_custkey", "c_mktsegment"), names, "c_mktsegment", "p_type")


@query("keep_known_keys", "SELECT o_orderkey, o_custkey FROM orders SEMI JOIN (SELECT c_custkey AS o_custkey FROM customer WHERE c_acctbal > 0) USING (o_custkey)")
def _(t):
    known = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return R.keep_known_keys(t.orders.select("o_orderkey", "o_custkey"), known, ["o_custkey"])


# ---------------------------------------------------------------- aggregations


@query("top_groups", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
def _(t):
    return R.top_groups(t.orders, ["o_custkey"], 15)


_PRIO = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("crosstab_sum", "SELECT o_custkey, " + ", ".join(
    f"round(sum(CASE WHEN o_orderpriority = '{p}' THEN o_totalprice END), 4) AS \"{p}\"" for p in _PRIO)
    + " FROM orders GROUP BY 1")
def _(t):
    wide = R.crosstab_sum(t.orders, "o_custkey", "o_orderpriority", _PRIO, "o_totalprice")
    return wide.select("o_custkey", *[F.round(p, 4).alias(p) for p in _PRIO])


@query("group_mean", """
    SELECT o_orderpriority, round(avg(o_totalprice), 5) AS o_totalprice FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY 1""")
def _(t):
    rows = t.orders.filter("o_orderstatus is not null")
    return R.group_mean(rows, ["o_orderpriority"], ["o_totalprice"]).withColumn(
        "o_totalprice", F.round("o_totalprice", 5))


@query("value_counts", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def _(t):
    return R.value_counts(t.customer, "c_mktsegment")


@query("nunique", "SELECT count(DISTINCT l_partkey) AS n_distinct FROM lineitem")
def _(t):
    return R.nunique(t.lineitem, "l_partkey")


@query("unique", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def _(t):
    return R.unique(t.lineitem, ["l_suppkey", "l_returnflag"])


@query("median", "SELECT c_mktsegment, round(median(c_acctbal), 6) AS median FROM customer GROUP BY 1")
def _(t):
    return R.median(t.customer, "c_acctbal", ["c_mktsegment"]).withColumn("median", F.round("median", 6))


_SCALED = ["l_quantity", "l_extendedprice", "l_discount"]


@query("fit_mean_std", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM lineitem" for c in _SCALED))
def _(t):
    return R.fit_mean_std(t.lineitem, _SCALED).select(
        "column", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query("min_max", "SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, max(o_totalprice) * 1.2::DOUBLE AS \"limit\" FROM orders")
def _(t):
    return R.min_max(t.orders, "o_totalprice")


@query("length_percentiles", rf"""
    WITH x AS (SELECT len({WORDS}) AS n FROM documents)
    SELECT round(quantile_cont(n, 0.90), 6) AS p90, round(quantile_cont(n, 0.97), 6) AS p97,
           round(quantile_cont(n, 0.99), 6) AS p99 FROM x""")
def _(t):
    lengths = t.documents.select(F.size(words("text")).alias("n"))
    out = R.percentiles(lengths, "n", [0.90, 0.97, 0.99])
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


_DESC = ["l_quantity", "l_tax", "l_extendedprice"]


@query("describe", " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 5) AS mean, round(stddev_samp({c}), 5) AS std,
           min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
           round(quantile_cont({c}, 0.75), 6) AS q75, max({c}) AS max, count(DISTINCT {c}) AS "unique",
           CAST(count(*) - count({c}) AS BIGINT) AS missing,
           (SELECT {c} FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
           (SELECT count(*) FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top_freq
    FROM lineitem""" for c in _DESC))
def _(t):
    out = R.describe(t.lineitem, _DESC)
    places = {"mean": 5, "std": 5, "p25": 6, "p50": 6, "p75": 6}
    renamed = {"p25": "q25", "p50": "q50", "p75": "q75"}
    return out.select(*[(F.round(c, places[c]) if c in places else F.col(c)).alias(renamed.get(c, c))
                        for c in out.columns])


@query("drop_duplicates", "SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text")
def _(t):
    return R.drop_duplicates(t.documents.select("doc_id", "text"), ["text"], "doc_id")


@query("removed_duplicates", """
    SELECT count(*) AS before_dedup, count(DISTINCT text) AS after_dedup, count(*) - count(DISTINCT text) AS removed FROM documents""")
def _(t):
    return R.removed_duplicates(t.documents.select("doc_id", "text"), ["text"], "doc_id")


@query("token_freq", rf"""
    SELECT token, count(*) AS n FROM (SELECT unnest({WORDS}) AS token FROM documents) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 500""")
def _(t):
    return R.top_groups(t.documents.select(F.explode(words("text")).alias("token")), ["token"], 500)


@query("largest_by", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity * l_extendedprice AS area FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity * l_extendedprice DESC, l_linenumber, l_partkey) = 1""")
def _(t):
    area = F.col("l_quantity") * F.col("l_extendedprice")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", area.alias("area"))
    return R.largest_by(rows, ["l_orderkey"], F.col("area"), ["l_linenumber", "l_partkey"])


@query("unigram_probs", """
    SELECT i AS size_id, round(coalesce(n, 0) / (SELECT count(*) FROM part), 9) AS prob
    FROM range(60) r(i) LEFT JOIN (SELECT p_size, count(*) AS n FROM part GROUP BY 1) ON p_size = i""")
def _(t):
    ids = t.part.select(F.col("p_size").cast("long").alias("size_id"))
    return R.unigram_probs(ids, "size_id", 60).withColumn("prob", F.round("prob", 9))


@query("weighted_mean_metric", """
    WITH b AS (SELECT l_suppkey, avg(l_discount) AS metric, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT round(sum(metric * n) / sum(n), 9) AS metric FROM b""")
def _(t):
    batches = t.lineitem.groupBy("l_suppkey").agg(F.avg("l_discount").alias("metric"), F.count("*").alias("n"))
    return batches.agg(F.round(R.weighted_mean("metric", "n"), 9).alias("metric"))


@query("corpus_counts", rf"""
    SELECT count(*) AS n_rows, CAST(sum(len({WORDS})) AS BIGINT) AS n_tokens,
           (SELECT count(DISTINCT w) FROM (SELECT unnest({WORDS}) AS w FROM documents)) AS n_vocab FROM documents""")
def _(t):
    return R.corpus_counts(t.documents, words("text"))


# ---------------------------------------------------------------- sorting and sets


@query("sort_rows", "SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity FROM lineitem")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    return R.sort_rows(rows, {"l_shipdate": True, "l_quantity": False, "l_orderkey": True, "l_linenumber": True})


@query("top_bottom", """
    (SELECT o_orderkey, o_totalprice, 'top' AS side FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15) UNION ALL
    (SELECT o_orderkey, o_totalprice, 'bottom' AS side FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 15)""")
def _(t):
    return R.top_bottom(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey", 15)


@query("union_all", """
    SELECT doc_id AS id, text FROM documents UNION ALL SELECT item_id AS id, text FROM benchmark
    UNION ALL SELECT conv_id AS id, text FROM conversations""")
def _(t):
    return R.union_all([t.documents.select(F.col("doc_id").alias("id"), "text"),
                        t.benchmark.select(F.col("item_id").alias("id"), "text"),
                        t.conversations.select(F.col("conv_id").alias("id"), "text")])


_TAGS = "list_filter([lang, source, CASE WHEN n_chars > 2000 THEN 'long' END], lambda x: x IS NOT NULL)"


def doc_tags(t):
    """Documents with a label set: language, source and, for long texts, ``long``."""
    tags = F.array("lang", "source", F.when(F.col("n_chars") > 2000, "long"))
    return t.documents.select("doc_id", F.filter(tags, lambda x: x.isNotNull()).alias("tags"))


@query("union_labels", f"SELECT DISTINCT unnest({_TAGS}) AS label FROM documents")
def _(t):
    return R.union_labels(doc_tags(t), "tags")


@query("vocab_overlap", rf"""
    WITH a AS (SELECT DISTINCT unnest({WORDS}) AS token FROM benchmark),
    b AS (SELECT DISTINCT unnest({WORDS}) AS token FROM documents)
    SELECT token, token IN (SELECT token FROM b) AS found FROM a""")
def _(t):
    return R.vocab_overlap(t.benchmark.select(F.explode(words("text")).alias("token")),
                           t.documents.select(F.explode(words("text")).alias("token")))
