"""Windows per key, sampling, splits and calendar fields."""

from pyspark.sql import functions as F

from fernwick.functions import arrays as A
from fernwick.functions import dates as D
from fernwick.functions.text import words
from fernwick.operators import sampling as S
from fernwick.operators import windows as W
from fernwick.plans.catalog.registry import query
from fernwick.plans.catalog.relational import WORDS

# ---------------------------------------------------------------- windows per key

_FLAG = "event_type = 'purchase'"
_DUR = "date_diff('day', {a}, {b})"


def _events(t):
    return t.events.select("event_id", "user_id", "ts", "event_type", "value")


@query("days_since_last", f"""
    SELECT event_id, CAST(date_diff('day', max(CASE WHEN {_FLAG} THEN CAST(ts AS DATE) END) OVER (
        PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), CAST(ts AS DATE)) AS INTEGER) AS after
    FROM events""")
def _(t):
    out = W.days_since_last(_events(t), F.expr(_FLAG), ["user_id"], "ts", "event_id")
    return out.select("event_id", "after")


@query("days_until_next", f"""
    SELECT event_id, CAST(date_diff('day', min(CASE WHEN {_FLAG} THEN CAST(ts AS DATE) END) OVER (
        PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
        CAST(ts AS DATE)) AS INTEGER) AS before FROM events""")
def _(t):
    out = W.days_until_next(_events(t), F.expr(_FLAG), ["user_id"], "ts", "event_id")
    return out.select("event_id", "before")


@query("rolling_sum_trailing", """
    SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
        ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS value_bw FROM events""")
def _(t):
    out = W.rolling_sum_trailing(_events(t), ["value"], ["user_id"], ["ts", "event_id"])
    return out.select("event_id", F.round("value_bw", 6).alias("value_bw"))


@query("rolling_sum_leading", """
    SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
        ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING), 6) AS value_fw FROM events""")
def _(t):
    out = W.rolling_sum_leading(_events(t), ["value"], ["user_id"], ["ts", "event_id"])
    return out.select("event_id", F.round("value_fw", 6).alias("value_fw"))


@query("dense_index", """
    WITH f AS (SELECT o_custkey, min(o_orderkey) AS first FROM orders GROUP BY 1)
    SELECT o_custkey, row_number() OVER (ORDER BY first) - 1 AS idx FROM f""")
def _(t):
    from fernwick.operators.features import dense_index

    return dense_index(t.orders, "o_custkey", "o_orderkey", "idx")


# Score and prediction of a document, derived from its id so that both engines agree.
_PROB = "(CAST('0x' || substr(md5('p|' || doc_id), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE)"


def predictions(t):
    """Labels with a score and the class predicted at one half."""
    rows = t.labels.withColumn("p", S.hash_fraction("doc_id", "p"))
    return rows.select("doc_id", F.col("quality").alias("y"), "p", (F.col("p") > 0.5).cast("int").alias("pred"))


PRED = f"pr AS (SELECT doc_id, quality AS y, {_PROB} AS p, CAST({_PROB} > 0.5 AS INTEGER) AS pred FROM labels)"
# Probability of the true class of a row.
_PY = "CASE WHEN y = 1 THEN p ELSE 1 - p END"


@query("most_correct", f"""
    WITH {PRED} SELECT doc_id, y, pred = y AS is_correct, row_number() OVER (PARTITION BY y, pred = y
        ORDER BY CASE WHEN pred = y THEN -({_PY}) ELSE {_PY} END, doc_id) AS place FROM pr QUALIFY place <= 4""")
def _(t):
    from fernwick.operators.evaluate import most_by_correct

    rows = predictions(t).withColumn("py", F.expr(_PY))
    return most_by_correct(rows, "y", "pred", "py", "doc_id", 4).select(
        "doc_id", "y", "is_correct", F.col("place").cast("long").alias("place"))


@query("most_uncertain", f"""
    WITH {PRED} SELECT doc_id, y, round(p, 9) AS p FROM pr
    QUALIFY row_number() OVER (PARTITION BY y ORDER BY abs({_PY} - 0.5), doc_id) <= 4""")
def _(t):
    from fernwick.operators.evaluate import most_uncertain

    rows = predictions(t).withColumn("py", F.expr(_PY))
    return most_uncertain(rows, "y", "py", "doc_id", 2, 4).select("doc_id", "y", F.round("p", 9).alias("p"))


@query("worst_errors", f"""
    WITH {PRED},
    fp AS (SELECT *, 'false positive' AS kind FROM pr WHERE pred = 1 AND y = 0 ORDER BY p DESC, doc_id LIMIT 10),
    fn AS (SELECT *, 'false negative' AS kind FROM pr WHERE pred = 0 AND y = 1 ORDER BY p, doc_id LIMIT 10)
    SELECT e.doc_id, kind, round(p, 9) AS p, text FROM (SELECT * FROM fp UNION ALL SELECT * FROM fn) e
    LEFT JOIN documents d ON e.doc_id = d.doc_id""")
def _(t):
    from fernwick.operators.evaluate import worst_errors

    worst = worst_errors(predictions(t), "y", "pred", "p", "doc_id", 10)
    # Twenty rows at most.
    out = t.documents.select("doc_id", "text").join(F.broadcast(worst), "doc_id", "right")
    return out.select("doc_id", "kind", F.round("p", 9).alias("p"), "text")


@query("shift_target", rf"""
    WITH w AS (SELECT conv_id, turn, {WORDS} AS w FROM conversations)
    SELECT conv_id, turn, array_to_string(w[:-2], ' ') AS source, array_to_string(w[2:], ' ') AS target FROM w""")
def _(t):
    source, target = A.shift_target(words("text"))
    return t.conversations.select("conv_id", "turn", F.array_join(source, " ").alias("source"),
                                  F.array_join(target, " ").alias("target"))


@query("token_windows", rf"""
    WITH w AS (SELECT doc_id, {WORDS} AS w FROM documents),
    s AS (SELECT doc_id, w, unnest(range(0, len(w) - 8, 8)) AS start FROM w WHERE len(w) > 8)
    SELECT doc_id, CAST(start AS INTEGER) AS start, array_to_string(w[start+1:start+8], ' ') AS items, w[start+9] AS "next" FROM s""")
def _(t):
    docs = t.documents.select("doc_id", words("text").alias("w"))
    rows = docs.select("doc_id", F.inline(A.windows(F.col("w"), 8, 8)))
    return rows.withColumn("items", F.array_join("items", " "))


@query("best_split", " UNION ALL ".join(f"""
    (WITH g AS (SELECT {c} AS x, count(*) AS n, sum(l_extendedprice) AS s, sum(l_extendedprice * l_extendedprice) AS s2 FROM lineitem GROUP BY 1),
    r AS (SELECT x, sum(n) OVER o AS n, sum(s) OVER o AS s, sum(s2) OVER o AS s2, sum(n) OVER () AS tn,
          sum(s) OVER () AS ts, sum(s2) OVER () AS ts2 FROM g WINDOW o AS (ORDER BY x)),
    sc AS (SELECT x, n * sqrt(greatest(s2 / n - (s / n) * (s / n), 0))
             + (tn - n) * sqrt(greatest((ts2 - s2) / (tn - n) - ((ts - s) / (tn - n)) * ((ts - s) / (tn - n)), 0)) AS score
           FROM r WHERE n > 5 AND n < tn - 5)
    SELECT '{c}' AS feature, x AS threshold, round(score / 1e6, 5) AS score FROM sc ORDER BY sc.score, x LIMIT 1)"""
    for c in ("l_quantity", "l_discount", "l_tax")))
def _(t):
    from fernwick.operators.models import best_split

    out = best_split(t.lineitem, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", 5)
    return out.withColumn("score", F.round(F.col("score") / 1e6, 5))


@query("ewma", """
    WITH RECURSIVE s AS (SELECT event_id, user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
    r AS (SELECT event_id, user_id, rn, 0.1::DOUBLE * value AS v FROM s WHERE rn = 1
          UNION ALL SELECT s.event_id, s.user_id, s.rn, 0.9::DOUBLE * r.v + 0.1::DOUBLE * s.value FROM r JOIN s ON s.user_id = r.user_id AND s.rn = r.rn + 1)
    SELECT event_id, round(v / (1 - pow(0.9::DOUBLE, rn)), 6) AS smoothed FROM r""")
def _(t):
    out = W.ewma(_events(t), "value", ["user_id"], ["ts", "event_id"], 0.9)
    return out.select("event_id", F.round("smoothed", 6).alias("smoothed"))


# ---------------------------------------------------------------- sampling and splits


def _h(seed, col):
    return f"md5('{seed}|' || {col})"


def _rank(seed, col, over=""):
    return f"row_number() OVER ({over} ORDER BY {_h(seed, col)}, {col})"


@query("get_sample", f"SELECT o_orderkey, o_totalprice FROM orders QUALIFY {_rank(42, 'o_orderkey')} <= 500")
def _(t):
    return S.get_sample(t.orders.select("o_orderkey", "o_totalprice"), 500, "o_orderkey")


@query("bernoulli_sample", f"""
    SELECT o_orderkey FROM orders WHERE CAST('0x' || substr({_h(42, 'o_orderkey')}, 1, 8) AS BIGINT) / 4294967296.0::DOUBLE < 0.1""")
def _(t):
    return S.bernoulli_sample(t.orders.select("o_orderkey"), 0.1, "o_orderkey")


@query("cv_fold", f"""
    WITH r AS (SELECT o_orderkey, {_rank(42, 'o_orderkey')} - 1 AS r, CAST(floor(0.2::DOUBLE * count(*) OVER ()) AS BIGINT) AS n FROM orders)
    SELECT o_orderkey, r >= 2 * n AND r < 3 * n AS is_val FROM r""")
def _(t):
    return S.cv_fold(t.orders.select("o_orderkey"), "o_orderkey", cv_idx=2)


@query("split_by_idx", f"""
    WITH r AS (SELECT o_orderkey, {_rank(42, 'o_orderkey')} - 1 AS r, CAST(floor(0.2::DOUBLE * count(*) OVER ()) AS BIGINT) AS n FROM orders)
    SELECT CASE WHEN r < n THEN 'selected' ELSE 'rest' END AS side, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM r GROUP BY 1""")
def _(t):
    picked, rest = S.split_by_idx(S.cv_fold(t.orders.select("o_orderkey"), "o_orderkey"))
    both = picked.withColumn("side", F.lit("selected")).union(rest.withColumn("side", F.lit("rest")))
    return both.groupBy("side").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


_GROUPED = f"""
    g AS (SELECT source, {_rank(8081, 'source')} AS r, floor(0.87::DOUBLE * count(*) OVER ()) AS n FROM (SELECT DISTINCT source FROM documents)),
    g2 AS (SELECT source, {_rank('8081|second', 'source')} AS r2, n FROM g WHERE r <= n),
    side AS (SELECT source, CASE WHEN r2 <= floor(0.82::DOUBLE * n) THEN 'train' ELSE 'valid' END AS split FROM g2),
    sp AS (SELECT doc_id, source, text, coalesce(split, 'test') AS split FROM documents LEFT JOIN side USING (source))"""


@query("grouped_split", f"WITH {_GROUPED} SELECT doc_id, source, split FROM sp")
def _(t):
    return S.grouped_split(t.documents.select("doc_id", "source"), "source")


@query("split_sizes", f"WITH {_GROUPED} SELECT split, count(*) AS n FROM sp GROUP BY 1")
def _(t):
    from fernwick.operators.relational import split_sizes

    return split_sizes(S.grouped_split(t.documents.select("doc_id", "source"), "source"))


@query("random_split", f"""
    SELECT doc_id, CASE WHEN {_rank(42, 'doc_id')} <= ceil(0.1::DOUBLE * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM documents""")
def _(t):
    return S.random_split(t.documents.select("doc_id"), "doc_id")


@query("positional_split", """
    SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey) <= count(*) OVER () - floor(count(*) OVER () * 0.25)
        THEN 'train' ELSE 'valid' END AS split FROM orders""")
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderdate")
    return S.positional_split(rows, ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("date_range_split", """
    SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '1997-06-01' AND DATE '1997-07-31' THEN 'valid' ELSE 'train' END AS split FROM orders""")
def _(t):
    return S.date_range_split(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "1997-06-01",
                              "1997-07-31").drop("o_orderdate")


@query("shuffle", f"SELECT doc_id, {_rank(42, 'doc_id')} AS place FROM documents")
def _(t):
    return S.shuffle(t.documents.select("doc_id"), "doc_id")


@query("sample_by_class", f"SELECT doc_id, quality FROM labels QUALIFY {_rank(42, 'doc_id', 'PARTITION BY quality')} <= 4")
def _(t):
    return S.sample_by_class(t.labels.select("doc_id", "quality"), ["quality"], 4, "doc_id")


@query("sort_batches", """
    SELECT doc_id, CAST(floor((row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1) / 32) AS BIGINT) AS batch FROM documents""")
def _(t):
    return S.sort_batches(t.documents.select("doc_id", "n_chars"), "n_chars", "doc_id", 32).drop("n_chars")


@query("sortish_batches", f"""
    WITH c AS (SELECT doc_id, n_chars, CAST(floor(({_rank(42, 'doc_id')} - 1) / 200) AS BIGINT) AS chunk FROM documents),
    b AS (SELECT *, chunk * 50 + CAST(floor((row_number() OVER (PARTITION BY chunk ORDER BY n_chars DESC, doc_id) - 1) / 4) AS BIGINT) AS batch FROM c),
    first AS (SELECT batch FROM b GROUP BY 1 ORDER BY max(n_chars) DESC, batch LIMIT 1),
    o AS (SELECT batch, {_rank('42|order', 'batch')} AS batch_order FROM (SELECT DISTINCT batch FROM b WHERE batch NOT IN (SELECT batch FROM first)))
    SELECT doc_id, batch, coalesce(batch_order, 0) AS batch_order FROM b LEFT JOIN o USING (batch)""")
def _(t):
    rows = t.documents.select("doc_id", "n_chars")
    return S.sortish_batches(rows, "n_chars", "doc_id", 4).drop("n_chars")


@query("bootstrap_rows", f"""
    WITH w AS (SELECT i // 5000 AS tree, i % 5000 AS draw,
                CAST('0x' || substr({_h('42|draw', 'i')}, 1, 15) AS BIGINT) % (SELECT count(*) FROM orders) + 1 AS r FROM range(15000) t(i)),
    p AS (SELECT o_orderkey, {_rank(42, 'o_orderkey')} AS r FROM orders)
    SELECT tree, draw, o_orderkey FROM w JOIN p USING (r)""")
def _(t):
    return S.bootstrap_rows(t.orders, "o_orderkey", 5000, 3)


# ---------------------------------------------------------------- calendar


@query("add_datepart", """
    WITH d AS (SELECT event_id, ts, CAST(ts AS DATE) AS d FROM events)
    SELECT event_id, CAST(year(d) AS INTEGER) AS "tsYear", CAST(month(d) AS INTEGER) AS "tsMonth", CAST(weekofyear(d) AS INTEGER) AS "tsWeek",
        CAST(day(d) AS INTEGER) AS "tsDay", CAST(isodow(d) - 1 AS INTEGER) AS "tsDayofweek", CAST(dayofyear(d) AS INTEGER) AS "tsDayofyear",
        d = last_day(d) AS "tsIs_month_end", day(d) = 1 AS "tsIs_month_start", d = last_day(d) AND month(d) % 3 = 0 AS "tsIs_quarter_end",
        day(d) = 1 AND month(d) % 3 = 1 AS "tsIs_quarter_start", month(d) = 12 AND day(d) = 31 AS "tsIs_year_end",
        month(d) = 1 AND day(d) = 1 AS "tsIs_year_start", CAST(hour(ts) AS INTEGER) AS "tsHour", CAST(minute(ts) AS INTEGER) AS "tsMinute",
        CAST(second(ts) AS INTEGER) AS "tsSecond", CAST(floor(epoch(ts)) AS BIGINT) AS "tsElapsed" FROM d""")
def _(t):
    return D.add_datepart(t.events.select("event_id", "ts"), "ts", time=True)


@query("add_datepart_orders", """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS "o_orderYear", CAST(weekofyear(o_orderdate) AS INTEGER) AS "o_orderWeek",
        CAST(isodow(o_orderdate) - 1 AS INTEGER) AS "o_orderDayofweek", CAST(epoch(o_orderdate) AS BIGINT) AS "o_orderElapsed" FROM orders""")
def _(t):
    out = D.add_datepart(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate")
    return out.select("o_orderkey", "o_orderYear", "o_orderWeek", "o_orderDayofweek", "o_orderElapsed")


@query("combine_date", """
    SELECT l_orderkey, l_linenumber, l_partkey, TIMESTAMP '1970-01-01' + to_years(CAST(1990 + l_linenumber - 1970 AS INTEGER))
      + to_months(CAST(l_linenumber * 3 - 1 AS INTEGER)) + to_days(CAST(l_quantity - 1 + 7 * 2 AS INTEGER))
      + to_hours(CAST(l_quantity AS INTEGER)) + to_minutes(90) + to_milliseconds(1500) AS made FROM lineitem""")
def _(t):
    made = D.combine_date(F.col("l_linenumber") + 1990, F.col("l_linenumber") * 3, F.col("l_quantity").cast("int"),
                          weeks=2, hours=F.col("l_quantity"), minutes=90, milliseconds=1500)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", made.alias("made"))


@query("days_between", """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return lines.join(orders, "l_orderkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", D.days_between("l_shipdate", "o_orderdate").alias("days"))


@query("date_from_parts", "SELECT o_orderkey, make_date(CAST(year(o_orderdate) - 2 AS INTEGER), CAST(month(o_orderdate) AS INTEGER), 15) AS since FROM orders")
def _(t):
    return t.orders.select("o_orderkey", D.date_from_parts(F.year("o_orderdate") - 2, F.month("o_orderdate")).alias("since"))


@query("iso_week_monday", """
    SELECT o_orderkey, CAST(date_trunc('week', make_date(CAST(isoyear(o_orderdate) AS INTEGER), 1, 4)) AS DATE)
        + CAST((weekofyear(o_orderdate) - 1) * 7 AS INTEGER) AS monday FROM orders""")
def _(t):
    day = F.col("o_orderdate").cast("date")
    iso_year = F.year(F.date_add(day, 3 - F.weekday(day)))
    return t.orders.select("o_orderkey", D.iso_week_monday(iso_year, F.weekofyear(day)).alias("monday"))


@query("parse_date", """
    SELECT o_orderkey, CASE o_orderkey % 3 WHEN 2 THEN NULL ELSE date_trunc('day', o_orderdate) END AS parsed FROM orders""")
def _(t):
    k = F.col("o_orderkey") % 3
    raw = F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(
        k == 1, F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise(F.lit("soon"))
    return t.orders.select("o_orderkey", D.parse_date(raw, ["yyyy-MM-dd", "MM/dd/yyyy"]).alias("parsed"))


