"""The store-day feature table, with nations as stores."""

from pyspark.sql import functions as F

from fernwick.operators.features import proc_df
from fernwick.operators.relational import join_df
from fernwick.plans.catalog.registry import query
from fernwick.plans.store_features import store_features
from fernwick.session import cut_lineage


def store_days(t):
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").cast("date").alias("date"), "o_totalprice", "o_orderpriority")
    rows = orders.join(t.customer.select("c_custkey", F.col("c_nationkey").alias("store")), "c_custkey")
    days = rows.groupBy("store", "date").agg(
        F.round(F.sum("o_totalprice"), 2).alias("sales"), F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("promo"))
    n = F.col("n_nationkey")
    named = join_df(t.nation.withColumnRenamed("n_regionkey", "r_regionkey"), t.region, "r_regionkey")
    stores = named.select(
        n.alias("store"), F.col("n_name").alias("name"), F.col("r_name").alias("region"),
        F.when(n % 5 != 0, 1985 + n).alias("open_year"), F.when(n % 7 != 0, n % 12 + 1).alias("open_month"),
        F.when(n % 4 != 0, 1994 + n % 6).alias("promo_year"), F.when(n % 3 != 0, n * 2 + 1).alias("promo_week"))
    return days, stores


_STORES = """
    d AS (SELECT c_nationkey AS store, CAST(o_orderdate AS DATE) AS date, round(sum(o_totalprice), 2) AS sales, bool_or(o_orderpriority = '1-URGENT') AS promo
          FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
    s AS (SELECT n_nationkey AS store, n_name AS name, r_name AS region,
             coalesce(CASE WHEN n_nationkey % 5 <> 0 THEN 1985 + n_nationkey END, 1900) AS oy, coalesce(CASE WHEN n_nationkey % 7 <> 0 THEN n_nationkey % 12 + 1 END, 1) AS om,
             coalesce(CASE WHEN n_nationkey % 4 <> 0 THEN 1994 + n_nationkey % 6 END, 1900) AS py, coalesce(CASE WHEN n_nationkey % 3 <> 0 THEN n_nationkey * 2 + 1 END, 1) AS pw
          FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
    w AS (SELECT *, date_diff('day', max(CASE WHEN promo THEN date END) OVER (PARTITION BY store ORDER BY date), date) AS after_promo,
             date_diff('day', min(CASE WHEN promo THEN date END) OVER (PARTITION BY store ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), date) AS before_promo,
             sum(CAST(promo AS INTEGER)) OVER (PARTITION BY store ORDER BY date ROWS 6 PRECEDING) AS bw,
             sum(CAST(promo AS INTEGER)) OVER (PARTITION BY store ORDER BY date ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING) AS fw FROM d),
    j AS (SELECT w.*, name, region, oy, py, date_diff('day', make_date(oy, om, 15), date) AS od,
             date_diff('day', CAST(date_trunc('week', make_date(py, 1, 4)) AS DATE) + CAST((pw - 1) * 7 AS INTEGER), date) AS pd FROM w LEFT JOIN s USING (store)),
    k AS (SELECT *, CASE WHEN od < 0 OR oy < 1990 THEN 0 ELSE od END AS days_open, CASE WHEN pd < 0 OR py < 1990 THEN 0 ELSE pd END AS promo_days FROM j)"""


@query("store_features", f"""
    WITH {_STORES} SELECT CAST(store AS INTEGER) AS store, date, sales, name, region, CAST(after_promo AS INTEGER) AS after_promo, CAST(before_promo AS INTEGER) AS before_promo,
      CAST(bw AS BIGINT) AS promo_n_bw, CAST(fw AS BIGINT) AS promo_n_fw, CAST(days_open AS INTEGER) AS days_open,
      CAST(least(days_open // 30, 24) AS INTEGER) AS months_open, CAST(least(promo_days // 7, 25) AS INTEGER) AS promo_weeks,
      CAST(weekofyear(date) AS INTEGER) AS "Week", CAST(isodow(date) - 1 AS INTEGER) AS "Dayofweek" FROM k WHERE sales <> 0""")
def _(t):
    out = store_features(*store_days(t))
    return out.select("store", "date", "sales", "name", "region", "after_promo", "before_promo", "promo_n_bw", "promo_n_fw", "days_open",
                      "months_open", "promo_weeks", "Week", "Dayofweek")


@query("store_model_table")
def _(t):
    """The feature table made numeric, ready for a model."""
    rows = store_features(*store_days(t)).select("store", "date", "sales", "name", "region", "after_promo", "before_promo", "promo_n_bw", "months_open", "promo_weeks")
    # The wrangled table is read by each fitting step.
    return proc_df(cut_lineage(rows), "sales", ignore_flds=["date"], do_scale=True).x
