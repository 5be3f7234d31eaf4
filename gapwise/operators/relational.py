"""Plain relational operators over the star schema: extensions that the time-series engine gets from Spark for free."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F


def _t(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def pricing_summary(spark, d):
    li = _t(spark, d, "lineitem").where("l_shipdate <= timestamp_ntz'1998-09-02 00:00:00'")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc_price"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("count_order"))


def revenue_by_nation(spark, d):
    li, o, c, n = (_t(spark, d, x) for x in ("lineitem", "orders", "customer", "nation"))
    out = li.select("l_orderkey", "l_extendedprice", "l_discount").join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(c.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(n.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    return out.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


def customers_without_large_orders(spark, d):
    large = _t(spark, d, "orders").where("o_totalprice > 300000")
    return _t(spark, d, "customer").join(large, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


def segments_with_large_orders(spark, d):
    large = _t(spark, d, "orders").where("o_totalprice > 300000")
    return _t(spark, d, "customer").join(large, F.col("c_custkey") == F.col("o_custkey"), "left_semi").groupBy("c_mktsegment").agg(F.count("*").alias("customers"))


def suppliers_and_customers(spark, d):
    s = _t(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("suppliers"))
    c = _t(spark, d, "customer").where("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("customers"))
    return s.join(c, "k", "full").select(F.col("k").alias("nationkey"), "suppliers", "customers")


def sales_cube(spark, d):
    o = _t(spark, d, "orders")
    out = o.cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return out.withColumns({c: F.coalesce(c, F.lit("all")) for c in ("o_orderstatus", "o_orderpriority")})


def sales_rollup(spark, d):
    out = _t(spark, d, "orders").rollup(F.year("o_orderdate").alias("y"), F.col("o_orderstatus")).agg(F.count("*").alias("orders"))
    return out.select(F.coalesce(F.col("y").cast("string"), F.lit("all")).alias("y"), F.coalesce("o_orderstatus", F.lit("all")).alias("o_orderstatus"), "orders")


def shared_nations(spark, d):
    c = _t(spark, d, "customer").where("c_acctbal > 9900").select(F.col("c_nationkey").alias("nationkey"))
    return c.intersect(_t(spark, d, "supplier").select(F.col("s_nationkey").alias("nationkey")))


def nations_without_rich_suppliers(spark, d):
    rich = _t(spark, d, "supplier").where("s_acctbal > 5000")
    return _t(spark, d, "nation").select(F.col("n_nationkey").alias("nationkey")).exceptAll(rich.select(F.col("s_nationkey").alias("nationkey")).distinct())


def top_orders_per_segment(spark, d):
    o = _t(spark, d, "orders").join(_t(spark, d, "customer").select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    w = Window.partitionBy("c_mktsegment").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return o.withColumn("place", F.row_number().over(w)).where("place <= 3").select("c_mktsegment", "place", "o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"))


_REV = "round(sum(l_extendedprice * (1 - l_discount)), 2)"

CATALOGUE = {
    "pricing_summary": (pricing_summary, f"SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, {_REV} AS sum_disc_price, round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2"),
    "revenue_by_nation": (revenue_by_nation, f"SELECT n_name, {_REV} AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1"),
    "customers_without_large_orders": (
        customers_without_large_orders,
        "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)",
    ),
    "segments_with_large_orders": (segments_with_large_orders, "SELECT c_mktsegment, count(*) AS customers FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000) GROUP BY 1"),
    "suppliers_and_customers": (suppliers_and_customers, "SELECT coalesce(s.k, c.k) AS nationkey, suppliers, customers FROM (SELECT s_nationkey AS k, count(*) AS suppliers FROM supplier GROUP BY 1) s FULL JOIN (SELECT c_nationkey AS k, count(*) AS customers FROM customer WHERE c_acctbal > 9000 GROUP BY 1) c ON s.k = c.k"),
    "sales_cube": (sales_cube, "SELECT coalesce(o_orderstatus, 'all') AS o_orderstatus, coalesce(o_orderpriority, 'all') AS o_orderpriority, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)"),
    "sales_rollup": (sales_rollup, "SELECT coalesce(CAST(y AS VARCHAR), 'all') AS y, coalesce(o_orderstatus, 'all') AS o_orderstatus, count(*) AS orders FROM (SELECT year(o_orderdate) AS y, o_orderstatus FROM orders) GROUP BY ROLLUP (y, o_orderstatus)"),
    "shared_nations": (shared_nations, "SELECT c_nationkey AS nationkey FROM customer WHERE c_acctbal > 9900 INTERSECT SELECT s_nationkey FROM supplier"),
    "nations_without_rich_suppliers": (
        nations_without_rich_suppliers,
        "SELECT n_nationkey AS nationkey FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000",
    ),
    "top_orders_per_segment": (top_orders_per_segment, "SELECT c_mktsegment, CAST(row_number() OVER w AS INTEGER) AS place, o_orderkey, round(o_totalprice, 2) AS o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey WINDOW w AS (PARTITION BY c_mktsegment ORDER BY o_totalprice DESC, o_orderkey) QUALIFY row_number() OVER w <= 3"),
}
