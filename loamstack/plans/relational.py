"""Joins, cubes, windows, set operations and sorts over the star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.readers import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_disc, count(*) AS n
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""")
def rel_pricing_summary(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "lineitem").where("l_shipdate <= timestamp '1998-09-02'")
    revenue = F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return t.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(revenue, 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"))


@query("""SELECT n_name, c_mktsegment, round(sum(o_totalprice), 2) AS total, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def rel_star_join(spark: SparkSession, d: str) -> DataFrame:
    o, c, n, r = (table(spark, d, t) for t in ("orders", "customer", "nation", "region"))
    rows = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.groupBy("n_name", "c_mktsegment").agg(F.round(F.sum("o_totalprice"), 2).alias("total"), F.count("*").alias("n"))


@query("""SELECT c_custkey, count(o_orderkey) AS orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""")
def rel_left_join(spark: SparkSession, d: str) -> DataFrame:
    c, o = table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").select("o_custkey", "o_orderkey")
    return c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("orders"))


@query("""SELECT coalesce(c_nationkey, s_nationkey) AS nation, c_custkey IS NULL AS no_customer, s_suppkey IS NULL AS no_supplier, count(*) AS n
FROM customer FULL JOIN supplier ON c_nationkey = s_nationkey GROUP BY ALL""")
def rel_full_join_whole(spark: SparkSession, d: str) -> DataFrame:
    """Both sides are counted by nation first, so no pair of rows is made."""
    c = table(spark, d, "customer").groupBy("c_nationkey", F.col("c_custkey").isNull().alias("no_customer")).agg(F.count("*").alias("nc"))
    s = table(spark, d, "supplier").groupBy("s_nationkey", F.col("s_suppkey").isNull().alias("no_supplier")).agg(F.count("*").alias("ns"))
    rows = c.join(s, F.col("c_nationkey") == F.col("s_nationkey"), "full")
    pairs = F.coalesce("nc", F.lit(1)) * F.coalesce("ns", F.lit(1))
    return rows.groupBy(F.coalesce("c_nationkey", "s_nationkey").alias("nation"), F.coalesce("no_customer", F.lit(True)).alias("no_customer"), F.coalesce("no_supplier", F.lit(True)).alias("no_supplier")).agg(F.sum(pairs).alias("n"))


@query("""SELECT p_brand, count(*) AS sold FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 45) GROUP BY p_brand""")
def rel_semi_join(spark: SparkSession, d: str) -> DataFrame:
    busy = table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, d, "part").join(busy, "p_partkey", "left_semi").groupBy("p_brand").agg(F.count("*").alias("sold"))


@query("""SELECT c_custkey, c_mktsegment FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""")
def rel_anti_join(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(o, "c_custkey", "left_anti").select("c_custkey", "c_mktsegment")


@query("""SELECT r_name, n_name FROM region CROSS JOIN nation""")
def rel_cross_join(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "region").select("r_name").crossJoin(table(spark, d, "nation").select("n_name"))


@query("""SELECT e.event_id, (SELECT p.event_id FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'view' AND (p.ts, p.event_id) <= (e.ts, e.event_id) ORDER BY p.ts DESC, p.event_id DESC LIMIT 1) AS view_id
FROM events e WHERE e.event_type = 'purchase'""")
def rel_asof_join(spark: SparkSession, d: str) -> DataFrame:
    """Each purchase with the user's last view before it: a running last value, without a range join."""
    e = table(spark, d, "events")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = e.withColumn("view_id", F.last(F.when(F.col("event_type") == "view", F.col("event_id")), ignorenulls=True).over(w))
    return rows.where("event_type = 'purchase'").select("event_id", "view_id")


@query("""SELECT s_suppkey, band, count(*) AS n FROM supplier JOIN (SELECT 'low' AS band, -1e9 AS lo, 0.0 AS hi UNION ALL SELECT 'mid', 0.0, 5000.0 UNION ALL SELECT 'high', 5000.0, 1e9) ON s_acctbal >= lo AND s_acctbal < hi GROUP BY ALL""")
def rel_range_join(spark: SparkSession, d: str) -> DataFrame:
    bands = spark.createDataFrame([("low", -1e9, 0.0), ("mid", 0.0, 5000.0), ("high", 5000.0, 1e9)], "band string, lo double, hi double")
    s = table(spark, d, "supplier")
    return s.join(F.broadcast(bands), (F.col("s_acctbal") >= F.col("lo")) & (F.col("s_acctbal") < F.col("hi"))).groupBy("s_suppkey", "band").agg(F.count("*").alias("n"))  # three rows


@query("""SELECT a.event_id AS first_id, b.event_id AS next_id FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'click' AND b.event_type = 'error' AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL 6 HOUR""")
def rel_interval_join(spark: SparkSession, d: str) -> DataFrame:
    """Clicks with the errors of the next six hours: equal on user and hour bucket pairs, then filtered."""
    e = table(spark, d, "events")
    bucket = lambda c: F.floor(F.unix_timestamp(c) / 21600)
    a = e.where("event_type = 'click'").select("user_id", F.col("ts").alias("ta"), F.col("event_id").alias("first_id"), F.explode(F.array(bucket("ts"), bucket("ts") + 1)).alias("b"))
    b = e.where("event_type = 'error'").select("user_id", F.col("ts").alias("tb"), F.col("event_id").alias("next_id"), bucket("ts").alias("b"))
    return a.join(b, ["user_id", "b"]).where("tb > ta AND tb <= ta + INTERVAL 6 HOURS").select("first_id", "next_id")


@query("""SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def rel_cube(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def rel_rollup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("""SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY l_returnflag""")
def rel_count_distinct(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_suppkey").alias("suppliers"))


@query()
def rel_approx_distinct(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey", 0.02).alias("parts"), F.percentile_approx("l_extendedprice", 0.5, 1000).alias("median"))


@query("""SELECT o_orderkey, o_custkey, row_number() OVER w AS rn, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus) AS rk, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus) AS dr,
ntile(4) OVER w AS tile, lag(o_orderkey) OVER w AS before, lead(o_orderkey) OVER w AS after FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def rel_ranking(spark: SparkSession, d: str) -> DataFrame:
    w, s = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"), Window.partitionBy("o_custkey").orderBy("o_orderstatus")
    return table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.row_number().over(w).alias("rn"), F.rank().over(s).alias("rk"), F.dense_rank().over(s).alias("dr"), F.ntile(4).over(w).alias("tile"), F.lag("o_orderkey").over(w).alias("before"), F.lead("o_orderkey").over(w).alias("after")
    )


@query("""SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY epoch_us(o_orderdate::TIMESTAMP) // 1000000 RANGE BETWEEN 7776000 PRECEDING AND CURRENT ROW), 2) AS spent_90d FROM orders""")
def rel_range_frame(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("sec").rangeBetween(-90 * 86400, 0)
    rows = table(spark, d, "orders").withColumn("sec", F.unix_timestamp(F.col("o_orderdate").cast("timestamp")))
    return rows.select("o_orderkey", F.round(F.sum("o_totalprice").over(w), 2).alias("spent_90d"))


@query("""SELECT o_orderstatus, round(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END), 2) AS urgent, round(sum(CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice END), 2) AS low FROM orders GROUP BY o_orderstatus""")
def rel_pivot(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "orders").groupBy("o_orderstatus").pivot("o_orderpriority", ["1-URGENT", "5-LOW"]).agg(F.sum("o_totalprice"))
    return p.select("o_orderstatus", F.round(F.col("`1-URGENT`"), 2).alias("urgent"), F.round(F.col("`5-LOW`"), 2).alias("low"))


@query("""SELECT l_orderkey, name, round(v, 4) AS v FROM (SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem) UNPIVOT (v FOR name IN (l_discount, l_tax))""")
def rel_unpivot_whole(spark: SparkSession, d: str) -> DataFrame:
    """Like the SQL, without those whose value is null."""
    t = table(spark, d, "lineitem").unpivot(["l_orderkey", "l_linenumber"], ["l_discount", "l_tax"], "name", "v")
    return t.where("v IS NOT NULL").select("l_orderkey", "name", F.round("v", 4).alias("v"))


@query("""(SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier)""")
def rel_intersect(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).intersect(table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")))


@query("""SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'O' EXCEPT ALL SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'""")
def rel_except_all(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.where("o_orderstatus = 'O'").select(F.col("o_custkey").alias("k")).exceptAll(o.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")))


@query("""SELECT c_mktsegment, c_custkey, c_acctbal FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS n FROM customer) WHERE n <= 3""")
def rel_top_per_group(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("c_mktsegment").orderBy(F.desc("c_acctbal"), "c_custkey")
    return table(spark, d, "customer").withColumn("n", F.row_number().over(w)).where("n <= 3").select("c_mktsegment", "c_custkey", "c_acctbal")


@query("""SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def rel_top_k(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").select("o_orderkey", "o_totalprice").limit(20)
