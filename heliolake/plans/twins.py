"""Queries of the relational operators with their SQL, on the star-schema tables.

Rectangles and positions are derived from the integer keys by the same arithmetic on both
sides, so that spatial operators have closed forms in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heliolake.operators import products as P
from heliolake.operators import relational as R
from heliolake.operators.geojoin import box_pairs
from heliolake.sources.tables import read_table as table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def twin(sql: str) -> Callable:
    def keep(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return keep


# --- derived shapes ------------------------------------------------------------------------

RECT_CUSTOMER = "SELECT c_custkey AS id, (c_custkey*37)%400 AS x0, (c_custkey*53)%300 AS y0, (c_custkey*37)%400+6+c_custkey%7 AS x1, (c_custkey*53)%300+6+c_custkey%5 AS y1, 'customer' AS ds FROM customer"
RECT_PART = "SELECT p_partkey AS id, (p_partkey*41+3)%400 AS x0, (p_partkey*59+2)%300 AS y0, (p_partkey*41+3)%400+2+p_partkey%11 AS x1, (p_partkey*59+2)%300+2+p_partkey%9 AS y1, 'part' AS ds FROM part"


def rects(spark: SparkSession, sf: str, which: str) -> DataFrame:
    k = F.col("c_custkey" if which == "customer" else "p_partkey")
    x0, y0, w, h = ((k * 37) % 400, (k * 53) % 300, 6 + k % 7, 6 + k % 5) if which == "customer" else ((k * 41 + 3) % 400, (k * 59 + 2) % 300, 2 + k % 11, 2 + k % 9)
    df = table(spark, sf, which, "c_custkey" if which == "customer" else "p_partkey")
    return df.select(k.alias("id"), x0.alias("x0"), y0.alias("y0"), (x0 + w).alias("x1"), (y0 + h).alias("y1"), F.lit(which).alias("ds"))


def lonlat() -> tuple[Column, Column]:
    k = F.col("c_custkey")
    return ((k * 37) % 400).cast("double") * F.lit(0.9) - F.lit(180.0), ((k * 53) % 300).cast("double") * F.lit(0.5) - F.lit(75.0)


LONLAT = "SELECT *, CAST((c_custkey*37)%400 AS DOUBLE)*CAST(0.9 AS DOUBLE)-CAST(180.0 AS DOUBLE) AS lon, CAST((c_custkey*53)%300 AS DOUBLE)*CAST(0.5 AS DOUBLE)-CAST(75.0 AS DOUBLE) AS lat FROM customer"


def big(c: Column) -> Column:
    return c.cast("bigint")


# --- aggregation ---------------------------------------------------------------------------


@twin("""SELECT o_orderpriority, count(*) AS n, round(avg(o_totalprice), 2) AS avg_price, round(sum(o_totalprice), 2) AS sum_price,
count(*) - count(o_orderstatus) AS missing FROM orders GROUP BY o_orderpriority""")
def overview_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.round(F.avg("o_totalprice"), 2).alias("avg_price"), F.round(F.sum("o_totalprice"), 2).alias("sum_price"), (F.count("*") - F.count("o_orderstatus")).alias("missing")
    )


@twin("""SELECT CASE WHEN l_extendedprice < 1000 THEN 'tiny' WHEN l_extendedprice < 10000 THEN 'small' WHEN l_extendedprice < 30000 THEN 'medium' WHEN l_extendedprice < 60000 THEN 'large' ELSE 'huge' END AS bucket,
count(*) AS n, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1""")
def size_buckets(spark: SparkSession, sf: str) -> DataFrame:
    steps = [(1000, "tiny"), (10000, "small"), (30000, "medium"), (60000, "large")]
    return table(spark, sf, "lineitem", "l_extendedprice").groupBy(R.ladder(F.col("l_extendedprice"), steps, "huge").alias("bucket")).agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"))


@twin(f"""SELECT floor(lon/10)*10 AS grid_lon, floor(lat/10)*10 AS grid_lat, count(*) AS n, count(DISTINCT c_nationkey) AS nations FROM ({LONLAT}) GROUP BY 1, 2 HAVING count(*) > 1""")
def grid_counts_having(spark: SparkSession, sf: str) -> DataFrame:
    lon, lat = lonlat()
    df = table(spark, sf, "customer", "c_custkey", "c_nationkey").select((F.floor(lon / 10) * 10.0).alias("grid_lon"), (F.floor(lat / 10) * 10.0).alias("grid_lat"), "c_nationkey")
    return df.groupBy("grid_lon", "grid_lat").agg(F.count("*").alias("n"), F.count_distinct("c_nationkey").alias("nations")).filter("n > 1")


@twin("""SELECT event_type, count(*) AS n, count(*) - count(nullif(json_extract_string(props, '$.k'), '')) AS missing_k,
round(100.0 * count(value) / count(*), 2)::DOUBLE AS pct_value FROM events GROUP BY event_type""")
def completeness(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    return table(spark, sf, "events").groupBy("event_type").agg(
        F.count("*").alias("n"), (F.count("*") - F.count(F.when(k != "", k))).alias("missing_k"), F.round(F.lit(100.0) * F.count("value") / F.count("*"), 2).cast("double").alias("pct_value")
    )


@twin("""SELECT n.n_nationkey, n.n_name, CAST(coalesce(a.n, 0) AS BIGINT) AS n, coalesce(a.total, 0.0)::DOUBLE AS total, coalesce(a.mean, 0.0)::DOUBLE AS mean, coalesce(a.least, 0.0)::DOUBLE AS least, coalesce(a.most, 0.0)::DOUBLE AS most,
CASE WHEN coalesce(a.n,0) < 1 THEN 'No PV' WHEN coalesce(a.n,0) < 100 THEN 'Low PV' WHEN coalesce(a.n,0) < 1000 THEN 'Medium PV' WHEN coalesce(a.n,0) < 10000 THEN 'High PV' ELSE 'Very High PV' END AS category
FROM nation n LEFT JOIN (SELECT c_nationkey, count(*) AS n, round(sum(c_acctbal), 4) AS total, round(avg(c_acctbal), 4) AS mean, min(c_acctbal) AS least, max(c_acctbal) AS most FROM customer GROUP BY 1) a ON a.c_nationkey = n.n_nationkey""")
def country_stats_zero_fill(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer", "c_nationkey", "c_acctbal").withColumnRenamed("c_nationkey", "n_nationkey")
    return P.country_statistics(table(spark, sf, "nation", "n_nationkey", "n_name"), rows, "n_nationkey", "c_acctbal")


@twin("""SELECT c_nationkey, n, area, CASE WHEN area > 0 THEN round(n / area, 8) ELSE 0.0 END::DOUBLE AS density,
CASE WHEN n < 1 THEN 'No PV' WHEN n < 100 THEN 'Low PV' WHEN n < 1000 THEN 'Medium PV' WHEN n < 10000 THEN 'High PV' ELSE 'Very High PV' END AS category
FROM (SELECT c_nationkey, count(*) AS n, CAST((c_nationkey % 5) * 1000 AS DOUBLE) AS area FROM customer GROUP BY c_nationkey)""")
def adoption_category(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "customer", "c_nationkey").groupBy("c_nationkey").agg(F.count("*").alias("n")).withColumn("area", ((F.col("c_nationkey") % 5) * 1000).cast("double"))
    return df.select("c_nationkey", "n", "area", F.round(P.density(F.col("n"), F.col("area")), 8).alias("density"), P.adoption_category(F.col("n")).alias("category"))


@twin("""SELECT event_type, count(*) AS users, round(avg(n), 6) AS mean_n, min(n) AS min_n, max(n) AS max_n FROM (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1""")
def two_level_stats(spark: SparkSession, sf: str) -> DataFrame:
    per = table(spark, sf, "events", "event_type", "user_id").groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    return per.groupBy("event_type").agg(F.count("*").alias("users"), F.round(F.avg("n"), 6).alias("mean_n"), F.min("n").alias("min_n"), F.max("n").alias("max_n"))


@twin("""SELECT count(*) AS n, count(DISTINCT user_id) AS users, round(sum(value), 4) AS total, round(avg(value), 6) AS mean, round(median(value), 6) AS med, min(value) AS least, max(value) AS most FROM events""")
def median_stats(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events", "user_id", "value").agg(
        F.count("*").alias("n"), F.count_distinct("user_id").alias("users"), F.round(F.sum("value"), 4).alias("total"), F.round(F.avg("value"), 6).alias("mean"), F.round(F.median("value"), 6).alias("med"), F.min("value").alias("least"), F.max("value").alias("most")
    )


@twin("""SELECT l_returnflag, count(*) FILTER (WHERE l_quantity > 25) AS big, CAST(sum(CASE WHEN l_discount = 0 THEN 1 ELSE 0 END) AS BIGINT) AS undiscounted, round(sum(coalesce(l_tax, 0)), 4) AS tax, round(avg(CASE WHEN l_linestatus = 'O' THEN l_quantity END), 6) AS open_qty FROM lineitem GROUP BY 1""")
def conditional_aggs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.count_if(F.col("l_quantity") > 25).alias("big"), big(F.sum(F.when(F.col("l_discount") == 0, 1).otherwise(0))).alias("undiscounted"), F.round(F.sum(F.coalesce("l_tax", F.lit(0.0))), 4).alias("tax"), F.round(F.avg(F.when(F.col("l_linestatus") == "O", F.col("l_quantity"))), 6).alias("open_qty")
    )


@twin("""SELECT n.n_nationkey, any_value(n.n_name) AS n_name, any_value(r.r_name) AS r_name, count(c.c_custkey) AS customers, round(coalesce(sum(c.c_acctbal), 0), 2)::DOUBLE AS balance FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey LEFT JOIN customer c ON c.c_nationkey = n.n_nationkey GROUP BY n.n_nationkey""")
def wide_group_any_value(spark: SparkSession, sf: str) -> DataFrame:
    # customers are summed by nation before the join, so only one row a nation is joined
    per = table(spark, sf, "customer", "c_custkey", "c_nationkey", "c_acctbal").groupBy("c_nationkey").agg(F.count("c_custkey").alias("customers"), F.sum("c_acctbal").alias("s"))
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    df = n.join(r, n["n_regionkey"] == r["r_regionkey"]).join(per, n["n_nationkey"] == per["c_nationkey"], "left")
    return df.groupBy("n_nationkey").agg(F.any_value("n_name").alias("n_name"), F.any_value("r_name").alias("r_name"), F.coalesce(F.any_value("customers"), F.lit(0)).cast("bigint").alias("customers"), F.round(F.coalesce(F.any_value("s"), F.lit(0.0)), 2).alias("balance"))


@twin("""SELECT count(*) AS n_rows, count(*) - count(s_acctbal) AS n_null, count(DISTINCT s_acctbal) AS n_distinct, min(s_acctbal) AS min_value, max(s_acctbal) AS max_value, round(avg(s_acctbal), 6) AS mean_value, round(stddev_samp(s_acctbal), 6) AS std_value, round(quantile_cont(s_acctbal, 0.25), 6) AS q25, round(quantile_cont(s_acctbal, 0.5), 6) AS q50, round(quantile_cont(s_acctbal, 0.75), 6) AS q75 FROM supplier""")
def numeric_summary(spark: SparkSession, sf: str) -> DataFrame:
    return R.summary_of(table(spark, sf, "supplier", "s_acctbal"), "s_acctbal")


@twin("""SELECT event_type, CAST(min(ts) AS VARCHAR)[:19] AS first_ts, CAST(max(ts) AS VARCHAR)[:19] AS last_ts, count(DISTINCT CAST(ts AS DATE)) AS days FROM events GROUP BY 1""")
def freshness(spark: SparkSession, sf: str) -> DataFrame:
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf, "events", "event_type", "ts").groupBy("event_type").agg(text(F.min("ts")).alias("first_ts"), text(F.max("ts")).alias("last_ts"), F.count_distinct(F.to_date("ts")).alias("days"))


@twin("""SELECT o_custkey, string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) AS priorities, count(DISTINCT o_orderpriority) AS n FROM orders GROUP BY 1""")
def array_agg_distinct(spark: SparkSession, sf: str) -> DataFrame:
    s = F.array_sort(F.collect_set("o_orderpriority"))
    return table(spark, sf, "orders", "o_custkey", "o_orderpriority").groupBy("o_custkey").agg(s.alias("s")).select("o_custkey", F.array_join("s", "|").alias("priorities"), F.size("s").cast("bigint").alias("n"))


@twin("""SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m') AS period, count(*) AS n, round(sum(o_totalprice), 2) / 1000 AS thousands, quarter(any_value(date_trunc('month', o_orderdate))) AS quarter_no FROM orders WHERE o_totalprice IS NOT NULL GROUP BY 1""")
def monthly_series(spark: SparkSession, sf: str) -> DataFrame:
    m = F.date_trunc("month", "o_orderdate")
    df = table(spark, sf, "orders", "o_orderdate", "o_totalprice").dropna(subset=["o_totalprice"]).groupBy(m.alias("m")).agg(F.count("*").alias("n"), (F.round(F.sum("o_totalprice"), 2) / 1000).alias("thousands"))
    return df.select(F.date_format("m", "yyyy-MM").alias("period"), "n", "thousands", F.quarter("m").cast("bigint").alias("quarter_no"))


# --- joins ---------------------------------------------------------------------------------


@twin("""SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)""")
def anti_join(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders", "o_custkey", "o_totalprice").filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer", "c_custkey", "c_name").join(o, "c_custkey", "left_anti")


@twin("""SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)""")
def semi_join(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders", "o_custkey", "o_totalprice").filter("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer", "c_custkey", "c_mktsegment").join(o, "c_custkey", "left_semi")


@twin("""SELECT CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey END AS k FROM customer WHERE CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey END NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)""")
def not_in(spark: SparkSession, sf: str) -> DataFrame:
    k = table(spark, sf, "customer", "c_custkey").select(F.when(F.col("c_custkey") % 10 != 0, F.col("c_custkey")).alias("k"))
    return R.not_in(k, table(spark, sf, "orders", "o_custkey", "o_totalprice").filter("o_totalprice > 300000").select(F.col("o_custkey").alias("k")), "k")


@twin(f"""SELECT c.c_custkey, b.region_no FROM ({LONLAT}) c JOIN (SELECT r_regionkey AS region_no, CAST(r_regionkey*60-150 AS DOUBLE) AS xmin, CAST(r_regionkey*60-110 AS DOUBLE) AS xmax, CAST(r_regionkey*20-60 AS DOUBLE) AS ymin, CAST(r_regionkey*20-10 AS DOUBLE) AS ymax FROM region) b
ON c.lon BETWEEN b.xmin AND b.xmax AND c.lat BETWEEN b.ymin AND b.ymax""")
def range_join(spark: SparkSession, sf: str) -> DataFrame:
    lon, lat = lonlat()
    pts = table(spark, sf, "customer", "c_custkey").select("c_custkey", lon.alias("lon"), lat.alias("lat"))
    k = F.col("r_regionkey")
    boxes = table(spark, sf, "region", "r_regionkey").select(k.alias("region_no"), (k * 60 - 150).cast("double").alias("xmin"), (k * 60 - 110).cast("double").alias("xmax"), (k * 20 - 60).cast("double").alias("ymin"), (k * 20 - 10).cast("double").alias("ymax"))
    return R.boxes_join(pts, boxes, "lon", "lat", ("xmin", "ymin", "xmax", "ymax"), 10.0).select("c_custkey", "region_no")


@twin("""SELECT e.event_id, CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS k, m.n_types FROM events e CROSS JOIN (SELECT count(DISTINCT event_type) AS n_types FROM events) m""")
def cross_meta_json(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events", "event_id", "props", "event_type")
    meta = e.agg(F.count_distinct("event_type").alias("n_types"))  # one row
    return e.crossJoin(F.broadcast(meta)).select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"), "n_types")


@twin("""SELECT j.key AS name, count(*) AS n FROM events e, json_each(e.props) j GROUP BY 1""")
def json_keys(spark: SparkSession, sf: str) -> DataFrame:
    keys = F.explode(F.map_keys(F.from_json("props", "map<string,string>")))
    return table(spark, sf, "events", "props").select(keys.alias("name")).groupBy("name").agg(F.count("*").alias("n"))


@twin("""SELECT CAST(c.c_custkey AS VARCHAR) AS id, c.c_acctbal AS balance, c.c_mktsegment AS segment, 'customer' AS source FROM customer c UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_acctbal, NULL, 'supplier' FROM supplier""")
def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("source"))
    s = table(spark, sf, "supplier").select(F.lit("supplier").alias("source"), F.col("s_acctbal").alias("balance"), F.col("s_suppkey").cast("string").alias("id"))
    return R.union_by_name([c, s])


@twin("""SELECT p_partkey, coalesce(TRY_CAST(p_brand AS DOUBLE), CAST(nullif(p_size, 1) AS DOUBLE), p_retailprice) AS measure, coalesce(nullif(p_type, ''), p_name) AS label FROM part""")
def candidate_coalesce(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "part").withColumns({"size_or_null": F.nullif("p_size", F.lit(1)), "type_or_null": F.nullif("p_type", F.lit(""))})
    return df.select("p_partkey", R.candidate(df, ["missing", "p_brand", "size_or_null", "p_retailprice"], "double").alias("measure"), R.candidate(df, ["type_or_null", "p_name"], "string").alias("label"))


@twin("""SELECT c.c_custkey, coalesce(o.n, 0)::BIGINT AS n_orders, o.n IS NOT NULL AS has_orders, o.n IS NULL OR o.n < 5 AS is_small, coalesce(o.top, -1.0)::DOUBLE AS top FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1) o ON o.o_custkey = c.c_custkey""")
def flags_and_fills(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders", "o_custkey", "o_totalprice").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"))
    df = table(spark, sf, "customer", "c_custkey").join(o, "c_custkey", "left")
    top = F.when(F.col("top").isNull() | F.isnan("top"), -1.0).otherwise(F.col("top"))
    return df.select("c_custkey", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_orders"), F.col("n").isNotNull().alias("has_orders"), (F.col("n").isNull() | (F.col("n") < 5)).alias("is_small"), top.alias("top"))


@twin("""SELECT n.n_name, r.r_name, CASE r.r_name WHEN 'EUROPE' THEN 1 WHEN 'ASIA' THEN 2 ELSE 9 END AS priority FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey""")
def dimension_lookup(spark: SparkSession, sf: str) -> DataFrame:
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    pri = F.create_map(F.lit("EUROPE"), F.lit(1), F.lit("ASIA"), F.lit(2))
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).select("n_name", "r_name", F.coalesce(F.try_element_at(pri, F.col("r_name")), F.lit(9)).alias("priority"))


@twin("""SELECT DISTINCT c.c_nationkey AS cell, s.s_nationkey IS NOT NULL AS is_supplied FROM customer c LEFT JOIN (SELECT DISTINCT s_nationkey FROM supplier) s ON s.s_nationkey = c.c_nationkey""")
def cell_exists(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer", "c_nationkey").distinct().withColumnRenamed("c_nationkey", "cell")
    s = table(spark, sf, "supplier", "s_nationkey").distinct().select(F.col("s_nationkey").alias("cell"), F.lit(True).alias("y"))
    return c.join(s, "cell", "left").select("cell", F.col("y").isNotNull().alias("is_supplied"))


@twin(f"""WITH g AS (SELECT x.i*40 AS gx, y.j*30 AS gy FROM range(10) x(i), range(10) y(j)), p AS (SELECT (x0//40)*40 AS gx, (y0//30)*30 AS gy, count(*) AS n, CAST(sum((x1-x0)*(y1-y0)) AS BIGINT) AS area FROM ({RECT_PART}) GROUP BY 1, 2)
SELECT g.gx, g.gy, coalesce(p.n, 0)::BIGINT AS n, coalesce(p.area, 0)::BIGINT AS area FROM g LEFT JOIN p ON p.gx = g.gx AND p.gy = g.gy""")
def grid_left_fill(spark: SparkSession, sf: str) -> DataFrame:
    p = rects(spark, sf, "part").groupBy(F.expr("(x0 div 40)*40").alias("gx"), F.expr("(y0 div 30)*30").alias("gy")).agg(F.count("*").alias("n"), F.sum(F.expr("(x1-x0)*(y1-y0)")).alias("area"))
    grid = spark.range(10).select((F.col("id") * 40).alias("gx"), F.explode(F.expr("sequence(0L, 270L, 30L)")).alias("gy"))
    return grid.join(p, ["gx", "gy"], "left").na.fill(0, ["n", "area"])


def positional_contexts(c: DataFrame) -> list[DataFrame]:
    """Two context tables with a row for every customer; some values are null, as the SQL has no row there."""
    k = F.col("c_custkey")
    site, cover = F.concat(F.lit("site"), (k % 7).cast("string")), F.concat(F.lit("cover"), (k % 5).cast("string"))
    return [c.select(k, F.when(k % 2 == 0, site).alias("site")), c.select(k, F.when(k % 3 == 0, cover).alias("cover"))]


def joined_contexts(rows: DataFrame, key: str, contexts: list[DataFrame]) -> DataFrame:
    """Rows with the columns of each context table, by key; null where it has no such key."""
    for context in contexts:
        rows = rows.join(context, key, "left")
    return rows


@twin("""SELECT c.c_custkey, a.site, b.cover FROM customer c LEFT JOIN (SELECT c_custkey, 'site' || CAST(c_custkey % 7 AS VARCHAR) AS site FROM customer WHERE c_custkey % 2 = 0) a USING (c_custkey) LEFT JOIN (SELECT c_custkey, 'cover' || CAST(c_custkey % 5 AS VARCHAR) AS cover FROM customer WHERE c_custkey % 3 = 0) b USING (c_custkey)""")
def positional_to_key_join(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer", "c_custkey")
    return joined_contexts(c, "c_custkey", positional_contexts(c))


# --- spatial operators in closed form ------------------------------------------------------

_PAIRS = f"""WITH a AS (SELECT *, (x0//20)*1000 + y0//20 AS cell, (x1-x0)*(y1-y0) AS area FROM ({RECT_CUSTOMER})), b AS (SELECT *, (x0//20)*1000 + y0//20 AS cell, (x1-x0)*(y1-y0) AS area FROM ({RECT_PART})), u AS (SELECT * FROM a UNION ALL SELECT * FROM b),
p AS (SELECT s.ds AS ds_a, s.id AS id_a, s.area AS area_a, l.ds AS ds_b, l.id AS id_b, l.area AS area_b, greatest(0, least(s.x1, l.x1) - greatest(s.x0, l.x0)) * greatest(0, least(s.y1, l.y1) - greatest(s.y0, l.y0)) AS common
FROM u s JOIN u l ON s.cell = l.cell AND s.ds <> l.ds AND (s.area < l.area OR (s.area = l.area AND s.ds > l.ds))),
gone AS (SELECT DISTINCT ds_b AS ds, id_b AS id FROM p WHERE common > 0 AND common < area_a AND common < area_b AND CAST(common AS DOUBLE) / least(area_a, area_b) > 0.5) """


def celled_rects(spark: SparkSession, sf: str) -> DataFrame:
    both = rects(spark, sf, "customer").unionByName(rects(spark, sf, "part"))
    return both.withColumns({"cell": F.expr("(x0 div 20)*1000 + y0 div 20"), "area": F.expr("(x1-x0)*(y1-y0)")})


def _removed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    u = celled_rects(spark, sf)
    a = u.select("cell", *[F.col(c).alias(f"a_{n}") for c, n in (("ds", "dataset"), ("area", "area"), ("x0", "x0"), ("y0", "y0"), ("x1", "x1"), ("y1", "y1"))])
    b = u.select("cell", *[F.col(c).alias(f"b_{n}") for c, n in (("ds", "dataset"), ("id", "id"), ("area", "area"), ("x0", "x0"), ("y0", "y0"), ("x1", "x1"), ("y1", "y1"))])
    zero = F.lit(0).cast("bigint")
    common = F.greatest(zero, F.least("a_x1", "b_x1") - F.greatest("a_x0", "b_x0")) * F.greatest(zero, F.least("a_y1", "b_y1") - F.greatest("a_y0", "b_y0"))
    pairs = a.join(b, "cell").filter("a_dataset <> b_dataset").select(
        F.col("a_dataset"), F.col("b_dataset"), F.col("b_id"), F.col("a_area").cast("double").alias("a_area"), F.col("b_area").cast("double").alias("b_area"), F.col("a_area").alias("a_size"), F.col("b_area").alias("b_size"), common.alias("common")
    )
    return u, P.removed_by_overlap(pairs)


@twin(_PAIRS + "SELECT u.ds, u.id FROM u LEFT JOIN gone ON gone.ds = u.ds AND gone.id = u.id WHERE gone.id IS NULL")
def overlap_dedup(spark: SparkSession, sf: str) -> DataFrame:
    u, gone = _removed(spark, sf)
    return u.join(gone.withColumnRenamed("dataset", "ds"), ["ds", "id"], "left_anti").select("ds", "id")


@twin(_PAIRS + """, r AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY area DESC, ds, id) AS rn FROM u), top AS (SELECT cell, ds, id, area FROM r WHERE rn = 1) SELECT * FROM top""")
def rank_dedup(spark: SparkSession, sf: str) -> DataFrame:
    # the row of a window's first rank, as an aggregate that is combined before the shuffle
    rank = F.struct(-F.col("area"), F.col("ds"), F.col("id"))
    return celled_rects(spark, sf).groupBy("cell").agg(F.min_by(F.struct("ds", "id", "area"), rank).alias("t")).select("cell", "t.ds", "t.id", "t.area")


@twin(_PAIRS + """SELECT 'before' AS stage, count(*) AS n, 0.0::DOUBLE AS pct_removed FROM u UNION ALL SELECT 'after', count(*), round(100.0 * (SELECT count(*) FROM gone) / (SELECT count(*) FROM u), 4)::DOUBLE FROM u LEFT JOIN gone ON gone.ds = u.ds AND gone.id = u.id WHERE gone.id IS NULL""")
def stats_before_after(spark: SparkSession, sf: str) -> DataFrame:
    u, gone = _removed(spark, sf)
    marked = u.join(gone.select(F.col("dataset").alias("ds"), "id", F.lit(1).alias("g")), ["ds", "id"], "left").agg(F.count("*").alias("n"), F.count("g").alias("g"))
    stages = F.array(F.struct(F.lit("before").alias("stage"), F.col("n").alias("n"), F.lit(0.0).alias("pct_removed")), F.struct(F.lit("after").alias("stage"), (F.col("n") - F.col("g")).alias("n"), F.round(F.lit(100.0) * F.col("g") / F.col("n"), 4).alias("pct_removed")))
    return marked.select(F.explode(stages).alias("s")).select("s.*")


@twin(f"""WITH u AS (SELECT *, (x1-x0)*(y1-y0) AS area, (x0//20)*1000 + y0//20 AS cell FROM ({RECT_PART})), p AS (SELECT a.id AS ia, b.id AS ib, a.area AS aa, b.area AS ab, greatest(0, least(a.x1,b.x1)-greatest(a.x0,b.x0))*greatest(0, least(a.y1,b.y1)-greatest(a.y0,b.y0)) AS common, (a.x0=b.x0 AND a.y0=b.y0 AND a.x1=b.x1 AND a.y1=b.y1) AS eq FROM u a JOIN u b ON a.cell = b.cell AND a.id < b.id)
SELECT DISTINCT CASE WHEN aa > ab THEN ia ELSE ib END AS id FROM p WHERE eq OR (common > 0 AND common < aa AND common < ab AND CAST(common AS DOUBLE) / least(aa, ab) > 0.5)""")
def pair_dedup_legacy(spark: SparkSession, sf: str) -> DataFrame:
    u = rects(spark, sf, "part").drop("ds").withColumns({"cell": F.expr("(x0 div 20)*1000 + y0 div 20"), "area": F.expr("(x1-x0)*(y1-y0)")})
    ren = lambda p: u.select("cell", *[F.col(c).alias(p + c) for c in ("id", "x0", "y0", "x1", "y1", "area")])
    zero = F.lit(0).cast("bigint")
    p = ren("a").join(ren("b"), "cell").filter("aid < bid")
    common = F.greatest(zero, F.least("ax1", "bx1") - F.greatest("ax0", "bx0")) * F.greatest(zero, F.least("ay1", "by1") - F.greatest("ay0", "by0"))
    eq = (F.col("ax0") == F.col("bx0")) & (F.col("ay0") == F.col("by0")) & (F.col("ax1") == F.col("bx1")) & (F.col("ay1") == F.col("by1"))
    p = p.withColumn("common", common)
    over = (F.col("common") > 0) & (F.col("common") < F.col("aarea")) & (F.col("common") < F.col("barea")) & (F.col("common") / F.least("aarea", "barea") > 0.5)
    # of an equal-area pair the one with the larger id goes
    return p.filter(eq | over).select(F.when(F.col("aarea") > F.col("barea"), F.col("aid")).otherwise(F.col("bid")).alias("id")).distinct()


_BOTH = f"SELECT c.id AS customer_id, p.id AS part_id FROM ({RECT_CUSTOMER}) c JOIN ({RECT_PART}) p ON "


def _both(spark: SparkSession, sf: str, where: Column | None = None) -> DataFrame:
    edges = (("x0", "xmin"), ("y0", "ymin"), ("x1", "xmax"), ("y1", "ymax"))
    boxes = lambda which, q: rects(spark, sf, which).select(F.col("id").alias(f"{q}id"), *[F.col(c).cast("double").alias(q + n) for c, n in edges])
    return box_pairs(boxes("customer", "a"), boxes("part", "b"), where).select(F.col("aid").alias("customer_id"), F.col("bid").alias("part_id"))


@twin(_BOTH + "c.x0 <= p.x1 AND p.x0 <= c.x1 AND c.y0 <= p.y1 AND p.y0 <= c.y1")
def spatial_join_intersects(spark: SparkSession, sf: str) -> DataFrame:
    return _both(spark, sf)


@twin(_BOTH + "p.x0 >= c.x0 AND p.x1 <= c.x1 AND p.y0 >= c.y0 AND p.y1 <= c.y1")
def spatial_join_within(spark: SparkSession, sf: str) -> DataFrame:
    return _both(spark, sf, F.expr("bxmin >= axmin AND bxmax <= axmax AND bymin >= aymin AND bymax <= aymax"))


@twin(f"""SELECT part.id AS part_id, count(c.id) AS n FROM ({RECT_PART}) part LEFT JOIN ({RECT_CUSTOMER}) c ON (c.x0-part.x0)*(c.x0-part.x0) + (c.y0-part.y0)*(c.y0-part.y0) <= 25 GROUP BY 1""")
def distance_join(spark: SparkSession, sf: str) -> DataFrame:
    p = rects(spark, sf, "part").select(F.col("id").alias("part_id"), F.col("x0").alias("px"), F.col("y0").alias("py"))
    c = rects(spark, sf, "customer").select(F.col("id").alias("cid"), "x0", "y0")
    boxes = p.withColumns({"bx0": F.col("px") - 5, "by0": F.col("py") - 5, "bx1": F.col("px") + 5, "by1": F.col("py") + 5})
    near = R.boxes_join(c, boxes, "x0", "y0", ("bx0", "by0", "bx1", "by1"), 10.0).filter("(x0-px)*(x0-px) + (y0-py)*(y0-py) <= 25").groupBy("part_id").agg(F.count("*").alias("n"))
    return p.select("part_id").join(near, "part_id", "left").na.fill(0, ["n"])


@twin(f"""SELECT p.id, p.x0, p.y0 FROM ({RECT_PART}) p WHERE p.x1 >= (SELECT min(x0) + 50 FROM ({RECT_CUSTOMER})) AND p.x0 <= (SELECT max(x1) - 100 FROM ({RECT_CUSTOMER})) AND p.y1 >= (SELECT min(y0) + 50 FROM ({RECT_CUSTOMER})) AND p.y0 <= (SELECT max(y1) - 100 FROM ({RECT_CUSTOMER}))""")
def bbox_prefilter(spark: SparkSession, sf: str) -> DataFrame:
    b = rects(spark, sf, "customer").agg((F.min("x0") + 50).alias("bx0"), (F.max("x1") - 100).alias("bx1"), (F.min("y0") + 50).alias("by0"), (F.max("y1") - 100).alias("by1"))  # one row
    return rects(spark, sf, "part").crossJoin(F.broadcast(b)).filter("x1 >= bx0 AND x0 <= bx1 AND y1 >= by0 AND y0 <= by1").select("id", "x0", "y0")


@twin(f"""SELECT id, CAST(x0 + x1 AS DOUBLE) / 2 AS cx, CAST(y0 + y1 AS DOUBLE) / 2 AS cy, (x1-x0)*(y1-y0) AS area, 'POLYGON ((' || x0 || ' ' || y0 || ', ' || x1 || ' ' || y0 || ', ' || x1 || ' ' || y1 || ', ' || x0 || ' ' || y1 || ', ' || x0 || ' ' || y0 || '))' AS wkt FROM ({RECT_CUSTOMER})""")
def envelope_centroid(spark: SparkSession, sf: str) -> DataFrame:
    from heliolake.functions.st import envelope_wkt

    return rects(spark, sf, "customer").select("id", ((F.col("x0") + F.col("x1")).cast("double") / 2).alias("cx"), ((F.col("y0") + F.col("y1")).cast("double") / 2).alias("cy"), F.expr("(x1-x0)*(y1-y0)").alias("area"), envelope_wkt("x0", "y0", "x1", "y1").alias("wkt"))


@twin(f"""SELECT id, round((x1-x0) * (y1-y0), 3)::DOUBLE AS area_planar, round(6378137.0 * radians(x0 * 0.9::DOUBLE - 180.0), 3) AS mx, round(6378137.0 * ln(tan(pi()/4 + radians(y0 * 0.5::DOUBLE - 75.0)/2)), 3) AS my FROM ({RECT_CUSTOMER})""")
def mercator_area(spark: SparkSession, sf: str) -> DataFrame:
    from heliolake.functions.st import mercator

    x, y = mercator(F.col("x0") * F.lit(0.9) - 180.0, F.col("y0") * F.lit(0.5) - 75.0)
    return rects(spark, sf, "customer").select("id", F.expr("(x1-x0)*(y1-y0)").cast("double").alias("area_planar"), F.round(x, 3).alias("mx"), F.round(y, 3).alias("my"))


@twin(f"""WITH RECURSIVE h AS (SELECT id, x0 % 256 AS x, y0 % 256 AS y, 128 AS s, CAST(0 AS BIGINT) AS d FROM ({RECT_PART})
UNION ALL SELECT id, CASE WHEN ry = 0 THEN CASE WHEN rx = 1 THEN 255 - y ELSE y END ELSE x END, CASE WHEN ry = 0 THEN CASE WHEN rx = 1 THEN 255 - x ELSE x END ELSE y END, s // 2, d + CAST(s AS BIGINT) * s * xor(3 * rx, ry)
FROM (SELECT *, CASE WHEN (x // s) % 2 = 1 THEN 1 ELSE 0 END AS rx, CASE WHEN (y // s) % 2 = 1 THEN 1 ELSE 0 END AS ry FROM h WHERE s > 0)) SELECT id, d AS code FROM h WHERE s = 0""")
def hilbert_order(spark: SparkSession, sf: str) -> DataFrame:
    from heliolake.functions.st import hilbert

    return rects(spark, sf, "part").select("id", hilbert(F.col("x0") % 256, F.col("y0") % 256, 8).alias("code"))


@twin(f"""SELECT id, ds, grid, (x0//grid)*grid AS gx, (y0//grid)*grid AS gy FROM (SELECT *, CASE WHEN (x1-x0)*(y1-y0) >= 40 THEN 40 ELSE 10 END AS grid FROM ({RECT_PART}))""")
def size_split_union(spark: SparkSession, sf: str) -> DataFrame:
    df = rects(spark, sf, "part").withColumn("grid", F.when(F.expr("(x1-x0)*(y1-y0)") >= 40, 40).otherwise(10))
    return df.select("id", "ds", "grid", F.expr("(x0 div grid)*grid").alias("gx"), F.expr("(y0 div grid)*grid").alias("gy"))


# --- windows, order, sampling ---------------------------------------------------------------


@twin("""SELECT o_custkey, o_orderkey, priority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY priority DESC, o_orderkey) AS rn FROM (SELECT o_custkey, o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4 WHEN '3-MEDIUM' THEN 3 WHEN '4-NOT SPECIFIED' THEN 2 ELSE 0 END AS priority FROM orders)) WHERE rn = 1""")
def best_match_priority(spark: SparkSession, sf: str) -> DataFrame:
    p = F.lit(0)
    for k, v in {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3, "4-NOT SPECIFIED": 2}.items():
        p = F.when(F.col("o_orderpriority") == k, F.lit(v)).otherwise(p)
    df = table(spark, sf, "orders", "o_custkey", "o_orderkey", "o_orderpriority").withColumn("priority", p)
    return R.best_by(df, ["o_custkey"], F.struct("priority", -F.col("o_orderkey")), "o_orderkey", "priority")


@twin("""SELECT p_brand, p_partkey, height FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY height IS NULL, height DESC, p_retailprice DESC, p_partkey) AS rn FROM (SELECT *, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size END AS height FROM part)) WHERE rn = 1""")
def best_match_nulls(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "part", "p_brand", "p_partkey", "p_size", "p_retailprice").withColumn("height", F.when(F.col("p_size") % 3 != 0, F.col("p_size")))
    return R.best_by(df, ["p_brand"], F.struct(F.col("height").isNotNull(), F.coalesce("height", F.lit(0)), "p_retailprice", -F.col("p_partkey")), "p_partkey", "height")


@twin(f"""SELECT cell, n, nations FROM (SELECT (x0//20)*1000 + y0//20 AS cell, count(*) AS n, count(DISTINCT id % 25) AS nations FROM ({RECT_CUSTOMER}) GROUP BY 1) ORDER BY n DESC, cell LIMIT 20""")
def top_k_cells(spark: SparkSession, sf: str) -> DataFrame:
    df = rects(spark, sf, "customer").groupBy(F.expr("(x0 div 20)*1000 + y0 div 20").alias("cell")).agg(F.count("*").alias("n"), F.count_distinct(F.col("id") % 25).alias("nations"))
    return df.orderBy(F.desc("n"), "cell").limit(20)


@twin("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def first_by_time(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events", "user_id", "event_id", "event_type", "ts")
    return e.groupBy("user_id").agg(F.min_by(F.struct("event_id", "event_type"), F.struct("ts", "event_id")).alias("b")).select("user_id", "b.event_id", "b.event_type")


@twin("""SELECT p_partkey, p_type, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS pos FROM part QUALIFY pos <= 100""")
def sorted_slice(spark: SparkSession, sf: str) -> DataFrame:
    # a top-k first, then positions of its 100 rows alone
    top = table(spark, sf, "part", "p_partkey", "p_type", "p_retailprice").orderBy(F.desc("p_retailprice"), "p_partkey").limit(100)
    return top.select("p_partkey", "p_type", F.row_number().over(Window.orderBy(F.desc("p_retailprice"), "p_partkey")).cast("bigint").alias("pos"))


@twin("""SELECT DISTINCT c_mktsegment FROM customer ORDER BY 1""")
def sorted_values(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer", "c_mktsegment").distinct().orderBy("c_mktsegment")


# --- scalar functions and filters -----------------------------------------------------------


@twin("""SELECT s_suppkey, sha256(concat_ws('_', s_name, CAST(s_nationkey AS VARCHAR), CAST(s_suppkey AS VARCHAR))) AS stable_id, md5(s_name) AS name_hash FROM supplier""")
def stable_id_sha256(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select("s_suppkey", F.sha2(F.concat_ws("_", "s_name", F.col("s_nationkey").cast("string"), F.col("s_suppkey").cast("string")), 256).alias("stable_id"), F.md5("s_name").alias("name_hash"))


@twin("""SELECT p_partkey, left(p_name, 4) AS head, lower(p_brand) AS brand, split_part(p_type, ' ', 1) AS kind, replace(p_name, ' ', '_') AS slug, ends_with(p_type, 'STEEL') AS is_steel, p_brand || '-' || p_type AS label FROM part""")
def string_functions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        "p_partkey", F.left("p_name", F.lit(4)).alias("head"), F.lower("p_brand").alias("brand"), F.split_part("p_type", F.lit(" "), F.lit(1)).alias("kind"), F.replace("p_name", F.lit(" "), F.lit("_")).alias("slug"), F.endswith("p_type", F.lit("STEEL")).alias("is_steel"), F.concat("p_brand", F.lit("-"), "p_type").alias("label")
    )


@twin("""SELECT p_partkey FROM part WHERE regexp_matches(p_type, '^(SMALL|LARGE)') OR p_name LIKE '%1%'""")
def regex_glob_filter(spark: SparkSession, sf: str) -> DataFrame:
    from heliolake.sources.files import glob_to_regex

    return table(spark, sf, "part", "p_partkey", "p_type", "p_name").filter(F.col("p_type").rlike("^(SMALL|LARGE)") | F.col("p_name").rlike(glob_to_regex("*1*"))).select("p_partkey")


@twin("""SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_totalprice BETWEEN 1000 AND 150000 AND o_orderpriority <> '5-LOW'""")
def dynamic_filter(spark: SparkSession, sf: str) -> DataFrame:
    rules = {"o_orderstatus": ("in", ["F", "O"]), "o_totalprice": ("between", (1000, 150000)), "o_orderpriority": ("!=", "5-LOW")}
    return R.filter_by(table(spark, sf, "orders"), rules).select("o_orderkey")


@twin("""SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross FROM lineitem""")
def lateral_alias(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax")
    return df.selectExpr("l_orderkey", "l_linenumber", "l_extendedprice * (1 - l_discount) AS net", "net * (1 + l_tax) AS gross")


@twin("""SELECT r_regionkey, i AS step, r_regionkey * 10 + i AS cell FROM region, range(3) t(i)""")
def unnest_lockstep(spark: SparkSession, sf: str) -> DataFrame:
    zipped = F.arrays_zip(F.array(*[F.lit(i) for i in range(3)]).alias("step"), F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.col("r_regionkey") * 10 + i).alias("cell"))
    return table(spark, sf, "region", "r_regionkey").select("r_regionkey", F.explode(zipped).alias("z")).select("r_regionkey", F.col("z.step").cast("bigint").alias("step"), F.col("z.cell").cast("bigint").alias("cell"))


_RES = "CASE " + " ".join(f"WHEN need <= {km2:.9f} THEN {res}" for res, km2 in reversed(list(enumerate(P.CELL_AREA_KM2)))) + " ELSE 0 END"


@twin(f"""SELECT res, count(*) AS n FROM (SELECT CASE WHEN area IS NULL OR area <= 0 THEN 15 ELSE {_RES} END AS res FROM (SELECT area, area / 1e6 * 1.05 AS need FROM (SELECT l_extendedprice * 100 AS area FROM lineitem))) GROUP BY 1""")
def adaptive_resolution(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem", "l_extendedprice").groupBy(P.adaptive_resolution(F.col("l_extendedprice") * 100).alias("res")).agg(F.count("*").alias("n"))


def _context() -> dict[str, Column]:
    k = F.col("c_custkey")
    pick = lambda m, *v: F.element_at(F.array(*[F.lit(x) for x in v]), (k % m).cast("int") + 1)
    return {
        "building_relationship": pick(4, "rooftop_confirmed", "rooftop_likely", "none", None),
        "land_use_type": pick(5, "industrial", "commercial", "agricultural", "residential", None),
        "land_cover_type": pick(3, "built_up", "grass", "bare"),
        "ecosystem_type": pick(7, "forest", "aquatic", "polar", "grassland", "urban", "barren", None),
        "land_use_suitability": pick(6, "highly_suitable", "suitable", "moderately_suitable", "unsuitable", "unknown", None),
        "environmental_impact": pick(11, "minimal_impact", "moderate_impact", "high_impact", "special_consideration", "minimal_impact", "minimal_impact", None, "moderate_impact", "minimal_impact", "minimal_impact", "x"),
        "admin_level": pick(3, "locality", "county", "country"),
        "has_admin": k % 2 == 0,
        "has_building": k % 3 == 0,
        "has_land_use": k % 5 != 0,
        "has_land_cover": F.when(k % 13 != 0, k % 7 != 0),
    }


def _listed(m: int, *v: str | None) -> str:
    return "[" + ", ".join("NULL" if x is None else f"'{x}'" for x in v) + f"][CAST(c_custkey % {m} AS INT) + 1]"


_SITES = f"""WITH c AS (SELECT c_custkey, coalesce({_listed(4, "rooftop_confirmed", "rooftop_likely", "none", None)}, 'unknown') AS b, coalesce({_listed(5, "industrial", "commercial", "agricultural", "residential", None)}, 'unknown') AS lu, {_listed(3, "built_up", "grass", "bare")} AS lc,
coalesce({_listed(7, "forest", "aquatic", "polar", "grassland", "urban", "barren", None)}, 'unknown') AS eco, coalesce({_listed(6, "highly_suitable", "suitable", "moderately_suitable", "unsuitable", "unknown", None)}, 'unknown') AS su,
coalesce({_listed(11, "minimal_impact", "moderate_impact", "high_impact", "special_consideration", "minimal_impact", "minimal_impact", None, "moderate_impact", "minimal_impact", "minimal_impact", "x")}, 'unknown') AS im, {_listed(3, "locality", "county", "country")} AS al FROM customer),
s AS (SELECT *, CASE WHEN b IN ('rooftop_confirmed','rooftop_likely') THEN 'rooftop' WHEN lu='industrial' THEN 'industrial_ground_mount' WHEN lu='commercial' THEN 'commercial_ground_mount' WHEN lu='agricultural' THEN 'agrivoltaic' WHEN lc='built_up' THEN 'urban_ground_mount' WHEN lc IN ('grass','bare') THEN 'utility_scale' ELSE 'ground_mount_other' END AS site_classification,
round(greatest(0, least(1, 0.5 + CASE b WHEN 'rooftop_confirmed' THEN 0.2 WHEN 'rooftop_likely' THEN 0.1 ELSE 0 END + CASE su WHEN 'highly_suitable' THEN 0.2 WHEN 'suitable' THEN 0.1 WHEN 'moderately_suitable' THEN 0.05 ELSE 0 END + CASE im WHEN 'minimal_impact' THEN 0.1 WHEN 'moderate_impact' THEN 0.05 WHEN 'high_impact' THEN -0.1 ELSE 0 END + CASE WHEN al IN ('locality','county') THEN 0.05 ELSE 0 END)), 4)::DOUBLE AS solar_potential_score,
CASE WHEN eco='forest' OR im='high_impact' THEN 'high_sensitivity' WHEN eco IN ('aquatic','polar') OR im='special_consideration' THEN 'special_consideration' WHEN eco IN ('grassland','agricultural') OR im='moderate_impact' THEN 'moderate_sensitivity' WHEN eco IN ('urban','barren') OR im='minimal_impact' THEN 'low_sensitivity' ELSE 'unknown_sensitivity' END AS environmental_sensitivity FROM c) """


@twin(_SITES + """SELECT c_custkey, site_classification, solar_potential_score, environmental_sensitivity, CASE WHEN su='highly_suitable' AND environmental_sensitivity='low_sensitivity' THEN 'highly_feasible' WHEN su IN ('suitable','highly_suitable') AND environmental_sensitivity IN ('low_sensitivity','moderate_sensitivity') THEN 'feasible' WHEN su='moderately_suitable' OR environmental_sensitivity='moderate_sensitivity' THEN 'moderately_feasible' WHEN environmental_sensitivity IN ('high_sensitivity','special_consideration') THEN 'challenging' ELSE 'unknown_feasibility' END AS development_feasibility FROM s""")
def site_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return P.site_scores(table(spark, sf, "customer", "c_custkey").withColumns(_context())).select("c_custkey", "site_classification", "solar_potential_score", "environmental_sensitivity", "development_feasibility")


@twin("""WITH f AS (SELECT c_custkey % 4 AS grp, (CAST(c_custkey%2=0 AS INT) + CAST(c_custkey%3=0 AS INT) + CAST(c_custkey%5<>0 AS INT) + CAST(c_custkey%13<>0 AND c_custkey%7<>0 AS INT)) / 4.0::DOUBLE AS cc FROM customer) SELECT grp, count(*) AS n, round(avg(cc), 6) AS mean_completeness, count(*) FILTER (WHERE cc >= 0.75) AS complete FROM f GROUP BY 1""")
def context_completeness(spark: SparkSession, sf: str) -> DataFrame:
    df = P.site_scores(table(spark, sf, "customer", "c_custkey").withColumns(_context()))
    return df.groupBy((F.col("c_custkey") % 4).alias("grp")).agg(F.count("*").alias("n"), F.round(F.avg("context_completeness"), 6).alias("mean_completeness"), F.count_if(F.col("has_complete_context")).alias("complete"))


# --- quality -------------------------------------------------------------------------------


@twin("""SELECT 'not_null' AS rule, CAST(count(*) FILTER (WHERE c_mktsegment IS NULL) AS BIGINT) AS violations FROM customer UNION ALL SELECT 'unique', (SELECT count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)) UNION ALL SELECT 'accepted_values', (SELECT count(*) FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')) UNION ALL SELECT 'accepted_range', (SELECT count(*) FROM customer WHERE c_acctbal < 0 OR c_acctbal > 5000) UNION ALL SELECT 'relationships', (SELECT count(*) FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer))""")
def expectations_counts(spark: SparkSession, sf: str) -> DataFrame:
    from heliolake.operators import expectations as X

    c, o = table(spark, sf, "customer"), table(spark, sf, "orders", "o_custkey")
    rules = {
        "not_null": X.not_null(c, "c_mktsegment"),
        "unique": X.unique(o, "o_custkey"),
        "accepted_values": X.accepted_values(c, "c_mktsegment", ["BUILDING", "MACHINERY"]),
        "accepted_range": X.accepted_range(c, "c_acctbal", 0, 5000),
        "relationships": X.relationships(o, "o_custkey", c, "c_custkey"),
    }
    return X.summary(rules)


@twin("""SELECT snapshot_id, n_orders FROM (SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS snapshot_id, count(*) AS n_orders, max(date_trunc('day', o_orderdate)) AS ts FROM orders GROUP BY 1) WHERE ts < (SELECT max(date_trunc('day', o_orderdate)) FROM orders) - INTERVAL 365 DAY""")
def snapshot_expire(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders", "o_orderdate")
    snaps = o.groupBy(F.date_format("o_orderdate", "yyyyMMdd").cast("bigint").alias("snapshot_id")).agg(F.count("*").alias("n_orders"), F.max(F.date_trunc("day", "o_orderdate")).alias("ts"))
    last = o.agg(F.max(F.date_trunc("day", "o_orderdate")).alias("last"))  # one row
    return snaps.crossJoin(F.broadcast(last)).filter(F.col("ts") < F.col("last") - F.expr("INTERVAL 365 DAYS")).select("snapshot_id", "n_orders")
