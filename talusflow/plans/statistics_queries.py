"""Queries: cleaning, scaling, describing."""

from __future__ import annotations

from pyspark.sql import functions as F

from talusflow.operators import statistics as st
from talusflow.operators.skew import count_hot_keys, salted_join
from talusflow.plans import proxy
from talusflow.plans.feature_queries import _facts
from talusflow.plans.registry import query
from talusflow.schemas import METRIC_NAMES

CENTS = "CAST(value AS DECIMAL(7,2))"


def _readings(spark, sf_dir):
    return proxy.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts",
                                                       "value")


@query("noise_filter",
       "SELECT event_id, user_id, value, round(CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS "
       "DOUBLE) / count(*) OVER w, 6) AS smoothed FROM events WINDOW w AS "
       "(PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)")
def noise_filter(spark, sf_dir):
    readings = _readings(spark, sf_dir).select("event_id", "user_id", "ts", "value")
    smooth = st.noise_filter(readings, "user_id", ["ts", "event_id"], "value")
    return smooth.select("event_id", "user_id", "value", F.round("smoothed", 6).alias("smoothed"))


@query("outlier_filter",
       "SELECT event_id, user_id, value FROM events JOIN (SELECT user_id, avg(value) AS m, "
       "stddev_samp(value) AS s FROM events GROUP BY user_id) USING (user_id) "
       "WHERE coalesce(abs(value - m) <= 3 * s, true)")
def outlier_filter(spark, sf_dir):
    readings = _readings(spark, sf_dir).select("event_id", "user_id", "value")
    return st.outlier_filter(readings, "user_id", "value", ["event_id"])


@query("outlier_filter_iqr",
       "SELECT event_id, user_id, value FROM events JOIN (SELECT user_id, "
       "quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events "
       "GROUP BY user_id) USING (user_id) WHERE value BETWEEN q1 - 1.5 * (q3 - q1) "
       "AND q3 + 1.5 * (q3 - q1)")
def outlier_filter_iqr(spark, sf_dir):
    readings = _readings(spark, sf_dir).select("event_id", "user_id",
                                               F.expr(CENTS).alias("value"))
    return st.outlier_filter_iqr(readings, "user_id", "value", ["event_id"])


@query("standardize",
       "SELECT event_id, event_type, round((value - m) / s, 6) AS scaled FROM events JOIN "
       "(SELECT event_type, avg(value) AS m, stddev_samp(value) AS s FROM events "
       "GROUP BY event_type) USING (event_type)")
def standardize(spark, sf_dir):
    readings = _readings(spark, sf_dir).select("event_id", "event_type", "value")
    scaled = st.standardize(readings, ["event_type"], "value", ["event_id"])
    return scaled.select("event_id", "event_type", F.round("scaled", 6).alias("scaled"))


@query("minmax_normalize",
       "SELECT event_id, event_type, round((value - a) / (b - a), 6) AS scaled FROM events JOIN "
       "(SELECT event_type, min(value) AS a, max(value) AS b FROM events GROUP BY event_type) "
       "USING (event_type)")
def minmax_normalize(spark, sf_dir):
    readings = _readings(spark, sf_dir).select("event_id", "event_type", "value")
    scaled = st.minmax_normalize(readings, ["event_type"], "value", ["event_id"])
    return scaled.select("event_id", "event_type", F.round("scaled", 6).alias("scaled"))


LONG_METRICS = " UNION ALL ".join(
    f"SELECT location_id, year, month, '{m}' AS metric, {m} AS v FROM facts"
    for m in METRIC_NAMES)


@query("metric_statistics",
       "SELECT location_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, metric, "
       "count(v) AS n, CAST(sum(CAST(v AS DECIMAL(18,3))) AS DOUBLE) / count(v) AS mean, "
       "round(stddev_samp(v), 6) AS stddev, "
       "min(v) AS low, max(v) AS high, round(quantile_cont(v, 0.25), 6) AS q1, "
       "round(quantile_cont(v, 0.5), 6) AS median, round(quantile_cont(v, 0.75), 6) AS q3 "
       f"FROM ({LONG_METRICS}) WHERE v IS NOT NULL GROUP BY ALL")
def metric_statistics(spark, sf_dir):
    kinds = {m: "decimal(6,3)" if m.startswith("soil_moisture") else "decimal(5,2)"
             for m in METRIC_NAMES}
    stats = st.metric_statistics(_facts(spark, sf_dir), ["location_id", "year", "month"], kinds)
    rounded = ("stddev", "q1", "median", "q3")
    return stats.withColumns({c: F.round(c, 6) for c in rounded})


@query("hot_key_join",
       "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_returnflag, "
       "count(*) AS n_rows, max(top_price) AS top_price FROM lineitem JOIN "
       "(SELECT l_returnflag, max(l_extendedprice) AS top_price FROM lineitem "
       "GROUP BY l_returnflag) USING (l_returnflag) GROUP BY 1, 2, 3")
def hot_key_join(spark, sf_dir):
    """Each of the three keys holds a third of the rows, so all of them are split."""
    items = proxy.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber",
                                                          "l_returnflag", "l_extendedprice")
    top = items.groupBy("l_returnflag").agg(F.max("l_extendedprice").alias("top_price"))
    hot = count_hot_keys(items, ["l_returnflag"], floor=1)
    joined = salted_join(items.drop("l_extendedprice"), top, ["l_returnflag"],
                         ["l_orderkey", "l_linenumber"], hot)
    return joined.groupBy("l_orderkey", "l_linenumber", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("top_price").alias("top_price"))
