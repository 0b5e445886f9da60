"""The facility job's analytics as queries over a fact built from the driver tables, with their SQL.

Units are segments of nations, regions are countries, return flags are indicators, and line
status is the category. Asia has no name, households no area, and lines numbered three no value. Some parts weigh a thousandfold, so that there are anomalies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardbook.functions.periods import period_of, with_period_columns
from wardbook.plans import facility

DOUBLES = ("mom_percent_change", "rolling_3_month_avg", "reporting_rate", "rolling_mean", "rolling_stddev", "z_score",
           "avg_streak_completeness")


def _fact(read) -> DataFrame:
    lines, orders, customer = read("lineitem"), read("orders"), read("customer")
    nation, region = read("nation"), read("region")
    weight = F.when(F.col("l_partkey") % 500 == 1, F.col("l_quantity") * 1000).otherwise(F.col("l_quantity"))
    rows = (
        lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        .join(customer, orders["o_custkey"] == customer["c_custkey"])
        .join(nation, customer["c_nationkey"] == nation["n_nationkey"])
        .join(region, nation["n_regionkey"] == region["r_regionkey"])
    )
    grain = {
        "health_area": F.nullif("c_mktsegment", F.lit("HOUSEHOLD")),
        "country_name": F.nullif("r_name", F.lit("ASIA")), "region_name": F.lit(None).cast("string"),
        "district_name": F.col("n_name"), "facility_name": F.concat_ws(" ", "n_name", "c_mktsegment"),
        "org_unit_uid": F.concat(F.lit("N"), "n_nationkey", F.lit("/"), "c_mktsegment"),
        "data_element_uid": F.col("l_returnflag"), "data_element_name": F.lower("l_returnflag"),
        "category_option_combo_uid": F.col("l_linestatus"), "category_option_combo_name": F.lower("l_linestatus"),
        "program_uid": F.lit(None).cast("string"), "period": period_of(F.col("l_shipdate").cast("date")),
        "expected_indicator_count": (F.col("n_regionkey") + 5).cast("long"),
    }
    folded = rows.select(*[c.alias(n) for n, c in grain.items()], weight.alias("weight"), "l_linenumber").groupBy(*grain).agg(
        F.sum(F.when(F.col("l_linenumber") != 3, F.col("weight"))).alias("numeric_value"),
        F.count_distinct("l_linenumber").alias("reported_indicator_count"),
    )
    scored = folded.withColumns({
        "raw_value": F.col("numeric_value").cast("long").cast("string"), "rows": F.lit(1),
        "completeness_score": F.col("reported_indicator_count") / F.col("expected_indicator_count"),
    })
    return with_period_columns(scored)


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in df.columns if c in DOUBLES})


def fact_month_over_month(spark: SparkSession, read) -> DataFrame:
    return _rounded(facility.month_over_month_change(_fact(read)))


def fact_rolling_average(spark: SparkSession, read) -> DataFrame:
    return _rounded(facility.rolling_three_month_average(_fact(read)))


def fact_reporting_rate(spark: SparkSession, read) -> DataFrame:
    return _rounded(facility.country_reporting_rate(_fact(read)))


def fact_top_underreporting(spark: SparkSession, read) -> DataFrame:
    return facility.top_underreporting_facilities(_fact(read))


def fact_anomalies(spark: SparkSession, read) -> DataFrame:
    return _rounded(facility.anomalies(_fact(read)))


def fact_volumes(spark: SparkSession, read) -> DataFrame:
    return facility.global_volumes_by_quarter(_fact(read))


def fact_completeness(spark: SparkSession, read) -> DataFrame:
    return facility.completeness_comparison(_fact(read))


def fact_coverage_pairs(spark: SparkSession, read) -> DataFrame:
    return facility.FOLDS["coverage"][1](_fact(read)).select("data_element_name", "country_name").distinct()


def fact_coverage_matrix(spark: SparkSession, read) -> DataFrame:
    return facility.data_element_coverage_matrix(_fact(read))


def fact_low_completeness(spark: SparkSession, read) -> DataFrame:
    return _rounded(facility.low_completeness_flags(facility.completeness_comparison(_fact(read), ordered=False)))


def fact_volumes_from_folds(spark: SparkSession, read) -> DataFrame:
    """Volumes from the fold by month that an incremental run keeps."""
    return facility.global_volumes_by_quarter(facility.FOLDS["volumes"][1](_fact(read)))


def fact_reporting_rate_from_folds(spark: SparkSession, read) -> DataFrame:
    return _rounded(facility.country_reporting_rate(facility.FOLDS["presence"][1](_fact(read))))


QUERIES = {
    f.__name__: f for f in (
        fact_month_over_month, fact_rolling_average, fact_reporting_rate, fact_top_underreporting, fact_anomalies,
        fact_volumes, fact_completeness, fact_coverage_pairs, fact_coverage_matrix, fact_low_completeness,
        fact_volumes_from_folds, fact_reporting_rate_from_folds,
    )
}

FACT = """
    WITH f AS (
        SELECT nullif(c_mktsegment, 'HOUSEHOLD') AS health_area, nullif(r_name, 'ASIA') AS country_name,
               CAST(NULL AS VARCHAR) AS region_name, n_name AS district_name, n_name || ' ' || c_mktsegment AS facility_name,
               'N' || n_nationkey || '/' || c_mktsegment AS org_unit_uid, l_returnflag AS data_element_uid,
               lower(l_returnflag) AS data_element_name, l_linestatus AS category_option_combo_uid,
               lower(l_linestatus) AS category_option_combo_name, strftime(l_shipdate, '%Y%m') AS period,
               year(l_shipdate) || 'Q' || quarter(l_shipdate) AS quarter, n_regionkey + 5 AS expected,
               sum(CASE WHEN l_linenumber <> 3 THEN l_quantity * CASE WHEN l_partkey % 500 = 1 THEN 1000 ELSE 1 END END) AS v,
               count(DISTINCT l_linenumber) AS reported
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
             JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        GROUP BY ALL)
"""
MEANS = f"""
    {FACT},
    sums AS (SELECT country_name, health_area, period, expected, sum(reported)::DOUBLE AS s, count(*) AS c FROM f GROUP BY ALL),
    means AS (
        SELECT country_name, health_area, period,
               list_reduce(list_prepend(0::DOUBLE, list(s / expected ORDER BY expected)), lambda a, b: a + b) / sum(c)
                   AS avg_completeness_score
        FROM sums GROUP BY ALL)
"""
VOLUMES = f"{FACT} SELECT health_area, quarter, sum(v) AS total_service_volume FROM f GROUP BY ALL"
RATES = f"""
    {FACT},
    e AS (SELECT country_name, count(DISTINCT org_unit_uid) AS expected_facilities FROM f GROUP BY 1),
    r AS (SELECT country_name, period, count(DISTINCT org_unit_uid) AS reported_facilities FROM f WHERE v IS NOT NULL GROUP BY ALL)
    SELECT country_name, period, expected_facilities, reported_facilities,
           round(reported_facilities * 1.0::DOUBLE / expected_facilities, 6) AS reporting_rate
    FROM r JOIN e USING (country_name)
"""
ORACLES = {
    "fact_month_over_month": f"""
        {FACT},
        m AS (SELECT health_area, district_name, data_element_name, period AS year_month, sum(v) AS monthly_value FROM f GROUP BY ALL),
        p AS (SELECT *, lag(monthly_value) OVER (
                  PARTITION BY health_area, district_name, data_element_name ORDER BY year_month) AS previous_month_value FROM m)
        SELECT *, CASE WHEN previous_month_value > 0
            THEN round((monthly_value - previous_month_value) / previous_month_value * 100, 6) END AS mom_percent_change FROM p
    """,
    "fact_rolling_average": f"""
        {FACT},
        m AS (SELECT country_name, facility_name, org_unit_uid, data_element_name, period AS year_month, sum(v) AS monthly_value
              FROM f GROUP BY ALL)
        SELECT *, round(avg(monthly_value) OVER (
            PARTITION BY org_unit_uid, data_element_name ORDER BY year_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6)
            AS rolling_3_month_avg FROM m
    """,
    "fact_reporting_rate": RATES,
    "fact_reporting_rate_from_folds": RATES,
    "fact_top_underreporting": f"""
        {FACT},
        z AS (SELECT health_area, country_name, facility_name, org_unit_uid, period, sum(coalesce(v, 0)) = 0 AS zero FROM f GROUP BY ALL),
        u AS (SELECT health_area, country_name, facility_name, org_unit_uid, sum(zero::INT)::BIGINT AS zero_data_periods FROM z GROUP BY ALL)
        SELECT *, (rank() OVER (PARTITION BY health_area ORDER BY zero_data_periods DESC))::INT AS rank FROM u QUALIFY rank <= 5
    """,
    "fact_anomalies": f"""
        {FACT},
        w AS (SELECT *, v AS numeric_value, avg(v) OVER k AS m, stddev_samp(v) OVER k AS s FROM f WINDOW k AS (
                  PARTITION BY org_unit_uid, data_element_uid, category_option_combo_uid ORDER BY period
                  ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))
        SELECT country_name, region_name, district_name, facility_name, org_unit_uid, data_element_name, data_element_uid,
               category_option_combo_name, period, numeric_value, round(m, 6) AS rolling_mean, round(s, 6) AS rolling_stddev,
               round((v - m) / s, 6) AS z_score
        FROM w WHERE s > 0 AND abs(v - m) > 3 * s
    """,
    "fact_volumes": VOLUMES,
    "fact_volumes_from_folds": VOLUMES,
    "fact_completeness": f"{MEANS} SELECT * FROM means",
    "fact_coverage_pairs": f"{FACT} SELECT DISTINCT data_element_name, country_name FROM f",
    "fact_coverage_matrix": f"""
        {FACT}
        SELECT data_element_name, max((country_name IS NULL)::INT) AS "null", {', '.join(
            f"max((country_name IS NOT DISTINCT FROM '{c}')::INT) AS "
            f'"{c}"' for c in ("AFRICA", "AMERICA", "EUROPE", "MIDDLE EAST"))}
        FROM f GROUP BY 1
    """,
    "fact_low_completeness": f"""
        {MEANS},
        low AS (SELECT *, (period[1:4]::INT * 12 + period[5:6]::INT) - row_number() OVER (
                    PARTITION BY country_name, health_area ORDER BY period) AS island
                FROM means WHERE avg_completeness_score < 0.8)
        SELECT country_name, health_area, count(*) AS consecutive_low_periods, min(period) AS streak_start_period,
               max(period) AS streak_end_period, round(avg(avg_completeness_score), 6) AS avg_streak_completeness
        FROM low GROUP BY country_name, health_area, island HAVING count(*) >= 3
    """,
}
