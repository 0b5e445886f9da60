"""Each operator as a query over the driver's tables; the SQL it must equal is in ``oracles``.

Money is summed as whole cents, which is exact in any order, and leaves as a double.
Dates leave as text. Months are grouped by their first day and turned into ``yyyyMM`` text
after the aggregate, on few rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardbook.functions.columns import ratio
from wardbook.functions.periods import period_dimension, period_of, with_period_columns
from wardbook.functions.values import with_quality_flags, with_typed_values
from wardbook.operators import completeness as scoring
from wardbook.operators import crossview, facilities, trends
from wardbook.operators.contract import ColumnSpec, contract_report
from wardbook.operators.drift import drift_totals, snapshot_drift
from wardbook.operators.hierarchy import flatten_hierarchy, paths_from_parents
from wardbook.operators.history import attach_as_of, drift_between, validity
from wardbook.operators.incremental import differing_periods, new_periods_only, period_digests
from wardbook.operators.latest import latest_by, unique_lookup
from wardbook.operators.records import explode_records
from wardbook.operators.resolve import flag_unresolved, resolve, unresolved
from wardbook.operators.star import ambiguous_keys, fill_unknown, project_fact
from wardbook.operators.trailing import HotKeyRanges, HotKeySplit
from wardbook.operators.validity import count_stages, split_valid, validity_summary, with_validity
from wardbook.plans import export_queries, facility, fact_queries
from wardbook.sources.tables import query_workspace, side_by_side

# The driver tables' columns, so that no job has to look them up in file footers.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
              " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
                " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
                " l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "labels": "doc_id long, quality int, toxic int",
}
SNAPSHOT_DATE = "1998-07-01"
LOW_DAY_SCORE = 0.5
DOCUMENT_CONTRACT = [
    ColumnSpec("doc_id", "long", nullable=False),
    ColumnSpec("source", "string"),
    ColumnSpec("n_chars", "integer"),
    ColumnSpec("title", "string"),
    ColumnSpec("quality", "integer", nullable=False),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _cents(column: str) -> Column:
    return F.floor(F.col(column) * 100 + 0.5)


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


def _month(column: str) -> Column:
    return F.trunc(F.col(column).cast("date"), "month")


def _as_period(df: DataFrame, month: str = "month", period: str = "period") -> DataFrame:
    return df.withColumn(month, period_of(F.col(month))).withColumnRenamed(month, period)


def _orders_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "customer")
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"])


def _labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), ["doc_id"])


# Sources, flattening, validity


def explode_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = _table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.transform("embedding", lambda x, i: F.struct(i.alias("position"), x.alias("value"))).alias("parts"),
    )
    return explode_records(nested, "parts", {
        "position": F.col("record.position").cast("long"),
        "value": F.col("record.value").cast("double"),
    }, keep=["vec_id"])


def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k int")["k"].cast("long").alias("k"))


def _unpadded_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order months written without a leading zero: five digits, malformed, up to September."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.concat(
        F.year("o_orderdate").cast("string"), F.month("o_orderdate").cast("string")).alias("period"))
    return with_validity(orders, ["o_orderkey", "o_custkey"], "period")


def validity_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unpadded_periods(spark, sf_dir).select("o_orderkey", "period", "is_valid")


def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_valid(_unpadded_periods(spark, sf_dir))[1]


def quarantine_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(validity_summary(_unpadded_periods(spark, sf_dir)), "quarantine_rate")


def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan of each table, whatever the number of stages counted from it."""
    documents = _table(spark, sf_dir, "documents").select("doc_id")
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("labelled"))
    return count_stages(_unpadded_periods(spark, sf_dir), {
        "orders": F.lit(True), "valid_orders": F.col("is_valid"), "malformed_orders": ~F.col("is_valid"),
    }).unionByName(count_stages(resolve(documents, labels, ["doc_id"]), {
        "documents": F.lit(True), "unlabelled_documents": F.col("labelled").isNull(),
    }))


def period_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = _table(spark, sf_dir, "orders").select(_month("o_orderdate").alias("month")).distinct()
    dimension = period_dimension(_as_period(months))
    return dimension.withColumns({
        c: F.col(c).cast("string") for c in ("period_start_date", "period_end_date")
    })


def typed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document attributes as text observations; a language typed as a number does not parse."""
    kinds = [
        ("n_chars", "INTEGER_ZERO_OR_POSITIVE"), ("quality", "BOOLEAN"), ("toxic", "INTEGER"),
        ("lang", "NUMBER"), ("source", "TEXT"),
    ]
    observations = _labelled_documents(spark, sf_dir).select("doc_id", F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(kind).alias("kind"),
                 F.col(name).cast("string").alias("value"))
        for name, kind in kinds
    ]).alias("attributes"))
    rows = explode_records(observations, "attributes", {
        "data_element_name": "record.name", "value_type": "record.kind", "raw_value": "record.value",
    }, keep=["doc_id"])
    flagged = with_quality_flags(
        with_typed_values(rows).withColumn("day", F.lit("2024-01-01").cast("date")),
        updated="day", period_end="day",
    )
    return flagged.drop("day", "is_late_reported")


def late_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus", "l_shipdate")
    joined = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).withColumn(
        "period_end_date", F.last_day("o_orderdate"))
    flagged = with_quality_flags(joined, value="l_linestatus", updated="l_shipdate")
    return flagged.select(
        "l_orderkey", "l_linenumber", F.col("period_end_date").cast("string"), "is_late_reported"
    )


# Joins and lookups


def resolve_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels").withColumn("matched", F.lit(True))
    documents = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    return resolve(documents, labels, ["doc_id"]).withColumns({
        "matched": F.coalesce("matched", F.lit(False)),
        "quality": F.col("quality").cast("long"),
        "toxic": F.col("toxic").cast("long"),
    })


def unresolved_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    return unresolved(documents, _table(spark, sf_dir, "labels"), ["doc_id"])


def unresolved_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with an unknown or missing return flag, or from an unknown supplier, found in one pass."""
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif("l_returnflag", F.lit("N")).alias("flag"), "l_suppkey")
    flags = spark.range(1).select(F.lit("R").alias("flag"))
    suppliers = _table(spark, sf_dir, "supplier").filter("s_acctbal >= 0").select(F.col("s_suppkey").alias("l_suppkey"))
    return flag_unresolved(lines, {"unknown_flag": (flags, ["flag"]), "unknown_supplier": (suppliers, ["l_suppkey"])})


def flag_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late order lines, missing attributes and zeros of documents: each the rows where a flag holds."""
    late = late_flags(spark, sf_dir).filter("is_late_reported").select(
        F.lit("late").alias("split"), F.col("l_orderkey").alias("id"), F.col("l_linenumber").cast("string").alias("part"))
    flags = F.array(F.when(F.col("is_missing_value"), "missing"), F.when(F.col("is_explicit_zero"), "zero"))
    documents = typed_values(spark, sf_dir).select(
        F.explode(F.array_compact(flags)).alias("split"), F.col("doc_id").alias("id"), F.col("data_element_name").alias("part"))
    return late.unionByName(documents)


def flatten_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    region, nation = _table(spark, sf_dir, "region"), _table(spark, sf_dir, "nation")
    customer = _table(spark, sf_dir, "customer")
    region_id = F.concat(F.lit("R"), "r_regionkey")
    nation_id = F.concat(F.lit("N"), "n_nationkey")
    nation_path = F.concat(F.lit("/R"), "n_regionkey", F.lit("/N"), "n_nationkey")
    customer_id = F.concat(F.lit("C"), "c_custkey")
    nodes = (
        region.select(region_id.alias("id"), F.col("r_name").alias("name"), F.lit(1).alias("level"),
                      F.concat(F.lit("/"), region_id).alias("path"))
        .unionByName(nation.select(nation_id.alias("id"), F.col("n_name").alias("name"),
                                   F.lit(2).alias("level"), nation_path.alias("path")))
        .unionByName(
            customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
            .select(customer_id.alias("id"), F.col("c_name").alias("name"), F.lit(3).alias("level"),
                    F.concat(nation_path, F.lit("/"), customer_id).alias("path")))
    )
    return flatten_hierarchy(nodes, 3, {1: "region_name", 2: "nation_name"})


def hierarchy_from_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as ``flatten_hierarchy``, from a tree that has parents instead of paths."""
    region, nation = _table(spark, sf_dir, "region"), _table(spark, sf_dir, "nation")
    nodes = (
        region.select(F.concat(F.lit("R"), "r_regionkey").alias("id"), F.col("r_name").alias("name"), F.lit(None).cast("string").alias("parent"))
        .unionByName(nation.select(
            F.concat(F.lit("N"), "n_nationkey").alias("id"), F.col("n_name").alias("name"), F.concat(F.lit("R"), "n_regionkey").alias("parent")))
        .unionByName(_table(spark, sf_dir, "customer").select(
            F.concat(F.lit("C"), "c_custkey").alias("id"), F.col("c_name").alias("name"), F.concat(F.lit("N"), "c_nationkey").alias("parent")))
    )
    tree = paths_from_parents(nodes, query_workspace(spark))
    return flatten_hierarchy(tree, 3, {1: "region_name", 2: "nation_name"}, level="depth").withColumnRenamed("depth", "level")


def tree_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a deep tree: each under the one of half its key, some under one of theirs, in a circle."""
    key = F.col("c_custkey")
    nodes = _table(spark, sf_dir, "customer").select(
        key.alias("id"), F.when(key % 50 == 7, key * 2).otherwise(F.floor(key / 2)).alias("parent"))
    found = paths_from_parents(nodes, query_workspace(spark))
    return found.withColumn("depth", F.col("depth").cast("long"))


def latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey")
    latest = latest_by(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"], ["l_partkey", "l_suppkey"])
    return latest.withColumn("l_shipdate", F.col("l_shipdate").cast("date").cast("string"))


def unique_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_name", "p_type")
    return unique_lookup(parts, ["p_brand"])


def _part_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as programs whose expected items are the words of the part's name."""
    programs = _table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", F.split("p_name", " ").alias("words"))
    return explode_records(programs, "words", {"word": "record"}, keep=["p_partkey", "p_brand"])


def program_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part_words(spark, sf_dir)


def expected_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.expected_counts(_part_words(spark, sf_dir), ["p_brand"], "word", count="expected_words")


def ambiguous_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ambiguous_keys(_part_words(spark, sf_dir), ["p_brand", "word"])


def program_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders to the program of their nation and segment, if it expects their priority.

    A program expects the priorities of the orders of its customers in debt.
    """
    observed = _orders_of_customers(spark, sf_dir).select(
        "o_orderkey", "c_nationkey", "c_mktsegment", "o_orderpriority", "c_acctbal")
    keys = ["o_orderpriority", "c_nationkey", "c_mktsegment"]
    bridge = observed.filter(F.col("c_acctbal") < 0).select(*keys).distinct().withColumn(
        "program_name", F.concat_ws(" ", "c_mktsegment", F.col("c_nationkey").cast("string")))
    return resolve(observed, bridge, keys).select("o_orderkey", "o_orderpriority", "program_name")


# Completeness


def _day_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as observations: unit user, period day, item event type, group month."""
    day = F.col("ts").cast("date")
    return _table(spark, sf_dir, "events").select(
        F.trunc(day, "month").alias("month"), "user_id", day.alias("day"), "event_type", "value")


def _user_day_scores(events: DataFrame) -> DataFrame:
    expected = query_workspace(events.sparkSession).keep(scoring.expected_counts(events, ["month"], "event_type"), "expected")
    reported = scoring.reported_counts(
        events, ["month", "user_id", "day"], "event_type", require_value="value")
    return scoring.completeness(reported, expected, ["month"])


def user_day_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _user_day_scores(_day_events(spark, sf_dir))
    return _rounded(scores.drop("month"), "completeness_score").withColumn("day", F.col("day").cast("string"))


def _scored_user_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user and day with its score and its number of events, both from one pass.

    Expected counts are one row per month, written so that Spark knows their size when it joins.
    """
    events = _day_events(spark, sf_dir)
    expected = query_workspace(spark).keep(scoring.expected_counts(events, ["month"], "event_type"), "expected")
    reported = scoring.reported_counts(
        events, ["month", "user_id", "day"], "event_type", require_value="value", rows="rows")
    return scoring.completeness(reported, expected, ["month"])


def mean_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = scoring.mean_score(_scored_user_days(spark, sf_dir), ["day"], weight="rows", counts=facility.SCORE_COUNTS)
    return means.withColumn("day", F.col("day").cast("string"))


def mean_score_by_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = scoring.mean_score(_scored_user_days(spark, sf_dir), ["day"], unit=["user_id"], counts=facility.SCORE_COUNTS)
    return means.withColumn("day", F.col("day").cast("string"))


def low_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _user_day_scores(_day_events(spark, sf_dir))
    streaks = crossview.low_streaks(
        scores, ["user_id"], period="day", score="completeness_score",
        below=LOW_DAY_SCORE, index=F.unix_date("day"))
    return _rounded(streaks, "avg_streak_completeness").withColumns({
        c: F.col(c).cast("string") for c in ("streak_start_period", "streak_end_period")})


# Trends, rates, ranks, anomalies


def _segment_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["c_nationkey", "c_mktsegment"]
    orders = _orders_of_customers(spark, sf_dir).withColumn("month", _month("o_orderdate"))
    totals = trends.period_totals(orders, keys, "month", _cents("o_totalprice"))
    return _as_period(totals).withColumn("monthly_value", F.col("monthly_value") / 100)


def period_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = trends.period_change(_segment_months(spark, sf_dir), ["c_nationkey", "c_mktsegment"], "period")
    return _rounded(changed, "mom_percent_change")


def period_change_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = trends.period_change(
        _segment_months(spark, sf_dir), ["c_nationkey", "c_mktsegment"], "period", calendar=True)
    return _rounded(changed, "mom_percent_change")


def _supplier_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").withColumn("month", _month("l_shipdate"))
    totals = trends.period_totals(lines, ["l_suppkey"], "month", _cents("l_extendedprice"))
    return _as_period(totals).withColumn("monthly_value", F.col("monthly_value") / 100)


def rolling_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = trends.rolling_mean(_supplier_months(spark, sf_dir), ["l_suppkey"], "period")
    return _rounded(rolled, "rolling_3_month_avg")


def rolling_mean_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = trends.rolling_mean(
        _supplier_months(spark, sf_dir), ["l_suppkey"], "period", min_periods=3, calendar=True)
    return _rounded(rolled, "rolling_3_month_avg")


def reporting_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation")
    orders = _orders_of_customers(spark, sf_dir)
    finished = orders.join(nation, orders["c_nationkey"] == nation["n_nationkey"]).select(
        "n_name", _month("o_orderdate").alias("month"), "c_custkey",
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderstatus")).alias("finished"))
    rates = facilities.reporting_rate(finished, "n_name", "month", "c_custkey", "finished")
    return _rounded(_as_period(rates), "reporting_rate")


def reporting_rate_null_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources with a long document, per quality label and language; unlabelled is a group too."""
    documents = _labelled_documents(spark, sf_dir).withColumns({
        "quality": F.col("quality").cast("long"),
        "long_text": F.when(F.col("n_chars") > 2000, F.col("n_chars")),
    })
    rates = facilities.reporting_rate(
        documents, "quality", "lang", "source", "long_text", keep_null_group=True)
    return _rounded(rates, "reporting_rate")


def top_underreporting(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders_of_customers(spark, sf_dir).select(
        "c_mktsegment", "c_custkey", _month("o_orderdate").alias("month"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("finished_price"))
    return facilities.top_underreporting(orders, "c_mktsegment", ["c_custkey"], "month", "finished_price")


def _event_anomalies(
    spark: SparkSession, sf_dir: str, exclude_current: bool, split: HotKeySplit | HotKeyRanges | None = None
) -> DataFrame:
    """Five event types share all events, so each type is cut, by default into ranges of whole seconds."""
    events = _table(spark, sf_dir, "events").select("event_type", "ts", "event_id", "value")
    day = F.unix_date(F.col("ts").cast("date")).cast("long")
    second = ((day * 24 + F.hour("ts")) * 60 + F.minute("ts")) * 60 + F.second("ts")
    found = facilities.rolling_anomalies(
        events, ["event_type"], ["ts", "event_id"], "value",
        exclude_current=exclude_current, split=split or HotKeyRanges(second))
    return _rounded(found.drop("ts"), "rolling_mean", "rolling_stddev", "z_score")


def rolling_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_anomalies(spark, sf_dir, exclude_current=False)


def rolling_anomalies_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_anomalies(spark, sf_dir, exclude_current=True)


def rolling_anomalies_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in many small ranges of the order, each with the rows at the end of those before it."""
    day = F.unix_date(F.col("ts").cast("date")).cast("long")
    minute = (day * 24 + F.hour("ts")) * 60 + F.minute("ts")
    return _event_anomalies(spark, sf_dir, exclude_current=False, split=HotKeyRanges(minute, rows_per_range=20))


def rolling_anomalies_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in many small chunks, whose bins go on below the minute: no minute has to fit a chunk."""
    day = F.unix_date(F.col("ts").cast("date")).cast("long")
    fine = F.struct(day.alias("day"), F.hour("ts").alias("hour"), F.minute("ts").alias("minute"), F.second("ts").alias("second"))
    return _event_anomalies(spark, sf_dir, exclude_current=False, split=HotKeySplit(fine, rows_per_chunk=300))


# Comparisons, governance, warehouse


def _segment_volumes(spark: SparkSession, sf_dir: str, additive: Column | None = None) -> DataFrame:
    """Volumes by segment and first day of the quarter, labelled after the sum."""
    orders = _orders_of_customers(spark, sf_dir).withColumn(
        "quarter_start", F.trunc(F.col("o_orderdate").cast("date"), "quarter"))
    summed = crossview.volumes(
        orders, ["c_mktsegment", "quarter_start"], _cents("o_totalprice"), additive=additive)
    return with_period_columns(_as_period(summed, "quarter_start")).select(
        "c_mktsegment", "quarter", (F.col("total_service_volume") / 100).alias("total_service_volume"))


def volumes_by_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segment_volumes(spark, sf_dir)


def volumes_additive_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volumes in which pending orders do not add up."""
    return _segment_volumes(spark, sf_dir, additive=F.col("o_orderstatus") != "P")


def coverage_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    priorities = crossview.distinct_values(orders, "o_orderpriority")
    return crossview.coverage_matrix(orders, "o_custkey", "o_orderpriority", priorities)


def document_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract_report(_labelled_documents(spark, sf_dir), DOCUMENT_CONTRACT)


def _priority_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's latest order priority before the snapshot date against that since."""
    orders = _table(spark, sf_dir, "orders")
    before = F.col("o_orderdate") < F.lit(SNAPSHOT_DATE).cast("timestamp_ntz")
    return snapshot_drift(
        orders.filter(~before), orders.filter(before), "o_custkey", "o_orderpriority",
        order=["o_orderdate", "o_orderkey"])


def priority_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _priority_drift(spark, sf_dir)


def priority_drift_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift_totals(_priority_drift(spark, sf_dir))


def _priority_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's priority with every order, until an order that is pending: then it has none."""
    return _table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), F.lit("priority").alias("attribute"), F.col("o_orderpriority").alias("value"),
        (F.col("o_orderstatus") != "P").alias("is_present"), F.col("o_orderdate").cast("date").alias("changed_at"))


def attribute_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    intervals = validity(_priority_log(spark, sf_dir))
    return intervals.withColumns({c: F.col(c).cast("string") for c in ("valid_from", "valid_to")})


def drift_between_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    since, until = (F.lit(d).cast("date") for d in ("1996-01-01", "1997-06-15"))
    return drift_between(validity(_priority_log(spark, sf_dir)), since, until)


def as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the priority that their customer had on the day of shipping."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("id"))
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("shipped"))
    rows = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select("l_orderkey", "l_linenumber", "id", "shipped")
    return attach_as_of(rows, validity(_priority_log(spark, sf_dir)), ["id"], "shipped", "priority", attribute="priority").select(
        "l_orderkey", "l_linenumber", "priority")


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", F.col("o_orderdate").cast("date").cast("string").alias("day"))


def new_days_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of days from which no finished order has been loaded."""
    orders = _dated_orders(spark, sf_dir)
    loaded = orders.filter(F.col("o_orderstatus") == "F")
    return new_periods_only(orders, loaded, period="day", loaded_period="day").drop("o_orderpriority")


def new_or_corrected_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, plus the days with an order entered after the last finished one."""
    orders = _dated_orders(spark, sf_dir)
    loaded = orders.filter(F.col("o_orderstatus") == "F")
    return new_periods_only(
        orders, loaded, period="day", loaded_period="day", updated="o_orderkey", reprocess_corrected=True,
    ).drop("o_orderpriority")


def new_or_corrected_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of months in which a customer's priority is not loaded, or was loaded from an older order only.

    Loaded are finished orders. An order's priority is missing where it is not specified.
    """
    orders, loaded = _grouped_orders(spark, sf_dir)
    return new_periods_only(
        orders, loaded, period="day", loaded_period="day", updated="o_orderkey", reprocess_corrected=True,
        key=["customer_group", "priority"])


def _grouped_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("priority"),
        (F.col("o_custkey") % 100).alias("customer_group"), F.col("o_orderdate").cast("date").cast("string").alias("day"))
    return orders, orders.filter((F.col("o_orderstatus") == "F") | (F.col("o_orderkey") % 3 > 0))


def differing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days whose offered orders are not the loaded ones, found by digests."""
    orders, loaded = _grouped_orders(spark, sf_dir)
    columns = ["o_orderkey", "customer_group", "priority"]
    return differing_periods(period_digests(orders, columns, "day"), period_digests(loaded, columns, "day"), "day")


def new_or_corrected_by_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``new_or_corrected_keys``, with only those days compared key by key whose digests differ."""
    orders, loaded = _grouped_orders(spark, sf_dir)
    days = query_workspace(spark).keep(differing_days(spark, sf_dir).select("day"), "days")
    return new_periods_only(
        orders.join(days, "day", "left_semi"), loaded.join(days, "day", "left_semi"), period="day", loaded_period="day",
        updated="o_orderkey", reprocess_corrected=True, key=["customer_group", "priority"])


def star_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    orders = _orders_of_customers(spark, sf_dir)
    joined = (
        orders.join(nation, orders["c_nationkey"] == nation["n_nationkey"], "left")
        .join(region, nation["n_regionkey"] == region["r_regionkey"], "left")
    )
    month = _month("o_orderdate")
    fact = project_fact(joined, {
        "o_orderkey": F.col("o_orderkey"),
        "org_unit_uid": F.col("c_custkey"),
        "facility_name": F.col("c_name"),
        "country_name": F.col("n_name"),
        "region_name": F.col("r_name"),
        "health_area": F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")),
        "year_month": period_of(month),
        "numeric_value": F.col("o_totalprice"),
        "share_of_balance": F.round(ratio(F.col("o_totalprice"), F.col("c_acctbal")), 6),
    })
    return fill_unknown(fact, "health_area")


def service_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facility job's fact, from raw observations to its contract columns.

    Order lines are observations: of a brand, in the month of shipping, by a customer, per return
    flag. Brands are indicators in areas by their first digit, regions are countries, nations
    are districts, and a region's program expects the brands that its suppliers ship.
    """
    orders = _table(spark, sf_dir, "orders")
    part = _table(spark, sf_dir, "part")
    lines = _table(spark, sf_dir, "lineitem")
    area = F.substring("p_brand", 1, 7)
    work = query_workspace(spark)
    observations = (
        lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        .join(part, lines["l_partkey"] == part["p_partkey"])
        .select(
            F.col("p_brand").alias("data_element_uid"),
            period_of(F.col("l_shipdate").cast("date")).alias("period"),
            F.concat(F.lit("C"), "o_custkey").alias("org_unit_uid"),
            F.col("l_returnflag").alias("category_option_combo_uid"),
            F.col("l_linestatus").alias("attribute_option_combo_uid"),
            F.col("l_quantity").cast("long").cast("string").alias("raw_value"),
            F.lower("o_orderpriority").alias("stored_by"),
            F.col("o_orderdate").alias("created_at"),
            F.col("l_shipdate").alias("last_updated_at"),
            F.col("o_orderstatus").alias("followup"),
        )
    )
    indicators = part.select(
        F.col("p_brand").alias("data_element_uid"), F.lower("p_brand").alias("data_element_name"),
        F.lit("INTEGER").alias("value_type"), area.alias("health_area"),
    ).distinct()
    flags = lines.filter("l_returnflag <> 'N'").select(
        F.col("l_returnflag").alias("category_option_combo_uid"),
        F.lower("l_returnflag").alias("category_option_combo_name"),
    ).distinct()
    hierarchy = flatten_tree(spark, sf_dir).select(
        F.col("id").alias("org_unit_uid"), F.col("name").alias("facility_name"),
        F.col("region_name").alias("country_name"), F.lit(None).cast("string").alias("region_name"),
        F.col("nation_name").alias("district_name"),
    )
    supplier, nation = _table(spark, sf_dir, "supplier"), _table(spark, sf_dir, "nation")
    region = _table(spark, sf_dir, "region")
    # Pairs first: they are as many as parts and suppliers meet, not as many as lines.
    pairs = lines.join(part, lines["l_partkey"] == part["p_partkey"]).select("p_brand", "l_suppkey").distinct()
    bridge = (
        pairs.join(supplier, pairs["l_suppkey"] == supplier["s_suppkey"])
        .join(nation, supplier["s_nationkey"] == nation["n_nationkey"])
        .join(region, nation["n_regionkey"] == region["r_regionkey"])
        .select(
            F.concat_ws("/", "r_name", area).alias("program_uid"), F.col("r_name").alias("program_name"),
            area.alias("program_health_area"), F.col("r_name").alias("program_country"),
            F.col("p_brand").alias("data_element_uid"),
        ).distinct()
    )
    # Used by the scores and by the fact: built once. Observations are read once, and so are not written.
    built = {"bridge": bridge, "indicators": indicators, "hierarchy": hierarchy}
    bridge, indicators, hierarchy = side_by_side(
        spark, *[lambda name=name, df=df: work.keep(df, name) for name, df in built.items()])
    enriched = facility.enrich(observations, indicators, flags, hierarchy, bridge)
    return facility.fact_service_delivery(enriched).withColumns({
        c: F.col(c).cast("date").cast("string") for c in ("created_at", "last_updated_at")
    })


def _over_tables(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(spark, lambda name: _table(spark, sf_dir, name))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{name: _over_tables(query) for name, query in {**export_queries.QUERIES, **fact_queries.QUERIES}.items()},
    "volumes_by_quarter": volumes_by_quarter,
    "volumes_additive_only": volumes_additive_only,
    "explode_records": explode_embeddings,
    "json_fields": json_fields,
    "validity_split": validity_split,
    "quarantined_rows": quarantined_rows,
    "quarantine_rate": quarantine_rate,
    "stage_counts": stage_counts,
    "period_columns": period_columns,
    "typed_values": typed_values,
    "late_flags": late_flags,
    "resolve_lookup": resolve_lookup,
    "unresolved_keys": unresolved_keys,
    "unresolved_flags": unresolved_flags,
    "flag_splits": flag_splits,
    "flatten_hierarchy": flatten_tree,
    "hierarchy_from_parents": hierarchy_from_parents,
    "tree_paths": tree_paths,
    "latest_by_key": latest_by_key,
    "unique_lookup": unique_parts,
    "program_bridge": program_bridge,
    "expected_counts": expected_items,
    "ambiguous_keys": ambiguous_items,
    "program_mapping": program_mapping,
    "completeness": user_day_completeness,
    "mean_score": mean_score,
    "mean_score_by_unit": mean_score_by_unit,
    "low_streaks": low_streaks,
    "period_change": period_change,
    "period_change_calendar": period_change_calendar,
    "rolling_mean": rolling_mean,
    "rolling_mean_calendar": rolling_mean_calendar,
    "reporting_rate": reporting_rate,
    "reporting_rate_null_group": reporting_rate_null_group,
    "top_underreporting": top_underreporting,
    "rolling_anomalies": rolling_anomalies,
    "rolling_anomalies_prior": rolling_anomalies_prior,
    "rolling_anomalies_chunks": rolling_anomalies_chunks,
    "rolling_anomalies_ranges": rolling_anomalies_ranges,
    "coverage_matrix": coverage_matrix,
    "contract_report": document_contract,
    "snapshot_drift": priority_drift,
    "drift_totals": priority_drift_totals,
    "new_periods_only": new_days_only,
    "new_or_corrected_periods": new_or_corrected_days,
    "new_or_corrected_keys": new_or_corrected_keys,
    "new_or_corrected_by_digest": new_or_corrected_by_digest,
    "differing_periods": differing_days,
    "attribute_validity": attribute_validity,
    "drift_between_runs": drift_between_runs,
    "as_of_join": as_of_join,
    "star_fact": star_fact,
    "service_fact": service_fact,
}
