"""Plans: where Spark shuffles, broadcasts, prunes, and folds rows before a shuffle."""

import os

import pytest
from pyspark.sql import functions as F

from wardbook.operators import crossview, facilities
from wardbook.operators.contract import ColumnSpec, contract_report
from wardbook.operators.drift import snapshot_drift
from wardbook.operators.incremental import new_periods_only
from wardbook.operators.latest import latest_by
from wardbook.operators.resolve import HeavyKeys, resolve, unresolved
from wardbook.operators.trailing import HotKeyRanges, HotKeySplit
from wardbook.sources.tables import write_partitioned
from wardbook.plans import driver_tables, facility

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture
def plan(capsys):
    def explain(df, mode="simple"):
        capsys.readouterr()
        df.explain(mode)
        return capsys.readouterr().out
    return explain


@pytest.fixture(scope="module")
def facts(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("facts") / "t")
    (spark.range(2000).selectExpr(
        "id", "cast(id % 7 as string) k", "cast(id % 5 as string) unit", "cast(202401 + id % 6 as string) period",
        "cast(id as double) value", "repeat('x', 50) payload")
     .write.parquet(path))
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def lookup(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lookup") / "t")
    spark.range(7).selectExpr("cast(id as string) k", "concat('n', id) name").write.parquet(path)
    return spark.read.parquet(path)


def test_small_lookups_are_broadcast_without_a_hint(plan, facts, lookup):
    for df in (resolve(facts, lookup, ["k"]), unresolved(facts, lookup, ["k"])):
        text = plan(df)
        assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_big_lookups_are_not_broadcast(spark, plan, facts, lookup):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        text = plan(resolve(facts, lookup, ["k"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "BroadcastExchange" not in text


@pytest.fixture
def bare_shuffles(spark):
    """Neither broadcasts by size nor splitting of skewed joins."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = [spark.conf.get(n) for n in names]
    for name, value in zip(names, ("-1", "false")):
        spark.conf.set(name, value)
    yield
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def rows_per_task(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect())


def test_rows_without_a_key_do_not_meet_in_one_task(spark, bare_shuffles):
    rows = spark.range(8000).selectExpr("id", "case when id % 5 = 0 then cast(id % 40 as string) end k")
    names = spark.range(40).selectExpr("cast(id as string) k", "id * 10 as name")
    plain, spread = resolve(rows, names, ["k"]), resolve(rows, names, ["k"], spread=["id"])
    assert sorted(plain.collect(), key=str) == sorted(spread.select(plain.columns).collect(), key=str)
    assert rows_per_task(plain)[-1] >= 6400 and rows_per_task(spread)[-1] < 2500


def test_heavy_keys_are_dealt_to_several_tasks(spark, plan, bare_shuffles):
    rows = spark.range(8000).selectExpr(
        "id", "case when id % 10 = 0 then null when id % 3 > 0 then 'hot' else cast(id % 41 as string) end k")
    names = spark.range(40).selectExpr("cast(id as string) k", "id * 10 as name").union(spark.sql("SELECT 'hot', -1"))
    plain, dealt = resolve(rows, names, ["k"]), resolve(rows, names, ["k"], spread=["id"], heavy=HeavyKeys(200, 3))
    assert sorted(plain.collect(), key=str) == sorted(dealt.select(plain.columns).collect(), key=str)
    assert rows_per_task(plain)[-1] >= 4500 and rows_per_task(dealt)[-1] < 1800
    text = plan(dealt)
    assert "BroadcastHashJoin" in text and "TakeOrderedAndProject" in text


def test_hot_and_null_keys_of_a_shuffled_join_are_split(spark, plan, tmp_path):
    spark.range(300_000).selectExpr(
        "case id % 3 when 0 then 'hot' when 1 then null else cast(id as string) end k", "id", "uuid() text"
    ).repartition(8).write.parquet(str(tmp_path / "rows"))
    spark.range(300_000).selectExpr("if(id = 0, 'hot', cast(id as string)) k", "id * 2 twice", "uuid() name").write.parquet(
        str(tmp_path / "lookup"))
    rows, register = (spark.read.parquet(str(tmp_path / n)) for n in ("rows", "lookup"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
    }
    for name, setting in settings.items():
        spark.conf.set(name, setting)
    try:
        joined = resolve(rows, register, ["k"])
        joined.write.parquet(str(tmp_path / "out"))
        joined.collect()
        assert "skew=true" in plan(joined)
        missing = unresolved(rows, register, ["k"])
        missing.collect()
        assert "skew=true" in plan(missing)
    finally:
        for name in settings:
            spark.conf.unset(name)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 300_000 and out.filter("k = 'hot' and twice = 0").count() == 100_000
    assert missing.count() == 100_000


def test_latest_keeps_one_row_per_key_before_the_shuffle(plan, facts):
    text = plan(latest_by(facts, ["k"], ["value"]))
    partial, exchange = text.index("row_number(), 1, Partial"), text.index("Exchange hashpartitioning")
    assert text.index("row_number(), 1, Final") < exchange < partial
    assert text.count("Exchange") == 1


def test_reporting_rate_shuffles_rows_once(plan, facts):
    df = facilities.reporting_rate(facts, "k", "period", "unit", "value")
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_ranks_do_not_gather_an_area(plan, facts):
    text = plan(facilities.top_underreporting(facts, "k", ["unit"], "period", "value"))
    assert text.count("Window [sum(__units") == 1 and "rank(" not in text


def test_hot_keys_are_shuffled_by_chunk(plan, facts):
    df = facilities.rolling_anomalies(facts, ["k"], ["id"], "value", split=HotKeySplit(F.expr("id div 10"), 100))
    text = plan(df.select("id", "value", "z_score"))
    assert "BroadcastHashJoin" in text
    assert text.count("Exchange hashpartitioning") == 3  # bin counts, running counts, the rows once


def test_ranges_of_hot_keys_shuffle_rows_once(spark, facts):
    df = facilities.rolling_anomalies(facts, ["k"], ["id"], "value", split=HotKeyRanges(F.col("id"), 100))
    df.write.format("noop").mode("overwrite").save()
    df = df.select("id", "value", "z_score")
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # The rows, which the ends of ranges reuse; counts by key; ends by key, and dealt like the rows.
    assert final.count("Exchange hashpartitioning") - final.count("ReusedExchange") == 4 and "ReusedExchange" in final
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final


def test_coverage_matrix_needs_one_shuffle(plan, facts):
    assert plan(crossview.coverage_matrix(facts, "unit", "k", ["0", "1", None])).count("Exchange") == 1


def test_contract_is_one_pass_over_required_columns(plan, facts):
    text = plan(contract_report(facts, [ColumnSpec("k", "string", False), ColumnSpec("value", "double", False),
                                        ColumnSpec("payload", "string")]), "formatted")
    assert text.count("Scan parquet") == 2  # the tree line and its details
    assert "ReadSchema: struct<k:string,value:double>" in text


def test_drift_joins_on_the_partitioning_it_has(plan, facts):
    text = plan(snapshot_drift(facts, facts.filter("id > 5"), "id", "k"))
    assert "FullOuter" in text and text.count("Exchange hashpartitioning") == 2


def test_loaded_periods_are_skipped_without_shuffling_the_export(plan, facts):
    loaded = facts.filter("period < '202403'").select(F.col("period").alias("year_month"))
    text = plan(new_periods_only(facts, loaded))
    assert "LeftAnti" in text and "BroadcastHashJoin" in text
    assert text.count("Exchange hashpartitioning") == 1  # the distinct periods


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not there")
def test_mean_scores_read_and_shuffle_events_once_per_step(spark, plan):
    text = plan(driver_tables.mean_score(spark, SF_DIR))
    assert text.count("events.parquet") == 1 and "BroadcastHashJoin" in text
    # The last one is of a row per day and expected count and task.
    assert text.count("Exchange hashpartitioning") <= 4


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not there")
def test_stage_counts_scan_each_table_once(spark, plan):
    text = plan(driver_tables.stage_counts(spark, SF_DIR))
    assert [text.count(f"{t}.parquet") for t in ("orders", "documents", "labels")] == [1, 1, 1]


def test_analytics_read_the_columns_they_need(spark, plan, tmp_path):
    columns = ", ".join(f"cast(null as {t}) {n}" for n, t in _fact_types())
    table = facility.fact_table(spark, str(tmp_path / "fact"))
    write_partitioned(
        spark.sql(f"select {columns}").fillna({"health_area": "A", "year_month": "202401"}),
        table.folder("a"), facility.FACT_PARTITIONS)
    table.publish(table.current().after("a", ["202401"], keep=False))
    fact = facility.read_fact(spark, table.path)
    text = plan(facility.global_volumes_by_quarter(fact), "formatted")
    assert "ReadSchema: struct<quarter:string,numeric_value:double>" in text
    text = plan(fact.filter("year_month = '202401'").select("raw_value"), "formatted")
    assert "PartitionFilters" in text and "ReadSchema: struct<raw_value:string>" in text


def _fact_types():
    aliases = {"integer": "int", "long": "bigint"}
    return [(c.name, aliases.get(c.type, c.type)) for c in facility.FACT_CONTRACT]


def test_partitioned_writes_split_a_partition_that_holds_most_rows(spark, tmp_path):
    rows = spark.range(400_000).selectExpr(
        "if(id % 10 < 9, 'hot', 'cold') area", "'202401' month", "id", "uuid() text")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        write_partitioned(rows, str(tmp_path / "t"), ["area", "month"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = lambda area: len(list((tmp_path / "t" / f"area={area}" / "month=202401").glob("*.parquet")))
    assert files("hot") > 1 and files("cold") <= 2
    assert spark.read.parquet(str(tmp_path / "t")).count() == 400_000


def test_scores_of_the_fact_need_no_second_pass(spark):
    """Scores counted within the rows equal those that are computed apart and joined; observations are read once."""
    seen = [
        (de, f"2024{month:02d}", f"u{unit}", combo, str(month + unit), "2024-02-01", "2024-02-02")
        for de in ("a", "b", "c", "unknown") for month in (1, 2) for unit in range(4) for combo in ("x", None)
        if (month + unit + ord(de[0])) % 3
    ]
    seen += seen[:5] + [("a", None, "u1", "x", "5", None, None), ("b", "202401", None, "x", "5", None, None)]
    observations = spark.createDataFrame(
        seen, "data_element_uid string, period string, org_unit_uid string, category_option_combo_uid string, raw_value string,"
        " created_at string, last_updated_at string").withColumn("attribute_option_combo_uid", F.lit("z"))
    observations = observations.withColumns({c: F.to_timestamp(c) for c in ("created_at", "last_updated_at")}).withColumn("stored_by", F.lit("s"))
    indicators = spark.createDataFrame(
        [("a", "A", "INTEGER", "one"), ("b", "B", "INTEGER", "one"), ("c", "C", "NUMBER", None)],
        "data_element_uid string, data_element_name string, value_type string, health_area string")
    combos = spark.createDataFrame([("x", "X")], "category_option_combo_uid string, category_option_combo_name string")
    hierarchy = spark.createDataFrame(
        [("u0", "U0", "d", "r", "Alpha"), ("u1", "U1", "d", "r", "Alpha"), ("u2", "U2", "d", "r", None)],
        "org_unit_uid string, facility_name string, district_name string, region_name string, country_name string")
    bridge = spark.createDataFrame(
        [("p", "P", "one", "Alpha", "a"), ("p", "P", "one", "Alpha", "b")],
        "program_uid string, program_name string, program_health_area string, program_country string, data_element_uid string")
    tables = (observations, indicators, combos, hierarchy, bridge)
    scores = facility.completeness(facility.name_reports(observations, indicators, hierarchy), bridge)
    columns = facility.FACT_COLUMNS
    joined = facility.enrich(*tables, scores).select(*columns)
    within = facility.enrich(*tables).select(*columns)
    assert sorted(map(repr, within.collect())) == sorted(map(repr, joined.collect()))
    assert within.filter("completeness_score = 1").count() and within.filter("completeness_score IS NULL").count()
    text = driver_tables.service_fact(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation [l_orderkey") <= 2  # observations and flags
    assert "collect_set" in text
