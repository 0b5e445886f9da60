"""Edge cases on hand-written rows."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wardbook.functions.columns import join_null_safe
from wardbook.functions.periods import PERIOD_COLUMNS, is_period, period_dimension, with_period_columns
from wardbook.functions.values import with_quality_flags, with_typed_values
from wardbook.operators import completeness as scoring
from wardbook.operators import crossview, facilities, trends
from wardbook.operators.drift import drift_totals, snapshot_drift
from wardbook.operators.hierarchy import flatten_hierarchy
from wardbook.operators.incremental import new_periods_only
from wardbook.operators.latest import latest_by, unique_lookup
from wardbook.operators.resolve import flag_unresolved, resolve, unresolved
from wardbook.operators.star import ambiguous_keys, fill_unknown, restore_unknown
from wardbook.operators.validity import enforce_rate, split_valid, validity_summary, with_validity
from wardbook.sources import exports as ex


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# Exports


def test_export_without_records_gives_one_malformed_row(spark, tmp_path):
    path = tmp_path / "d.json"
    path.write_text('{"version": "1", "dataValues": []}\n{"version": "2"}\n{broken\n')
    flat = ex.flatten_data_values(ex.read_documents(spark, str(path), ex.DATA_VALUES_DOCUMENT))
    assert flat.count() == 3 and flat.dropna("all").count() == 0
    corrupt = ex.read_documents(spark, str(path), ex.DATA_VALUES_DOCUMENT, keep_corrupt=True)
    assert rows(ex.flatten_data_values(corrupt), ex.CORRUPT, "period") == [
        ("{broken", None), (None, None), (None, None)]


def test_unparsable_timestamp_and_empty_groups_are_null(spark, tmp_path):
    path = tmp_path / "d.json"
    path.write_text(json.dumps({"dataValues": [
        {"dataElement": "a", "lastUpdated": "soon", "created": "2024-01-02T03:04:05.000", "storedBy": "Ann.B"}]}))
    flat = ex.flatten_data_values(ex.read_documents(spark, str(path), ex.DATA_VALUES_DOCUMENT)).first()
    assert flat["last_updated_at"] is None and flat["created_at"] == datetime(2024, 1, 2, 3, 4, 5)
    assert flat["stored_by"] == "ann.b"
    path.write_text(json.dumps({"dataElements": [
        {"id": "a", "dataElementGroups": []}, {"id": "b", "dataElementGroups": [{"name": "X"}, {"name": "Y"}]}]}))
    indicators = ex.flatten_indicators(ex.read_documents(spark, str(path), ex.METADATA_DOCUMENT))
    assert rows(indicators, "data_element_uid", "health_area") == [("a", None), ("b", "X")]


# Validity


def test_split_is_disjoint_and_complete(spark):
    periods = ["202401", "20241", None, "2024-1", "202413"]
    df = spark.createDataFrame([("u", p) for p in periods] + [(None, "202401")], "uid string, period string")
    valid, malformed = split_valid(with_validity(df, ["uid"], "period"))
    assert rows(valid, "uid", "period") == [("u", "202401"), ("u", "202413")]
    assert valid.unionByName(malformed).exceptAll(df).isEmpty() and valid.count() + malformed.count() == 6
    strict, _ = split_valid(with_validity(df, ["uid"], "period", strict=True))
    assert rows(strict, "period") == [("202401",)]
    assert enforce_rate(validity_summary(with_validity(df, ["uid"], "period")), 0.9)["malformed_rows"] == 4


def test_rate_of_no_rows_is_one(spark):
    empty = with_validity(spark.createDataFrame([], "uid string, period string"), ["uid"], "period")
    assert validity_summary(empty).first()["quarantine_rate"] == 1.0


# Periods and values


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_period_columns_in_either_ansi_mode(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = with_period_columns(spark.createDataFrame([("202402",), ("202413",), ("abc",)], "period string"))
        got = {r["period"]: tuple(r[c] for c in PERIOD_COLUMNS[2:]) for r in df.collect()}
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert got["202402"] == (2024, 2, "2024Q1", date(2024, 2, 1), date(2024, 2, 29))
    assert got["202413"] == (2024, 13, None, None, None)
    assert got["abc"] == (None, None, None, None, None)


def test_period_dimension_is_distinct(spark):
    df = spark.createDataFrame([("202402",), ("202402",), ("202312",)], "period string")
    assert rows(period_dimension(df), "period", "quarter") == [("202312", "2023Q4"), ("202402", "2024Q1")]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_typed_values_and_flags(spark, ansi):
    end = date(2024, 1, 31)
    df = spark.createDataFrame([
        ("n", "NUMBER", "abc", datetime(2024, 3, 31)),
        ("z", "INTEGER", "0", datetime(2024, 4, 1)),
        ("d", "PERCENTAGE", "0.0", None),
        ("b", "BOOLEAN", "true", datetime(2024, 1, 1)),
        ("t", "TRUE_ONLY", "true", datetime(2024, 1, 1)),
        ("u", None, "7", datetime(2024, 1, 1)),
        ("m", "INTEGER", None, datetime(2024, 1, 1)),
    ], "id string, value_type string, raw_value string, last_updated_at timestamp").withColumn(
        "period_end_date", F.lit(end))
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        got = {r["id"]: r for r in with_quality_flags(with_typed_values(df)).collect()}
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert {k: r["numeric_value"] for k, r in got.items()} == {
        "n": None, "z": 0.0, "d": 0.0, "b": None, "t": None, "u": None, "m": None}
    assert {k for k, r in got.items() if r["boolean_value"]} == {"b"}
    assert (got["z"]["is_explicit_zero"], got["d"]["is_explicit_zero"], got["m"]["is_explicit_zero"]) == (True, False, None)
    assert [k for k, r in got.items() if r["is_missing_value"]] == ["m"]
    assert (got["n"]["is_late_reported"], got["z"]["is_late_reported"], got["d"]["is_late_reported"]) == (False, True, None)


# Lookups


def test_latest_by_is_deterministic_and_unique(spark):
    data = [
        ("k1", 1, "old"), ("k1", 3, "new"), ("k1", None, "undated"),
        ("k2", 5, "b"), ("k2", 5, "c"), ("k2", 5, "a"), (None, 1, "x"), (None, 2, "y"),
    ]
    for partitions in (1, 3, 7):
        df = spark.createDataFrame(data, "k string, at int, v string").repartition(partitions)
        assert rows(latest_by(df, ["k"], ["at"]), "k", "v") == [("k1", "new"), ("k2", "c"), (None, "y")]


def test_latest_by_breaks_ties_on_arrays_and_skips_maps(spark):
    df = spark.createDataFrame([("k", [1], {"a": 1}), ("k", [2], {"a": 1})], "k string, a array<int>, m map<string,int>")
    assert unique_lookup(df, ["k"]).first()["a"] == [2]


def test_resolved_and_unresolved_make_up_the_input(spark):
    df = spark.createDataFrame([("a", 1), ("x", 2), (None, 3)], "k string, v int")
    lookup = spark.createDataFrame([("a", "A"), ("b", "B")], "k string, name string")
    assert rows(resolve(df, lookup, ["k"]), "k", "name") == [("a", "A"), ("x", None), (None, None)]
    assert rows(unresolved(df, lookup, ["k"]), "v") == [(2,), (3,)]
    numbers = spark.createDataFrame([(1,), (2,)], "v int")
    flagged = flag_unresolved(df, {"bad_k": (lookup, ["k"]), "bad_v": (numbers, ["v"])})
    assert rows(flagged, "k", "v", "bad_k", "bad_v") == [
        ("a", 1, False, False), ("x", 2, True, False), (None, 3, True, True)]


def test_join_null_safe_of_a_frame_with_its_own_aggregate(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int")
    sums = df.groupBy("k").agg(F.sum("v").alias("s"))
    assert rows(join_null_safe(df, sums, ["k"]), "k", "v", "s") == [("a", 1, 3), ("a", 2, 3), (None, 3, 3)]


def test_hierarchies_of_several_depths(spark):
    nodes = spark.createDataFrame([
        ("c", "Country", 1, "/c"), ("r", "Region", 2, "/c/r"), ("d", "District", 3, "/c/r/d"),
        ("f", "Clinic", 4, "/c/r/d/f"), ("p", "Post", 5, "/c/r/d/f/p"),
        ("g", "Orphan", 4, "/c/gone/lost/g"), ("h", "Lost", 4, "/gone/lost"), ("i", "No path", 4, None),
    ], "id string, name string, level int, path string")
    names = {1: "country", 2: "region", 3: "district"}
    got = rows(flatten_hierarchy(nodes, 4, names), "id", "name", "country", "region", "district")
    assert got == [("f", "Clinic", "Country", "Region", "District"), ("g", "Orphan", "Country", None, None)]
    assert flatten_hierarchy(nodes, 4, names).columns == ["id", "name", "level", "country", "region", "district"]
    assert rows(flatten_hierarchy(nodes, 3, {1: "country", 2: "region"}), "id", "country", "region") == [
        ("d", "Country", "Region")]
    assert rows(flatten_hierarchy(nodes, 5, {**names, 4: "clinic"}), "id", "clinic", "country") == [
        ("p", "Clinic", "Country")]


def test_bridge_that_multiplies_rows_is_reported(spark):
    bridge = spark.createDataFrame([("p1", "de", "X"), ("p2", "de", "X"), ("p3", "de", "Y"), ("p4", "de", None)],
                                   "program string, item string, country string")
    assert rows(ambiguous_keys(bridge, ["item", "country"]), "item", "country", "rows") == [("de", "X", 2)]


# Completeness


def test_completeness_of_null_groups_and_missing_values(spark):
    df = spark.createDataFrame([
        ("X", "u1", "a", "1"), ("X", "u1", "a", "2"), ("X", "u1", "b", None), ("X", "u1", None, "3"),
        (None, "u2", "a", "1"), ("Z", "u3", "a", "1"),
    ], "area string, unit string, item string, value string")
    expected = scoring.expected_counts(
        spark.createDataFrame([("X", i) for i in "abcd"] + [("Z", None)], "area string, item string"), ["area"], "item")
    reported = scoring.reported_counts(df, ["area", "unit"], "item", resolved="item")
    scores = scoring.completeness(reported, expected, ["area"])
    assert rows(scores, "area", "unit", "completeness_score") == [("X", "u1", 0.5), ("Z", "u3", None), (None, "u2", None)]
    strict = scoring.reported_counts(df, ["area", "unit"], "item", resolved="item", require_value="value")
    assert rows(scoring.completeness(strict, expected, ["area"]).filter("area = 'X'"), "completeness_score") == [(0.25,)]
    attached = scoring.attach(df, scores, ["area", "unit"])
    assert attached.count() == df.count()
    assert attached.filter("area is null").first()["completeness_score"] is None


def test_mean_score_weighs_rows_or_units(spark):
    df = spark.createDataFrame([("X", "u1", 1.0)] * 3 + [("X", "u2", 0.0)], "area string, unit string, completeness_score double")
    assert scoring.mean_score(df, ["area"]).first()[1] == 0.75
    assert scoring.mean_score(df, ["area"], unit=["unit"]).first()[1] == 0.5
    counted = df.withColumn("completeness_score", F.nullif("completeness_score", F.lit(7.0))).groupBy(
        "area", "unit", "completeness_score").count().unionByName(
        spark.createDataFrame([("X", "u3", None, 9), ("Y", "u4", None, 9)], "area string, unit string, completeness_score double, count long"))
    assert [tuple(r) for r in scoring.mean_score(counted, ["area"], weight="count").collect()] == [("X", 0.75), ("Y", None)]


# Trends


def test_change_over_rows_and_over_calendar_months(spark):
    totals = spark.createDataFrame([("k", "202401", 10.0), ("k", "202402", 15.0), ("k", "202404", 30.0), ("j", "202401", 0.0), ("j", "202402", 5.0)],
                                   "k string, period string, monthly_value double")
    change = trends.period_change(totals, ["k"], "period")
    columns = ["k", "period", "previous_month_value", "mom_percent_change"]
    assert rows(change, *columns) == [
        ("j", "202401", None, None), ("j", "202402", 0.0, None),
        ("k", "202401", None, None), ("k", "202402", 10.0, 50.0), ("k", "202404", 15.0, 100.0)]
    calendar = trends.period_change(totals, ["k"], "period", calendar=True)
    assert rows(calendar.filter("period = '202404'"), *columns) == [("k", "202404", None, None)]


def test_calendar_month_before_january_is_december(spark):
    totals = spark.createDataFrame([("k", "202312", 10.0), ("k", "202401", 15.0)], "k string, period string, monthly_value double")
    got = trends.period_change(totals, ["k"], "period", calendar=True)
    assert rows(got, "period", "previous_month_value") == [("202312", None), ("202401", 10.0)]


def test_rolling_mean_options(spark):
    totals = spark.createDataFrame([("k", "202401", 3.0), ("k", "202402", None), ("k", "202403", 6.0), ("k", "202406", 9.0)],
                                   "k string, period string, monthly_value double")

    def means(**options):
        return [r[1] for r in rows(trends.rolling_mean(totals, ["k"], "period", **options), "period", "rolling_3_month_avg")]

    assert means() == [3.0, 3.0, 4.5, 7.5]
    assert means(min_periods=2) == [None, None, 4.5, 7.5]
    assert means(calendar=True) == [3.0, 3.0, 4.5, 9.0]


# Facilities


def test_reporting_rate_options(spark):
    fact = spark.createDataFrame([
        ("X", "202401", "f1", "1"), ("X", "202401", "f1", "2"), ("X", "202401", "f2", None), ("X", "202402", "f2", "3"),
        ("X", "202402", "f1", "3"), ("Y", "202401", "f9", None), (None, "202401", "f7", "1"),
    ], "country_name string, period string, org_unit_uid string, raw_value string")
    columns = ["country_name", "period", "expected_facilities", "reported_facilities", "reporting_rate"]
    assert rows(facilities.reporting_rate(fact), *columns) == [("X", "202401", 2, 1, 0.5), ("X", "202402", 2, 2, 1.0)]
    assert rows(facilities.reporting_rate(fact, keep_null_group=True).filter("country_name is null"), *columns) == [
        (None, "202401", 1, 1, 1.0)]
    register = spark.createDataFrame([("X", f"f{i}") for i in range(4)], "country_name string, org_unit_uid string")
    assert rows(facilities.reporting_rate(fact, expected_units=register), *columns)[0] == ("X", "202401", 4, 1, 0.25)


def test_six_tied_facilities_all_rank_first(spark):
    fact = spark.createDataFrame(
        [("HIV", "X", f"n{i}", f"f{i}", p, v) for i in range(6) for p, v in (("202401", 0.0), ("202402", None))]
        + [("HIV", "X", "n7", "f7", "202401", 1.0), (None, None, None, "f8", "202401", None)],
        "health_area string, country_name string, facility_name string, org_unit_uid string, period string, numeric_value double")
    got = rows(facilities.top_underreporting(fact), "health_area", "org_unit_uid", "zero_data_periods", "rank")
    assert got == [("HIV", f"f{i}", 2, 1) for i in range(6)] + [(None, "f8", 1, 1)]
    assert facilities.top_underreporting(fact, top=7).count() == 8


@pytest.mark.parametrize("n, flagged", [(10, 0), (11, 1), (12, 1)])
def test_anomaly_needs_eleven_values(spark, n, flagged):
    df = spark.createDataFrame([("k", i, 1000.0 if i == n - 1 else 1.0) for i in range(n)], "k string, at int, numeric_value double")
    found = facilities.rolling_anomalies(df, ["k"], ["at"])
    assert found.count() == flagged
    if flagged:
        assert found.first()["z_score"] == pytest.approx((n - 1) / n**0.5)


def test_anomaly_against_prior_rows_only(spark):
    values = [1.0, 2.0, 1.0, 2.0, 50.0]
    df = spark.createDataFrame([("k", i, v) for i, v in enumerate(values)], "k string, at int, numeric_value double")
    assert facilities.rolling_anomalies(df, ["k"], ["at"]).count() == 0
    assert rows(facilities.rolling_anomalies(df, ["k"], ["at"], exclude_current=True), "at") == [(4,)]


# Comparisons


def test_streak_over_the_year_end(spark):
    low = ["202311", "202312", "202401", "202402", "202405"]
    df = spark.createDataFrame([("X", p, 0.5) for p in low] + [("X", "202403", 0.8), ("X", "202404", None)],
                               "area string, period string, avg_completeness_score double")
    got = rows(crossview.low_streaks(df, ["area"]), "area", "consecutive_low_periods", "streak_start_period", "streak_end_period", "avg_streak_completeness")
    assert got == [("X", 4, "202311", "202402", 0.5)]


def test_volumes_sort_and_additive(spark):
    df = spark.createDataFrame([("b", 1.0, "SUM"), ("a", 2.0, "SUM"), ("a", 3.0, "AVERAGE"), ("c", None, "SUM")],
                               "area string, numeric_value double, how string")
    assert [tuple(r) for r in crossview.volumes(df, ["area"]).collect()] == [("a", 5.0), ("b", 1.0), ("c", None)]
    assert crossview.volumes(df, ["area"], additive=F.col("how") == "SUM").first()[1] == 2.0


def test_coverage_matrix_with_null_row_and_column(spark):
    df = spark.createDataFrame([("Cases", "X"), ("Cases", None), (None, "Y")], "item string, country string")
    values = crossview.distinct_values(df, "country")
    assert values == [None, "X", "Y"]
    matrix = crossview.coverage_matrix(df, "item", "country", values)
    assert matrix.columns == ["item", "null", "X", "Y"]
    assert rows(matrix, "*") == [("Cases", 1, 1, 0), (None, 0, 0, 1)]
    clash = df.unionByName(spark.createDataFrame([(None, "null")], df.schema))
    matrix = crossview.coverage_matrix(clash, "item", "country", crossview.distinct_values(clash, "country"))
    assert matrix.columns == ["item", "null_", "X", "Y", "null"]
    assert rows(matrix, "*") == [("Cases", 1, 1, 0, 0), (None, 0, 0, 1, 1)]
    assert crossview.coverage_pairs(df, "item", "country").count() == 3


def test_unknown_is_told_from_a_value_of_that_name(spark):
    areas = ["HIV", None, "Unknown", "Unknown_", "Unknowns", ""]
    df = spark.createDataFrame([(a,) for a in areas], "area string")
    stored = fill_unknown(df, "area")
    assert [r[0] for r in stored.collect()] == ["HIV", "Unknown", "Unknown_", "Unknown__", "Unknowns", ""]
    assert [r[0] for r in restore_unknown(stored, "area").collect()] == areas


# Drift and incremental


def test_drift_dedupes_and_finds_nothing_against_itself(spark):
    a = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", None)], "id string, name string")
    assert snapshot_drift(a, a, "id", "name").isEmpty()
    assert snapshot_drift(a, a.unionByName(spark.createDataFrame([(None, "z")], a.schema)), "id", "name").isEmpty()
    b = spark.createDataFrame([("1", "b"), ("2", "x"), ("3", "c")], "id string, name string")
    drift = snapshot_drift(b, a, "id", "name")
    assert rows(drift, "id", "change", "old_name", "new_name") == [("2", "renamed", None, "x"), ("3", "added", None, "c")]
    assert tuple(drift_totals(drift).first()) == (1, 0, 1)
    assert tuple(drift_totals(snapshot_drift(a, a, "id", "name")).first()) == (0, 0, 0)


def test_new_periods(spark):
    df = spark.createDataFrame([("202401", 1), ("202402", 1), ("202402", 9), ("202403", None), (None, 1)], "period string, last_updated_at int")
    loaded = spark.createDataFrame([("202401", 5), ("202402", 5), ("202402", 3)], "year_month string, last_updated_at int")
    assert rows(new_periods_only(df, loaded), "period") == [("202403",)]
    assert rows(new_periods_only(df, loaded, reprocess_corrected=True), "period", "last_updated_at") == [
        ("202402", 1), ("202402", 9), ("202403", None)]


def test_late_reports_reload_their_period_whatever_their_stamp(spark):
    df = spark.createDataFrame([("202401", "a", 5), ("202401", "b", 1), ("202402", None, 2), ("202403", "a", 1)],
                               "period string, k string, last_updated_at int")
    loaded = spark.createDataFrame([("202401", "a", 5), ("202402", None, 2), ("202403", "a", None)],
                                   "year_month string, k string, last_updated_at int")
    assert rows(new_periods_only(df, loaded, reprocess_corrected=True, key=["k"]), "period", "k") == [
        ("202401", "a"), ("202401", "b"), ("202403", "a")]


def test_periods_reject_trailing_text(spark):
    df = spark.createDataFrame([("202401x",), ("x202401",), ("２０２４０１",)], "p string")
    assert df.filter(is_period(F.col("p"))).isEmpty()
