"""The operators bound to the health-facility schema."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardbook.functions.periods import with_period_columns
from wardbook.functions.values import with_quality_flags, with_typed_values
from wardbook.operators import completeness as scoring
from wardbook.operators import crossview, facilities, trends
from wardbook.operators.contract import TYPE_ALIASES, ColumnSpec
from wardbook.operators.hierarchy import flatten_hierarchy, paths_from_parents
from wardbook.operators.latest import latest_by
from wardbook.operators.resolve import resolve
from wardbook.operators.star import project_fact, restore_unknown
from wardbook.operators.validity import with_validity
from wardbook.sources.tables import Workspace
from wardbook.sources.versions import Version, VersionedTable

# Levels of the organisation tree, the key of an observation, what has an expected count and
# what has a score, the aggregation type of values that add up, the counts a score is the quotient of, the fact's columns with
# their contract types, and the output columns of the anomaly table.
LEAF_LEVEL = 4
LEVEL_NAMES = {1: "country_name", 2: "region_name", 3: "district_name"}
OBSERVATION_KEY = ["data_element_uid", "period", "org_unit_uid", "category_option_combo_uid"]
SCORE_GROUP = ["country_name", "health_area"]
SCORE_UNIT = ["org_unit_uid", "period", *SCORE_GROUP]
ADDITIVE_TYPE = "SUM"
FACT_PARTITIONS = ["health_area", "year_month"]
SCORE_COUNTS = ("reported_indicator_count", "expected_indicator_count")
FACT_CONTRACT = [
    ColumnSpec("data_element_uid", "string", nullable=False),
    ColumnSpec("data_element_name", "string"),
    ColumnSpec("category_option_combo_uid", "string"),
    ColumnSpec("category_option_combo_name", "string"),
    ColumnSpec("program_uid", "string"),
    ColumnSpec("program_name", "string"),
    ColumnSpec("health_area", "string"),
    ColumnSpec("org_unit_uid", "string", nullable=False),
    ColumnSpec("facility_name", "string"),
    ColumnSpec("district_name", "string"),
    ColumnSpec("region_name", "string"),
    ColumnSpec("country_name", "string"),
    ColumnSpec("period", "string", nullable=False),
    ColumnSpec("year_month", "string", nullable=False),
    ColumnSpec("year", "integer"),
    ColumnSpec("month", "integer"),
    ColumnSpec("quarter", "string"),
    ColumnSpec("raw_value", "string"),
    ColumnSpec("numeric_value", "double"),
    ColumnSpec("boolean_value", "boolean"),
    ColumnSpec("stored_by", "string"),
    ColumnSpec("created_at", "timestamp"),
    ColumnSpec("last_updated_at", "timestamp"),
    ColumnSpec("is_explicit_zero", "boolean"),
    ColumnSpec("is_missing_value", "boolean"),
    ColumnSpec("is_late_reported", "boolean"),
    ColumnSpec("reported_indicator_count", "long"),
    ColumnSpec("expected_indicator_count", "long"),
    ColumnSpec("completeness_score", "double"),
]
FACT_COLUMNS = [spec.name for spec in FACT_CONTRACT]
ANOMALY_COLUMNS = [
    "country_name", "region_name", "district_name", "facility_name", "org_unit_uid",
    "data_element_name", "data_element_uid", "category_option_combo_name", "period",
    "numeric_value", "rolling_mean", "rolling_stddev", "z_score",
]


def flag_valid(observations: DataFrame, strict: bool = False) -> DataFrame:
    return with_validity(observations, ["data_element_uid", "org_unit_uid"], "period", strict)


def tree_from_parents(org_units: DataFrame, work: Workspace) -> DataFrame:
    """``org_units`` with paths and levels that follow from the parent links, and ``is_cyclic``."""
    found = paths_from_parents(
        org_units, work, "org_unit_uid", "parent_org_unit_uid", path="__path", depth="__depth", cyclic="is_cyclic")
    return found.withColumns({"org_unit_path": F.col("__path"), "org_unit_level": F.col("__depth")}).drop("__path", "__depth")


def facility_hierarchy(org_units: DataFrame) -> DataFrame:
    """One row per facility with the names of its district, region and country."""
    return flatten_hierarchy(
        org_units, LEAF_LEVEL, LEVEL_NAMES,
        id="org_unit_uid", name="org_unit_name", level="org_unit_level", path="org_unit_path",
        carry=["org_unit_groups"],
    ).withColumnsRenamed({
        "org_unit_name": "facility_name",
        "org_unit_level": "facility_level",
        "org_unit_groups": "facility_groups",
    })


def latest_observations(observations: DataFrame) -> DataFrame:
    """The latest row per key, the later created one among equals.

    Sorts compare the first column most: that is the one that tells most rows apart.
    """
    return latest_by(
        observations, sorted(OBSERVATION_KEY, key=lambda c: c != "org_unit_uid"), ["last_updated_at", "created_at"],
    )


def resolve_metadata(df: DataFrame, indicators: DataFrame, category_options: DataFrame) -> DataFrame:
    named = resolve(df, indicators, ["data_element_uid"], spread=OBSERVATION_KEY)
    return resolve(named, category_options, ["category_option_combo_uid"], spread=OBSERVATION_KEY)


def enrich(
    observations: DataFrame,
    indicators: DataFrame,
    category_options: DataFrame,
    hierarchy: DataFrame,
    bridge: DataFrame,
    scores: DataFrame | None = None,
) -> DataFrame:
    """Latest observations with names, scores, typed values, flags and programs.

    Without ``scores`` they are counted from the rows themselves, to the same result.

    Duplicates go before the joins: their key is part of the raw row, so nothing is widened
    only to be dropped. Each lookup is joined once and holds a key once; only the bridge may
    multiply rows.
    """
    latest = resolve(resolve_metadata(latest_observations(observations), indicators, category_options),
                     hierarchy, ["org_unit_uid"], spread=OBSERVATION_KEY)
    named = score_latest(latest, bridge) if scores is None else attach_completeness(latest, scores)
    typed = with_quality_flags(with_typed_values(with_period_columns(named)))
    programs = bridge.select(
        "data_element_uid",
        F.col("program_country").alias("country_name"),
        F.col("program_health_area").alias("health_area"),
        "program_uid", "program_name", "program_country", "program_health_area",
    )
    return resolve(typed, programs, ["data_element_uid", "country_name", "health_area"], spread=OBSERVATION_KEY)


def name_reports(observations: DataFrame, indicators: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """Who reported what when, with the names that completeness groups by.

    Duplicates may stay: they do not change which indicators a facility reported. So scores
    come straight from a few columns of the observations.
    """
    reported = ["data_element_uid", "org_unit_uid", "period"]
    named = resolve(
        observations.select(*reported), indicators.select("data_element_uid", "data_element_name", "health_area"),
        ["data_element_uid"], spread=reported,
    )
    return resolve(named, hierarchy.select("org_unit_uid", "country_name"), ["org_unit_uid"], spread=reported)


def completeness(named: DataFrame, bridge: DataFrame) -> DataFrame:
    """Score per country, area, facility and period: resolved indicators over expected ones.

    ``named`` are enriched rows, or those of ``name_reports``.
    """
    reported = scoring.reported_counts(named, SCORE_UNIT, "data_element_uid", resolved="data_element_name")
    return scoring.completeness(reported, _expected(bridge), SCORE_GROUP)


def _expected(bridge: DataFrame) -> DataFrame:
    named = bridge.withColumnsRenamed({"program_country": "country_name", "program_health_area": "health_area"})
    return scoring.expected_counts(named, SCORE_GROUP, "data_element_uid")


def attach_completeness(df: DataFrame, scores: DataFrame) -> DataFrame:
    return scoring.attach(df, scores, SCORE_UNIT)


def score_latest(latest: DataFrame, bridge: DataFrame) -> DataFrame:
    """``attach_completeness`` of the scores that ``completeness`` would give."""
    return scoring.score_rows(latest, _expected(bridge), SCORE_GROUP, SCORE_UNIT, "data_element_uid", "data_element_name")


def fact_service_delivery(enriched: DataFrame) -> DataFrame:
    return project_fact(enriched, FACT_COLUMNS)


FACT_SCHEMA = ", ".join(f"{c.name} {TYPE_ALIASES.get(c.type, c.type)}" for c in FACT_CONTRACT)


def fact_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, FACT_PARTITIONS)


def read_fact(
    spark: SparkSession, path: str, version: Version | None = None, months: Sequence[str] | None = None
) -> DataFrame:
    """The fact as it was before writing, contract types and order, unknown areas null again.

    By default the published version, else the one given; ``months`` limits it to some months.
    """
    table = fact_table(spark, path)
    rows = table.read(version or table.current(), FACT_SCHEMA, months=months).select(*FACT_COLUMNS)
    return restore_unknown(rows, "health_area")


def _folded(fact: DataFrame, keys: Sequence[str], **measures) -> DataFrame:
    return fact.groupBy(*keys).agg(*[m.alias(name) for name, m in measures.items()])


#: The fact by month, folded to what one analytic needs of it, under the fact's column names: the
#: analytics below give the same from a fold as from the fact. A fold of a month depends on
#: that month only, so folds of all months side by side are the fold of the whole fact.
FOLDS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "district_values": (
        "health_area string, district_name string, data_element_name string, year_month string, numeric_value double",
        lambda fact: _folded(
            fact, ["health_area", "district_name", "data_element_name", "year_month"], numeric_value=F.sum("numeric_value")),
    ),
    "facility_values": (
        "country_name string, facility_name string, org_unit_uid string, data_element_name string, year_month string,"
        " numeric_value double",
        lambda fact: _folded(
            fact, ["country_name", "facility_name", "org_unit_uid", "data_element_name", "year_month"],
            numeric_value=F.sum("numeric_value")),
    ),
    "presence": (
        "country_name string, org_unit_uid string, period string, year_month string, raw_value string",
        lambda fact: _folded(fact, ["country_name", "org_unit_uid", "period", "year_month"], raw_value=F.max("raw_value")),
    ),
    "area_values": (
        "health_area string, country_name string, facility_name string, org_unit_uid string, period string,"
        " year_month string, numeric_value double",
        lambda fact: _folded(
            fact, ["health_area", "country_name", "facility_name", "org_unit_uid", "period", "year_month"],
            numeric_value=F.sum(F.coalesce("numeric_value", F.lit(0.0)))),
    ),
    "volumes": (
        "health_area string, quarter string, data_element_uid string, year_month string, numeric_value double",
        lambda fact: _folded(
            fact, ["health_area", "quarter", "data_element_uid", "year_month"], numeric_value=F.sum("numeric_value")),
    ),
    "scores": (
        "country_name string, health_area string, org_unit_uid string, period string, year_month string,"
        " reported_indicator_count bigint, expected_indicator_count bigint, completeness_score double, rows bigint",
        lambda fact: _folded(
            fact, ["country_name", "health_area", "org_unit_uid", "period", "year_month", "reported_indicator_count",
                   "expected_indicator_count", "completeness_score"], rows=F.count(F.lit(1))),
    ),
    "coverage": (
        "data_element_name string, country_name string, year_month string",
        lambda fact: crossview.coverage_pairs(fact, "data_element_name", "country_name", "year_month"),
    ),
}


def month_over_month_change(fact: DataFrame, calendar: bool = False) -> DataFrame:
    keys = ["health_area", "district_name", "data_element_name"]
    totals = trends.period_totals(fact, keys, "year_month", "numeric_value")
    return trends.period_change(totals, keys, "year_month", calendar=calendar)


def rolling_three_month_average(
    fact: DataFrame, min_periods: int = 1, calendar: bool = False
) -> DataFrame:
    keys = ["country_name", "facility_name", "org_unit_uid", "data_element_name"]
    totals = trends.period_totals(fact, keys, "year_month", "numeric_value")
    return trends.rolling_mean(
        totals, ["org_unit_uid", "data_element_name"], "year_month",
        min_periods=min_periods, calendar=calendar,
    )


def country_reporting_rate(fact: DataFrame, **options) -> DataFrame:
    return facilities.reporting_rate(fact, **options)


def top_underreporting_facilities(fact: DataFrame, top: int = 5) -> DataFrame:
    return facilities.top_underreporting(fact, top=top)


def anomalies(fact: DataFrame, exclude_current: bool = False) -> DataFrame:
    """A key has one row per month and program here, so its window fits a task as it is."""
    return facilities.rolling_anomalies(
        fact, ["org_unit_uid", "data_element_uid", "category_option_combo_uid"],
        ["year_month", "program_uid"], exclude_current=exclude_current,
    ).select(*ANOMALY_COLUMNS)


def global_volumes_by_quarter(fact: DataFrame, indicators: DataFrame | None = None) -> DataFrame:
    """Sums of all values or, given the indicators, of those whose aggregation type is a sum."""
    if indicators is None:
        return crossview.volumes(fact, ["health_area", "quarter"])
    kinds = indicators.select("data_element_uid", "aggregation_type")
    return crossview.volumes(
        resolve(fact, kinds, ["data_element_uid"]), ["health_area", "quarter"],
        additive=F.col("aggregation_type") == ADDITIVE_TYPE,
    )


def completeness_comparison(
    fact: DataFrame, equal_facilities: bool = False, ordered: bool = True, weight: str | None = None
) -> DataFrame:
    """Mean scores by rows of the fact, or by facilities; ``weight`` names the column of row counts of a fold."""
    return scoring.mean_score(
        fact, ["country_name", "health_area", "period"],
        unit=["org_unit_uid"] if equal_facilities else None, weight=weight, ordered=ordered, counts=SCORE_COUNTS,
    )


def data_element_coverage_matrix(fact: DataFrame, countries: list | None = None) -> DataFrame:
    if countries is None:
        countries = crossview.distinct_values(fact, "country_name")
    return crossview.coverage_matrix(fact, "data_element_name", "country_name", countries)


def low_completeness_flags(scores: DataFrame) -> DataFrame:
    return crossview.low_streaks(scores, ["country_name", "health_area"])
