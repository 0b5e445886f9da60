"""The batch job: exports in, star schema, quality tables and analytics out."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardbook.errors import EmptyFact
from wardbook.functions.periods import period_dimension
from wardbook.operators.contract import ColumnSpec, enforce_contract
from wardbook.operators.drift import drift_totals, snapshot_drift
from wardbook.operators.history import changes, drift_between, register_at, validity
from wardbook.operators.incremental import differing_periods, new_periods_only, period_digests
from wardbook.operators.latest import unique_lookup
from wardbook.operators.resolve import flag_unresolved
from wardbook.operators.star import ambiguous_keys, fill_unknown
from wardbook.operators.validity import MAX_QUARANTINE_RATE, enforce_rate, split_valid, validity_summary
from wardbook.plans import facility
from wardbook.sources import exports as ex
from wardbook.sources.tables import (
    Workspace, side_by_side, write_csv, write_json, write_parquet, write_partitioned,
)
from wardbook.sources.versions import Version, VersionedTable, new_load

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class JobOptions:
    """How a run departs from the defaults."""

    incremental: bool = False
    reprocess_corrected: bool = False
    reference_metadata: str | None = None
    multi_line: bool = False
    data_values_as_lines: bool = False
    split_data_values: bool = False
    keep_corrupt: bool = False
    strict_periods: bool = False
    max_quarantine_rate: float = MAX_QUARANTINE_RATE
    calendar: bool = False
    min_periods: int = 1
    exclude_current: bool = False
    equal_facilities: bool = False
    keep_null_country: bool = False
    facility_register: bool = False
    additive_volumes: bool = False
    tree_from_parents: bool = False
    run_time: str | None = None
    drift_since: str | None = None
    contract: tuple[ColumnSpec, ...] = tuple(facility.FACT_CONTRACT)


@dataclass(frozen=True)
class Lookups:
    indicators: DataFrame
    category_options: DataFrame
    hierarchy: DataFrame
    programs: DataFrame
    bridge: DataFrame


def run(spark: SparkSession, data_dir: str, out_dir: str, options: JobOptions = JobOptions()) -> bool:
    """Run the job; False means that an incremental run found nothing to load.

    Raises an error of ``wardbook.errors`` when a gate fails; the summary then holds the counts up
    to that gate. Readers of the fact see the new months once everything else is written. Intermediate tables are written once and read back, so each export is parsed
    once and every later step prunes columns. They are deleted when a run ends well, and left
    for inspection when it does not.
    """
    work = Workspace(spark, fallback=f"{out_dir}/work")
    counts: dict[str, int] = {}
    try:
        loaded = _run(spark, data_dir, out_dir, options, work, counts)
    finally:
        if counts:
            rows = spark.createDataFrame(list(counts.items()), "stage string, rows long")
            write_csv(rows.coalesce(1), f"{out_dir}/dq/summary")
    work.delete()
    return loaded


def _run(
    spark: SparkSession, data_dir: str, out_dir: str, options: JobOptions, work: Workspace, counts: dict[str, int]
) -> bool:
    def count(stage: str, rows: int) -> None:
        counts[stage] = rows
        log.info("%s: %d rows", stage, rows)

    warehouse, dq = f"{out_dir}/warehouse", f"{out_dir}/dq"
    table = facility.fact_table(spark, f"{warehouse}/fact_service_delivery")
    version, load = table.current(), new_load()

    exports = ex.load_exports(
        spark, data_dir, multi_line=options.multi_line, data_values_as_lines=options.data_values_as_lines,
        keep_corrupt=options.keep_corrupt, split_data_values=options.split_data_values, work=work,
    )
    landed = work.keep(
        facility.flag_valid(ex.flatten_data_values(exports["data_values"]), options.strict_periods),
        "observations",
    )
    valid, malformed = split_valid(landed)
    valid = valid.drop(ex.CORRUPT)

    extends = options.incremental and version.number > 0
    digests = work.keep(period_digests(valid, DIGESTED), "digests")
    if extends:
        months = _months_to_load(table, version, valid, digests, options.reprocess_corrected)
        if not months:
            return False
        valid, digests = (rows.filter(F.col("period").isin(months)) for rows in (valid, digests))

    write_parquet(malformed, f"{out_dir}/quarantine/malformed_data_values")
    landing = validity_summary(landed).first()
    count("flattened_data_values", landing["total_rows"])
    count("malformed_data_values", landing["malformed_rows"])
    count("processed_data_values", valid.count() if extends else landing["valid_rows"])
    enforce_rate(landing, options.max_quarantine_rate)

    lookups = _lookups(work, exports, dq, options)
    scores = work.keep(
        facility.completeness(
            facility.name_reports(valid, lookups.indicators, lookups.hierarchy), lookups.bridge
        ),
        "completeness",
    )
    cleaned = Observation("clean")
    clean = work.keep(
        facility.enrich(
            valid, lookups.indicators, lookups.category_options, lookups.hierarchy, lookups.bridge, scores
        ).observe(cleaned, F.count(F.lit(1)).alias("rows")),
        "clean",
    )
    count("enriched_data_values", cleaned.get["rows"])
    side_by_side(
        spark,
        lambda: _report_drift(spark, lookups.indicators, f"{warehouse}/metadata_history", dq, options),
        lambda: _unresolved_reports(work, valid, lookups, dq),
        lambda: write_parquet(
            ambiguous_keys(lookups.bridge, ["data_element_uid", "program_country", "program_health_area"]),
            f"{dq}/ambiguous_program_indicators",
        ),
        lambda: write_parquet(clean.filter("is_late_reported"), f"{dq}/late_reported"),
        lambda: write_parquet(clean.filter("is_missing_value"), f"{dq}/missing_values"),
        lambda: write_parquet(clean.filter("is_explicit_zero"), f"{dq}/explicit_zeros"),
    )

    fact = facility.fact_service_delivery(clean)
    if not counts["enriched_data_values"]:
        raise EmptyFact("The fact has no rows")
    enforce_contract(fact, options.contract)

    following = version.after(load, [r["period"] for r in digests.select("period").collect()], keep=extends)
    side_by_side(
        spark,
        lambda: write_partitioned(fill_unknown(fact, "health_area"), table.folder(load), facility.FACT_PARTITIONS),
        lambda: write_parquet(digests.withColumn("year_month", F.col("period")), table.folder(load, "digests")),
        *[
            lambda name=name, fold=fold: write_parquet(fold(fact), table.folder(load, name))
            for name, (_, fold) in facility.FOLDS.items()
        ],
    )
    whole_fact = facility.read_fact(spark, table.path, following)
    folds = {name: table.read(following, schema, name) for name, (schema, _) in facility.FOLDS.items()}
    side_by_side(
        spark,
        *_dimensions(folds["presence"], lookups, warehouse),
        *_analytics(whole_fact, folds, lookups, options, f"{out_dir}/analytics"),
        *_cross_country(work, folds, lookups, options, f"{out_dir}/cross_country"),
        lambda: write_parquet(lookups.indicators, f"{warehouse}/metadata_snapshot"),
        lambda: _record_history(work, lookups.indicators, f"{warehouse}/metadata_history", dq, options),
    )
    table.publish(following)
    table.sweep()
    count("fact_service_delivery", whole_fact.count() if extends else counts["enriched_data_values"])
    return True


#: What a month's digest is of: the key of an observation and its time stamp.
DIGESTED = [*(c for c in facility.OBSERVATION_KEY if c != "period"), "last_updated_at"]
DIGESTS = "period string, rows bigint, digest string, check bigint, year_month string"


def _months_to_load(
    table: VersionedTable, version: Version, valid: DataFrame, digests: DataFrame, reprocess_corrected: bool
) -> list[str]:
    """Months of the export that are not loaded and, if asked for, those with new or corrected keys.

    Only months whose digest differs from the one kept at their last load are compared, so the fact's
    other partitions are not opened. There are as many entries on the driver as months.
    """
    differing = differing_periods(digests, table.read(version, DIGESTS, "digests")).collect()
    months = {r["period"] for r in differing if r["period"] not in version.months}
    suspects = [r["period"] for r in differing if r["period"] in version.months]
    if reprocess_corrected and suspects:
        rows, held = compared_rows(table, version, valid, suspects)
        corrected = new_periods_only(rows, held, reprocess_corrected=True, key=[c for c in DIGESTED if c != "last_updated_at"])
        months |= {r["period"] for r in corrected.select("period").distinct().collect()}
    return sorted(months)


def compared_rows(
    table: VersionedTable, version: Version, valid: DataFrame, months: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """The offered and the loaded rows of some months."""
    held = facility.read_fact(table.spark, table.path, version, months).drop("period")
    return valid.filter(F.col("period").isin(list(months))), held


def _lookups(work: Workspace, exports: dict[str, DataFrame], dq: str, options: JobOptions) -> Lookups:
    """Lookups with one row per key, written so that Spark knows their size when it plans joins."""
    programs = ex.flatten_programs(exports["programs"]).filter(F.col("program_uid").isNotNull())
    org_units = ex.known(ex.flatten_org_units(exports["org_units"]), "org_unit_uid")
    if options.tree_from_parents:
        tree = work.keep(facility.tree_from_parents(org_units, work), "tree")
        write_parquet(tree.filter("is_cyclic").select("org_unit_uid", "parent_org_unit_uid"), f"{dq}/org_unit_cycles")
        org_units = tree.select(*org_units.columns)
    return Lookups(*side_by_side(
        work.spark,
        lambda: work.keep(
            ex.known(ex.flatten_indicators(exports["metadata"]), "data_element_uid"), "indicators"
        ),
        lambda: work.keep(
            ex.known(ex.flatten_category_options(exports["metadata"]), "category_option_combo_uid"),
            "category_options",
        ),
        lambda: work.keep(facility.facility_hierarchy(org_units), "hierarchy"),
        lambda: work.keep(programs, "programs"),
        lambda: work.keep(ex.program_indicators(programs).distinct(), "program_indicators"),
    ))


def _report_drift(
    spark: SparkSession, indicators: DataFrame, history: str, dq: str, options: JobOptions
) -> None:
    """Compare with the given reference export, else with the register of the last run, if there was one.

    That is taken from the history, which runs only append to, and not from the snapshot, which they replace.
    """
    if options.reference_metadata:
        documents = ex.read_documents(
            spark, options.reference_metadata, ex.METADATA_DOCUMENT, options.multi_line
        )
        reference = ex.known(ex.flatten_indicators(documents), "data_element_uid")
    else:
        log = _history(spark, history)
        if log.isEmpty():
            return
        reference = register_at(validity(log), F.current_timestamp() + F.expr("INTERVAL 1 DAY"), ["data_element_name"])
        reference = reference.withColumnRenamed("id", "data_element_uid")
    drift = snapshot_drift(indicators, reference, "data_element_uid", "data_element_name")
    write_json(drift.orderBy("change", "id"), f"{dq}/metadata_drift")
    write_json(drift_totals(drift), f"{dq}/metadata_drift_totals")


def _history(spark: SparkSession, path: str) -> DataFrame:
    """The log of changes; an empty one where none has been written."""
    spark.createDataFrame([], HISTORY).write.mode("ignore").parquet(path)
    return spark.read.schema(HISTORY).parquet(path)


def _record_history(work: Workspace, indicators: DataFrame, path: str, dq: str, options: JobOptions) -> None:
    """Append what has changed in any attribute since the last run; report it, and all that has since a given time."""
    spark = work.spark
    at = F.lit(options.run_time).cast("timestamp") if options.run_time else F.lit(datetime.now(timezone.utc))
    log = _history(spark, path)
    attributes = [c for c in indicators.columns if c != "data_element_uid"]
    new = work.keep(changes(log, indicators, "data_element_uid", attributes, at), "metadata_changes")
    write_parquet(new, f"{dq}/metadata_changes")
    if options.drift_since:
        drift = drift_between(validity(log.unionByName(new)), F.lit(options.drift_since).cast("timestamp"), at)
        write_parquet(drift, f"{dq}/metadata_drift_since")
    new.write.mode("append").parquet(path)


HISTORY = "id string, attribute string, value string, is_present boolean, changed_at timestamp"


def _unresolved_reports(work: Workspace, valid: DataFrame, lookups: Lookups, dq: str) -> None:
    """One pass over all rows finds those with any unknown key; the reports then split these few."""
    checks = {
        "unresolved_data_elements": (lookups.indicators, ["data_element_uid"]),
        "unresolved_category_option_combos": (lookups.category_options, ["category_option_combo_uid"]),
        "unresolved_org_units": (lookups.hierarchy, ["org_unit_uid"]),
    }
    suspects = work.keep(
        flag_unresolved(valid, checks, spread=facility.OBSERVATION_KEY).filter(" or ".join(checks)), "unresolved"
    )
    for report in checks:
        rows = suspects.filter(report).drop(*checks)
        if report == "unresolved_org_units":
            rows = facility.resolve_metadata(rows, lookups.indicators, lookups.category_options)
        write_parquet(rows, f"{dq}/{report}")


def _dimensions(months: DataFrame, lookups: Lookups, folder: str) -> list[Callable[[], None]]:
    """Indicators and facilities are unique already; a program may come more than once."""
    return [
        lambda: write_parquet(lookups.indicators, f"{folder}/dim_data_element"),
        lambda: write_parquet(lookups.hierarchy, f"{folder}/dim_org_unit"),
        lambda: write_parquet(period_dimension(months, "year_month"), f"{folder}/dim_period"),
        lambda: write_parquet(unique_lookup(lookups.programs, ["program_uid"]), f"{folder}/dim_program"),
    ]


def _analytics(
    fact: DataFrame, folds: dict[str, DataFrame], lookups: Lookups, options: JobOptions, folder: str
) -> list[Callable[[], None]]:
    """Only the anomalies read the fact itself: a value is judged by the ones before it."""
    register = lookups.hierarchy.select("country_name", "org_unit_uid") if options.facility_register else None
    return [
        lambda: write_csv(
            facility.month_over_month_change(folds["district_values"], options.calendar),
            f"{folder}/month_over_month_change",
        ),
        lambda: write_csv(
            facility.rolling_three_month_average(folds["facility_values"], options.min_periods, options.calendar),
            f"{folder}/rolling_3_month_average",
        ),
        lambda: write_csv(
            facility.country_reporting_rate(
                folds["presence"], expected_units=register, keep_null_group=options.keep_null_country
            ),
            f"{folder}/country_reporting_rate",
        ),
        lambda: write_csv(
            facility.top_underreporting_facilities(folds["area_values"]), f"{folder}/top_underreporting_facilities"
        ),
        lambda: write_csv(facility.anomalies(fact, options.exclude_current), f"{folder}/anomalies"),
    ]


def _cross_country(
    work: Workspace, folds: dict[str, DataFrame], lookups: Lookups, options: JobOptions, folder: str
) -> list[Callable[[], None]]:
    def write_scores() -> None:
        means = facility.completeness_comparison(folds["scores"], options.equal_facilities, ordered=False, weight="rows")
        scores = work.keep(means, "mean_scores")
        write_csv(
            scores.orderBy("country_name", "health_area", "period"), f"{folder}/completeness_comparison"
        )
        write_csv(facility.low_completeness_flags(scores), f"{folder}/low_completeness_flags")

    return [
        lambda: write_csv(
            facility.global_volumes_by_quarter(folds["volumes"], lookups.indicators if options.additive_volumes else None),
            f"{folder}/global_volumes_by_quarter",
        ),
        lambda: write_csv(
            facility.data_element_coverage_matrix(folds["coverage"]), f"{folder}/data_element_coverage_matrix"
        ),
        lambda: write_parquet(
            folds["coverage"].select("data_element_name", "country_name").distinct(), f"{folder}/data_element_coverage_pairs"
        ),
        write_scores,
    ]
