"""The whole job against a plain-Python model, its gates, and incremental runs."""

import csv
import glob
import json

import pytest
from pyspark.errors import AnalysisException

from tests.exports import (
    INDICATORS, MONTHS, data_values, expected_fact, malformed_values, value, write_exports,
)
from wardbook.errors import ContractViolation, EmptyFact, JobStopped, QuarantineRateExceeded
from wardbook.operators.contract import ColumnSpec
from wardbook.plans import facility
from wardbook.plans.job import JobOptions, run
from wardbook.sources.tables import Workspace, exists

KEY = facility.OBSERVATION_KEY


def read_fact(spark, out):
    return facility.read_fact(spark, f"{out}/warehouse/fact_service_delivery")


def fact_rows(spark, out):
    return sorted(map(str, read_fact(spark, out).collect()))


def read_csv(folder):
    rows = []
    for part in sorted(glob.glob(f"{folder}/part-*.csv")):
        with open(part, newline="") as f:
            rows += list(csv.DictReader(f))
    return rows


@pytest.fixture(scope="module")
def full_run(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("full")
    rows = data_values()
    data = write_exports(base / "data", rows + malformed_values())
    assert run(spark, data, str(base / "out"))
    return rows, str(base / "out"), data


def test_fact_equals_model(spark, full_run):
    rows, out, _ = full_run
    want = expected_fact(rows)
    got = {tuple(r[k] for k in KEY): r.asDict() for r in read_fact(spark, out).collect()}
    assert set(got) == set(want)
    for key, columns in want.items():
        assert {c: got[key][c] for c in columns} == columns, key


def test_fact_has_contract_columns_and_types(spark, full_run):
    fact = read_fact(spark, full_run[1])
    aliases = {"integer": "int", "long": "bigint"}
    assert fact.dtypes == [(c.name, aliases.get(c.type, c.type)) for c in facility.FACT_CONTRACT]


def test_unknown_area_only_at_rest(spark, full_run):
    stored = spark.read.parquet(f"{full_run[1]}/warehouse/fact_service_delivery")
    assert stored.filter("health_area = 'Unknown'").count() > 0
    assert read_fact(spark, full_run[1]).filter("health_area = 'Unknown'").count() == 0


def test_quarantine_and_flag_tables(spark, full_run):
    rows, out, _ = full_run
    assert spark.read.parquet(f"{out}/quarantine/malformed_data_values").count() == len(malformed_values())
    want = expected_fact(rows).values()
    for table, flag in (("late_reported", "is_late_reported"), ("missing_values", "is_missing_value"),
                        ("explicit_zeros", "is_explicit_zero")):
        assert spark.read.parquet(f"{out}/dq/{table}").count() == sum(bool(r[flag]) for r in want)


def test_unresolved_tables_count_rows_before_deduplication(spark, full_run):
    rows, out, _ = full_run
    known = {i["id"] for i in INDICATORS}
    want = {
        "unresolved_data_elements": [r for r in rows if r["dataElement"] not in known],
        "unresolved_category_option_combos":
            [r for r in rows if r["categoryOptionCombo"] not in ("cocMain", "cocKids")],
        "unresolved_org_units": [r for r in rows if r["orgUnit"] not in ("facA", "facB", "facC")],
    }
    for table, expected in want.items():
        got = spark.read.parquet(f"{out}/dq/{table}")
        assert got.count() == len(expected), table
    assert "data_element_name" in spark.read.parquet(f"{out}/dq/unresolved_org_units").columns


def test_dimensions(spark, full_run):
    out = f"{full_run[1]}/warehouse"
    units = {r["org_unit_uid"]: r for r in spark.read.parquet(f"{out}/dim_org_unit").collect()}
    assert set(units) == {"facA", "facB", "facC"}
    assert units["facC"]["region_name"] is None and units["facC"]["country_name"] == "Beta"
    assert units["facA"]["facility_groups"] == "Public,Urban"
    assert spark.read.parquet(f"{out}/dim_data_element").count() == 4
    assert spark.read.parquet(f"{out}/dim_program").count() == 2
    periods = spark.read.parquet(f"{out}/dim_period").orderBy("period").collect()
    assert [r["period"] for r in periods] == MONTHS
    assert str(periods[3]["period_end_date"]) == "2024-02-29" and periods[3]["quarter"] == "2024Q1"


def test_analytics_files(full_run):
    rows, out, _ = full_run
    fact = expected_fact(rows)
    rates = read_csv(f"{out}/analytics/country_reporting_rate")
    assert list(rates[0]) == ["country_name", "period", "expected_facilities", "reported_facilities", "reporting_rate"]
    assert {(r["country_name"], r["period"]): float(r["reporting_rate"]) for r in rates} == {
        (c, m): 1.0 for c in ("Alpha", "Beta") for m in MONTHS}

    change = read_csv(f"{out}/analytics/month_over_month_change")
    cases = sorted((r for r in change if r["district_name"] == "Beta Coast" and r["data_element_name"] == "Cases"),
                   key=lambda r: r["year_month"])
    assert [r["monthly_value"] for r in cases] == ["30.0", "31.0", "32.0", "33.0"]
    assert cases[0]["previous_month_value"] == "" and float(cases[1]["mom_percent_change"]) == pytest.approx(100 / 30)

    rolling = read_csv(f"{out}/analytics/rolling_3_month_average")
    clinic_c = sorted((r for r in rolling if r["org_unit_uid"] == "facC" and r["data_element_name"] == "Cases"),
                      key=lambda r: r["year_month"])
    assert [float(r["rolling_3_month_avg"]) for r in clinic_c] == [30.0, 30.5, 31.0, 32.0]

    top = read_csv(f"{out}/analytics/top_underreporting_facilities")
    assert {r["org_unit_uid"]: (r["zero_data_periods"], r["rank"]) for r in top if r["health_area"] == ""} == {
        "facA": ("4", "1")}
    assert {r["rank"] for r in top if r["health_area"] == "HIV"} == {"1"}

    volumes = read_csv(f"{out}/cross_country/global_volumes_by_quarter")
    sums = {}
    for r in fact.values():
        key = (r["health_area"] or "", r["quarter"])
        sums[key] = (sums.get(key) or 0) + r["numeric_value"] if r["numeric_value"] is not None else sums.get(key)
    assert {(r["health_area"], r["quarter"]): float(r["total_service_volume"]) if r["total_service_volume"] else None
            for r in volumes} == sums

    coverage = {r["data_element_name"]: r for r in read_csv(f"{out}/cross_country/data_element_coverage_matrix")}
    assert list(coverage["Cases"]) == ["data_element_name", "null", "Alpha", "Beta"]
    assert (coverage["Cases"]["null"], coverage["In stock"]["Beta"], coverage["In stock"]["Alpha"]) == ("1", "0", "1")

    streaks = read_csv(f"{out}/cross_country/low_completeness_flags")
    assert [(r["country_name"], r["streak_start_period"], r["streak_end_period"], r["consecutive_low_periods"])
            for r in streaks] == [("Beta", "202311", "202402", "4")]
    assert float(streaks[0]["avg_streak_completeness"]) == 0.5


def test_volumes_of_additive_indicators_only(spark, full_run):
    fact = read_fact(spark, full_run[1])
    indicators = spark.createDataFrame([("deCases", "SUM"), ("dePosit", "AVERAGE")], "data_element_uid string, aggregation_type string")
    got = {(r[0], r[1]): r[2] for r in facility.global_volumes_by_quarter(fact, indicators).collect()}
    want = {}
    for (element, *_), r in expected_fact(full_run[0]).items():
        key = (r["health_area"], r["quarter"])
        want.setdefault(key, None)
        if element == "deCases" and r["numeric_value"] is not None:
            want[key] = (want[key] or 0) + r["numeric_value"]
    assert got == want


def test_stage_counts(full_run):
    rows, out, _ = full_run
    counts = {r["stage"]: int(r["rows"]) for r in read_csv(f"{out}/dq/summary")}
    assert counts == {
        "flattened_data_values": len(rows) + 3, "malformed_data_values": 3, "processed_data_values": len(rows),
        "enriched_data_values": len(expected_fact(rows)), "fact_service_delivery": len(expected_fact(rows)),
    }


def test_pretty_printed_and_line_exports_give_the_same_fact(spark, full_run, tmp_path):
    rows, out, _ = full_run
    pretty = write_exports(tmp_path / "pretty", rows, pretty=True)
    assert run(spark, pretty, str(tmp_path / "out1"), JobOptions(multi_line=True))
    lines = write_exports(tmp_path / "lines", rows)
    (tmp_path / "lines" / "data_values.json").write_text("\n".join(map(json.dumps, rows)))
    assert run(spark, lines, str(tmp_path / "out2"), JobOptions(data_values_as_lines=True))
    assert fact_rows(spark, out) == fact_rows(spark, tmp_path / "out1") == fact_rows(spark, tmp_path / "out2")


def test_split_documents_give_the_same_fact_and_quarantine(spark, full_run, tmp_path):
    rows, out, data = full_run
    pretty = write_exports(tmp_path / "pretty", rows + malformed_values(), pretty=True)
    for folder, multi_line in ((data, False), (pretty, True)):
        again = str(tmp_path / f"out-{multi_line}")
        assert run(spark, folder, again, JobOptions(multi_line=multi_line, split_data_values=True))
        assert fact_rows(spark, out) == fact_rows(spark, again)
        assert spark.read.parquet(f"{again}/quarantine/malformed_data_values").count() == len(malformed_values())


def test_incremental_runs_add_up_to_a_full_run(spark, full_run, tmp_path):
    rows, full_out, full_data = full_run
    out = str(tmp_path / "out")
    first = write_exports(tmp_path / "first", [r for r in rows if r["period"] < "202401"])
    assert run(spark, first, out, JobOptions(incremental=True))
    before = fact_rows(spark, out)
    assert run(spark, full_data, out, JobOptions(incremental=True))
    assert fact_rows(spark, out) == fact_rows(spark, full_out)
    assert set(before) <= set(fact_rows(spark, out))
    for table in ("analytics/rolling_3_month_average", "cross_country/completeness_comparison"):
        assert sorted(map(str, read_csv(f"{out}/{table}"))) == sorted(map(str, read_csv(f"{full_out}/{table}")))
    assert spark.read.parquet(f"{out}/warehouse/dim_period").count() == len(MONTHS)

    after = fact_rows(spark, out)
    assert run(spark, full_data, out, JobOptions(incremental=True)) is False
    assert fact_rows(spark, out) == after


def test_incremental_corrections(spark, full_run, tmp_path):
    rows, _, full_data = full_run
    out = str(tmp_path / "out")
    assert run(spark, full_data, out)
    corrected = rows + [value("deCases", "202312", "facC", "500", days=90)]
    data = write_exports(tmp_path / "data", corrected)
    assert run(spark, data, out, JobOptions(incremental=True)) is False
    assert run(spark, data, out, JobOptions(incremental=True, reprocess_corrected=True))
    got = {tuple(r[k] for k in KEY): r["raw_value"] for r in read_fact(spark, out).collect()}
    assert got == {k: v["raw_value"] for k, v in expected_fact(corrected).items()}


def test_reloaded_months_leave_no_row_behind(spark, full_run, tmp_path):
    """An unknown indicator becomes known, so its rows change area; a late report has an old stamp."""
    rows, _, _ = full_run
    rows = [r for r in rows if r["period"] in MONTHS[:2]]
    out, whole = str(tmp_path / "out"), str(tmp_path / "whole")
    first = write_exports(tmp_path / "first", rows, indicators=[i for i in INDICATORS if i["id"] != "dePosit"])
    assert run(spark, first, out)
    corrected = rows + [value("deCases", MONTHS[0], "facC", "500", days=90)]
    corrected.append(value("deStock", MONTHS[1], "facC", "false", days=-20))
    data = write_exports(tmp_path / "data", corrected)
    assert run(spark, data, out, JobOptions(incremental=True, reprocess_corrected=True))
    assert run(spark, data, whole)
    assert fact_rows(spark, out) == fact_rows(spark, whole)
    assert read_fact(spark, out).count() == len(expected_fact(corrected))
    assert run(spark, data, out, JobOptions(incremental=True, reprocess_corrected=True)) is False


def test_a_table_that_cannot_be_opened_is_not_taken_for_none(spark, tmp_path):
    assert not exists(spark, str(tmp_path / "none"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(AnalysisException):
        exists(spark, str(tmp_path / "empty"))


def test_summary_is_there_when_a_gate_stops_the_run(spark, tmp_path):
    row = data_values(MONTHS[:1])[0]
    data = write_exports(tmp_path / "data", [row, {**row, "period": "x"}])
    with pytest.raises(QuarantineRateExceeded):
        run(spark, data, str(tmp_path / "out"))
    counts = {r["stage"]: int(r["rows"]) for r in read_csv(f"{tmp_path}/out/dq/summary")}
    assert counts == {"flattened_data_values": 2, "malformed_data_values": 1, "processed_data_values": 1}


def test_drift_against_last_run_and_against_a_given_export(spark, tmp_path):
    rows, out = data_values(MONTHS[:1]), str(tmp_path / "out")
    old = write_exports(tmp_path / "old", rows)
    changed = [{**INDICATORS[0], "name": "All cases"}, *INDICATORS[2:], {**INDICATORS[1], "id": "deExtra"}]
    new = write_exports(tmp_path / "new", rows, indicators=changed)
    assert run(spark, old, out)
    assert not glob.glob(f"{out}/dq/metadata_drift")
    assert run(spark, new, out)
    want = {("deExtra", "added", None, "Positivity"), ("dePosit", "removed", "Positivity", None),
            ("deCases", "renamed", "Cases", "All cases")}
    columns = ["id", "change", "old_name", "new_name"]
    assert {tuple(r) for r in spark.read.json(f"{out}/dq/metadata_drift").select(columns).collect()} == want
    totals = spark.read.json(f"{out}/dq/metadata_drift_totals").first()
    assert (totals["total_added"], totals["total_removed"], totals["total_renamed"]) == (1, 1, 1)
    assert run(spark, new, out, JobOptions(reference_metadata=f"{old}/metadata.json"))
    assert {tuple(r) for r in spark.read.json(f"{out}/dq/metadata_drift").select(columns).collect()} == want


def test_metadata_history_over_three_runs(spark, tmp_path):
    rows, out = data_values(MONTHS[:1]), str(tmp_path / "out")
    registers = [
        INDICATORS, [{**INDICATORS[0], "name": "All cases"}, *INDICATORS[2:]],
        [{**INDICATORS[0], "valueType": "TEXT"}, *INDICATORS[1:]],
    ]
    for day, indicators in enumerate(registers, 1):
        data = write_exports(tmp_path / str(day), rows, indicators=indicators)
        assert run(spark, data, out, JobOptions(run_time=f"2024-01-0{day} 00:00:00", drift_since="2024-01-01 12:00:00"))
    changed = {(r["id"], r["attribute"], r["change"], r["old_value"], r["new_value"])
               for r in spark.read.parquet(f"{out}/dq/metadata_drift_since").collect()}
    assert changed == {("deCases", "value_type", "changed", INDICATORS[0]["valueType"], "TEXT")}
    last = {(r["id"], r["attribute"]) for r in spark.read.parquet(f"{out}/dq/metadata_changes").collect()}
    assert {("deCases", "data_element_name"), ("deCases", "value_type"), ("dePosit", "data_element_name")} <= last
    assert not any(i in ("deStock", "deOther") for i, _ in last)


def test_tree_from_parent_links_gives_the_same_fact(spark, tmp_path):
    """Where every ancestor is there; without paths in the export."""
    rows = data_values(MONTHS[:1])
    data = write_exports(tmp_path / "data", rows)
    units = json.loads((tmp_path / "data" / "org_units.json").read_text())
    known = {u["id"] for u in units["organisationUnits"]}
    for u in units["organisationUnits"]:
        above = [p for p in u["path"].strip("/").split("/")[:-1] if p in known]
        u["path"] = "/" + "/".join([*above, u["id"]])
        u["parent"], u["level"] = {"id": above[-1]} if above else None, len(above) + 1
    (tmp_path / "data" / "org_units.json").write_text(json.dumps(units))
    assert run(spark, data, str(tmp_path / "by_path"))
    for u in units["organisationUnits"]:
        u["path"], u["level"] = None, None
    units["organisationUnits"] += [{"id": "x", "parent": {"id": "y"}}, {"id": "y", "parent": {"id": "x"}}]
    (tmp_path / "data" / "org_units.json").write_text(json.dumps(units))
    assert run(spark, data, str(tmp_path / "by_parent"), JobOptions(tree_from_parents=True))
    assert fact_rows(spark, tmp_path / "by_parent") == fact_rows(spark, tmp_path / "by_path")
    cycles = spark.read.parquet(f"{tmp_path}/by_parent/dq/org_unit_cycles")
    assert {r["org_unit_uid"] for r in cycles.collect()} == {"x", "y"}


def test_gates(spark, tmp_path):
    row = data_values(MONTHS[:1])[0]
    bad = {**row, "period": "x"}
    data = write_exports(tmp_path / "a", [row] * 8 + [bad])
    with pytest.raises(QuarantineRateExceeded):
        run(spark, data, str(tmp_path / "out"))
    assert spark.read.parquet(f"{tmp_path}/out/quarantine/malformed_data_values").count() == 1
    data = write_exports(tmp_path / "b", [row] * 9 + [bad])
    assert run(spark, data, str(tmp_path / "out"))
    data = write_exports(tmp_path / "c", [])
    with pytest.raises(QuarantineRateExceeded):
        run(spark, data, str(tmp_path / "out"))
    with pytest.raises(EmptyFact):
        run(spark, data, str(tmp_path / "out"), JobOptions(max_quarantine_rate=1.0))
    data = write_exports(tmp_path / "d", [row])
    contract = (ColumnSpec("health_area", "integer"),)
    with pytest.raises(ContractViolation, match="Column type mismatch for health_area"):
        run(spark, data, str(tmp_path / "out"), JobOptions(contract=contract))
    assert [e.exit_code for e in (JobStopped, QuarantineRateExceeded, EmptyFact, ContractViolation)] == [1, 2, 3, 4]


def test_command_line_exits_with_the_gate_code(spark, tmp_path, capsys, monkeypatch):
    import wardbook.__main__ as cli
    monkeypatch.setattr(cli, "run", lambda *args: seen.append(args) or True)
    seen = []
    arguments = ["--data-dir", "d", "--output-dir", "o"]
    assert cli.main(arguments) == 0
    assert cli.main([*arguments, "--incremental", "--reference-metadata", "m.json", "--multi-line"]) == 0
    assert [a[1:] for a in seen] == [
        ("d", "o", JobOptions()),
        ("d", "o", JobOptions(incremental=True, reference_metadata="m.json", multi_line=True))]
    options = ["--calendar", "--min-periods", "2", "--exclude-current", "--equal-facilities", "--keep-null-country",
               "--facility-register", "--additive-volumes", "--strict-periods", "--keep-corrupt", "--max-quarantine-rate", "0.5"]
    assert cli.main([*arguments, *options]) == 0
    assert seen[-1][3] == JobOptions(
        calendar=True, min_periods=2, exclude_current=True, equal_facilities=True, keep_null_country=True,
        facility_register=True, additive_volumes=True, strict_periods=True, keep_corrupt=True, max_quarantine_rate=0.5)
    monkeypatch.setattr(cli, "run", run)
    row = data_values(MONTHS[:1])[0]
    data = write_exports(tmp_path / "data", [{**row, "period": "x"}])
    assert cli.main(["--data-dir", data, "--output-dir", str(tmp_path / "out")]) == 2
    assert "QuarantineRateExceeded: 1 of 1 rows" in capsys.readouterr().err


def test_text_of_corrupt_documents_reaches_quarantine(spark, tmp_path):
    data = write_exports(tmp_path / "data", data_values(MONTHS[:1]))
    with open(f"{data}/data_values.json", "a") as f:
        f.write("\n{broken\n")
    assert run(spark, data, str(tmp_path / "out"), JobOptions(keep_corrupt=True))
    malformed = spark.read.parquet(f"{tmp_path}/out/quarantine/malformed_data_values").collect()
    assert [r["_corrupt_record"] for r in malformed] == ["{broken"]


def test_work_tables_go_to_the_checkpoint_folder(spark, full_run):
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(f"{root}/wardbook-*"))
    rows, out, data = full_run
    with pytest.raises(ContractViolation):
        run(spark, data, f"{out}-broken", JobOptions(contract=(ColumnSpec("health_area", "integer"),)))
    assert len(set(glob.glob(f"{root}/wardbook-*/clean")) - before) and not glob.glob(f"{out}*/work*")


def test_work_tables_go_after_success(spark, full_run, tmp_path):
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(f"{root}/wardbook-*"))
    assert run(spark, full_run[2], str(tmp_path / "out"))
    assert set(glob.glob(f"{root}/wardbook-*")) == before


def test_work_tables_go_to_the_output_where_no_folder_is_named():
    class Unconfigured:
        class conf:
            get = staticmethod(lambda name, default: default)
    first, second = (Workspace(Unconfigured, "/shared/out/work").folder for _ in range(2))
    assert first.startswith("/shared/out/work/wardbook-") and first != second
