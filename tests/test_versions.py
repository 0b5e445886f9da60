"""Loads that are switched to at once, and incremental runs that read only what they need."""

import glob
import os

import pytest

from tests.exports import MONTHS, data_values, value, write_exports
from tests.test_job import fact_rows, read_csv
from wardbook.plans import facility, job
from wardbook.plans.job import JobOptions, run
from wardbook.sources.versions import VersionedTable, new_load

ANALYTICS = [
    "analytics/month_over_month_change", "analytics/rolling_3_month_average", "analytics/country_reporting_rate",
    "analytics/top_underreporting_facilities", "analytics/anomalies", "cross_country/global_volumes_by_quarter",
    "cross_country/data_element_coverage_matrix", "cross_country/completeness_comparison",
    "cross_country/low_completeness_flags",
]
INCREMENTAL = JobOptions(incremental=True, reprocess_corrected=True)


def fact_folder(out):
    return f"{out}/warehouse/fact_service_delivery"


def spoil(out, months):
    """Make the fact's files of these months unreadable."""
    spoilt = [f for m in months for f in glob.glob(f"{fact_folder(out)}/load=*/*/year_month={m}/*.parquet")]
    for file in spoilt:
        with open(file, "wb") as f:
            f.write(b"no parquet")
        crc = os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    assert spoilt


@pytest.fixture()
def loaded(spark, tmp_path):
    """Three months loaded, and an export with a fourth month and a correction of the second."""
    rows = data_values()
    first = write_exports(tmp_path / "first", [r for r in rows if r["period"] < MONTHS[3]])
    more = rows + [value("deCases", MONTHS[1], "facB", "77", days=120), value("deNew", MONTHS[1], "facC", "3")]
    out = str(tmp_path / "out")
    assert run(spark, first, out)
    return out, write_exports(tmp_path / "second", more), first


def test_an_incremental_run_equals_a_full_one(spark, loaded, tmp_path):
    out, second, _ = loaded
    whole = str(tmp_path / "whole")
    assert run(spark, second, out, INCREMENTAL) and run(spark, second, whole)
    assert fact_rows(spark, out) == fact_rows(spark, whole)
    for table in ANALYTICS:
        assert sorted(map(str, read_csv(f"{out}/{table}"))) == sorted(map(str, read_csv(f"{whole}/{table}"))), table
    assert glob.glob(f"{out}/cross_country/data_element_coverage_pairs/*.parquet")


@pytest.mark.parametrize("step", ["fact", "digests", "folds", "analytics", "publish", "rename", "sweep"])
def test_a_run_that_is_cut_off_leaves_the_old_fact_or_the_new(spark, loaded, tmp_path, monkeypatch, step):
    out, second, _ = loaded
    whole = str(tmp_path / "whole")
    assert run(spark, second, whole)
    before, after = fact_rows(spark, out), fact_rows(spark, whole)

    def cut(*args, **kwargs):
        raise InterruptedError(step)

    def cut_for(part, real):
        return lambda df, path, *more: cut() if part in path else real(df, path, *more)

    with monkeypatch.context() as patch:
        if step == "fact":
            patch.setattr(job, "write_partitioned", cut)
        elif step in ("digests", "folds"):
            patch.setattr(job, "write_parquet", cut_for("/digests/" if step == "digests" else "/presence/", job.write_parquet))
        elif step == "analytics":
            patch.setattr(job, "write_csv", cut_for("country_reporting_rate", job.write_csv))
        elif step in ("publish", "sweep"):
            patch.setattr(VersionedTable, step, cut)
        else:
            real = VersionedTable._file_of
            patch.setattr(VersionedTable, "_file_of", lambda self, n: real(self, n) if n < 2 else cut())
        with pytest.raises(InterruptedError):
            run(spark, second, out, INCREMENTAL)
    assert fact_rows(spark, out) == (after if step == "sweep" else before)
    assert run(spark, second, out, INCREMENTAL) is (step != "sweep")
    assert fact_rows(spark, out) == after


def test_unchanged_months_are_not_opened_to_find_changed_ones(spark, loaded):
    out, second, first = loaded
    spoil(out, [MONTHS[0], MONTHS[2]])
    table = facility.fact_table(spark, fact_folder(out))
    version, landed = table.current(), job.facility.flag_valid(
        job.ex.flatten_data_values(job.ex.load_exports(spark, second)["data_values"]))
    valid = landed.filter("is_valid")
    digests = job.period_digests(valid, job.DIGESTED)
    assert job._months_to_load(table, version, valid, digests, True) == [MONTHS[1], MONTHS[3]]
    assert job._months_to_load(table, version, valid, digests, False) == [MONTHS[3]]
    spoil(out, MONTHS[:3])
    assert run(spark, first, out, INCREMENTAL) is False


def test_analytics_read_folds_and_only_anomalies_the_fact(spark, loaded):
    out, _, _ = loaded
    table = facility.fact_table(spark, fact_folder(out))
    fact, version = facility.read_fact(spark, table.path), table.current()
    folds = {name: table.read(version, schema, name) for name, (schema, _) in facility.FOLDS.items()}
    pairs = [
        (facility.month_over_month_change, "district_values"), (facility.rolling_three_month_average, "facility_values"),
        (facility.country_reporting_rate, "presence"), (facility.top_underreporting_facilities, "area_values"),
        (facility.global_volumes_by_quarter, "volumes"), (facility.data_element_coverage_matrix, "coverage"),
    ]
    want = [sorted(map(str, f(fact).collect())) for f, _ in pairs]
    scores = sorted(map(str, facility.completeness_comparison(fact).collect()))
    equal = sorted(map(str, facility.completeness_comparison(fact, equal_facilities=True).collect()))
    spoil(out, MONTHS[:3])
    assert [sorted(map(str, f(folds[name]).collect())) for f, name in pairs] == want
    assert sorted(map(str, facility.completeness_comparison(folds["scores"], weight="rows").collect())) == scores
    assert sorted(map(str, facility.completeness_comparison(folds["scores"], equal_facilities=True, weight="rows").collect())) == equal


def test_one_month_reads_one_load(spark, loaded):
    out, second, _ = loaded
    assert run(spark, second, out, INCREMENTAL)
    table = facility.fact_table(spark, fact_folder(out))
    version = table.current()
    assert version.number == 2 and len(set(version.months.values())) == 2
    one = facility.read_fact(spark, table.path, months=[MONTHS[0]])
    assert all(f"load={version.months[MONTHS[0]]}" in f for f in one.inputFiles())
    assert {r["year_month"] for r in one.collect()} == {MONTHS[0]}
    assert facility.read_fact(spark, table.path, months=[]).count() == 0


def test_plain_readers_see_the_current_rows_after_a_run(spark, loaded):
    out, second, _ = loaded
    assert run(spark, second, out, INCREMENTAL)
    plain = spark.read.parquet(fact_folder(out))
    assert plain.count() == facility.read_fact(spark, fact_folder(out)).count()
    assert len(glob.glob(f"{fact_folder(out)}/_versions/*.json")) == 1


def test_two_runs_do_not_publish_the_same_version(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), ["year_month"])
    assert table.current().months == {}
    one, two = (table.current().after(new_load(), ["202401"], keep=True) for _ in range(2))
    table.publish(one)
    with pytest.raises(FileExistsError):
        table.publish(two)
    assert table.current() == one
