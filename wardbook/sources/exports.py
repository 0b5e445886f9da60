"""Nested JSON exports: their schemas, reading them, and flattening them to tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardbook.operators.latest import unique_lookup
from wardbook.operators.records import explode_records
from wardbook.sources.splitting import read_split_documents
from wardbook.sources.tables import Workspace

# Export file names and the fields of their documents and records.
FILES = {
    "data_values": "data_values.json",
    "metadata": "metadata.json",
    "org_units": "org_units.json",
    "programs": "programs.json",
}

DATA_VALUE_FIELDS = """
    dataElement string, period string, orgUnit string, categoryOptionCombo string,
    attributeOptionCombo string, value string, storedBy string, created string,
    lastUpdated string, followup string
"""
DATA_VALUES_DOCUMENT = f"""
    responseType string, version string, exportDate string,
    dataValues array<struct<{DATA_VALUE_FIELDS}>>
"""
METADATA_DOCUMENT = """
    date string, version string,
    dataElements array<struct<
        id string, name string, shortName string, code string, valueType string,
        domainType string, aggregationType string, zeroIsSignificant boolean,
        categoryCombo struct<id string, name string>,
        dataElementGroups array<struct<id string, name string>>,
        created string, lastUpdated string>>,
    categoryOptionCombos array<struct<id string, name string, created string, lastUpdated string>>
"""
ORG_UNITS_DOCUMENT = """
    date string, version string,
    organisationUnits array<struct<
        id string, name string, shortName string, code string, level int, path string,
        parent struct<id string, name string>, groups array<struct<id string, name string>>,
        created string, lastUpdated string>>
"""
PROGRAMS_DOCUMENT = """
    date string, version string,
    programs array<struct<
        id string, name string, shortName string, healthArea string, country string,
        reportingFrequency string, dataElements array<string>, created string, lastUpdated string>>
"""

DOCUMENTS = {
    "data_values": DATA_VALUES_DOCUMENT,
    "metadata": METADATA_DOCUMENT,
    "org_units": ORG_UNITS_DOCUMENT,
    "programs": PROGRAMS_DOCUMENT,
}

CORRUPT = "_corrupt_record"


def read_documents(
    spark: SparkSession, path: str, schema: str, multi_line: bool = False, keep_corrupt: bool = False
) -> DataFrame:
    """JSON documents, one per line, or one pretty-printed per file with ``multi_line``.

    A document that does not parse gives a row of nulls, with its text in an extra column if
    ``keep_corrupt`` is set. ``path`` may be a folder of files, which then load in parallel.
    """
    if keep_corrupt:
        schema = f"{schema}, {CORRUPT} string"
    reader = spark.read.schema(schema).option("multiLine", multi_line).option("mode", "PERMISSIVE")
    return reader.option("columnNameOfCorruptRecord", CORRUPT).json(path)


def read_data_value_lines(spark: SparkSession, path: str) -> DataFrame:
    """Bare data-value records as JSON Lines: a single big file splits over many tasks.

    Shaped like a document with a one-record array, so the same flattening applies. A line
    that does not parse becomes a record of nulls and lands in quarantine.
    """
    lines = spark.read.schema(DATA_VALUE_FIELDS).json(path)
    return lines.select(F.array(F.struct("*")).alias("dataValues"))


def read_split_data_values(spark: SparkSession, path: str, work: Workspace | None = None) -> DataFrame:
    """Data-value documents of any size and layout, each read by many tasks."""
    names = [field.split()[0] for field in DATA_VALUE_FIELDS.split(",")]
    return read_split_documents(spark, path, "dataValues", names, DATA_VALUE_FIELDS, work)


def load_export(
    spark: SparkSession,
    data_dir: str,
    name: str,
    multi_line: bool = False,
    data_values_as_lines: bool = False,
    keep_corrupt: bool = False,
    split_data_values: bool = False,
    work: Workspace | None = None,
) -> DataFrame:
    """One of the exports of a data folder; the options from ``data_values_as_lines`` on concern data values.

    ``split_data_values`` cuts documents into records, so that many tasks read one document,
    and ``work`` holds its pieces where they are not records; ``keep_corrupt`` is for documents that are read whole.
    """
    path = f"{data_dir}/{FILES[name]}"
    if name == "data_values":
        if data_values_as_lines and split_data_values:
            raise ValueError("data values are either lines or documents to split")
        if data_values_as_lines:
            return read_data_value_lines(spark, path)
        if split_data_values:
            return read_split_data_values(spark, path, work)
    return read_documents(spark, path, DOCUMENTS[name], multi_line, keep_corrupt and name == "data_values")


def load_exports(spark: SparkSession, data_dir: str, **options: bool | Workspace) -> dict[str, DataFrame]:
    """The four exports of a data folder by name, under the options of ``load_export``."""
    return {name: load_export(spark, data_dir, name, **options) for name in FILES}


def flatten_data_values(documents: DataFrame) -> DataFrame:
    """One row per observation. Timestamps that do not parse are null.

    The text of documents that do not parse stays, if it was read.
    """
    return explode_records(documents, "dataValues", {
        "data_element_uid": "record.dataElement",
        "period": "record.period",
        "org_unit_uid": "record.orgUnit",
        "category_option_combo_uid": "record.categoryOptionCombo",
        "attribute_option_combo_uid": "record.attributeOptionCombo",
        "raw_value": "record.value",
        "stored_by": F.lower("record.storedBy"),
        "created_at": F.try_to_timestamp(F.col("record.created")),
        "last_updated_at": F.try_to_timestamp(F.col("record.lastUpdated")),
        "followup": "record.followup",
    }, keep=[c for c in documents.columns if c == CORRUPT])


def flatten_indicators(metadata: DataFrame) -> DataFrame:
    """One row per indicator; its health area is the name of its first group, if it has one."""
    return explode_records(metadata, "dataElements", {
        "data_element_uid": "record.id",
        "data_element_name": "record.name",
        "value_type": "record.valueType",
        "domain_type": "record.domainType",
        "aggregation_type": "record.aggregationType",
        "zero_is_significant": "record.zeroIsSignificant",
        "category_combo_uid": "record.categoryCombo.id",
        "category_combo_name": "record.categoryCombo.name",
        "health_area": F.get("record.dataElementGroups", 0)["name"],
    })


def flatten_category_options(metadata: DataFrame) -> DataFrame:
    return explode_records(metadata, "categoryOptionCombos", {
        "category_option_combo_uid": "record.id",
        "category_option_combo_name": "record.name",
    })


def flatten_org_units(org_units: DataFrame) -> DataFrame:
    """One row per node of the organisation tree, group names joined by commas."""
    return explode_records(org_units, "organisationUnits", {
        "org_unit_uid": "record.id",
        "org_unit_name": "record.name",
        "org_unit_level": "record.level",
        "org_unit_path": "record.path",
        "parent_org_unit_uid": "record.parent.id",
        "org_unit_groups": F.concat_ws(",", F.col("record.groups.name")),
    })


def flatten_programs(programs: DataFrame) -> DataFrame:
    return explode_records(programs, "programs", {
        "program_uid": "record.id",
        "program_name": "record.name",
        "program_health_area": "record.healthArea",
        "program_country": "record.country",
        "reporting_frequency": "record.reportingFrequency",
        "program_data_elements": "record.dataElements",
    })


def program_indicators(programs: DataFrame) -> DataFrame:
    """The bridge from programs to the indicators they expect."""
    return explode_records(
        programs, "program_data_elements", {"data_element_uid": "record"},
        keep=["program_uid", "program_name", "program_health_area", "program_country"],
    )


def known(df: DataFrame, key: str) -> DataFrame:
    """A lookup ready to join: one row per key, and no row for the null of an empty export."""
    return unique_lookup(df.filter(F.col(key).isNotNull()), [key])
