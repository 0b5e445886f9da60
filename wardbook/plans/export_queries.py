"""The export readers as queries: documents written as JSON files from the driver tables, loaded and flattened.

Most documents hold a handful of records. Some are empty, lack a field, have no groups, carry a
time stamp that does not parse or a user name in mixed case. Big ones hold those of many orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardbook.sources import exports as ex
from wardbook.sources.tables import query_workspace


def _loaded(spark: SparkSession, name: str, records: DataFrame, document: Column, record: Column, field: str) -> DataFrame:
    """An export of the records with one ``document`` key per line, written and loaded; a null record is left out."""
    grouped = records.groupBy(document.alias("document")).agg(F.collect_list(record).alias(field))
    folder = query_workspace(spark).folder
    grouped.select(F.to_json(F.struct(field))).write.text(f"{folder}/{ex.FILES[name]}")
    return ex.load_export(spark, folder, name)


def _stamp(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSS")


def _as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def flatten_data_values(spark: SparkSession, read) -> DataFrame:
    """Order lines as observations, a document per order; keys that are multiples of seven give empty documents."""
    lines = read("lineitem")
    record = F.when(F.col("l_orderkey") % 7 > 0, F.struct(
        F.col("l_partkey").cast("string").alias("dataElement"),
        F.date_format("l_shipdate", "yyyyMM").alias("period"),
        F.concat(F.lit("S"), "l_suppkey").alias("orgUnit"),
        F.nullif("l_returnflag", F.lit("N")).alias("categoryOptionCombo"),
        F.col("l_linestatus").alias("attributeOptionCombo"),
        F.col("l_quantity").cast("long").cast("string").alias("value"),
        F.concat(F.lit("User"), "l_returnflag").alias("storedBy"),
        _stamp("l_shipdate").alias("created"),
        F.when(F.col("l_linenumber") == 3, F.lit("soon")).otherwise(_stamp("l_shipdate")).alias("lastUpdated"),
    ))
    documents = _loaded(spark, "data_values", lines, F.col("l_orderkey"), record, "dataValues")
    return _as_text(ex.flatten_data_values(documents), "created_at", "last_updated_at")


#: Order keys whose lines share a big document.
ORDERS_A_DOCUMENT = 20_000


def _document_lines(records: DataFrame) -> DataFrame:
    """Pretty-printed documents as a row per record, so that no task holds a whole one.

    The first record of a document comes with what begins it, the last with what ends it.
    """
    at = Window.partitionBy("document").orderBy("document")
    begin = F.when(F.row_number().over(at) == 1, F.lit('{\n  "version": "2",\n  "dataValues": [\n    ')).otherwise(F.lit("    "))
    end = F.when(F.lead(F.lit(True)).over(at).isNull(), F.lit("\n  ]\n}")).otherwise(F.lit(","))
    return records.select("document", F.concat(begin, "record", end).alias("text"))


def _split_export(spark: SparkSession, read, user: Column) -> DataFrame:
    """Order lines as observations in few big documents, a pretty-printed file each, cut into records."""
    record = F.struct(
        F.col("l_partkey").cast("string").alias("dataElement"), F.date_format("l_shipdate", "yyyyMM").alias("period"),
        F.concat(F.lit("S"), "l_suppkey").alias("orgUnit"), F.col("l_quantity").cast("long").cast("string").alias("value"),
        user.alias("storedBy"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("followup"),
    )
    records = read("lineitem").select(
        F.floor(F.col("l_orderkey") / ORDERS_A_DOCUMENT).alias("document"), F.to_json(record).alias("record"))
    documents = _document_lines(records)
    work = query_workspace(spark)
    documents.write.partitionBy("document").text(f"{work.folder}/{ex.FILES['data_values']}")
    found = ex.flatten_data_values(ex.load_export(spark, work.folder, "data_values", split_data_values=True, work=work))
    return _as_text(found, "created_at", "last_updated_at")


def split_export(spark: SparkSession, read) -> DataFrame:
    return _split_export(spark, read, F.concat(F.lit("User"), "l_returnflag"))


def split_export_braces(spark: SparkSession, read) -> DataFrame:
    """User names look like the border between two records, so pieces are put together again."""
    return _split_export(spark, read, F.concat(F.lit('},{"dataElement":{'), "l_returnflag", F.lit("}]}")))


def _metadata(spark: SparkSession, read) -> DataFrame:
    part = read("part")
    words = F.split("p_type", " ")
    record = F.struct(
        F.concat(F.lit("P"), "p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.when(F.col("p_size") > 10, F.lit("NUMBER")).alias("valueType"), F.lit("AGGREGATE").alias("domainType"),
        F.when(F.col("p_size") % 2 == 0, F.lit("SUM")).otherwise(F.lit("AVERAGE")).alias("aggregationType"),
        (F.col("p_size") > 25).alias("zeroIsSignificant"),
        F.when(F.col("p_size") % 3 > 0, F.struct(F.col("p_brand").alias("id"), F.lower("p_brand").alias("name"))).alias("categoryCombo"),
        F.when(F.col("p_size") % 5 > 0, F.transform(words, lambda w: F.struct(F.lower(w).alias("id"), w.alias("name"))))
        .otherwise(F.array().cast("array<struct<id:string,name:string>>")).alias("dataElementGroups"),
    )
    return _loaded(spark, "metadata", part, F.floor(F.col("p_partkey") / 20), record, "dataElements")


def flatten_indicators(spark: SparkSession, read) -> DataFrame:
    """Parts as indicators; the first word of the type is the area, where there are groups."""
    return ex.flatten_indicators(_metadata(spark, read))


def flatten_category_options(spark: SparkSession, read) -> DataFrame:
    """Suppliers as category options."""
    record = F.struct(F.concat(F.lit("S"), "s_suppkey").alias("id"), F.when(F.col("s_acctbal") > 0, F.col("s_name")).alias("name"))
    documents = _loaded(spark, "metadata", read("supplier"), F.col("s_nationkey"), record, "categoryOptionCombos")
    return ex.flatten_category_options(documents)


def flatten_org_units(spark: SparkSession, read) -> DataFrame:
    """Customers under their nation, in groups by segment and by debt."""
    customer = read("customer")
    node, parent = F.concat(F.lit("C"), "c_custkey"), F.concat(F.lit("N"), "c_nationkey")
    groups = F.filter(F.array(F.col("c_mktsegment"), F.when(F.col("c_acctbal") < 0, F.lit("in debt"))), lambda g: g.isNotNull())
    record = F.struct(
        node.alias("id"), F.col("c_name").alias("name"), F.lit(2).alias("level"),
        F.concat(F.lit("/"), parent, F.lit("/"), node).alias("path"),
        F.when(F.col("c_custkey") % 9 > 0, F.struct(parent.alias("id"))).alias("parent"),
        F.when(F.col("c_custkey") % 4 > 0, F.transform(groups, lambda g: F.struct(g.alias("name")))).alias("groups"),
    )
    documents = _loaded(spark, "org_units", customer, F.floor(F.col("c_custkey") / 20), record, "organisationUnits")
    return ex.flatten_org_units(documents)


def _programs(spark: SparkSession, read) -> DataFrame:
    """Brands as programs that expect their part types; those of one size expect nothing."""
    programs = read("part").groupBy("p_brand", "p_size").agg(F.sort_array(F.collect_set("p_type")).alias("types"))
    record = F.struct(
        F.concat_ws("/", "p_brand", F.col("p_size").cast("string")).alias("id"), F.col("p_brand").alias("name"),
        F.substring("p_brand", 1, 7).alias("healthArea"), F.when(F.col("p_size") > 5, F.lit("Alpha")).alias("country"),
        F.lit("Monthly").alias("reportingFrequency"),
        F.when(F.col("p_size") == 1, F.array().cast("array<string>")).otherwise(F.col("types")).alias("dataElements"),
    )
    return ex.flatten_programs(_loaded(spark, "programs", programs, F.col("p_brand"), record, "programs"))


def flatten_programs(spark: SparkSession, read) -> DataFrame:
    return _programs(spark, read).withColumn("program_data_elements", F.array_join("program_data_elements", "|"))


def flatten_program_indicators(spark: SparkSession, read) -> DataFrame:
    return ex.program_indicators(_programs(spark, read))


QUERIES = {
    f.__name__: f for f in (
        flatten_data_values, split_export, split_export_braces, flatten_indicators, flatten_category_options, flatten_org_units, flatten_programs,
        flatten_program_indicators,
    )
}
