"""Nested records written as JSON files, read and flattened."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.functions import flatten_columns
from lakeledger.plans.json_to_csv import flatten_json, flatten_json_to_csv
from lakeledger.session import scratch_path
from lakeledger.sinks.tables import write_csv
from lakeledger.sources.csv import read_csv_records
from lakeledger.sources.json import read_json_records, read_json_typed
from workload.base import query, table, write_array_files

RUN = datetime(2026, 5, 11)


def customers(spark, sf_dir) -> DataFrame:
    """Customers with their nation nested; keys differ between the segments."""
    nations = table(spark, sf_dir, "nation")
    joined = table(spark, sf_dir, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    building = F.col("c_mktsegment") == "BUILDING"
    return joined.select(
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("name"),
        F.struct(
            F.struct(
                F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")
            ).alias("nation"),
            F.when(building, F.col("c_mktsegment")).alias("segment"),
        ).alias("address"),
        F.array(F.col("c_mktsegment"), F.col("n_name")).alias("tags"),
        F.when(~building, F.col("c_acctbal")).alias("balance"),
    )


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


_FLAT = """
SELECT c_custkey AS key, c_name AS name, n_name AS address_nation_name,
       n_regionkey AS address_nation_region,
       CASE WHEN c_mktsegment = 'BUILDING' THEN c_mktsegment END AS address_segment,
       '["' || c_mktsegment || '","' || n_name || '"]' AS tags,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey"""
_FLAT_TEXT = f"SELECT * REPLACE (key::VARCHAR AS key, address_nation_region::VARCHAR AS address_nation_region, balance::VARCHAR AS balance) FROM ({_FLAT})"


@query("flatten_typed", _FLAT)
def flatten_typed(spark, sf_dir):
    path = scratch_path(spark, "arrays")
    nested = customers(spark, sf_dir)
    write_array_files(_as_text(nested), path, "value", 10_000)
    return flatten_columns(read_json_typed(spark, path, nested.schema))


@query("flatten_json", _FLAT_TEXT)
def flatten_json_query(spark, sf_dir):
    path = scratch_path(spark, "arrays")
    write_array_files(_as_text(customers(spark, sf_dir)), path, "value", 10_000)
    return flatten_json(read_json_records(spark, path))


@query("flatten_lines_to_csv", _FLAT_TEXT)
def flatten_lines_to_csv(spark, sf_dir):
    """The whole job on JSON Lines; its CSV is read back."""
    path, out = scratch_path(spark, "lines"), scratch_path(spark, "csv")
    customers(spark, sf_dir).write.json(path)
    result = flatten_json_to_csv(spark, path, out, RUN, lines=True)
    return spark.read.option("header", "true").option("escape", '"').csv(result.path)


@query(
    "flatten_single_csv",
    """
SELECT o_orderkey::VARCHAR AS key, o_orderpriority AS info_priority,
       'say "' || o_orderstatus || '", ' || chr(10) || 'ok' AS info_note,
       CASE WHEN o_orderstatus = 'F' THEN o_custkey::VARCHAR END AS customer, 1 AS files
FROM orders""",
)
def flatten_single_csv(spark, sf_dir):
    """The whole job into one CSV file with one header; quotes, commas and line ends inside cells."""
    path, out = scratch_path(spark, "order-lines"), scratch_path(spark, "single-csv")
    note = F.concat(F.lit('say "'), "o_orderstatus", F.lit('", \nok'))
    orders = table(spark, sf_dir, "orders")
    # Eight files, and more of them for more orders.
    files = 8 + orders.count() // 500_000
    orders.select(
        F.col("o_orderkey").alias("key"),
        F.struct(F.col("o_orderpriority").alias("priority"), note.alias("note")).alias("info"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).alias("customer"),
    ).repartition(files, "key").write.json(path)
    result = flatten_json_to_csv(spark, path, out, RUN, lines=True, single_file=True)
    read = read_csv_records(spark, result.path, result.columns)
    return read.withColumn("files", F.lit(len(spark.read.text(result.path).inputFiles())))


@query(
    "flatten_no_input",
    """
SELECT * FROM (VALUES ('no json here', 'NO_FILES', 0, 0::BIGINT, 0::BIGINT)) v(input, status, files, skipped, orders)
UNION ALL
SELECT 'broken files', 'NO_RECORDS', 4, 4, count(*) FROM orders WHERE o_orderkey % 2 = 0""",
)
def flatten_no_input(spark, sf_dir):
    """What the job says of a folder without JSON files, and of one whose files are all cut off."""
    orders = table(spark, sf_dir, "orders")
    text, broken = scratch_path(spark, "no-json"), scratch_path(spark, "all-broken")
    orders.select(F.to_json(F.struct("o_orderkey")).alias("value")).write.text(text)
    # Four arrays of different lengths, none of them closed.
    cut = orders.where("o_orderkey % 2 = 0").withColumn("part", F.col("o_orderkey") % 8)
    counted = cut.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    value = F.concat(F.lit("["), F.repeat(F.lit("1,"), F.col("n").cast("int")), F.lit('{"o_orderkey":'))
    counted.select("part", value.alias("value")).write.partitionBy("part").options(
        header="false", sep="\u0001", quote="\u0002", extension="json"
    ).csv(broken)
    orders_of = {"no json here": F.lit(0).cast("bigint"), "broken files": F.coalesce(F.sum("n"), F.lit(0))}
    rows = []
    for name, path in (("no json here", text), ("broken files", broken)):
        found = flatten_json_to_csv(spark, path, scratch_path(spark, "none"), RUN)
        rows.append(
            counted.agg(orders_of[name].alias("orders")).select(
                F.lit(name).alias("input"), F.lit(found.status).alias("status"), F.lit(found.files).alias("files"),
                F.lit(found.skipped).cast("bigint").alias("skipped"), "orders",
            )
        )
    return rows[0].unionByName(rows[1])


def _broken_lines(spark, sf_dir) -> str:
    """Every order as a JSON line; those of one status are cut off."""
    path = scratch_path(spark, "broken-lines")
    text = F.to_json(F.struct("o_orderkey", "o_totalprice"))
    table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "P", F.substring_index(text, ":", 1))
        .otherwise(text)
        .alias("value")
    ).write.text(path)
    return path


@query(
    "json_lines_malformed",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'",
)
def json_lines_malformed(spark, sf_dir):
    return read_json_typed(
        spark, _broken_lines(spark, sf_dir), "o_orderkey bigint, o_totalprice double", lines=True
    )


@query(
    "json_lines_skipped",
    "SELECT o_orderstatus = 'P' AS is_broken, count(*) AS line_count FROM orders GROUP BY 1",
)
def json_lines_skipped(spark, sf_dir):
    records = read_json_records(spark, _broken_lines(spark, sf_dir), lines=True)
    return records.groupBy("is_broken").agg(F.count(F.lit(1)).alias("line_count"))


@query(
    "union_columns",
    """
SELECT n_nationkey::VARCHAR AS key, n_name AS name, n_regionkey::VARCHAR AS region, NULL AS s_acctbal FROM nation
UNION ALL SELECT s_suppkey::VARCHAR, s_name, NULL, s_acctbal::VARCHAR FROM supplier
UNION ALL SELECT c_custkey::VARCHAR, c_name, NULL, NULL FROM customer""",
)
def union_columns(spark, sf_dir):
    """Files with different keys; the union of their columns."""
    path = scratch_path(spark, "union")
    table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("key"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").alias("region"),
    ).write.json(f"{path}/nation")
    table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), "s_acctbal"
    ).write.json(f"{path}/supplier")
    table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name")
    ).write.json(f"{path}/customer")
    return flatten_json(read_json_records(spark, path, lines=True))


@query(
    "csv_round_trip",
    """
SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderpriority,
       CASE WHEN o_orderstatus <> 'P' THEN '"' || o_orderstatus || '", ok' END AS note,
       o_totalprice::VARCHAR AS o_totalprice
FROM orders""",
)
def csv_round_trip(spark, sf_dir):
    note = F.concat(F.lit('"'), F.col("o_orderstatus"), F.lit('", ok'))
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        F.when(F.col("o_orderstatus") != "P", note).alias("note"),
        "o_totalprice",
    )
    path = write_csv(rows, scratch_path(spark, "orders-csv"), RUN)
    return spark.read.option("header", "true").option("escape", '"').csv(path)


@query(
    "flatten_dynamic_keys",
    """
SELECT 'k' || s_suppkey || '_name' AS column_name, s_name AS cell FROM supplier
UNION ALL SELECT 'k' || s_suppkey || '_place_nation', s_nationkey::VARCHAR FROM supplier
UNION ALL SELECT 'key', s_suppkey::VARCHAR FROM supplier""",
)
def flatten_dynamic_keys(spark, sf_dir):
    """A key of its own in every record; the flat table's filled cells."""
    path = scratch_path(spark, "dynamic-keys")
    own = F.to_json(
        F.struct(F.col("s_name").alias("name"), F.struct(F.col("s_nationkey").alias("nation")).alias("place"))
    )
    key = F.col("s_suppkey").cast("string")
    table(spark, sf_dir, "supplier").select(
        F.concat(F.lit('{"key":'), key, F.lit(',"k'), key, F.lit('":'), own, F.lit("}")).alias("value")
    ).write.text(path)
    # Columns are as many as records: as a wide table, nearly all of its cells would be empty.
    flat = flatten_json(read_json_records(spark, path, lines=True), sparse=True)
    return flat.select(F.explode_outer("cells").alias("column_name", "cell")).filter("cell IS NOT NULL")


@query(
    "flat_names",
    """
SELECT unnest(['a_b', 'key', 'tags_0']) AS column_name, (SELECT count(*) FROM supplier) AS filled""",
)
def flat_names(spark, sf_dir):
    """Sorted columns, and two paths with one name of which the later one counts."""
    path = scratch_path(spark, "flat-names")
    name = F.col("s_name")
    table(spark, sf_dir, "supplier").select(
        F.struct(name.alias("0")).alias("tags"),
        F.col("s_suppkey").alias("key"),
        F.when(F.col("s_suppkey") % 2 == 0, name).alias("a_b"),
        F.struct(F.when(F.col("s_suppkey") % 2 == 1, name).alias("b")).alias("a"),
    ).write.json(path)
    records = read_json_records(spark, path, lines=True)
    flat = flatten_json(records, order="sorted", on_collision="last")
    assert flat.columns == ["a_b", "key", "tags_0"]
    counts = flat.agg(*[F.count(c).alias(c) for c in flat.columns])
    return counts.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in flat.columns]))
    )
