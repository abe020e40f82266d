"""Data quality reports on the order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeledger.operators.quality import (
    date_coverage,
    key_duplicates,
    key_duplicates_after,
    key_orphans,
    key_orphans_after,
    populated_share,
)
from workload.base import query, table


@query(
    "populated_share",
    """
SELECT source, count(*) AS row_count, count(quality) AS populated_count,
       count(quality) * 1.0::DOUBLE / count(*) AS populated_share
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source""",
)
def populated_share_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return populated_share(docs.join(labels, "doc_id", "left"), ["source"], "quality")


@query(
    "date_coverage",
    """
WITH days AS (SELECT DISTINCT o_orderpriority, o_orderdate::DATE AS day FROM orders),
span AS (SELECT o_orderpriority, min(day) AS first, max(day) AS last FROM days GROUP BY 1),
expected AS (
  SELECT o_orderpriority, unnest(generate_series(first, last, INTERVAL 1 DAY))::DATE AS day
  FROM span)
SELECT o_orderpriority, day AS missing_date FROM expected
EXCEPT SELECT o_orderpriority, day FROM days""",
)
def date_coverage_query(spark, sf_dir):
    return date_coverage(table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_orderdate")


@query(
    "pk_duplicates",
    """
SELECT l_orderkey, l_linenumber, count(*) AS row_count
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def pk_duplicates(spark, sf_dir):
    return key_duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "fk_orphans",
    """
SELECT l_orderkey, count(*) AS row_count FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders
                  WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')
GROUP BY 1""",
)
def fk_orphans(spark, sf_dir):
    """Lines whose order is not among the closed or open ones."""
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'")
    lines = table(spark, sf_dir, "lineitem")
    return key_orphans(lines, orders, ["l_orderkey"], ["o_orderkey"]).select(
        "l_orderkey", F.col("row_count")
    )


@query(
    "pk_duplicates_of_loads",
    """
SELECT l_orderkey, l_linenumber, count(*) AS row_count
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def pk_duplicates_of_loads(spark, sf_dir):
    """The full report from that of the first years and the lines shipped since."""
    keys = ["l_orderkey", "l_linenumber"]
    lines = table(spark, sf_dir, "lineitem")
    stored, appended = lines.filter("l_shipdate < '2000-01-01'"), lines.filter("l_shipdate >= '2000-01-01'")
    return key_duplicates_after(key_duplicates(stored, keys), appended, stored, keys)


@query(
    "fk_orphans_of_loads",
    """
SELECT l_orderkey, count(*) AS row_count FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders
                  WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')
GROUP BY 1""",
)
def fk_orphans_of_loads(spark, sf_dir):
    """The full report from that of the first years, the lines shipped since and all orders.

    The first report was made without the open orders, which the load brings too.
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'")
    stored, appended = lines.filter("l_shipdate < '2000-01-01'"), lines.filter("l_shipdate >= '2000-01-01'")
    before = key_orphans(stored, orders.filter("o_orderstatus <> 'O'"), ["l_orderkey"], ["o_orderkey"])
    return key_orphans_after(before, appended, orders, ["l_orderkey"], ["o_orderkey"])
