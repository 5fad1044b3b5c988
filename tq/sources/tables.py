"""Input tables: the driver's Parquet tables and the portable ``dirty`` view.

``dirty`` is a wide all-text table with known defects, derived by Spark from
``orders`` joined to ``customer`` (one row per order), so its size grows with
the scale factor.  Its SQL runs unchanged in Spark SQL and DuckDB; the text is
built from integers on purpose (double-to-text differs between engines).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# fixed values: the portable dirty-table definition (shared with the DuckDB oracles)
DIRTY_SQL = """
SELECT
  CASE WHEN o_orderkey % 997 = 5 THEN concat('bad-', cast(o_orderkey AS string))
       WHEN o_orderkey % 499 = 7 THEN cast(o_orderkey - 1 AS string)
       WHEN o_orderkey % 1999 = 11 THEN '   '
       ELSE cast(o_orderkey AS string) END AS id,
  CASE WHEN o_orderkey % 11 = 0 THEN ''
       WHEN o_orderkey % 613 = 3 THEN concat('$-', cast(o_orderkey % 90 + 1 AS string), '.00')
       WHEN o_orderkey % 701 = 4 THEN 'n/a'
       WHEN o_orderkey % 503 = 2 THEN concat('$', cast(10 + o_orderkey % 30 AS string), ',',
                                             lpad(cast(o_orderkey % 1000 AS string), 3, '0'), '.50')
       ELSE concat('$', cast(20 + o_orderkey % 480 AS string), '.25') END AS price,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL
       WHEN o_orderkey % 809 = 6 THEN '33'
       WHEN o_orderkey % 811 = 14 THEN 'two'
       ELSE concat(' ', cast(o_orderkey % 8 + 1 AS string), ' ') END AS beds,
  CASE WHEN o_orderkey % 823 = 15 THEN '16'
       WHEN o_orderkey % 13 = 0 THEN ''
       ELSE cast(o_orderkey % 5 AS string) END AS bedrooms,
  CASE WHEN o_orderkey % 827 = 16 THEN '10.5'
       WHEN o_orderkey % 829 = 17 THEN '1,5'
       ELSE concat(cast(o_orderkey % 3 + 1 AS string), '.5') END AS bathrooms,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL
       WHEN o_orderkey % 911 = 8 THEN '7.5'
       WHEN o_orderkey % 307 = 9 THEN '0.0'
       ELSE concat('4.', cast(o_orderkey % 10 AS string)) END AS review_scores_rating,
  CASE WHEN o_orderkey % 853 = 18 THEN '-1'
       WHEN o_orderkey % 857 = 19 THEN 'good'
       WHEN o_orderkey % 311 = 20 THEN '0'
       ELSE concat('3.', cast(o_orderkey % 10 AS string)) END AS review_scores_cleanliness,
  CASE WHEN o_orderkey % 859 = 21 THEN '5.01'
       WHEN o_orderkey % 4 = 0 THEN ' '
       ELSE '5' END AS review_scores_location,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL
       WHEN o_orderkey % 863 = 22 THEN 'last summer'
       ELSE cast(cast(o_orderdate AS date) AS string) END AS first_review,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL
       WHEN o_orderkey % 601 = 10 THEN cast(cast(o_orderdate AS date) - 30 AS string)
       ELSE cast(cast(o_orderdate AS date) + 30 AS string) END AS last_review,
  CASE WHEN o_orderkey % 1201 = 12 THEN '40.71'
       ELSE concat('48.8', cast(o_orderkey % 10 AS string)) END AS latitude,
  CASE WHEN o_orderkey % 1301 = 13 THEN NULL
       ELSE concat('2.3', cast(o_orderkey % 10 AS string)) END AS longitude,
  CASE WHEN o_orderkey % 401 = 1 THEN '+33 6 12 34 56 78'
       WHEN o_orderkey % 3 = 0 THEN '' ELSE c_name END AS host_about,
  CASE WHEN o_orderkey % 450 = 0 THEN '1000'
       ELSE cast(o_orderkey % 28 + 1 AS string) END AS minimum_nights,
  CASE WHEN o_orderkey % 17 = 0 THEN 'T' WHEN o_orderkey % 9 = 0 THEN 't' ELSE 'f' END AS host_is_superhost,
  CASE WHEN o_orderkey % 19 = 0 THEN '' ELSE 't' END AS has_availability,
  CASE WHEN o_orderkey % 2 = 0 THEN '  ' ELSE NULL END AS calendar_updated
FROM orders JOIN customer ON o_custkey = c_custkey
"""
# end of fixed values


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def dirty(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """The dirty all-text table, planned by Spark from ``orders`` and ``customer``.

    Only the columns the view needs are read (column pruning reaches the scans).  ``partitions``: deal the orders
    out over so many tasks first; for a single small file, which is read by one task.
    """
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return spark.sql(DIRTY_SQL.replace("FROM orders JOIN customer", "FROM {orders} JOIN {customer}"),
                     orders=orders.repartition(partitions) if partitions else orders, customer=customer)
