"""Shift logs derived from the ``orders`` table, with every fault kind and repeated records.

The text is valid in Spark SQL and in DuckDB; ``{orders}`` names the input relation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# namespace of the business keys in all registered queries; any other would do
NAMESPACE = "3d1c5a60-2f0b-4c7e-9a51-6b8e0f4d2c17"

FX_SQL = """
WITH b AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS st, o_orderpriority AS pr,
         CAST(year(o_orderdate) AS STRING) AS y, CAST(month(o_orderdate) AS STRING) AS m,
         CAST(day(o_orderdate) AS STRING) AS dd,
         lpad(CAST(month(o_orderdate) AS STRING), 2, '0') AS m2,
         lpad(CAST(day(o_orderdate) AS STRING), 2, '0') AS d2,
         800 + o_custkey % 401 AS plan_q
  FROM {orders}),
o AS (
  SELECT b.*, 0 AS cp, k % 3 AS rn FROM b
  UNION ALL SELECT b.*, 1 AS cp, k % 3 AS rn FROM b WHERE k % 50 = 7
  UNION ALL SELECT b.*, 2 AS cp, (k + 1) % 3 AS rn FROM b WHERE k % 50 = 9)
SELECT
  CASE WHEN k % 101 = 0 THEN '' WHEN k % 103 = 0 THEN '2026-02-30' WHEN k % 107 = 0 THEN NULL
       WHEN k % 11 = 1 THEN y || '/' || m2 || '/' || d2
       WHEN k % 11 = 2 THEN y || '.' || m2 || '.' || d2
       WHEN k % 11 = 3 THEN d2 || '-' || m2 || '-' || y
       WHEN k % 11 = 4 THEN dd || '/' || m || '/' || y
       WHEN k % 11 = 5 THEN d2 || '.' || m2 || '.' || y
       WHEN k % 11 = 6 THEN ' ' || y || '-' || m || '-' || dd || ' '
       ELSE y || '-' || m2 || '-' || d2 END AS date,
  CASE WHEN k % 89 = 0 THEN 'D' WHEN k % 97 = 0 THEN NULL WHEN k % 13 = 0 THEN ' b '
       WHEN st = 'F' THEN 'A' WHEN st = 'O' THEN 'B' ELSE 'c' END AS shift,
  CASE WHEN k % 83 = 0 THEN '  ' WHEN k % 17 = 0 THEN ' Line1'
       ELSE 'Line' || CAST(1 + c % 4 AS STRING) END AS line,
  CASE WHEN k % 73 = 0 THEN CAST(-(k % 300) AS STRING) WHEN k % 79 = 0 THEN 'n/a'
       WHEN k % 19 = 0 THEN '1_000' ELSE CAST(plan_q AS STRING) END AS planned_output,
  CASE WHEN k % 71 = 0 THEN '-1' WHEN k % 67 = 0 THEN '12.5' WHEN k % 61 = 0 THEN '0'
       ELSE CAST(plan_q - k % 120 AS STRING) END AS actual_output,
  CASE WHEN k % 59 = 0 THEN '5000' WHEN k % 53 = 0 THEN '' WHEN k % 61 = 0 THEN '0'
       ELSE ' ' || CAST(k % 30 AS STRING) END AS defect_qty,
  CASE WHEN k % 47 = 0 THEN CAST(481 + k % 400 AS STRING) WHEN k % 43 = 0 THEN '-7'
       WHEN k % 41 = 0 THEN NULL WHEN pr = '5-LOW' THEN '0'
       ELSE '+' || CAST(10 + k % 110 AS STRING) END AS downtime_min,
  CASE WHEN pr = '1-URGENT' THEN 'Equipment Failure' WHEN pr = '2-HIGH' THEN 'Material Shortage'
       WHEN pr = '3-MEDIUM' THEN 'Changeover' WHEN pr = '5-LOW' THEN 'No Downtime'
       WHEN k % 5 = 0 THEN NULL ELSE 'Cleaning' END AS downtime_reason,
  'Operator ' || CAST(c % 5 AS STRING) AS operator,
  CASE WHEN cp = 1 THEN 'Duplicate CSV Upload' WHEN k % 3 = 0 THEN 'Google Form'
       WHEN k % 3 = 1 THEN 'Manual CSV Upload' ELSE 'Legacy Excel Log' END AS source_system,
  'shift_logs_' || CAST(rn AS STRING) || '.csv' AS source_file,
  3 * k + cp + 1 AS row_number,
  md5(CAST(k AS STRING) || '-' || CAST(cp AS STRING)) AS row_id,
  CASE WHEN rn = 0 THEN TIMESTAMP '2026-01-01 00:00:00'
       WHEN rn = 1 THEN TIMESTAMP '2026-01-02 00:00:00'
       ELSE TIMESTAMP '2026-01-03 00:00:00' END AS ingested_at,
  'records_2026010' || CAST(1 + rn AS STRING) || 'T000000Z_0000000' || CAST(rn AS STRING) AS run_id
FROM o
"""


def shift_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records (15 columns) over ``<sf_dir>/orders.parquet``."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return spark.sql(FX_SQL, orders=orders)
