"""Engineering sources derived from the generic test tables.

Each text is plain SQL that Spark and DuckDB read alike; names in braces are the given tables. The
derivation makes the dirt the layers must handle: padded and mixed-case codes, unreadable and
non-positive numbers, unknown codes, nulls, re-sent rows, equal start dates, several open revisions.
Every row of a source table yields rows here; nothing is sampled or cut.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partledger.context import RunContext
from partledger.sources import files

PLANT = RunContext("run-001", datetime(2002, 1, 1, 6, 0, 0))
DESIGN = RunContext("run-002", datetime(2024, 2, 1, 6, 0, 0))

# A part is quoted by up to four suppliers; every line item is one price notice of one of them.
RAW_COST = """
SELECT concat('P', q.l_partkey) AS part_id,
       concat(' ', lower(s.s_name), ' ') AS supplier_name,
       CASE WHEN q.l_partkey % 9 = 4 THEN 'n/a'
            WHEN q.l_linenumber = 1 AND q.l_quantity >= 49 THEN '0'
            WHEN q.l_linenumber = 2 AND q.l_quantity >= 50 THEN '-12.5'
            WHEN q.l_linenumber = 3 AND q.l_quantity >= 50 THEN NULL
            ELSE CAST(q.l_extendedprice AS STRING) END AS cost,
       CASE WHEN q.l_suppkey % 50 = 7 THEN NULL
            WHEN q.l_suppkey % 50 = 9 THEN 'xxx'
            WHEN q.l_partkey % 10 = 3 THEN 'gbp '
            WHEN s.s_suppkey % 5 = 0 THEN 'usd'
            WHEN s.s_suppkey % 5 = 1 THEN ' eur'
            ELSE 'inr' END AS currency,
       CAST(q.l_shipdate AS DATE) AS last_updated
FROM (SELECT l.*, (l_partkey + (l_suppkey % 4) * CAST(floor((SELECT count(*) FROM {supplier}) / 4) AS BIGINT))
                  % (SELECT count(*) FROM {supplier}) AS quoted_by
      FROM {lineitem} l) q
JOIN {supplier} s ON s.s_suppkey = q.quoted_by
"""

RAW_BOM = """
SELECT concat('A', l_orderkey) AS assembly_id,
       concat(' P', l_partkey) AS part_id,
       CASE WHEN l_linenumber = 7 AND l_quantity < 3 THEN 0
            WHEN l_linenumber = 6 AND l_quantity < 2 THEN NULL
            ELSE CAST(l_quantity AS INT) END AS quantity,
       l_shipdate AS last_modified
FROM {lineitem}
"""

RAW_REVISIONS = """
WITH yearly AS (
  SELECT l_partkey AS p, year(l_shipdate) AS y, min(CAST(l_shipdate AS DATE)) AS first_ship,
         max(l_shipdate) AS last_ship, count(*) AS n
  FROM {lineitem} GROUP BY l_partkey, year(l_shipdate)),
chained AS (SELECT *, lead(first_ship) OVER (PARTITION BY p ORDER BY y) AS next_ship FROM yearly),
told AS (
  SELECT concat('P', p) AS part_id, concat(' r', y) AS revision,
         CASE WHEN (p + y) % 23 = 0 THEN 'scrapped'
              WHEN (p + y) % 29 = 0 THEN NULL
              WHEN n % 4 = 0 THEN 'draft'
              WHEN n % 4 = 1 THEN 'in review'
              ELSE 'released' END AS status,
         CASE WHEN (p + y) % 31 = 0 THEN NULL
              WHEN p % 41 = 7 THEN CAST(concat(y - y % 2, '-01-01') AS DATE)
              ELSE first_ship END AS effective_from,
         CASE WHEN p % 37 = 5 AND y >= 2000 THEN NULL ELSE next_ship END AS effective_to,
         last_ship AS last_modified, n
  FROM chained)
SELECT part_id, revision, status, effective_from, effective_to, last_modified FROM told
UNION ALL
SELECT part_id, revision, 'draft' AS status, effective_from, effective_to,
       last_modified - INTERVAL 1 DAY AS last_modified
FROM told WHERE n % 5 = 0
"""

RAW_CAD = """
SELECT CASE WHEN event_type = 'error' AND user_id % 10 = 3 THEN NULL ELSE concat(' P', user_id, ' ') END AS part_id,
       p_name AS part_name,
       concat(' ', p_type) AS material,
       CASE WHEN event_type = 'click' AND value < 1 THEN 'heavy'
            ELSE CAST(CAST(value AS DECIMAL(18,2)) AS STRING) END AS weight_kg,
       concat('designer ', event_type) AS designer,
       CAST(CAST(ts AS DATE) AS STRING) AS created_date,
       concat('/landing/cad/cad_metadata_',
              CASE WHEN event_type = 'signup' AND user_id % 10 = 9 THEN 'adhoc'
                   WHEN event_type = 'view' THEN replace(CAST(CAST(ts AS DATE) AS STRING), '-', '_')
                   ELSE CAST(CAST(ts AS DATE) AS STRING) END, '.csv') AS _source_file
FROM {events} LEFT JOIN {part} ON p_partkey = user_id
"""

RAW_AUDIT = """
SELECT CAST(ts AS DATE) AS event_date, ts AS event_time,
       CASE WHEN event_id % 7 = 0 THEN 'jobs' ELSE 'tables' END AS service_name,
       concat('user', user_id) AS user_identity,
       CASE event_type WHEN 'view' THEN 'getTable' WHEN 'click' THEN 'selectFromTable'
                       WHEN 'purchase' THEN 'updateTable' WHEN 'signup' THEN 'createTable'
                       ELSE 'listTables' END AS action_name,
       concat(CASE WHEN k % 10 = 0 THEN 'sandbox' ELSE 'plant' END, '.gold.t', k % 25) AS full_name_arg,
       CASE WHEN k % 13 = 0 THEN 403 ELSE 200 END AS status_code
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM {events}) e
"""

# Event order is the sequence number; an error event deletes its key.
RAW_CDC = """
SELECT event_id AS lsn, user_id AS part_no, CAST(CAST(value AS DECIMAL(18,2)) AS STRING) AS reading,
       CASE WHEN event_type = 'error' THEN 'delete' WHEN event_type = 'signup' THEN 'insert' ELSE 'update' END AS op
FROM {events}
"""

# A ledger of hourly loads: one per event type (as the feed) and event.
RAW_RUNS = """
SELECT concat(upper(event_type), '_LOAD') AS pipeline_name, concat('run_', event_id) AS run_id,
       CASE WHEN value < 2 THEN 'FAILED' WHEN value < 4 THEN 'RUNNING' ELSE 'SUCCESS' END AS status,
       ts AS last_updated, CAST(floor(value * 400) AS BIGINT) AS duration_seconds
FROM {events}
"""

SUPPLIER_SITES = """
SELECT trim(upper(s_name)) AS supplier_name, n_name AS location
FROM {supplier} LEFT JOIN {nation} ON n_nationkey = s_nationkey
"""

RAW = {
    "raw_cost": RAW_COST, "raw_bom": RAW_BOM, "raw_revisions": RAW_REVISIONS, "raw_cad": RAW_CAD,
    "raw_audit": RAW_AUDIT, "raw_cdc": RAW_CDC, "raw_runs": RAW_RUNS, "supplier_sites": SUPPLIER_SITES,
}
GIVEN = ("lineitem", "supplier", "nation", "part", "events", "orders", "customer")


def given(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return files.parquet_table(spark, f"{folder}/{table}.parquet")


def derive(spark: SparkSession, name: str, table: Callable[[str], DataFrame]) -> DataFrame:
    text = RAW[name]
    return spark.sql(text, **{t: table(t) for t in GIVEN if "{" + t + "}" in text})


def raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return derive(spark, name, lambda t: given(spark, folder, t))


def nested_audit(flat: DataFrame) -> DataFrame:
    """The audit log in its nested source shape."""
    return flat.select(
        "event_date", "event_time", "service_name", "user_identity", "action_name",
        F.struct("full_name_arg").alias("request_params"), F.struct("status_code").alias("response"))
