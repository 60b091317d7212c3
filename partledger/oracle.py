"""The same answers in DuckDB's SQL, written from the contract rather than from the Spark plans.

A query is a body over named common table expressions; ``sql`` puts the needed ones in front.
"""

from __future__ import annotations

import re

from partledger.context import CURRENCIES, REASON_COST, REASON_CURRENCY, REASON_NO_PART, REASON_NO_START
from partledger.context import REASON_QUANTITY, REASON_STATUS, STATUSES
from partledger.fixtures import GIVEN, RAW
from partledger.plans import serving


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values: list[str]) -> str:
    return ", ".join(text(v) for v in values)


def pct(part: str, whole: str) -> str:
    """100·part/whole to two places, halves up, in whole numbers."""
    return f"CAST((({part}) * 20000 + ({whole})) // (2 * ({whole})) AS DOUBLE) / 100"


def money(value: str) -> str:
    return f"CAST({value} AS DECIMAL(38,4))"


def mean4(total: str, n: str) -> str:
    """total/n to four places, halves up, in whole numbers."""
    units = f"(CAST(({total}) * 10000 AS HUGEINT) * 2 + ({n})) // (2 * ({n}))"
    return money(f"CAST({units} AS DECIMAL(22,0)) * CAST(0.0001 AS DECIMAL(5,4))")


def days(start: str, end: str) -> str:
    return f"date_diff('day', CAST({start} AS DATE), CAST({end} AS DATE))"


def file_day(column: str) -> str:
    return f"TRY_CAST(replace(regexp_extract({column}, 'cad_metadata_(\\d{{4}}[-_]\\d{{2}}[-_]\\d{{2}})', 1), '_', '-') AS DATE)"


def newest(keys: str, order: str) -> str:
    order = ", ".join(f"{c.strip()} DESC NULLS LAST" for c in order.split(","))
    return f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"


PLANT_TS = "TIMESTAMP '2002-01-01 06:00:00'"
PLANT_DAY = "DATE '2002-01-01'"
DESIGN_TS = "TIMESTAMP '2024-02-01 06:00:00'"

CTES: dict[str, str] = {name: sql.format(**{t: t for t in GIVEN}) for name, sql in RAW.items()}
CTES |= {
    # Silver
    "judged_cad": f"""
SELECT trim(part_id) AS part_id, trim(part_name) AS part_name, trim(material) AS material,
       TRY_CAST(trim(weight_kg) AS DECIMAL(18,4)) AS weight_kg, trim(designer) AS designer,
       TRY_CAST(trim(created_date) AS DATE) AS created_date, _source_file, {file_day('_source_file')} AS file_date,
       CASE WHEN part_id IS NULL THEN {text(REASON_NO_PART)} END AS reason
FROM raw_cad""",
    "silver_cad": f"""
SELECT part_id, part_name, material, weight_kg, designer, created_date, file_date FROM judged_cad WHERE reason IS NULL
{newest('part_id', 'file_date, _source_file, created_date, designer, material, part_name, weight_kg')}""",
    "judged_rev": f"""
SELECT *, CASE WHEN effective_from IS NULL THEN {text(REASON_NO_START)}
               WHEN status IS NULL OR status NOT IN ({listed(STATUSES)}) THEN {text(REASON_STATUS)} END AS reason
FROM (SELECT trim(part_id) AS part_id, trim(upper(revision)) AS revision,
             CASE status WHEN 'draft' THEN 'Draft' WHEN 'in review' THEN 'In Review' WHEN 'released' THEN 'Released'
                         WHEN 'scrapped' THEN 'Scrapped' END AS status,
             CAST(effective_from AS TIMESTAMP) AS effective_from, CAST(effective_to AS TIMESTAMP) AS effective_to,
             last_modified
      FROM raw_revisions)""",
    "silver_rev": f"""
SELECT part_id, revision, status, effective_from, effective_to, last_modified,
       effective_to IS NULL AS is_current_revision,
       {days('effective_from', f'coalesce(CAST(effective_to AS DATE), {PLANT_DAY})')} AS revision_duration_days
FROM judged_rev WHERE reason IS NULL
{newest('part_id, revision', 'last_modified, effective_from, effective_to, status')}""",
    "open_rev": f"""
SELECT part_id, revision, status, effective_from, effective_to, revision_duration_days
FROM silver_rev WHERE is_current_revision {newest('part_id', 'effective_from, revision')}""",
    "judged_bom": f"""
SELECT trim(assembly_id) AS assembly_id, trim(part_id) AS part_id, quantity, last_modified,
       CASE WHEN quantity IS NULL OR quantity <= 0 THEN {text(REASON_QUANTITY)} END AS reason
FROM raw_bom""",
    "bom_lines": f"""
SELECT assembly_id, part_id, quantity, last_modified FROM judged_bom WHERE reason IS NULL
{newest('assembly_id, part_id', 'last_modified, quantity')}""",
    "silver_bom": """
SELECT b.*, o.revision AS current_revision, o.status AS current_status, o.part_id IS NOT NULL AS has_active_revision
FROM bom_lines b LEFT JOIN open_rev o USING (part_id)""",
    "judged_cost": f"""
SELECT *, CASE WHEN cost IS NULL OR cost <= 0 THEN {text(REASON_COST)}
               WHEN currency IS NULL OR currency NOT IN ({listed(CURRENCIES)}) THEN {text(REASON_CURRENCY)} END AS reason
FROM (SELECT trim(part_id) AS part_id, trim(upper(supplier_name)) AS supplier_name,
             TRY_CAST(cost AS DECIMAL(18,4)) AS cost, trim(upper(currency)) AS currency,
             CAST(last_updated AS TIMESTAMP) AS last_updated
      FROM raw_cost)""",
    "silver_cost": f"""
SELECT part_id, supplier_name, cost, currency, last_updated FROM judged_cost WHERE reason IS NULL
{newest('part_id, supplier_name', 'last_updated, cost, currency')}""",
    "pcv": f"""
SELECT b.part_id, b.assembly_id, b.quantity, b.current_revision, b.has_active_revision, o.revision, o.status,
       o.effective_from, o.effective_to, o.revision_duration_days, c.supplier_name, c.cost, c.currency, c.last_updated,
       {money('c.cost * b.quantity')} AS total_assembly_cost, c.cost IS NOT NULL AS cost_data_available,
       o.revision IS NOT NULL AS revision_data_available
FROM silver_bom b LEFT JOIN open_rev o USING (part_id) LEFT JOIN silver_cost c USING (part_id)""",
    # Gold
    "positioned": """
SELECT part_id, supplier_name, currency, cost, rank() OVER w = 1 AS is_lowest_cost_supplier,
       CAST(cost - min(cost) OVER (PARTITION BY part_id, currency) AS DECIMAL(18,4)) AS cost_vs_cheapest
FROM silver_cost WINDOW w AS (PARTITION BY part_id, currency ORDER BY cost)""",
    "per_part_currency": """
SELECT part_id, currency, count(*) AS n, min(cost) AS low, max(cost) AS high, sum(cost) AS total
FROM silver_cost GROUP BY part_id, currency""",
    "main_price": """
SELECT part_id, currency, low AS min_cost, high AS max_cost, sum(n) OVER (PARTITION BY part_id) AS supplier_count
FROM per_part_currency QUALIFY row_number() OVER (PARTITION BY part_id ORDER BY n DESC, currency) = 1""",
    "dim_part": """
SELECT o.part_id, o.revision AS current_revision, o.status AS current_status, o.effective_from AS current_effective_from,
       o.revision_duration_days AS current_revision_age_days, r.total_revision_count, r.first_released_at,
       r.last_revision_change_at, CAST(m.supplier_count AS BIGINT) AS supplier_count, m.min_cost, m.max_cost, m.currency,
       m.supplier_count > 1 AS has_multi_supplier, CAST(m.max_cost - m.min_cost AS DECIMAL(18,4)) AS cost_spread
FROM open_rev o
LEFT JOIN (SELECT part_id, count(revision) AS total_revision_count, min(effective_from) AS first_released_at,
                  max(last_modified) AS last_revision_change_at FROM silver_rev GROUP BY part_id) r USING (part_id)
LEFT JOIN main_price m USING (part_id)""",
    "dim_supplier": f"""
SELECT supplier_name, currency, count(*) AS parts_supplied, {money('sum(cost)')} AS total_listed_cost,
       {mean4('sum(cost)', 'count(*)')} AS avg_cost_per_part, min(cost) AS min_part_cost, max(cost) AS max_part_cost,
       max(last_updated) AS last_price_update_at, count(*) > 1 AS is_multi_part_supplier
FROM silver_cost GROUP BY supplier_name, currency""",
    "fact": """
SELECT v.assembly_id, v.part_id, v.supplier_name, v.revision, v.status, v.quantity, v.cost, v.currency,
       v.total_assembly_cost, v.effective_from, v.effective_to, v.has_active_revision AS is_current_revision,
       v.has_active_revision, v.cost_data_available, v.revision_data_available,
       coalesce(p.is_lowest_cost_supplier, false) AS is_lowest_cost_supplier, p.cost_vs_cheapest
FROM pcv v LEFT JOIN positioned p ON v.part_id = p.part_id AND v.supplier_name = p.supplier_name""",
    "asm_totals": f"""
SELECT assembly_id, currency, {money('sum(low * quantity)')} AS low,
       CAST(round(sum(CAST(total * quantity AS DOUBLE) / n), 4) AS DECIMAL(38,4)) AS mean, count(*) AS priced
FROM silver_bom JOIN per_part_currency USING (part_id) GROUP BY assembly_id, currency""",
    "asm_counts": """
SELECT assembly_id, count(DISTINCT part_id) AS total_parts_count,
       count(DISTINCT part_id) FILTER (part_id IN (SELECT part_id FROM silver_cost)) AS parts_with_cost,
       count(DISTINCT part_id) FILTER (has_active_revision) AS parts_with_current_revision
FROM silver_bom GROUP BY assembly_id""",
    "agg_assembly": f"""
SELECT c.assembly_id, t.currency, t.low AS min_total_assembly_cost, t.mean AS avg_total_assembly_cost,
       c.total_parts_count, c.parts_with_cost, c.parts_with_current_revision,
       {pct('c.parts_with_cost', 'c.total_parts_count')} AS parts_coverage_pct,
       {pct('c.parts_with_current_revision', 'c.total_parts_count')} AS revision_coverage_pct,
       CASE WHEN c.parts_with_cost = c.total_parts_count THEN 'Complete'
            WHEN c.parts_with_cost >= 0.8 * c.total_parts_count THEN 'Mostly Complete'
            ELSE 'Incomplete' END AS cost_data_completeness,
       row_number() OVER (PARTITION BY c.assembly_id ORDER BY t.priced DESC NULLS LAST, t.currency) = 1 AS is_main_currency
FROM asm_counts c LEFT JOIN asm_totals t USING (assembly_id)""",
    "supplier_sums": f"""
SELECT supplier_name, currency, count(*) AS parts_supplied, count(DISTINCT assembly_id) AS assemblies_covered,
       {money('sum(total_assembly_cost)')} AS total_extended_cost,
       CASE WHEN count(cost) > 0 THEN {mean4('sum(cost)', 'count(*)')} END AS avg_unit_cost,
       min(cost) AS min_unit_cost, max(cost) AS max_unit_cost,
       {money('coalesce(sum(total_assembly_cost) FILTER (is_lowest_cost_supplier), 0)')} AS lowest_cost_spend
FROM fact GROUP BY supplier_name, currency""",
    "agg_supplier": """
SELECT *, CASE WHEN spend_share_pct >= 30 THEN 'Strategic' WHEN spend_share_pct >= 10 THEN 'Preferred'
               ELSE 'Tactical' END AS supplier_tier
FROM (SELECT *, round(CAST(lowest_cost_spend AS DOUBLE)
                      / CAST(coalesce(nullif(sum(lowest_cost_spend) OVER (PARTITION BY currency), 0), 1) AS DOUBLE)
                      * 100, 2) AS spend_share_pct
      FROM supplier_sums)""",
    "rev_history": f"""
SELECT part_id, revision, status, effective_from, effective_to, is_current_revision, revision_duration_days,
       last_modified, lead(revision) OVER (PARTITION BY part_id ORDER BY effective_from, revision) AS next_revision,
       rank() OVER s AS revision_sequence, {days('effective_from', 'effective_to')} AS days_to_next_revision,
       CASE WHEN rank() OVER s = 1 THEN 'Initial Release' WHEN is_current_revision THEN 'Current'
            ELSE 'Superseded' END AS revision_stage
FROM silver_rev WINDOW s AS (PARTITION BY part_id ORDER BY effective_from)""",
    "cad_activity": f"""
SELECT *, CASE WHEN file_date IS NULL THEN 'Unknown' WHEN processing_lag_days = 0 THEN 'Same Day'
               WHEN processing_lag_days <= 1 THEN 'Next Day' WHEN processing_lag_days <= 3 THEN 'Within 3 Days'
               ELSE 'Delayed' END AS lag_status
FROM (SELECT file_date, count(part_id) AS files_processed, count(DISTINCT part_id) AS unique_files,
             {DESIGN_TS} AS first_processed_at, {DESIGN_TS} AS last_processed_at,
             {days('file_date', DESIGN_TS)} AS processing_lag_days
      FROM silver_cad GROUP BY file_date)""",
    "scd2": """
SELECT part_id, revision, status, effective_from AS valid_from, valid_to, valid_to IS NULL AS is_current
FROM (SELECT *, lead(effective_from) OVER (PARTITION BY part_id ORDER BY effective_from, revision) AS valid_to
      FROM silver_rev)""",
    # Serving
    "dashboard": """
SELECT f.*, a.min_total_assembly_cost AS assembly_min_cost, a.avg_total_assembly_cost AS assembly_avg_cost,
       a.total_parts_count, a.parts_coverage_pct, a.cost_data_completeness
FROM fact f JOIN agg_assembly a ON f.assembly_id = a.assembly_id
 AND (f.currency = a.currency OR (f.currency IS NULL AND a.is_main_currency))""",
    "mart": f"""
SELECT d.assembly_id, d.part_id, d.revision AS part_revision, d.status AS part_status, d.supplier_name, d.quantity,
       d.cost AS unit_cost, d.currency, d.total_assembly_cost AS line_cost,
       d.is_lowest_cost_supplier AS is_cheapest_supplier, d.cost_vs_cheapest AS cost_premium, d.is_current_revision,
       d.has_active_revision, d.cost_data_available AS has_erp_cost, d.assembly_min_cost, d.assembly_avg_cost,
       d.total_parts_count AS assembly_total_parts, d.parts_coverage_pct AS assembly_cost_coverage_pct,
       d.cost_data_completeness AS assembly_data_completeness, p.total_revision_count AS part_revision_count,
       p.first_released_at AS part_first_released_at, {PLANT_DAY} AS report_date
FROM dashboard d LEFT JOIN dim_part p USING (part_id)""",
    "scorecard": """
SELECT s.*, d.last_price_update_at, d.is_multi_part_supplier
FROM agg_supplier s LEFT JOIN dim_supplier d ON s.supplier_name = d.supplier_name AND s.currency = d.currency""",
    # Governance
    "rejects": """
SELECT 'cad_metadata' AS table_name, reason FROM judged_cad
UNION ALL SELECT 'plm_revisions', reason FROM judged_rev
UNION ALL SELECT 'plm_bom', reason FROM judged_bom
UNION ALL SELECT 'erp_cost', reason FROM judged_cost""",
    "profile": "\nUNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{table}' AS table_name, count(*) AS row_count, "
        f"count(*) FILTER ({' OR '.join(k + ' IS NULL' for k in keys)}) AS null_key_rows FROM {source}"
        for layer, table, source, keys in [
            ("bronze", "cad_metadata", "raw_cad", ["part_id"]),
            ("bronze", "plm_revisions", "raw_revisions", ["part_id", "revision"]),
            ("bronze", "plm_bom", "raw_bom", ["assembly_id", "part_id"]),
            ("bronze", "erp_cost", "raw_cost", ["part_id", "supplier_name"]),
            ("silver", "cad_metadata", "silver_cad", ["part_id"]),
            ("silver", "plm_revisions", "silver_rev", ["part_id", "revision"]),
            ("silver", "plm_bom", "bom_lines", ["assembly_id", "part_id"]),
            ("silver", "erp_cost", "silver_cost", ["part_id", "supplier_name"]),
        ]),
    "key_profile": f"SELECT *, {pct('null_key_rows', 'row_count')} AS null_key_pct FROM profile",
    "rates": f"""
SELECT table_name, count(reason) AS rejected_rows, count(*) AS total_rows, {pct('count(reason)', 'count(*)')} AS quarantine_pct
FROM rejects GROUP BY table_name""",
    "marks": """
SELECT 'erp_cost' AS table_name, CAST(max(last_updated) AS VARCHAR) AS last_watermark FROM raw_cost
UNION ALL SELECT 'plm_bom', CAST(max(last_modified) AS VARCHAR) FROM raw_bom
UNION ALL SELECT 'plm_revisions', CAST(max(effective_to) AS VARCHAR) FROM raw_revisions""",
    "stale": f"""
SELECT *, age_hours IS NULL AS unreadable, coalesce(age_hours <= 25, false) AS passed
FROM (SELECT table_name, last_watermark,
             round((epoch({PLANT_TS}) - epoch(TRY_CAST(last_watermark AS TIMESTAMP))) / 3600.0, 1) AS age_hours FROM marks)""",
    "metrics": f"""
SELECT 'run-001' AS run_id, {PLANT_DAY} AS run_date, *, {PLANT_TS} AS logged_at FROM (
  SELECT layer, table_name, 'row_count' AS metric_name, CAST(row_count AS DOUBLE) AS metric_value,
         CAST(0 AS DOUBLE) AS threshold, true AS passed FROM key_profile
  UNION ALL SELECT layer, table_name, 'null_key_pct', null_key_pct, 2.0, null_key_pct <= 2 FROM key_profile
  UNION ALL SELECT 'silver', table_name, 'quarantine_pct', quarantine_pct, 5.0, quarantine_pct <= 5 FROM rates
  UNION ALL SELECT 'pipeline', table_name, 'watermark_age_hrs', age_hours, 25.0, passed FROM stale)""",
    "latest_state": f"SELECT pipeline_name, run_id, status, last_updated FROM raw_runs {newest('pipeline_name', 'last_updated, run_id')}",
    "access": """
SELECT event_time, user_identity, action_name, full_name_arg, status_code FROM raw_audit
WHERE event_date = DATE '2024-01-15' AND service_name = 'tables' AND full_name_arg LIKE 'plant.%'
  AND action_name IN ('getTable', 'selectFromTable', 'describeTable', 'createTable', 'updateTable', 'deleteFromTable')""",
}


def labels(mapping: dict[str, str]) -> str:
    return ", ".join(f'{c} AS "{label}"' for c, label in mapping.items())


def profile_of(table: str, source: str, columns: list[tuple[str, str]], renamed: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS column_name, '{kind}' AS data_type, "
        f"{pct(f'count(*) - count({column})', 'count(*)')} AS null_pct, {low} AS min_value, {high} AS max_value FROM {source}"
        for name, kind, column, low, high in [
            (c if c != renamed else "vendor", k, c, f"CAST(min({c}) AS VARCHAR)", f"CAST(max({c}) AS VARCHAR)")
            for c, k in columns])


COST_TYPES = [("part_id", "string"), ("supplier_name", "string"), ("cost", "decimal(18,4)"), ("currency", "string"),
              ("last_updated", "timestamp")]
RAW_COST_TYPES = [("part_id", "string"), ("supplier_name", "string"), ("cost", "string"), ("currency", "string"),
                  ("last_updated", "date")]
BOM_TYPES = [("assembly_id", "string"), ("part_id", "string"), ("quantity", "int"), ("last_modified", "timestamp")]
CTES["drift_now"] = profile_of("erp_cost", "silver_cost", COST_TYPES)
CTES["drift_base"] = profile_of("erp_cost", "raw_cost", RAW_COST_TYPES, renamed="supplier_name")

JSON_OFFER = """'{"supplier":"' || supplier_name || '","unit_cost":' || CAST(cost AS VARCHAR) || ',"currency":"' || currency || '"}'"""
CTES["offers"] = f"""
SELECT part_id, '[' || string_agg({JSON_OFFER}, ',' ORDER BY supplier_name, cost, currency) || ']' AS all_suppliers
FROM silver_cost GROUP BY part_id"""
CTES["best_offer"] = """
SELECT part_id, supplier_name AS cheapest_supplier, cost AS cheapest_unit_cost, currency AS cost_currency
FROM silver_cost JOIN main_price USING (part_id, currency)
QUALIFY row_number() OVER (PARTITION BY part_id ORDER BY cost, supplier_name) = 1"""


def json_field(name: str, value: str, quoted: bool = True) -> str:
    body = f"""'"' || {value} || '"'""" if quoted else f"CAST({value} AS VARCHAR)"
    return f"""CASE WHEN {value} IS NULL THEN NULL ELSE '"{name}":' || {body} END"""


LOOKUP_JSON = "'{' || concat_ws(',', " + ", ".join([
    json_field("part_id", "part_id"), json_field("current_revision", "current_revision"),
    json_field("current_status", "current_status"), json_field("is_available", "(current_status = 'Released')", False),
    json_field("cheapest_supplier", "cheapest_supplier"), json_field("cheapest_unit_cost", "cheapest_unit_cost", False),
    json_field("cost_currency", "cost_currency"), json_field("all_suppliers", "all_suppliers", False),
    json_field("page", "0", False), json_field("pages", "1", False)]) + ") || '}'"

SNAPSHOT = "regexp_extract(_source_file, '([^/]+)\\.csv$', 1)"

BODIES: dict[str, str] = {
    "bronze_audit_erp": f"""SELECT *, '/landing/erp/erp_cost' AS _source_path, 'erp' AS _source_domain,
       {PLANT_TS} AS _bronze_ingested_at, 'run-001' AS _bronze_pipeline_run FROM raw_cost""",
    "silver_audit_cad": f"""SELECT *, 'bronze.cad_metadata' AS _silver_source_table, {DESIGN_TS} AS _silver_processed_at,
       'run-002' AS _silver_pipeline_run FROM silver_cad""",
    "gold_audit_dim_supplier": f"""SELECT *, {PLANT_DAY} AS _gold_run_date, {PLANT_TS} AS _gold_processed_at,
       'run-001' AS _gold_pipeline_run FROM dim_supplier""",
    "csv_tree_scan": f"""SELECT part_id, part_name, material, weight_kg, designer, created_date,
       {file_day('_source_file')} AS file_date, {SNAPSHOT} AS snapshot FROM raw_cad""",
    **dict.fromkeys(["files_by_ledger", "stream_files_by_ledger"], f"""SELECT part_id, part_name, material, weight_kg,
       designer, created_date, {file_day('_source_file')} AS file_date, {SNAPSHOT} AS snapshot,
       CASE WHEN coalesce({file_day('_source_file')} <= DATE '2024-01-15', true) THEN 2 ELSE 1 END AS wave FROM raw_cad"""),
    "csv_folder_listing": f"SELECT {SNAPSHOT} AS snapshot, true AS has_bytes FROM raw_cad GROUP BY 1",
    "monthly_split": """SELECT 'plm_bom_' || strftime(last_modified, '%Y_%m') || '_01' AS snapshot, count(*) AS n,
       CAST(sum(quantity) AS BIGINT) AS pieces FROM raw_bom GROUP BY 1""",
    "new_files_since": f"""SELECT * FROM (SELECT *, {file_day('_source_file')} AS file_date FROM raw_cad)
       WHERE file_date > DATE '2024-01-15'""",
    "last_load_date": f"SELECT max({file_day('_source_file')}) AS last_load_date FROM raw_cad",
    "unprocessed_files": f"""SELECT DISTINCT regexp_extract(_source_file, '([^/]+)$', 1) AS file_name FROM raw_cad
       WHERE NOT coalesce({file_day('_source_file')} <= DATE '2024-01-20', false)""",
    "incremental_by_watermark": """SELECT *, TIMESTAMP '2001-06-30' AS _ingestion_ts FROM raw_cost
       WHERE last_updated > DATE '1998-01-01' AND last_updated <= DATE '2001-06-30'""",
    "land_increment": """SELECT *, CASE WHEN last_modified <= TIMESTAMP '1998-12-31' THEN TIMESTAMP '1998-12-31'
       ELSE TIMESTAMP '2001-12-31' END AS _ingestion_ts FROM raw_bom""",
    "bulk_load_csv": """SELECT part_id, material, TRY_CAST(weight_kg AS DECIMAL(18,4)) AS weight_kg,
       TRY_CAST(created_date AS DATE) AS created_date FROM raw_cad""",
    "cdc_changes_after": "SELECT * FROM raw_cdc WHERE lsn > (SELECT floor(max(lsn) / 2) FROM raw_cdc)",
    "cad_file_date": f"SELECT part_id, _source_file, {file_day('_source_file')} AS file_date FROM raw_cad",
    "dedup_latest_cad": f"""SELECT * EXCLUDE (day, w) FROM (SELECT *, {file_day('_source_file')} AS day,
       TRY_CAST(weight_kg AS DECIMAL(18,4)) AS w FROM raw_cad)
       {newest('part_id', 'day, _source_file, created_date, designer, material, part_name, w, weight_kg')}""",
    "dedup_latest_revisions": f"""SELECT * FROM raw_revisions
       {newest('part_id, revision', 'last_modified, effective_from, effective_to, status')}""",
    "dedup_latest_bom": f"SELECT * FROM raw_bom {newest('assembly_id, part_id', 'last_modified, quantity')}",
    "dedup_latest_cost": f"""SELECT * EXCLUDE c FROM (SELECT *, TRY_CAST(cost AS DECIMAL(18,4)) AS c FROM raw_cost)
       {newest('part_id, supplier_name', 'last_updated, c, cost, currency')}""",
    "clean_cad": "SELECT * FROM silver_cad",
    "clean_revisions": "SELECT * FROM silver_rev",
    "clean_bom": "SELECT * FROM bom_lines",
    "clean_cost": "SELECT * FROM silver_cost",
    "quarantine_cad": "SELECT * EXCLUDE reason, reason AS _rejection_reason FROM judged_cad WHERE reason IS NOT NULL",
    "quarantine_revisions": "SELECT * EXCLUDE reason, reason AS _rejection_reason FROM judged_rev WHERE reason IS NOT NULL",
    "quarantine_bom": "SELECT * EXCLUDE reason, reason AS _rejection_reason FROM judged_bom WHERE reason IS NOT NULL",
    "quarantine_cost": "SELECT * EXCLUDE reason, reason AS _rejection_reason FROM judged_cost WHERE reason IS NOT NULL",
    "quarantine_ledger": f"""SELECT * EXCLUDE reason, reason AS _rejection_reason, {PLANT_TS} AS _quarantine_ts,
       'run-001' AS _run_id FROM judged_cost WHERE reason IS NOT NULL""",
    "quarantine_summary": """SELECT table_name, reason AS rejection_reason, count(*) AS rows_rejected FROM rejects
       WHERE reason IS NOT NULL GROUP BY ALL""",
    "revision_duration": "SELECT part_id, revision, is_current_revision, revision_duration_days FROM silver_rev",
    "current_revision": "SELECT * FROM open_rev",
    "bom_enriched": "SELECT * FROM silver_bom",
    "part_cost_view": "SELECT * FROM pcv",
    "dim_part": "SELECT * FROM dim_part",
    "dim_supplier": "SELECT * FROM dim_supplier",
    "fact_bom_cost": "SELECT * FROM fact",
    "cheapest_supplier": "SELECT part_id, currency, supplier_name, cost FROM positioned WHERE is_lowest_cost_supplier",
    "cost_vs_cheapest": "SELECT * FROM positioned",
    "agg_assembly_cost": "SELECT * FROM agg_assembly",
    "agg_supplier_cost": "SELECT * FROM agg_supplier",
    "agg_part_revision_history": "SELECT * FROM rev_history",
    "agg_cad_activity": "SELECT * FROM cad_activity",
    "revision_impact": f"""SELECT b.assembly_id, m.currency, count(*) AS revised_parts, CAST(sum(b.quantity) AS BIGINT) AS pieces,
       {money('sum(m.min_cost * b.quantity)')} AS cost_at_lowest_price, max(r.revised_at) AS last_revised_at
FROM bom_lines b
JOIN (SELECT part_id, max(last_modified) AS revised_at FROM silver_rev WHERE last_modified > TIMESTAMP '2001-06-01'
      GROUP BY part_id) r USING (part_id)
LEFT JOIN main_price m USING (part_id) GROUP BY b.assembly_id, m.currency""",
    "assembly_cost_summary": "SELECT * EXCLUDE is_main_currency FROM agg_assembly WHERE is_main_currency",
    "supplier_performance": """SELECT supplier_name, currency, parts_supplied, assemblies_covered, avg_unit_cost,
       lowest_cost_spend, spend_share_pct, supplier_tier FROM agg_supplier WHERE supplier_name IS NOT NULL""",
    "vw_assembly_cost_dashboard": f"SELECT {labels(serving.DASHBOARD_LABELS)} FROM dashboard",
    "vw_part_catalogue": f"SELECT {labels(serving.CATALOGUE_LABELS)} FROM dim_part ORDER BY part_id",
    "vw_supplier_scorecard": f"SELECT {labels(serving.SCORECARD_LABELS)} FROM scorecard ORDER BY spend_share_pct DESC",
    "vw_revision_tracker": f"SELECT {labels(serving.TRACKER_LABELS)} FROM rev_history ORDER BY part_id, revision_sequence",
    "vw_cad_health": f"""SELECT {labels(serving.CAD_HEALTH_LABELS)} FROM (
       SELECT *, CASE lag_status WHEN 'Same Day' THEN 'On Time' WHEN 'Next Day' THEN 'Acceptable' ELSE 'At Risk' END
              AS health_status FROM cad_activity) ORDER BY file_date DESC""",
    "mart_assembly_cost": "SELECT * FROM mart",
    "mart_supplier_scorecard": f"""
SELECT * EXCLUDE (days_since_price_update, price_freshness), days_since_price_update, price_freshness,
       CASE WHEN supplier_tier = 'Strategic' AND price_freshness = 'Current' THEN 'Maintain — key supplier, pricing current'
            WHEN supplier_tier = 'Strategic' THEN 'Urgent — renegotiate pricing with strategic supplier'
            WHEN supplier_tier = 'Preferred' AND parts_supplied = 1
            THEN 'Review — single-part preferred supplier, consider consolidation'
            WHEN supplier_tier = 'Tactical' THEN 'Monitor — low spend share, evaluate if needed'
            ELSE 'Review' END AS recommended_action, {PLANT_DAY} AS report_date
FROM (SELECT *, CASE WHEN days_since_price_update <= 30 THEN 'Current' WHEN days_since_price_update <= 90 THEN 'Stale'
                     ELSE 'Outdated' END AS price_freshness
      FROM (SELECT *, {days('last_price_update_at', PLANT_DAY)} AS days_since_price_update FROM scorecard))""",
    "mart_open_revisions": f"""
SELECT r.part_id, r.revision, r.status, r.effective_from, r.revision_duration_days AS days_active,
       greatest(180 - r.revision_duration_days, 0) AS days_until_review_due,
       CASE WHEN r.revision_duration_days >= 365 THEN 'Escalate — overdue for revision'
            WHEN r.revision_duration_days >= 180 THEN 'Review — approaching revision threshold'
            ELSE 'On Track' END AS review_status, r.revision_sequence, p.supplier_count, p.min_cost AS current_min_cost,
       p.currency, p.min_cost IS NOT NULL AS has_cost_data, {PLANT_DAY} AS report_date
FROM rev_history r LEFT JOIN dim_part p USING (part_id) WHERE r.is_current_revision""",
    "api_part_cost_lookup": f"""
SELECT part_id, current_revision, current_status, current_status = 'Released' AS is_available, cheapest_supplier,
       cheapest_unit_cost, cost_currency, all_suppliers, 0 AS supplier_page, 1 AS supplier_pages, {LOOKUP_JSON} AS api_response_json,
       {PLANT_TS} AS cache_refreshed_at
FROM dim_part LEFT JOIN best_offer USING (part_id) LEFT JOIN offers USING (part_id)""",
    "masked_mart": """SELECT assembly_id, part_id, supplier_name, CAST(NULL AS DECIMAL(18,4)) AS unit_cost, part_revision
       FROM mart""",
    "row_filtered_mart": """SELECT assembly_id, part_id, line_cost FROM mart
       WHERE assembly_id IS NOT NULL AND assembly_data_completeness <> 'Incomplete'""",
    "domain_filtered_rejects": """
SELECT table_name, reason AS rejection_reason, count(*) AS rows_rejected,
       CASE table_name WHEN 'cad_metadata' THEN 'cad' ELSE 'plm' END AS domain
FROM rejects WHERE reason IS NOT NULL AND table_name <> 'erp_cost' GROUP BY ALL""",
    "upsert_cost": f"""
WITH waves AS (SELECT * EXCLUDE reason, CASE WHEN last_updated > TIMESTAMP '1999-12-31' THEN 2 END AS wave
               FROM judged_cost WHERE reason IS NULL),
each_wave AS (SELECT * FROM waves {newest('part_id, supplier_name, wave', 'last_updated, cost, currency')})
SELECT * FROM each_wave {newest('part_id, supplier_name', 'wave')}""",
    "upsert_partitioned_revisions": f"""
WITH waves AS (SELECT *, CASE WHEN last_modified > TIMESTAMP '2000-07-01' THEN 2 ELSE 1 END AS wave FROM raw_revisions)
SELECT * EXCLUDE wave FROM waves
{newest('part_id, revision', 'wave, last_modified, effective_from, effective_to, status')}""",
    "cdc_apply": f"SELECT lsn, part_no, reading FROM (SELECT * FROM raw_cdc {newest('part_no', 'lsn')}) WHERE op <> 'delete'",
    "scd2_revision": "SELECT * FROM scd2",
    "scd2_status": """
WITH changes AS (SELECT * FROM silver_rev WINDOW w AS (PARTITION BY part_id ORDER BY effective_from, revision)
                 QUALIFY lag(status) OVER w IS NULL OR lag(status) OVER w <> status),
closed AS (SELECT *, lead(effective_from) OVER (PARTITION BY part_id ORDER BY effective_from, revision) AS valid_to FROM changes)
SELECT part_id, status, effective_from AS valid_from, valid_to, valid_to IS NULL AS is_current FROM closed""",
    "scd2_incremental": "SELECT * FROM scd2",
    "revision_as_of": """SELECT part_id, revision, status, valid_from AS effective_from FROM scd2
       WHERE valid_from <= TIMESTAMP '1999-06-30' AND (valid_to IS NULL OR valid_to > TIMESTAMP '1999-06-30')""",
    "bom_revision_as_of": """SELECT b.*, s.revision, s.status FROM bom_lines b LEFT JOIN scd2 s
       ON b.part_id = s.part_id AND s.valid_from <= b.last_modified AND (s.valid_to IS NULL OR b.last_modified < s.valid_to)""",
    "star_dim_part": """
SELECT md5(part_id) AS part_key, part_id, part_name, material, weight_kg, designer
FROM (SELECT part_id FROM silver_cad UNION SELECT part_id FROM bom_lines UNION SELECT part_id FROM silver_rev
      UNION SELECT part_id FROM silver_cost) LEFT JOIN silver_cad USING (part_id)""",
    "star_dim_assembly": """SELECT DISTINCT md5(assembly_id) AS assembly_key, assembly_id,
       'Assembly ' || assembly_id AS assembly_name FROM bom_lines""",
    "star_dim_supplier": """SELECT md5(supplier_name) AS supplier_key, supplier_name, location
       FROM (SELECT DISTINCT supplier_name FROM silver_cost) LEFT JOIN supplier_sites USING (supplier_name)""",
    "star_dim_revision": """
SELECT md5(part_id || chr(31) || revision || chr(31) || CAST(CAST(valid_from AS DATE) AS VARCHAR)) AS revision_key, part_id,
       revision, status, valid_from AS effective_from, valid_to AS effective_to, is_current FROM scd2""",
    "star_fact_bom": "SELECT md5(assembly_id) AS assembly_key, md5(part_id) AS part_key, quantity FROM bom_lines",
    "star_fact_cost": """SELECT CASE WHEN part_id IN (SELECT part_id FROM silver_cad) THEN md5(part_id) ELSE 'unknown' END
       AS part_key, md5(supplier_name) AS supplier_key, cost, currency FROM silver_cost""",
    "star_fact_design": """
SELECT md5(c.part_id) AS part_key,
       md5(s.part_id || chr(31) || s.revision || chr(31) || CAST(CAST(s.valid_from AS DATE) AS VARCHAR)) AS revision_key,
       c.created_date, c.weight_kg
FROM silver_cad c LEFT JOIN scd2 s ON c.part_id = s.part_id AND s.valid_from <= c.created_date
 AND (s.valid_to IS NULL OR c.created_date < s.valid_to)""",
    "dq_profile": "SELECT * FROM key_profile",
    "table_freshness": """
SELECT 'plm_revisions' AS table_name, count(*) AS row_count, max(last_modified) AS latest FROM silver_rev
UNION ALL SELECT 'plm_bom', count(*), max(last_modified) FROM bom_lines
UNION ALL SELECT 'erp_cost', count(*), max(last_updated) FROM silver_cost""",
    "quarantine_rate": "SELECT * FROM rates",
    "watermark_age": "SELECT * FROM stale",
    "supplier_freshness": f"""
SELECT *, false AS unreadable, age_hours <= 25 AS passed
FROM (SELECT supplier_name AS table_name, CAST(max(last_updated) AS VARCHAR) AS last_watermark,
             round((epoch({PLANT_TS}) - epoch(max(last_updated))) / 3600.0, 1) AS age_hours
      FROM silver_cost GROUP BY supplier_name)""",
    "dq_metrics": "SELECT * FROM metrics",
    "alerts": """
SELECT run_id, run_date, CASE metric_name WHEN 'null_key_pct' THEN 'DataQuality' WHEN 'quarantine_pct' THEN 'Quarantine'
                                          ELSE 'WatermarkStale' END AS alert_type,
       CASE metric_name WHEN 'null_key_pct' THEN 'Warning' ELSE 'Critical' END AS severity,
       table_name, metric_name, metric_value, threshold,
       CASE metric_name
         WHEN 'null_key_pct' THEN format('{}: null key rate {}% exceeds threshold {}%', table_name, CAST(metric_value AS VARCHAR), CAST(threshold AS VARCHAR))
         WHEN 'quarantine_pct' THEN format('{}: {}% rows quarantined — exceeds {}% threshold', table_name, CAST(metric_value AS VARCHAR), CAST(threshold AS VARCHAR))
         ELSE format('{}: watermark not updated for {}h — pipeline may have stalled (limit {}h)', table_name, CAST(metric_value AS VARCHAR), CAST(threshold AS VARCHAR))
       END AS message, logged_at
FROM metrics WHERE NOT passed""",
    "daily_summary": """
SELECT run_date, layer, table_name, max(metric_value) FILTER (metric_name = 'row_count') AS row_count,
       max(metric_value) FILTER (metric_name = 'null_key_pct') AS null_key_pct,
       max(metric_value) FILTER (metric_name = 'quarantine_pct') AS quarantine_pct,
       max(metric_value) FILTER (metric_name = 'watermark_age_hrs') AS watermark_age_hrs,
       bool_and(passed) AS all_checks_passed, count(*) FILTER (NOT passed) AS failed_checks,
       layer = 'bronze' AND table_name IN ('cad_metadata', 'erp_cost') AS has_files
FROM metrics GROUP BY run_date, layer, table_name ORDER BY layer, table_name""",
    "column_profile": profile_of("erp_cost", "silver_cost", COST_TYPES) + " UNION ALL " + profile_of("plm_bom", "bom_lines", BOM_TYPES),
    "column_drift": """
SELECT coalesce(n.table_name, b.table_name) AS table_name, coalesce(n.column_name, b.column_name) AS column_name,
       n.data_type AS data_type_now, n.null_pct AS null_pct_now, n.min_value AS min_value_now, n.max_value AS max_value_now,
       b.data_type AS data_type_base, b.null_pct AS null_pct_base, b.min_value AS min_value_base, b.max_value AS max_value_base,
       CASE WHEN b.table_name IS NULL THEN 'added' WHEN n.table_name IS NULL THEN 'dropped'
            WHEN n.data_type <> b.data_type THEN 'changed'
            WHEN abs(n.null_pct - b.null_pct) > 5 OR n.min_value IS DISTINCT FROM b.min_value
              OR n.max_value IS DISTINCT FROM b.max_value THEN 'shifted' ELSE 'same' END AS drift
FROM drift_now n FULL JOIN drift_base b ON n.table_name = b.table_name AND n.column_name = b.column_name""",
    "duplicate_bom_keys": "SELECT assembly_id, part_id, count(*) AS copies FROM raw_bom GROUP BY 1, 2 HAVING count(*) > 1",
    "referential_orphans": "SELECT assembly_id, part_id FROM bom_lines WHERE part_id NOT IN (SELECT part_id FROM silver_cost)",
    "covered_lines": "SELECT assembly_id, part_id FROM bom_lines WHERE part_id IN (SELECT part_id FROM silver_cost)",
    "quality_log": f"""
SELECT *, {pct('failed', 'total')} AS failed_pct, failed = 0 AS passed FROM (
  SELECT 'cad_metadata' AS table_name, 'not null part_id' AS rule, count(*) AS total, count(*) FILTER (part_id IS NULL) AS failed FROM raw_cad
  UNION ALL SELECT 'plm_bom', 'unique assembly_id,part_id', CAST(sum(n) AS BIGINT), CAST(sum(n - 1) AS BIGINT)
            FROM (SELECT count(*) AS n FROM raw_bom GROUP BY assembly_id, part_id)
  UNION ALL SELECT 'plm_bom', 'part_id in erp_cost', count(*), count(*) FILTER (part_id NOT IN (SELECT part_id FROM silver_cost)) FROM bom_lines
  UNION ALL SELECT 'erp_cost', {text(REASON_COST)}, count(*), count(*) FILTER (cost IS NULL OR cost <= 0) FROM judged_cost
  UNION ALL SELECT 'erp_cost', {text(REASON_CURRENCY)}, count(*),
            count(*) FILTER (currency IS NULL OR currency NOT IN ({listed(CURRENCIES)})) FROM judged_cost)""",
    "run_gate": """SELECT count(*) AS pipelines, count(*) FILTER (status = 'SUCCESS') AS succeeded,
       bool_and(status = 'SUCCESS') AS may_start FROM latest_state""",
    "latest_runs": "SELECT * FROM latest_state",
    "sla_breaches": """SELECT run_id, 'bronze' AS layer, pipeline_name AS table_name,
       CAST((duration_seconds + 3) // 6 AS DOUBLE) / 10 AS duration_minutes, CAST(60 AS DOUBLE) AS threshold
       FROM raw_runs WHERE duration_seconds > 3600""",
    "table_access": "SELECT * FROM access",
    "access_top10": """SELECT full_name_arg, action_name, count(*) AS accesses FROM access GROUP BY 1, 2
       ORDER BY accesses DESC, full_name_arg, action_name LIMIT 10""",
    "access_by_user": "SELECT user_identity, count(*) AS accesses FROM access GROUP BY 1",
    "table_file_stats": """SELECT 'lineitem' AS table_name, count(*) AS row_count, true AS has_files, true AS has_bytes
       FROM lineitem""",
    "compact_cluster": "SELECT * FROM lineitem",
    "stream_ingest_cad": f"""SELECT * EXCLUDE _source_file FROM (SELECT *, {SNAPSHOT} AS snapshot,
       {file_day('_source_file')} AS file_date FROM raw_cad)
       {newest('part_id', 'file_date, snapshot, created_date, designer, material, part_name, weight_kg')}""",
    "stream_cdc_apply": f"SELECT lsn, part_no, reading FROM (SELECT * FROM raw_cdc {newest('part_no', 'lsn')}) WHERE op <> 'delete'",
    "stream_cdc_state": f"SELECT lsn, part_no, reading FROM (SELECT * FROM raw_cdc {newest('part_no', 'lsn')}) WHERE op <> 'delete'",
    "stream_without_repeats": "SELECT event_id, user_id, event_type FROM events",
    "stream_daily_activity": "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2",
}


def needed(body: str) -> list[str]:
    """Names of the expressions a body uses, directly or through others, each after those it uses."""
    found: list[str] = []

    def visit(sql: str) -> None:
        for name in CTES:
            if name not in found and re.search(rf"\b{name}\b", sql):
                visit(CTES[name])
                if name not in found:
                    found.append(name)

    visit(body)
    return found


def sql(name: str) -> str:
    body = BODIES[name].strip()
    ctes = [f"{n} AS ({CTES[n].strip()})" for n in needed(body)]
    if not ctes:
        return body
    own = body[5:] if body.startswith("WITH ") else None
    return "WITH " + ",\n".join(ctes) + (",\n" + own if own else "\n" + body)


BODIES["scd2_status_incremental"] = BODIES["scd2_status"]
BODIES["lake_upsert_reopened"] = BODIES["lake_upsert_repeat"] = BODIES["run_chain_cost"] = BODIES["clean_cost"]
BODIES["run_chain_revisions"], BODIES["run_chain_cad"] = BODIES["clean_revisions"], BODIES["clean_cad"]
BODIES["run_chain_rejects"] = BODIES["quarantine_summary"]
BODIES["gold_after_second_run"] = BODIES["agg_assembly_cost"]
BODIES["open_revisions_after_second_run"] = BODIES["mart_open_revisions"]
BODIES["watermark_commit"] = """
SELECT trim(supplier_name) AS table_name,
       CASE WHEN min(last_updated) <= DATE '2000-01-01' THEN '2000-01-01 00:00:00' END AS last_watermark
FROM raw_cost WHERE last_updated <= DATE '2000-01-01' GROUP BY 1"""
BODIES["incremental_run"] = f"""
SELECT part_id, supplier_name, cost, currency, last_updated FROM (SELECT *, TRY_CAST(cost AS DECIMAL(18,4)) AS c FROM raw_cost)
WHERE TRY_CAST(cost AS DECIMAL(18,4)) > 0 AND upper(trim(currency)) IN ({listed(CURRENCIES)})
{newest('part_id, supplier_name', 'last_updated, c, cost, currency')}"""

BODIES["bucketed_upsert"] = BODIES["clean_cost"]
BODIES["dim_supplier_from_changes"], BODIES["dim_part_from_changes"] = BODIES["dim_supplier"], BODIES["dim_part"]
CTES["first_offers"] = CTES["silver_cost"].replace("FROM judged_cost WHERE", "FROM judged_cost WHERE last_updated <= TIMESTAMP '1999-12-31' AND")
BODIES["bucketed_changes"] = """
SELECT *, 1 AS more FROM (SELECT * FROM silver_cost EXCEPT SELECT * FROM first_offers)
UNION ALL SELECT *, -1 FROM (SELECT * FROM first_offers EXCEPT SELECT * FROM silver_cost)"""
BODIES["revision_price_spans"] = """
WITH quoted AS (SELECT DISTINCT part_id, supplier_name FROM judged_cost WHERE reason IS NULL),
starts AS (SELECT o.supplier_name, r.* FROM quoted o JOIN silver_rev r USING (part_id) WHERE effective_from IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY part_id, supplier_name, effective_from ORDER BY revision DESC) = 1),
lefts AS (SELECT part_id, supplier_name, revision, status, effective_from AS f,
        least(coalesce(effective_to, TIMESTAMP '9999-01-01'),
              coalesce(lead(effective_from) OVER (PARTITION BY part_id, supplier_name ORDER BY effective_from), TIMESTAMP '9999-01-01')) AS t FROM starts),
notices AS (SELECT * FROM judged_cost WHERE reason IS NULL AND last_updated IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY part_id, supplier_name, last_updated ORDER BY cost DESC, currency DESC) = 1),
rights AS (SELECT part_id, supplier_name, cost, currency, last_updated AS f,
        coalesce(lead(last_updated) OVER (PARTITION BY part_id, supplier_name ORDER BY last_updated), TIMESTAMP '9999-01-01') AS t FROM notices),
spans AS (SELECT part_id, supplier_name, revision, status, cost, currency, greatest(l.f, r.f) AS f, least(l.t, r.t) AS t
  FROM lefts l JOIN rights r USING (part_id, supplier_name) WHERE greatest(l.f, r.f) < least(l.t, r.t)),
marked AS (SELECT *, CASE WHEN lag(t) OVER w = f AND lag((revision, status, cost, currency)) OVER w = (revision, status, cost, currency)
                     THEN 0 ELSE 1 END AS fresh FROM spans WINDOW w AS (PARTITION BY part_id, supplier_name ORDER BY f)),
grouped AS (SELECT *, sum(fresh) OVER (PARTITION BY part_id, supplier_name ORDER BY f) AS g FROM marked)
SELECT part_id, supplier_name, revision, status, cost, currency, min(f) AS valid_from,
       nullif(max(t), TIMESTAMP '9999-01-01') AS valid_to
FROM grouped GROUP BY part_id, supplier_name, revision, status, cost, currency, g"""
BODIES["merged_column_states"] = " UNION ALL ".join(
    f"SELECT 'erp_cost' AS table_name, '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS nulls, "
    f"count(DISTINCT {c}) AS distinct_count, true AS distinct_within_error, true AS merged_as_one_pass, true AS rank_within_error FROM silver_cost"
    for c in ("part_id", "supplier_name", "cost", "currency", "last_updated"))


BODIES["part_cost_answers"] = """
SELECT l.assembly_id, l.part_id, current_revision, cheapest_supplier, cheapest_unit_cost, 1 AS supplier_pages
FROM bom_lines l JOIN (SELECT * FROM dim_part LEFT JOIN best_offer USING (part_id)) USING (part_id)"""
BODIES["guarded_mart"] = """
WITH rows_of AS (SELECT CASE WHEN assembly_data_completeness <> 'Incomplete' THEN assembly_id END AS assembly_id, part_id, line_cost, unit_cost FROM mart)
SELECT 'otto' AS reader, * FROM rows_of UNION ALL
SELECT 'ines', * FROM rows_of WHERE assembly_id IS NOT NULL UNION ALL
SELECT 'tom', * REPLACE (CAST(NULL AS DECIMAL(18,4)) AS unit_cost) FROM rows_of WHERE assembly_id IS NOT NULL"""
CTES["grown_cost"] = """
SELECT part_id, supplier_name, cost AS came, TRY_CAST(cost AS DECIMAL(18,4)) AS cost, CAST(NULL AS VARCHAR) AS currency, last_updated,
       CASE WHEN month(last_updated) <= 6 THEN 'FOB' END AS incoterm, CAST(day(last_updated) AS INT) AS min_order FROM raw_cost"""
BODIES["promoted_columns"] = "SELECT * EXCLUDE came FROM grown_cost"
BODIES["drifted_landing"] = """
SELECT 'cost' AS column_name, count(*) AS row_count, 0 AS null_count, 'STRING' AS column_type
FROM grown_cost WHERE came IS NOT NULL AND cost IS NULL HAVING count(*) > 0 UNION ALL
SELECT 'incoterm', count(*), count(*) - count(incoterm), 'STRING' FROM grown_cost UNION ALL
SELECT 'min_order', count(*), count(*) - count(min_order), 'BIGINT' FROM grown_cost"""
BODIES["profile_distinct_counts"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count, true AS within_error FROM {table}"
    for name, table, columns in (("erp_cost", "silver_cost", COST_TYPES), ("plm_bom", "bom_lines", BOM_TYPES)) for c, _ in columns)


LACKING = "count(*) FILTER (part_id IS NULL OR supplier_name IS NULL)"
BODIES["profile_of_writes"] = f"""
SELECT layer, 'erp_cost' AS table_name, count(*) AS row_count, {LACKING} AS null_key_rows, {pct(LACKING, "count(*)")} AS null_key_pct
FROM silver_cost, (VALUES ('bronze'), ('silver')) AS l(layer) GROUP BY layer"""


def all_sql() -> dict[str, str]:
    return {name: sql(name) for name in BODIES}
