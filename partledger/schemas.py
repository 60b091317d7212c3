"""Fixed schemas (as DDL text, which readers and createDataFrame take), keys and partition columns per table."""

from __future__ import annotations

from dataclasses import dataclass


CAD_CSV = (
    "part_id string, part_name string, material string, weight_kg string, designer string, created_date string"
)
PLM_REVISIONS = (
    "part_id string, revision string, status string, effective_from date, effective_to date, last_modified timestamp"
)
PLM_BOM = "assembly_id string, part_id string, quantity int, last_modified timestamp"
ERP_COST = "part_id string, supplier_name string, cost string, currency string, last_updated date"

# Control tables
WATERMARK = "table_name string, last_watermark string, merge_key array<string>, adls_path string"
CDC_POSITION = "table_name string, last_lsn bigint"
FILE_LEDGER = "file_name string, status string, processed_time timestamp"
RUN_STATUS = (
    "pipeline_name string, run_id string, status string, start_time timestamp, end_time timestamp, "
    "last_updated timestamp"
)

# Governance tables
RUN_LOG = (
    "run_id string, run_date date, layer string, table_name string, status string, rows_read bigint, "
    "rows_written bigint, rows_quarantined bigint, duration_seconds double, error_message string, logged_at timestamp"
)
DQ_METRICS = (
    "run_id string, run_date date, layer string, table_name string, metric_name string, metric_value double, "
    "threshold double, passed boolean, logged_at timestamp"
)
TABLE_HEALTH = (
    "run_date date, layer string, table_name string, row_count bigint, size_bytes bigint, num_files bigint, "
    "last_modified timestamp, logged_at timestamp"
)
SCHEMA_BASELINE = (
    "table_name string, column_name string, data_type string, is_nullable boolean, baseline_date date, "
    "logged_at timestamp"
)
ALERT_LOG = (
    "run_id string, run_date date, alert_type string, severity string, table_name string, metric_name string, "
    "metric_value double, threshold double, message string, logged_at timestamp"
)

GOVERNANCE_TABLES = {
    "pipeline_run_log": RUN_LOG,
    "dq_metrics": DQ_METRICS,
    "table_health": TABLE_HEALTH,
    "schema_baseline": SCHEMA_BASELINE,
    "alert_log": ALERT_LOG,
}


# Key buckets of a new table that is merged into. An arrival rewrites the buckets it hits, so a large table
# should have many times more than an arrival has keys; the number is kept with the table.
BUCKETS = 8


# Partition columns with a handful of accepted values.
CODES = frozenset({"currency", "status"})


@dataclass(frozen=True)
class TableSpec:
    layer: str
    name: str
    keys: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    buckets: int = 0  # key buckets of a new table; 0 for none

    @property
    def id(self) -> str:
        return f"{self.layer}.{self.name}"

    @property
    def required(self) -> tuple[str, ...]:
        """Keys that ought to have a value in every row."""
        return tuple(k for k in self.keys if k not in ("currency", "supplier_page"))


TABLES = {
    spec.id: spec
    for spec in [
        TableSpec("bronze", "cad_metadata", ("part_id",), buckets=BUCKETS),
        TableSpec("bronze", "plm_revisions", ("part_id", "revision"), buckets=BUCKETS),
        TableSpec("bronze", "plm_bom", ("assembly_id", "part_id"), buckets=BUCKETS),
        TableSpec("bronze", "erp_cost", ("part_id", "supplier_name"), buckets=BUCKETS),
        TableSpec("silver", "cad_metadata", ("part_id",), buckets=BUCKETS),
        TableSpec("silver", "plm_revisions", ("part_id", "revision"), buckets=BUCKETS),
        TableSpec("silver", "plm_bom", ("assembly_id", "part_id")),
        TableSpec("silver", "erp_cost", ("part_id", "supplier_name"), buckets=BUCKETS),
        TableSpec("silver", "part_cost_view", ("part_id", "supplier_name", "assembly_id"), ("currency",)),
        TableSpec("gold", "dim_part", ("part_id",), (), ("part_id",)),
        TableSpec("gold", "dim_supplier", ("supplier_name", "currency"), (), ("supplier_name",)),
        TableSpec(
            "gold", "fact_bom_cost", ("assembly_id", "part_id", "supplier_name"), ("currency",),
            ("assembly_id", "part_id"),
        ),
        TableSpec("gold", "agg_assembly_cost", ("assembly_id", "currency"), (), ("assembly_id",)),
        TableSpec("gold", "agg_supplier_cost", ("supplier_name", "currency"), (), ("supplier_name",)),
        TableSpec("gold", "agg_part_revision_history", ("part_id", "revision"), ("status",), ("part_id",)),
        TableSpec("gold", "agg_cad_activity", ("file_date",), (), ("file_date",)),
        TableSpec(
            "serving", "mart_assembly_cost", ("assembly_id", "part_id", "supplier_name"), ("currency",),
            ("assembly_id", "part_id"),
        ),
        TableSpec("serving", "mart_supplier_scorecard", ("supplier_name", "currency"), (), ("supplier_name",)),
        TableSpec("serving", "mart_open_revisions", ("part_id", "revision"), (), ("part_id", "review_status")),
        TableSpec("serving", "api_part_cost_lookup", ("part_id", "supplier_page"), (), ("part_id",)),
        TableSpec("star", "dim_part", ("part_key",)),
        TableSpec("star", "dim_assembly", ("assembly_key",)),
        TableSpec("star", "dim_supplier", ("supplier_key",)),
        TableSpec("star", "dim_revision", ("revision_key",)),
        TableSpec("star", "fact_bom", ("assembly_key", "part_key")),
        TableSpec("star", "fact_cost", ("part_key", "supplier_key")),
        TableSpec("star", "fact_design", ("part_key",)),
        # Views for reports, stored with their labels: no keys to check.
        TableSpec("serving", "vw_assembly_cost_dashboard", ()),
        TableSpec("serving", "vw_part_catalogue", ()),
        TableSpec("serving", "vw_supplier_scorecard", ()),
        TableSpec("serving", "vw_revision_tracker", ()),
        TableSpec("serving", "vw_cad_pipeline_health", ()),
    ]
}
