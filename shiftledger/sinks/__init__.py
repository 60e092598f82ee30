"""Outputs: stored tables and CSV exports."""

from .csv_export import export_csv, export_kpi, export_raw, export_validated
from .tables import disposition, require_not_null, write_kpi, write_raw, write_validated

__all__ = [
    "disposition",
    "export_csv",
    "export_kpi",
    "export_raw",
    "export_validated",
    "require_not_null",
    "write_kpi",
    "write_raw",
    "write_validated",
]
