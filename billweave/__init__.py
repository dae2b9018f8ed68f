"""Cost and usage report analytics on PySpark: typed staging, daily cost tables, sinks, streams."""

from billweave.schema import REPORT_COLUMNS, STAGING_COLUMNS, TypePlan

__all__ = ["REPORT_COLUMNS", "STAGING_COLUMNS", "TypePlan"]
