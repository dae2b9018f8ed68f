"""One call from landed files to rows appended to a raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from billweave.schema import landing_schema
from billweave.sinks.catalogs import CatalogTarget
from billweave.sinks.tables import append_batch, create_if_absent
from billweave.sources.event_logs import coerce_records, event_records, read_event_log
from billweave.sources.files import read_parquet_report


def append_log(
    spark: SparkSession,
    path: str,
    target: CatalogTarget,
    table: str,
    separator: str = "\n",
    bad_values: str = "fail",
    cut_rows: str = "fail",
) -> int:
    """Appends the records of event logs to a raw table, made if it is absent; returns how many.

    A log without any record is an error, raised after the write, which then has added nothing.
    """
    return _append(event_records(read_event_log(spark, path, separator), cut_rows=cut_rows), path, target, table, bad_values)


def append_parquet(spark: SparkSession, path: str, target: CatalogTarget, table: str, bad_values: str = "fail") -> int:
    """Appends the rows of Parquet files, sub-folders included, to a raw table; returns how many."""
    return _append(read_parquet_report(spark, path), path, target, table, bad_values)


def _append(records: DataFrame, path: str, target: CatalogTarget, table: str, bad_values: str) -> int:
    name = create_if_absent(records.sparkSession, target, table, landing_schema())
    rows = append_batch(coerce_records(records, bad_values), name)
    if not rows:
        raise ValueError(f"no report records found at {path}")
    return rows
