"""Data tests of the built tables. Each returns the failing rows, so an empty result is a pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billweave.schema import KEY_COLUMN


def duplicated_keys(table: DataFrame, key: str = KEY_COLUMN) -> DataFrame:
    """Keys that occur more than once; NULL keys are left to :func:`null_keys`."""
    return (
        table.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter("n_records > 1")
    )


def null_keys(table: DataFrame, key: str = KEY_COLUMN) -> DataFrame:
    return table.filter(F.col(key).isNull())


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Name and number of rows of each table, counted where the rows are."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, table in tables.items()
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


def empty_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Tables that hold no row after a run."""
    return row_counts(tables).filter("n_rows = 0")
