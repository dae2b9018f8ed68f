"""Tables in the session catalog or in another one: create, replace, append, drop, sample, probe."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billweave.dictionary import described
from billweave.functions import quote_text
from billweave.schema import KEY_COLUMN
from billweave.session import RELEASE_SHUFFLES, settings
from billweave.sinks.catalogs import CatalogTarget

PERIOD = "billing_period_start_date"


def ensure_namespace(spark: SparkSession, target: CatalogTarget) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {target.schema_name}")


def replace_table(
    df: DataFrame,
    target: CatalogTarget,
    table: str,
    partition_by: str | None = None,
    comment: str = "",
    location: str | None = None,
) -> DataFrame:
    """Writes ``df`` as a table, replacing an earlier one, with column comments; returns the table.

    With ``partition_by``, rows of one day are brought together and sorted by billing period. The
    rebalance splits a day that holds very many rows over several tasks and files.
    """
    spark, name = df.sparkSession, target.table_name(table)
    ensure_namespace(spark, target)
    df = described(df)
    if partition_by:
        df = df.hint("rebalance", partition_by).sortWithinPartitions(partition_by, PERIOD)
    if target.is_session:
        writer = df.write.mode("overwrite").format("parquet")
        writer = writer.option("path", location) if location else writer
        with settings(spark, {RELEASE_SHUFFLES: "true"}):
            (writer.partitionBy(partition_by) if partition_by else writer).saveAsTable(name)
    else:
        writer = df.writeTo(name).using("iceberg")
        (writer.partitionedBy(F.col(partition_by)) if partition_by else writer).createOrReplace()
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {quote_text(comment)}")
    if KEY_COLUMN in df.columns:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('unique_key' = '{KEY_COLUMN}')")
    return spark.table(name)


def create_if_absent(
    spark: SparkSession,
    target: CatalogTarget,
    table: str,
    schema: T.StructType,
    partition_by: tuple[str, ...] = (),
    location: str | None = None,
) -> str:
    """Creates an empty table with a fixed schema; another writer may have done so first."""
    name = target.table_name(table)
    ensure_namespace(spark, target)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    using = "parquet" if target.is_session else "iceberg"
    partitions = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    where = f" LOCATION {quote_text(location)}" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {using}{partitions}{where}")
    return name


def append_batch(df: DataFrame, name: str) -> int:
    """Appends rows to a table and returns how many; they are counted while they are written."""
    spark = df.sparkSession
    counted = Observation()
    rows = df.select(*spark.table(name).columns).observe(counted, F.count(F.lit(1)).alias("rows"))
    with settings(spark, {RELEASE_SHUFFLES: "true"}):
        rows.write.insertInto(name)
    return counted.get["rows"]


def overwrite_partitions(df: DataFrame, name: str) -> None:
    """Replaces the partitions that ``df`` has rows for, and leaves the others."""
    spark = df.sparkSession
    # For tables of the session catalog the mode is a session setting, not a writer option.
    with settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic", RELEASE_SHUFFLES: "true"}):
        df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def truncate_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def count_rows(df: DataFrame) -> int:
    return df.count()


def sample_table(
    df: DataFrame,
    columns: list[str],
    rows: int,
    target: CatalogTarget,
    table: str,
    location: str | None = None,
) -> DataFrame:
    """A new table with the first ``rows`` rows of some columns, in the order of these columns."""
    sample = df.select(*columns).orderBy(*columns).limit(rows)
    return replace_table(sample, target, table, location=location)


def write_probe(spark: SparkSession, target: CatalogTarget, table: str | None = None) -> DataFrame:
    """Checks a catalog by writing a row to a new table and reading it back."""
    table = table or f"write_probe_{uuid.uuid4().hex[:12]}"
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("writer", T.StringType())])
    drop_table(spark, target.table_name(table))
    name = create_if_absent(spark, target, table, schema)
    append_batch(spark.range(1, 2).select(F.col("id").cast("int"), F.lit("spark").alias("writer")), name)
    return spark.table(name)
