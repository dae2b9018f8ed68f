"""Joins to small derived tables that are broadcast only after their size has been measured."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billweave.session import scratch_path

# Rows are spread over this many salts when a lookup is too large to broadcast, unless told otherwise.
SALTS = 32
# Room taken by one row of a broadcast hash table besides its values.
_ROW_OVERHEAD = 64


@dataclass(frozen=True)
class Lookup:
    """A derived table with the measured size, in bytes, that it is known not to exceed."""

    table: DataFrame
    size: int

    def fits(self) -> bool:
        """Whether every executor may hold a copy, by the session's own broadcast limit."""
        return self.size <= _broadcast_limit(self.table.sparkSession)

    def reduced_to(self, table: DataFrame) -> Lookup:
        """A table made of at most one row per row of this one, and of no wider rows."""
        return replace(self, table=table)


def settle(df: DataFrame, label: str) -> Lookup:
    """Writes ``df`` to the shared folder and measures it in the same job.

    The stored copy cuts the lineage and outlives lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    measured = Observation()
    width = reduce(lambda a, b: a + b, [_width(f) for f in df.schema], F.lit(_ROW_OVERHEAD))
    df.observe(measured, F.sum(width).alias("size")).write.parquet(path)
    return Lookup(spark.read.schema(df.schema).parquet(path), measured.get["size"] or 0)


def join_lookup(
    df: DataFrame, lookup: Lookup, keys: dict[str, str], how: str, null_safe: bool = False, salts: int = SALTS
) -> DataFrame:
    """Joins ``df`` to a lookup; ``keys`` maps columns of ``df`` to columns of the lookup.

    The key columns of the lookup are dropped. While the lookup fits into a broadcast, ``df`` is
    not shuffled. Beyond that the join is shuffled by key and salt, so that neither a frequent key
    nor the rows without a key end up in a single task.
    """
    renamed = {right: f"__lookup_{right}" for right in keys.values()}
    table = lookup.table.withColumnsRenamed(renamed)
    on = [(F.col(left), F.col(renamed[right])) for left, right in keys.items()]
    if lookup.fits():
        table = F.broadcast(table)
    else:
        last = F.lit(salts - 1).cast("long")
        df = df.withColumn("__salt", F.pmod(F.xxhash64(*_row_identity(df)), F.lit(salts)))
        table = table.withColumn("__lookup_salt", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        on.append((F.col("__salt"), F.col("__lookup_salt")))
    matches = [a.eqNullSafe(b) if null_safe else a == b for a, b in on]
    joined = df.join(table, reduce(lambda a, b: a & b, matches), how)
    return joined.drop(*renamed.values(), "__salt", "__lookup_salt")


def _row_identity(df: DataFrame) -> list[str]:
    """Columns that tell report lines apart. A salt made of them is the same when a lost task is
    run again, which a counter or a random number would not be."""
    return [c for c in ("_file", "_line") if c in df.columns] or df.columns


def _width(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.StringType):
        return F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + 16
    return F.lit(16)


def _broadcast_limit(spark: SparkSession) -> int:
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().lower()
    digits = text.rstrip("bkmgtp")
    unit = {"": 1, "b": 1, "k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40, "p": 2**50}
    return int(digits) * unit[text[len(digits) :][:1]]
