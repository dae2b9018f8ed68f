"""Landing of a raw report: its rows are cast once, and superseded file versions are left out.

Rows are written typed, partitioned by billing period and file version; no text is parsed again for any of the tables
made from them. Superseded rows are told by the raw texts of their version keys, in a narrow scan, and are neither cast
nor shuffled nor written. Where they are to be kept, all dated rows are written in one scan, and which version of a
period is the newest follows from the partitions' names.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billweave.operators.lookups import join_lookup, settle
from billweave.operators.staging import FLAG, PERIOD, VERSION, StagingOptions, stage_report, stage_versions
from billweave.schema import STAGING_COLUMNS
from billweave.sinks.catalogs import CatalogTarget
from billweave.sinks.tables import create_if_absent, drop_table

PERIOD_DAY, FILE_VERSION = "billing_period_day", "file_version"


def land_report(
    raw: DataFrame,
    target: CatalogTarget,
    table: str,
    options: StagingOptions = StagingOptions(),
    keep_superseded: bool = False,
    location: str | None = None,
) -> DataFrame:
    """Writes a report as a typed table, replacing an earlier one; returns the staging rows of its newest versions.

    Rows of superseded versions are not written unless ``keep_superseded`` is set. With other ``version_keys`` than the
    billing period, a period has several newest versions, which names don't tell: all are written, they are found by a
    scan of the keys, and kept rows are told by a join. Only tables of the session catalog can be landed in.
    """
    if not target.is_session:
        raise ValueError("a report is landed in the session catalog")
    spark = raw.sparkSession
    by_name = tuple(options.version_keys) == (PERIOD,)
    newest_only = by_name and not keep_superseded
    rows = (stage_report(raw, options).drop(FLAG) if newest_only else stage_versions(raw, options)).withColumns(
        {PERIOD_DAY: F.col(PERIOD).cast("date"), FILE_VERSION: F.col(VERSION).cast("string")}
    )
    drop_table(spark, target.table_name(table))
    name = create_if_absent(spark, target, table, rows.schema, (PERIOD_DAY, FILE_VERSION), location)
    rows.hint("rebalance", PERIOD_DAY, FILE_VERSION).select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    landed = spark.table(name)
    if by_name and keep_superseded:
        newest, _ = versions_by_name(spark, name)
        tests = [(F.col(PERIOD_DAY) == F.lit(p).cast("date")) & (F.col(FILE_VERSION) == v) for p, v in newest]
        landed = landed.filter(reduce(lambda a, b: a | b, tests, F.lit(False)))
    elif not newest_only:
        keys = options.version_keys
        latest = settle(landed.groupBy(*keys).agg(F.max(VERSION).alias("__latest")), "latest-versions")
        landed = join_lookup(landed, latest, {**{k: k for k in keys}, VERSION: "__latest"}, "inner", null_safe=True)
    return landed.withColumn(FLAG, F.lit(True)).select(*STAGING_COLUMNS)


def versions_by_name(spark: SparkSession, name: str) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """The newest (period, version) of each period of a landed table, and all others, from its partitions' names."""
    found = []
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
        parts = dict(p.split("=", 1) for p in row[0].split("/"))
        found.append((parts[PERIOD_DAY], unquote(parts[FILE_VERSION])))
    newest: dict[str, str] = {}
    for period, version in found:
        newest[period] = max(version, newest.get(period, ""))
    is_newest = [newest[p] == v for p, v in found]
    return [f for f, new in zip(found, is_newest) if new], [f for f, new in zip(found, is_newest) if not new]
