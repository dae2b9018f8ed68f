"""From a raw report to the daily tables, step by step or as one run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from billweave.operators.checks import duplicated_keys, empty_tables, null_keys
from billweave.operators.overview import daily_overview
from billweave.operators.rollups import daily_instance_report, daily_product_report
from billweave.operators.staging import StagingOptions, stage_report
from billweave.plans.landing import land_report
from billweave.sinks.catalogs import CatalogTarget
from billweave.sinks.tables import replace_table

STAGING_TABLE = "staging_report"
OVERVIEW_TABLE = "daily_overview"
PRODUCT_TABLE = "daily_product_report"
INSTANCE_TABLE = "daily_instance_report"


@dataclass(frozen=True)
class DailyTables:
    """The written tables."""

    staging: DataFrame
    overview: DataFrame
    product: DataFrame
    instance: DataFrame

    def named(self) -> dict[str, DataFrame]:
        return {OVERVIEW_TABLE: self.overview, PRODUCT_TABLE: self.product, INSTANCE_TABLE: self.instance}


def build_tables(
    raw: DataFrame,
    target: CatalogTarget,
    options: StagingOptions = StagingOptions(),
    staging_target: CatalogTarget | None = None,
) -> DailyTables:
    """Writes the staging table and the three daily tables, replacing earlier ones.

    Every table is read back for the next step: raw text is parsed once for all tables
    (:mod:`billweave.plans.landing`), and the two reports aggregate the stored, rounded overview. Staging
    stays in the session catalog unless told otherwise, where superseded rows are found by a scan of
    their own; the daily tables go to ``target``.
    """
    home = staging_target or CatalogTarget("builtin", target.namespace)
    if home.is_session:
        staging = land_report(raw, home, STAGING_TABLE, options)
    else:
        staging = replace_table(stage_report(raw, options), home, STAGING_TABLE)
    overview = replace_table(
        daily_overview(staging), target, OVERVIEW_TABLE, "usage_start_date",
        "Costs and usage per day and all dimensions of a line item.",
    )
    product = replace_table(
        daily_product_report(overview), target, PRODUCT_TABLE, "usage_date",
        "Costs and usage per day, account and product.",
    )
    instance = replace_table(
        daily_instance_report(overview), target, INSTANCE_TABLE, "usage_date",
        "Costs and usage per day, account and usage type.",
    )
    return DailyTables(staging, overview, product, instance)


def check_tables(tables: DailyTables) -> list[str]:
    """What is wrong with the written tables: repeated keys, missing keys, or no rows at all."""
    problems = [f"{r.table_name} is empty" for r in empty_tables(tables.named()).collect()]
    for name, table in tables.named().items():
        if not duplicated_keys(table).isEmpty():
            problems.append(f"{name} has repeated keys")
        if not null_keys(table).isEmpty():
            problems.append(f"{name} has rows without a key")
    return problems
