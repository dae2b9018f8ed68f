"""Report tables of a catalog."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from billweave.functions import quote_name


@dataclass(frozen=True)
class ReportSource:
    """Where the raw report table is; an empty catalog means the session's own.

    The defaults are fixed values: they also make up the origin written into every staging row.
    """

    catalog: str = "polaris"
    schema: str = "cloud_cost"
    table: str = "aws_cost_report"

    @classmethod
    def from_environment(cls, env: Mapping[str, str] = os.environ) -> ReportSource:
        """Takes COST_SOURCE_CATALOG, COST_SOURCE_SCHEMA and COST_SOURCE_TABLE where set."""
        return cls(
            env.get("COST_SOURCE_CATALOG") or cls.catalog,
            env.get("COST_SOURCE_SCHEMA") or cls.schema,
            env.get("COST_SOURCE_TABLE") or cls.table,
        )

    @property
    def name(self) -> str:
        return quote_name(".".join(p for p in (self.catalog, self.schema, self.table) if p))

    @property
    def relation(self) -> str:
        """The origin of rows from this table."""
        return f"{self.catalog}.{self.table}"


def read_report_table(spark: SparkSession, source: ReportSource) -> DataFrame:
    return spark.table(source.name)
