"""Output catalogs: which one the daily tables go to, and how it is configured in Spark."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billweave.functions import quote_name

# The output catalogs that can be written to, and their default settings. "builtin"
# is the session's own catalog.
LOCAL_KINDS = ("builtin",)
REST_KINDS: dict[str, dict[str, str]] = {
    "lakekeeper": {
        "uri": "http://localhost:18181/catalog",
        "warehouse": "demo",
        "namespace": "default",
    },
    "horizon": {
        "uri": "https://example.snowflakecomputing.com/polaris/api/catalog",
        "warehouse": "DEVELOPMENT",
        "namespace": "CLOUD_COST",
        "scope": "session:role:ACCOUNTADMIN",
        "delegation": "vended-credentials",
        "region": "us-west-2",
    },
    "polaris": {
        "uri": "https://example.polaris.catalog",
        "warehouse": "cloud_cost",
        "namespace": "cloud_cost",
        "scope": "PRINCIPAL_ROLE:ALL",
        "delegation": "vended-credentials",
        "region": "us-east-1",
    },
}
READ_ONLY_KINDS = ("unity",)
DEFAULT_KIND = "lakekeeper"


@dataclass(frozen=True)
class CatalogTarget:
    """One output catalog and the namespace the tables go to."""

    kind: str = "builtin"
    namespace: str = "default"

    def __post_init__(self) -> None:
        check_kind(self.kind)

    @classmethod
    def from_environment(cls, env: Mapping[str, str] = os.environ) -> CatalogTarget:
        """The catalog named in COST_TARGET_CATALOG, with its default or COST_CATALOG_SCHEMA."""
        kind = env.get("COST_TARGET_CATALOG") or DEFAULT_KIND
        check_kind(kind)
        fallback = REST_KINDS.get(kind, {}).get("namespace", "default")
        return cls(kind, env.get("COST_CATALOG_SCHEMA") or fallback)

    @property
    def is_session(self) -> bool:
        return self.kind in LOCAL_KINDS

    @property
    def schema_name(self) -> str:
        return quote_name(self.namespace if self.is_session else f"{self.kind}.{self.namespace}")

    def table_name(self, table: str) -> str:
        return f"{self.schema_name}.{quote_name(table)}"


def check_kind(kind: str) -> None:
    if kind in READ_ONLY_KINDS:
        raise ValueError(f"catalog {kind} is read-only and cannot take the tables")
    if kind not in (*LOCAL_KINDS, *REST_KINDS):
        raise ValueError(f"unknown catalog {kind}; one of {', '.join([*LOCAL_KINDS, *REST_KINDS])}")


def catalog_conf(kind: str, overrides: Mapping[str, str] | None = None) -> dict[str, str]:
    """The Spark properties of one output catalog, and of no other.

    ``overrides`` replaces defaults and adds ``credential`` or ``token``. The catalogs over REST
    need the public Iceberg runtime on the class path.
    """
    check_kind(kind)
    if kind in LOCAL_KINDS:
        return {}
    known = {**REST_KINDS[kind], **(overrides or {})}
    prefix = f"spark.sql.catalog.{kind}"
    spark_names = {
        "uri": "uri",
        "warehouse": "warehouse",
        "scope": "scope",
        "credential": "credential",
        "token": "token",
        "oauth_uri": "oauth2-server-uri",
        "delegation": "header.X-Iceberg-Access-Delegation",
        "region": "client.region",
        "namespace": "default-namespace",
    }
    unknown = set(known) - set(spark_names)
    if unknown:
        raise ValueError(f"unknown catalog settings: {', '.join(sorted(unknown))}")
    if known.get("credential") and "oauth_uri" not in known:
        known["oauth_uri"] = known["uri"].rstrip("/") + "/v1/oauth/tokens"
    return {
        prefix: "org.apache.iceberg.spark.SparkCatalog",
        f"{prefix}.type": "rest",
        **{f"{prefix}.{spark_names[k]}": v for k, v in known.items()},
    }


def activate(spark: SparkSession, target: CatalogTarget, overrides: Mapping[str, str] | None = None) -> None:
    """Configures the catalog of ``target`` in a running session, and no other of the known ones."""
    for other in REST_KINDS.keys() - {target.kind}:
        for key in spark.conf.getAll:
            if key == f"spark.sql.catalog.{other}" or key.startswith(f"spark.sql.catalog.{other}."):
                spark.conf.unset(key)
    for key, value in catalog_conf(target.kind, overrides).items():
        spark.conf.set(key, value)


def schema_name(
    custom: str | None,
    target_schema: str,
    env: Mapping[str, str] = os.environ,
    project_schema: str = "cloud_cost",
) -> str:
    """The namespace of a table.

    The project's own schema can be renamed as a whole by CATALOG_SCHEMA. A table without a schema
    goes to the target's, and any other schema is appended to the target's.
    """
    if custom is None:
        return target_schema
    if custom == project_schema:
        return (env.get("CATALOG_SCHEMA") or custom).strip()
    return f"{target_schema}_{custom.strip()}"


def list_catalogs(spark: SparkSession, names: list[str]) -> DataFrame:
    """Which of the named catalogs the session has loaded."""
    return spark.sql("SHOW CATALOGS").filter(F.col("catalog").isin(names))
