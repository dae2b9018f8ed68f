"""Queries of the driver contract: the library run on the driver's tables, with SQL to compare to.

All queries run over the raw report that ``billweave.sources.star_schema`` makes of the whole
``lineitem`` table, or over the whole ``events`` and ``orders`` tables.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from datetime import date
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle_queries  # noqa: E402
from billweave.operators import checks, staging  # noqa: E402
from billweave.operators.names import (  # noqa: E402
    account_activity,
    billing_account_names,
    usage_account_names,
)
from billweave.operators.overview import daily_overview, merged_overview, overview_states  # noqa: E402
from billweave.operators.rollups import daily_instance_report, daily_product_report  # noqa: E402
from billweave.plans.append import append_parquet  # noqa: E402
from billweave.plans.landing import land_report  # noqa: E402
from billweave.plans.marts import DailyTables, build_tables, check_tables  # noqa: E402
from billweave.schema import REPORT_COLUMNS, landing_schema  # noqa: E402
from billweave.session import prepare, scratch_path  # noqa: E402
from billweave.sinks.catalogs import CatalogTarget  # noqa: E402
from billweave.sinks.csv_files import write_csv  # noqa: E402
from billweave.sinks.tables import (  # noqa: E402
    append_batch,
    count_rows,
    create_if_absent,
    drop_table,
    replace_table,
    sample_table,
    truncate_table,
    write_probe,
)
from billweave.sources.event_logs import coerce_records  # noqa: E402
from billweave.sources.files import (  # noqa: E402
    read_csv_folder,
    read_csv_report,
    read_parquet_report,
    register_csv_folder,
)
from billweave.sources.landed_rows import ingest_rows  # noqa: E402
from billweave.sources.log_scan import scan_event_log  # noqa: E402
from billweave.sources.star_schema import raw_report  # noqa: E402
from billweave.sources.tables import ReportSource, read_report_table  # noqa: E402
from billweave.streaming.ingest import RawTable, ingest, landed_files  # noqa: E402
from billweave.streaming.refresh import DailyRefresh  # noqa: E402

try:  # the subpackage llm, its pipeline, or what they need may be left out of an installation
    import corpus_pipeline
    from billweave.llm import queries as llm_queries
    from billweave.llm import sql as llm_sql
except ImportError as missing:
    print(f"queries of the training-data operators are left out: {missing}", file=sys.stderr)
    corpus_pipeline = None

SMOKE_FOLDER = "/root/testdata/sf0.001"
SESSION_CATALOG = CatalogTarget("builtin", "default")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the daily product report of the smallest data set."""
    return queries()["daily_product_report"](spark, SMOKE_FOLDER)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator or chain of operators; see the README for what each one covers."""
    found = {
        "raw_report": raw_report,
        "typed_staging": lambda s, d: staging.type_report(raw_report(s, d)),
        "staging_report": _staged,
        "latest_file_version": _latest_file_version,
        "start_date_filter": lambda s, d: _staged(s, d, staging.StagingOptions(start_date="1998-01-01")),
        "usage_account_names": lambda s, d: usage_account_names(account_activity(_staged(s, d))),
        "billing_account_names": lambda s, d: billing_account_names(account_activity(_staged(s, d))),
        "daily_overview": _overview,
        "daily_product_report": lambda s, d: daily_product_report(_overview(s, d)),
        "daily_instance_report": lambda s, d: daily_instance_report(_overview(s, d)),
        "key_unique_failures": lambda s, d: checks.duplicated_keys(_overview(s, d)),
        "key_null_failures": lambda s, d: checks.null_keys(_overview(s, d)).select("unique_key"),
        "duplicates_of_a_dimension": lambda s, d: checks.duplicated_keys(_overview(s, d), "line_item_description"),
        "nulls_of_a_dimension": lambda s, d: checks.null_keys(_overview(s, d), "instance_type").select(
            "unique_key", "instance_type"
        ),
        "cast_failures": lambda s, d: staging.cast_failures(raw_report(s, d)),
        "row_counts": _row_counts,
        "restamped_report": _restamped_report,
        "ctas_sample": _ctas_sample,
        "append_readback": _append_readback,
        "event_envelopes": _event_envelopes,
        "stream_ingest_marts": _stream_ingest_marts,
        "written_overview": lambda s, d: _written(s, d).overview,
        "written_product_report": lambda s, d: _written(s, d).product,
        "written_instance_report": lambda s, d: _written(s, d).instance,
        "table_checks": _table_checks,
        "parquet_folder": _parquet_folder,
        "csv_folder": _csv_folder,
        "csv_catalog": _csv_catalog,
        "landed_report": _landed_report,
        "appended_parquet": _appended_parquet,
        "row_bounded_ingest": _row_bounded_ingest,
        "compacted_ingest": _compacted_ingest,
        "merged_states_overview": _merged_states_overview,
        "catalog_table": _catalog_table,
        "table_lifecycle": _table_lifecycle,
    }
    if corpus_pipeline is not None:
        found |= llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    return {name: _prepared(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    """The same results in DuckDB SQL, where SQL can express them."""
    found = oracle_queries.all_queries()
    if corpus_pipeline is not None:
        found |= llm_sql.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def _prepared(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: query(prepare(spark), folder)


def _staged(
    spark: SparkSession, folder: str, options: staging.StagingOptions = staging.StagingOptions()
) -> DataFrame:
    return staging.stage_report(raw_report(spark, folder), options)


def _overview(spark: SparkSession, folder: str) -> DataFrame:
    return daily_overview(_staged(spark, folder))


def _latest_file_version(spark: SparkSession, folder: str) -> DataFrame:
    return staging.flag_latest_version(raw_report(spark, folder)).select(
        "_file", "_line", "_modified", "billing_period_start_date", "is_latest_file_version"
    )


def _row_counts(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_report(spark, folder)
    staged = staging.stage_report(raw)
    return checks.row_counts({"raw": raw, "staging": staged, "overview": daily_overview(staged)})


def _restamped_report(spark: SparkSession, folder: str) -> DataFrame:
    """All lines under one file version, out to CSV files and back in."""
    path = scratch_path(spark, "restamped-csv")
    write_csv(staging.restamp(raw_report(spark, folder), oracle_queries.RESTAMPED_AT), path)
    return staging.stage_report(read_csv_report(spark, path))


def _ctas_sample(spark: SparkSession, folder: str) -> DataFrame:
    table = f"sample_{uuid.uuid4().hex}"
    return sample_table(
        raw_report(spark, folder), ["_file", "_line"], 10, SESSION_CATALOG, table, scratch_path(spark, table)
    )


def _append_readback(spark: SparkSession, folder: str) -> DataFrame:
    """Two appends to a new raw table, read back."""
    table = f"appended_{uuid.uuid4().hex}"
    name = create_if_absent(
        spark, SESSION_CATALOG, table, landing_schema(), location=scratch_path(spark, table)
    )
    records = coerce_records(raw_report(spark, folder), bad_values="null")
    append_batch(records.filter("bill_bill_type = 'Refund'"), name)
    append_batch(records.filter("bill_bill_type <> 'Refund'"), name)
    return spark.table(name)


def _written(spark: SparkSession, folder: str) -> DailyTables:
    """All tables of a production run, in a new namespace of the session catalog."""
    return build_tables(raw_report(spark, folder), CatalogTarget("builtin", f"daily_{uuid.uuid4().hex}"))


def _table_checks(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the written tables, after their data tests have passed."""
    tables = _written(spark, folder)
    problems = check_tables(tables)
    if problems:
        raise AssertionError("; ".join(problems))
    return checks.row_counts(tables.named())


def _parquet_folder(spark: SparkSession, folder: str) -> DataFrame:
    """The report out to Parquet files in folders of different depth, and back in as one relation."""
    path, raw = scratch_path(spark, "parquet-report"), raw_report(spark, folder)
    raw.filter(F.col("bill_bill_type") == "Refund").write.parquet(f"{path}/refunds")
    raw.filter(F.col("bill_bill_type") != "Refund").write.parquet(f"{path}/others/all/of/them")
    return read_parquet_report(spark, path)


def _csv_folder(spark: SparkSession, folder: str) -> DataFrame:
    """All CSV files of a folder, one half of them with the columns the other way round; blanks come back as NULL."""
    path, raw = scratch_path(spark, "csv-report"), raw_report(spark, folder)
    write_csv(raw.filter(F.col("bill_bill_type") == "Refund"), f"{path}/refunds.csv")
    write_csv(raw.filter(F.col("bill_bill_type") != "Refund").select(*reversed(REPORT_COLUMNS)), f"{path}/others.csv")
    return read_csv_folder(spark, path, REPORT_COLUMNS)


def _csv_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """The CSV files of a folder as views, found by listing."""
    path, raw, run = scratch_path(spark, "csv-catalog"), raw_report(spark, folder), uuid.uuid4().hex
    write_csv(raw.filter(F.col("bill_bill_type") == "Refund"), f"{path}/refunds_{run}.csv")
    write_csv(raw.filter(F.col("bill_bill_type") != "Refund"), f"{path}/others_{run}.csv")
    first, second = register_csv_folder(spark, path)
    return spark.table(first).unionByName(spark.table(second))


def _landed_report(spark: SparkSession, folder: str) -> DataFrame:
    """Staging from one pass over the text; superseded versions are dropped by partition names."""
    return land_report(raw_report(spark, folder), SESSION_CATALOG, f"landed_{uuid.uuid4().hex}")


def _merged_states_overview(spark: SparkSession, folder: str) -> DataFrame:
    """The overview merged from the partial aggregates of two loads."""
    staged = _staged(spark, folder)
    first = F.col("bill_type") == "Refund"
    return merged_overview(overview_states(staged.filter(first)).unionByName(overview_states(staged.filter(~first))))


def _appended_parquet(spark: SparkSession, folder: str) -> DataFrame:
    """A landed Parquet folder appended to a new raw table in one call, and the number of rows it returns."""
    path, table = scratch_path(spark, "landed-parquet"), f"appended_{uuid.uuid4().hex}"
    raw_report(spark, folder).write.parquet(f"{path}/of/a/day")
    rows = append_parquet(spark, path, SESSION_CATALOG, table, bad_values="null")
    return spark.createDataFrame([(rows,)], "n_rows long")


def _row_bounded_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows each batch has added to a raw table, with at most ``BOUNDED_ROWS`` a batch."""
    root, run = scratch_path(spark, "bounded"), uuid.uuid4().hex
    raw_report(spark, folder).write.parquet(f"{root}/landing")
    raw = RawTable(SESSION_CATALOG, f"bounded_{run}", f"{root}/raw", bad_values="null")
    ingest_rows(spark, f"{root}/landing", raw, f"{root}/checkpoint", oracle_queries.BOUNDED_ROWS)
    return spark.table(raw.name).groupBy("ingest_batch").agg(F.count(F.lit(1)).alias("n_rows"))


def _compacted_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """A raw table filled in three batches, the folders of its closed periods merged after each, and read back."""
    run, raw = uuid.uuid4().hex, raw_report(spark, folder)
    table = RawTable(SESSION_CATALOG, f"compacted_{run}", bad_values="null")
    table.create(spark)
    third = F.col("identity_line_item_id").cast("long") % 3
    for n in range(3):
        table.add_batch(raw.filter(third == n), f"batch-{n}")
        table.compact(spark, date(1996, 1, 1), [f"batch-{n}"])
    return table.read(spark).select(*landing_schema().names)


def _catalog_table(spark: SparkSession, folder: str) -> DataFrame:
    """Staging from a raw table that the environment names."""
    table = f"report_{uuid.uuid4().hex}"
    replace_table(raw_report(spark, folder), SESSION_CATALOG, table, location=scratch_path(spark, table))
    source = ReportSource.from_environment(
        {"COST_SOURCE_CATALOG": "spark_catalog", "COST_SOURCE_SCHEMA": "default", "COST_SOURCE_TABLE": table}
    )
    return staging.stage_report(read_report_table(spark, source))


def _table_lifecycle(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts of a table that is filled, truncated, filled with the refunds, and dropped."""
    table = f"lifecycle_{uuid.uuid4().hex}"
    name = create_if_absent(spark, SESSION_CATALOG, table, landing_schema())  # no path: only own tables are truncated
    records = coerce_records(raw_report(spark, folder), bad_values="null")
    counts = [("appended", append_batch(records, name))]
    truncate_table(spark, name)
    counts.append(("after truncate", count_rows(spark.table(name))))
    counts.append(("refunds", append_batch(records.filter("bill_bill_type = 'Refund'"), name)))
    drop_table(spark, name)
    counts.append(("tables after drop", int(spark.catalog.tableExists(name))))
    probe = f"probe_{uuid.uuid4().hex}"
    counts.append(("probe", count_rows(write_probe(spark, SESSION_CATALOG, probe))))
    drop_table(spark, SESSION_CATALOG.table_name(probe))
    return spark.createDataFrame(counts, "step string, n_rows long")


def _event_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """The events as objects printed over many lines, with other text around them, read back as report records."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    record = F.struct(
        F.col("event_type").alias("_file"),
        F.col("event_id").alias("_line"),
        F.concat(F.col("ts").cast("string"), F.lit("+02:00")).alias("_modified"),
        (F.lit(1_700_000_000_000) + F.col("event_id")).alias("_fivetran_synced"),
        F.col("value").alias("line_item_unblended_cost"),
        F.col("props").alias("product"),
        F.lit("").alias("line_item_usage_amount"),
        F.lit("other").alias("not_in_the_report"),
    )
    kind = F.col("event_id") % 3
    event = (
        F.when(kind == 0, F.to_json(F.struct(record.alias("value"), F.lit("k").alias("key")), {"pretty": "true"}))
        .when(kind == 1, F.to_json(F.struct(record.alias("data")), {"pretty": "true"}))
        .otherwise(F.to_json(record))
    )
    deep = F.lit('{"note": ' + '{"a": ' * 8 + "1" + "}" * 8 + "}")
    line = F.concat(F.lit("INFO [worker {7}] out: {job "), event, F.lit(' {"note": "no record"} } '), deep, F.lit(" done, set {a} and {"))
    path = scratch_path(spark, "event-log")
    events.select(line.alias("value")).write.text(path)
    return coerce_records(scan_event_log(spark, path)).select(
        "_file", "_line", "_modified", "_fivetran_synced", "line_item_unblended_cost",
        "line_item_usage_amount", "product",
    )


def _stream_ingest_marts(spark: SparkSession, folder: str) -> DataFrame:
    """The product report kept by a stream: half of the older file versions land first, then newer ones, which
    replace them, then the other half, which comes too late to count."""
    root = scratch_path(spark, "stream")
    run = uuid.uuid4().hex
    raw = raw_report(spark, folder)
    older, even = F.col("_modified").contains("-01 "), F.col("identity_line_item_id").cast("long") % 2 == 0
    raw_table = RawTable(SESSION_CATALOG, f"raw_{run}", f"{root}/raw", bad_values="null")
    refresh = DailyRefresh(raw_table, SESSION_CATALOG, prefix=f"live_{run}_", folder=f"{root}/tables")
    for arrival, rows in (("older", older & even), ("newer", ~older), ("late", older & ~even)):
        raw.filter(rows).write.parquet(f"{root}/landing/{arrival}")
        ingest(
            landed_files(spark, f"{root}/landing"),
            raw_table,
            f"{root}/checkpoint",
            interval_seconds=None,
            refresh=lambda batch: refresh.after_batch(spark, batch),
        ).start().awaitTermination()
    return refresh.read(spark, "product")
