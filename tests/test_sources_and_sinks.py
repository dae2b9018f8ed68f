import gzip

import pytest
from pyspark.sql import functions as F

from billweave.dictionary import DICTIONARY, description
from billweave.operators.staging import stage_report
from billweave.plans.marts import build_tables, check_tables
from billweave.schema import REPORT_COLUMNS, STAGING_COLUMNS, landing_schema
from billweave.sinks.catalogs import CatalogTarget, activate, catalog_conf, list_catalogs, schema_name
from billweave.sinks.csv_files import write_csv
from billweave.sinks.tables import (
    append_batch,
    count_rows,
    create_if_absent,
    drop_table,
    replace_table,
    sample_table,
    truncate_table,
    write_probe,
)
from billweave.sources.event_logs import coerce_records, event_records, read_event_log, unreadable_records
from billweave.sources.files import read_csv_report, read_parquet_report, register_csv_folder
from billweave.sources.tables import ReportSource, read_report_table

MONTH = {
    "_file": "bucket/report/data/x.csv", "_modified": "2024-05-02",
    "bill_billing_period_start_date": "2024-04-01 00:00:00", "bill_billing_period_end_date": "2024-05-01 00:00:00",
}
HERE = CatalogTarget("builtin", "cost_tests")


def test_csv_round_trip_keeps_quotes(spark, report, tmp_path):
    raw = report([{"product": '{"product_name":"A, \\"B\\""}', "_line": 1}, {"_file": "é/x", "_line": 2}], **MONTH)
    write_csv(raw, str(tmp_path / "csv"))
    back = read_csv_report(spark, str(tmp_path / "csv"))
    blank = raw.select(*[F.nullif(c, F.lit("")).alias(c) for c in raw.columns])
    assert back.columns == raw.columns and back.exceptAll(blank).count() == 0 and back.count() == 2


def test_csv_file_with_more_columns_and_declared_types(spark, tmp_path):
    file = tmp_path / "cost.csv"
    file.write_text('extra,' + ",".join(REPORT_COLUMNS) + "\n" + "zzz" + "," * REPORT_COLUMNS.index("product") + ',"{""product_name"":""A""}"' + "," * (len(REPORT_COLUMNS) - 1 - REPORT_COLUMNS.index("product")) + "\n")
    raw = read_csv_report(spark, str(file), {"_modified": "timestamp_ntz"})
    assert dict(raw.dtypes)["_modified"] == "timestamp_ntz" and raw.first().product == '{"product_name":"A"}'
    assert register_csv_folder(spark, str(tmp_path), ["cost.csv"]) == ["cost"]
    assert spark.table("cost").select("extra").first()[0] == "zzz"


def test_parquet_folder(spark, report, tmp_path):
    report([{"_line": 1}]).write.parquet(str(tmp_path / "a" / "b"))
    report([{"_line": 2}]).write.parquet(str(tmp_path / "c"))
    assert sorted(r._line for r in read_parquet_report(spark, str(tmp_path)).collect()) == ["1", "2"]
    assert [r._line for r in read_parquet_report(spark, str(tmp_path / "c" / "*.parquet")).collect()] == ["2"]
    report([]).write.parquet(str(tmp_path / "none"))
    with pytest.raises(ValueError, match="no report rows"):
        read_parquet_report(spark, str(tmp_path / "none"))


LOG = [
    'INFO {thread-1} start {"value": {"_file": "a", "_line": 1, "product": "{\\"k\\": 1}"}} and {"data": {"_file": "b"}}',
    '{"_file": "c", "_line": "3"} {"note": "none"} [{"_file": "d"},{"_file": "e"}]',
    '{broken {"value": {"_file": "f", "_modified": 1712000000}}',
    "nothing here",
]


def test_event_log(spark, tmp_path):
    (tmp_path / "log.txt").write_text("\n".join(LOG))
    found = event_records(read_event_log(spark, str(tmp_path / "log.txt")))
    assert found.columns == list(REPORT_COLUMNS)
    assert {r._file: r._line for r in found.collect()} == {"a": "1", "b": None, "c": "3", "d": None, "e": None, "f": None}
    assert found.filter("_file = 'a'").first().product == '{"k": 1}'


def test_event_log_with_objects_over_several_lines(spark, tmp_path):
    (tmp_path / "log.txt").write_text('one\n{\n  "value": {\n    "_file": "a"\n  }\n}\n{\n  "_file": "b"\n}\n')
    found = event_records(read_event_log(spark, str(tmp_path / "log.txt"), "\n}"))
    assert sorted(r._file for r in found.collect()) == ["a", "b"]


def test_records_are_coerced_or_refused(spark, report):
    records = report([{"_line": "5", "_modified": "1712000000", "line_item_usage_amount": "", "_file": ""}]).drop("product")
    good = coerce_records(records)
    assert good.schema == landing_schema()
    row = good.first()
    assert (row._line, row.line_item_usage_amount, row._file, row.product) == (5, None, "", None)
    bad = report([{"_line": "x", "bill_invoice_id": "INV-1"}, {"_line": "1"}])
    with pytest.raises(Exception, match="cannot read"):
        coerce_records(bad).collect()
    assert coerce_records(bad, "null").count() == 2
    assert [r.unreadable_columns for r in unreadable_records(bad).collect()] == [["_line", "bill_invoice_id"]]


def test_tables(spark, report):
    name = create_if_absent(spark, HERE, "raw", landing_schema())
    assert create_if_absent(spark, HERE, "raw", landing_schema()) == name
    assert append_batch(coerce_records(report([{"_line": 1}, {"_line": 2}])), name) == 2
    assert append_batch(coerce_records(report([{"_line": 3}])), name) == 1
    table = read_report_table(spark, ReportSource("", "cost_tests", "raw"))
    assert count_rows(table) == 3
    assert [r._line for r in sample_table(table, ["_line"], 2, HERE, "sampled").orderBy("_line").collect()] == [1, 2]
    truncate_table(spark, name)
    assert count_rows(spark.table(name)) == 0
    drop_table(spark, name)
    assert not spark.catalog.tableExists("cost_tests.raw")
    assert [tuple(r) for r in write_probe(spark, HERE).collect()] == [(1, "spark")]


def test_daily_tables_are_written_with_keys_and_comments(spark, report):
    days = [{**MONTH, "line_item_usage_start_date": f"2024-04-0{d} 10:00:00", "line_item_unblended_cost": "1"} for d in (1, 1, 2)]
    for _ in range(2):  # a second run replaces the tables of the first
        tables = build_tables(report(days), HERE)
    assert check_tables(tables) == []
    assert tables.overview.count() == 2 and tables.staging.columns == list(STAGING_COLUMNS)
    layout = spark.sql("DESCRIBE TABLE EXTENDED cost_tests.daily_overview").collect()
    about = {r.col_name: r for r in layout}
    assert about["usage_account_id"].comment == description("usage_account_id") != ""
    assert about["Comment"].data_type.startswith("Costs and usage")
    parts = {r[0] for r in spark.sql("SHOW PARTITIONS cost_tests.daily_overview").collect()}
    assert parts == {"usage_start_date=2024-04-01", "usage_start_date=2024-04-02"}
    empty = build_tables(report([]), CatalogTarget("builtin", "cost_empty"))
    assert len(check_tables(empty)) == 3


def test_dictionary_covers_all_columns(report):
    assert len(DICTIONARY) == 106 and set(REPORT_COLUMNS) <= set(DICTIONARY)
    assert all(description(c) for c in STAGING_COLUMNS)


def test_catalogs(spark):
    assert catalog_conf("builtin") == {}
    with pytest.raises(ValueError):
        catalog_conf("ducklake")
    conf = catalog_conf("polaris", {"credential": "id:secret", "uri": "https://x"})
    assert conf["spark.sql.catalog.polaris.type"] == "rest"
    assert conf["spark.sql.catalog.polaris.oauth2-server-uri"] == "https://x/v1/oauth/tokens"
    assert {k.split(".")[3] for k in catalog_conf("horizon")} == {"horizon"}
    for kind, message in (("unity", "read-only"), ("other", "unknown")):
        with pytest.raises(ValueError, match=message):
            CatalogTarget(kind)
    target = CatalogTarget.from_environment({"COST_TARGET_CATALOG": "polaris", "COST_CATALOG_SCHEMA": "x"})
    assert target.table_name("t") == "`polaris`.`x`.`t`" and not target.is_session
    assert CatalogTarget.from_environment({}).table_name("t") == "`lakekeeper`.`default`.`t`"
    activate(spark, HERE)
    assert [r[0] for r in list_catalogs(spark, ["spark_catalog", "other"]).collect()] == ["spark_catalog"]


def test_schema_names():
    assert schema_name(None, "main", {}) == "main"
    assert schema_name("cloud_cost", "main", {}) == "cloud_cost"
    assert schema_name("cloud_cost", "main", {"CATALOG_SCHEMA": " x "}) == "x"
    assert schema_name(" other ", "main", {"CATALOG_SCHEMA": "x"}) == "main_other"
    assert ReportSource.from_environment({"COST_SOURCE_TABLE": "t"}).relation == "polaris.t"


def test_csv_lines_that_do_not_fit(spark, tmp_path):
    from billweave.sources.files import read_csv_report

    for name, lines in {"short": "a,1", "long": "a,1,x,y", "broken": 'a,1,"x\ny"'}.items():
        path = str(tmp_path / f"{name}.csv")
        with open(path, "w") as file:
            file.write(f"p,q,r\nb,2,z\n{lines}\n")
        with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
            read_csv_report(spark, path).collect()
        rows = read_csv_report(spark, path, bad_lines="null").collect()
        assert [r["_corrupt_record"] is None for r in rows][0] and any(r["_corrupt_record"] for r in rows)
    assert read_csv_report(spark, str(tmp_path / "broken.csv"), multi_line=True).collect()[1]["r"] == "x\ny"


def test_csv_keeps_outer_blanks(spark, tmp_path):
    from billweave.sinks.csv_files import write_csv
    from billweave.sources.files import read_csv_report

    texts = ["  lead and trail  ", "a\ttab\t", 'say ""twice""', "plain"]
    write_csv(spark.createDataFrame([(t,) for t in texts], "t string"), str(tmp_path / "out"))
    assert sorted(r.t for r in read_csv_report(spark, str(tmp_path / "out")).collect()) == sorted(texts)


def test_event_objects_of_any_depth_and_between_braces(spark):
    from billweave.sources.event_logs import event_records

    deep = '{"_file":"deep","product":' + '{"a":' * 8 + "1" + "}" * 8 + "}"
    log = [deep, '{"value": ' + deep + "}", 'INFO {job {"value": {"_file": "kept", "_line": 1.50}} } end', None, "none {}"]
    rows = event_records(spark.createDataFrame([(t,) for t in log], "value string")).collect()
    assert sorted(r["_file"] for r in rows) == ["deep", "deep", "kept"]
    assert {r["_line"] for r in rows} == {None, "1.50"}
    with pytest.raises(Exception, match="separator"):
        event_records(spark.createDataFrame([('{"_file": "cut", ',)], "value string")).collect()


def test_csv_files_are_packed(spark, tmp_path):
    from billweave.sources.files import read_csv_folder

    rows = spark.range(50_000).selectExpr("cast(id as string) id", "concat('the same text in every line ', id % 3) text").coalesce(1)
    for name, compression in {"packed": "gzip", "plain": "none"}.items():
        write_csv(rows, str(tmp_path / f"{name}.csv"), compression)
    size = {n: sum(f.stat().st_size for f in (tmp_path / f"{n}.csv").glob("part-*")) for n in ("packed", "plain")}
    assert 3 * size["packed"] < size["plain"]
    (tmp_path / "three.csv.gz").write_bytes(gzip.compress(b"text,id\nt,x\n"))
    assert register_csv_folder(spark, str(tmp_path)) == ["packed", "plain", "three"]
    assert spark.table("packed").exceptAll(rows).isEmpty() and spark.table("packed").count() == 50_000
    found = read_csv_folder(spark, str(tmp_path), ["id", "text"])
    assert found.count() == 100_001 and [r.text for r in found.filter("id = 'x'").collect()] == ["t"]


def test_texts_of_few_values_are_made_before_the_join(spark, tmp_path):
    from billweave.schema import REPORT_COLUMNS
    from billweave.sources.star_schema import _PREPARED, FILLED_COLUMNS, raw_report

    keys = [None, -26, -1, 0, 1, 2, 7, 24, 25, 32]
    parts = [None, -5, -3, 0, 1, 2, 100, 149]
    days = [None, "1997-12-31 00:00:00", "1998-01-01 00:00:00"]
    spark.sql("select explode(sequence(0, 479)) as i").selectExpr(
        "i as l_orderkey",
        f"element_at(array({', '.join(f'cast({k} as bigint)' if k is not None else 'null' for k in parts)}), 1 + i % 8) as l_partkey",
        f"element_at(array({', '.join(f'cast({k} as bigint)' if k is not None else 'null' for k in keys)}), cast(1 + i div 8 % 10 as int)) as l_suppkey",
        "if(i % 11 = 0, null, 1 + i % 7) as l_linenumber",
        "cast(i as double) as l_quantity", "i * 1.5d as l_extendedprice", "i % 3 / 100d as l_discount", "i % 5 / 100d as l_tax",
        "element_at(array('A', 'N', 'R', null), 1 + i % 4) as l_returnflag", "if(i % 2 = 0, 'O', 'F') as l_linestatus",
        f"cast(element_at(array({', '.join(repr(d) if d else 'null' for d in days)}), 1 + i % 3) as timestamp_ntz) as l_shipdate",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame(
        [(k, k % 5) for k in range(25)] + [(7, 3), (-1, 2), (2, None), (None, 1), (2**62, 1)], "n_nationkey long, n_regionkey long"
    ).write.parquet(str(tmp_path / "nation.parquet"))

    plain = spark.read.parquet(str(tmp_path / "lineitem.parquet")).join(
        spark.read.parquet(str(tmp_path / "nation.parquet")), F.expr("l_suppkey % 25 = n_nationkey")
    )
    era = "case when year(l_shipdate) < 1998 then ' (old)' else '' end"
    service = "case l_partkey % 3 when 0 then 'Compute' when 1 then 'Storage' else 'Network' end"
    for name, sql in {**_PREPARED, "era": era, "service": service}.items():
        plain = plain.withColumn(name, F.expr(sql))
    plain = plain.select(*[F.expr(FILLED_COLUMNS[c]).alias(c) for c in REPORT_COLUMNS])
    report = raw_report(spark, str(tmp_path))
    assert report.count() == plain.count() > 300
    assert report.exceptAll(plain).isEmpty() and plain.exceptAll(report).isEmpty()

    lines = report._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "payer " not in lines and "monthly fee of " not in lines
