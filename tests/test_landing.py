import json
import random
import time

import pytest
from pyspark.sql import functions as F

from billweave.operators.staging import StagingOptions, stage_report
from billweave.plans.append import append_log, append_parquet
from billweave.plans.landing import land_report
from billweave.schema import REPORT_COLUMNS
from billweave.sinks.catalogs import CatalogTarget
from billweave.sources.event_logs import Number, as_text, event_records, record_of
from billweave.sources.files import read_csv_folder, read_csv_report, register_csv_folder
from billweave.sources.log_scan import scan_event_log

HERE = CatalogTarget("builtin", "cost_landing")


def _lines(month, version, report, n):
    return [
        {"_file": f"{report}/r/{i}", "_line": i, "_modified": version, "bill_billing_period_start_date": f"2024-{month}-01", "line_item_unblended_cost": i}
        for i in range(n)
    ]


def test_landing_drops_superseded_versions_by_name(spark, report):
    rows = _lines("03", "2024-03-09", "a", 3) + _lines("03", "2024-03-10 00:00:00.5", "a", 2) + _lines("04", "2024-04-01", "a", 2)
    rows += [{"_line": 9, "bill_billing_period_start_date": "2024-03-01"}, {"_line": 8, "_modified": "2024-09-01"}]
    raw = report(rows)
    landed = land_report(raw, HERE, "landed")
    assert landed.count() == 4 and landed.exceptAll(stage_report(raw).select(landed.columns)).count() == 0
    parts = {r[0].split("/")[1] for r in spark.sql("SHOW PARTITIONS cost_landing.landed").collect()}
    assert parts == {"file_version=2024-03-10 00%3A00%3A00.5", "file_version=2024-04-01 00%3A00%3A00"}
    kept = land_report(raw, HERE, "landed", keep_superseded=True)
    assert kept.count() == 4 and spark.table("cost_landing.landed").count() == 7
    assert kept.exceptAll(landed.sparkSession.createDataFrame(stage_report(raw).collect(), kept.schema)).count() == 0


def test_superseded_rows_are_not_written(spark, report, tmp_path):
    raw = report(_lines("03", "2024-03-09", "a", 3) + _lines("03", "2024-03-10", "a", 2))
    landed = land_report(raw, HERE, "lean", location=str(tmp_path / "lean"))
    # Partitions that are taken off a table with a location of its own leave their files behind.
    assert landed.count() == 2 and len(list((tmp_path / "lean").glob("*/file_version=*"))) == 1


def test_landing_by_other_version_keys(spark, report):
    options = StagingOptions(version_keys=("billing_period_start_date", "report"), start_date="2024-04-01")
    raw = report(_lines("03", "2024-03-09", "a", 3) + _lines("04", "2024-04-02", "a", 1) + _lines("04", "2024-04-01", "b", 2) + _lines("04", "2024-04-01", "a", 1))
    landed = land_report(raw, HERE, "keyed", options)
    expected = stage_report(raw, options)
    assert landed.count() == expected.count() == 3 and landed.exceptAll(expected.select(landed.columns)).count() == 0


def test_landing_needs_one_pass_over_the_text(spark, report, tmp_path):
    report(_lines("03", "2024-03-09", "a", 3)).write.csv(str(tmp_path / "in"), header=True)
    landed = land_report(read_csv_report(spark, str(tmp_path / "in")), HERE, "once")
    for file in (tmp_path / "in").glob("*.csv"):
        file.write_text("spoilt")
    plan = landed._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" not in plan and landed.count() == 3


def test_upper_case_columns(report):
    raw = report(_lines("03", "2024-03-09", "a", 2))
    upper = raw.toDF(*[c.upper() for c in raw.columns])
    assert stage_report(upper).exceptAll(stage_report(raw)).count() == 0 and stage_report(upper).count() == 2


def test_csv_folder_with_other_column_orders(spark, tmp_path):
    for name, text in {"one": "a,b\n1,2\n", "two": "b,A,c\n20,10,30\n", "sub/three": '﻿"c","b"\r\n300,200\r\n', "empty": ""}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / f"{name}.csv").write_text(text, newline="")
    rows = lambda df: [tuple(r) for r in df.select("a", "b", "c").collect()]
    found = read_csv_folder(spark, str(tmp_path))
    assert sorted(c.lower() for c in found.columns) == ["a", "b", "c"]
    assert sorted(map(str, rows(found))) == sorted(map(str, [("1", "2", None), ("10", "20", "30"), (None, "200", "300")]))
    only = read_csv_folder(spark, str(tmp_path), ["b", "z"])
    assert sorted(r.b for r in only.collect()) == ["2", "20", "200"] and {r.z for r in only.collect()} == {None}
    with pytest.raises(ValueError, match="unknown columns"):
        read_csv_folder(spark, str(tmp_path), ["a", "b"], unknown="fail")
    with pytest.raises(ValueError, match="lacks columns"):
        read_csv_folder(spark, str(tmp_path), missing="fail")
    with pytest.raises(ValueError, match="no CSV files"):
        (tmp_path / "none").mkdir()
        read_csv_folder(spark, str(tmp_path / "none"))
    (tmp_path / "none" / "twice.csv").write_text("a,A\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        read_csv_folder(spark, str(tmp_path / "none"))


def test_headers_of_csv_files_in_many_splits(spark, tmp_path):
    from billweave.sources.files import csv_headers

    for name, header in {"one": "a,b", "two": "b,a"}.items():
        (tmp_path / f"{name}.csv").write_text(header + "\n" + "".join(f"{i},x{i}\n" for i in range(3000)))
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "64")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        found = csv_headers(spark, [str(tmp_path / "two.csv"), str(tmp_path / "one.csv")])
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert list(found.values()) == [("b", "a"), ("a", "b")]


@pytest.mark.parametrize("bad_lines", ["fail", "null"])
def test_csv_files_of_other_headers_are_not_mixed_up(spark, tmp_path, bad_lines):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n20,10\n")
    with pytest.raises(Exception, match="header|Header"):
        read_csv_report(spark, str(tmp_path), bad_lines=bad_lines).collect()


def test_csv_views_fail_on_damaged_lines(spark, tmp_path):
    (tmp_path / "good-1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n4\n6,7,8\n")
    assert register_csv_folder(spark, str(tmp_path)) == ["bad", "good-1"]
    assert [tuple(r) for r in spark.sql("SELECT * FROM `good-1`").collect()] == [("1", "2")]
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        spark.table("bad").collect()


def _decoded(text):
    decoder, found, at = json.JSONDecoder(parse_float=Number), [], text.find("{")
    while at >= 0:
        try:
            inside, end = decoder.raw_decode(text, at)
        except json.JSONDecodeError:
            end = at + 1
        else:
            record = record_of(inside)
            found += [] if record is None else [tuple(as_text(record.get(c)) for c in REPORT_COLUMNS)]
        at = text.find("{", end)
    return found


def test_log_objects_across_lines_and_splits(spark, tmp_path):
    rng = random.Random(3)
    expected = []
    for k in range(2):
        parts = []
        for i in range(900):
            inside = {"_file": f"f{k}-{i}", "product": rng.choice(["x", "{ in text }", "{", "}{", 'q"uo"te', "long " * rng.randint(1, 600)])}
            inside = rng.choice([inside, inside, {"value": inside}, {"note": [inside]}, {"data": json.dumps(inside)}])
            parts.append(json.dumps(inside, indent=rng.choice([None, 1, 4])))
            parts.append(rng.choice(["\n", "\n\n", " INFO {a} {job \n", " and {\n", ' set {"k" = 1}\n']))
        (tmp_path / f"{k}.log").write_text("".join(parts))
        expected += _decoded("".join(parts))
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "64")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        found = [tuple(r) for r in scan_event_log(spark, str(tmp_path), longest=8000).collect()]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sorted(map(str, found)) == sorted(map(str, expected))


def test_log_scan_is_linear_in_braces():
    from billweave.sources.log_scan import _Split

    one = 'INFO [worker {7}] {job {"_file": "a", "_line": 1}} and {\n' + '{"_file": "' + "b" * 9000 + '", "product": {"a": [true, "}"]}}\n'
    for cut in (3000, 4096 - 12, 4096 - 3, 4096 - 1, 4096):  # tokens of all kinds cut by the end of a window
        for token in ("false", "-12.5e+3", '"\\u00e9"', '"text"', "null"):
            text = '{"_file": "' + "c" * (cut - 30) + '", "_line": ' + token + "}\n"
            assert _Split(("f", 0), "fail", 1 << 18).add(text + one).num_rows == 3
    began = time.monotonic()
    found = _Split(("f", 0), "fail", 1 << 18).add(one * 1000 + "{ } x {\n" * 100_000)
    assert found.num_rows == 2000 and time.monotonic() - began < 20


def test_cut_log_objects(spark, tmp_path):
    (tmp_path / "log").write_text('{"_file": "a"}\nINFO set {a} and {\n{"_file": "b", \n')
    with pytest.raises(Exception, match="does not end"):
        scan_event_log(spark, str(tmp_path / "log")).collect()
    assert [r._file for r in scan_event_log(spark, str(tmp_path / "log"), "skip").collect()] == ["a"]
    rows = spark.createDataFrame([("INFO set {a} and {",), ('{"_file": "cut", ',), ('{"k": ' * 12_000,)], "value string")
    assert event_records(rows.filter("value LIKE 'INFO%'")).count() == 0
    assert event_records(rows, cut_rows="skip").count() == 0
    with pytest.raises(Exception, match="separator"):
        event_records(rows.filter("value LIKE '{\"_file%'")).collect()


def test_appending_in_one_call(spark, report, tmp_path):
    (tmp_path / "log").write_text('{"_file": "a", "_line": 1}\n{"value": {"_file": "b"}}\n')
    assert append_log(spark, str(tmp_path / "log"), HERE, "appended") == 2
    report(_lines("03", "2024-03-09", "a", 3)).write.parquet(str(tmp_path / "in"))
    assert append_parquet(spark, str(tmp_path / "in"), HERE, "appended") == 3
    assert spark.table("cost_landing.appended").filter(F.col("_file").isNotNull()).count() == 5
    (tmp_path / "none").write_text("no record {}\n")
    with pytest.raises(ValueError, match="no report records"):
        append_log(spark, str(tmp_path / "none"), HERE, "appended")
