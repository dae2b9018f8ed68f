from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from billweave import REPORT_COLUMNS, STAGING_COLUMNS, TypePlan
from billweave.functions import quote_name, report_name
from billweave.operators.staging import (
    StagingOptions,
    cast_failures,
    flag_latest_version,
    restamp,
    stage_report,
    type_report,
)

APRIL = {"bill_billing_period_start_date": "2024-04-01 00:00:00", "bill_billing_period_end_date": "2024-05-01 00:00:00"}
MARCH = {"bill_billing_period_start_date": "2024-03-01 00:00:00", "bill_billing_period_end_date": "2024-04-01 00:00:00"}


def test_report_name(spark):
    paths = {
        "/consolidated/20221201-20230101/v1/x.csv": "consolidated",
        "prefix/Report/data/BILLING_PERIOD=2024-03/x": "prefix/Report",
        "single": "single",
        None: None,
    }
    rows = spark.createDataFrame([(p,) for p in paths], "p string").select("p", report_name(F.col("p")).alias("r"))
    assert {r.p: r.r for r in rows.collect()} == paths


def test_only_the_latest_version_of_each_period_stays(report):
    raw = report(
        [
            {**APRIL, "_line": 1, "_modified": "2024-04-02 00:00:00"},
            {**APRIL, "_line": 2, "_modified": "2024-04-03 02:31:02"},
            {**APRIL, "_line": 3, "_modified": ""},
            {**MARCH, "_line": 4, "_modified": "2024-03-02 00:00:00"},
            {"_line": 5, "_modified": "2024-05-01 00:00:00"},
        ],
        _file="bucket/report/x",
    )
    staged = stage_report(raw)
    assert staged.columns == list(STAGING_COLUMNS) and len(staged.columns) == 74
    assert sorted(r._line for r in staged.collect()) == [2, 4]
    flags = {r._line: r.is_latest_file_version for r in flag_latest_version(raw).collect()}
    assert flags == {1: False, 2: True, 3: None, 4: True, 5: True}
    assert [r._line for r in stage_report(raw, StagingOptions(start_date="2024-04-01")).collect()] == [2]


def test_superseded_rows_go_by_their_raw_texts(report):
    lines = [
        {**APRIL, "_modified": m, "_line": n}
        for n, m in enumerate(["2024-04-20 00:00:00", "2024-04-20T00:00:00Z", "2024-04-03 00:00:00", "soon", ""], 1)
    ]
    staged = stage_report(report([*lines, {**APRIL, "bill_billing_period_start_date": "April", "_modified": "2024-05-01 00:00:00"}]))
    plan = staged._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "Join Inner" not in plan  # no column is added, so no wide row is copied
    below = plan[plan.index("LeftSemi") :]
    assert "try_cast" not in below.lower() and "cast(" not in below.lower()
    assert sorted(r._line for r in staged.collect()) == [1, 2]


def test_flag_equals_the_window(report):
    rows = [
        {"bill_billing_period_start_date": p, "_modified": m, "_line": n}
        for n, (p, m) in enumerate(
            (p, m)
            for p in ("", "2024-04-01", "2024-05-01 00:00:00", "bad")
            for m in ("", "2024-04-02", "2024-04-03 01:00:00", "2024-04-03T01:00:00Z")
        )
    ]
    flagged = flag_latest_version(report(rows))
    window = F.max("_modified").over(Window.partitionBy("billing_period_start_date")) == F.col("_modified")
    assert flagged.count() == len(rows)
    both = flagged.withColumn("w", window)
    assert both.filter(~F.col("w").eqNullSafe(F.col("is_latest_file_version"))).count() == 0


def test_version_keys_can_separate_reports(report):
    raw = report(
        [
            {**APRIL, "_file": "b/one/x", "_modified": "2024-04-02", "_line": 1},
            {**APRIL, "_file": "b/two/x", "_modified": "2024-04-03", "_line": 2},
        ]
    )
    assert [r._line for r in stage_report(raw).collect()] == [2]
    keys = StagingOptions(version_keys=("billing_period_start_date", "report"))
    assert sorted(r._line for r in stage_report(raw, keys).collect()) == [1, 2]


def test_a_lookup_too_large_to_broadcast_gives_the_same_rows(spark, report):
    raw = report(
        [{**(APRIL if n % 3 else MARCH), "_modified": f"2024-04-0{1 + n % 2}", "_line": n} for n in range(60)]
    )
    expected = sorted(r._line for r in stage_report(raw).collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = stage_report(raw)
        assert "Broadcast" not in shuffled._jdf.queryExecution().executedPlan().toString()
        assert sorted(r._line for r in shuffled.collect()) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fallbacks_and_names(report):
    row = stage_report(
        report(
            [{
                **APRIL, "_modified": "2024-04-02", "product_operation": "Store", "product_pricing_unit": "GB",
                "product": '{"product_name":"Cloud Compute","region":"x"}', "bill_invoice_id": "INV-1",
                "line_item_usage_amount": "1.5", "bill_payer_account_id": "100000000001",
            }]
        )
    ).first()
    assert (row.operation, row.pricing_unit, row.product_name) == ("Store", "GB", "Cloud Compute")
    assert row.usage_start_date == datetime(2024, 4, 1) and row.usage_end_date == datetime(2024, 5, 1)
    assert (row.invoice_id, row.usage_amount, row.bill_payer_account_id) == (None, 1.5, 100000000001)
    assert row.source_relation == "polaris.aws_cost_report"


def test_missing_columns(report):
    raw = report([{**APRIL, "_modified": "2024-04-02"}]).drop("product", "_line")
    with pytest.raises(ValueError, match="_line, product"):
        stage_report(raw)
    assert stage_report(raw, StagingOptions(allow_missing=True)).first()._line is None


def test_typed_input_keeps_its_types(report):
    raw = report([{**APRIL, "_modified": "2024-04-02", "_line": 7, "line_item_usage_amount": "0.1"}])
    wide = TypePlan(numbers="double")
    typed = type_report(raw, StagingOptions(types=wide)).drop("source_relation")
    staged, again = stage_report(typed, StagingOptions(types=wide)), stage_report(raw, StagingOptions(types=wide))
    assert staged.collect() == again.collect() and staged.schema == again.schema
    assert [n for n, _ in type_report(raw).dtypes] == ["source_relation", *REPORT_COLUMNS]


def test_cast_failures(report):
    raw = report([{"bill_invoice_id": "INV-1"}, {"bill_invoice_id": "7", "_line": "x"}, {"_modified": "soon"}])
    assert {r.column_name: r.failed_rows for r in cast_failures(raw).collect()} == {
        "bill_invoice_id": 1, "_line": 1, "_modified": 1,
    }


def test_restamp(report):
    raw = restamp(report([{**APRIL, "_modified": "2024-04-02"}, {**APRIL, "_modified": "2024-04-03"}]), "2026-05-28")
    assert stage_report(raw).count() == 2


def test_quote_name():
    assert quote_name("a.b`c.d") == "`a`.`b``c`.`d`"
