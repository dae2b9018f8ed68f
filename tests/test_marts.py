import hashlib
from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from billweave.operators.checks import duplicated_keys, null_keys, row_counts
from billweave.operators.names import account_activity, account_names, billing_account_names, usage_account_names
from billweave.operators.overview import daily_overview
from billweave.operators.rollups import daily_instance_report, daily_product_report
from billweave.operators.staging import stage_report
from billweave.schema import INSTANCE_DIMENSIONS, OVERVIEW_DIMENSIONS

MONTH = {
    "_file": "bucket/report/data/x.csv", "_modified": "2024-05-02",
    "bill_billing_period_start_date": "2024-04-01 00:00:00", "bill_billing_period_end_date": "2024-05-01 00:00:00",
}


def md5_of(values):
    null = "_dbt_utils_surrogate_key_null_"
    return hashlib.md5("-".join(null if v is None else str(v) for v in values).encode()).hexdigest()


def test_one_sparse_line(report):
    """A line with hardly any value: sums are zero, other measures NULL, the fallbacks fill in."""
    staged = stage_report(
        report([{
            **MONTH, "bill_bill_type": "Anniversary", "bill_payer_account_id": 1234,
            "bill_payer_account_name": "Payer", "product": '{"product_name":"Cloud Compute"}',
        }])
    )
    overview = daily_overview(staged)
    row = overview.first()
    assert len(overview.columns) == 72 and overview.count() == 1
    assert (row.report, row.usage_start_date, row.usage_end_date) == ("bucket/report", date(2024, 4, 1), date(2024, 5, 1))
    assert (row.bill_payer_account_name, row.usage_account_name, row.product_name) == ("Payer", None, "Cloud Compute")
    zero = Decimal("0.000000")
    assert (row.usage_amount, row.blended_cost, row.count_line_items) == (zero, zero, Decimal(1))
    assert row.avg_blended_rate is None and row.savings_plan_rate is None
    assert row.unique_key == md5_of([row[c] if c not in ("billing_period_start_date", "billing_period_end_date") else f"{row[c]}" for c in OVERVIEW_DIMENSIONS])
    for made, columns in ((daily_product_report, 21), (daily_instance_report, 20)):
        result = made(overview)
        assert result.count() == 1 and len(result.columns) == columns
        assert result.first().count_regions == 0 and result.first().total_blended_cost == zero


def test_measures(report):
    lines = [
        {"line_item_unblended_cost": "1.25", "line_item_blended_rate": "0.5", "reservation_total_reserved_units": "3", "reservation_unused_quantity": "4"},
        {"line_item_unblended_cost": "-0.75", "line_item_blended_rate": "1.0", "reservation_total_reserved_units": "5", "reservation_unused_quantity": "2"},
        {"line_item_unblended_cost": "", "line_item_blended_rate": ""},
    ]
    row = daily_overview(stage_report(report(lines, **MONTH))).first()
    assert row.unblended_cost == Decimal("0.5") and row.avg_blended_rate == Decimal("0.75")
    assert row.total_reserved_units == 5 and row.reservation_unused_quantity == 2 and row.count_line_items == 3


def test_names_fill_in(report):
    lines = [
        {"line_item_usage_account_id": 1, "line_item_usage_account_name": "old", "line_item_usage_start_date": "2024-04-01"},
        {"line_item_usage_account_id": 1, "line_item_usage_account_name": "new", "line_item_usage_start_date": "2024-04-09"},
        {"line_item_usage_account_id": 1},
        {"line_item_usage_account_id": 2, "line_item_usage_account_name": "b", "line_item_usage_start_date": "2024-04-03"},
        {"line_item_usage_account_id": 2, "line_item_usage_account_name": "a", "line_item_usage_start_date": "2024-04-03"},
        {"line_item_usage_account_name": "nobody"},
        {},
    ]
    staged = stage_report(report(lines, **MONTH))
    activity = account_activity(staged)
    assert {r[0]: r[1] for r in usage_account_names(activity).collect()} == {1: "new", 2: "a", None: "nobody"}
    assert billing_account_names(activity).count() == 0
    got = daily_overview(staged, account_names(activity)).groupBy("usage_account_id", "usage_account_name").count()
    names = {(r[0], r[1]) for r in got.collect()}
    # An account keeps the name of the line; only a missing one is filled, and only by an id.
    assert names == {(1, "old"), (1, "new"), (2, "a"), (2, "b"), (None, "nobody"), (None, None)}


def test_names_too_many_to_broadcast_fill_in_the_same(spark, report):
    lines = [
        {"line_item_usage_account_id": n % 5 or "", "line_item_usage_account_name": f"n{n}" if n % 3 else "", "_line": n,
         "line_item_usage_start_date": f"2024-04-{10 + n % 9}"}
        for n in range(60)
    ]
    staged = stage_report(report(lines, **MONTH))
    expected = daily_overview(staged).collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = daily_overview(staged)
        assert shuffled._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == 2
        assert sorted(shuffled.collect(), key=str) == sorted(expected, key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rollups(report):
    lines = [
        {"line_item_usage_type": t, "product_region_code": r, "product_servicecode": s, "line_item_unblended_cost": c}
        for t, r, s, c in (("box", "r1", "s1", "1"), ("box", "r2", "s2", "2"), ("box", "", "s2", "3"), ("net", "r1", "s1", "4"))
    ]
    overview = daily_overview(stage_report(report(lines, **MONTH)))
    product = daily_product_report(overview).first()
    assert (product.count_regions, product.count_instances, product.total_unblended_cost) == (2, 2, 10)
    by_type = {r.usage_type: r for r in daily_instance_report(overview).collect()}
    assert (by_type["box"].count_products, by_type["box"].count_regions, by_type["box"].total_unblended_cost) == (2, 2, 6)
    assert by_type["net"].unique_key == md5_of([by_type["net"][c] for c in INSTANCE_DIMENSIONS])


def test_checks(spark):
    table = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "unique_key string")
    assert [tuple(r) for r in duplicated_keys(table).collect()] == [("a", 2)]
    assert null_keys(table).count() == 2
    assert {tuple(r) for r in row_counts({"t": table, "none": table.limit(0)}).collect()} == {("t", 5), ("none", 0)}


def test_the_only_wide_shuffle_is_after_partial_aggregation(report):
    plan = daily_overview(stage_report(report([MONTH])))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BatchEvalPython" not in plan and "Window" not in plan
    assert plan.count("BroadcastHashJoin") == 3


def test_names_are_filled_in_groups_not_in_rows(report):
    plan = daily_overview(stage_report(report([MONTH])))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan[plan.rindex("LeftOuter") :]
