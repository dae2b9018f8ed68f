"""A raw text report made from the order tables, so that all queries run on given data.

Every line item becomes one report line. The report is a map over ``lineitem``; the only join is
the one to the fixed 25 nations, so reading the report costs what reading a report file costs.

Texts that hang on the nation, the service and the era alone are made once for each of these, before the join, and those
of a small remainder are picked from a list: a text that is put together for each line costs more than one that is there.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billweave.schema import REPORT_COLUMNS

# The value of every report column, each a different one, so that a wrong entry in a list of columns shows.
# What the overview groups by depends on few attributes, which keeps several lines in a group. Written in SQL
# that reads alike in common dialects. The name m is that of _PREPARED, service and
# era are those of _few_valued: accounts were renamed at the start of 1998.
FILLED_COLUMNS: dict[str, str] = {
    "_file": "concat(case when l_orderkey % 2 = 0 then '/' else '' end, 'exports/report_', "
    "cast(n_regionkey % 2 as string), '/data/BILLING_PERIOD=', m, '/f-00001.csv.gz')",
    "_fivetran_synced": "concat(m, '-28 12:00:00.5')",
    "_line": "concat(cast(l_linenumber as string), case when l_returnflag = 'N' then '.0' else '' end)",
    "_modified": "concat(m, '-0', cast(1 + l_linenumber % 2 as string), ' 06:00:00')",
    "bill_bill_type": "case l_returnflag when 'A' then 'Anniversary' when 'N' then 'Purchase' else 'Refund' end",
    "bill_billing_entity": "case l_linestatus when 'O' then 'AWS' else 'AWS Marketplace' end",
    "bill_billing_period_end_date": "concat(m, '-28 00:00:00')",
    "bill_billing_period_start_date": "concat(m, '-01T00:00:00Z')",
    "bill_invoice_id": "case l_returnflag when 'A' then '' when 'N' then 'INV-77' else '77' end",
    "bill_payer_account_id": "cast(100000000000 + n_regionkey % 2 as string)",
    "bill_payer_account_name": "case when l_linenumber = 5 then '' else concat('payer ', cast(n_regionkey % 2 as string), era) end",
    "identity_line_item_id": "cast(l_orderkey as string)",
    "line_item_blended_cost": "case when l_linestatus = 'O' then '' else cast(l_extendedprice as string) end",
    "line_item_blended_rate": "cast(l_discount as string)",
    "line_item_currency_code": "case n_regionkey % 2 when 0 then 'USD' else 'EUR' end",
    "line_item_line_item_description": "concat('usage of ', service)",
    "line_item_line_item_type": "case l_returnflag when 'R' then 'RIFee' else 'Usage' end",
    "line_item_normalization_factor": "cast(1 + l_partkey % 8 as string)",
    "line_item_normalized_usage_amount": "cast(l_quantity as string)",
    "line_item_operation": "case when l_linestatus = 'O' then '' else 'Run' end",
    "line_item_product_code": "concat('P-', service)",
    "line_item_unblended_cost": "cast(case when l_returnflag = 'R' then -l_extendedprice else l_extendedprice end as string)",
    "line_item_unblended_rate": "case when l_discount = 0 then '' else cast(l_discount as string) end",
    "line_item_usage_account_id": "cast(200000000000 + n_regionkey % 3 as string)",
    "line_item_usage_account_name": "case when l_linenumber in (3, 7) then '' else concat('region ', cast(n_regionkey % 3 as string), era) end",
    "line_item_usage_amount": "case when l_suppkey % 50 = 7 then 'n/a' else cast(l_quantity as string) end",
    "line_item_usage_end_date": "case when l_linenumber = 3 then '' else concat(m, '-03 0', cast(l_linenumber as string), ':00:00') end",
    "line_item_usage_start_date": "case when l_linenumber = 3 then '' else concat(m, '-02 0', cast(l_linenumber as string), ':00:00') end",
    "line_item_usage_type": "concat('type-', cast(l_partkey % 3 as string))",
    "pricing_public_on_demand_cost": "case when l_returnflag = 'R' then cast(l_extendedprice as string) else '' end",
    "pricing_public_on_demand_rate": "cast(l_tax as string)",
    "pricing_purchase_option": "case l_returnflag when 'R' then 'No Upfront' when 'A' then 'All Upfront' else '' end",
    "pricing_term": "case l_returnflag when 'R' then 'Reserved' else 'OnDemand' end",
    "pricing_unit": "case when l_linestatus = 'F' then '' else 'Hrs' end",
    "product_pricing_unit": "'GB'",
    "product_operation": "'Store'",
    "product": "concat('{\"product_name\":\"', service, ' Service\",\"region\":\"x\"}')",
    "product_product_name": "case when l_suppkey % 5 = 0 then '' else concat(service, ' Service') end",
    "product_region_code": "case when l_returnflag = 'N' then '' else concat('r-', cast(n_regionkey % 3 as string)) end",
    "product_servicecode": "concat('svc-', service)",
    "product_instance_family": "case l_partkey % 3 when 0 then 'General' else concat(service, ' optimised') end",
    "product_instance_type": "case when l_linestatus = 'F' then '' else 'm.large' end",
    "reservation_number_of_reservations": "case when l_returnflag = 'R' then cast(l_linenumber as string) else '' end",
    "reservation_total_reserved_units": "case when l_returnflag = 'R' then cast(l_quantity as string) else '' end",
    "reservation_unused_quantity": "case when l_returnflag = 'R' then cast(l_tax as string) else '' end",
    "reservation_effective_cost": "case when l_returnflag = 'R' then cast(l_discount as string) else '' end",
    "savings_plan_savings_plan_rate": "case when l_returnflag = 'N' then '' else cast(l_tax as string) end",
    "savings_plan_used_commitment": "cast(l_discount as string)",
    "bill_invoicing_entity": "case n_regionkey % 2 when 0 then 'Invoices Inc.' else 'Invoices SARL' end",
    "identity_time_interval": "concat(m, '-02T00:00:00Z/', m, '-03T00:00:00Z')",
    "line_item_availability_zone": "case when l_linestatus = 'F' then '' else concat('zone-', cast(n_regionkey % 3 as string), 'a') end",
    "line_item_resource_id": "concat('i-', cast(l_partkey as string))",
    "line_item_tax_type": "case l_returnflag when 'N' then 'VAT' else '' end",
    "pricing_currency": "case n_regionkey % 3 when 0 then 'USD' else 'GBP' end",
    "product_fee_code": "case l_returnflag when 'R' then concat('fee-', service) else '' end",
    "product_fee_description": "case l_returnflag when 'R' then concat('monthly fee of ', service) else '' end",
    "product_from_location": "concat('City ', cast(n_regionkey % 3 as string))",
    "product_from_location_type": "case n_regionkey % 2 when 0 then 'Origin region' else 'Origin edge' end",
    "product_from_region_code": "concat('from-', cast(n_regionkey % 3 as string))",
    "product_location": "concat('Site ', cast(n_regionkey % 3 as string))",
    "product_location_type": "case n_regionkey % 2 when 0 then 'Region' else 'Edge' end",
    "product_product_family": "concat(service, ' family')",
    "product_to_location": "case l_returnflag when 'A' then '' else concat('Town ', cast(n_regionkey % 3 as string)) end",
    "product_to_location_type": "case l_linestatus when 'O' then 'Target region' else 'Target edge' end",
    "product_to_region_code": "concat('to-', cast(n_regionkey % 2 as string))",
    "product_usagetype": "concat('product-type-', cast(l_partkey % 3 as string))",
    "reservation_amortized_upfront_cost_for_usage": "concat(cast(l_partkey % 101 as string), '.25')",
    "reservation_amortized_upfront_fee_for_billing_period": "concat(cast(l_partkey % 103 as string), '.25')",
    "reservation_normalized_units_per_reservation": "concat(cast(l_partkey % 107 as string), '.25')",
    "reservation_recurring_fee_for_usage": "concat(cast(l_partkey % 109 as string), '.25')",
    "reservation_total_reserved_normalized_units": "concat(cast(l_partkey % 113 as string), '.25')",
    "reservation_units_per_reservation": "concat(cast(l_partkey % 127 as string), '.25')",
    "reservation_unused_amortized_upfront_fee_for_billing_period": "concat(cast(l_partkey % 131 as string), '.25')",
    "reservation_unused_normalized_unit_quantity": "concat(cast(l_partkey % 137 as string), '.25')",
    "reservation_unused_recurring_fee": "concat(cast(l_partkey % 139 as string), '.25')",
    "reservation_upfront_value": "concat(cast(l_partkey % 149 as string), '.25')",
    "savings_plan_amortized_upfront_commitment_for_billing_period": "concat(cast(l_partkey % 151 as string), '.5')",
    "savings_plan_recurring_commitment_for_billing_period": "concat(cast(l_partkey % 157 as string), '.5')",
    "savings_plan_savings_plan_effective_cost": "concat(cast(l_partkey % 163 as string), '.5')",
    "savings_plan_total_commitment_to_date": "concat(cast(l_partkey % 167 as string), '.5')",
}

# The months from 1900 to 2099 as yyyy-MM.
_MONTHS = ",".join(f"{1900 + n // 12}-{n % 12 + 1:02d}" for n in range(2400))
_PREPARED: dict[str, str] = {
    # The month as yyyy-MM, from numbers: formatting a timestamp is far slower, and so is each way from a time to its day.
    # It is picked from a list; other centuries are put together.
    "day": "cast(l_shipdate as date)",
    "yyyymm": "year(day) * 100 + month(day)",
    "m": f"coalesce(get(split('{_MONTHS}', ','), (yyyymm div 100 - 1900) * 12 + yyyymm % 100 - 1), "
    "concat(substr(cast(yyyymm as string), 1, 4), '-', substr(cast(yyyymm as string), 5, 2)))",
}

# Parts of a line's number in ``_few_valued``: the nation, the service and the era. A part key that is missing, or has a
# remainder below 0, belongs to the last service; a line without a date to the later era.
_SERVICES = {0: "Compute", 1: "Storage", 2: "Network"}
_ERAS = {1: " (old)", 0: ""}
_NUMBER = (
    "cast(l_suppkey % 25 as bigint) * 6 + case l_partkey % 3 when 0 then 0 when 1 then 2 else 4 end "
    "+ case when l_shipdate < date'1998-01-01' then 1 else 0 end"
)
_FEW = {"n_regionkey", "service", "era"}
_CONCAT = re.compile(r"concat\((?:[^()']|'[^']*'|cast\([^()]*\))*\)")
_REMAINDER = re.compile(r"concat\(cast\((\w+ % (\d+)) as string\), '([.\d]+)'\)")


def _names_in(sql: str) -> set[str]:
    return set(re.findall(r"\b(?:[ln]_\w+|m|era|service)\b", re.sub("'[^']*'", "", sql)))


def _made_once() -> dict[str, str]:
    """Names for the texts put together from what has few values only, wherever they stand in a column."""
    found = dict.fromkeys(c for sql in FILLED_COLUMNS.values() for c in _CONCAT.findall(sql) if _names_in(c) <= _FEW)
    return {sql: f"__text_{i}" for i, sql in enumerate(found)}


def _few_valued(nation: DataFrame, texts: dict[str, str]) -> DataFrame:
    """Six rows per nation, one for each service in each era, with the texts that hang on these alone."""
    number = {f"try_multiply(cast(n_nationkey as bigint), 6L) + {2 * s + e}": (s, e) for s in _SERVICES for e in _ERAS}
    rows = [f"named_struct('number', {n}, 'service', '{_SERVICES[s]}', 'era', '{_ERAS[e]}')" for n, (s, e) in number.items()]
    few = nation.select("n_regionkey", F.expr(f"inline(array({', '.join(rows)}))"))
    return few.withColumns({name: F.expr(sql) for sql, name in texts.items()})


def _picked(sql: str) -> str:
    """The same text out of a list of all texts of a remainder; only for one below 0 is it put together."""
    found = _REMAINDER.fullmatch(sql)
    if not found:
        return sql
    remainder, n, ending = found.groups()
    texts = ",".join(f"{i}{ending}" for i in range(int(n)))
    return f"coalesce(get(split('{texts}', ','), cast({remainder} as int)), {sql})"


def raw_report(spark: SparkSession, folder: str) -> DataFrame:
    """The 80 text columns of a report with one line per row of ``lineitem``."""
    lineitem = spark.read.parquet(f"{folder}/lineitem.parquet")
    nation = spark.read.parquet(f"{folder}/nation.parquet").select("n_nationkey", "n_regionkey")
    texts = _made_once()
    lines = lineitem.join(F.broadcast(_few_valued(nation, texts)), F.expr(f"{_NUMBER} = number"))
    prepared = lines
    for name, sql in _PREPARED.items():
        prepared = prepared.withColumn(name, F.expr(sql))
    return prepared.select(
        *[
            F.expr(_CONCAT.sub(lambda found: texts.get(found[0]) or _picked(found[0]), FILLED_COLUMNS[c])).alias(c)
            for c in REPORT_COLUMNS
        ]
    )
