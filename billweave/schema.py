"""Columns, kinds and keys of the cost report and of the tables built from it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The 80 report columns that are read, in report order, and the
# kind of value each one carries.
# ---------------------------------------------------------------------------
_REPORT_COLUMNS = """
_file                                                          text
_fivetran_synced                                               time
_line                                                          int
_modified                                                      time
bill_bill_type                                                 text
bill_billing_entity                                            text
bill_billing_period_end_date                                   time
bill_billing_period_start_date                                 time
bill_invoice_id                                                int
bill_invoicing_entity                                          text
bill_payer_account_id                                          int
bill_payer_account_name                                        text
identity_line_item_id                                          text
identity_time_interval                                         text
line_item_availability_zone                                    text
line_item_blended_cost                                         number
line_item_blended_rate                                         number
line_item_currency_code                                        text
line_item_line_item_description                                text
line_item_line_item_type                                       text
line_item_normalization_factor                                 number
line_item_normalized_usage_amount                              number
line_item_operation                                            text
line_item_product_code                                         text
line_item_resource_id                                          text
line_item_tax_type                                             text
line_item_unblended_cost                                       number
line_item_unblended_rate                                       number
line_item_usage_account_id                                     int
line_item_usage_account_name                                   text
line_item_usage_amount                                         number
line_item_usage_end_date                                       time
line_item_usage_start_date                                     time
line_item_usage_type                                           text
pricing_currency                                               text
pricing_public_on_demand_cost                                  number
pricing_public_on_demand_rate                                  number
pricing_purchase_option                                        text
pricing_term                                                   text
pricing_unit                                                   text
product_pricing_unit                                           text
product_fee_code                                               text
product_fee_description                                        text
product_from_location                                          text
product_from_location_type                                     text
product_from_region_code                                       text
product_instance_family                                        text
product_instance_type                                          text
product_location                                               text
product_location_type                                          text
product_operation                                              text
product                                                        text
product_product_name                                           text
product_product_family                                         text
product_region_code                                            text
product_servicecode                                            text
product_to_location                                            text
product_to_location_type                                       text
product_to_region_code                                         text
product_usagetype                                              text
reservation_amortized_upfront_cost_for_usage                   number
reservation_amortized_upfront_fee_for_billing_period           number
reservation_effective_cost                                     number
reservation_normalized_units_per_reservation                   number
reservation_number_of_reservations                             int
reservation_recurring_fee_for_usage                            number
reservation_total_reserved_normalized_units                    number
reservation_total_reserved_units                               number
reservation_units_per_reservation                              number
reservation_unused_amortized_upfront_fee_for_billing_period    number
reservation_unused_normalized_unit_quantity                    number
reservation_unused_quantity                                    number
reservation_unused_recurring_fee                               number
reservation_upfront_value                                      number
savings_plan_amortized_upfront_commitment_for_billing_period   number
savings_plan_recurring_commitment_for_billing_period           number
savings_plan_savings_plan_effective_cost                       number
savings_plan_savings_plan_rate                                 number
savings_plan_total_commitment_to_date                          number
savings_plan_used_commitment                                   number
"""

REPORT_KINDS: dict[str, str] = dict(
    line.split() for line in _REPORT_COLUMNS.strip().splitlines()
)
REPORT_COLUMNS: tuple[str, ...] = tuple(REPORT_KINDS)

# ---------------------------------------------------------------------------
# The staging columns. After each name: the report columns it is
# filled from, the first one that has a value. Without any: computed.
# ---------------------------------------------------------------------------
_STAGING_COLUMNS = """
source_relation
_file                                 _file
report
_line                                 _line
_modified                             _modified
is_latest_file_version
bill_type                             bill_bill_type
billing_entity                        bill_billing_entity
billing_period_start_date             bill_billing_period_start_date
billing_period_end_date               bill_billing_period_end_date
invoice_id                            bill_invoice_id
invoicing_entity                      bill_invoicing_entity
bill_payer_account_id                 bill_payer_account_id
bill_payer_account_name               bill_payer_account_name
blended_cost                          line_item_blended_cost
blended_rate                          line_item_blended_rate
currency_code                         line_item_currency_code
normalization_factor                  line_item_normalization_factor
normalized_usage_amount               line_item_normalized_usage_amount
availability_zone                     line_item_availability_zone
line_item_description                 line_item_line_item_description
line_item_type                        line_item_line_item_type
tax_type                              line_item_tax_type
operation                             line_item_operation product_operation
product_code                          line_item_product_code
unblended_cost                        line_item_unblended_cost
unblended_rate                        line_item_unblended_rate
usage_account_id                      line_item_usage_account_id
usage_account_name                    line_item_usage_account_name
usage_amount                          line_item_usage_amount
usage_end_date                        line_item_usage_end_date bill_billing_period_end_date
usage_start_date                      line_item_usage_start_date bill_billing_period_start_date
usage_type                            line_item_usage_type
public_on_demand_cost                 pricing_public_on_demand_cost
public_on_demand_rate                 pricing_public_on_demand_rate
purchase_option                       pricing_purchase_option
pricing_term                          pricing_term
pricing_unit                          pricing_unit product_pricing_unit
product_fee_code                      product_fee_code
product_fee_description               product_fee_description
product_name
product_family                        product_product_family
product_service_code                  product_servicecode
instance_type                         product_instance_type
instance_family                       product_instance_family
location                              product_location
location_type                         product_location_type
region_code                           product_region_code
from_location                         product_from_location
from_location_type                    product_from_location_type
from_region_code                      product_from_region_code
to_location                           product_to_location
to_location_type                      product_to_location_type
to_region_code                        product_to_region_code
reservation_amortized_upfront_cost_for_usage           reservation_amortized_upfront_cost_for_usage
reservation_amortized_upfront_fee_for_billing_period   reservation_amortized_upfront_fee_for_billing_period
reservation_effective_cost            reservation_effective_cost
number_of_reservations                reservation_number_of_reservations
normalized_units_per_reservation      reservation_normalized_units_per_reservation
units_per_reservation                 reservation_units_per_reservation
total_reserved_normalized_units       reservation_total_reserved_normalized_units
total_reserved_units                  reservation_total_reserved_units
reservation_recurring_fee_for_usage   reservation_recurring_fee_for_usage
reservation_unused_amortized_upfront_fee_for_billing_period   reservation_unused_amortized_upfront_fee_for_billing_period
reservation_unused_normalized_unit_quantity            reservation_unused_normalized_unit_quantity
reservation_unused_quantity           reservation_unused_quantity
reservation_unused_recurring_fee      reservation_unused_recurring_fee
reservation_upfront_value             reservation_upfront_value
savings_plan_amortized_upfront_commitment_for_billing_period  savings_plan_amortized_upfront_commitment_for_billing_period
savings_plan_recurring_commitment_for_billing_period   savings_plan_recurring_commitment_for_billing_period
savings_plan_effective_cost           savings_plan_savings_plan_effective_cost
savings_plan_rate                     savings_plan_savings_plan_rate
savings_plan_total_commitment_to_date savings_plan_total_commitment_to_date
savings_plan_used_commitment          savings_plan_used_commitment
"""

STAGING_SOURCES: dict[str, tuple[str, ...]] = {
    words[0]: tuple(words[1:])
    for words in (line.split() for line in _STAGING_COLUMNS.strip().splitlines())
}
STAGING_COLUMNS: tuple[str, ...] = tuple(STAGING_SOURCES)

# ---------------------------------------------------------------------------
# Dimensions of the three daily tables, in the order in which
# they enter the hashed key.
# ---------------------------------------------------------------------------
OVERVIEW_DIMENSIONS: tuple[str, ...] = tuple("""
source_relation report usage_start_date usage_end_date
billing_period_start_date billing_period_end_date
usage_account_id usage_account_name bill_payer_account_id bill_payer_account_name
invoice_id invoicing_entity billing_entity bill_type line_item_type tax_type
purchase_option pricing_term product_fee_code product_fee_description
pricing_unit usage_type currency_code line_item_description
product_code product_service_code product_name product_family operation
instance_family instance_type location location_type region_code availability_zone
from_location from_location_type from_region_code
to_location to_location_type to_region_code
""".split())

_REPORT_DIMENSIONS = """
source_relation report usage_date billing_period_start_date billing_period_end_date
usage_account_id usage_account_name bill_payer_account_id bill_payer_account_name
currency_code
"""
PRODUCT_DIMENSIONS: tuple[str, ...] = tuple(
    (_REPORT_DIMENSIONS + "product_code product_name").split()
)
INSTANCE_DIMENSIONS: tuple[str, ...] = tuple((_REPORT_DIMENSIONS + "usage_type").split())

# ---------------------------------------------------------------------------
# Measures of the overview as "name aggregate staging-column".
# ---------------------------------------------------------------------------
_OVERVIEW_MEASURES = """
usage_amount                 total    usage_amount
normalized_usage_amount      total    normalized_usage_amount
normalization_factor         largest  normalization_factor
blended_cost                 total    blended_cost
unblended_cost               total    unblended_cost
public_on_demand_cost        total    public_on_demand_cost
avg_blended_rate             mean     blended_rate
avg_unblended_rate           mean     unblended_rate
avg_public_on_demand_rate    mean     public_on_demand_rate
count_line_items             rows     *
reservation_amortized_upfront_cost_for_usage          largest  reservation_amortized_upfront_cost_for_usage
reservation_amortized_upfront_fee_for_billing_period  largest  reservation_amortized_upfront_fee_for_billing_period
reservation_effective_cost          largest  reservation_effective_cost
number_of_reservations              largest  number_of_reservations
normalized_units_per_reservation    largest  normalized_units_per_reservation
units_per_reservation               largest  units_per_reservation
total_reserved_normalized_units     largest  total_reserved_normalized_units
total_reserved_units                largest  total_reserved_units
reservation_recurring_fee_for_usage largest  reservation_recurring_fee_for_usage
reservation_unused_amortized_upfront_fee_for_billing_period  smallest  reservation_unused_amortized_upfront_fee_for_billing_period
reservation_unused_normalized_unit_quantity           smallest reservation_unused_normalized_unit_quantity
reservation_unused_quantity         smallest reservation_unused_quantity
reservation_unused_recurring_fee    smallest reservation_unused_recurring_fee
reservation_upfront_value           largest  reservation_upfront_value
savings_plan_amortized_upfront_commitment_for_billing_period  largest  savings_plan_amortized_upfront_commitment_for_billing_period
savings_plan_recurring_commitment_for_billing_period  largest  savings_plan_recurring_commitment_for_billing_period
savings_plan_effective_cost         largest  savings_plan_effective_cost
savings_plan_rate                   largest  savings_plan_rate
savings_plan_total_commitment_to_date                 largest  savings_plan_total_commitment_to_date
savings_plan_used_commitment        largest  savings_plan_used_commitment
"""
OVERVIEW_MEASURES: tuple[tuple[str, str, str], ...] = tuple(
    tuple(line.split()) for line in _OVERVIEW_MEASURES.strip().splitlines()
)

# Sums shared by the product and the instance report, new name first.
ROLLUP_TOTALS: dict[str, str] = {
    "usage_amount": "usage_amount",
    "normalized_usage_amount": "normalized_usage_amount",
    "total_reserved_units": "total_reserved_units",
    "total_blended_cost": "blended_cost",
    "total_unblended_cost": "unblended_cost",
    "total_public_on_demand_cost": "public_on_demand_cost",
}
# Distinct counts of the two reports, new name first.
PRODUCT_COUNTS: dict[str, str] = {
    "count_regions": "region_code",
    "count_instances": "usage_type",
}
INSTANCE_COUNTS: dict[str, str] = {
    "count_products": "product_service_code",
    "count_regions": "region_code",
}

# Fixed value: type of every overview measure.
MEASURE_TYPE = "decimal(28,6)"
KEY_COLUMN = "unique_key"


@dataclass(frozen=True)
class TypePlan:
    """Spark types of the typed report.

    ``ids`` is used for the account, invoice and line numbers. Account numbers have twelve
    digits, so the default is 64 bits; ``"int"`` gives 32 bits (longer numbers become NULL)
    and ``"string"`` keeps alphanumeric invoice numbers. ``numbers`` is used for amounts, costs
    and rates: ``"float"``, ``"double"`` or a decimal such as ``"decimal(28,10)"``.
    """

    ids: str = "bigint"
    numbers: str = "float"

    def of(self, column: str) -> str:
        kind = REPORT_KINDS[column]
        if kind == "int":
            # Only identifiers may stay text; line and reservation counts are numbers.
            if self.ids == "string" and not column.endswith("_id"):
                return "bigint"
            return self.ids
        return {"text": "string", "time": "timestamp_ntz", "number": self.numbers}[kind]


def text_schema(columns: tuple[str, ...] = REPORT_COLUMNS) -> T.StructType:
    """Schema of a raw report: every column is text."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def landing_schema() -> T.StructType:
    """Schema of the raw table that ingest appends to, columns sorted by name."""
    kinds = {
        "text": T.StringType(),
        "time": T.TimestampNTZType(),
        "int": T.LongType(),
        "number": T.DoubleType(),
    }
    return T.StructType(
        [T.StructField(c, kinds[REPORT_KINDS[c]]) for c in sorted(REPORT_COLUMNS)]
    )


def missing_columns(columns: list[str]) -> list[str]:
    have = set(columns)
    return [c for c in REPORT_COLUMNS if c not in have]
