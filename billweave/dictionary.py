"""What the columns mean. The texts end up as column comments of the written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billweave.schema import STAGING_SOURCES

_TEXTS = """
cost_report: Standard cost and usage report, one record per line item.
_file: Path of the report file; exports that keep old versions put the version time into it.
report: Bucket and report name, the first two parts of the file path.
_fivetran_synced: When the record was loaded.
source_relation: Catalog and table that the record comes from.
_line: Line of the report file that the record was read from.
_modified: When the report file was last changed; the newest value of a billing period counts.
max_modified_for_billing_period: Newest file change within a billing period.
bill_bill_type: Kind of bill: Anniversary for monthly use, Purchase for upfront fees, Refund for negative costs.
bill_billing_entity: Whether a marketplace seller or another service is billed.
bill_billing_period_end_date: End of the billing period in UTC, exclusive.
bill_billing_period_start_date: Start of the billing period in UTC, inclusive.
bill_invoice_id: Invoice number; blank until the report is final.
bill_invoicing_entity: Company that issues the invoice.
bill_payer_account_id: Number of the account that pays.
bill_payer_account_name: Name of the account that pays; filled from the latest known name.
cost_category: Cost categories of the line item, as keys and values.
discount: Discounts that apply to the line item, as keys and values.
identity_line_item_id: Number of the line item within one partition of one report version.
identity_time_interval: Start and end of the interval that the line item covers, in UTC.
line_item_availability_zone: Availability zone of the resource.
line_item_blended_cost: Blended rate times usage; blank for discounts.
line_item_blended_rate: Average rate of a product over all accounts of an organization.
line_item_currency_code: Currency of the amounts.
line_item_legal_entity: Seller of record.
line_item_line_item_description: Text that describes the line item.
line_item_line_item_type: Kind of charge, such as Usage, DiscountedUsage, Tax, Fee or RIFee.
line_item_normalization_factor: Weight of the instance size; compares sizes of one family.
line_item_normalized_usage_amount: Usage times normalization factor.
line_item_operation: Operation that was charged; taken from the product when blank.
line_item_product_code: Short code of the measured product.
line_item_resource_id: Resource that was used, if reports list resources.
line_item_tax_type: Kind of tax.
line_item_unblended_cost: Unblended rate times usage.
line_item_unblended_rate: Rate of this account's own use of the product.
line_item_usage_account_id: Number of the account that used the service.
line_item_usage_account_name: Name of the account that used the service; filled from the latest known name.
line_item_usage_amount: Units used in the interval; for size-flexible reservations see the total reserved units.
line_item_usage_end_date: End of the usage in UTC, exclusive; the billing period's end when blank.
line_item_usage_start_date: Start of the usage in UTC, inclusive; the billing period's start when blank.
line_item_usage_type: What was used, such as an instance type or a transfer kind.
pricing_currency: Currency of the prices.
pricing_lease_contract_length: Length of a reservation term.
pricing_offering_class: Class of a reservation offer.
pricing_public_on_demand_cost: Cost at the public on-demand rate.
pricing_public_on_demand_rate: Public on-demand rate.
pricing_purchase_option: How a reservation is paid: all, part or nothing upfront.
pricing_rate_code: Code of product, offer and price together.
pricing_rate_id: Number of the rate.
pricing_term: Whether the use is on demand, reserved or spot.
pricing_unit: Unit that usage is priced in; taken from the product when blank.
product: Product attributes as JSON text.
product_fee_code: Code of a fee.
product_fee_description: Text of a fee.
product_from_location: Place a transfer starts from.
product_from_location_type: Kind of place a transfer starts from.
product_from_region_code: Region code a transfer starts from.
product_instance_family: Family of the instance.
product_instance_type: Instance type with its size.
product_location: Place of the resource.
product_location_type: Kind of place of the resource.
product_operation: Operation according to the product attributes.
product_pricing_unit: Unit according to the product attributes.
product_product_family: Category of the product.
product_product_name: Full name of the service; taken from the product attributes when blank.
product_region_code: Region code of the resource.
product_servicecode: Code of the service within the product.
product_sku: Code of the product as sold.
product_to_location: Place a transfer goes to.
product_to_location_type: Kind of place a transfer goes to.
product_to_region_code: Region code a transfer goes to.
product_usagetype: Usage type according to the product attributes.
reservation_amortized_upfront_cost_for_usage: Upfront payment spread over the used hours.
reservation_amortized_upfront_fee_for_billing_period: Upfront payment spread over the billing period.
reservation_effective_cost: Amortized upfront cost plus recurring fee.
reservation_end_time: End of the reservation.
reservation_modification_status: Whether the reservation was changed, and by whom.
reservation_normalized_units_per_reservation: Normalized units of one reservation.
reservation_number_of_reservations: Reservations covered by the subscription.
reservation_recurring_fee_for_usage: Recurring fee spread over the used hours.
reservation_reservation_a_r_n: Resource name of the reservation.
reservation_reservation_arn: Resource name of the reservation.
reservation_start_time: Start of the reservation.
reservation_subscription_id: Number of the offer a reservation belongs to.
reservation_total_reserved_normalized_units: Normalized units per reservation times number of reservations.
reservation_total_reserved_units: Reserved units; to be used instead of the usage amount for size-flexible reservations.
reservation_units_per_reservation: Reserved units of one reservation.
reservation_unused_amortized_upfront_fee_for_billing_period: Amortized upfront fee for unused hours.
reservation_unused_normalized_unit_quantity: Unused normalized units.
reservation_unused_quantity: Unused hours.
reservation_unused_recurring_fee: Recurring fee for unused hours.
reservation_upfront_value: Upfront price paid for the reservation.
resource_tags: Tags of the resource, as keys and values.
savings_plan_amortized_upfront_commitment_for_billing_period: Upfront commitment spread over the billing period.
savings_plan_end_time: End of the savings plan.
savings_plan_offering_type: Kind of savings plan.
savings_plan_payment_option: How the savings plan is paid.
savings_plan_purchase_term: Length of the savings plan.
savings_plan_recurring_commitment_for_billing_period: Monthly recurring commitment.
savings_plan_region: Region of the savings plan.
savings_plan_savings_plan_arn: Number of the savings plan.
savings_plan_savings_plan_effective_cost: Share of the monthly commitment for this usage.
savings_plan_savings_plan_rate: Savings plan rate of the usage.
savings_plan_start_time: Start of the savings plan.
savings_plan_total_commitment_to_date: Commitment so far, upfront and recurring.
savings_plan_used_commitment: Commitment used, rate times usage.
"""

DICTIONARY: dict[str, str] = dict(
    line.split(": ", 1) for line in _TEXTS.strip().splitlines()
)

# Columns that only the daily tables have, and columns that carry another entry's value.
_TABLE_COLUMNS = {
    "unique_key": "Hash over all dimensions of the table.",
    "is_latest_file_version": "Whether the record comes from the newest file of its billing period.",
    "count_line_items": "Number of line items.",
    "count_regions": "Number of different regions.",
    "count_instances": "Number of different usage types.",
    "count_products": "Number of different services.",
}
_SAME_AS = {
    "usage_date": "line_item_usage_start_date",
    "product_name": "product_product_name",
    "avg_blended_rate": "line_item_blended_rate",
    "avg_unblended_rate": "line_item_unblended_rate",
    "avg_public_on_demand_rate": "pricing_public_on_demand_rate",
    "total_blended_cost": "line_item_blended_cost",
    "total_unblended_cost": "line_item_unblended_cost",
    "total_public_on_demand_cost": "pricing_public_on_demand_cost",
}


def description(column: str) -> str:
    """The text for a column of a raw, staging or daily table; blank if there is none."""
    if column in _TABLE_COLUMNS:
        return _TABLE_COLUMNS[column]
    sources = STAGING_SOURCES.get(column) or (column,)
    return DICTIONARY.get(_SAME_AS.get(column, sources[0]), "")


def described(df: DataFrame) -> DataFrame:
    """``df`` with the descriptions as column comments, which tables keep."""
    return df.select(
        *[
            F.col(c).alias(c, metadata={"comment": description(c)}) if description(c) else F.col(c)
            for c in df.columns
        ]
    )
