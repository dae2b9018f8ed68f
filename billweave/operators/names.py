"""Account names: the most recent known name of every usage and every paying account."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billweave.operators.lookups import Lookup, join_lookup, settle

USAGE_ID, USAGE_NAME = "usage_account_id", "usage_account_name"
PAYER_ID, PAYER_NAME = "bill_payer_account_id", "bill_payer_account_name"
ORIGIN = "source_relation"
LAST_USED, LAST_BILLED = "last_used", "last_billed"


@dataclass(frozen=True)
class AccountNames:
    """Name lookups for both kinds of accounts, one row per account and origin."""

    usage: Lookup
    payer: Lookup


def account_activity(staged: DataFrame) -> DataFrame:
    """Last usage start and last billing period of each combination of accounts and names.

    One narrow scan serves both name lookups; the aggregate shrinks the rows before the shuffle.
    """
    return staged.groupBy(ORIGIN, USAGE_ID, USAGE_NAME, PAYER_ID, PAYER_NAME).agg(
        F.max("usage_start_date").alias(LAST_USED),
        F.max("billing_period_start_date").alias(LAST_BILLED),
    )


def usage_account_names(activity: DataFrame) -> DataFrame:
    return _latest_names(activity, USAGE_ID, USAGE_NAME, LAST_USED)


def billing_account_names(activity: DataFrame) -> DataFrame:
    return _latest_names(activity, PAYER_ID, PAYER_NAME, LAST_BILLED)


def account_names(activity: DataFrame) -> AccountNames:
    """Both lookups from an activity table, measured so that joins know if they fit."""
    stored = settle(activity, "account-activity")
    usage, payer = usage_account_names(stored.table), billing_account_names(stored.table)
    if stored.fits():
        return AccountNames(stored.reduced_to(usage), stored.reduced_to(payer))
    return AccountNames(settle(usage, "usage-names"), settle(payer, "payer-names"))


def fill_names(staged: DataFrame, names: AccountNames) -> DataFrame:
    """Fills missing account names; an account without an id keeps a missing name.

    Both names are joined before either is filled, in one step over the wide rows instead of two.
    """
    columns, filled = staged.columns, {}
    for lookup, account_id, name in (
        (names.payer, PAYER_ID, PAYER_NAME),
        (names.usage, USAGE_ID, USAGE_NAME),
    ):
        known = f"__known_{name}"
        renamed = lookup.reduced_to(lookup.table.withColumnRenamed(name, known))
        keys = {account_id: account_id, ORIGIN: ORIGIN}
        staged = join_lookup(staged, renamed, keys, "left")
        filled[name] = F.coalesce(name, known).alias(name)
    return staged.select(*[filled.get(c, F.col(c)) for c in columns])


def _latest_names(activity: DataFrame, account_id: str, name: str, last_seen: str) -> DataFrame:
    """The name seen last; of names seen last at the same time, the first in the alphabet.

    The smallest (age, name) pair per account is an aggregate, so an account with very many names
    is combined before the shuffle. A ranking window would sort them in one task. Taking the last
    date of each name first would change nothing: the best pair is the same.
    """
    age = F.expr(f"timestamp_ntz'9999-12-31' - {last_seen}")
    by_age = F.min(F.struct(age.isNull().alias("undated"), age.alias("age"), F.col(name).alias("name")))
    return (
        activity.filter(F.col(name).isNotNull())
        .groupBy(account_id, ORIGIN)
        .agg(by_age.alias("latest"))
        .select(account_id, F.col("latest.name").alias(name), ORIGIN)
    )
