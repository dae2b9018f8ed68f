"""Raw text report to typed staging rows of the latest file version of each billing period."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billweave.functions import maybe_infinite_number, no_number, product_name, report_name, typed_value, unreadable
from billweave.operators.lookups import join_lookup, settle
from billweave.schema import REPORT_COLUMNS, STAGING_SOURCES, TypePlan, missing_columns

# Origin written into every row, and start of the history, unless given.
DEFAULT_SOURCE_RELATION = "polaris.aws_cost_report"
DEFAULT_START_DATE = "1970-01-01"

PERIOD = "billing_period_start_date"
VERSION = "_modified"
FLAG = "is_latest_file_version"


@dataclass(frozen=True)
class StagingOptions:
    """How a raw report is staged.

    ``version_keys`` are the staging columns within which the newest ``_modified`` wins. The
    default looks at the billing period alone; add ``report``, ``bill_payer_account_id`` or
    ``source_relation`` when reports of several exports share a month.
    """

    types: TypePlan = field(default_factory=TypePlan)
    source_relation: str = DEFAULT_SOURCE_RELATION
    start_date: str = DEFAULT_START_DATE
    version_keys: tuple[str, ...] = (PERIOD,)
    allow_missing: bool = False


def type_report(raw: DataFrame, options: StagingOptions = StagingOptions()) -> DataFrame:
    """The origin of the rows and the 80 report columns, cast leniently."""
    raw = _with_numbers(_complete(raw, options), options)
    typed = _typed_columns(raw, options)
    return raw.select(
        F.lit(options.source_relation).alias("source_relation"),
        *[value.alias(name) for name, value in typed.items()],
    )


def flag_latest_version(raw: DataFrame, options: StagingOptions = StagingOptions()) -> DataFrame:
    """All rows under their staging names; the version flag is true, false or NULL.

    The newest version per period is aggregated and joined back. A window over the period would
    give the same flag, but sort all rows of a month in one task.
    """
    raw = _with_numbers(_complete(raw, options), options)
    staged = _staged_columns(raw, options)
    rows = raw.select(*[value.alias(name) for name, value in staged.items()])
    keys = options.version_keys
    latest = settle(_latest(rows, keys, VERSION), "latest-versions")
    joined = join_lookup(rows, latest, {k: k for k in keys}, "left", null_safe=True)
    flag = (F.col("__latest") == F.col(VERSION)).alias(FLAG)
    return joined.select(*[flag if c == FLAG else F.col(c) for c in STAGING_SOURCES])


def stage_report(raw: DataFrame, options: StagingOptions = StagingOptions()) -> DataFrame:
    """Typed rows of the latest file version of each billing period since the start date.

    Superseded rows are dropped by the raw texts of their version keys, before anything of them is cast: an export
    that keeps all its versions holds mostly superseded rows. A semi-join adds no column, so no wide row is copied.
    """
    if PERIOD not in options.version_keys:
        # Rows before the start date are dropped first, which is right within a billing period only.
        raise ValueError(f"version_keys must name {PERIOD}")
    raw = _complete(raw, options)
    newest = settle(_newest_texts(raw, options), "newest-texts")
    # NULL matches NULL: a plain test would also be taken down to the scan, as a filter for rows with all these texts.
    kept = join_lookup(raw, newest, {c: c for c in newest.table.columns}, "left_semi", null_safe=True)
    kept = _with_numbers(kept, options)
    values = {**_staged_columns(kept, options), FLAG: F.lit(True)}
    return kept.select(*[values[c].alias(c) for c in STAGING_SOURCES])


def stage_versions(raw: DataFrame, options: StagingOptions = StagingOptions()) -> DataFrame:
    """Typed rows of every dated file version since the start date, without the version flag.

    One scan: which version is the newest is left to whoever keeps the rows by version.
    """
    raw = _with_numbers(_complete(raw, options), options)
    rows = raw.select(*[value.alias(name) for name, value in _staged_columns(raw, options).items()])
    start = F.lit(options.start_date).cast("timestamp_ntz")
    return rows.filter((F.col(PERIOD) >= start) & F.col(VERSION).isNotNull())


def cast_failures(raw: DataFrame, options: StagingOptions = StagingOptions()) -> DataFrame:
    """Per report column: rows that hold a text which its type cannot take. Columns without any
    are left out."""
    raw = _complete(raw, options)
    typed = _typed_columns(raw, options)
    judged = [c for c in REPORT_COLUMNS if options.types.of(c) != "string"]
    texts = _number_texts(raw, options)
    counts = raw.agg(
        *[
            F.count_if(
                no_number(c, options.types.of(c)) if c in texts else unreadable(f"cast({c} as string)", typed[c])
            ).alias(c)
            for c in judged
        ]
    )
    return (
        counts.unpivot([], judged, "column_name", "failed_rows")
        .filter("failed_rows > 0")
        .select("column_name", "failed_rows")
    )


def restamp(raw: DataFrame, modified_at: str) -> DataFrame:
    """Gives all rows one file version."""
    return raw.withColumn(VERSION, F.lit(modified_at))


def _complete(raw: DataFrame, options: StagingOptions) -> DataFrame:
    """The report columns under their own names, whatever case the source writes them in."""
    by_lower = {c.lower(): c for c in raw.columns}
    renamed = {by_lower[c]: c for c in REPORT_COLUMNS if c in by_lower and c not in raw.columns}
    raw = raw.withColumnsRenamed(renamed) if renamed else raw
    absent = missing_columns(raw.columns)
    if not absent:
        return raw
    if not options.allow_missing:
        raise ValueError("report columns are missing: " + ", ".join(absent))
    return raw.withColumns({c: F.lit(None).cast("string") for c in absent})


def _with_numbers(raw: DataFrame, options: StagingOptions) -> DataFrame:
    """Number texts as numbers, perhaps infinite: each is cast once, and only then tested."""
    texts = _number_texts(raw, options)
    return raw.withColumns({c: maybe_infinite_number(c, options.types.of(c)) for c in texts}) if texts else raw


def _number_texts(raw: DataFrame, options: StagingOptions) -> list[str]:
    have = {f.name: f.dataType.simpleString() for f in raw.schema}
    return [c for c in REPORT_COLUMNS if have[c] == "string" and options.types.of(c) in ("float", "double")]


def _typed_columns(raw: DataFrame, options: StagingOptions) -> dict[str, Column]:
    have = {f.name: f.dataType.simpleString() for f in raw.schema}
    return {c: typed_value(c, have[c], options.types.of(c)) for c in REPORT_COLUMNS}


def _staged_columns(raw: DataFrame, options: StagingOptions) -> dict[str, Column]:
    """Every staging column but the version flag."""
    typed = _typed_columns(raw, options)
    computed = {
        "source_relation": F.lit(options.source_relation),
        "report": report_name(typed["_file"]),
        "product_name": product_name(typed["product_product_name"], typed["product"]),
    }
    return {
        name: computed[name] if name in computed else F.coalesce(*[typed[s] for s in sources])
        for name, sources in STAGING_SOURCES.items()
        if name != FLAG
    }


def _newest_texts(raw: DataFrame, options: StagingOptions) -> DataFrame:
    """The raw values of the version keys that mean the newest version since the start date.

    Each combination of raw values is stored first and cast once: a filter on what it means would else be taken
    down to the scan and be computed for each row.
    """
    keys = options.version_keys
    early = {c: f"__{c}" for c in dict.fromkeys([PERIOD, VERSION, *keys])}
    sources = {s for c in early for s in {"report": ("_file",)}.get(c, STAGING_SOURCES[c]) if s in raw.columns}
    staged = _staged_columns(raw, options)
    found = settle(raw.select(*sorted(sources)).distinct(), "version-texts").table
    # Nothing but the key columns is left to cast; the others are never asked for.
    keyed = found.select(*found.columns, *[staged[c].alias(alias) for c, alias in early.items()])
    # A day has started when its midnight is reached, so no cast to a date is needed.
    start = F.lit(options.start_date).cast("timestamp_ntz")
    keyed = keyed.filter((F.col(early[PERIOD]) >= start) & F.col(early[VERSION]).isNotNull())
    latest = _latest(keyed, [early[k] for k in keys], early[VERSION])
    latest = latest.withColumnsRenamed({early[k]: f"__latest_{k}" for k in keys})
    same = [F.col(early[k]).eqNullSafe(F.col(f"__latest_{k}")) for k in keys]
    on = reduce(lambda a, b: a & b, same, F.col(early[VERSION]) == F.col("__latest"))
    return keyed.join(latest, on, "left_semi").select(*found.columns)


def _latest(rows: DataFrame, keys: list[str] | tuple[str, ...], version: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.max(version).alias("__latest"))
