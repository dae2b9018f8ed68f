"""Column expressions: lenient and strict casts, report texts, hashed keys."""

from billweave.functions.casts import (
    blank_to_null,
    ingest_time,
    ingest_value,
    lenient_cast,
    lenient_int,
    lenient_number,
    lenient_time,
    maybe_infinite_number,
    no_number,
    strict,
    typed_value,
    unreadable,
)
from billweave.functions.keys import day_of, surrogate_key
from billweave.functions.texts import (
    product_name,
    quote_name,
    quote_text,
    report_name,
    trim_slashes,
)

__all__ = [
    "blank_to_null",
    "day_of",
    "ingest_time",
    "ingest_value",
    "lenient_cast",
    "lenient_int",
    "lenient_number",
    "lenient_time",
    "maybe_infinite_number",
    "no_number",
    "product_name",
    "quote_name",
    "quote_text",
    "report_name",
    "strict",
    "surrogate_key",
    "trim_slashes",
    "typed_value",
    "unreadable",
]
