"""Text expressions of the staging step, and quoting of names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: where the product name stands in the JSON text of the product column.
PRODUCT_NAME_PATTERN = '"product_name":"([^"]+)"'


def trim_slashes(text: Column) -> Column:
    return F.btrim(text, F.lit("/"))


def report_name(file: Column) -> Column:
    """First two parts of the file path, without outer slashes; NULL for a NULL path."""
    return trim_slashes(F.substring_index(file, "/", 2))


def product_name(name: Column, product: Column) -> Column:
    """The product name, else the one inside the JSON text of the product column."""
    inside = F.regexp_extract(product, PRODUCT_NAME_PATTERN, 1)
    return F.coalesce(name, F.nullif(inside, F.lit("")))


def quote_name(name: str) -> str:
    """A dotted name with every part in back-ticks."""
    parts = [p for p in name.split(".") if p]
    if not parts:
        raise ValueError("empty name")
    return ".".join("`" + p.strip("`").replace("`", "``") + "`" for p in parts)


def quote_text(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
