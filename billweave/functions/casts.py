"""Lenient casts for raw report text and strict casts for ingest. All are built-in expressions.

The casts take the name of a text column, or the SQL text of an expression, and return a column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def blank_to_null(text: str) -> Column:
    return F.expr(f"nullif({text}, '')")


def lenient_int(text: str, target: str = "bigint") -> Column:
    """Whole number; a fraction or an exponent is rounded half up, anything else gives NULL."""
    # As many digits before the point as a bigint needs, all others behind it: it is rounded once.
    number = f"try_cast({text} as decimal(38,19))"
    return F.expr(f"case when {_may_be_number(text)} then try_cast(round({number}, 0) as {target}) end")


def lenient_number(text: str, target: str = "float") -> Column:
    """Finite number or NULL; never NaN or infinity, which have no decimal form later on."""
    number = f"case when {_may_be_number(text)} then try_cast({text} as {target}) end"
    if target.startswith("decimal"):
        return F.expr(number)
    return F.expr(f"case when abs({number}) < {target}('infinity') then {number} end")


def maybe_infinite_number(text: str, target: str = "float") -> Column:
    """:func:`lenient_number` before the test for infinity, which names the number twice: cast it in a step before."""
    return F.expr(f"case when {_may_be_number(text)} then try_cast({text} as {target}) end")


def lenient_time(text: str) -> Column:
    """Zone-less timestamp; a zone suffix is read over, anything without a full date gives NULL.

    Spark alone would also read "2024", "2024-04", "2024-04-02 10", "now" or "today" as a time.
    """
    value = f"ltrim({text})"
    full_date = (
        f"substr({value}, 5, 1) = '-' and length({value}) >= 8 and substr({value}, -1, 1) not in (' ', 'T') "
        f"and (length({value}) <= 10 or contains({value}, ':'))"
    )
    return F.expr(f"case when {full_date} then try_cast({value} as timestamp_ntz) end")


def _may_be_number(text: str) -> str:
    """Cheap test on bytes: starts and ends with a digit or a sign below it, is not hexadecimal.

    It keeps Java's own forms ("1.5f", "NaN", "0x1p3") away from the cast, and most other texts
    that a cast could not read, each of which would cost an exception.
    """
    return (
        f"{text} > '' and {text} < ':' and substr({text}, -1, 1) < ':' "
        f"and not contains({text}, 'x') and not contains({text}, 'X')"
    )


def lenient_cast(text: str, target: str) -> Column:
    """The cast of one raw text value to the type a :class:`TypePlan` asks for."""
    if target == "string":
        return blank_to_null(text)
    if target == "timestamp_ntz":
        return lenient_time(text)
    if target in ("int", "bigint"):
        return lenient_int(text, target)
    return lenient_number(text, target)


def typed_value(column: str, have: str, want: str) -> Column:
    """Like :func:`lenient_cast`, without the way over text when the column is typed already."""
    if have == want and want in ("timestamp_ntz", "int", "bigint"):
        return F.col(column)
    if have in ("int", "bigint") and want in ("int", "bigint", "float", "double"):
        return F.col(column).try_cast(want)
    if have in ("float", "double") and want in ("float", "double"):
        number = f"cast({column} as {want})"
        return F.expr(f"case when abs({number}) < {want}('infinity') then {number} end")
    return lenient_cast(column if have == "string" else f"cast({column} as string)", want)


def ingest_time(text: str) -> Column:
    """Timestamp of an ingested record, brought to UTC and then zone-less; NULL if unreadable.

    Reads epoch numbers (milliseconds above 1e10, else seconds), ISO dates and date-times, and a
    trailing ``Z`` or offset, which is applied. The result does not depend on the session zone.
    """
    value = f"trim({text})"
    unit = f"if(try_cast({value} as double) > 10000000000, 1000, 1)"
    # A number beyond the calendar is unreadable like any other text.
    seconds = f"try_cast(try_divide(try_cast({value} as decimal(38,6)), {unit}) as decimal(18,6))"
    # The offset of a time such as 10:00:00.5+0530, as the interval +05:30.
    offset = rf"regexp_replace({value}, r'^.*([+-]\d\d):?(\d\d)$', r'$1:$2')"
    shift = F.expr(
        rf"case when {value} rlike r':\d\d.*[+-]\d\d:?\d\d$' "
        f"then try_cast({offset} as interval hour to minute) else interval '0:00' hour to minute end"
    )
    return F.when(
        F.expr(f"{value} rlike r'^-?[0-9.]+$'"),
        F.expr(f"try_add({_EPOCH}, make_dt_interval(0, 0, 0, if(abs({seconds}) < 200000000000, {seconds}, null)))"),
    ).otherwise(lenient_time(value) - shift)


def ingest_value(text: str, kind: str) -> Column:
    """Value of an ingested record; text keeps blanks, other kinds turn them into NULL."""
    if kind == "text":
        return F.expr(text)
    if kind == "time":
        return ingest_time(text)
    value = f"nullif(trim({text}), '')"
    if kind == "number":
        return F.expr(f"try_cast({value} as double)")
    # As an integer conversion: a fraction in a number is cut off, not rounded.
    return F.expr(rf"try_cast(nullif(regexp_extract({value}, r'^([+-]?\d+)(\.\d*)?$', 1), '') as bigint)")


def unreadable(text: str, value: Column) -> Column:
    """True where ``text`` holds something and ``value``, its cast, is NULL."""
    return value.isNull() & F.expr(f"trim({text}) > ''")


def no_number(text: str, target: str = "float") -> Column:
    """:func:`unreadable` of :func:`lenient_number`, which names the number twice: here the text is cast once."""
    finite = F.abs(maybe_infinite_number(text, target)) < F.expr(f"{target}('infinity')")
    return ~F.coalesce(finite, F.lit(False)) & F.expr(f"trim({text}) > ''")


def strict(text: str, value: Column, column: str) -> Column:
    """``value``, or a failing job where the text could not be read."""
    complaint = F.raise_error(F.concat(F.lit(f"cannot read {column}: "), F.expr(text)))
    return F.coalesce(value, F.when(F.expr(f"trim({text}) > ''"), complaint))
