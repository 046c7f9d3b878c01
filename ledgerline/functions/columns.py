"""Column expressions: typing of raw text, guarded arithmetic, calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
NUMBER = "decimal(18,4)"
# Text keeps all its digits; with more than that behind the point it does not parse.
EXACT, SCALE = "decimal(28,10)", 10
US_DATE = "MM/dd/yyyy"

_CAST_TO = {"int": "int", "money": EXACT, "number": EXACT, "date": "date", "stamp": "timestamp_ntz"}


def typed(column: Column, kind: str, strict: bool = True) -> Column:
    """Turn raw text into the type of ``kind``.

    ``strict`` raises on text that does not parse (ANSI cast); otherwise it gives NULL.
    """
    if kind == "text":
        return column
    if kind == "lower":
        return F.lower(F.trim(column))
    if kind == "upper":
        return F.upper(F.trim(column))
    if kind == "flag":
        return F.coalesce(F.lower(F.trim(column)) == "true", F.lit(False))
    if kind in ("us_date", "us_stamp"):
        target = "date" if kind == "us_date" else "timestamp_ntz"
        iso = column.cast(target) if strict else column.try_cast(target)
        return F.coalesce(F.try_to_date(column, US_DATE).cast(target), iso)
    target = _CAST_TO[kind]
    value = column.cast(target) if strict else column.try_cast(target)
    if target == EXACT:
        # Plain numbers show lost digits; with an exponent the number itself is compared with the text's
        # value, which a double holds exactly enough for up to fifteen digits. Texts too short to lose
        # digits, and without an exponent, are told by length and letter, before any pattern.
        plain = (F.length(column) > SCALE + 1) & column.rlike(rf"\.[0-9]{{{SCALE}}}[0-9]*[1-9]")
        exact = column.try_cast("double").eqNullSafe(column.try_cast(target).cast("double")) & ~column.rlike("[1-9.][0-9.]{15,}[eE]")
        loses = F.when(column.contains("e") | column.contains("E"), ~exact).otherwise(plain)
        refused = F.raise_error(F.concat(F.lit("too many digits: "), column)).cast(target) if strict else F.lit(None).cast(target)
        value = F.when(loses, refused).otherwise(value)
    return value


def null_if_in(column: Column, values: tuple[str, ...]) -> Column:
    """NULL where the text is exactly one of ``values``."""
    return F.when(~column.isin(*values), column)


def mean(column: Column | str) -> Column:
    """Average as exact sum over count, NULL on no values.

    The sum of decimals is exact and independent of row order, so the result does not
    depend on how rows were spread over tasks, as a running double average would.
    """
    return ratio(F.sum(column), F.count(column))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, NULL when the denominator is zero or missing."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def month_of(column: Column | str) -> Column:
    """First day of the month as a date."""
    return F.trunc(F.col(column) if isinstance(column, str) else column, "month")


def sum_when(condition: Column, value: Column) -> Column:
    """Sum of ``value`` over the rows that satisfy ``condition``; 0 when none does."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0).cast(MONEY)))


def utc(column: Column, zone: str | Column, doubled: str = "first", missing: str = "later") -> Column:
    """Wall-clock time of ``zone`` as UTC, both without a zone.

    A time that the clock shows twice is its ``first`` or ``second`` occurrence; one that the clock
    skips counts ``later`` by what is skipped, or becomes ``null``.
    """
    source = F.lit(zone) if isinstance(zone, str) else zone
    result = first = F.convert_timezone(source, F.lit("UTC"), column)

    def shown(moment: Column) -> Column:
        return F.convert_timezone(F.lit("UTC"), source, moment)

    if doubled == "second":
        for minutes in (30, 60):  # clocks are set back by one of these
            again = first + F.expr(f"INTERVAL {minutes} MINUTES")
            result = F.when(shown(again) == column, again).otherwise(result)
    return F.when(shown(result) == column, result) if missing == "null" else result


def canonical_customer_id(column: Column) -> Column:
    """Bare digits become ``CUST-nnn``; anything else is left as it is."""
    return F.when(
        column.rlike(r"^\d+$"),
        F.concat(F.lit("CUST-"), F.when(F.length(column) < 3, F.lpad(column, 3, "0")).otherwise(column)),
    ).otherwise(column)


def id_format(column: Column) -> Column:
    """Shape of an identifier: every run of digits becomes ``9``."""
    return F.regexp_replace(column, r"\d+", "9")


def feature_list(column: Column) -> Column:
    """Comma separated text as an array."""
    return F.split(column, ",")
