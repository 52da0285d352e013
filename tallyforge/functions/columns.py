"""Column expressions of the loan and measurement tables. All stay inside whole-stage codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyforge.sources.lookups import REGION_DIGITS

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def derive_region(zip_code: ColumnOrName) -> Column:
    """Region of a zip code by its first digit; anything else, and a null zip, gives NULL."""
    digit = F.substring(col(zip_code), 1, 1)
    chain = F
    for region, digits in REGION_DIGITS.items():
        chain = chain.when(digit.isin(*digits), F.lit(region))
    return chain


def region_prefixes(zip_code: ColumnOrName, regions: list[str] | tuple[str, ...]) -> Column:
    """The same test as ``derive_region(zip).isin(regions)`` written as prefixes of the stored column.

    Prefix tests reach the Parquet scan, a CASE over a substring does not.
    """
    prefixes = [d for r in regions for d in REGION_DIGITS.get(r, ())]
    return starts_with_any(zip_code, prefixes)


def derive_office(zip_code: ColumnOrName) -> Column:
    return F.substring(col(zip_code), 1, 3)


def term_to_months(term: ColumnOrName) -> Column:
    """Months of the two listed terms (their text has a leading space), else NULL."""
    c = col(term)
    return F.when(c == " 36 months", F.lit(36)).when(c == " 60 months", F.lit(60))


#: What counts as a number in text: no ``NaN``, no ``Infinity``, no type suffix.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def to_numeric(text: ColumnOrName) -> Column:
    """Text to double; text that is no number gives NULL instead of an ANSI cast error."""
    return F.when(col(text).cast("string").rlike(NUMBER), col(text).try_cast("double"))


def parse_rate(rate: ColumnOrName) -> Column:
    """``"13.5%"`` to 13.5: the first percent sign is removed, then :func:`to_numeric`."""
    return to_numeric(F.regexp_replace(col(rate), r"^([^%]*)%", "$1"))


def bucket_half(value: ColumnOrName) -> Column:
    """Round to the nearest 0.5, halves of the doubled value away from zero."""
    return F.round(col(value) * 2.0) / 2.0


def profit(price: ColumnOrName, discount: ColumnOrName, cost: ColumnOrName, quantity: ColumnOrName) -> Column:
    return col(price) * (1.0 - col(discount)) - col(cost) * col(quantity)


def as_label(c: ColumnOrName) -> Column:
    """A 0/1 class label as integer."""
    return col(c).cast("int")


def starts_with_any(c: ColumnOrName, prefixes: list[str] | tuple[str, ...]) -> Column:
    """True when the text starts with one of the prefixes; pushed to the scan as StartsWith."""
    if not prefixes:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [col(c).startswith(p) for p in prefixes])


def not_in_keep_null(c: ColumnOrName, values: list[str] | tuple[str, ...]) -> Column:
    """``not in`` where NULL is not in the list, so NULL rows are kept (SQL would drop them)."""
    return ~F.coalesce(col(c).isin(*values), F.lit(False))


def sum_or_zero(value: Column) -> Column:
    """Sum that is 0, not NULL, for a group without values."""
    return F.coalesce(F.sum(value), F.lit(0.0))


def millions(value: ColumnOrName) -> Column:
    return col(value) / 1e6
