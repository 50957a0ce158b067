"""Column expressions shared by the operators.  All are JVM built-ins."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the product page that an external item id belongs to.
PRODUCT_URL_PREFIX = "https://www.tcgplayer.com/product/"


def run_date(as_of: date | None = None) -> Column:
    """The clock of a run.  Both forms fold to a literal, so partitions still prune."""
    return F.current_date() if as_of is None else F.lit(as_of)


def days_before(as_of: date | None, days: int) -> Column:
    return F.date_sub(run_date(as_of), days)


def years_before(as_of: date | None, years: int) -> Column:
    """The same calendar day some years ago; 29 February becomes the 28th."""
    return F.add_months(run_date(as_of), -12 * years)


def day_offset(start: Column, end: Column) -> Column:
    """Calendar days from start to end."""
    return F.datediff(end, start)


def price_ratio(now: Column, then: Column) -> Column:
    """now / then to four digits, ties to even; NULL if either is missing or zero."""
    quotient = now.cast("double") / then.cast("double")
    return F.when((now != 0) & (then != 0), F.rint(quotient * 10000) / 10000)


def product_url(external_id: Column) -> Column:
    """URL of an external id, by way of a whole number, so never '12.0'; NULL for no number."""
    return F.concat(F.lit(PRODUCT_URL_PREFIX), external_id.try_cast("bigint").cast("string"))


def matches_term(column: Column, term: str | None) -> Column:
    """Case-insensitive substring test that an empty term switches off.

    ``%`` and ``_`` in the term are wildcards; a backslash is an ordinary character.
    """
    if not term:
        return F.lit(True)
    pattern = F.concat(F.lit("%"), F.lower(F.lit(term.replace("\\", "\\\\"))), F.lit("%"))
    return F.like(F.lower(column), pattern)


def mean_of(price: Column) -> Column:
    """Mean from an exact sum; NULL where no price is known."""
    return F.try_divide(F.sum(price).cast("double"), F.count(price))


def mean_cents(price: Column) -> Column:
    """Mean of a decimal price, rounded once, half up, to two digits."""
    return F.round(F.try_divide(F.sum(price), F.count(price)), 2).cast("decimal(10,2)")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def megabytes(length: Column) -> Column:
    return F.round(length / F.lit(1048576.0), 2)
