"""Money columns and the debit / credit rules."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import CREDIT_TYPES, DEBIT_TYPES


def _column(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def money(col) -> Column:
    """Exact cents, half-up; what does not fit (NaN, overflow) is NULL."""
    return _column(col).try_cast("decimal(18,2)")


def exact(col) -> Column:
    """Raw amounts as decimals, so that sums do not depend on their order.

    28 digits before the point hold any amount there is; NaN, infinity and more
    fail the query rather than leave a row out of a total.
    """
    raw = _column(col)
    number = raw.try_cast("decimal(34,6)")
    return F.when(raw.isNotNull() & number.isNull(), F.raise_error(F.lit("an amount is no finite number"))).otherwise(number)


def total(col) -> Column:
    """Sum of raw amounts, rounded to cents once at the end."""
    return F.sum(exact(col)).cast("decimal(28,2)")


def average(col) -> Column:
    return F.avg(exact(col)).cast("decimal(18,2)")


def debit(amount="amount", kind="transaction_type") -> Column:
    return F.when(F.col(kind).isin(*DEBIT_TYPES), F.col(amount)).otherwise(0)


def credit(amount="amount", kind="transaction_type") -> Column:
    return F.when(F.col(kind).isin(*CREDIT_TYPES), F.col(amount)).otherwise(0)


def signed(amount="amount", kind="transaction_type") -> Column:
    """Credits count up; every other type, unknown or NULL ones too, down."""
    return F.when(F.col(kind).isin(*CREDIT_TYPES), F.col(amount)).otherwise(-F.col(amount))
