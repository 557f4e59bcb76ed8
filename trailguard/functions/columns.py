"""Column expressions shared by the operators.  All JVM-side, no Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results.
EPSILON = 1e-6            # guard added to every ratio denominator
SMALL_AMOUNT = 10000.0    # "small transaction" / smurfing gate threshold
WINDOW_DAYS = 5           # look-back of every rolling window, in days

# Own choice: sums keep ten decimal places of amounts below 1e18; see money_sum.
MONEY_TYPE = "decimal(28,10)"


def account_key(bank, account) -> Column:
    """``<bank>_<account>``; NULL when either part is NULL (rows with NULL go to dead letter)."""
    return F.concat(F.col(bank).cast("string") if isinstance(bank, str) else bank.cast("string"),
                    F.lit("_"),
                    F.col(account) if isinstance(account, str) else account)


def qualify_keep_nulls(bank, account) -> Column:
    """``concat_ws('_', bank, account)``: skips a NULL part instead of returning NULL."""
    b = F.col(bank) if isinstance(bank, str) else bank
    a = F.col(account) if isinstance(account, str) else account
    return F.concat_ws("_", b.cast("string"), a)


def ratio(num: Column, den: Column, eps: float = EPSILON) -> Column:
    """``num / (den + eps)`` as DOUBLE."""
    return num.cast("double") / (den.cast("double") + F.lit(eps))


def money(c) -> Column:
    """Money as DECIMAL so that sums are exact and independent of summation order; NULL for
    what DECIMAL can't hold (NaN, infinities, 1e18 and above)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast(MONEY_TYPE)


def money_aggs(c) -> dict[str, Column]:
    """Partial aggregates of an amount: ``amt`` (exact sum), ``odd`` (double sum of the amounts
    DECIMAL can't hold, NULL without any) and ``paid`` (amounts that are not NULL)."""
    col = F.col(c) if isinstance(c, str) else c
    return {"amt": F.sum(money(col)),
            "odd": F.sum(F.when(money(col).isNull(), col.cast("double"))),
            "paid": F.count(col)}


def merge_money(prefix: str = "") -> dict[str, Column]:
    """The same aggregates from partial ones."""
    return {prefix + c: F.sum(prefix + c) for c in ("amt", "odd", "paid")}


def mean_of_money(prefix: str = "") -> Column:
    """Mean of the amounts that are not NULL: ``(double(amt) + odd) / paid``; NULL without any.
    A NaN or infinite amount makes its group's mean NaN or infinite, as a mean of doubles does."""
    amt, odd, paid = (F.col(prefix + c) for c in ("amt", "odd", "paid"))
    total = F.coalesce(amt.cast("double"), F.lit(0.0)) + F.coalesce(odd, F.lit(0.0))
    return F.when(paid > 0, total / paid.cast("double"))


def date_text(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.date_format(col, "yyyy-MM-dd")


def ts_text(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")
