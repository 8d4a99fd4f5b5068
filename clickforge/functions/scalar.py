"""Small scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sentinels written into categorical columns.
SENTINEL_NULL = "deadbeef"   # the value was NULL
SENTINEL_RARE = "rarebeef"   # the value was rare in train, or unseen


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(num: Column | str, den: Column | str) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI mode would raise)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def natural_log(c: Column | str) -> Column:
    """ln(x); x <= 0 or NULL gives NULL (never an error, never -inf)."""
    x = _c(c).cast("double")
    return F.when(x > 0, F.log(x))


def label_recode(c: Column | str, to_signed: bool = True) -> Column:
    """0/1 label -> -1/+1 (``to_signed``) or -1/+1 -> 0/1."""
    x = _c(c)
    if to_signed:
        return F.when(x == 0, F.lit(-1)).otherwise(x).cast("int")
    return F.when(x == -1, F.lit(0)).otherwise(x).cast("int")


def rounded(c: Column | str, places: int = 6) -> Column:
    return F.round(_c(c).cast("double"), places)
