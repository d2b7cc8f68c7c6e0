"""Numeric helpers kept as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from .nulls import col_of


def round_half_up(c: str | Column, digits: int = 3) -> Column:
    """Round a double to ``digits`` decimals, ties away from zero on its decimal text.

    The value goes through DECIMAL(38, 12) first, so the result does not
    depend on the binary error of the double (0.0005 rounds to 0.001). NaN,
    infinities and values beyond 1e15, which hold hardly any decimals, stay as they are.
    """
    x = col_of(c).cast("double")
    rounded = F.round(x.cast(DecimalType(38, 12)), digits).cast("double")
    return F.when(F.abs(x) < F.lit(1e15), rounded).otherwise(x)


def inv_logit(eta: Column) -> Column:
    """Inverse logit ``1 / (1 + exp(-eta))``."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))


def share_true(cond: Column) -> Column:
    """Aggregate: mean of a boolean, NULLs ignored, no value gives 0.

    ``mean(cond, na.rm = TRUE)`` with ``NaN -> 0`` as in the reference.
    """
    return F.coalesce(F.avg(F.when(cond, F.lit(1.0)).when(~cond, F.lit(0.0))), F.lit(0.0))
