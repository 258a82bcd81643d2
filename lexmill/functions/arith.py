"""Integer arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def div(a: Column, b: Column | int) -> Column:
    """Integer quotient as bigint, rounded towards zero; never goes through doubles."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))
