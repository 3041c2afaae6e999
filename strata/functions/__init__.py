"""Column-expression helpers shared by the operators (all JVM-side)."""

from strata.functions.dates import day_diff, month_start
from strata.functions.numeric import CENTS, TOTAL, cents, half_up_ratio, rounded_money

__all__ = ["CENTS", "TOTAL", "cents", "day_diff", "half_up_ratio", "month_start", "rounded_money"]
