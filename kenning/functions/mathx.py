"""Math functions (MA-*)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kenning import config

__all__ = ["decay_exponent", "aged_count", "minmax", "sigmoid", "round_half_up"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _step_exponent(step: config.DecayStep, d: Column) -> Column:
    if step.form == "log10":
        return F.lit(step.a) * F.log10(d)
    if step.form == "ln":
        return F.lit(step.a) * F.ln(d)
    if step.form == "sqrt":
        return F.lit(step.a) * F.sqrt(d)
    if step.form == "ln_ratio":
        return F.lit(step.a) * (F.ln(F.lit(float(step.ref_days))) - F.ln(d))
    raise ValueError(f"unknown decay form {step.form!r}")


def decay_exponent(days, schedule) -> Column:
    """Exponent of the aging factor for whole ``days`` (clamped to >= 1)."""
    # clamp to >= 1 (day 0 or a future day); a missing day stays missing
    d = F.when(_c(days).isNotNull(), F.greatest(_c(days), F.lit(1))).cast("double")
    expr = None
    for step in schedule:
        e = _step_exponent(step, d)
        if step.max_days is None:
            expr = e if expr is None else expr.otherwise(e)
        else:
            cond = d <= F.lit(float(step.max_days))
            expr = F.when(cond, e) if expr is None else expr.when(cond, e)
    return expr


def aged_count(freq, days, schedule, null_day_keeps_count: bool = False) -> Column:
    """MA-1..3: ``ceil(freq * exp(e))``; rounded to 9 places first so a whole
    number computed with a float error does not move up by one."""
    aged = F.ceil(F.round(_c(freq) * F.exp(decay_exponent(days, schedule)), 9)).cast("bigint")
    if null_day_keeps_count:
        aged = F.when(_c(days).isNull(), _c(freq).cast("bigint")).otherwise(aged)
    return aged


def minmax(x, lo, hi, low: float = 0.0) -> Column:
    """MA-6: scale to [low, 1] given the column minimum and maximum; max = min gives ``low``."""
    std = F.coalesce(F.try_divide(_c(x) - _c(lo), _c(hi) - _c(lo)), F.lit(0.0))
    return std if low == 0.0 else std * F.lit(1.0 - low) + F.lit(low)


def sigmoid(x) -> Column:
    """MA-8."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(x)))


def round_half_up(x, digits: int) -> Column:
    return F.round(_c(x), digits)
