"""Reusable Column expressions and driver-side distribution functions."""

from .columns import (  # noqa: F401
    capped,
    currency_to_double,
    nullif_zero,
    round_half_away,
    safe_corr,
    weekend_flag,
)
