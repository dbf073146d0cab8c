from .columns import (exact_mean, high_risk_flag, is_true, month_label, month_start, nan_to_null, outside,
                      rate_pct, safe_ratio, with_high_risk, with_month, zero_if_null_ratio)
from .rounding import np_round, round6

__all__ = [
    "exact_mean",
    "high_risk_flag", "is_true", "month_label", "month_start", "nan_to_null", "outside", "rate_pct",
    "safe_ratio", "with_high_risk", "with_month", "zero_if_null_ratio", "np_round", "round6",
]
