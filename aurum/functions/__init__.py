from aurum.functions.scalars import (  # noqa: F401
    bands, coalesce_zero, date_from_name, ddmmyyyy, guarded_ratio, is_false, is_true,
    lit_concat, nullif_ratio, period_of, positive_flag, round_half_up, safe_double,
    safe_long, scaled, strict_concat, value_map, weighted_sum,
)
