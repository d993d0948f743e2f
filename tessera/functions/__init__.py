from tessera.functions.expressions import (
    is_aggregate_group,
    parse_season_label,
    require_columns,
    round_half_even,
    safe_divide,
    to_number,
    two_digit_year,
    weighted_sum,
)

__all__ = [
    "is_aggregate_group",
    "parse_season_label",
    "require_columns",
    "round_half_even",
    "safe_divide",
    "to_number",
    "two_digit_year",
    "weighted_sum",
]
