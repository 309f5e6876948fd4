"""Column helpers: everything here returns a Column and stays inside Catalyst."""

from .aggregates import (  # noqa: F401
    any_flag,
    any_flag_nullable,
    count_distinct_where,
    count_where,
    max_where,
    mean_of,
    n_rows,
    pct,
    rate,
)
from .expressions import (  # noqa: F401
    assign_phase,
    bucketize,
    clean_email,
    clean_name,
    days_between,
    flag_to_int,
    is_true,
    map_values,
    null_if,
    phase_order,
    promo_sensitivity,
    recommended_action,
    risk_tier,
    round_to,
    safe_ratio,
)
