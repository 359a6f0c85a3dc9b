from premia.functions.columns import (  # noqa: F401
    banded,
    cents,
    clamp,
    money_avg,
    money_sum,
    parse_date,
    quarter_label,
    ratio_pct,
)
from premia.functions.quantile import exact_quantile  # noqa: F401
from premia.functions.skew import left_join, slice_of  # noqa: F401
