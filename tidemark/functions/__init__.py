from .dates import (COMPACT_MONTH, SPACED_MONTH, abbr_of_text, month_abbr, month_name,  # noqa: F401
                    month_start, month_text, parse_month, quarter_label, trade_season,
                    year_of_text)
from .labels import balance_status, inflation_band, sourcing_signal  # noqa: F401
from .numeric import (exact_avg, exact_sum, lenient_double, nan_to_null, nullif_zero, unit_sum,  # noqa: F401
                      round_to, strict_double)
