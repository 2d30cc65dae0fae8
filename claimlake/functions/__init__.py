"""Column-expression helpers (all JVM-side built-ins)."""

from claimlake.functions.text import (  # noqa: F401
    npi_strict, npi_with_fallback, npi_after_dash, street_before_dash,
    city_state_first_comma, city_state_last_comma, city_state_two_chars, code_type,
)
from claimlake.functions.money import (  # noqa: F401
    to_money, money_or_zero, to_claim_id, to_number, to_long, to_int_truncated, round2, exact_avg, safe_ratio,
    pct_of, clip_negative, money_ratio, money_avg,
)
from claimlake.functions.dates import (  # noqa: F401
    to_date_lenient, date_reading, day_first_text, month_start, date_key, service_month, fiscal_year, fiscal_period,
)
from claimlake.functions.masking import mask_sha256, mask_md5, MASKERS  # noqa: F401
