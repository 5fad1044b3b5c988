from tq.functions.columns import (  # noqa: F401
    col,
    count_if,
    digit_only,
    is_blank,
    normalize_text,
    null_if_equal,
    null_if_match,
    parse_currency,
    parse_flag,
    pct,
    safe_cast,
    strip_currency,
    text_sample,
)
