from feedwright.functions.exprs import (  # noqa: F401
    COMPARISON_OPERATORS, compare, delimiter_repair, expected_flag, isin_ci, job_number,
    lag_text, naming_flags, not_blank, null_count, percent, quote_ident, quote_literal, seam_repair,
    size_pretty, size_pretty_sql, ts_literal, typed_literal,
)
from feedwright.functions.keys import lower_keys, lower_keys_column  # noqa: F401
