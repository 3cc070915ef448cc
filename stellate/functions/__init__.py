"""Column expressions (all JVM-side builtins, no Python UDFs)."""

from stellate.functions.dates import (  # noqa: F401
    date_key, date_key_str, day_diff_1900, day_number_1900, month_name, run_stamp_compat,
    week_of_month, week_of_year_sunday,
)
from stellate.functions.predicates import (  # noqa: F401
    NULL_MODES, binary_changed, changed, col_changed, typed_empty,
)
