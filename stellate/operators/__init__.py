"""DataFrame operators: merge/SCD family, surrogate keys, calendar, audits,
idempotent append."""

from stellate.operators.append import append_idempotent, new_rows  # noqa: F401
from stellate.operators.audit import (  # noqa: F401
    assert_clean, cascade_delete, cascade_update, duplicate_keys, length_violations, null_violations,
    orphans, unique_among,
)
from stellate.operators.calendar import calendar, calendar_for, calendar_from_bounds  # noqa: F401
from stellate.operators.keys import (  # noqa: F401
    assign_surrogate_keys, extend_surrogate_keys, lookup_key, max_key, unmatched,
)
from stellate.operators.merge import change_feed, merge_actions, scd1  # noqa: F401
from stellate.operators.scd import scd2, scd2_actions, scd2_expired, scd2_new_versions, scd3, scd4  # noqa: F401
