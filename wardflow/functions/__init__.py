from wardflow.functions.rules import (  # noqa: F401
    blank_to_null, cap_to_null, clamp_date, clamp_number, negative_label,
    null_default, parse_mixed_date, present_flag, recode, sentinel_to_null,
    KEEP,
)
from wardflow.functions.dates import (  # noqa: F401
    day_diff, month_diff_boundary, month_end, year_diff_boundary,
)
from wardflow.functions.hashing import (  # noqa: F401
    hash_utf8, hash_utf16le, hash_varchar,
)
