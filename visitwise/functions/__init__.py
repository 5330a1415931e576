"""Column expressions (the scalar operators C01-C34).

Every function takes and returns ``Column`` objects, so the work stays on
the JVM.
"""

from visitwise.functions.coords import (  # noqa: F401
    coord_text, to_number, haversine_m, guarded_distance, range_class,
    range_class_si, RANGE_IN, RANGE_OUT,
)
from visitwise.functions.durations import (  # noqa: F401
    duration_seconds, length_text, time_code, duration_minutes,
    timedelta_text, SENTINEL_LENGTH,
)
from visitwise.functions.dates import (  # noqa: F401
    parse_dmy, parse_mdy_hm, to_ts, year_of, date_part, iso_date,
    month_end_flag, period_yyyymm, year_range_filter,
)
from visitwise.functions import text  # noqa: F401
from visitwise.functions.text import (  # noqa: F401
    clean_text, strip_marks, latin1_safe,
)
from visitwise.functions.codes import (  # noqa: F401
    code_from_int, code_from_text, code_canonical, not_null_flag,
    equal_flag, concat_strict, first_element, fill_blank, int_text,
    case_in_list,
)
