"""Column -> Column building blocks.  No session, no actions: every function
returns a native Catalyst expression so it stays inside whole-stage codegen."""

from meteomart.functions.text import (  # noqa: F401
    clean_decimal, clean_text, coerce_date, na_to_null, normalize_col,
    parse_hour, py_normalize_col, py_parse_years, try_numeric,
)
from meteomart.functions.classify import (  # noqa: F401
    day_period, rain_intensity, uf_timezone, wind_risk,
)
from meteomart.functions.keys import surrogate_key  # noqa: F401
from meteomart.functions.timefmt import (  # noqa: F401
    exact_avg_round, hour_of, local_time, validated_time, weekday_name_padded,
)
