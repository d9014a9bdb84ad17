"""Column-expression helpers (JVM-side, codegen friendly; no Python UDFs)."""

from clickflow.functions.strings import (  # noqa: F401
    java_split, java_trim, event_string, json_object,
)
from clickflow.functions.timefmt import (  # noqa: F401
    ms_to_ts, datetime_text, sql_timestamp_text, window_bounds_ms,
)
