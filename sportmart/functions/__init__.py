"""Column expressions; every function is Column -> Column and stays in the JVM."""

from sportmart.functions.dates import (
    academic_year,
    clock_minutes,
    clock_text,
    hms,
    local_date,
    local_time,
    london_to_local,
    parse_long_date,
)
from sportmart.functions.paths import has_column, nth, path_or_null, path_type
from sportmart.functions.text import initials, last_segment, object_keys, season_label

__all__ = [
    "academic_year", "clock_minutes", "clock_text", "has_column", "hms", "initials", "last_segment", "local_date",
    "local_time", "london_to_local", "nth", "object_keys", "parse_long_date", "path_or_null",
    "path_type", "season_label",
]
