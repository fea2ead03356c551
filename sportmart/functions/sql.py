"""The scalars for SQL text: functions of the session, inlined by the optimiser wherever a query calls them."""

from __future__ import annotations

from pyspark.sql import SparkSession

from sportmart.functions.dates import HOME_ZONE, LOCAL_ZONE

_BARE = "trim(replace(replace(text, 'BST', ''), 'GMT', ''))"
_UTC = f"convert_timezone('{HOME_ZONE}', 'UTC', wall)"
_LATER = f"{_UTC} + INTERVAL '1' HOUR"

#: Name, arguments, result and body. A function may call those before it; each means what the column function of its name does.
FUNCTIONS = (
    ("initials", "text STRING", "STRING", "array_join(transform(split(text, '[ /]'), word -> substring(word, 1, 1)), '')"),
    ("parse_long_date", "text STRING", "DATE", "CAST(try_to_timestamp(text, 'd MMMM yyyy') AS DATE)"),
    (
        "wall_time", "text STRING", "TIMESTAMP_NTZ",
        "TIMESTAMP_NTZ '1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, CAST(unix_seconds(try_to_timestamp("
        f"concat(substr({_BARE}, 5), ' Z'), 'd MMM yyyy, H:mm X')) AS DECIMAL(18, 6)))",
    ),
    (
        "wall_to_local", "wall TIMESTAMP_NTZ", "TIMESTAMP_NTZ",
        f"convert_timezone('UTC', '{LOCAL_ZONE}', IF(month(wall) >= 9 AND hour(wall) < 4"
        f" AND convert_timezone('UTC', '{HOME_ZONE}', {_LATER}) = wall, {_LATER}, {_UTC}))",
    ),
    ("london_to_local", "text STRING", "TIMESTAMP_NTZ", "wall_to_local(wall_time(text))"),
    ("local_date", "text STRING", "DATE", "CAST(london_to_local(text) AS DATE)"),
    (
        "clock_text", "wall TIMESTAMP_NTZ", "STRING",
        "concat(lpad(CAST(hour(wall) AS STRING), 2, '0'), ':', lpad(CAST(minute(wall) AS STRING), 2, '0'))",
    ),
    ("local_time", "text STRING", "STRING", "clock_text(london_to_local(text))"),
    (
        "clock_minutes", "text STRING", "INT",
        r"""aggregate(split(replace(replace(text, '+', ''), "'00", ''), ' '), 0, (total, part) ->
            total + IF(part RLIKE '^\\s*-?\\d{1,9}$', try_cast(part AS INT), NULL))""",
    ),
)


def register_functions(spark: SparkSession) -> list[str]:
    """Make the functions callable by name in the session's SQL; calling it again changes nothing."""
    for name, arguments, result, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
    return [name for name, *_ in FUNCTIONS]
