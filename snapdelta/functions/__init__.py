from snapdelta.functions.collections import (
    array_literal,
    array_literals,
    exploded,
    joined,
    json_array,
    json_array_or_empty,
    map_text,
    range_text,
)
from snapdelta.functions.json import json_fields, json_text
from snapdelta.functions.text import (
    as_text,
    collapse_spaces,
    iso_text,
    newline_runs_to_space,
    newlines_to_spaces,
    number_text,
    or_blank,
    or_false,
    or_zero,
    timestamp_text,
    timestamptz_text,
    without,
)

__all__ = [
    "array_literal",
    "array_literals",
    "as_text",
    "collapse_spaces",
    "exploded",
    "iso_text",
    "joined",
    "json_array",
    "json_array_or_empty",
    "json_fields",
    "json_text",
    "map_text",
    "newline_runs_to_space",
    "newlines_to_spaces",
    "number_text",
    "or_blank",
    "or_false",
    "or_zero",
    "range_text",
    "timestamp_text",
    "timestamptz_text",
    "without",
]
