from marketlake.functions.labels import cap_label, trend_label
from marketlake.functions.paths import (
    lake_path,
    lake_path_column,
    model_location,
    parse_lake_path,
)
from marketlake.functions.ratios import ratio, ratio_pct
from marketlake.functions.records import (
    as_json_text,
    conform,
    json_text,
    keys_first,
    nested_to_json,
    tag,
)

__all__ = [
    "as_json_text",
    "cap_label",
    "conform",
    "json_text",
    "keys_first",
    "lake_path",
    "lake_path_column",
    "model_location",
    "nested_to_json",
    "parse_lake_path",
    "ratio",
    "ratio_pct",
    "tag",
    "trend_label",
]
