"""Column-level helpers: plain expressions that stay inside whole-stage codegen."""

from barlake.functions.columns import (
    audit_columns,
    cleanse_string,
    conform_bars_columns,
    stamp,
    to_float32,
)
from barlake.functions.json import parse_json, parse_profile, profile_columns

__all__ = [
    "audit_columns",
    "cleanse_string",
    "conform_bars_columns",
    "parse_json",
    "parse_profile",
    "profile_columns",
    "stamp",
    "to_float32",
]
