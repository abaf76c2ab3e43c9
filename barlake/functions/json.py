"""Profile JSON parsing with the narrow five-field schema."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from barlake.functions.columns import cleanse_string, to_float32
from barlake.schemas import PROFILE_FIELDS, PROFILE_JSON


def parse_json(doc: Column | str, schema: StructType) -> Column:
    """``from_json`` in the default permissive mode (FN-6, D15).

    A bad field is null and the others survive; a malformed or empty document gives
    nulls in every field. Declare only the fields you read: the parser then skips
    the rest of each document.
    """
    c = F.col(doc) if isinstance(doc, str) else doc
    return F.from_json(c, schema)


def parse_profile(info: Column | str) -> Column:
    """The profile document parsed with the narrow five-field schema."""
    return parse_json(info, PROFILE_JSON)


def profile_columns(parsed: str = "parsed_info", ticker: str = "ticker") -> list[Column]:
    """The six profile columns (PRJ-2, PRJ-5): strings cleansed, the market cap
    narrowed to FLOAT (D12)."""
    p = F.col(parsed)
    out = [cleanse_string(F.col(ticker)).cast(StringType()).alias("ticker")]
    for field, name in PROFILE_FIELDS:
        value = p.getField(field)
        out.append((to_float32(value) if name == "market_cap" else cleanse_string(value)).alias(name))
    return out
