"""JSON payload access (X-01, X-02, F-01, F-02).

A raw record is a JSON *string*.  Silver parses it once per row with a narrow
struct of STRING fields (``from_json``): unread keys are skipped, JSON nulls
and absent keys both become SQL NULL (like ``->>``), and numbers arrive as
their JSON text, ready for exact casts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import BASE_PAYLOAD, BUSINESS_KEY_FIELD, DOC_METADATA_KEY, DOC_PAYLOAD


def parse_base(payload: Column) -> Column:
    return F.from_json(payload, BASE_PAYLOAD)


def parse_document(payload: Column) -> Column:
    return F.from_json(payload, DOC_PAYLOAD)


def field(payload: Column, path: str) -> Column:
    """``payload->>'a'`` / ``payload->'a'->>'b'`` for one-off reads."""
    return F.get_json_object(payload, "$." + path)


def is_document(payload: Column) -> Column:
    """True when the record carries extraction metadata (document branch)."""
    return field(payload, DOC_METADATA_KEY).isNotNull()


def is_valid_json_object(text: Column) -> Column:
    """Text that parses as a JSON object (malformed text cannot enter bronze)."""
    # inside brackets, trailing text breaks the array instead of being left out
    one = F.from_json(F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(T.MapType(T.StringType(), T.StringType())),
                      {"allowSingleQuotes": "false"})
    return F.coalesce((F.size(one) == 1) & F.get(one, F.lit(0)).isNotNull(), F.lit(False))


def is_loadable(text: Column) -> Column:
    """A JSON object with a business key."""
    return is_valid_json_object(text) & field(text, BUSINESS_KEY_FIELD).isNotNull()
