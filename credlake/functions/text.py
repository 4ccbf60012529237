"""Text helpers: truncation, file-name parsing, receipt amount (X-08, X-21..X-29)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import AMOUNT_PATTERN, DOC_FILE_PREFIX, DOC_FILE_TS_FORMAT, ORG_TYPE_MAX_LEN

# Corrected variant of the amount pattern: also accepts an ungrouped amount
# ("1130.63") whole instead of keeping only its last three integer digits.
AMOUNT_PATTERN_STRICT = r"(?is)NETO A PAGAR S/.*?(\d{1,3}(?:,\d{3})+\.\d{2}|\d+\.\d{2})"


def truncate(c: Column, n: int = ORG_TYPE_MAX_LEN) -> Column:
    """``::VARCHAR(n)`` truncation; Spark's cast to varchar would not cut."""
    return F.substring(c, 1, n)


def base_name(path: Column) -> Column:
    """Last path component of a file path or URI."""
    return F.regexp_extract(path, r"([^/]+)$", 1)


def id_prefix(file_name: Column) -> Column:
    """The application id before the first underscore of ``<id>_<name>``."""
    return F.split(file_name, "_", 2).getItem(0)


def is_numeric_id(c: Column) -> Column:
    """ASCII digits only.  (Python's isdigit also accepts '²'; we do not.)"""
    return F.coalesce(c.rlike(r"^[0-9]+$"), F.lit(False))


def upload_name(app_id: Column, original_name: Column) -> Column:
    """Landing-zone name ``<id>_<original file name>``."""
    return F.concat_ws("_", app_id, original_name)


def extract_amount(text: Column, strict: bool = False) -> Column:
    """First amount after the 'NETO A PAGAR S/' label as DOUBLE, else NULL.

    ``strict=False`` keeps the original pattern, so an amount written without
    thousands commas loses its leading digits exactly as it did before.
    """
    pat = AMOUNT_PATTERN_STRICT if strict else AMOUNT_PATTERN
    raw = F.nullif(F.regexp_extract(text, pat, 1), F.lit(""))
    return F.regexp_replace(raw, ",", "").cast("double")


def document_file_name(ts: Column, unique: Column | None = None) -> Column:
    """``idp_boleta_<yyyyMMdd_HHmmss>.json``.

    Names have one-second resolution, so documents written in the same
    second would overwrite each other; pass ``unique`` (e.g. the id) to
    append a distinguishing suffix.
    """
    parts = [F.lit(DOC_FILE_PREFIX), F.date_format(ts, DOC_FILE_TS_FORMAT)]
    if unique is not None:
        parts += [F.lit("_"), unique.cast("string")]
    parts.append(F.lit(".json"))
    return F.concat(*parts)
