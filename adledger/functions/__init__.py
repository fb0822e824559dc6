"""Scalar column functions (all built-in Spark expressions, no UDFs)."""

from adledger.functions.scalars import (  # noqa: F401
    MICROS,
    TRIM_PATTERN,
    ad_description,
    clean_text,
    coalesce_zero,
    in_rolling_window,
    is_display,
    micros_to_units,
    not_display,
    platform_tag,
    to_micros,
    typed_null,
)
