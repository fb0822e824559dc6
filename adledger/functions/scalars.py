"""Scalar expressions used across the pipelines.

Every function returns a ``Column`` built from Spark built-ins so that it
stays inside whole-stage code generation.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money unit of the search network reports, the text normaliser
# pattern (leading/trailing whitespace including Unicode spaces), the pattern
# that marks display campaigns (matched on the lower-cased name) and the
# length of the partner keyword window in days before "today".
MICROS = 1_000_000
TRIM_PATTERN = r"^[\s\p{Z}]+|[\s\p{Z}]+$"
DISPLAY_PATTERN = "%display%"
ROLLING_DAYS = 30


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def typed_null(dtype: str = "string") -> Column:
    """A null of a concrete type (an untyped null would be written as VOID)."""
    return F.lit(None).cast(dtype)


def platform_tag(account, name: str) -> Column:
    """O-PLATFORM: the network name, or null when the account is null."""
    return F.when(_c(account).isNotNull(), F.lit(name))


def is_display(campaign) -> Column:
    """Display campaigns: name contains 'display' (any case).  Null stays null."""
    return F.lower(_c(campaign)).like(DISPLAY_PATTERN)


def not_display(campaign) -> Column:
    """O-DISP-EX predicate; null campaign names give null, so the row is dropped."""
    return ~is_display(campaign)


def clean_text(c) -> Column:
    """TRIM of all whitespace, Unicode spaces included."""
    return F.regexp_replace(_c(c), TRIM_PATTERN, "")


def ad_description(*parts) -> Column:
    """Description text: parts with null -> '' joined by single spaces, trimmed.

    ``concat`` (not ``concat_ws``) so that the separator stays when a part is
    empty, exactly like string concatenation with coalesced parts.
    """
    pieces = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit(" "))
        pieces.append(F.coalesce(_c(p), F.lit("")))
    return clean_text(F.concat(*pieces))


def coalesce_zero(c) -> Column:
    return F.coalesce(_c(c), F.lit(0))


def micros_to_units(c) -> Column:
    """Integer micros -> currency units as double (one division at the end)."""
    return _c(c).cast("double") / F.lit(float(MICROS))


def to_micros(c) -> Column:
    """Currency units (double) -> integer micros, so sums are exact and order-free."""
    return F.round(_c(c) * F.lit(float(MICROS))).cast("long")


def in_rolling_window(c, as_of: dt.date | str | None, days: int = ROLLING_DAYS) -> Column:
    """O-ROLL30: cast(c as date) between as_of - days and as_of, both ends included."""
    # Today in UTC, whatever the zone of the session.
    today = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("date")
    end = today if as_of is None else F.lit(str(as_of)).cast("date")
    return _c(c).cast("date").between(F.date_sub(end, days), end)
