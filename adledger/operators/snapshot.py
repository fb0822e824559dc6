"""O-SNAP / O-LATESTVAL: pick the latest load of an append-only report.

Semantics (parity contract): per key, take MAX(load time) and keep *every*
row loaded at that time (ties kept); rows with a null key or a null load time
never match.

Physical choice: an aggregate of MAX per key joined back on (keys, load time).
The aggregate is combined map-side, so a key holding a third of the table
costs one partial-aggregate row per task, and the join back is an equi-join
that AQE either turns into a broadcast (when the runtime size of the per-key
maxima is under the broadcast threshold) or splits by skew.  A window
``max().over(partitionBy(keys))`` would hold a whole hot key in one task, so
it is only kept as a cross-check (``latest_snapshot_window``).

Left lazy, the maxima's size is known only when the wide side of the join has
already been exchanged, all of its history included.  The PPC datasets stage
the maxima first (``staged_times``): the join is planned with their measured size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adledger.session import stage_table


def _not_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def latest_times(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Per-key maximum load time (one row per non-null key)."""
    return (df.where(_not_null(keys + [ts]))
              .groupBy(*keys)
              .agg(F.max(ts).alias(ts)))


def staged_times(df: DataFrame, keys: list[str], ts: str, name: str) -> DataFrame:
    """``latest_times`` written once as a staging table (``name``-times).

    Where the maxima are small, ``latest_snapshot`` then broadcasts them and the
    rows of older loads are dropped in the scan, before any exchange of wide
    rows; else it is the exchange on the key, as before.
    """
    return stage_table(latest_times(df, keys, ts), f"{name}-times")


def latest_snapshot(df: DataFrame, keys: list[str], ts: str,
                    times: DataFrame | None = None) -> DataFrame:
    """Rows of ``df`` at the latest ``ts`` of their key (ties kept, null keys dropped).

    ``times`` may give the per-key maxima computed elsewhere, e.g. from the raw
    report when ``df`` is a pre-aggregate of it (same maxima, and the
    pre-aggregate then has a single consumer).
    """
    times = latest_times(df, keys, ts) if times is None else times
    return df.join(times, on=keys + [ts], how="inner")


def latest_snapshot_window(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Window form of ``latest_snapshot``; same rows, used to cross-check."""
    w = Window.partitionBy(*keys)
    return (df.where(_not_null(keys + [ts]))
              .withColumn("__max_ts", F.max(ts).over(w))
              .where(F.col(ts) == F.col("__max_ts"))
              .drop("__max_ts"))


def latest_values(df: DataFrame, keys: list[str], order_col: str, value_col: str,
                  keep=None, staged: str | None = None) -> DataFrame:
    """O-LATESTVAL: distinct ``value_col`` values at the latest ``order_col`` per key.

    ``keep`` is a predicate applied before picking the latest position and again
    to the rows read at it (the reference applies it on both sides).
    """
    base = df if keep is None else df.where(keep)
    return latest_rows_distinct(base, keys, order_col, [value_col], staged)


def latest_rows_distinct(df: DataFrame, keys: list[str], order_col: str, cols: list[str],
                         staged: str | None = None) -> DataFrame:
    """DISTINCT ``keys`` + ``cols`` of the rows at the latest ``order_col`` per key.

    Distinct rows joined with the maximum per key: both combine map-side, and
    AQE can split the join at a hot key, however many distinct rows it holds.
    With ``staged`` the distinct rows are written once under that name and feed
    both sides, so ``df`` is read once.
    """
    rows = df.select(*keys, order_col, *[c for c in cols if c not in (*keys, order_col)]).distinct()
    if staged:
        rows = stage_table(rows, staged)
    return latest_snapshot(rows, keys, order_col).select(*keys, *cols).distinct()


def with_multiplicity(df: DataFrame, keys: list[str], count_col: str = "__n") -> DataFrame:
    """Distinct rows of ``df`` with how often each occurs.

    Joining a pre-aggregated fact to (dimension row, count) and multiplying
    additive metrics by the count gives exactly the sums that joining the raw
    fact to the raw (possibly duplicated) dimension would give, without the
    fan-out.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
