"""O-SNAP kept between refreshes: the picked rows of a report, merged with each new load.

The pick of all loads is the pick of (the rows picked before, with the new
load): a row passed over once has a later load of its key beside it and is never
picked again, and rows tied with the latest load stay, whichever load brought
them.  So a refresh reads the kept rows of the sites that the load touches, and
the load, never the report's history.  Late loads need no care: a load older than
what is kept for a key loses to it, whenever it arrives.

Kept rows carry the id of the load that brought them.  A load that is merged
again (a retried refresh) first takes its earlier rows out, so merging twice
equals merging once.  The kept table changes by one commit (``sources.versions``):
a failed refresh leaves the rows of the last one.

``restate_since`` is the other way to refresh a part: the report is read again
from a day on, and days before it keep their rows.  The bound is on a column of
the snapshot key, so it commutes with the pick (T4); a bound on any other column
is refused.

The dataset plans take ``read_kept`` in the place of the raw report: a pick of
picked rows is these rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adledger.operators.snapshot import latest_snapshot
from adledger.sources.versions import Version, current, publish_version, read_version

LOAD = "__load_id"


def merge_load(load: DataFrame, path: str, keys: list[str], ts: str, load_id: str,
               sites: list[str] | None = None) -> Version | None:
    """Merge a load into the kept rows under ``path`` and commit; other sites' rows stay as they are.

    ``keys`` hold ``site``.  Given ``sites`` (the configured ones), rows of others
    are passed over, and no more names reach the driver.  A load without rows
    commits nothing (None).
    """
    if "site" not in keys or LOAD in load.columns:
        raise ValueError(f"the snapshot key must hold site, and {LOAD} is a column of the kept rows alone")
    spark = load.sparkSession
    known = F.col("site").isNotNull() if sites is None else F.col("site").isin(sites)
    new = load.where(known).withColumn(LOAD, F.lit(load_id))
    touched = sorted(new.agg(F.collect_set("site")).first()[0])
    if not touched:
        return None
    before = current(spark, path)
    if before is not None:
        kept = read_version(spark, path, before).where(F.col("site").isin(touched) & (F.col(LOAD) != load_id))
        new = kept.unionByName(new)
    return publish_version(latest_snapshot(new, keys, ts).select(*load.columns, LOAD), path, sites=touched, by_day=False)


def read_kept(spark: SparkSession, path: str) -> DataFrame:
    """The rows at the latest load of their key, of all loads merged so far."""
    return read_version(spark, path).drop(LOAD)


def restate_since(kept: DataFrame, report: DataFrame, keys: list[str], ts: str, day: str,
                  since: dt.date | str) -> DataFrame:
    """The kept rows of the days before ``since``, and the report's pick of the days from it on.

    Equals the full pick if no load since the kept rows were written changed a
    day before ``since``.  The bound reaches the scans of both.
    """
    if day not in keys:
        raise ValueError(f"{day} is not of the snapshot key {keys}: a bound on it would change what is picked")
    bound = F.lit(str(since)).cast("date").cast(report.schema[day].dataType)
    old = latest_snapshot(kept.where(F.col(day) < bound), keys, ts)
    return old.unionByName(latest_snapshot(report.where(F.col(day) >= bound), keys, ts).select(*old.columns))
