"""O-PUBLISH with a one-step commit: versions of a dataset, laid out by site and day.

A publish writes the rows of its sites into a folder of their own
(``data/version=…/site=…/day=…``) that no reader looks at yet.  Then one file is
added to ``_commits``: the list of the sites' current folders, in which the
published sites' entries are new, emptied sites have none, and all other sites
keep theirs.  That file is the commit: its job moves it into place by one rename,
so a reader sees the old rows of all sites or the new rows of all sites, also if
the publish fails in between or a reader is still on the old files, which stay
until ``vacuum``.  A list has an entry for each site, whatever the data.

One publisher a dataset at a time: two that commit the same version are told
apart by their tag and the later one to look raises ``RuntimeError``.

Readers get one relation over the current folders: a filter on ``site`` or on
the day (``date`` where it is a date) prunes folders.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adledger.session import delete_folder

COMMIT = T.StructType([T.StructField("version", T.LongType()), T.StructField("tag", T.StringType()),
                       T.StructField("columns", T.StringType()), T.StructField("unique_by", T.ArrayType(T.StringType())),
                       T.StructField("folders", T.MapType(T.StringType(), T.StringType()))])
# The one entry of a dataset without sites.
WHOLE = ""


@dataclass(frozen=True)
class Version:
    """A committed state of a dataset: its columns and, for each site, the folder of its rows."""
    version: int
    tag: str
    schema: T.StructType
    unique_by: tuple[str, ...]
    folders: dict[str, str]

    @property
    def folder(self) -> str:
        """Where this commit's own rows were written."""
        return f"data/version={self.version:08d}-{self.tag}"


def history(spark: SparkSession, path: str) -> list[Version]:
    """All commits of a dataset, oldest first."""
    try:
        commits = spark.read.schema(COMMIT).parquet(f"{path}/_commits")
        rows = commits.agg(F.collect_list(F.struct(*commits.columns))).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    found = [Version(r.version, r.tag, T.StructType.fromJson(json.loads(r.columns)), tuple(r.unique_by or ()), r.folders)
             for r in rows]
    return sorted(found, key=lambda v: (v.version, v.tag))


def current(spark: SparkSession, path: str) -> Version | None:
    """The last commit (None: nothing is published)."""
    return max(history(spark, path), key=lambda v: (v.version, v.tag), default=None)


def _day(schema: T.StructType) -> str | None:
    """The column of the day folders: ``date`` itself, or ``day`` if dates have a time of day."""
    kinds = {f.name: f.dataType for f in schema}
    if "date" not in kinds:
        return None
    return "date" if isinstance(kinds["date"], T.DateType) else "day"


def _kinds(schema: T.StructType) -> list[tuple[str, str]]:
    """Names and types; whether a column may be null is no difference, as read rows always may."""
    return [(f.name, f.dataType.simpleString()) for f in schema]


def publish_version(df: DataFrame, path: str, sites: list[str] | None = None, by_site: bool = True,
                    by_day: bool = True, unique_by: list[str] | None = None) -> Version:
    """Replace the rows of the sites in ``df``, and of ``sites`` (those without rows are emptied), in one step.

    ``by_site=False`` replaces a dataset without sites (a view) as a whole;
    ``by_day=False`` makes no day folders.
    ``unique_by`` records columns that no two rows share, as a roll-up by them has it.
    """
    spark, schema = df.sparkSession, df.schema
    before = current(spark, path)
    if before is not None and before.folders and by_site and _kinds(before.schema) != _kinds(schema):
        kept = set(before.folders) - set(sites or [])
        if kept:
            raise ValueError(f"columns differ from those of the sites that stay ({sorted(kept)})")
    tag = uuid.uuid4().hex
    number = before.version + 1 if before else 1
    folder = Version(number, tag, schema, (), {}).folder
    day = _day(schema) if by_day else None
    rows = df if day != "day" else df.withColumn("day", F.col("date").cast("date"))
    dirs = [c for c in ("site" if by_site else None, day) if c]
    writer = (rows.hint("rebalance", *dirs) if dirs else rows).write.mode("overwrite")
    (writer.partitionBy(*dirs) if dirs else writer).parquet(f"{path}/{folder}")
    written = spark.read.schema(rows.schema).parquet(f"{path}/{folder}")
    if by_site:
        # Folder names; no column is read.
        seen = written.agg(F.collect_set("site").alias("found"), F.bool_or(F.col("site").isNull()).alias("other")).first()
        found = set(seen.found)
        if seen.other:
            raise ValueError("there are rows without a site")
        folders = {s: f for s, f in (before.folders if before else {}).items() if s not in found | set(sites or [])}
        folders |= {s: folder for s in found}
    else:
        folders = {} if written.isEmpty() else {WHOLE: folder}
    done = Version(number, tag, schema, tuple(unique_by or ()), folders)
    _commit(spark, path, done)
    return done


def _commit(spark: SparkSession, path: str, v: Version) -> None:
    """Add the list of folders: one file, moved into place by one rename."""
    row = (v.version, v.tag, v.schema.json(), list(v.unique_by), v.folders)
    spark.createDataFrame([row], COMMIT).coalesce(1).write.mode("append").parquet(f"{path}/_commits")
    if sum(x.version == v.version for x in history(spark, path)) > 1:
        raise RuntimeError(f"another publisher committed version {v.version} of {path} at the same time; publish again")


def read_version(spark: SparkSession, path: str, version: int | Version | None = None) -> DataFrame:
    """The rows of the last commit, or of an earlier one that has not been vacuumed."""
    v = version if isinstance(version, Version) else current(spark, path) if version is None else next(
        (x for x in history(spark, path) if x.version == version), None)
    if v is None:
        raise FileNotFoundError(f"{path}: " + ("nothing is published" if version is None else f"no version {version}"))
    if not v.folders:
        return spark.createDataFrame([], v.schema)
    day = _day(v.schema)
    schema = v.schema if day != "day" else T.StructType([*v.schema, T.StructField("day", T.DateType())])
    places = sorted(f"{path}/{f}" + (f"/site={folder_name(s)}" if s != WHOLE else "") for s, f in v.folders.items())
    rows = spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*places)
    return rows.select(*v.schema.names)


def folder_name(value: str) -> str:
    """A partition value as the writer escapes it in a folder name."""
    special = set("\"#%'*/:=?\\{[]^\x7f") | {chr(c) for c in range(1, 32)}
    return "".join(f"%{ord(c):02X}" if c in special else c for c in value)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete the folders that only commits before the last ``keep`` refer to; return them."""
    versions = history(spark, path)
    live = {f for v in versions[-max(1, keep):] for f in v.folders.values()}
    dead = sorted({f for v in versions[:-max(1, keep)] for f in v.folders.values()} - live)
    for f in dead:
        delete_folder(spark, f"{path}/{f}")
    return dead
