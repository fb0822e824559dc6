"""O-PUBLISH / O-EXPORT: write datasets.

Datasets are written as Parquet partitioned by ``site``; refreshing some sites
replaces just their partitions, also where a site's result is now empty.  The
CSV export writes one directory per site, without header, as the reference's
unload does.  Both go to shared storage; nothing is written to a machine-local
folder.  ``sources.versions`` publishes with a one-step commit.
"""

from __future__ import annotations

import uuid
from functools import reduce
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from adledger.session import delete_folder, replace_folder
from adledger.sources.versions import folder_name


def publish(df: DataFrame, path: str, partition_by: str = "site", sites: list[str] | None = None) -> None:
    """Replace the dataset's partitions that ``df`` holds, and clear those of ``sites`` without rows.

    Rows are rebalanced by site before the write: few files a site, and a
    large site is split over several tasks.
    """
    seen = Observation()
    rows = df.observe(seen, F.collect_set(F.col(partition_by).cast("string")).alias("written"))
    (rows.hint("rebalance", partition_by).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy(partition_by)
         .parquet(path))
    if sites:
        for site in sorted(set(sites) - set(seen.get["written"])):
            delete_folder(df.sparkSession, f"{path}/{partition_by}={folder_name(site)}")


def read_published(spark: SparkSession, path: str, partition_by: str = "site") -> DataFrame:
    """A published dataset; the partition column is the string it was written from."""
    found = spark.read.parquet(path).schema
    schema = StructType([StructField(f.name, StringType()) if f.name == partition_by else f for f in found])
    return spark.read.schema(schema).parquet(path)


# Null marker of the CSV export.  A text that starts with a backslash gets one more, so none can be the marker.
CSV_NULL = "\\N"
CSV_OPTIONS = {"header": "false", "nullValue": CSV_NULL, "emptyValue": "", "quote": '"', "escape": '"',
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _texts(df: DataFrame, change, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*[change(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, StringType) and f.name not in keep
                       else F.col(f"`{f.name}`") for f in df.schema])


def _guarded(c: Column) -> Column:
    return F.when(c.startswith("\\"), F.concat(F.lit("\\"), c)).otherwise(c)


def _unguarded(c: Column) -> Column:
    return F.when(c.startswith("\\\\"), F.substr(c, F.lit(2))).otherwise(c)


def _folder(path: str, site: str) -> str:
    return f"{path.rstrip('/')}/{quote(site, safe=' ')}"


def export_csv(df: DataFrame, path: str, sites: list[str]) -> None:
    """Unload each of ``sites`` (the configured ones) as header-less CSV into ``path/<site>``.

    One job writes all sites, each row once, beside the directories; then each
    site's directory is replaced by a rename.  Other sites' directories stay as
    they are; a site without rows gets an empty one.  ``path`` names the
    dataset's family, such as ``.../keywords``.
    """
    spark, aside = df.sparkSession, f"{path.rstrip('/')}/_unload-{uuid.uuid4().hex}"
    rows = _texts(df.where(F.col("site").isin(list(sites))), _guarded, keep=("site",))
    rows.hint("rebalance", "site").write.options(**CSV_OPTIONS, quoteAll="true").partitionBy("site").csv(aside)
    for site in sites:
        replace_folder(spark, f"{aside}/site={folder_name(site)}", _folder(path, site))
    delete_folder(spark, aside)


def read_csv_export(spark: SparkSession, path: str, schema: StructType, sites: list[str]) -> DataFrame:
    """Read an export back with a pinned schema (without ``site``, which the directories give)."""
    parts = [_texts(spark.read.schema(schema).options(**CSV_OPTIONS, multiLine="true").csv(_folder(path, s)),
                    _unguarded).withColumn("site", F.lit(s)) for s in sites]
    return reduce(DataFrame.unionByName, parts)
