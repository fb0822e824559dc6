"""O-SCAN over a source of its own for each site and network.

Every site names a location for each of its networks; a report is the union of
the sites' folders, each read with the columns it has and brought to the pinned
schema by name: a missing column is a typed null, a column of another type is
cast (a value that doesn't fit is an error, none is dropped), nested records are
matched field by field.  Loaders that meet a second type write it to a twin
column ``<name>__<type>``; twins fill the nulls of the first.  Columns that no
step reads are left out.

Only the folders of configured (site, network) pairs are listed.  ``site`` is a
constant of each branch, so a filter on it drops whole branches before anything
is read, and all branches are one job.
"""

from __future__ import annotations

from dataclasses import fields
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adledger import schemas
from adledger.config import SiteConfig, sites_with
from adledger.sources.reports import RawReports

# Raw report -> (network, pinned schema); the names are those of ``RawReports``.
REPORTS: dict[str, tuple[str, T.StructType]] = {
    "google_ads": ("google", schemas.GOOGLE_ADS),
    "google_keywords": ("google", schemas.GOOGLE_KEYWORDS),
    "google_campaign_report": ("google", schemas.GOOGLE_CAMPAIGN_REPORT),
    "google_campaigns": ("google", schemas.GOOGLE_CAMPAIGNS),
    "bing_ads": ("bing", schemas.BING_ADS),
    "bing_keywords": ("bing", schemas.BING_KEYWORDS),
    "bing_campaigns": ("bing", schemas.BING_CAMPAIGNS),
    "social_insights": ("facebook", schemas.SOCIAL_INSIGHTS),
    "social_campaigns": ("facebook", schemas.SOCIAL_CAMPAIGNS),
    "social_adsets": ("facebook", schemas.SOCIAL_ADSETS),
    "social_ads": ("facebook", schemas.SOCIAL_ADS),
}
# The type names that twin columns end in.
TWIN_TYPES = ("bigint", "long", "int", "double", "float", "string", "boolean", "timestamp", "date")


def location(site: SiteConfig, network: str, report: str) -> str:
    """The folder of one site's report."""
    if network not in site.sources:
        raise ValueError(f"site {site.site!r} has {network} but no location for it in `sources`")
    where = site.sources[network]
    return where.replace("{report}", report) if "{report}" in where else f"{where.rstrip('/')}/{report}"


def _conformed(c: Column, have: T.DataType, want: T.DataType, name: str) -> Column:
    """``c`` of type ``have`` as ``want``; records by their fields' names, whatever their order."""
    if have == want:
        return c
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(c, lambda x: _conformed(x, have.elementType, want.elementType, name))
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        own = {f.name.lower(): f for f in have}
        inner = [_conformed(c[own[f.name.lower()].name], own[f.name.lower()].dataType, f.dataType, f"{name}.{f.name}")
                 if f.name.lower() in own else F.lit(None).cast(f.dataType) for f in want]
        return F.when(c.isNotNull(), F.struct(*[i.alias(f.name) for i, f in zip(inner, want, strict=True)]))
    if any(isinstance(t, (T.ArrayType, T.StructType, T.MapType)) for t in (have, want)):
        raise TypeError(f"column {name} is {have.simpleString()}, not {want.simpleString()}")
    return c.cast(want)


def reconciled(df: DataFrame, schema: T.StructType, site: str) -> DataFrame:
    """The columns of ``schema`` from whatever ``df`` has of them, and the site."""
    own: dict[str, T.StructField] = {f.name.lower(): f for f in df.schema}

    def column(want: T.StructField) -> Column:
        if want.name == "site":
            return F.lit(site).alias("site")
        names = [want.name.lower(), *(f"{want.name.lower()}__{t}" for t in TWIN_TYPES)]
        found = [_conformed(F.col(f"`{own[n].name}`"), own[n].dataType, want.dataType, want.name) for n in names if n in own]
        return (F.coalesce(*found) if found else F.lit(None).cast(want.dataType)).alias(want.name)

    return df.select(*[column(f) for f in schema])


def read_site_report(spark: SparkSession, config: list[SiteConfig], report: str) -> DataFrame:
    """One raw report of all sites that have its network, each from its own location."""
    network, schema = REPORTS[report]
    sites = set(sites_with(config, network))
    branches = [reconciled(spark.read.option("mergeSchema", "true").parquet(location(c, network, report)), schema, c.site)
                for c in config if c.site in sites]
    return reduce(DataFrame.union, branches) if branches else spark.createDataFrame([], schema)


def read_site_reports(spark: SparkSession, config: list[SiteConfig]) -> RawReports:
    """All raw reports of the configured sites and networks."""
    return RawReports(**{f.name: read_site_report(spark, config, f.name) for f in fields(RawReports)})
