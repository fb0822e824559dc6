"""O-SCAN / O-SITES: read raw reports for a set of sites.

On a cluster each raw report is one Parquet dataset partitioned by ``site``;
the schema is pinned (no inference) and the site list becomes a partition
filter, so only the configured sites' files are listed and read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adledger.config import SiteConfig, sites_with


def read_report(spark: SparkSession, path: str, schema: StructType,
                sites: list[str] | None = None) -> DataFrame:
    """Scan one raw report with a pinned schema, pruned to ``sites``."""
    df = spark.read.schema(schema).parquet(path)
    return df if sites is None else restrict_to_sites(df, sites)


def restrict_to_sites(df: DataFrame, sites: list[str]) -> DataFrame:
    """Keep the rows of the given sites (a partition filter on ``site``)."""
    return df.where(F.col("site").isin(list(sites)))


def for_network(df: DataFrame, config: list[SiteConfig], network: str) -> DataFrame:
    """O-SITES: keep only rows of sites that have ``network`` configured."""
    return restrict_to_sites(df, sites_with(config, network))


@dataclass
class RawReports:
    """The eleven raw reports one refresh reads (S1-S11), each with a ``site`` column.

    ``sources.testdata.Reports`` offers the same attributes, derived from the
    seeded tables.
    """
    google_ads: DataFrame
    google_keywords: DataFrame
    google_campaign_report: DataFrame
    google_campaigns: DataFrame
    bing_ads: DataFrame
    bing_keywords: DataFrame
    bing_campaigns: DataFrame
    social_insights: DataFrame
    social_campaigns: DataFrame
    social_adsets: DataFrame
    social_ads: DataFrame


def read_reports(spark: SparkSession, root: str, sites: list[str] | None = None) -> RawReports:
    """Read the raw reports stored as ``root/<report>`` Parquet folders partitioned by site."""
    from adledger import schemas

    def rd(name: str, schema: StructType) -> DataFrame:
        return read_report(spark, f"{root.rstrip('/')}/{name}", schema, sites)
    return RawReports(
        google_ads=rd("google_ads", schemas.GOOGLE_ADS),
        google_keywords=rd("google_keywords", schemas.GOOGLE_KEYWORDS),
        google_campaign_report=rd("google_campaign_report", schemas.GOOGLE_CAMPAIGN_REPORT),
        google_campaigns=rd("google_campaigns", schemas.GOOGLE_CAMPAIGNS),
        bing_ads=rd("bing_ads", schemas.BING_ADS),
        bing_keywords=rd("bing_keywords", schemas.BING_KEYWORDS),
        bing_campaigns=rd("bing_campaigns", schemas.BING_CAMPAIGNS),
        social_insights=rd("social_insights", schemas.SOCIAL_INSIGHTS),
        social_campaigns=rd("social_campaigns", schemas.SOCIAL_CAMPAIGNS),
        social_adsets=rd("social_adsets", schemas.SOCIAL_ADSETS),
        social_ads=rd("social_ads", schemas.SOCIAL_ADS),
    )
