"""The daily refresh as one Spark job: every dataset for every site.

Builds the shared stages once (the picked rows of each search report, and the
campaign budgets for both), publishes the five datasets laid out by site and
day under ``out_root``, then the five union views over them, and releases the
staging tables.  Every dataset and view changes by one commit
(``sources.versions``): readers see yesterday's rows or today's, and a failed or
partial run can simply be re-run.  ``r`` is a ``sources.reports.RawReports``
(``read_reports``) or the seeded-table ``sources.testdata.Reports``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from adledger.config import SiteConfig
from adledger.plans import ppc, social, views
from adledger.session import stage_table, staging
from adledger.sources.reports import RawReports
from adledger.sources.versions import publish_version

DATASETS = ("ppc_creatives", "display_creatives", "ppc_keywords", "display_keywords",
            "social_ads")


def build_all(r: RawReports, config: list[SiteConfig], as_of: dt.date | str | None = None
              ) -> tuple[dict[str, DataFrame], list[ppc.SearchStage]]:
    """The five datasets (lazy apart from the staging writes) and the stages behind them."""
    budget = stage_table(ppc.search_budget(r.google_campaign_report, config), "campaign-budget")
    ads = ppc.search_ads_stage(r.google_ads, r.google_campaign_report, config, budget=budget)
    kws = ppc.search_keywords_stage(r.google_keywords, r.google_campaign_report, config,
                                    budget=budget)
    datasets = {
        "ppc_creatives": ppc.ppc_creatives(r.google_ads, r.google_campaign_report, r.bing_ads,
                                           r.bing_campaigns, config, stage=ads),
        "display_creatives": ppc.display_creatives(r.google_ads, r.google_campaign_report,
                                                   config, stage=ads),
        "ppc_keywords": ppc.ppc_keywords(r.google_keywords, r.google_campaign_report,
                                         r.google_campaigns, r.bing_keywords, r.bing_campaigns,
                                         config, as_of, stage=kws),
        "display_keywords": ppc.display_keywords(r.google_keywords, r.google_campaign_report,
                                                 r.google_campaigns, config, stage=kws),
        "social_ads": social.social_ads(r.social_insights, r.social_campaigns, r.social_adsets,
                                        r.social_ads, config),
    }
    return datasets, [ads, kws]


def run_daily(r: RawReports, config: list[SiteConfig], out_root: str,
              as_of: dt.date | str | None = None) -> dict[str, str]:
    """Publish every dataset and view under ``out_root``; return name -> folder of the rows just published.

    Readers go through ``versions.read_version`` (datasets and view copies) or
    ``views.published_views``, which follow the last commit.
    """
    sites, root, paths = [c.site for c in config], out_root.rstrip("/"), {}
    with staging():
        datasets, _ = build_all(r, config, as_of)
        for name, df in datasets.items():
            done = publish_version(df, f"{root}/{name}", sites=sites, unique_by=["site", *views.UNIQUE_BY[name]])
            paths[name] = f"{root}/{name}/{done.folder}"
        spark = df.sparkSession
        for name, df in views.published_views(spark, root).items():
            done = publish_version(df, f"{root}/{name}", by_site=False, by_day=False)   # views have no site column
            paths[name] = f"{root}/{name}/{done.folder}"
    return paths
