"""P5: the per-site social ads dataset, for all social sites in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame

from adledger.config import SiteConfig
from adledger.operators import rollup, social
from adledger.sources.reports import for_network


def social_ads(insights: DataFrame, campaigns: DataFrame, adsets: DataFrame, ads: DataFrame,
               config: list[SiteConfig]) -> DataFrame:
    """P5: base (distinct) + latest statuses + ad-grain action pivot, summed per day."""
    ins = for_network(insights, config, "facebook")
    camps = for_network(campaigns, config, "facebook")
    sets = for_network(adsets, config, "facebook")
    base = social.social_base(ins, camps, sets, config)
    with_status = social.attach_statuses(base, for_network(ads, config, "facebook"), sets, camps)
    pivot = social.action_pivot(social.action_rows(ins), "ad")
    return rollup.daily_social(social.attach_actions(with_status, pivot))
