"""The per-site PPC datasets, for all sites in one job.

Every key carries ``site``; a site's rows never meet another site's rows in a
snapshot pick, join or roll-up (T27), so one job equals the union of the
per-site jobs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adledger.config import SiteConfig
from adledger.operators import partner, rollup, search
from adledger.operators.snapshot import staged_times
from adledger.session import drop_staged, stage_table, together
from adledger.sources.reports import for_network


@dataclass
class SearchStage:
    """Shared intermediate results of one search network report.

    ``latest`` (the picked rows at the finest key) and ``attached`` (impressions
    and budgets of every item and day) each have several consumers.  Left lazy,
    every consumer would scan and shuffle the report once more, so both are
    written as staging tables in the shared checkpoint folder
    (``session.stage_table``).  Only picked rows are staged, not the history.
    ``totals`` (impressions by click type) are read from ``latest``.
    """
    latest: DataFrame
    totals: DataFrame
    budget: DataFrame
    item_id: str

    @cached_property
    def attached(self) -> DataFrame:
        """Impressions and budgets of every (item, day), staged when first asked for; all datasets read the same."""
        return stage_table(search.attachments(self.totals, self.budget, self.item_id), f"search-{self.item_id}-attached")

    def release(self) -> None:
        """Delete the staging tables (after the datasets built on them are written)."""
        for df in (self.latest, *([self.attached] if "attached" in self.__dict__ else [])):
            drop_staged(df)


def _stage(report: DataFrame, keys: list[str], fine: Callable[[DataFrame], DataFrame], item_id: str,
           budget: Callable[[], DataFrame]) -> SearchStage:
    """The maxima staged, then the picked rows, ``fine`` of them (and at the same time the budgets)."""
    def picked() -> DataFrame:
        times = staged_times(report, keys, search.TS, f"search-{item_id}")
        try:
            return stage_table(fine(search.latest_rows(report, keys, times)), f"search-{item_id}-latest")
        finally:
            drop_staged(times)

    latest, budgets = together(picked, budget)
    return SearchStage(latest, search.clicktype_totals(latest, item_id), budgets, item_id)


def search_budget(campaign_report: DataFrame, config: list[SiteConfig]) -> DataFrame:
    """O-BUDGET for the configured search sites (shared by the ad and keyword stages)."""
    return search.campaign_budget(for_network(campaign_report, config, "google"), staged="campaign-report")


def search_ads_stage(google_ads: DataFrame, campaign_report: DataFrame,
                     config: list[SiteConfig],
                     snapshot_keys: list[str] = search.SNAP_KEYS,
                     budget: DataFrame | None = None) -> SearchStage:
    """Shared stage of P1/P2.  ``snapshot_keys=search.SNAP_KEYS_BY_ID`` is the T1 correction."""
    ads = for_network(google_ads, config, "google")
    return _stage(ads, snapshot_keys, lambda rows: search.ad_fine(rows, config), "adid",
                  lambda: budget if budget is not None else search_budget(campaign_report, config))


def google_creative_rows(stage: SearchStage, display: bool = False,
                         only_display: bool = False) -> DataFrame:
    """Search network half of P1 (``display=False``) or of P2 (``display=True``)."""
    rows = search.by_item(stage.latest, "adid")
    items = search.all_ads_null_campaign(rows, only_display) if display else search.search_ads(rows)
    final = search.attach_impressions_and_budget(items, stage.attached, "adid")
    return search.normalize_ads(final)


def partner_times(bing_ads: DataFrame, config: list[SiteConfig]) -> DataFrame:
    """The latest load of each site and day of the partner ad report, staged."""
    return staged_times(for_network(bing_ads, config, "bing"), partner.SNAP_KEYS, partner.TS, "partner-ads")


def bing_creative_rows(bing_ads: DataFrame, bing_campaigns: DataFrame,
                       config: list[SiteConfig], times: DataFrame | None = None) -> DataFrame:
    times = times if times is not None else partner_times(bing_ads, config)
    ads = for_network(bing_ads, config, "bing")
    return partner.normalize_ads(partner.ads_with_budget(ads, for_network(bing_campaigns, config, "bing"), times))


def ppc_creatives(google_ads: DataFrame, campaign_report: DataFrame, bing_ads: DataFrame,
                  bing_campaigns: DataFrame, config: list[SiteConfig],
                  stage: SearchStage | None = None) -> DataFrame:
    """Non-display creatives per site and day, search + search partner (O-UNION-NET)."""
    given = stage
    stage, times = together(lambda: given or search_ads_stage(google_ads, campaign_report, config),
                            lambda: partner_times(bing_ads, config))
    rows = google_creative_rows(stage).drop(search.ITEM).unionByName(
        bing_creative_rows(bing_ads, bing_campaigns, config, times))
    return rollup.daily_creatives(rows)


def display_creatives(google_ads: DataFrame, campaign_report: DataFrame,
                      config: list[SiteConfig], stage: SearchStage | None = None,
                      only_display: bool = False) -> DataFrame:
    """The 'display' creatives dataset (campaign null, T8).

    Parity default: no campaign filter, so it holds every search campaign and
    the all-creatives view counts non-display ads twice (T9).
    ``only_display=True`` applies the display filter the name promises.
    """
    stage = stage or search_ads_stage(google_ads, campaign_report, config)
    return rollup.daily_creatives(google_creative_rows(stage, display=True,
                                                       only_display=only_display))


def search_keywords_stage(google_keywords: DataFrame, campaign_report: DataFrame,
                          config: list[SiteConfig],
                          snapshot_keys: list[str] = search.SNAP_KEYS,
                          budget: DataFrame | None = None) -> SearchStage:
    """Shared stage of P3/P4.  ``snapshot_keys=search.SNAP_KEYS_BY_ID`` is the T1 correction."""
    kws = for_network(google_keywords, config, "google")
    return _stage(kws, snapshot_keys, search.keyword_fine, "keywordid",
                  lambda: budget if budget is not None else search_budget(campaign_report, config))


def google_keyword_rows(stage: SearchStage, campaigns: DataFrame, config: list[SiteConfig],
                        display: bool = False) -> DataFrame:
    named = search.keywords_with_campaign(stage.latest, for_network(campaigns, config, "google"), display)
    items = (search.by_item(named, "keywordid")
             .withColumn("max_cpc_micros", F.coalesce("maxcpc_micros", F.lit(0).cast("long")))
             .drop("maxcpc_micros"))
    final = search.attach_impressions_and_budget(items, stage.attached, "keywordid")
    return search.normalize_keywords(final)


def partner_history(bing_keywords: DataFrame, config: list[SiteConfig], as_of: dt.date | str | None) -> DataFrame:
    """The partner keyword report reduced for its two readers, staged."""
    return stage_table(partner.keyword_history(for_network(bing_keywords, config, "bing"), as_of), "partner-keywords")


def bing_keyword_rows(bing_keywords: DataFrame, bing_campaigns: DataFrame,
                      config: list[SiteConfig], as_of: dt.date | str | None,
                      match_keys: tuple[str, ...] = ("keywordid",), history: DataFrame | None = None) -> DataFrame:
    history = history if history is not None else partner_history(bing_keywords, config, as_of)
    budgets = stage_table(partner.daily_budgets(for_network(bing_campaigns, config, "bing")), "partner-budgets")
    rows = partner.history_with_budget(history, budgets)
    return partner.normalize_keywords(
        partner.attach_match_type(rows, partner.latest_match_types(history), match_keys))


def ppc_keywords(google_keywords: DataFrame, campaign_report: DataFrame, campaigns: DataFrame,
                 bing_keywords: DataFrame, bing_campaigns: DataFrame, config: list[SiteConfig],
                 as_of: dt.date | str | None = None,
                 stage: SearchStage | None = None,
                 match_keys: tuple[str, ...] = ("keywordid",)) -> DataFrame:
    """Non-display keywords per site and day; ``as_of`` defaults to today.

    ``match_keys`` selects the partner match-type join keys (T13; parity default).
    """
    given = stage
    stage, history = together(lambda: given or search_keywords_stage(google_keywords, campaign_report, config),
                              lambda: partner_history(bing_keywords, config, as_of))
    rows = google_keyword_rows(stage, campaigns, config).drop(search.ITEM).unionByName(
        bing_keyword_rows(bing_keywords, bing_campaigns, config, as_of, match_keys, history))
    return rollup.daily_keywords(rows)


def display_keywords(google_keywords: DataFrame, campaign_report: DataFrame,
                     campaigns: DataFrame, config: list[SiteConfig],
                     stage: SearchStage | None = None) -> DataFrame:
    """Display-campaign keywords (search network only)."""
    stage = stage or search_keywords_stage(google_keywords, campaign_report, config)
    return rollup.daily_keywords(google_keyword_rows(stage, campaigns, config, display=True))
