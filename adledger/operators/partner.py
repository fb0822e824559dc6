"""Search partner (Bing) steps of the PPC datasets.

The reference joins raw rows at the latest load of each day to the campaign
entity (for the daily budget) and, for keywords, to the latest non-empty
match type, and only then sums.  Here the rows are picked first (maxima of a narrow
scan joined back), then combined on every column the final roll-up groups by,
and, as sums are linear, the joins carry a multiplicity that scales them.  Same
numbers, one wide shuffle of the picked rows only, no fan-out of raw rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adledger.functions import in_rolling_window, platform_tag, to_micros, typed_null
from adledger.functions.scalars import ROLLING_DAYS
from adledger.operators.joins import salted_left_join
from adledger.operators.snapshot import latest_snapshot, latest_values, with_multiplicity

TS = "_sdc_report_datetime"
SNAP_KEYS = ["site", "timeperiod"]

# Fixed value: network tag.
PLATFORM = "Bing"

AD_KEYS = ["site", "accountname", "accountid", "campaignid", "adgroupid", "adid",
           "campaignname", "adgroupname", "finalurl", "titlepart1", "titlepart2",
           "addescription", "adgroupstatus", "campaignstatus", "adstatus", "timeperiod", TS]
KW_KEYS = ["site", "accountname", "accountid", "campaignid", "adgroupid", "keywordid",
           "campaignname", "adgroupname", "keyword", "adgroupstatus", "campaignstatus",
           "keywordstatus", "timeperiod", TS]
MATCH_KEYS = ["site", "campaignid", "adgroupid", "keywordid"]


def _fine(report: DataFrame, keys: list[str]) -> DataFrame:
    return report.groupBy(*keys).agg(
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        F.sum(to_micros("spend")).alias("cost_micros"),
    )


def daily_budgets(campaigns: DataFrame) -> DataFrame:
    """Campaign entity as (site, campaignid, budget, multiplicity)."""
    dim = campaigns.select("site", F.col("id").alias("campaignid"),
                           F.col("dailybudget").alias("budget"))
    return with_multiplicity(dim, ["site", "campaignid", "budget"], "__n")


def _scaled(df: DataFrame, factor) -> list:
    return [(F.col(c) * factor).alias(c) for c in ("impressions", "clicks", "cost_micros")]


def latest_day_rows(report: DataFrame, keys: list[str], times: DataFrame | None = None) -> DataFrame:
    """O-SNAP per (site, day), then the wide aggregate of the rows picked.  ``times``: the maxima, if staged."""
    return _fine(latest_snapshot(report, SNAP_KEYS, TS, times), keys)


def ads_with_budget(ads: DataFrame, campaigns: DataFrame, times: DataFrame | None = None) -> DataFrame:
    """Latest ad rows per day joined (inner) to the campaign's daily budget."""
    latest = latest_day_rows(ads, AD_KEYS, times)
    j = latest.join(daily_budgets(campaigns), ["site", "campaignid"], "inner")
    others = [c for c in AD_KEYS if c != TS]
    return j.select(*others, *_scaled(j, F.col("__n")), "budget")


def in_window(report: DataFrame, as_of: dt.date | str | None,
              days: int = ROLLING_DAYS) -> DataFrame:
    """O-ROLL30 on the day column (applied before the snapshot pick, T4)."""
    return report.where(in_rolling_window("timeperiod", as_of, days))


def keyword_history(keywords: DataFrame, as_of: dt.date | str | None) -> DataFrame:
    """One pass over the keyword report for both of its readers.

    Rows of the 31 days are summed by every column that is read of them; of
    older rows only the match type of the keyword and day is kept, once.  Staged,
    this feeds the snapshot pick (maxima and rows) and the match types.
    """
    inside = F.coalesce(in_rolling_window("timeperiod", as_of, ROLLING_DAYS), F.lit(False))
    wide = [k for k in KW_KEYS if k not in (*MATCH_KEYS, "timeperiod")]
    rows = (keywords.where(inside | (F.col("bidmatchtype") != ""))
                    .select(*MATCH_KEYS, "timeperiod", "bidmatchtype", inside.alias("inside"),
                            *[F.when(inside, F.col(c)).alias(c) for c in wide],
                            *[F.when(inside, F.col(c)).alias(c) for c in ("impressions", "clicks")],
                            F.when(inside, to_micros("spend")).alias("cost_micros")))
    return (rows.groupBy(*MATCH_KEYS, "timeperiod", "bidmatchtype", "inside", *wide)
                .agg(*[F.sum(c).alias(c) for c in ("impressions", "clicks", "cost_micros")]))


def history_with_budget(history: DataFrame, budgets: DataFrame) -> DataFrame:
    """``keywords_with_budget`` from the staged history and ``daily_budgets``."""
    picked = latest_snapshot(history.where("inside"), SNAP_KEYS, TS)
    latest = picked.groupBy(*KW_KEYS).agg(*[F.sum(c).alias(c) for c in ("impressions", "clicks", "cost_micros")])
    return _with_budget(latest, budgets)


def latest_match_types(keywords: DataFrame) -> DataFrame:
    """O-LATESTVAL: non-empty match types at the latest day per (campaign, ad group, keyword)."""
    return latest_values(keywords, MATCH_KEYS, "timeperiod", "bidmatchtype",
                         keep=F.col("bidmatchtype") != "")


def keywords_with_budget(keywords: DataFrame, campaigns: DataFrame,
                         as_of: dt.date | str | None) -> DataFrame:
    return _with_budget(latest_day_rows(in_window(keywords, as_of), KW_KEYS), daily_budgets(campaigns))


def _with_budget(latest: DataFrame, budgets: DataFrame) -> DataFrame:
    j = latest.join(budgets, ["site", "campaignid"], "inner")
    others = [c for c in KW_KEYS if c != TS]
    return j.select(*others, *_scaled(j, F.col("__n")), "budget")


def attach_match_type(kw: DataFrame, match_types: DataFrame,
                      match_keys: tuple[str, ...] = ("keywordid",)) -> DataFrame:
    """O-JOIN-MT: left join on keyword id only (T13, T14); fan-out kept as a multiplicity.

    ``match_keys=("campaignid", "adgroupid", "keywordid")`` is the named
    correction (off by default): join on the keys the match type was computed on.
    """
    keys = ["site", *match_keys]
    mt = with_multiplicity(match_types.select(*keys, "bidmatchtype"),
                           [*keys, "bidmatchtype"], "__m")
    j = salted_left_join(kw, mt, keys, ["campaignid", "adgroupid", "timeperiod"])
    factor = F.coalesce(F.col("__m"), F.lit(1))
    others = [c for c in kw.columns if c not in ("impressions", "clicks", "cost_micros")]
    return j.select(*others, "bidmatchtype", *_scaled(j, factor))


def normalize_ads(rows: DataFrame) -> DataFrame:
    """O-PROJ-B: partner ad rows in the common creative layout."""
    return rows.select(
        "site", F.col("accountname").alias("account"), F.col("accountid").alias("account_id"),
        platform_tag("accountid", PLATFORM).alias("platform"),
        F.col("campaignid").alias("campaign_id"), F.col("adgroupid").alias("adgroup_id"),
        F.col("adid").alias("creative_id"), F.col("adgroupname").alias("adgroup"),
        F.col("campaignname").alias("campaign"), "impressions", "clicks", "cost_micros",
        F.col("finalurl").alias("url"), F.col("titlepart1").alias("headline1"),
        F.col("titlepart2").alias("headline2"), typed_null().alias("headline3"),
        F.col("addescription").alias("description"),
        F.col("adgroupstatus").alias("adgroup_state"),
        F.col("campaignstatus").alias("campaign_state"),
        F.col("adstatus").alias("creative_state"), F.col("timeperiod").alias("date"), "budget")


def normalize_keywords(rows: DataFrame) -> DataFrame:
    """O-PROJ-B for keywords; max CPC is the constant 0."""
    return rows.select(
        "site", F.col("accountname").alias("account"), F.col("accountid").alias("account_id"),
        platform_tag("accountid", PLATFORM).alias("platform"),
        F.col("campaignid").alias("campaign_id"), F.col("adgroupid").alias("adgroup_id"),
        F.col("keywordid").alias("keyword_id"), F.col("adgroupname").alias("adgroup"),
        F.col("campaignname").alias("campaign"), "keyword", "impressions", "clicks",
        "cost_micros", F.col("adgroupstatus").alias("adgroup_state"),
        F.col("campaignstatus").alias("campaign_state"),
        F.col("keywordstatus").alias("keyword_state"),
        F.col("bidmatchtype").alias("match_type"), F.col("timeperiod").alias("date"),
        F.lit(0).cast("long").alias("max_cpc_micros"), "budget")
