"""Social network steps (P5).

Join shape.  The base joins insights to every version of its campaign and ad
set (no snapshot pick, T28) and then takes DISTINCT over the projected
columns.  The ad-set side contributes no column, so it is an existence test
(left semi join on distinct ids); the campaign side contributes only
(account id, id, name), so it is de-duplicated before the join.  Both are
exact rewrites of "join every version, then DISTINCT" without the per-version
fan-out of the insight rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adledger.config import SiteConfig, account_name, adset_patterns
from adledger.functions import to_micros

TS = "_sdc_received_at"

# The three action types that are pivoted into columns.
POST_REACTION = "post_reaction"
LINK_CLICK = "link_click"
LIKE = "like"


def adset_filter(config: list[SiteConfig]) -> Column | None:
    """O-PATTERN: a site's LIKE pattern on the lower-cased ad-set name, other sites pass."""
    patterns = adset_patterns(config)
    if not patterns:
        return None
    name = F.lower(F.col("adset_name"))
    matched = reduce(lambda a, b: a | b,
                     [(F.col("site") == s) & name.like(p) for s, p in patterns.items()])
    return matched | ~F.col("site").isin(list(patterns))


def social_base(insights: DataFrame, campaigns: DataFrame, adsets: DataFrame,
                config: list[SiteConfig]) -> DataFrame:
    """O-JOIN-FB + O-PATTERN + O-PROJ-F + F9 + DISTINCT."""
    adset_ids = adsets.select("site", F.col("id").alias("adset_id")).distinct()
    camps = campaigns.select("site", F.col("id").alias("campaign_id"), "account_id",
                             F.col("name").alias("campaign_name")).distinct()
    ins = insights
    cond = adset_filter(config)
    if cond is not None:
        ins = ins.where(cond)
    base = (ins.join(adset_ids, ["site", "adset_id"], "left_semi")
               .join(camps, ["site", "campaign_id"], "inner"))
    return base.select(
        "site", "account_id", "campaign_id", "campaign_name",
        F.col("adset_id").alias("adgroup_id"), F.col("adset_name").alias("adgroup_name"),
        "ad_id", "ad_name", F.col("date_start").alias("date"),
        account_name(F.col("account_id"), config).alias("account_name"),
        "impressions", "clicks", "spend", "reach", "frequency",
        F.col("inline_link_clicks").alias("link_clicks"),
    ).distinct().select(
        # DISTINCT compares the spend as reported; only then is it rounded to micros.
        "site", "account_id", "campaign_id", "campaign_name", "adgroup_id", "adgroup_name", "ad_id", "ad_name",
        "date", "account_name", "impressions", "clicks", to_micros("spend").alias("cost_micros"), "reach",
        "frequency", "link_clicks")


def latest_entity_status(entities: DataFrame, id_alias: str, status_alias: str) -> DataFrame:
    """O-SNAP per entity id + DISTINCT status; ties with different values fan out.

    Each status is first reduced to its last load, map-side: what is left of an
    entity is a row for each of the few statuses, and the table is read once.
    """
    last = entities.where(F.col("id").isNotNull() & F.col("site").isNotNull()).groupBy("site", "id", "effective_status").agg(
        F.max(TS).alias(TS))
    newest = F.max(TS).over(Window.partitionBy("site", "id"))
    return (last.withColumn("__newest", newest).where(F.col(TS) == F.col("__newest"))
                .select("site", F.col("id").alias(id_alias), F.col("effective_status").alias(status_alias)))


def action_rows(insights: DataFrame) -> DataFrame:
    """O-LATERAL: one row per action entry; rows without actions vanish (inner unnest)."""
    return (insights
            .select("site", "campaign_id", "adset_id", "ad_id", "date_start",
                    F.explode("actions").alias("a"))
            .select("site", "campaign_id", "adset_id", "ad_id", "date_start",
                    F.col("a.value.action_type").alias("action_type"),
                    F.col("a.value.value").alias("value")))


def action_stats(insights: DataFrame) -> DataFrame:
    """O-ACTSUM: action value per (type, ad, ad set, campaign, day) over all insight rows."""
    return (action_rows(insights)
            .groupBy("site", "action_type", "ad_id", "adset_id", "campaign_id", "date_start")
            .agg(F.sum("value").alias("value")))


def _pivot_sums(suffix: str) -> list[Column]:
    def one(kind: str, name: str) -> Column:
        return F.sum(F.when(F.col("action_type") == kind, F.col("value"))
                     .otherwise(F.lit(0))).alias(f"{name}_{suffix}")
    return [one(POST_REACTION, "post_reactions"), one(LINK_CLICK, "link_clicks"),
            one(LIKE, "likes")]


GRAINS = {
    "ad": ["campaign_id", "adset_id", "ad_id", "date_start"],
    "adset": ["campaign_id", "adset_id", "date_start"],
    "campaign": ["campaign_id", "date_start"],
}


def action_pivot(rows: DataFrame, grain: str = "ad") -> DataFrame:
    """O-PIVOT / O-PIVOT-S / O-PIVOT-C: conditional sums of three action types.

    ``rows`` may be the per-type sums (``action_stats``) or the unnested rows
    (``action_rows``): a conditional sum of partial sums equals the
    conditional sum of the rows, null and zero cases included, so the daily
    dataset pivots the unnested rows directly and saves one shuffle.
    Not ``DataFrame.pivot``: that yields null where this must yield 0 (T24).
    """
    return rows.groupBy("site", *GRAINS[grain]).agg(*_pivot_sums(grain))


def latest_received(insights: DataFrame) -> DataFrame:
    """O-REACH: latest load time per ad (computed by the reference, not used downstream)."""
    return insights.groupBy("site", "ad_id").agg(F.max(TS).alias(TS))


def attach_statuses(base: DataFrame, ads: DataFrame, adsets: DataFrame,
                    campaigns: DataFrame) -> DataFrame:
    """O-JOIN-ST: three left joins to the latest statuses."""
    return (base.join(latest_entity_status(ads, "ad_id", "ad_status"), ["site", "ad_id"], "left")
                .join(latest_entity_status(adsets, "adgroup_id", "adgroup_status"),
                      ["site", "adgroup_id"], "left")
                .join(latest_entity_status(campaigns, "campaign_id", "campaign_status"),
                      ["site", "campaign_id"], "left"))


def attach_actions(rows: DataFrame, pivot: DataFrame) -> DataFrame:
    """O-JOIN-ACT: left join on the three ids and the day (cast on both sides, T24)."""
    act = pivot.select("site", "ad_id", F.col("adset_id").alias("adgroup_id"), "campaign_id",
                       F.col("date_start").cast("date").alias("__day"),
                       "post_reactions_ad", "link_clicks_ad", "likes_ad")
    return (rows.withColumn("__day", F.col("date").cast("date"))
                .join(act, ["site", "ad_id", "adgroup_id", "campaign_id", "__day"], "left")
                .drop("__day"))
